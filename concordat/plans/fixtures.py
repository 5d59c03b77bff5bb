"""Entity tables derived from the test tables, as SQL text that Spark and DuckDB both run.

Every fixture takes whole tables.  The key arithmetic only varies values (a country in lower case
here, an empty identifier there) so that each rule meets each kind of input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_TABLES = ("customer", "nation", "orders", "part", "embeddings")

_KEY = "lpad(cast(c_custkey AS string), 17, '0')"
_FULL = "concat(c_name, ' ', c_mktsegment, ' PLC')"
_CUSTOMERS = "{customer} JOIN {nation} ON c_nationkey = n_nationkey"

# One record per customer.  Each twentieth goes by an identifier no client knows.
_REGISTRY_FIELDS = f"""
    concat(CASE WHEN c_custkey % 20 = 7 THEN 'OLD' ELSE 'LEI' END, {_KEY}) AS lei,
    {_FULL} AS name,
    n_name AS country,
    c_mktsegment AS legal_form,
    CASE c_custkey % 25 WHEN 3 THEN 'LAPSED' WHEN 9 THEN 'inactive' WHEN 14 THEN NULL
        WHEN 16 THEN 'active' ELSE 'ACTIVE' END AS status,
    concat('RA', lpad(cast(n_regionkey AS string), 6, '0')) AS registration_authority"""

_CLIENT_FIELDS = f"""
    CASE c_custkey % 10 WHEN 0 THEN c_name WHEN 1 THEN upper({_FULL})
        WHEN 2 THEN concat('Acme ', cast(c_custkey AS string))
        WHEN 3 THEN concat('  ', {_FULL}, ' ') WHEN 4 THEN '' ELSE {_FULL} END AS entity_name,
    CASE c_custkey % 13 WHEN 4 THEN NULL WHEN 5 THEN '' ELSE concat('LEI', {_KEY}) END AS entity_lei,
    CASE c_custkey % 11 WHEN 2 THEN 'XX' WHEN 6 THEN NULL WHEN 8 THEN lower(n_name)
        ELSE n_name END AS country,
    CASE c_custkey % 17 WHEN 1 THEN 'LLC' WHEN 3 THEN NULL ELSE c_mktsegment END AS legal_form,
    concat('ops@c', cast(c_custkey AS string), '.example') AS contact_email,
    CASE c_custkey % 4 WHEN 0 THEN NULL
        ELSE concat('+00-', cast(c_custkey AS string)) END AS contact_phone"""

_CLIENT_ID = "concat('C', cast(c_custkey AS string)) AS client_id"

FIXTURES = {
    "registry": f"SELECT {_REGISTRY_FIELDS} FROM {_CUSTOMERS}",
    "client": f"SELECT {_CLIENT_ID}, {_CLIENT_FIELDS} FROM {_CUSTOMERS}",
    # Many clients per identifier.
    "client_large": f"""SELECT concat('O', cast(o_orderkey AS string)) AS client_id, {_CLIENT_FIELDS}
        FROM {{orders}} JOIN {_CUSTOMERS.replace(' JOIN', ' ON o_custkey = c_custkey JOIN', 1)}""",
    # A later batch: several rows per client, and clients without orders are absent.
    "client_update": f"""SELECT {_CLIENT_ID}, o_orderkey AS position,
            CASE o_orderstatus WHEN 'F' THEN upper({_FULL}) WHEN 'O' THEN c_name
                ELSE concat('Renamed ', cast(c_custkey AS string)) END AS entity_name,
            concat('LEI', {_KEY}) AS entity_lei, n_name AS country,
            CASE o_orderstatus WHEN 'P' THEN 'LLC' ELSE c_mktsegment END AS legal_form,
            cast(NULL AS string) AS contact_email, cast(NULL AS string) AS contact_phone
        FROM {{orders}} JOIN {_CUSTOMERS.replace(' JOIN', ' ON o_custkey = c_custkey JOIN', 1)}""",
    # An upload before ingest: absent values as empty text and a column nobody reads.
    "upload_raw": f"""SELECT client_id, entity_name, coalesce(entity_lei, '') AS entity_lei,
            coalesce(country, '') AS country, coalesce(legal_form, '') AS legal_form,
            contact_email, coalesce(contact_phone, '') AS contact_phone, 'CRM' AS client_system
        FROM (SELECT {_CLIENT_ID}, {_CLIENT_FIELDS} FROM {_CUSTOMERS}) AS c""",
    "registry_versions": f"""SELECT {_REGISTRY_FIELDS}, 1 AS ordinal FROM {_CUSTOMERS}
        UNION ALL
        SELECT lei, name, country, legal_form,
            CASE WHEN legal_form = 'MACHINERY' THEN 'RETIRED' ELSE status END AS status,
            registration_authority, 2 AS ordinal
        FROM (SELECT {_REGISTRY_FIELDS} FROM {_CUSTOMERS}) AS r""",
    # Few distinct times, so that the order needs its tie-break.
    "staged": f"""SELECT {_CLIENT_ID}, {_CLIENT_FIELDS},
            cast(concat('2024-01-0', cast(1 + c_custkey % 7 AS string), ' 00:00:00') AS timestamp)
                AS ingested_at
        FROM {_CUSTOMERS}""",
    # Part names as entity names: cut short, upper case, words swapped, with a suffix.
    "names_client": """SELECT p_partkey AS id,
            CASE p_partkey % 5 WHEN 0 THEN substring(p_name, 1, length(p_name) - 1)
                WHEN 1 THEN upper(p_name) WHEN 2 THEN concat(p_type, ', ', p_name)
                WHEN 3 THEN concat(p_name, ' ltd') ELSE concat(p_name, '-', p_brand) END AS name
        FROM {part}""",
    "names_registry": "SELECT p_partkey AS id, concat(p_name, ' ', p_type) AS name FROM {part}",
    "parents": """SELECT concat('C', cast(c_custkey AS string)) AS entity,
            CASE WHEN c_custkey = 1 THEN 'C2' WHEN c_custkey = 2 THEN 'C1' WHEN c_custkey = 0 THEN NULL
                ELSE concat('C', cast(cast(floor(c_custkey / 3) AS bigint) AS string)) END AS parent
        FROM {customer}""",
    # What a re-ranker may answer: usable, "none", out of range and unusable in several ways.
    "rerank_answers": """SELECT concat('C', cast(vec_id AS string)) AS client_id,
            CASE vec_id % 11
                WHEN 0 THEN '{{"match": 1, "confidence": 0.93, "reason": "same name"}}'
                WHEN 1 THEN '{{"match": null, "confidence": 0.2}}'
                WHEN 2 THEN '{{"match": 0, "confidence": 0.9}}'
                WHEN 3 THEN '{{"match": 9, "confidence": 0.9}}'
                WHEN 4 THEN 'The second one.'
                WHEN 5 THEN ' {{"match": 2}} '
                WHEN 6 THEN '{{"match": 3, "confidence": "0.75"}}'
                WHEN 7 THEN '{{"match": "2", "confidence": 0.9}}'
                WHEN 8 THEN '{{"match": 4, "confidence": null}}'
                WHEN 9 THEN '[1, 0.9]'
                ELSE '{{"match": 5, "confidence": 1}}' END AS answer
        FROM {embeddings}""",
}


def fixture_sql(name: str) -> str:
    """The fixture's query over the bare table names."""
    return FIXTURES[name].format(**{table: table for table in _TABLES})


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    tables = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)
