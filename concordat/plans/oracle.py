"""The same queries as DuckDB SQL, written independently of the Spark operators."""

from __future__ import annotations

from concordat.plans.fixtures import fixture_sql

ORACLE: dict[str, str] = {}

RUN_AT = "2024-02-01 00:00:00"
LATER = "2024-02-02 00:00:00"

_RESULT = """client_id, entity_lei, entity_name, verification_status, name_match, country_match,
    legal_form_match, lei_status, issues, gleif_name, gleif_country, quality_score"""


def _fixtures(*names: str) -> list[str]:
    return [f"{name} AS ({fixture_sql(name)})" for name in names]


def _select(ctes: list[str], body: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def _norm(column: str) -> str:
    return f"lower(trim(coalesce({column}, '')))"


def _given(column: str) -> str:
    return f"coalesce({column}, '') <> ''"


def _said(label: str, ours: str, theirs: str) -> str:
    return f"concat('{label} mismatch: ''', coalesce({ours}, 'None'), ''' vs GLEIF ''', coalesce({theirs}, 'None'), '''')"


def _validated(clients: str, registry: str, out: str, extra: str = "") -> list[str]:
    """CTEs that end in ``out``: one result row per row of ``clients``."""
    name = f"""entity_name IS NOT NULL AND {_given('r_name')} AND (contains({_norm('r_name')},
        {_norm('entity_name')}) OR contains({_norm('entity_name')}, {_norm('r_name')}))"""

    def same(ours: str, theirs: str) -> str:
        return f"{_given(ours)} AND {_given(theirs)} AND {_norm(ours)} = {_norm(theirs)}"

    return [
        f"""{out}_m AS (SELECT c.client_id, c.entity_lei, c.entity_name, c.country, c.legal_form{extra},
            r.lei IS NOT NULL AS found, NOT {_given('c.entity_lei')} AS missing, r.name AS r_name,
            r.country AS r_country, r.legal_form AS r_form, r.status AS r_status
            FROM {clients} c LEFT JOIN {registry} r ON r.lei = nullif(c.entity_lei, ''))""",
        f"""{out}_f AS (SELECT *, {name} AS name_match, {same('country', 'r_country')} AS country_match,
            {same('legal_form', 'r_form')} AS legal_form_match,
            {_given('r_status')} AND upper(r_status) <> 'ACTIVE' AS inactive,
            {_given('r_status')} AND upper(r_status) = 'ACTIVE' AS active FROM {out}_m)""",
        f"""{out}_i AS (SELECT *, CASE WHEN missing THEN 'entity_lei is missing'
            WHEN NOT found THEN concat('LEI ', entity_lei, ' not found in GLEIF')
            ELSE concat_ws(chr(10),
                CASE WHEN NOT name_match THEN {_said('Name', 'entity_name', 'r_name')} END,
                CASE WHEN {_given('country')} AND NOT country_match
                    THEN {_said('Country', 'country', 'r_country')} END,
                CASE WHEN {_given('legal_form')} AND NOT legal_form_match
                    THEN {_said('Legal form', 'legal_form', 'r_form')} END) END AS issues
            FROM {out}_f)""",
        f"""{out} AS (SELECT client_id, entity_lei, entity_name,
            CASE WHEN missing OR NOT found THEN 'MISSING' WHEN inactive THEN 'INACTIVE'
                WHEN issues <> '' THEN 'MISMATCH' ELSE 'VERIFIED' END AS verification_status,
            name_match, country_match, legal_form_match, r_status AS lei_status, issues,
            r_name AS gleif_name, r_country AS gleif_country,
            cast(CASE WHEN missing THEN 0 WHEN NOT found THEN 1 ELSE 4 * name_match::INT
                + 2 * country_match::INT + 2 * legal_form_match::INT + 2 * active::INT END AS DOUBLE)
                / 10 AS quality_score{extra.replace('c.', '')} FROM {out}_i)""",
    ]


def _results(clients: str = "client") -> list[str]:
    return _fixtures("registry", clients) + _validated(clients, "registry", "results")


# --- uploads and the registry ------------------------------------------------------------------

ORACLE["ingest_normalized"] = _select(
    _fixtures("upload_raw"),
    """SELECT client_id, nullif(entity_name, '') AS entity_name, nullif(entity_lei, '') AS entity_lei,
    nullif(country, '') AS country, nullif(legal_form, '') AS legal_form,
    nullif(contact_email, '') AS contact_email, nullif(contact_phone, '') AS contact_phone
    FROM upload_raw""",
)
ORACLE["staged_latest"] = _select(
    _fixtures("staged"),
    """SELECT client_id, entity_name, entity_lei,
    strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
    FROM staged ORDER BY staged.ingested_at DESC, client_id LIMIT 50000""",
)
ORACLE["registry_flatten"] = _select(
    _fixtures("registry")
    + [
        """pages AS (SELECT list(struct_pack(id := lei, entity := struct_pack(name := name,
        country := country, form := legal_form), status := status,
        authority := registration_authority)) AS data FROM registry GROUP BY substring(lei, 1, 18))""",
        "items AS (SELECT unnest(data) AS item FROM pages)",
    ],
    """SELECT item.id AS lei, item.entity.name AS name, item.entity.country AS country,
    item.entity.form AS legal_form, item.status AS status, item.authority AS registration_authority
    FROM items""",
)
_REQUESTED = """SELECT DISTINCT entity_lei AS lei FROM {} WHERE coalesce(entity_lei, '') <> ''"""
ORACLE["requested_leis"] = _select(_fixtures("client_large"), _REQUESTED.format("client_large"))
ORACLE["lei_batches"] = _select(
    _fixtures("client") + [f"asked AS ({_REQUESTED.format('client')})"],
    """SELECT lei, cast(floor((row_number() OVER (ORDER BY lei) - 1) / 200) AS BIGINT) AS batch
    FROM asked""",
)
ORACLE["registry_lookup"] = _select(
    _fixtures("registry", "client_large"),
    "SELECT * FROM registry WHERE lei IN (SELECT entity_lei FROM client_large)",
)
ORACLE["lei_point_lookup"] = _select(
    _fixtures("registry"), "SELECT * FROM registry WHERE lei = 'LEI00000000000000042' LIMIT 1"
)
ORACLE["registry_last_wins"] = _select(
    _fixtures("registry_versions"),
    """SELECT lei, name, country, legal_form, status, registration_authority FROM registry_versions
    QUALIFY row_number() OVER (PARTITION BY lei ORDER BY ordinal DESC) = 1""",
)

# --- matching and checking ---------------------------------------------------------------------

ORACLE["client_registry_join"] = _select(
    _fixtures("registry", "client_large"),
    """SELECT client_id, entity_lei, lei, name, status
    FROM client_large LEFT JOIN registry ON lei = entity_lei""",
)
ORACLE["lei_not_found"] = _select(
    _fixtures("registry", "client"),
    """SELECT client_id, entity_lei FROM client
    WHERE coalesce(entity_lei, '') <> '' AND entity_lei NOT IN (SELECT lei FROM registry)""",
)
ORACLE["unmatched_clients"] = _select(
    _results(),
    """SELECT * FROM client WHERE client_id IN (SELECT client_id FROM results
    WHERE verification_status IN ('MISMATCH', 'MISSING', 'UNVERIFIED'))""",
)
ORACLE["missing_lei"] = _select(
    _fixtures("client_large"),
    "SELECT client_id, entity_lei FROM client_large WHERE entity_lei IS NULL OR entity_lei = ''",
)
ORACLE["normalized_names"] = _select(
    _fixtures("client_large"), f"SELECT client_id, {_norm('entity_name')} AS name FROM client_large"
)
ORACLE["name_match_flags"] = _select(_results(), "SELECT client_id, name_match FROM results")
ORACLE["field_match_flags"] = _select(
    _results(), "SELECT client_id, country_match, legal_form_match FROM results"
)
ORACLE["inactive_leis"] = _select(
    _fixtures("registry"), "SELECT lei, status FROM registry WHERE upper(status) <> 'ACTIVE'"
)
ORACLE["validation_issues"] = _select(_results(), "SELECT client_id, issues FROM results")
ORACLE["verification_status"] = _select(
    _results(), "SELECT client_id, verification_status FROM results"
)
ORACLE["quality_score"] = _select(_results(), "SELECT client_id, quality_score FROM results")
ORACLE["validate_entities"] = _select(_results("client_large"), f"SELECT {_RESULT} FROM results")
ORACLE["verify_lei_batch"] = _select(
    _fixtures("registry")
    + [
        """asked AS (SELECT concat('LEI', lpad(cast(o_custkey AS VARCHAR), 17, '0')) AS client_id,
        '' AS entity_name, concat('LEI', lpad(cast(o_custkey AS VARCHAR), 17, '0')) AS entity_lei,
        cast(NULL AS VARCHAR) AS country, cast(NULL AS VARCHAR) AS legal_form FROM orders)"""
    ]
    + _validated("asked", "registry", "results"),
    f"SELECT {_RESULT} FROM results",
)
ORACLE["status_score_counts"] = _select(
    _results(),
    """SELECT verification_status, quality_score, count(*) AS records FROM results
    GROUP BY verification_status, quality_score""",
)

# --- reports -----------------------------------------------------------------------------------

_COUNTS = """count(*) AS total_records,
    count(*) FILTER (verification_status = 'VERIFIED') AS verified,
    count(*) FILTER (verification_status = 'MISMATCH') AS mismatched,
    count(*) FILTER (verification_status = 'INACTIVE') AS inactive,
    count(*) FILTER (verification_status IN ('MISSING', 'UNVERIFIED')) AS missing"""
_SCORE = "round(cast(sum(cast(round(quality_score * 10) AS BIGINT)) AS DOUBLE) / (count(*) * 10), 4)"


def _filled(column: str) -> str:
    return f"round(cast(count(*) FILTER (coalesce({column}, '') <> '') AS DOUBLE) / count(*), 3)"


def _any(column: str) -> str:
    return f"round(1.0::DOUBLE - cast(count(*) - count({column}) AS DOUBLE) / count(*), 3)"


def _report(source: str) -> str:
    return f"""totals AS (SELECT {_COUNTS}, {_SCORE} AS overall_quality_score,
        {_filled('entity_lei')} AS lei_completeness, {_filled('gleif_name')} AS gleif_name_completeness,
        {_filled('gleif_country')} AS gleif_country_completeness FROM {source}),
    told AS (SELECT *, cast(floor((round(overall_quality_score * 10000) + 5) / 10) AS BIGINT) AS pm
        FROM totals),
    report AS (SELECT * EXCLUDE (pm), concat_ws(chr(10),
        CASE WHEN overall_quality_score < 0.7::DOUBLE THEN concat('Overall quality below threshold: ',
            pm // 10, '.', pm % 10, '%') END,
        CASE WHEN missing / total_records > 0.1::DOUBLE THEN concat('High missing rate: ', missing, '/',
            total_records, ' records have no LEI') END,
        CASE WHEN inactive / total_records > 0.05::DOUBLE THEN concat('Inactive LEIs detected: ', inactive,
            ' records') END) AS issues_summary FROM told)"""


ORACLE["status_counts"] = _select(_results("client_large"), f"SELECT {_COUNTS} FROM results")
ORACLE["overall_score"] = _select(
    _results("client_large"), f"SELECT {_SCORE} AS overall_score FROM results"
)
ORACLE["field_completeness"] = _select(
    _results("client_large"),
    f"""SELECT {_filled('entity_lei')} AS entity_lei, {_filled('gleif_name')} AS gleif_name,
    {_filled('gleif_country')} AS gleif_country FROM results""",
)
ORACLE["quality_alerts"] = _select(
    _results("client_large") + [_report("results")],
    "SELECT unnest(string_split(issues_summary, chr(10))) AS alert FROM report",
)
ORACLE["quality_report"] = _select(
    _results("client_large") + [_report("results")], "SELECT * FROM report"
)
ORACLE["store_quality_report"] = _select(
    _results(),
    f"""SELECT {_COUNTS}, round(avg(quality_score), 4) AS overall_quality_score,
    {_any('entity_lei')} AS lei_completeness, {_any('gleif_name')} AS name_completeness,
    {_any('gleif_country')} AS country_completeness, '' AS issues_summary FROM results""",
)
ORACLE["store_completeness"] = _select(
    _results(),
    f"""SELECT {_any('entity_lei')} AS entity_lei, {_any('gleif_name')} AS gleif_name,
    {_any('gleif_country')} AS gleif_country FROM results""",
)
ORACLE["run_metrics"] = _select(
    _results("client_large"),
    "SELECT verification_status, count(*) AS records FROM results GROUP BY verification_status",
)
ORACLE["quality_history"] = _select(
    _results(),
    f"SELECT 'run-1' AS run_id, '{RUN_AT}' AS run_at, {_COUNTS}, {_SCORE} AS overall_score FROM results",
)
ORACLE["top_entities"] = _select(
    _results(),
    """SELECT client_id, verification_status, quality_score FROM results
    ORDER BY quality_score DESC, client_id LIMIT 1000""",
)


def _merged(batch: str, position: str) -> str:
    return f"""last_rows AS (SELECT * FROM {batch}
        QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY {position} DESC) = 1),
    merged AS (SELECT {_RESULT}, '{LATER}' AS processed_at FROM last_rows
        UNION ALL
        SELECT {_RESULT}, '{RUN_AT}' AS processed_at FROM results
        WHERE client_id NOT IN (SELECT client_id FROM last_rows))"""


_UPDATE = (
    _fixtures("client_update")
    + _validated("client_update", "registry", "updated", ", c.position")
    + [_merged("updated", "position")]
)
ORACLE["upsert_merge"] = _select(_results() + _UPDATE, "SELECT * FROM merged")
ORACLE["issues_json"] = _select(
    _results(),
    """SELECT client_id, cast(CASE WHEN issues = '' THEN '[]'
    ELSE to_json(string_split(issues, chr(10))) END AS VARCHAR) AS issues FROM results""",
)

# --- resolution --------------------------------------------------------------------------------


def _sort_key(column: str) -> str:
    cleaned = (
        rf"regexp_replace(regexp_replace(lower(coalesce({column}, '')), '[\x{{80}}-\x{{FF}}]', '', 'g'),"
        r" '[^\p{L}\p{N}_]+', ' ', 'g')"
    )
    return f"array_to_string(list_sort(string_split(trim({cleaned}), ' ')), ' ')"


# Names a and b with the letter masks of a and the letter codes of b: the bit-vector recurrence
# for the longest common subsequence.
_MASKS = """list_transform(range(128), lambda c: cast(coalesce(list_sum(list_transform(
    range(length(key)), lambda p: CASE WHEN ascii(key[p + 1]) = c THEN 1::BIGINT << p
    ELSE 0::BIGINT END)), 0) AS BIGINT)) AS masks, (1::BIGINT << length(key)) - 1 AS ones"""
_CODES = "list_transform(string_split(key, ''), lambda ch: ascii(ch) + 1) AS codes"
_COMMON = """(length(a.key) - bit_count(list_reduce(list_prepend(a.ones, list_transform(b.codes,
    lambda c: a.masks[c])), lambda v, k: ((v + (v & k)) | (v & ~k)) & a.ones)))"""


def _scored(on: str) -> str:
    return f"""SELECT a.*, b.* EXCLUDE (key, codes), CASE WHEN a.key = b.key THEN 100
        WHEN a.key = '' OR b.key = '' THEN 0
        ELSE cast(round_even(100 * (1 - (length(a.key) + length(b.key) - 2 * {_COMMON})::DOUBLE
            / (length(a.key) + length(b.key))), 0) AS INT) END AS score
        FROM {on}"""


def _best(queries: str, items: str, out: str) -> list[str]:
    """CTEs that end in ``out (key, match_id, score)``: the best item per distinct query key."""
    return [
        f"{out}_a AS (SELECT key, {_MASKS} FROM (SELECT DISTINCT key FROM {queries}))",
        f"""{out}_b AS (SELECT key, match_id, {_CODES}
            FROM (SELECT key, min(id) AS match_id FROM {items} GROUP BY key))""",
        f"{out}_s AS ({_scored(f'{out}_a a, {out}_b b')})",
        f"""{out} AS (SELECT key, match_id, score FROM {out}_s WHERE score > 0
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, match_id) = 1)""",
    ]


ORACLE["token_sort_ratio"] = _select(
    _fixtures("registry", "client_large")
    + [
        f"""pairs AS (SELECT client_id, {_sort_key('entity_name')} AS ka, {_sort_key('name')} AS kb
            FROM client_large LEFT JOIN registry ON lei = entity_lei)""",
        f"pa AS (SELECT key, {_MASKS} FROM (SELECT DISTINCT ka AS key FROM pairs))",
        f"""pb AS (SELECT ka, key, {_CODES} FROM (SELECT DISTINCT ka, kb AS key FROM pairs))""",
        "scored AS (SELECT key AS ka, kb, score FROM ("
        + _scored("pa a JOIN (SELECT *, key AS kb FROM pb) b ON a.key = b.ka")
        + "))",
    ],
    """SELECT client_id, score FROM pairs JOIN scored USING (ka, kb)""",
)
ORACLE["fuzzy_best_match"] = _select(
    _fixtures("names_client", "names_registry")
    + [
        f"asked AS (SELECT id, {_sort_key('name')} AS key FROM names_client)",
        f"offered AS (SELECT id, {_sort_key('name')} AS key FROM names_registry)",
    ]
    + _best("asked", "offered", "best"),
    "SELECT id, match_id, score FROM asked LEFT JOIN best USING (key)",
)

_INNER = "round(list_inner_product(q.vector, i.vector), 12)"


def _top(queries: str, items: str, out: str) -> str:
    return f"""{out} AS (SELECT q.id AS query_id,
        cast(row_number() OVER (PARTITION BY q.id ORDER BY {_INNER} DESC, i.id) AS INT) AS rank,
        i.id AS id, round({_INNER}, 6) AS score FROM {queries} q, {items} i QUALIFY rank <= 5)"""


ORACLE["vector_topk"] = _select(
    [
        "vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vector FROM embeddings)",
        _top("vectors", "vectors", "best"),
    ],
    "SELECT query_id, rank, id, score FROM best",
)
ORACLE["vector_normalize"] = _select(
    [
        "wide AS (SELECT vec_id, embedding::DOUBLE[] AS w FROM embeddings)",
        """scaled AS (SELECT vec_id, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w)))
            AS v FROM wide)""",
    ],
    """SELECT vec_id, cast(len(v) AS INT) AS dimensions, round(list_inner_product(v, v), 6) AS squared_length,
    round(list_inner_product(v, range(1, len(v) + 1)::DOUBLE[]), 6) AS weighted_sum FROM scaled""",
)

_CANDIDATES = [
    """client_vectors AS (SELECT concat('C', vec_id) AS id, embedding::DOUBLE[] AS vector
        FROM embeddings)""",
    """registry_vectors AS (SELECT concat(CASE WHEN vec_id % 20 = 7 THEN 'OLD' ELSE 'LEI' END,
        lpad(cast(vec_id AS VARCHAR), 17, '0')) AS id, embedding::DOUBLE[] AS vector
        FROM embeddings WHERE vec_id IN (SELECT c_custkey FROM customer))""",
    _top("client_vectors", "registry_vectors", "top"),
    """listed AS (SELECT query_id AS client_id, score, registry.*,
        row_number() OVER (PARTITION BY query_id ORDER BY top.rank) AS rank
        FROM top JOIN registry ON top.id = registry.lei)""",
]
ORACLE["rerank_requests"] = _select(
    _fixtures("registry", "client") + _CANDIDATES,
    """SELECT listed.client_id, CASE WHEN count(client.client_id) > 0 THEN
        concat('"', coalesce(any_value(entity_name), 'None'), '" (country: ',
        coalesce(nullif(any_value(client.country), ''), 'unknown'), ', legal form: ',
        coalesce(nullif(any_value(client.legal_form), ''), 'unknown'), ')') END AS client_line,
        cast(count(*) AS INT) AS n, string_agg(concat(rank, '. ',
        coalesce(name, 'None'), ' | ', coalesce(listed.country, 'None'), ' | ',
        coalesce(listed.legal_form, 'None'), ' | ', coalesce(lei, 'None')), chr(10) ORDER BY rank)
        AS candidate_list FROM listed LEFT JOIN client USING (client_id) GROUP BY listed.client_id""",
)
# Which answers are usable: an object whose match is a whole number or null and whose confidence,
# if there is one, reads as a number.
_ANSWERED = [
    """parsed AS (SELECT client_id, CASE WHEN json_valid(answer) THEN answer::JSON END AS j
        FROM rerank_answers)""",
    """told AS (SELECT client_id,
        coalesce(json_type(j) = 'OBJECT'
            AND coalesce(json_type(j, '$.match'), 'NULL') IN ('NULL', 'UBIGINT', 'BIGINT')
            AND (json_type(j, '$.confidence') IS NULL OR (json_type(j, '$.confidence') <> 'NULL'
                AND try_cast(j ->> '$.confidence' AS DOUBLE) IS NOT NULL)), false) AS usable,
        try_cast(j ->> '$.match' AS BIGINT) AS choice,
        coalesce(try_cast(j ->> '$.confidence' AS DOUBLE), 0) AS confidence FROM parsed)""",
    """sizes AS (SELECT client_id, count(*) AS n FROM listed GROUP BY client_id)""",
    """decided AS (SELECT client_id, usable, coalesce(choice BETWEEN 1 AND n, false) AS chosen,
        choice, confidence FROM sizes JOIN told USING (client_id))""",
    """by_vector AS (SELECT d.client_id, l.lei, l.name, l.legal_form,
        CASE WHEN usable AND NOT chosen THEN 0 WHEN usable THEN confidence ELSE score END AS raw_score,
        CASE WHEN usable THEN 'rag_llm' ELSE 'embedding' END AS match_method
        FROM decided d LEFT JOIN listed l ON l.client_id = d.client_id
            AND l.rank = CASE WHEN NOT usable THEN 1 WHEN chosen THEN choice END)""",
]
ORACLE["rerank_apply"] = _select(
    _fixtures("registry", "rerank_answers") + _CANDIDATES + _ANSWERED,
    "SELECT client_id, lei, round(raw_score, 4) AS match_score, match_method FROM by_vector",
)
ORACLE["resolution_fallback"] = _select(
    _fixtures("registry", "rerank_answers", "client") + _CANDIDATES + _ANSWERED,
    """SELECT client_id, lei, name, round(coalesce(raw_score, 0), 4) AS match_score,
    coalesce(match_method, 'embedding_no_candidates') AS match_method
    FROM client LEFT JOIN by_vector USING (client_id)""",
)


def _issues(score: str) -> str:
    return f"""concat_ws(chr(10), CASE WHEN {score} < 0.8::DOUBLE
        THEN printf('Low match confidence: %.2f', {score}) END,
        CASE WHEN lei IS NULL THEN 'No match found' END) AS issues"""


ORACLE["resolution_issues"] = _select(
    _fixtures("registry", "client") + _CANDIDATES,
    f"""SELECT client_id, round(coalesce(score, 0), 4) AS match_score, {_issues('coalesce(score, 0)')}
    FROM client LEFT JOIN (SELECT client_id, score, lei FROM listed WHERE rank = 1)
    USING (client_id)""",
)
_UNMATCHED = """open AS (SELECT * FROM client WHERE client_id IN (SELECT client_id FROM results
    WHERE verification_status IN ('MISMATCH', 'MISSING', 'UNVERIFIED')))"""


def _by_name(clients: str) -> list[str]:
    return [
        f"asked AS (SELECT client_id, {_sort_key('entity_name')} AS key FROM {clients})",
        f"offered AS (SELECT lei AS id, {_sort_key('name')} AS key FROM registry)",
        *_best("asked", "offered", "best"),
        """by_name AS (SELECT client_id, lei, name, coalesce(score / 100.0::DOUBLE, 0) AS raw_score,
            'fuzzy' AS match_method FROM asked LEFT JOIN best USING (key)
            LEFT JOIN registry ON lei = match_id)""",
    ]


_RESOLVED = f"""SELECT client_id, lei, name, round(raw_score, 4) AS match_score, match_method,
    {_issues('raw_score')}"""
ORACLE["resolve_by_name"] = _select(
    _results() + [_UNMATCHED] + _by_name("open"), f"{_RESOLVED} FROM by_name"
)
ORACLE["resolve_by_close_name"] = _select(
    _results() + [_UNMATCHED] + _by_name("open"),
    f"""{_RESOLVED} FROM (SELECT client_id, CASE WHEN raw_score >= 0.73 THEN lei END AS lei,
        CASE WHEN raw_score >= 0.73 THEN name END AS name,
        CASE WHEN raw_score >= 0.73 THEN raw_score ELSE 0 END::DOUBLE AS raw_score, match_method FROM by_name)""",
)
ORACLE["resolve_entities"] = _select(
    _results()
    + _fixtures("rerank_answers")
    + [_UNMATCHED]
    + _CANDIDATES
    + _ANSWERED
    + ["rest AS (SELECT * FROM open WHERE client_id NOT IN (SELECT client_id FROM by_vector))"]
    + _by_name("rest"),
    f"""{_RESOLVED} FROM (SELECT client_id, lei, name, raw_score, match_method FROM by_vector
        WHERE client_id IN (SELECT client_id FROM open) UNION ALL SELECT * FROM by_name)""",
)
ORACLE["resolution_rate"] = _select(
    _results() + [_UNMATCHED] + _by_name("open"),
    """SELECT count(*) AS total, count(*) FILTER (raw_score >= 0.8::DOUBLE) AS resolved,
    round(cast(count(*) FILTER (raw_score >= 0.8::DOUBLE) AS DOUBLE) / count(*), 6) AS rate FROM by_name""",
)
ORACLE["entity_context"] = _select(
    _fixtures("registry")
    + [
        """numbered AS (SELECT *, row_number() OVER (ORDER BY lei) - 1 AS ordinal FROM registry)""",
    ],
    """SELECT cast(ordinal // 200 AS BIGINT) AS chunk, count(*) AS n_lines,
    string_agg(concat(lei, ': ', coalesce(name, 'None'), ', ', coalesce(country, 'None'), ', ',
        coalesce(status, 'None')), chr(10) ORDER BY lei) AS context
    FROM numbered GROUP BY chunk""",
)

# --- views for downstream use --------------------------------------------------------------------

ORACLE["newly_inactive"] = _select(
    _fixtures("registry_versions"),
    """SELECT lei, status FROM registry_versions WHERE ordinal = 2 AND upper(status) <> 'ACTIVE'
    AND lei NOT IN (SELECT lei FROM registry_versions WHERE ordinal = 1 AND upper(status) <> 'ACTIVE')""",
)
ORACLE["ultimate_parents"] = f"""WITH RECURSIVE parents AS ({fixture_sql('parents')}),
    tops AS (SELECT entity, entity AS root FROM parents WHERE parent IS NULL
        UNION ALL SELECT p.entity, t.root FROM parents p JOIN tops t ON p.parent = t.entity)
    SELECT entity, root FROM parents LEFT JOIN tops USING (entity)"""
ORACLE["status_mart"] = _select(
    _results(),
    f"""SELECT gleif_country, verification_status, count(*) AS records, {_SCORE} AS mean_score
    FROM results GROUP BY gleif_country, verification_status""",
)

ORACLE["merged_store_report"] = ORACLE["store_quality_report"]
ORACLE["merged_status_mart"] = ORACLE["status_mart"]

# --- whole jobs --------------------------------------------------------------------------------

# Empty fields of an upload are absent, names included.
_UPLOADED = """uploaded AS (SELECT client_id, nullif(entity_name, '') AS entity_name,
    nullif(entity_lei, '') AS entity_lei, nullif(country, '') AS country,
    nullif(legal_form, '') AS legal_form FROM upload_raw)"""
ORACLE["upload_run"] = _select(
    _fixtures("upload_raw", "registry_versions")
    + [_UPLOADED, "registry AS (SELECT * FROM registry_versions WHERE ordinal = 2)"]
    + _validated("uploaded", "registry", "results")
    + [_report("results")],
    "SELECT * FROM report",
)
ORACLE["daily_run"] = _select(
    _fixtures("upload_raw", "registry")
    + [_UPLOADED]
    + _validated("uploaded", "registry", "results")
    + _UPDATE,
    """SELECT * REPLACE (cast(CASE WHEN issues = '' THEN '[]'
    ELSE to_json(string_split(issues, chr(10))) END AS VARCHAR) AS issues) FROM merged""",
)
ORACLE["stream_run"] = _select(
    _fixtures("registry", "client_update")
    + _validated("client_update", "registry", "results", ", c.position"),
    f"""SELECT {_RESULT} FROM results
    QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY position DESC) = 1""",
)
ORACLE["stream_out_of_order"] = ORACLE["stream_run"]
_NUMBERED = "numbered AS (SELECT *, cast(substring(client_id, 2) AS BIGINT) AS n FROM client)"
ORACLE["upload_rejects"] = _select(
    _fixtures("client") + [_NUMBERED],
    """SELECT CASE WHEN n % 7 = 0 THEN client_id END AS client_id,
    nullif(entity_name, '') AS entity_name,
    CASE WHEN n % 7 = 0 THEN concat(client_id, ',"', coalesce(entity_name, ''), '",',
        coalesce(entity_lei, ''), ',surplus') END AS malformed
    FROM numbered WHERE n % 7 = 0 OR n % 11 = 0""",
)
ORACLE["resolution_without_index"] = _select(
    _fixtures("client"),
    """SELECT client_id, NULL::VARCHAR AS lei, NULL::VARCHAR AS name, 0::DOUBLE AS match_score,
    'no_index' AS match_method,
    concat('Low match confidence: 0.00', chr(10), 'No match found') AS issues FROM client""",
)
ORACLE["listed_by_status"] = _select(
    _results(),
    """SELECT client_id, verification_status, quality_score FROM results
    WHERE verification_status = 'MISMATCH' ORDER BY quality_score DESC, client_id LIMIT 100""",
)
ORACLE["staged_newest"] = _select(
    _fixtures("staged"),
    """SELECT client_id, entity_name, entity_lei,
    strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
    FROM staged ORDER BY staged.ingested_at DESC, client_id LIMIT 500""",
)

# The hash of a group of three letters, which the library joins by blanks to five bytes: the public
# 32-bit Murmur3 with seed 42, one block of four bytes and one byte more.
_NAME_PRODUCTS = """names AS (SELECT 'c' AS side, client_id AS id, entity_name AS name FROM client
        UNION ALL SELECT 'r', lei, name FROM registry),
    padded AS (SELECT side, id, '  ' || lower(trim(coalesce(name, ''), ' ')) || '  ' AS p FROM names),
    grams AS (SELECT side, id, ascii(p[i]) AS a, ascii(p[i + 1]) AS b, ascii(p[i + 2]) AS c
        FROM (SELECT side, id, p, unnest(range(1, length(p) - 1)) AS i FROM padded)),
    m1 AS (SELECT side, id, c AS t, ((a + 8192 + b * 65536 + 536870912)::UBIGINT * 3432918353::UBIGINT) % 4294967296 AS k FROM grams),
    m2 AS (SELECT side, id, t, (((k << 15) | (k >> 17)) & 4294967295) * 461845907::UBIGINT % 4294967296 AS k FROM m1),
    m3 AS (SELECT side, id, t, xor(42::UBIGINT, k) AS h FROM m2),
    m4 AS (SELECT side, id, ((((h << 13) | (h >> 19)) & 4294967295) * 5 + 3864292196::UBIGINT) % 4294967296 AS h,
        (t::UBIGINT * 3432918353::UBIGINT) % 4294967296 AS k FROM m3),
    m5 AS (SELECT side, id, h, (((k << 15) | (k >> 17)) & 4294967295) * 461845907::UBIGINT % 4294967296 AS k FROM m4),
    m6 AS (SELECT side, id, xor(xor(h, k), 5::UBIGINT) AS h FROM m5),
    m7 AS (SELECT side, id, xor(h, h >> 16) * 2246822507::UBIGINT % 4294967296 AS h FROM m6),
    m8 AS (SELECT side, id, xor(h, h >> 13) * 3266489909::UBIGINT % 4294967296 AS h FROM m7),
    m9 AS (SELECT side, id, xor(h, h >> 16) % 256 AS slot FROM m8),
    counts AS (SELECT side, id, slot, count(*)::DOUBLE AS n FROM m9 GROUP BY ALL),
    scaled AS (SELECT side, id, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY side, id)))::FLOAT::DOUBLE AS v FROM counts),
    shared AS (SELECT q.id AS query_id, i.id AS id, sum(q.v * i.v) AS s FROM scaled q JOIN scaled i USING (slot)
        WHERE q.side = 'c' AND i.side = 'r' GROUP BY ALL),
    products AS (SELECT query_id, id, coalesce(s, 0) AS s
        FROM (SELECT client_id AS query_id FROM client) CROSS JOIN (SELECT lei AS id FROM registry)
        LEFT JOIN shared USING (query_id, id))"""
# The same with the weight of each slot worked out from the registry's names.
_WEIGHTED_PRODUCTS = _NAME_PRODUCTS.replace(
    "counts AS (SELECT side, id, slot, count(*)::DOUBLE AS n FROM m9 GROUP BY ALL)",
    """plain AS (SELECT side, id, slot, count(*)::DOUBLE AS n FROM m9 GROUP BY ALL),
    seen AS (SELECT slot, count(*) AS df FROM plain WHERE side = 'r' GROUP BY slot),
    weights AS (SELECT slot, ln(((SELECT count(*) FROM registry) + 1.0)::DOUBLE / (coalesce(df, 0) + 1)) AS w
        FROM (SELECT DISTINCT slot FROM plain) LEFT JOIN seen USING (slot)),
    counts AS (SELECT side, id, slot, n * w AS n FROM plain JOIN weights USING (slot))""",
).replace("(n / sqrt(sum(n * n) OVER (PARTITION BY side, id)))", "(CASE WHEN sum(n * n) OVER d > 0 THEN n / sqrt(sum(n * n) OVER d) ELSE 0 END)").replace(
    "AS v FROM counts)", "AS v FROM counts WINDOW d AS (PARTITION BY side, id))"
)
ORACLE["name_vector_topk"] = _select(
    [*_fixtures("client", "registry"), _NAME_PRODUCTS],
    """SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS INT) AS rank,
        id, round(s, 6) AS score FROM products QUALIFY rank <= 5""",
)
ORACLE["weighted_name_topk"] = _select(
    [*_fixtures("client", "registry"), _WEIGHTED_PRODUCTS],
    """SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS INT) AS rank,
        id, round(s, 6) AS score FROM products QUALIFY rank <= 5""",
)
