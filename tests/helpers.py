"""Small tables for tests."""

from pyspark.sql import functions as F

from concordat import schemas as S

ACTIVE = ("529900T8BM49AURSDO55", "Apple Inc.", "US", "Corporation", "ACTIVE", "RA000602")
LAPSED = ("DEADBEEF1234567890AB", "Defunct Corp Ltd", "GB", "Limited", "INACTIVE", None)


def client(client_id, name, lei=None, country=None, form=None, email=None, phone=None):
    return (client_id, name, lei, country, form, email, phone)


MATCHING = client("C001", "Apple Inc.", ACTIVE[0], "US", "Corporation")
MISMATCHED = client("C002", "Apple Incorporated", ACTIVE[0], "UK", "Corporation")
NO_LEI = client("C003", "Unknown Corp")


def clients(spark, *rows):
    return spark.createDataFrame(list(rows), S.CLIENT)


def registry(spark, *rows):
    return spark.createDataFrame(list(rows), S.REGISTRY)


def by_id(df, key="client_id"):
    return {row[key]: row for row in df.collect()}


def at(text="2024-01-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def plan(df):
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
