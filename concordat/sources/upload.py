"""Client uploads: delimited files into client records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat import schemas as S
from concordat.functions.text import present

# Accepted file endings and columns an upload must have.
CSV_SUFFIX = ".csv"
WORKBOOK_SUFFIXES = (".xlsx", ".xls")
REQUIRED = ("client_id", "entity_name")
# End of fixed values.


def check_suffix(path: str) -> None:
    """Refuse files that are not uploads; workbooks must be saved as CSV first."""
    lowered = path.lower()
    if lowered.endswith(WORKBOOK_SUFFIXES):
        raise ValueError(f"workbooks are not read here, save as CSV first: {path}")
    if "." in lowered.rsplit("/", 1)[-1] and not lowered.endswith(CSV_SUFFIX):
        raise ValueError(f"only CSV files are supported: {path}")


def normalized_header(columns: list[str]) -> list[str]:
    """Lower-case column names, cut at both ends, blanks as underscores."""
    names = [column.strip().lower().replace(" ", "_") for column in columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"repeated columns in the upload: {', '.join(repeated)}")
    return names


def _check_files(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that holds files which would not be read."""
    files = spark.read.format("binaryFile").load(folder).select("path")
    other = files.where(~F.endswith(F.lower("path"), F.lit(CSV_SUFFIX))).first()
    if other is not None:
        raise ValueError(f"only CSV files are supported: {other.path}")


def read_upload(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Raw rows of one CSV file, or of a folder of CSV files with one header.

    Every column is text, so codes such as ``NA`` and identifiers with leading zeros stay as they
    are.  ``upload_order`` gives each row's place in the upload.  ``malformed`` holds the line of a
    row with more fields than the header has names, else null; rows with fewer fields lack the last
    ones.  A folder may hold CSV files only, and reading fails where a file's header differs from
    the others'.  Line breaks inside quotes need ``multiline``, which reads each file in one task.
    """
    check_suffix(path)
    options = {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}
    reader = spark.read.options(**options)
    try:
        if not path.lower().endswith(CSV_SUFFIX):
            _check_files(spark, path)
        columns = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"upload not found: {path}") from error
        raise
    names = normalized_header(columns)
    absent = [name for name in REQUIRED if name not in names]
    if absent:
        raise ValueError(f"upload lacks columns: {', '.join(absent)}")
    line = "__line"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, line]])
    raw = reader.options(columnNameOfCorruptRecord=line, columnPruning=False).schema(schema).csv(path)
    # The line is kept for rows with fewer fields too; only a field beyond the last makes it bad.
    wider = ", ".join(f"f{i} string" for i in range(len(columns) + 1))
    beyond = F.from_csv(F.col(line), wider, {"escape": '"'})[f"f{len(columns)}"]
    malformed = F.when(F.col(line).isNotNull() & beyond.isNotNull(), F.col(line))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    kept = [F.col(f"`{old}`").alias(new) for old, new in zip(columns, names)]
    return raw.select(*kept, place.alias("upload_order"), malformed.alias("malformed"))


def to_clients(raw: DataFrame, *keep: str) -> DataFrame:
    """Client records of raw rows: empty text becomes null, absent optional columns are null and
    columns outside the record are dropped, except those named in ``keep``."""

    def field(name: str):
        if name not in raw.columns:
            return F.lit(None).cast("string").alias(name)
        value = F.col(name).cast("string")
        return F.when(present(value), value).alias(name)

    return raw.select(*[field(name) for name in S.CLIENT_COLUMNS], *keep)


def _refused(clients: DataFrame) -> Column:
    found = F.col("client_id").isNull()
    return found | F.col("malformed").isNotNull() if "malformed" in clients.columns else found


def accepted(clients: DataFrame) -> DataFrame:
    """Rows that can be keyed and were read whole."""
    return clients.where(~_refused(clients))


def rejected(clients: DataFrame) -> DataFrame:
    """Rows without a client id, or with more fields than names, for the reject output."""
    return clients.where(_refused(clients))
