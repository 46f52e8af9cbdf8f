"""Landing files (JSON documents in a CSV column) and plain user CSV files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmart import fixed_values as fv
from segmart.functions.documents import parse_documents

QUOTING = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# A file with line breaks inside values is read by one task, so that files are kept small.
ROWS_PER_FILE = 100_000


def read_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = True, schema: str | None = None
) -> DataFrame:
    """CSV files with a header, doubled quotes and, by default, line breaks inside quotes.

    Column names come from the header and every column is text, so no pass over the
    data is spent on types. With `multi_line` a file is read by one task and
    parallelism comes from the number of files. Files without line breaks inside
    values, such as those of `write_landing`, may be read with `multi_line=False`,
    which lets Spark split them.
    """
    reader = spark.read.options(**QUOTING).option("mode", "PERMISSIVE")
    reader = reader.option("multiLine", multi_line)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_landing(
    spark: SparkSession, path: str | list[str], column: str = fv.LANDING_COLUMN, multi_line: bool = True
) -> DataFrame:
    """Landing rows; fails at once when the document column is not in the header."""
    rows = read_csv(spark, path, multi_line)
    if column not in rows.columns:
        raise ValueError(f"no column {column} in {path}: found {rows.columns}")
    return rows


def to_landing(documents: DataFrame, column: str = fv.LANDING_COLUMN) -> DataFrame:
    """Rename the document column to the landing column."""
    return documents.select(F.col(documents.columns[0]).alias(column))


def write_landing(
    documents: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Landing CSV files of a bounded row count, so that reads stay parallel."""
    writer = to_landing(documents).write.options(**QUOTING, **KEEP_SPACES)
    writer.option("maxRecordsPerFile", rows_per_file).mode(mode).csv(path)


def read_users_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """User CSV rows: the nine raw columns in their usual order, then all further ones."""
    rows = read_csv(spark, path, multi_line)
    return rows.select(*fv.RAW_USER_FIELDS, *[c for c in rows.columns if c not in fv.RAW_USER_FIELDS])


def write_users_csv(
    users: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """User CSV with header, UTF-8, inner and outer spaces kept."""
    writer = users.select(*fv.RAW_USER_FIELDS).write.options(**QUOTING, **KEEP_SPACES)
    writer.option("maxRecordsPerFile", rows_per_file).mode(mode).csv(path)


# The table of ids lies in the landing folder, under a name that readers of the folder pass over.
IDS = "_ids"
ID_ROWS = "id string, file string"


def landed_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, file): the ids that landing files are known to hold; a file without ids has a null one."""
    try:
        return spark.read.schema(ID_ROWS).parquet(f"{path}/{IDS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ID_ROWS)


def index_landing(
    spark: SparkSession, path: str, column: str = fv.LANDING_COLUMN, multi_line: bool = True
) -> DataFrame:
    """Add the ids of files that the table of ids does not know yet, and return those files' names.

    Files are parsed once, when they are new, whoever wrote them. Each has a row at least, so
    one without a single id is known too. The driver holds file names, as any reader's does.
    """
    known = {row["file"] for row in landed_ids(spark, path).select("file").distinct().collect()}
    new = [name for name in read_landing(spark, path, column, multi_line).inputFiles() if base_name(name) not in known]
    if new:
        rows = read_landing(spark, new, column, multi_line).withColumn("file", F.col("_metadata.file_name"))
        found = parse_documents(rows, column, ["_id"], keep=["file"]).where("_id IS NOT NULL")
        marks = spark.createDataFrame([(None, base_name(name)) for name in new], ID_ROWS)
        ids = found.select(F.col("_id").alias("id"), "file").unionByName(marks)
        ids.sortWithinPartitions("id").write.mode("append").parquet(f"{path}/{IDS}")
    return spark.createDataFrame([(base_name(name),) for name in new], "file string")


def base_name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1])
