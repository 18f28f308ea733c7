"""Daily raw CSV files under `event_date=YYYY-MM-DD/` folders."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.schemas import RAW

# Quotes are doubled inside quoted cells; cells are read as text and coerced later.
LINEAGE = ["source_file", "source_path"]
CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}
LINE = "_line"  # the whole line, where it does not have as many cells as the header
QUOTED = r'"([^"]|"")*"'


def file_key(path: Column) -> Column:
    """Day folder and name: what tells one delivered file from another."""
    return F.array_join(F.slice(F.split(path, "/"), -2, 2), "/")


def list_files(
    spark: SparkSession, root: str, day: str | None = None, folders: str = "event_date"
) -> DataFrame:
    """`path`, `source_path`, `length` of the CSV files in one day's folder, or in all of them.

    Only the listing is read: the file contents are pruned away. No such folder means no files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.option("pathGlobFilter", "*.csv").load(
            f"{root.rstrip('/')}/{folders}={day or '*'}"
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, source_path string, length bigint")
    return files.select("path", file_key(F.col("path")).alias("source_path"), "length")


def not_loaded(files: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Files that are not among the loaded ones."""
    if loaded is None:
        return files
    return files.join(loaded.select("source_path").distinct(), "source_path", "left_anti")


def line_fault(cells: int) -> Column:
    """What is wrong with a line of other than `cells` cells: `open_quote`, a quoted cell that does not end
    on this line or began before it, or `extra_cells`. A line that merely ends early has missing values."""
    line = F.col(LINE)
    found = F.length(F.regexp_replace(F.regexp_replace(line, QUOTED, ""), "[^,]", "")) + 1
    return F.when(F.regexp_count(line, F.lit('"')) % 2 == 1, "open_quote").when(found > cells, "extra_cells")


def read_raw(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """All cells as text, plus `source_file`, `source_path` and `line_fault` (null for a sound line).

    Files are split at line ends, so that a large one is read by many tasks; a line break in a quoted cell
    then leaves two faulty lines, neither of which is taken for an event. With `multi_line` such cells are
    read as they are, each file by one task.

    The file's own date counts, never its folder's. `columns` is the header of the files if it is
    not the full one; absent columns read as null. A header that does not match fails the read
    instead of shifting cells into other columns.
    """
    names = list(columns) if columns else RAW.fieldNames()
    schema = ", ".join(f"`{name}` string" for name in names)
    df = (
        spark.read.schema(f"{schema}, {LINE} string")
        .options(**CSV_OPTIONS, enforceSchema="false", recursiveFileLookup="true")
        .options(columnNameOfCorruptRecord=LINE, multiLine=str(multi_line).lower(), pathGlobFilter="*.csv")
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    return df.select(*raw_columns(names), *lineage_columns(), line_fault(len(names)).alias("line_fault"))


def lineage_columns() -> list[Column]:
    return [
        F.col("_metadata.file_name").alias("source_file"),
        file_key(F.col("_metadata.file_path")).alias("source_path"),
    ]


def raw_columns(have: Sequence[str]) -> list[Column]:
    """The raw columns in order, null text for the ones the input lacks."""
    return [
        (F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in RAW.fieldNames()
    ]


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`path`, `header`: the header line of each file.

    One text scan in Spark; only a file's first split can hold its header, and every header names
    the event id, so all other lines drop out before the grouping.
    """
    lines = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.csv").text(list(paths))
    line = F.regexp_replace("value", r'["\r]', "")
    headers = lines.where(
        (F.col("_metadata.file_block_start") == 0)
        & F.array_contains(F.split(line, ","), "event_id")
    )
    return headers.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(line).alias("header"))


def read_raw_any(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Like `read_raw` for files whose headers differ: each layout is read with its own columns."""
    layouts: dict[str, list[str]] = {}
    for row in file_headers(spark, paths).collect():  # one row per listed file
        layouts.setdefault(row["header"], []).append(row["path"])
    if not layouts:
        fields = [*RAW.fields, *[T.StructField(c, T.StringType()) for c in (*LINEAGE, "line_fault")]]
        return spark.createDataFrame([], T.StructType(fields))
    parts = [read_raw(spark, files, header.split(","), multi_line) for header, files in layouts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def is_header_mismatch(error: Exception) -> bool:
    return "CSV header" in str(error)
