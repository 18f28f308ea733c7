"""Remove lines that repeat elsewhere, by overlapping windows of three lines.

Every three consecutive lines of a text are a window, known by its MD5. The first occurrence of a window,
by id and position, stays; all lines that a later occurrence covers go, and overlapping ones are merged.
A text of fewer lines has no window and stays as it is.

A window that a third of all documents share is counted before it is shuffled, and its occurrences meet
its first one in a join that adaptive execution can split. Texts move once, to meet their positions.

Lines end at \\n. Nulls: a null text stays null; a null id comes first in order. Rows that agree in id
and text are one document: what is removed from one is removed from all. Rows with one id and different
texts are told apart by the text's hash. A text can become empty; its row stays. Further columns are
carried along; `n_lines` and `n_removed` replace any of the same name. An empty table gives an empty
result.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import clash_free, documents

WINDOW = 3


@clash_free("__key", "__lines", "__doc", "__gone", "__at")
def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with `text` shortened, `n_lines` before and `n_removed`."""
    carried = docs.drop("n_lines", "n_removed")
    keyed = carried.withColumn("__key", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    last = F.size("__lines") - window
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("at"), F.unhex(F.md5(F.concat_ws("\n", F.slice("__lines", i + 1, window)))).alias("hash")
        ),
    )
    found = (
        keyed.select("doc_id", "__key", lines.alias("__lines"))
        .where(last >= 0)
        .select("doc_id", "__key", F.explode(windows).alias("w"))
        .select(F.struct("doc_id", F.col("__key").alias("key"), "w.at").alias("place"), "w.hash")
    )
    first = (
        found.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first <> last").select("hash", "first")
    )
    later = found.join(first, "hash").where("place <> first").select("place.*")
    gone = (
        later.groupBy(F.col("doc_id").alias("__doc"), F.col("key").alias("__gone"))
        .agg(F.collect_set("at").alias("__at"))
    )
    covered = F.flatten(F.transform("__at", lambda p: F.sequence(p, p + window - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), covered)
    shortened = F.concat_ws("\n", F.transform(kept, lambda i: F.get("__lines", i)))
    met = keyed.join(
        gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__gone")), "left"
    ).withColumn("__lines", lines)
    total = F.coalesce(F.size("__lines"), F.lit(0)).cast("long")
    return met.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total),
            "n_removed": F.when(F.col("__at").isNull(), F.lit(0).cast("long")).otherwise(
                total - F.size(kept)
            ),
            "text": F.when(F.col("__at").isNull(), F.col("text")).otherwise(shortened),
        }
    ).select(*carried.columns, "n_lines", "n_removed")


def shortened(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with `text` and, where there is one, `n_chars` after the removal."""
    out = dedup_lines(docs, window)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and removed of every document, and the MD5 of what remains."""
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5")
    )


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS p FROM lines WHERE len(l) >= 3),
hashed AS (SELECT doc_id, p, md5(array_to_string(l[p + 1:p + 3], chr(10))) AS h FROM windows),
ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS n FROM hashed),
covered AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM ranked WHERE n > 1),
gone AS (SELECT doc_id, list(p) AS g FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       md5(CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(
         range(0, len(l)), lambda i: NOT list_contains(g, i)), lambda i: l[i + 1]), chr(10)), '') END) AS text_md5
FROM lines LEFT JOIN gone USING (doc_id)
"""
