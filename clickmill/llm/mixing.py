"""Mix sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source has the same expected number of copies, its source's target divided by its
source's size. Expected copies are summed along a fixed order of the source's documents, one offset
drawn per source is added, and a document is emitted once for every integer boundary that its stretch
of the sum crosses. The order goes through classes of size, so that every size is thinned or repeated
at the same rate and the words taken come near the target.

Sums are exact: expected copies are whole multiples of 2**-24. A source is not summed in one task: its
order is cut at (size class, leading bits of the order's hash), each cut is summed by itself, and the
cuts' totals give where each one starts. The cuts depend on the cluster's number of shuffle
partitions; the order, and with it the result, does not.

Nulls: a null text has size 0; a null source is a source of its own, last in order; null ids sort
first. Rows with size 0 take part like others and weigh nothing. Rows that agree in id and text are
interchangeable. An empty table gives an empty result. Further columns are carried along; the
operator's own columns replace any of the same name (`size`, `source_size`, `target`, `copies`).
"""

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import WORD, clash_free, documents, partitions

UNIT = 1 << 24
STEPS = 8  # size classes per doubling
MOST = 3  # no source and no document is taken more often


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """`source`, `source_size` -> also `target`: shares by weight, repeating along the sources in
    code-point order with null last; no target above `most` times the size, the excess reshared.

    Sources fill up in the order of size per weight, so the shares still open are found by sums
    along that order. Rows here are sources, not documents.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w) for w in weights])
    weighed = sizes.withColumn(
        "weight", F.element_at(kinds, ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    )
    ratio = F.col("source_size") / F.col("weight")
    fills = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    open_weight = weight - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # A source is full if its cap lies below its share of what fuller ones leave.
    capped = most * F.col("source_size") * F.col("open_weight") < F.col("weight") * (
        F.col("total") - F.col("full")
    )
    shares = weighed.select(
        "*", total.alias("total"), full.alias("full"), open_weight.alias("open_weight"), ratio.alias("ratio")
    ).withColumn("capped", capped)
    first_open = F.min(F.when(~F.col("capped"), F.struct("ratio", "full", "open_weight"))).over(everything)
    share = (F.col("weight") * (F.col("total") - F.col("first.full"))).cast("double") / F.col(
        "first.open_weight"
    )
    cap = (most * F.col("source_size")).cast("double")
    return shares.withColumn("first", first_open).select(
        "source", "source_size", F.when(F.col("capped"), cap).otherwise(F.coalesce(share, cap)).alias("target")
    )


@clash_free("__key", "__class", "__scatter", "__cut", "__text", "__rows", "__words", "__source", "__rate", "__start", "__upto")
def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7) -> DataFrame:
    """The documents with `size`, `source_size`, `target` and `copies`, the times each is emitted."""
    bits = max(0, math.ceil(math.log2(max(1, partitions(docs.sparkSession) // 4))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    scatter = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    sized = docs.withColumn("size", size).withColumns(
        {
            "__key": key,
            "__class": F.when(F.col("size") > 0, F.floor(F.log2("size") * STEPS)).otherwise(F.lit(-1)),
            "__scatter": scatter,
            "__cut": F.shiftright(F.col("__scatter"), 32 - bits),
            "__text": F.md5(F.coalesce("text", F.lit(""))),
        }
    )
    cut = ["__key", "__class", "__cut"]
    cuts = sized.groupBy("source", *cut).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum("size").alias("__words")
    )
    goals = targets(cuts.groupBy("source").agg(F.sum("__words").alias("source_size")), weights)
    rate = F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(1.0)) * UNIT)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("__key"))), 1, 6), 16, 10)
    along = Window.partitionBy("__key").orderBy("__class", "__cut")
    so_far = F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        cuts.join(goals.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__rate", rate)
        .select(
            *cut,
            "source_size",
            "target",
            "__rate",
            (F.coalesce(so_far, F.lit(0)) * F.col("__rate") + start.cast("long")).alias("__start"),
        )
    )
    inside = Window.partitionBy(*cut).orderBy("__scatter", "doc_id", "__text")
    placed = sized.drop("source_size", "target", "copies").join(starts, cut)
    upto = F.col("__start") + F.sum("__rate").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    crossed = F.shiftright("__upto", 24) - F.shiftright(F.col("__upto") - F.col("__rate"), 24)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return placed.withColumn("__upto", upto).select(
        *kept, "size", "source_size", "target", crossed.cast("int").alias("copies")
    )


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as many times as it is taken; repeats are equal rows."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")
    return mixed.where("copies > 0").select(row, times).select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", taken, "copies")


OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         coalesce('=' || source, 'null') AS k, coalesce(CAST(doc_id AS VARCHAR), '') AS id, text
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         sum(source_size) OVER () AS total FROM sizes),
filled AS (
  SELECT *, source_size / weight AS ratio,
         3 * coalesce(sum(source_size) OVER w, 0) AS taken_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, 3 * source_size * open_weight < weight * (total - taken_before) AS capped FROM filled),
level AS (SELECT taken_before, open_weight FROM marked WHERE NOT capped ORDER BY ratio, taken_before LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * (total - l.taken_before) AS DOUBLE) / l.open_weight END AS target
  FROM marked LEFT JOIN level l ON true),
rated AS (
  SELECT s.*, g.source_size, g.target,
         CAST(floor(coalesce(g.target / nullif(g.source_size, 0), 1) * 16777216) AS BIGINT) AS rate,
         CAST('0x' || substr(md5('7:' || k), 1, 6) AS BIGINT) AS start,
         CASE WHEN size > 0 THEN floor(log2(size) * 8) ELSE -1 END AS cls,
         CAST('0x' || substr(md5('7:' || id), 1, 8) AS BIGINT) AS scatter
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
ranked AS (
  SELECT *, start + rate * row_number() OVER (
    PARTITION BY k ORDER BY cls, scatter, doc_id NULLS FIRST, md5(coalesce(text, ''))) AS upto FROM rated)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(((upto >> 24) - ((upto - rate) >> 24)) * size AS BIGINT) AS taken,
       CAST((upto >> 24) - ((upto - rate) >> 24) AS INTEGER) AS copies
FROM ranked
"""
