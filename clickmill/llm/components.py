"""Connected components of an edge table, by stars, with every round written to the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import by_shuffle, written


def components(edges: DataFrame) -> DataFrame:
    """`a`, `b` (longs, in any order) -> `node`, `root`: the smallest node of the component.

    Alternates two steps until nothing changes: every node links its larger neighbours, then its
    smaller ones, to its smallest neighbour. Both keep the components, and the links of a node are
    never brought into one row. Nulls and loops are dropped; an empty table gives an empty result.
    """

    def star(links: DataFrame, larger: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if larger:
            both = both.union(both.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = both.join(by_shuffle(least), "u")
        if larger:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    links = (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct()
    )
    state = None
    while True:
        links = written(star(star(links, True), False), "components")
        total = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("a")
        ).first()
        if tuple(total) == state:
            break
        state = tuple(total)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


