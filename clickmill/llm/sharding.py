"""Shards of nearly equal bytes by longest-processing-time scheduling; equal texts stay together.

Documents with the same text are a group, whose size is the sum of its rows' sizes (UTF-8 bytes and one).
Groups go, the largest first, to the shard with the least bytes so far, the smaller number among equals,
which a heap gives. What the heap needs is only how many groups there are of each size: the sum of D
different sizes is at least D * (D + 1) / 2, so that for B bytes the driver gets at most sqrt(2 * B) sizes
(14 million for 100 TB) and never a group. Groups of one size are taken in turns: the shards that are due
before the least loaded one is due again form a cycle, and the cycle repeats until it reaches the next
shard's load. A size is thus a few cycles, however many groups it has, and a group's rank among those of its
size says which place of which cycle it has.

Ranks and slots are not made by windows, which would bring a frequent size or a shard into one task: each
task numbers its own rows as they pass, and the tasks' counts give where each one starts. Copies are
combined before the shuffle; on the way back they meet their group's shard in a join that adaptive
execution can split.

Slots are gapless from 0 in every shard. A null text is empty: both are one group, of size 1 a row. Null and
repeated ids are rows like others. A text of any length is one row. A group larger than a shard's share makes
its shard larger than the others. An empty table gives an empty result. Columns asked for are carried in
one struct and cannot clash; `size`, `shard` and `slot` replace any of the same name.
"""

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import documents, schema_of, written

SHARDS = 16
OWN = ("size", "shard", "slot")


def schedule(sizes: Sequence[tuple[int, int]], shards: int) -> Iterator[tuple[int, int, list[int]]]:
    """(size, first rank, cycle) of (size, number of groups): from the first rank on, groups of that size go
    to the cycle's shards in turn. The sizes may come in any order; the largest are placed first."""
    heap = [(0, shard) for shard in range(shards)]
    for size, count in sorted(sizes, reverse=True):
        rank = 0
        while rank < count:
            load, shard = heap[0]
            due = load + size, shard  # the least loaded one's next turn
            turn = []
            while heap and heap[0] < due:
                turn.append(heappop(heap))
            yield size, rank, [shard for _, shard in turn]
            left = count - rank
            whole, part = divmod(left, len(turn))
            if heap:  # the cycle ends where the next shard joins it
                gap, later = divmod(heap[0][0] - load, size)
                rounds = gap - (later == 0 and heap[0][1] < shard)
                if whole >= rounds:
                    whole, part = rounds, 0
            for place, (held, shard) in enumerate(turn):
                heappush(heap, (held + size * (whole + (place < part)), shard))
            rank += whole * len(turn) + part


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """The rows with `task`, and `at`: their place among the task's rows with the same value of `column`."""
    index = rows.columns.index(column)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            at = []
            for value in batch.column(index).to_pylist():
                at.append(seen.get(value, 0))
                seen[value] = at[-1] + 1
            more = [pa.array([task] * len(at), pa.int32()), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "task", "at"])

    return rows.mapInArrow(place, schema_of(rows, "task int, at long"))


def starts(placed: DataFrame, column: str) -> DataFrame:
    """`column`, `task`, `first`: where a task's rows begin among all rows with that value; `n` of them."""
    so_far = Window.partitionBy(column).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(column, "task").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("first", F.coalesce(F.sum("n").over(so_far), F.lit(0)))


def group_shards(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`key`, `weight` (a whole number above 0), one row per group -> `key`, `shard`."""
    spark = groups.sparkSession
    held = written(numbered(groups.select("key", "weight"), "weight"), "groups")
    begins = written(starts(held, "weight"), "begins")
    sizes = begins.groupBy("weight").agg(F.sum("n").alias("n")).toArrow()
    cycles: dict[int, list[dict]] = {}
    for size, first, cycle in schedule(list(zip(*(c.to_pylist() for c in sizes.columns))), shards):
        cycles.setdefault(size, []).append({"first": first, "cycle": cycle})
    turns = pa.struct([("first", pa.int64()), ("cycle", pa.list_(pa.int32()))])
    table = pa.table(
        {"weight": pa.array(cycles, pa.int64()), "turns": pa.array(list(cycles.values()), pa.list_(turns))}
    )
    begins = begins.join(spark.createDataFrame(table), "weight").select("weight", "task", "first", "turns")
    rank = F.col("first") + F.col("at")
    turn = F.element_at(F.filter("turns", lambda t: t["first"] <= F.col("rank")), -1)
    chosen = F.get(F.col("turn.cycle"), ((F.col("rank") - F.col("turn.first")) % F.size("turn.cycle")).cast("int"))
    return (
        held.join(begins, ["weight", "task"]).withColumn("rank", rank).withColumn("turn", turn)
        .select("key", chosen.alias("shard"))
    )


def shard(docs: DataFrame, shards: int = SHARDS, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns asked for (all, if none are named), `size`, `shard` and `slot` of every document."""
    names = [c for c in columns or docs.columns if c not in OWN]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.xxhash64(text).alias("key"),  # texts that share a hash would only be kept together
        (F.octet_length(text) + 1).cast("long").alias("size"),
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("weight"))
    met = rows.join(group_shards(groups, shards), "key").select("row", "size", "shard")
    placed = written(numbered(met, "shard"), "sharded")
    begins = starts(placed, "shard").select("shard", "task", "first")
    return placed.join(begins, ["shard", "task"]).select(
        "row.*", "size", "shard", (F.col("first") + F.col("at")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with `size` and `slot`, in one folder per shard."""
    shard(docs, shards).write.mode("overwrite").partitionBy("shard").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", "text", F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard(docs, SHARDS, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
