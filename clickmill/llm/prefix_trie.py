"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt from the head of another one, its base, and its own turns behind as many. A run of
turns is an element of a monoid, (number of turns, polynomial hash): two runs are put together by
(n, x)(m, y) = (n + m, x * B**m + y), modulo the prime 2**127 - 1. The product of a conversation's own turns
behind the h-th one follows from its prefix products, so that every prefix of a rebuilt conversation is the
product of a base head and an own suffix, and no rebuilt turn or text is ever written. A prefix's product and
length are its node in the trie; taking the last turn off the product gives the parent.

Turns are known by references: 120 bits of the SHA-256 of role and text, which the table of turns holds with
the text's length. A node's members must all have one reference at its last turn; as this holds at every
depth, equal products mean equal turns. Two references at one node stop the run with an error.

Prefix products and sums along a conversation are made by ranges of (conversation, order), not by
conversation: every task multiplies its own stretch, and what earlier tasks hold of the same conversation, at
most one product per task, is put before it. So a conversation of any length is spread over tasks. Sums over
subtrees need no walk along the depth: a node that saves something is counted at its smallest member, and a
node's total is the sum over its members, less what its own smallest member saves above it. Lists of
conversations that end at a node are written in chunks and hashed chunk by chunk.

Turns are ordered by `turn` (null first), then by the reference, and repeated rows are repeated turns. Null
role or text is empty; a row with a null conv_id belongs to no conversation and takes no part. A base is read
as it stands in the table, never as rebuilt. Texts of any length are one reference. An empty table gives an
empty result. Other columns are not read and cannot clash.
"""

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import schema_of, written

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"turns").digest()[:15], "big")
INVERSE = pow(BASE, -1, PRIME)
REFERENCE = 15  # bytes, below the prime
NOTHING = bytes(16)  # the product of no turns
MOST = 5  # longest head
CHUNK = 1 << 16  # characters of an id list in one row

Run = tuple[int, int]  # turns, hash


def combined(one: Run, other: Run) -> Run:
    """The product of two runs of turns."""
    return one[0] + other[0], (one[1] * pow(BASE, other[0], PRIME) + other[1]) % PRIME


def behind(whole: Run, head: Run) -> Run:
    """The run that follows `head` in `whole`, which starts with it."""
    n = whole[0] - head[0]
    return n, (whole[1] - head[1] * pow(BASE, n, PRIME)) % PRIME


def single(reference: bytes) -> int:
    """The hash of one turn; never 0, so that runs of different lengths differ."""
    return int.from_bytes(reference, "big") + 1


def _number(held: bytes) -> int:
    return int.from_bytes(held, "big")


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def running(
    rows: DataFrame,
    group: str,
    order: list[Column],
    value: str,
    columns: str,
    zero: Any,
    plus: Callable[[Any, Any], Any],
    lift: Callable[[Any], Any],
    show: Callable[[Any], tuple],
    read: Callable[..., Any],
) -> DataFrame:
    """The rows with a running product along `order` within `group`, which must come first in it.

    `lift` makes a row's `value` an element, `plus` combines, `show` and `read` turn an element into the
    two `columns` (DDL) and back. The driver gets one product per task and group that tasks share.
    """
    names, kinds = zip(*(c.split() for c in columns.split(", ")))
    types = [{"long": pa.int64(), "binary": pa.binary()}[kind] for kind in kinds]
    at = rows.columns.index(group), rows.columns.index(value)
    out, task_at = len(rows.columns), len(rows.columns) + 3  # places of the new columns

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now, state, place = TaskContext.get().partitionId(), None, zero, 0
        for batch in batches:
            more: list[list] = [[], [], []]
            for key, held in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist()):
                if key != now:
                    now, state, place = key, zero, 0
                state, place = plus(state, lift(held)), place + 1
                for column, x in zip(more, (*show(state), place)):
                    column.append(x)
            made = [pa.array(c, kind) for c, kind in zip(more, (*types, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made, pa.array([task] * batch.num_rows, pa.int32())],
                [*batch.schema.names, *names, "place", "task"],
            )

    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = written(sorted_.mapInArrow(inside, schema_of(rows, f"{columns}, place long, task int")), "running")
    last = held.groupBy(group, "task").agg(F.max_by(F.struct(*names), "place").alias("last"))
    shared = last.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("task", "last"))).alias("parts"))
    before = {}  # (group, task): the product of the tasks before
    for row in shared.where(F.size("parts") > 1).collect():  # at most two groups a task
        state = zero
        for part in row["parts"]:
            before[row[group], part["task"]] = state
            state = plus(state, read(*part["last"]))

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(at[0]).to_pylist(), batch.column(task_at).to_pylist())
            states = zip(*(batch.column(out + i).to_pylist() for i in range(2)))
            shown = [show(plus(before[k], read(*s))) if k in before else s for k, s in zip(keys, states)]
            made = [pa.array([s[i] for s in shown], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:out], *made], batch.schema.names[: out + 2])

    return held.mapInArrow(carried, schema_of(rows, columns)) if before else held.drop("place", "task")


def turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `reference`, `chars`, `row`: all that is needed of the texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole, 256)), 1, REFERENCE)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("reference"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )


def prefixes(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `reference`, `chars`, `pos` (from 1) and `product` of every turn as it stands."""
    held = written(turns(conversations), "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("reference"), F.col("row")]
    return running(
        held, "conv_id", order, "reference", "pos long, product binary",
        zero=(0, 0), plus=combined, lift=lambda reference: (1, single(reference)),
        show=lambda run: (run[0], _bytes(run[1])), read=lambda n, product: (n, _number(product)),
    ).drop("turn", "row")


def rebuilt(own: DataFrame, base: Column, head: Column) -> DataFrame:
    """`conv_id`, `depth`, `product`, `reference`, `chars`, `ends` of every prefix of every rebuilt
    conversation, the empty one included. `base` is the conversation whose first `head` turns (at most `MOST`)
    come first, both as columns of `conv_id`.
    """
    first = F.when(F.col("pos") <= MOST, F.struct("pos", "product", "reference", "chars"))
    convs = own.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.array_sort(F.collect_list(first)).alias("first")  # nulls are left out
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"))
    nothing = F.lit(bytearray(NOTHING))
    joints = convs.withColumns({"base": base, "h": head.cast("int")}).join(bases, "base", "left").select(
        "conv_id", "n", "h", F.slice(F.coalesce("base_first", F.slice("first", 1, 0)), 1, F.col("h")).alias("head"),
        F.coalesce(F.get("first.product", F.col("h") - 1), nothing).alias("own_head"),
    )
    joints = written(
        joints.withColumns({
            "k": F.size("head").cast("long"),
            "base_head": F.coalesce(F.get("head.product", F.size("head") - 1), nothing),
            "ending": F.col("n") <= F.col("h"),
        }), "joints"
    )
    root = joints.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), nothing.alias("product"), F.lit(bytearray(b"")).alias("reference"),
        F.lit(0).cast("long").alias("chars"), (F.col("ending") & (F.col("k") == 0)).alias("ends"),
    )
    heads = joints.select("conv_id", "k", "ending", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), "t.product", "t.reference", "t.chars",
        (F.col("ending") & (F.col("t.pos") == F.col("k"))).alias("ends"),
    )

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, product = [], []
            names = ("pos", "product", "h", "own_head", "k", "base_head")
            for pos, whole, h, own_head, k, base_head in zip(*(batch.column(c).to_pylist() for c in names)):
                suffix = behind((pos, _number(whole)), (h, _number(own_head)))
                n, value = combined((k, _number(base_head)), suffix)
                depth.append(n)
                product.append(_bytes(value))
            kept = [batch.column(c) for c in ("reference", "chars", "ends")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depth, pa.int64()), pa.array(product, pa.binary()), *kept],
                ["conv_id", "depth", "product", "reference", "chars", "ends"],
            )

    behind_head = own.join(joints.where(~F.col("ending")).drop("head", "ending"), "conv_id").where("pos > h")
    suffixes = behind_head.withColumn("ends", F.col("pos") == F.col("n")).drop("n").mapInArrow(
        composed, "conv_id long, depth long, product binary, reference binary, chars long, ends boolean"
    )
    return root.unionByName(heads).unionByName(suffixes)


def _nodes(members: DataFrame) -> DataFrame:
    """`depth`, `product`, `parent`, `conv_id`, `n_convs`, `saves` of every node."""
    found = members.groupBy("depth", "product", "reference").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars")
    )

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = zip(*(batch.column(c).to_pylist() for c in ("depth", "product", "reference")))
            above = [
                _bytes((_number(product) - single(reference)) * INVERSE % PRIME) if depth else None
                for depth, product, reference in held
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above, pa.binary())], [*batch.schema.names, "parent"]
            )

    saves = (F.col("n_convs") - 1) * F.col("chars")
    return found.mapInArrow(parents, schema_of(found, "parent binary")).withColumn("saves", saves).drop("chars")


def _digests(ends: DataFrame) -> DataFrame:
    """`depth`, `product`, `ends_sha256` of the nodes where conversations end."""
    order = ["depth", "product", "conv_id"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, size = None, None, [], 0

        def made():
            columns = ([now[0]], [now[1]], [first], [",".join(ids)])
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["depth", "product", "first", "ids"]
            )

        for batch in batches:
            for depth, product, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, product) != now or size > CHUNK:
                    if now is not None:
                        yield made()
                    now, first, ids, size = (depth, product), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if now is not None:
            yield made()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for depth, product, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, product) == now:
                    digest.update(f",{ids}".encode())
                else:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = (depth, product), hashlib.sha256(ids.encode())
            yield rows(done)
        if now is not None:
            yield rows([(*now, digest.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.string()))],
            ["depth", "product", "ends_sha256"],
        )

    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunks, "depth long, product binary, first long, ids string"
    )
    keys = ["depth", "product"]
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(
        hashed, "depth long, product binary, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame, base: Column, head: Column) -> DataFrame:
    """One row per node: `conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens`, `ends_sha256`. `base` and `head` as in `rebuilt`."""
    members = written(rebuilt(prefixes(conversations), base, head), "members")
    nodes = written(_nodes(members), "nodes")
    node = ["depth", "product"]
    above = (F.col("depth") - 1).alias("depth"), F.col("parent").alias("product")
    children = nodes.where("depth > 0").select(*above).groupBy(*node).agg(F.count(F.lit(1)).alias("n_children"))
    # What the nodes of each smallest member save, along its own nodes from the top one.
    along = running(
        nodes.select("conv_id", *node, "saves"), "conv_id", [F.col("conv_id"), F.col("depth")], "saves",
        "steps long, upto long", zero=(0, 0), plus=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        lift=lambda saves: (1, saves), show=lambda run: run, read=lambda n, total: (n, total),
    )
    leaves = nodes.join(children, node, "left_anti").select("conv_id", F.lit(0).alias("saves"), F.lit(1).alias("leaf"))
    credit = nodes.select("conv_id", "saves", F.lit(0).alias("leaf")).union(leaves).groupBy("conv_id").agg(
        F.sum("saves").alias("credit"), F.sum("leaf").alias("leaf")
    ).where("credit > 0 OR leaf > 0")
    below = members.select("conv_id", *node).join(credit, "conv_id").groupBy(*node).agg(
        F.sum("credit").alias("credit"), F.sum("leaf").alias("n_leaves")
    )
    made = (
        nodes.drop("saves").join(along.select(*node, (F.col("upto") - F.col("saves")).alias("spent")), node)
        .join(below, node, "left").join(children, node, "left")
        .join(_digests(members.where("ends")), node, "left")
    )
    # A product with two references would be two rows with one key here.
    twice = nodes.groupBy(*node).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("parent_conv_id"))
    one = F.when(F.col("n") == 1, F.col("parent_conv_id")).otherwise(
        F.raise_error(F.lit("two different prefixes have one fingerprint"))
    )
    up = twice.select(F.col("depth").alias("up_depth"), F.col("product").alias("up_product"), one.alias("parent_conv_id"))
    met = (F.col("up_depth") == F.col("depth") - 1) & (F.col("up_product") == F.col("parent"))
    return made.join(up, met, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.coalesce("credit", F.lit(0)) - F.col("spent")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    decimal = conv.cast("string").cast("binary")
    return prefix_trie(
        spark.read.parquet(f"{sf_dir}/conversations.parquet"), conv - conv % 100, F.crc32(decimal) % (MOST + 1)
    )


OP13_SQL = """
WITH own AS (
  SELECT conv_id AS c, ref, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, ref) AS p
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
               substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30) AS ref
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (  -- crc32, bit by bit
  SELECT c, c - c % 100 AS base, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM own)),
parts AS (
  SELECT k.c, 0 AS own, p, ref, chars FROM convs k JOIN own b ON b.c = k.base AND b.p <= k.h
  UNION ALL SELECT k.c, 1, p, ref, chars FROM convs k JOIN own o ON o.c = k.c AND o.p > k.h),
paths AS (
  SELECT c, row_number() OVER w AS d, chars, string_agg(ref, '') OVER w AS path FROM parts
  WINDOW w AS (PARTITION BY c ORDER BY own, p)
  UNION ALL SELECT c, 0, 0, '' FROM convs),
members AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM paths),
nodes AS (
  SELECT d, path, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS sha
  FROM members GROUP BY d, path),
kids AS (SELECT left(path, length(path) - 30) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (SELECT x.*, coalesce(k.n, 0) AS kids FROM nodes x LEFT JOIN kids k USING (path)),
trees AS (
  SELECT a.path, count(*) FILTER (b.kids = 0) AS leaves, sum((b.n - 1) * b.chars) AS saved
  FROM whole a JOIN whole b ON b.d >= a.d AND starts_with(b.path, a.path) GROUP BY a.path)
SELECT x.c AS conv_id, CAST(x.d AS BIGINT) AS depth, up.c AS parent_conv_id, x.n AS n_convs,
       CAST(x.kids AS BIGINT) AS n_children, CAST(t.leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, x.sha AS ends_sha256
FROM whole x JOIN trees t USING (path)
LEFT JOIN nodes up ON x.d > 0 AND up.path = left(x.path, length(x.path) - 30)
"""
