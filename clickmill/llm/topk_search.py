"""Exact top-k by integer inner product: a ball tree per shard, searched by branch and bound.

Every component x becomes floor(1024 * x). Vectors are dealt by the hash of their id into shards of about
`SHARD` vectors of one length. A shard's ball tree halves the vectors along their widest component; a node
has a center and a radius, so that q.center + |q| * radius bounds the inner product with all vectors
below it. Nodes are opened in the order of that bound, and none is opened whose bound lies below the
query's k-th best score so far. A query first searches the shard it lies in; the k-th score found there
goes along to all other shards. The trees are a written table. Queries travel in blocks: each block meets
each shard once.

Scores are exact integers; one beyond 64 bits is cut off at their range. Ties go to the smaller id. A
vector that is null, empty, or has a null or non-finite component takes no part, nor does a row without
id. Vectors of different lengths are not compared. Repeated ids are separate candidates, and a query
leaves out all rows of its own id; of repeated rows of a query one is searched. An empty table gives an
empty result. Other columns are not read and cannot clash.
"""

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import by_shuffle, written

SHARD = 4096
LEAF = 128
BLOCK = 256  # queries that travel together
EVERY = 100
K = 10


def scaled(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(1024 * values).reshape(-1, dim)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers below 2**53 are exact as floats, others go through integers."""
    if len(rows) and np.abs(rows).max() * np.abs(query).max() * len(query) >= 2**52:
        whole = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows]
        return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in whole], np.int64)
    return np.einsum("ij,j->i", rows, query).astype(np.int64)


class Ball:
    """A ball tree; node i holds rows first[i]:last[i] of `rows` and has its children at `child[i]`."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, todo = np.arange(len(ids)), [(0, len(ids))]
        first, last, child, centers, radii = [], [], [], [], []
        at = 0
        while at < len(todo):
            start, stop = todo[at]
            held = rows[order[start:stop]]
            center = held.mean(0)
            centers.append(center)
            radii.append(float(np.sqrt(((held - center) ** 2).sum(1).max())))
            first.append(start)
            last.append(stop)
            if stop - start > LEAF:
                widest = int(np.argmax(held.max(0) - held.min(0)))
                order[start:stop] = order[start:stop][np.argsort(held[:, widest], kind="stable")]
                middle = (start + stop) // 2
                child.append(len(todo))
                todo += [(start, middle), (middle, stop)]
            else:
                child.append(-1)
            at += 1
        self.ids, self.rows = ids[order], rows[order]
        self.first, self.last, self.child = first, last, child
        self.centers, self.radii = np.array(centers), np.array(radii)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of up to k best rows, none below `floor`, best first, ties to the smaller id."""
        bounds = np.einsum("ij,j->i", self.centers, query) + np.sqrt((query**2).sum()) * self.radii
        bounds = bounds + 1e-6 * (1 + np.abs(bounds))  # what rounding may have taken away
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        least = floor
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if least is not None and -bound < least:
                break
            if self.child[node] >= 0:
                for below in (self.child[node], self.child[node] + 1):
                    if least is None or bounds[below] >= least:
                        heapq.heappush(heap, (-bounds[below], below))
                continue
            part = slice(self.first[node], self.last[node])
            found, named = products(self.rows[part], query), self.ids[part]
            keep = named != own
            if least is not None:
                keep &= found >= least
            scores, ids = np.append(scores, found[keep]), np.append(ids, named[keep])
            best = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[best], ids[best]
            if len(scores) == k and (least is None or scores[-1] > least):
                least = int(scores[-1])
        return scores, ids


def _build(every: int, k: int):
    """Per shard: its tree, and its queries with their k-th score there."""

    def one(table: pa.Table) -> pa.Table:
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        ids, rows = table["vec_id"].to_numpy(), scaled(table["embedding"], dim)
        tree = Ball(ids, rows)
        out = [(dim, shard, None, None, pickle.dumps(vars(tree), protocol=5))]
        seen = set()
        for at in np.flatnonzero(ids % every == 0):
            if int(ids[at]) in seen:
                continue
            seen.add(int(ids[at]))
            scores, _ = tree.search(int(ids[at]), rows[at], k, None)
            floor = int(scores[-1]) if len(scores) == k else None
            out.append((dim, shard, int(ids[at]), floor, rows[at].tobytes()))
        return pa.table(dict(zip(("dim", "shard", "query_id", "least", "held"), map(list, zip(*out)))), schema=BUILT)

    return one


BUILT = pa.schema(
    [("dim", pa.int32()), ("shard", pa.int32()), ("query_id", pa.int64()), ("least", pa.int64()), ("held", pa.binary())]
)
BUILT_DDL = "dim int, shard int, query_id long, least long, held binary"


def _search(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, ids, leasts, queries in zip(*(batch.column(i) for i in range(4))):
                tree = Ball.__new__(Ball)
                vars(tree).update(pickle.loads(held.as_py()))
                out: list[tuple] = []
                for own, least, query in zip(ids.as_py(), leasts.as_py(), queries.as_py()):
                    floor = None if least == NONE else least
                    scores, named = tree.search(own, np.frombuffer(query, np.float64), k, floor)
                    out.extend((own, int(n), int(s)) for n, s in zip(named, scores))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"]
                    )

    return rows


NONE = -(2**63)


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """For every id divisible by `every`: `query_id`, `rank`, `vec_id`, `score` of its k best others."""
    value = F.col("embedding")
    whole = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(value.isNotNull() & F.col("vec_id").isNotNull()).where(
        (F.size(value) > 0) & whole
    ).select(F.col("vec_id").cast("long"), F.size(value).alias("dim"), "embedding")
    shards = max(1, -(-usable.count() // SHARD))
    dealt = usable.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    built = written(dealt.groupBy("dim", "shard").applyInArrow(_build(every, k), BUILT_DDL), "balls")
    trees = built.where("query_id IS NULL").select("dim", "shard", F.col("held").alias("tree"))
    queries = built.where("query_id IS NOT NULL")
    blocks = max(1, -(-queries.count() // BLOCK))
    travelling = (
        queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        .groupBy("dim", "block")
        .agg(F.collect_list(F.struct("query_id", F.coalesce("least", F.lit(NONE)).alias("least"), "held")).alias("q"))
        .select("dim", "block", "q.query_id", "q.least", "q.held")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    # Spark takes the queries' size from before they are repeated for each shard: by that size it would send
    # all of the repeats to every task, by way of the driver
    met = by_shuffle(trees).join(travelling, ["dim", "shard"]).repartition(max(2, min(shards * blocks, 4096)), "dim", "shard", "block")
    found = met.select("tree", "query_id", "least", "held").mapInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
