"""Near duplicates: Jaccard join on word 5-grams by adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles (64-bit hashes); with fewer words, its whole
sequence is one. All tasks order shingles alike: those seen often go last. In that order, two documents
that are similar enough share at least `l` shingles among the first `n - ceil(t * n) + l` of each. Every
document chooses its own `l`: where its prefix reaches into common shingles, whose lists are long, a
longer prefix that asks for more shared shingles costs less than checking all that share one. A pair is
checked if it shares as many prefix shingles as the smaller `l` of the two asks for.

1. One pass over the texts writes each document's set size and signature, and the shingles that several
   documents of a task's window share, with their number. The number only orders shingles.
2. A second pass writes the prefixes, once per signature and task: copies are one node of the join,
   known by signature and size. Only shingles with several nodes are kept.
3. In each shingle's list, every node is checked against one node. Lists whose nodes are all connected
   by now need no more pairs, so a large group of near copies costs its size and not its square.
4. In the other lists, all pairs of unconnected nodes that pass the size and position bounds and share
   enough are checked, exactly, on the whole sets. Nodes of long lists are compared in blocks, which
   write what connects them. No list is cut off.

Nulls and empty texts: an empty set, linked with nothing. A null id is carried; a component's id is its
smallest id. Repeated rows are copies. Long texts are hashed whole. An empty table gives an empty
result. Other columns are not read and cannot clash.
"""


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import by_shuffle, clash_free, documents, partitions, small_batches, written
from clickmill.llm.components import components
from clickmill.llm.text import hashed_words, mix

N = 5
PERCENT = 75
LONGEST = 4  # largest l that a prefix may ask for
WINDOW = 2_000_000  # shingles that a task looks at together when it counts common ones
ORDERED = 400_000  # commonest shingles that are ordered by number; all others by hash alone
SHORT = 64  # nodes in a list whose pairs are written out
TOGETHER = 512  # nodes of a longer list that are compared at once with as many others
SENT = 2_000_000  # ids (8 bytes each) that may go to every task; more are joined by shuffle
KEPT = 1 << 18  # signatures that a task remembers, so as not to write a set again; then it starts anew
NO_ID = -(2**63)  # stands for a null id
_FACTORS = np.random.default_rng(5).integers(1, 2**63, N, np.uint64) | np.uint64(1)


def shingle_sets(column) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingles."""
    for _, bounds, words in hashed_words(column):
        n = len(words) - N + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for i in range(N if n > 0 else 0):
            rolled += words[i : i + n] * _FACTORS[i]
        rolled = mix(rolled)
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if stop - start >= N:
                yield np.unique(rolled[start : stop - N + 1])
            elif stop > start:
                whole = (words[start:stop] * _FACTORS[: stop - start]).sum() + np.uint64(stop - start)
                yield mix(np.array([whole], np.uint64) ^ np.uint64(0x5BD1E995))
            else:
                yield words[:0]


def signature(shingles: np.ndarray) -> int:
    return int(mix(np.array([mix(shingles ^ np.uint64(0x2545F491)).sum() + np.uint64(len(shingles))]))[0])


def signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (n >= 0), and rows of common shingles (n = -1, their number in `doc_id`)."""
    names, window, held, seen = ["doc_id", "n", "sig"], [], 0, set()

    def common():
        values, counts = np.unique(np.concatenate(window), return_counts=True)
        often = counts > 1
        number = counts[often].astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(np.full(len(number), -1)), pa.array(signed(values[often]))], names
        )

    for batch in batches:
        sizes, signatures = [], []
        for shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            signatures.append(signature(shingles) if len(shingles) else 0)
            if len(shingles) and signatures[-1] not in seen:
                seen.add(signatures[-1])
                window.append(shingles)
                held += len(shingles)
                if held >= WINDOW:
                    yield common()
                    window, held, seen = [], 0, set()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signed(signatures))], names
        )
    if window:
        yield common()


def prefix(shingles: np.ndarray, numbers: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(the prefix in the common order, the l it asks for). `numbers`: how common each shingle is."""
    n = len(shingles)
    least = -(-percent * n // 100)
    if not numbers.any():
        return shingles[: n - least + 1], 1
    order = np.argsort(numbers, kind="stable")
    lists = np.cumsum(numbers[order])
    steps = np.arange(1, min(LONGEST, least) + 1)
    met = lists[n - least + steps - 1]  # candidates' entries read, and what is left of them to check
    best = int(steps[np.argmin(met + 4 * met / steps**2)])
    return shingles[order[: n - least + best]], best


def _prefixes(common: np.ndarray, numbers: np.ndarray, percent: int):
    """Rows (shingle, sig, n, at, asks) of every signature's prefix, once per task and signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            parts, heads = [], []
            for shingles in shingle_sets(batch.column(0)):
                n = len(shingles)
                if not n or (sig := signature(shingles)) in done:
                    continue
                if len(done) >= KEPT:
                    done.clear()
                done.add(sig)
                at = np.minimum(np.searchsorted(common, shingles), max(len(common) - 1, 0))
                known = numbers[at] * (common[at] == shingles) if len(common) else np.zeros(n, np.int64)
                chosen, asks = prefix(shingles, known, percent)
                parts.append(chosen)
                heads.append((sig, n, asks, len(chosen)))
            if not heads:
                continue
            sig, n, asks, size = (np.array(x, np.uint64) for x in zip(*heads))
            size = size.astype(np.int64)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            repeat = lambda x: np.repeat(x.astype(np.int32), size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate(parts))),
                    pa.array(np.repeat(signed(sig), size)),
                    *(pa.array(x) for x in (repeat(n), at.astype(np.int32), repeat(asks))),
                ],
                ["shingle", "sig", "n", "at", "asks"],
            )

    return rows


def _runs(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...] = ("shingle",)
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(columns, starts of the runs of equal keys); a run is never cut between two of them."""
    kept: dict[str, np.ndarray] | None = None
    for batch in batches:
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if not batch.num_rows:
            continue
        if kept is not None:
            now = {c: np.concatenate([kept[c], v]) for c, v in now.items()}
        new = np.zeros(len(now["sig"]), bool)
        new[0] = True
        for key in keys:
            new[1:] |= now[key][1:] != now[key][:-1]
        starts = np.flatnonzero(new)
        last = starts[-1]
        kept = {c: v[last:] for c, v in now.items()}
        if last:
            yield {c: v[:last] for c, v in now.items()}, starts[:-1]
    if kept is not None:
        yield kept, np.array([0])


LISTS = "shingle long, sig long, n int, at int, asks int, first long, needs int"


def _possible(n, at, other_n, other_at, percent: int):
    """Whether two sets of these sizes that share a shingle at these places can be similar enough."""
    most = np.minimum(at, other_at) + np.minimum(n - at, other_n - other_at)
    return 100 * most >= percent * (n + other_n - most)


def _shared(percent: int):
    """The rows of lists with several nodes, each with its list's smallest node in `first`, and how many
    prefix shingles the two must share; 0 if they cannot be similar."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, starts in _runs(batches):
            sizes = np.diff(np.append(starts, len(now["sig"])))
            head = np.repeat(starts, sizes)
            first = now["sig"][head]
            several = np.repeat(np.maximum.reduceat(now["sig"], starts) != now["sig"][starts], sizes)
            again = np.zeros(len(first), bool)  # the same node from another task
            again[1:] = (now["sig"][1:] == now["sig"][:-1]) & (now["shingle"][1:] == now["shingle"][:-1])
            n, at = now["n"].astype(np.int64), now["at"].astype(np.int64)
            asks = now["asks"].astype(np.int64)
            near = (now["sig"] != first) & _possible(n, at, n[head], at[head], percent)
            needs = np.where(near, _asked(n, asks, n[head], asks[head], percent), 0).astype(np.int32)
            keep = several & ~again
            if keep.any():
                columns = [*(now[c] for c in ("shingle", "sig", "n", "at", "asks")), first, needs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[keep]) for c in columns],
                    ["shingle", "sig", "n", "at", "asks", "first", "needs"],
                )

    return rows


PAIRS = "a long, b long, asks int"


def _asked(n, asks, other_n, other_asks, percent: int):
    """How many prefix shingles two similar sets share at least: the smaller `l`, and what their overlap
    still lacks if all that one of them has behind its prefix is shared."""
    least, other_least = -(-percent * n // 100), -(-percent * other_n // 100)
    overlap = -(-percent * (n + other_n) // (100 + percent))
    behind = np.maximum(least - asks, other_least - other_asks)
    return np.maximum(np.minimum(asks, other_asks), overlap - behind)


def _pairs(percent: int):
    """All pairs of unconnected nodes of a list that pass the bounds of size and position."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, starts in _runs(batches):
            sig, root = now["sig"], now["root"]
            n, at, asks = (now[c].astype(np.int64) for c in ("n", "at", "asks"))
            stops = np.append(starts[1:], len(sig))
            stop = np.repeat(stops, stops - starts)
            for step in range(1, int((stops - starts).max())):
                i = np.arange(len(sig) - step)
                i = i[i + step < stop[: len(i)]]
                i = i[root[i] != root[i + step]]
                j = i + step
                good = _possible(n[i], at[i], n[j], at[j], percent)
                i, j = i[good], j[good]
                if len(i):
                    needs = _asked(n[i], asks[i], n[j], asks[j], percent)
                    ends = (np.minimum(sig[i], sig[j]), np.maximum(sig[i], sig[j]), needs.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b", "asks"])

    return rows


def _sets(wanted: np.ndarray | None):
    """Sets of the documents in `wanted` (ids; None: of all), 48 bits of each shingle; repeated ones of a
    task once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, ids), max(len(wanted) - 1, 0))
                found = wanted[at] == ids if len(wanted) else np.zeros(len(ids), bool)
                batch = batch.filter(pa.array(found))
                if not batch.num_rows:
                    continue
            held, values, packed = [], [], []
            for doc, one in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                sig = signature(one) if len(one) else 0
                if (doc, sig) in done:
                    continue
                if len(done) >= KEPT:
                    done.clear()
                done.add((doc, sig))
                held.append(doc)
                values.append(sig)
                packed.append(one.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int64()), pa.array(signed(values)), pa.array(packed, pa.binary())],
                ["id", "sig", "shingles"],
            )

    return rows


def _unpacked(held: bytes) -> np.ndarray:
    out = np.zeros((len(held) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(held, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


def _similar(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("one"), batch.column("other")):
                one, other = _unpacked(x.as_py()), _unpacked(y.as_py())
                if len(one) > len(other):
                    one, other = other, one
                at = np.minimum(np.searchsorted(other, one), len(other) - 1)
                both = int((other[at] == one).sum())
                good.append(100 * both >= percent * (len(one) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
                pa.array(good, pa.bool_())
            )

    return rows


def _connected(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the first node that each one reaches."""
    least = np.arange(len(linked))
    while True:
        met = np.minimum(least, np.where(linked, least[None, :], len(least)).min(1, initial=len(least)))
        met = met[met]
        if (met == least).all():
            return least
        least = met


def _dense(percent: int):
    """Links between unconnected nodes of two blocks of a long list, by one product of the matrix
    node x shingle with its transpose, made in strips of shingles. Of the links, as many are written as
    connect the same nodes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, starts in _runs(batches, ("shingle", "x", "y")):
            for start, stop in zip(starts, np.append(starts[1:], len(now["sig"]))):
                sig, root, mine = (now[c][start:stop] for c in ("sig", "root", "mine"))
                sets = [_unpacked(held) for held in now["shingles"][start:stop]]
                sizes = np.array([len(one) for one in sets])
                _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
                row = np.repeat(np.arange(len(sets)), sizes)[column >= 0]
                column = column[column >= 0]
                both = np.zeros((len(sets), len(sets)), np.float32)
                strip = max(1, (1 << 22) // len(sets))
                order = np.argsort(column, kind="stable")
                edges = np.arange(0, int(column.max(initial=-1)) + 1 + strip, strip)
                cuts = np.searchsorted(column[order], edges)
                for low, a, b in zip(edges, cuts[:-1], cuts[1:]):
                    held = np.zeros((len(sets), strip), np.float32)
                    held[row[order[a:b]], column[order[a:b]] - low] = 1
                    both += held @ held.T
                good = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
                good &= root[:, None] != root[None, :]
                good &= (mine == now["x"][start])[:, None] & (mine == now["y"][start])[None, :]
                least = _connected(good | good.T)
                i = np.flatnonzero(least != np.arange(len(sig)))
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(sig[least[i]]), pa.array(sig[i])], ["a", "b"])

    return rows


class Holders:
    """The texts, and for every signature the one document that shows its set when it is asked for."""

    def __init__(self, docs: DataFrame, described: DataFrame):
        self.texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
        self.of = described.where("n > 0").groupBy("sig").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("id"))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """`sig`, `shingles`: the whole sets of the nodes in `sig`, made from the texts once more. Every node
        has one row, however often its id and text are repeated in the table."""
        wanted = written(self.of.join(by_shuffle(nodes), "sig"), "wanted")
        columns = "id long, sig long, shingles binary"
        n = wanted.count()
        if n <= SENT:
            ids = np.sort(wanted.select("id").toArrow().column(0).to_numpy())
            found = self.texts.mapInArrow(_sets(ids), columns)
        else:
            found = self.texts.mapInArrow(_sets(None), columns).join(by_shuffle(wanted), ["id", "sig"], "left_semi")
        sets = written(found.select("sig", "shingles"), "shingles")
        if sets.count() > n:  # repeated rows in several tasks
            sets = written(sets.groupBy("sig").agg(F.first("shingles").alias("shingles")), "shingles")
        return sets


def _verified(pairs: DataFrame, holders: Holders, percent: int) -> DataFrame:
    """The pairs `a`, `b` that are similar enough, by their whole sets."""
    pairs = written(pairs.select("a", "b"), "pairs")
    sets = holders.sets(pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct())
    one = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("other"))
    other = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("one"))
    both = pairs.join(by_shuffle(one), "b").join(by_shuffle(other), "a").select("a", "b", "one", "other")
    return written(both.mapInArrow(_similar(percent), "a long, b long"), "links")


def _linked_in_long_lists(lists: DataFrame, holders: Holders, percent: int) -> DataFrame:
    """Links between nodes of long lists: each list in blocks, each pair of blocks a group by itself."""
    held = written(lists.select("shingle", "sig", "root", "size"), "long")
    sets = holders.sets(held.select("sig").distinct())
    blocks = F.ceil(F.col("size") / TOGETHER).cast("int")
    mine = F.pmod(F.xxhash64("sig"), blocks).cast("int")
    others = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    keys = ["shingle", "x", "y"]
    # Sets are met before rows are repeated for each block: Spark takes the size of the repeats from before, and
    # might send them all to every task. For the same reason it gives them to too few tasks; their number is set
    dealt = held.repartition(partitions(lists.sparkSession), "sig")
    met = dealt.join(by_shuffle(sets), "sig").select("shingle", "sig", "root", "shingles", mine.alias("mine"), others)
    met = met.withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")})
    met = met.repartition(*keys).sortWithinPartitions(*keys)
    links = met.select(*keys, "sig", "root", "mine", "shingles").mapInArrow(_dense(percent), "a long, b long")
    return written(links.distinct(), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every row."""
    small_batches(docs.sparkSession)
    described = written(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_describe, "doc_id long, n long, sig long"),
        "sets",
    )
    holders = Holders(docs, described)
    often = (
        described.where("n = -1").groupBy("sig").agg(F.sum("doc_id").alias("number"))
        .orderBy(F.desc("number"), "sig").limit(ORDERED).toArrow()
    )
    common, numbers = (often.column(i).to_numpy() for i in range(2))
    common = common.view(np.uint64)
    order = np.argsort(common)
    index = docs.select("text").mapInArrow(
        _prefixes(common[order], numbers[order], percent), "shingle long, sig long, n int, at int, asks int"
    )
    lists = written(
        index.repartition("shingle").sortWithinPartitions("shingle", "sig").mapInArrow(_shared(percent), LISTS), "lists"
    )
    stars = (
        lists.where("needs > 0").groupBy(F.col("first").alias("a"), F.col("sig").alias("b"))
        .agg(F.count(F.lit(1)).alias("met"), F.min("needs").alias("needs")).where("met >= needs")
    )
    links = _verified(stars, holders, percent)
    roots = components(links)
    rooted = lists.join(by_shuffle(roots.withColumnRenamed("node", "sig")), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig")
    )
    rooted = written(rooted, "rooted")
    mixed = rooted.groupBy("shingle").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("size")
    )
    open_lists = rooted.join(by_shuffle(mixed.where("x <> y").select("shingle", "size")), "shingle").drop("first", "needs")
    rest = (
        open_lists.where(F.col("size") <= SHORT).drop("size")
        .repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_pairs(percent), PAIRS)
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.min("asks").alias("asks"))
        .where("met >= asks")
    )
    links = links.unionByName(_verified(rest, holders, percent)).unionByName(
        _linked_in_long_lists(open_lists.where(F.col("size") > SHORT), holders, percent)
    )
    roots = components(links)

    rows = described.where("n >= 0")
    classes = rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least")).join(
        by_shuffle(roots.withColumnRenamed("node", "sig")), "sig", "left"
    ).withColumn("root", F.coalesce("root", "sig"))
    least = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(by_shuffle(least), "root").select("sig", "component")
    return rows.join(by_shuffle(named), "sig", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


@clash_free("__doc", "__n")
def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: of each group the smallest id stays, with its first row.

    Rows that share an id and a text are one document; rows that share an id only are kept or dropped
    together. Rows without a component (no text, no id) stay.
    """
    groups = near_duplicates(docs, percent)
    stay = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("__doc")).distinct()
    kept = docs.join(by_shuffle(stay), F.col("doc_id").eqNullSafe(F.col("__doc")), "left_semi")
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    return kept.withColumn("__n", F.row_number().over(same)).where("__n = 1").select(docs.columns)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP9_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
classes AS (SELECT min(doc_id) AS a, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
tokens AS (SELECT a, len(s) AS n, unnest(s) AS t FROM classes),
near AS (
  SELECT x.a AS a, y.a AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.a < y.a
  GROUP BY x.a, y.a, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT a, a AS r FROM classes UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.a),
roots AS (SELECT a, min(r) AS r FROM reach GROUP BY a),
named AS (SELECT c.s, r.r FROM classes c JOIN roots r USING (a))
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(n.r, d.doc_id) AS component_id
FROM sets d LEFT JOIN named n ON list_sort(d.s) = n.s
"""
