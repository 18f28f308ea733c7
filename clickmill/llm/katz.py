"""Katz backoff: Good-Turing discounted bigram and word counts with exactly normalised backoff weights.

Tokens are words and one end per text. A word seen r times keeps d_r * r of its count, for r up to 5 by the
Good-Turing estimate (or all of it where the estimate is not between 0 and 1); what words lose, or one
count if they lose nothing, is the probability of a word never seen. A word w after v, seen r times, has
d_r * r / (c(v) + 1/2); else it has a(v) * p(w), where a(v) is what v's followers leave, divided by the
probability of all words that do not follow v, so that each history sums to one over the vocabulary and
the unseen word. Every history keeps back half a count, since followers above 5 are not discounted. After a
word never seen p(w) holds as it is.

All texts are counted and scored by joins, whatever the corpus's size:
* words are counted, combined in each task; the `HEAD` commonest go to every task as a fixed-size table,
* pairs of two of the `TOP` commonest words, the only ones that can be very frequent, are counted in
  each task and looked up in a table of at most TOP * TOP numbers,
* all other pairs go once, compressed, to the bucket of their first word (pairs after a top word: of
  both), where the counts from training texts meet the occurrences of all texts,
* buckets return sums per text, sums per history, and what needs another word's count: rare followers
  and pairs never seen in training. These meet the words' table and the histories' table in joins; the
  weights of the top words, at most TOP and the start's, go to every task instead.

Nulls: a null text is empty and has one token, its end; a null id is carried and its fold is that of empty
text. Rows are scored one by one, repeated ones alike. Texts of any length are read whole. Without
training rows every token is unseen: the model then has one class of words and every score is 0, and so is
the base. An empty table gives an empty result. Other columns are not read and cannot clash.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import documents, fold, partitions, written
from clickmill.llm.text import hashed_words, mix

FOLDS = 10
HEAD = 400_000
TOP = 1024
GT = 5  # counts up to this are discounted
KEPT_BACK = 0.5
BLOCK = 1_000_000  # tokens that a task sends together
BUCKET = 4_000_000  # tokens a bucket is meant to hold
END = np.uint64(1)  # the end mark among the words' hashes
_RARE = np.uint64(1 << 63)  # marks a hash among keys; other keys are ranks in the head
_START = np.uint64(1 << 41)  # the key of a text's start, which is a history and no token


def token_stream(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, tokens) with the end mark behind every text's words."""
    for first, bounds, words in hashed_words(column):
        lengths = np.diff(bounds)
        stops = np.cumsum(lengths + 1)
        tokens = np.empty(len(words) + len(lengths), np.uint64)
        ends = np.zeros(len(tokens), bool)
        ends[stops - 1] = True
        tokens[ends] = END
        tokens[~ends] = words >> np.uint64(1) | np.uint64(2)  # never the mark, and room for one bit
        yield first, np.concatenate([[0], stops]), tokens


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted():
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    for batch in batches:
        for _, _, tokens in token_stream(batch.column(0)):
            held.append(tokens)
            size += len(tokens)
            if size >= 4 * BLOCK:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """d_1 .. d_GT from the numbers of types seen 1 .. GT + 1 times (Katz's form); 1 where there is no use."""
    n = [of_counts.get(r, 0) for r in range(1, GT + 2)]
    out = np.ones(GT)
    if not n[0] or not all(n):
        return out
    cut = (GT + 1) * n[GT] / n[0]
    for r in range(1, GT + 1):
        d = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) if cut < 1 else 1.0
        out[r - 1] = d if 0 < d < 1 else 1.0
    return out


class Words:
    """The head table and the word probabilities."""

    def __init__(self, words, counts, total: int, types: int, texts: int, of_counts: dict[int, int]):
        """`texts`: training texts, and so the count of the end mark and of the start as a history."""
        rank = np.lexsort((words, -counts))
        self.total, self.types, self.texts = total, types, texts
        order = np.argsort(words[rank])
        self.words, self.rank, self.counts = words[rank][order], order.astype(np.int64), counts[rank]
        self.keep = discounts(of_counts)
        lost = sum((1 - self.keep[r - 1]) * r * of_counts.get(r, 0) for r in range(1, GT + 1))
        self.scale = 1.0 if lost > 0 else total / (total + 1)
        self.unseen = (lost if lost > 0 else 1.0) / (total + (0 if lost > 0 else 1)) if total else 1.0

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """Rank by count of each token in the head; -1 for all others."""
        if not len(self.words):
            return np.full(len(tokens), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, self.rank[at], -1)

    def p(self, counts: np.ndarray) -> np.ndarray:
        counts = np.asarray(counts)
        kept = self.keep[np.clip(counts, 1, GT) - 1] * (counts <= GT) + (counts > GT)
        return np.where(counts > 0, kept * counts * self.scale / max(self.total, 1), self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(counts) + 0.1) / (self.total + 0.1 * (self.types + 1)))


def _top_places(words: Words, bounds: np.ndarray, tokens: np.ndarray):
    """(rank or -1 of each token, rank or TOP of each history that is a top one or the start, else -1)"""
    after = words.ranks(tokens)
    before = np.concatenate([[-1], after[:-1]])
    before[before >= TOP] = -1
    before[bounds[:-1]] = TOP
    return after, before


def _top_pairs(words: Words):
    """Counts of pairs of two top words, or of the start and a top word, in training texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((TOP + 1) * TOP, np.int64)
        for batch in batches:
            for _, bounds, tokens in token_stream(batch.column(0)):
                after, before = _top_places(words, bounds, tokens)
                both = (before >= 0) & (after >= 0) & (after < TOP)
                np.add.at(sums, before[both] * TOP + after[both], 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])

    return rows


def _packed(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(held: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(held), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


CLASSES = [f"s{r}" for r in range(1, GT + 2)]
# kind 0: part of a text's sums; 1: of a history's; 2: a rare word after a history; 3: a pair never seen in
# training; 4: numbers of pairs by count. `x`: base, follower probability or log probability; `y`: score.
_FIELDS = [("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64())] + [
    ("known", pa.int64()), ("v", pa.int64()), ("w", pa.int64()), ("x", pa.float64()), ("y", pa.float64()),
    *((c, pa.int64()) for c in CLASSES),
]
FOUND = pa.schema(_FIELDS)
SENT = pa.schema([("bucket", pa.int32()), ("pv", pa.binary()), ("pw", pa.binary()), ("at", pa.binary()), *_FIELDS])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _batch(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema],
        schema=schema,
    )


def _classes(counts: np.ndarray, at: np.ndarray, size: int, most: int = GT) -> dict[str, np.ndarray]:
    return {c: np.bincount(at[counts == r], minlength=size) for r, c in enumerate(CLASSES[:most], 1)}


def _send(words: Words, top: np.ndarray, buckets: int):
    """What top words say of each text, and all other pairs by bucket. `top`: counts of top pairs."""
    history = np.zeros(TOP + 1)
    history[: min(TOP, len(words.counts))] = words.counts[:TOP]
    history[TOP] = words.texts
    base, end_base = words.base(words.counts), float(words.base(words.texts))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def send():
            v, w, row = (np.concatenate(x) for x in zip(*held))
            spread = np.where((v < TOP) | (v == _START), mix(mix(v) ^ w), mix(v))
            bucket = (spread % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((w, v, bucket))
            v, w, row, bucket = v[order], w[order], row[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(v))):
                packed = {"pv": [_packed(v[a:b])], "pw": [_packed(w[a:b])], "at": [_packed(row[a:b])]}
                yield _batch(SENT, 1, bucket=[int(bucket[a])], **packed)

        for batch in batches:
            ids, docs = batch.column(1).to_numpy(), batch.column(2)
            train = batch.column(3).to_numpy(zero_copy_only=False).astype(np.uint64)
            for first, bounds, tokens in token_stream(batch.column(0)):
                n = len(bounds) - 1
                at = np.repeat(np.arange(n), np.diff(bounds))
                after, before = _top_places(words, bounds, tokens)
                end = tokens == END
                told = (after >= 0) | end
                value = np.full(len(tokens), end_base)
                value[~end & told] = base[after[~end & told]]
                more = np.zeros(len(tokens))
                counted = (before >= 0) & (history[before] > 0)
                more[counted] -= np.log10(history[before[counted]] + KEPT_BACK)
                pair = (before >= 0) & (after >= 0) & (after < TOP)
                seen = np.zeros(len(tokens), np.int64)
                seen[pair] = top[before[pair] * TOP + after[pair]]
                more[seen > GT] += np.log10(seen[seen > GT])
                known = (after >= 0) | (end & (words.texts > 0))
                yield _batch(
                    SENT,
                    n,
                    bucket=(ids[first : first + n] % buckets).astype(np.int32),
                    kind=np.zeros(n, np.int32),
                    row=ids[first : first + n],
                    doc_id=docs.slice(first, n),
                    n=np.diff(bounds),
                    known=np.bincount(at[known], minlength=n),
                    x=np.bincount(at[told], value[told], n),
                    y=np.bincount(at, more, n),
                    **_classes(seen, at, n),
                )
                rest = seen == 0
                keys = np.where(after >= 0, after.astype(np.uint64), tokens | _RARE)
                v = np.concatenate([[_START], keys[:-1]])
                v[bounds[:-1]] = _START
                place = ids[first : first + n].astype(np.uint64) * np.uint64(2) + train[first : first + n]
                held.append((v[rest], keys[rest], place[at[rest]]))
                size += int(rest.sum())
                if size >= BLOCK:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()

    return rows


def _meet(words: Words, top: np.ndarray):
    """One bucket per task: counts of its pairs from training texts, and what they say of all texts."""
    history = np.zeros(TOP)
    history[: min(TOP, len(words.counts))] = words.counts[:TOP]
    chance = words.p(words.counts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            texts = batch.filter(batch.column("pv").is_null())
            if texts.num_rows:
                yield texts.select(FOUND.names)
            for held in zip(*(batch.column(c) for c in ("pv", "pw", "at"))):
                if held[0].is_valid:
                    parts.append(tuple(_unpacked(x.as_py()) for x in held))
        if not parts:
            return
        v, w, place = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        order = np.lexsort((w, v))
        v, w, place = v[order], w[order], place[order]
        train, row = place & np.uint64(1), (place >> np.uint64(1)).astype(np.int64)
        del place, order
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        start = np.flatnonzero(new)
        count = np.add.reduceat(train.astype(np.int64), start)
        pair = np.cumsum(new) - 1
        pv, pw = v[start], w[start]
        newer = np.ones(len(pv), bool)
        newer[1:] = pv[1:] != pv[:-1]
        hist = np.cumsum(newer) - 1
        hv = pv[newer]
        total = np.bincount(hist, count, len(hv))
        is_top = (hv < TOP) | (hv == _START)
        total[is_top] = np.where(
            hv[is_top] == _START, words.texts, history[np.minimum(hv[is_top], TOP - 1).astype(np.int64)] if TOP else 0
        )
        yield _batch(
            FOUND, 1, kind=[4], **{c: [int((count == r).sum())] for r, c in enumerate(CLASSES, 1)}
        )
        # sums per text
        seen, of = count[pair], hist[pair]
        more = np.where(seen > GT, np.log10(np.maximum(seen, 1)), 0.0)
        own = ~is_top[of]
        more -= np.where(own & (total[of] > 0), np.log10(total[of] + KEPT_BACK), 0.0)
        rare = (hv[of] & _RARE) > 0
        names, at = np.unique(row, return_inverse=True)
        yield _batch(
            FOUND,
            len(names),
            kind=np.zeros(len(names), np.int32),
            row=names,
            known=np.bincount(at[rare & (total[of] > 0)], minlength=len(names)),
            x=np.bincount(at[rare], words.base(total[of[rare]]), len(names)),
            y=np.bincount(at, more, len(names)),
            **_classes(seen, at, len(names)),
        )
        # pairs never seen in training
        headed = (pw & _RARE) == 0
        lost = np.flatnonzero(seen == 0)
        if len(lost):
            at = pair[lost]
            yield _batch(
                FOUND,
                len(lost),
                kind=np.full(len(lost), 3, np.int32),
                row=row[lost],
                v=pa.array(hv[of[lost]].view(np.int64), mask=total[of[lost]] == 0),
                w=pa.array(pw[at].view(np.int64), mask=headed[at]),
                x=pa.array(np.log10(chance[np.where(headed[at], pw[at], 0).astype(np.int64)]), mask=~headed[at])
                if len(chance)
                else pa.nulls(len(lost), pa.float64()),
            )
        # histories that such pairs ask for, and their followers
        asked = is_top.copy()
        asked[of[lost]] = True
        asked &= total > 0
        live = (count > 0) & asked[hist]
        keep = np.flatnonzero(asked)
        direct = live & headed
        yield _batch(
            FOUND,
            len(keep),
            kind=np.ones(len(keep), np.int32),
            v=hv[keep].view(np.int64),
            x=np.bincount(hist[direct], chance[pw[direct].astype(np.int64)], len(hv))[keep]
            if len(chance)
            else np.zeros(len(keep)),
            **{c: x[keep] for c, x in _classes(count[live], hist[live], len(hv)).items()},
        )
        apart = np.flatnonzero(live & ~headed)
        yield _batch(
            FOUND,
            len(apart),
            kind=np.full(len(apart), 2, np.int32),
            v=pv[apart].view(np.int64),
            w=pw[apart].view(np.int64),
        )

    return rows


def score(docs: DataFrame, held_out) -> DataFrame:
    """`doc_id`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of every row; those for which
    the column `held_out` is true are not learned from."""
    spark = docs.sparkSession
    rows = docs.select("text", F.col("doc_id").cast("long"), (~held_out).alias("train"))
    learned = rows.where("train").select("text")
    counts = written(
        learned.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    few = [F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, GT + 2)]
    told = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"), *few).first()
    texts = counts.where(F.col("word") == int(END)).select("n").collect()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    words = Words(
        head["word"].to_numpy().view(np.uint64),
        head["n"].to_numpy(),
        told["total"] or 0,
        told["types"],
        texts[0]["n"] if texts else 0,
        {r: told[f"n{r}"] for r in range(1, GT + 2)},
    )
    pairs = learned.mapInArrow(_top_pairs(words), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    top = np.zeros((TOP + 1) * TOP, np.int64)
    top[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    buckets = max(partitions(spark), words.total // BUCKET)
    sent = (
        rows.select("text", F.monotonically_increasing_id().alias("row"), "doc_id", "train")
        .mapInArrow(_send(words, top, buckets), _ddl(SENT))
        .repartitionById(buckets, "bucket")
    )
    found = written(sent.drop("bucket").mapInArrow(_meet(words, top), _ddl(FOUND)), "found")

    types = found.where("kind = 4").agg(*[F.sum(c).alias(c) for c in CLASSES]).first()
    keep = discounts({r: (types[c] or 0) + int((top == r).sum()) for r, c in enumerate(CLASSES, 1)})
    # probabilities of rare words
    kept = F.element_at(F.array(*[F.lit(float(d)) for d in words.keep]), F.least(F.col("n"), F.lit(GT)).cast("int"))
    p = F.when(F.col("n") > GT, F.lit(1.0)).otherwise(kept) * F.col("n") * words.scale / max(words.total, 1)
    rare = counts.select(F.col("word").bitwiseOR(F.lit(-(2**63))).alias("w"), p.alias("p"))
    # histories
    table = top.reshape(TOP + 1, TOP)
    chance = np.append(words.p(words.counts[:TOP]), np.zeros(TOP))[:TOP]
    used = [i for i in range(TOP + 1) if table[i].any()]
    own = [
        (int(_START) if i == TOP else i, float(((table[i] > 0) * chance).sum()))
        + tuple(int((table[i] == r).sum()) for r in range(1, GT + 1))
        for i in used
    ]
    names = CLASSES[:GT]
    made = spark.createDataFrame(own, "v long, x double, " + ", ".join(f"{c} long" for c in names))
    after = found.where("kind = 2").select("v", "w").join(rare, "w").groupBy("v").agg(F.sum("p").alias("x"))
    histories = (
        found.where("kind = 1").select("v", "x", *names).unionByName(made).unionByName(after, allowMissingColumns=True)
        .groupBy("v").agg(F.sum("x").alias("x"), *[F.sum(c).alias(c) for c in names])
    )
    left = F.lit(KEPT_BACK)
    for r, c in enumerate(names, 1):
        left = left + F.coalesce(F.col(c), F.lit(0)) * float(r * (1 - keep[r - 1]))
    back = F.log10(left) - F.log10(F.greatest(1 - F.coalesce("x", F.lit(0.0)), F.lit(float(words.unseen))))
    weights = written(histories.select("v", back.alias("back")), "weights")
    lost = found.where("kind = 3").select("row", "v", "w", "x")
    priced = lost.where("x IS NOT NULL").select("row", "v", "x").union(
        lost.where("x IS NULL").join(rare, "w", "left")
        .select("row", "v", F.log10(F.coalesce("p", F.lit(float(words.unseen)))))
    )
    # top histories have the most pairs, but are at most TOP and the start: their weights go to every task
    is_top = F.coalesce(F.col("v").between(0, TOP - 1) | (F.col("v") == int(_START)), F.lit(False))
    backed = priced.where(is_top).join(F.broadcast(weights.where(is_top)), "v", "left").unionByName(
        priced.where(~is_top).join(weights.where(~is_top), "v", "left")
    )
    tail = backed.groupBy("row").agg(F.sum(F.col("x") + F.coalesce("back", F.lit(0.0))).alias("y"))
    sums = found.where("kind = 0").select("row", "doc_id", "n", "known", "x", "y", *names).unionByName(
        tail, allowMissingColumns=True
    ).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n", "known", "x", "y", *names)]
    )
    total = F.col("y")
    for r, c in enumerate(names, 1):
        total = total + F.col(c) * float(np.log10(keep[r - 1] * r))
    return sums.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        F.col("x").alias("base_score"),
        total.alias("score"),
    )


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fold(F.col("doc_id"), FOLDS) == 0
    return score(documents(spark, sf_dir), out).withColumn("held_out", out)
