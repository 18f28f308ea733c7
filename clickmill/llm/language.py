"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are its overlapping runs of 2, 3 and 4 bytes (A-Z as a-z), hashed into buckets. Their
embeddings are averaged and go through a linear layer; both are trained by stochastic gradient descent in
numpy, from a bounded sample of labelled rows, whole texts. The sample is `SAMPLE` rows dealt out evenly to
the languages, at least `LEAST` of each; in every language the rows first by the hash of (id, text) are taken,
equal rows once, until the language's part of `ENTRIES` different subwords is reached, one row in any case.
On a fifth of the sample, which training does not see, a temperature is fitted to the scores, and the score
that nearly all right answers reach becomes the bound of rejection. Tasks get the embeddings and the layer,
or, with few languages, their product: averaging and layer are linear.

Prediction reads whole texts; null texts and texts without a letter are `und`, with score 0. A text
below the bound keeps its best language, and `accepted` is false. Null languages teach nothing; without
any language every text is `und`. Every language with a text of two bytes or more is learned, however many
there are; one with shorter texts only has no subword to learn from. Null ids are carried, repeated rows are separate. Other columns are not read and cannot clash. An empty table gives an
empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import documents, fold, partitions
from clickmill.llm.text import _LOWER, buffers

BUCKETS = 1 << 16
WIDTH = 16
SAMPLE = 4000
LEAST = 20
ENTRIES = 1 << 24
PULL = 60  # how strongly a text's error moves its subwords' embeddings
STEP = 1 << 19  # bytes looked at together
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_GRAMS = (2, 3, 4)


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """For each length, the bucket of the run that starts at each byte."""
    low = _LOWER[data].astype(np.uint32)
    out, rolled = [], low.copy()
    for n in range(2, max(_GRAMS) + 1):
        if len(low) < n:
            out.append(np.empty(0, np.uint32))
            continue
        rolled = rolled[: len(low) - n + 1] * np.uint32(0x01000193) ^ low[n - 1 :]
        h = rolled * np.uint32(0x9E3779B1) + np.uint32(n * 0x7F4A7C15 & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(16))
    return out


def histogram(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text's subwords, ascending, and the share of each."""
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data), STEP):  # a run belongs to the piece in which it starts
        part = data[start : start + STEP + max(_GRAMS) - 1]
        for grams in subwords(part):
            counts += np.bincount(grams[:STEP], minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.uint16), (counts[found] / max(1, counts.sum())).astype(np.float32)


def _chosen(rows: DataFrame) -> tuple[list[str], list[int]]:
    """(languages, the last hash that is in each one's sample). Only hashes and sizes are shuffled. A language
    is cut by hash, and each cut passes on no more rows than the language's sample has."""
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return [], []
    each, entries = max(LEAST, SAMPLE // len(langs)), ENTRIES // len(langs)
    size = F.least(F.octet_length("text").cast("long") * len(_GRAMS), F.lit(BUCKETS))
    cut = F.pmod(F.xxhash64("key"), F.lit(partitions(rows.sparkSession))).cast("int")
    inside = Window.partitionBy("lang", "cut").orderBy("key")
    keys = (
        rows.groupBy("lang", "key").agg(F.max(size).alias("size")).withColumn("cut", cut)
        .withColumn("n", F.row_number().over(inside)).where(F.col("n") <= each).drop("n", "cut")
    )
    first = Window.partitionBy("lang").orderBy("key")
    so_far = F.sum("size").over(first.rowsBetween(Window.unboundedPreceding, 0))
    taken = (
        keys.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each)
        .withColumn("so_far", so_far).where((F.col("n") == 1) | (F.col("so_far") <= entries))
        .groupBy("lang").agg(F.max("key").alias("key"))
    )
    last = {r["lang"]: r["key"] for r in taken.collect()}
    return langs, [last[lang] for lang in langs]


def _sampled(rows: DataFrame) -> tuple[list[str], np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(languages, class of each sampled row, its subwords' histogram) from rows with text and language."""
    rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("text") >= min(_GRAMS))).select(
        "lang", F.xxhash64("doc_id", "text").alias("key"), "text"
    )
    langs, last = _chosen(rows)
    if not langs:
        return [], np.empty(0, np.int64), []
    spark = rows.sparkSession
    bounds = spark.createDataFrame(list(zip(langs, last, range(len(langs)))), "lang string, last long, class int")

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # no more than the sample: an equal row is passed on once
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            out: list[list] = [[], [], [], []]
            for i, (label, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if (label, key) not in seen:
                    seen.add((label, key))
                    found, share = histogram(data[offsets[i] : offsets[i + 1]])
                    for column, value in zip(out, (label, key, found.tobytes(), share.tobytes())):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(out, kinds)], ["class", "key", "grams", "share"]
            )

    table = (
        rows.join(F.broadcast(bounds), "lang").where(F.col("key") <= F.col("last"))  # a row per language
        .select("class", "key", "text").mapInArrow(some, "class int, key long, grams binary, share binary")
        .dropDuplicates(["class", "key"]).toArrow()
    )
    classes, keys = table["class"].to_numpy().astype(np.int64), table["key"].to_numpy()
    order = np.lexsort((keys, classes))  # the order in which rows arrive must not matter
    texts = [
        (np.frombuffer(table["grams"][int(i)].as_py(), np.uint16), np.frombuffer(table["share"][int(i)].as_py(), np.float32))
        for i in order
    ]
    return langs, classes[order], texts


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: DataFrame, epochs: int = 6, rate: float = 0.5) -> dict:
    """The model: languages, a row per bucket (class values, or the embedding, which `layer` turns into class
    values), temperature, bound of rejection."""
    langs, classes, texts = _sampled(rows)
    if not len(classes):
        return {"langs": [], "table": np.zeros((BUCKETS, 1), np.float32), "layer": None, "heat": 1.0, "bound": 0.0}
    draw = np.random.default_rng(11)
    embedding = draw.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(langs)), np.float32)
    order = draw.permutation(len(classes))
    kept_back = order[: len(order) // 5] if len(order) >= 50 else order
    rest = order[len(order) // 5 :] if len(order) >= 50 else order
    batch, steps, done = 32, epochs * (len(rest) // 32 + 1), 0

    def averaged(at: np.ndarray) -> np.ndarray:
        return np.array([np.einsum("i,ij->j", texts[i][1], embedding[texts[i][0]]) for i in at])

    for _ in range(epochs):
        rest = draw.permutation(rest)
        for start in range(0, len(rest), batch):
            at = rest[start : start + batch]
            hidden = averaged(at)
            error = softmax(np.einsum("ij,jk->ik", hidden, layer))
            error[np.arange(len(at)), classes[at]] -= 1
            now = rate * (1 - done / steps)
            back = np.einsum("ik,jk->ij", error, layer)
            layer -= now * np.einsum("ij,ik->jk", hidden, error) / len(at) * 10
            for i, step in zip(at, (-now * PULL / len(at) * 10 * back).astype(np.float32)):
                embedding[texts[i][0]] += texts[i][1][:, None] * step  # a text's buckets are all different
            done += 1
    values = np.einsum("ij,jk->ik", averaged(kept_back), layer)
    few = len(langs) <= WIDTH
    table = np.einsum("ij,jk->ik", embedding, layer).astype(np.float32) if few else embedding
    own = np.arange(len(kept_back))
    losses = {}
    for heat in np.geomspace(0.05, 20, 60):
        losses[heat] = -np.log(softmax(values / heat)[own, classes[kept_back]] + 1e-12).mean()
    heat = min(losses, key=losses.get)
    sure = softmax(values / heat)
    right = sure.argmax(1) == classes[kept_back]
    bound = float(np.quantile(sure.max(1)[right], 0.01)) if right.any() else 0.0
    return {"langs": langs, "table": table, "layer": None if few else layer, "heat": float(heat), "bound": bound}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """`doc_id`, `lang_pred`, `score`, `accepted` of every document."""
    langs, table, layer, heat, bound = (model[k] for k in ("langs", "table", "layer", "heat", "bound"))

    def values(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean table rows of the texts, read whole; runs do not reach over a row's end."""
        sums, counts = np.zeros((len(offsets) - 1, table.shape[1])), np.zeros(len(offsets) - 1)
        for n, grams in zip(_GRAMS, subwords(data)):
            found = table[grams]
            ends = np.maximum(offsets[1:] - n + 1, offsets[:-1])
            sums_so_far = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(found, axis=0, dtype=np.float64)])
            start = np.minimum(offsets[:-1], len(found))
            stop = np.maximum(np.minimum(ends, len(found)), start)
            sums += sums_so_far[stop] - sums_so_far[start]
            counts += stop - start
        return sums / np.maximum(counts, 1)[:, None]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            found = np.zeros((len(offsets) - 1, table.shape[1]))
            letters = np.zeros(len(offsets) - 1, bool)
            row = 0
            while row < len(offsets) - 1:
                until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, "right")) - 1)
                part, bounds = data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]
                if len(part) <= 4 * STEP:
                    found[row:until] = values(part, bounds)
                else:  # one long text, in overlapping pieces
                    pieces = [
                        (values(p, np.array([0, len(p)]))[0], len(p))
                        for i in range(0, len(part), STEP)
                        for p in [part[i : i + STEP + max(_GRAMS) - 1]]
                    ]
                    weight = np.array([n for _, n in pieces], float)
                    found[row] = (np.array([v for v, _ in pieces]) * weight[:, None]).sum(0) / weight.sum()
                marks = np.concatenate([[0], np.cumsum(_LETTER[part])])
                letters[row:until] = marks[bounds[1:]] > marks[bounds[:-1]]
                row = until
            for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)):
                letters[i] = any(c.isalpha() for c in batch.column(1)[int(i)].as_py() or "")
            sure = softmax((found if layer is None else np.einsum("ij,jk->ik", found, layer)) / heat)
            best = sure.argmax(1)
            known = letters & bool(langs)
            names = [langs[b] if k else "und" for b, k in zip(best, known)]
            score = np.where(known, sure.max(1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(known & (score >= bound))],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, lang_pred string, score double, accepted boolean"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", "text", "lang"))
    return predict(docs, model).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
