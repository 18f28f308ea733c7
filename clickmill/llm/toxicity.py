"""Toxicity by class-conditional Kneser-Ney models.

Each class has discounted word counts (modified Kneser-Ney: one discount each for counts of one, two and
more). What the discounts leave goes to a distribution that the classes share: continuation counts, the
number of different words that a word follows, taken where both classes agree, the smaller of the two,
and at least one. A rare expression that one class has by chance thus weighs little, one that it uses
often weighs much. Ratios count as far as they exceed a margin: common words differ a little between any
two samples, and that must not add up along a text. A text's score compares its log-likelihoods under both
classes, divided by a power of its number of words, which keeps texts of all lengths on one scale; a logistic
curve, fitted on sampled rows that the counts did not see and weighed by the labels' shares, turns it into 0
to 1. Margin and power are those of `MARGINS` and `POWERS` that have the least loss where each third of the
sampled rows is scored by the counts of the other two.

A word that the sample does not have is compared by its first `STEM` bytes, under models of their own.
Words are runs of ASCII letters, digits and non-ASCII characters, A-Z as a-z. Labels are learned from at
most `SAMPLE` rows per class, chosen among the labelled rows by the hash of the id, then of the text, and read
whole, as far as their texts together hold at most `SAMPLE_BYTES` per class (the first row always counts). They are
counted by Spark: the driver gets a row per different word, and then a row of sums per sampled text. Rows that agree in id, text and label are learned from once. The classes need not be of one size: each
has its own counts, and the curve weighs its rows by the labels' shares. Every whole text is scored. The model
is a table of the sample's words.

Nulls: a null or empty text has the score of no evidence at all. Labels that are null, or not 0 or 1, teach
nothing; several labels of one id are separate rows. Without rows of both classes every score is the
share of label 1 (0 without labels). Null ids are carried. Further columns are carried along; `score`
replaces one of the same name. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import documents, fold, schema_of, small_batches, written
from clickmill.llm.text import hashed_words, mix, row_of

SAMPLE = 4000
SAMPLE_BYTES = 16_000_000
LEVEL = 0.7
MARGINS = (0.0, 1.0, 2.0, 3.0, 4.0)  # a word says nothing unless one class uses it more than e**margin times as much
POWERS = (0.5, 0.0, 1.0)
THIRDS = 3
STEM = 4
_NEXT = np.uint64(0x9FB21C651E98DF25)


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """`toxic`, `part`, `text` of the sampled rows; at most `2 * sample` keys are sent to every task."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    texts = docs.where(F.col("text").isNotNull()).select(
        "doc_id", "text", F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("size")
    )
    keys = texts.select("doc_id", "key", "size").join(known, "doc_id").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("key")]
    chosen = [keys.where(F.col("toxic") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    first = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.sum("size").over(first)  # over at most `sample` rows a class
    within = chosen[0].union(chosen[1]).withColumn("held", held)
    within = within.where((F.col("held") <= SAMPLE_BYTES) | (F.col("held") == F.col("size")))
    ids = F.broadcast(within.select("doc_id", "key", "toxic"))
    rows = texts.join(ids, ["doc_id", "key"]).groupBy("doc_id", "key", "toxic").agg(F.first("text").alias("text"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(THIRDS)).cast("int").alias("part")
    return rows.select(F.col("toxic").cast("int"), part, "text")


CELLS = [(c, p) for c in (0, 1) for p in range(THIRDS)]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (stem, word, pair, cell, n): how often a word follows another, by class and third."""
    for batch in batches:
        toxic, part = (batch.column(c).to_numpy().astype(np.uint64) for c in ("toxic", "part"))
        cells = toxic * np.uint64(THIRDS) + part
        for stem in (0, STEM):
            for first, bounds, hashes in hashed_words(batch.column("text"), True, stem):
                if not len(hashes):
                    continue
                before = np.empty_like(hashes)
                before[1:] = hashes[:-1]
                before[bounds[:-1][np.diff(bounds) > 0]] = 1  # a text's first word follows a mark of its own
                pair = mix(mix(before ^ _NEXT) + hashes)
                cell = cells[first + row_of(bounds)]
                _, at, n = np.unique(mix(pair ^ cell), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), stem > 0)), pa.array(hashes[at].view(np.int64)),
                        pa.array(pair[at].view(np.int64)), pa.array(cell[at].astype(np.int32)), pa.array(n.astype(np.int64)),
                    ],
                    ["stem", "word", "pair", "cell", "n"],
                )


def _counts(sampled: DataFrame) -> DataFrame:
    """`stem`, `word`, its counts `n0` ... by class and third, and in `f0` ... how many different words it
    follows in each class without each third."""
    found = sampled.mapInArrow(_pairs, "stem boolean, word long, pair long, cell int, n long")
    in_cell = lambda i: F.col("cell") == i
    pairs = found.groupBy("stem", "word", "pair").agg(
        *[F.sum(F.when(in_cell(i), F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(CELLS))]
    )
    follows = []
    for c, third in CELLS:
        there = [F.col(f"n{i}") > 0 for i, (d, p) in enumerate(CELLS) if d == c and p != third]
        follows.append(F.count_if(there[0] | there[1]).cast("int").alias(f"f{len(follows)}"))
    return pairs.groupBy("stem", "word").agg(
        *[F.sum(f"n{i}").cast("int").alias(f"n{i}") for i in range(len(CELLS))], *follows
    )


def _discounts(counts: np.ndarray) -> np.ndarray:
    n = [max(1, int((counts == i).sum())) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)], 0.1, [0.95, 1.9, 2.85])


def kneser_ney(
    words: np.ndarray, counts: list[np.ndarray], follows: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, float]:
    """(words, their log-likelihood ratios, the ratio of a word never seen) from each word's count and
    continuation count in ordinary and toxic texts. `words` is sorted."""
    seen = counts[0] + counts[1] > 0
    words, counts, follows = words[seen], [c[seen] for c in counts], [f[seen] for f in follows]
    scale = [max(1, f.sum()) / max(1, follows[0].sum()) for f in follows]
    shared = np.maximum(np.minimum(follows[0] / scale[0], follows[1] / scale[1]), 1.0)
    shared /= shared.sum() + 1  # the 1 is for words never seen
    logs, new = [], []
    for count in counts:
        total = max(1, count.sum())
        off = _discounts(count)[np.clip(count, 1, 3) - 1] * (count > 0)
        spare = off.sum() / total
        logs.append(np.log((count - off) / total + spare * shared))
        new.append(np.log(max(spare, 1e-9)))
    return words, logs[1] - logs[0], float(new[1] - new[0])


def _beyond(ratio, margin: float):
    return np.sign(ratio) * np.maximum(np.abs(ratio) - margin, 0)


def _sums(ratio: np.ndarray, bounds: np.ndarray, margin: float) -> np.ndarray:
    """Each row's sum of what its words' ratios exceed the margin by."""
    return np.bincount(row_of(bounds), _beyond(ratio, margin), len(bounds) - 1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve, by Newton steps with a little shrinkage."""
    a, b = 0.0, 0.0
    features = np.stack([x, np.ones_like(x)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        slope = features @ (weight * (y - p)) - 1e-3 * np.array([a, b])
        bend = (features * (weight * p * (1 - p))) @ features.T + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a, b


class Model:
    """Ratios of words and stems, margin and power, and the curve from evidence to score."""

    def __init__(self, words, stems, slope: float, offset: float, margin: float = MARGINS[0], power: float = POWERS[0]):
        self.words, self.stems, self.slope, self.offset = words, stems, slope, offset
        self.margin, self.power = margin, power

    def ratios(self, hashes: np.ndarray, stems: np.ndarray) -> np.ndarray:
        """Each word's ratio, without the margin."""
        ratio = np.empty(len(hashes))
        rest = np.ones(len(hashes), bool)
        for (known, ratios, new), seen in ((self.words, hashes), (self.stems, stems)):
            at = np.minimum(np.searchsorted(known, seen[rest]), max(len(known) - 1, 0))
            found = known[at] == seen[rest] if len(known) else np.zeros(len(at), bool)
            ratio[rest] = np.where(found, ratios[at] if len(known) else 0.0, new)
            rest[rest] = ~found
        return ratio

    def summed(self, ratio: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.scaled(_sums(ratio, bounds, self.margin), np.diff(bounds))

    def scaled(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return sums / np.maximum(lengths, 1) ** self.power

    def evidence(self, hashes: np.ndarray, stems: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.summed(self.ratios(hashes, stems), bounds)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -30, 30)))


def _weights(y: np.ndarray, share: float) -> np.ndarray:
    return np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))


def _by_margin(ratio: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.stack([_sums(ratio, bounds, margin) for margin in MARGINS], 1)


def _chosen(folds: list[tuple["Model", np.ndarray, np.ndarray, np.ndarray]], share: float) -> tuple[float, float]:
    """`_least_loss` over folds (model, its ratios for unseen rows, bounds, labels)."""
    return _least_loss([(_by_margin(ratio, bounds), np.diff(bounds), y) for _, ratio, bounds, y in folds], share)


def _least_loss(folds: list[tuple[np.ndarray, np.ndarray, np.ndarray]], share: float) -> tuple[float, float]:
    """Margin and power with the least loss over folds of rows: (sums by row and margin, lengths, labels),
    the sums by a model that did not see these rows."""
    losses = {}
    for i, margin in enumerate(MARGINS):
        for power in POWERS:
            total = 0.0
            for sums, lengths, y in folds:
                model = Model(None, None, 1.0, 0.0, margin, power)
                x, weight = model.scaled(sums[:, i], lengths), _weights(y, share)
                model.slope, model.offset = logistic(x, y, weight)
                sure = np.where(y == 1, model.score(x), 1 - model.score(x))
                total -= float(weight @ np.log(np.maximum(sure, 1e-12)))
            losses[margin, power] = round(total, 9)
    return min(losses, key=losses.get)


def _evidence(sampled: DataFrame, models: list) -> DataFrame:
    """`toxic`, `part`, `n` words, and the sums by margin: `own` by the model without the row's third, `first`
    by the first model."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            words, stems = (hashed_words(batch.column("text"), True, stem) for stem in (0, STEM))
            for (first, bounds, hashes), (_, _, short) in zip(words, stems):
                held = slice(first, first + len(bounds) - 1)
                sums = np.zeros((2, len(bounds) - 1, len(MARGINS)))
                for third, model in enumerate(models):
                    if model is None or (third and not (part[held] == third).any()):
                        continue
                    ratio = model.ratios(hashes, short)
                    made = _by_margin(ratio, bounds)
                    mine = part[held] == third
                    sums[0, mine] = made[mine]
                    if not third:
                        sums[1] = made
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic").slice(first, len(bounds) - 1), pa.array(part[held]),
                        pa.array(np.diff(bounds)), *(pa.array(list(x), pa.list_(pa.float64())) for x in sums),
                    ],
                    ["toxic", "part", "n", "own", "first"],
                )

    return sampled.select("toxic", "part", "text").mapInArrow(
        rows, "toxic int, part int, n long, own array<double>, first array<double>"
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows given; two thirds of the sample are counted, one third calibrates."""
    small_batches(docs.sparkSession)
    shares = {r["toxic"]: r["count"] for r in labels.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    total = sum(shares.values())
    share = shares.get(1, 0) / total if total else 0.0
    nothing = np.empty(0, np.uint64), np.empty(0), 0.0
    odds = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if not min(shares.get(0, 0), shares.get(1, 0)):
        return Model(nothing, nothing, 0.0, odds)
    sampled = written(_sampled(docs, labels, sample), "sampled")
    found = _counts(sampled).toArrow()
    rows_of = {(r["toxic"], r["part"]) for r in sampled.groupBy("toxic", "part").count().collect()}
    tables = []
    for stem in (False, True):
        kind = found.filter(pc.equal(found.column("stem"), stem))
        words = kind.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        held = {c: kind.column(c).to_numpy()[order] for c in kind.column_names[2:]}
        tables.append((words[order], held))
    del found, kind

    def counted(third: int) -> Model | None:
        """The model of all rows but this third's."""
        if any(not any((c, p) in rows_of for p in range(THIRDS) if p != third) for c in (0, 1)):
            return None
        made = []
        for words, held in tables:
            counts = [sum(held[f"n{i}"] for i, (d, p) in enumerate(CELLS) if d == c and p != third) for c in (0, 1)]
            made.append(kneser_ney(words, counts, [held[f"f{CELLS.index((c, third))}"] for c in (0, 1)]))
        return Model(*made, 1.0, 0.0)

    model = counted(0)
    if model is None:
        return Model(nothing, nothing, 0.0, odds)
    seen = _evidence(sampled, [model, *(counted(third) for third in range(1, THIRDS))]).toArrow()
    toxic, part, n = (seen.column(i).to_numpy() for i in range(3))
    own, first = (np.array(seen.column(i).to_pylist()).reshape(-1, len(MARGINS)) for i in (3, 4))
    folds = []
    for third in range(THIRDS):
        rest = part == third
        if len(np.unique(toxic[rest])) == 2 and counted(third):
            folds.append((own[rest], n[rest], toxic[rest].astype(float)))
    if folds:
        model.margin, model.power = _least_loss(folds, share)
    rest = part == 0
    if len(np.unique(toxic[rest])) < 2:
        rest = np.ones(len(toxic), bool)
    x, y = model.scaled(first[rest][:, MARGINS.index(model.margin)], n[rest]), toxic[rest].astype(float)
    model.slope, model.offset = logistic(x, y, _weights(y, share))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with `score`."""
    carried = docs.drop("score")
    at = carried.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, stems = (hashed_words(batch.column(at), True, stem) for stem in (0, STEM))
            parts = [model.score(model.evidence(h, s, b)) for (_, b, h), (_, _, s) in zip(words, stems)]
            scores = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return carried.mapInArrow(rows, schema_of(carried, "score double"))


def teaching(labels: DataFrame) -> DataFrame:
    """The rows that labels may be learned from."""
    return labels.where(fold(F.col("doc_id"), 3) != 1)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, teaching(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= LEVEL).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, level: float = LEVEL) -> DataFrame:
    """The documents that score below `level`, by a model of the labels that may be learned from."""
    scored = score(docs, train(docs, teaching(labels)))
    return scored.where(F.col("score") < level).select(docs.columns)
