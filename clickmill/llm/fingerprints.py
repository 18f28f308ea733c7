"""Fingerprints of texts by prefix polynomial hashes.

A text's prefix arrays hold sum(code * base**i) modulo 2**31 - 1, for two bases. From them any span's hash
follows in constant time, so spans of any texts are compared without reading them again, and the longest
common extension of two places is found by binary search. A fingerprint is the text's length, its whole
hash and a sketch: the `SKETCH` smallest hashes of its spans of `SPAN` code points, all read off the
prefix array. Likeness is the share of common hashes among the smallest of both sketches. An edited
text's fingerprint is put together from the spans of its two sources; only the seam is hashed anew.

Documents follow each other by descending id over ranges of ids, one range per task, and each range also
gets the first row of the next one (the last range that of the first). Texts are shuffled once. Boundaries
are quantiles of the ids; at most one number per partition comes to the driver.

Nulls: a null text is empty; null ids follow all others. Rows of one id follow each other by their text's
hash; equal rows are interchangeable. A table of one row has itself as next. Two empty texts are alike
(1), an empty and another one not (0). A text shorter than a span is one span. An empty table gives an
empty result. Other columns are not read and cannot clash.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import documents, partitions

PRIME = (1 << 31) - 1
BASES = (1_000_003, 19_260_817)
SPAN = 12
SKETCH = 64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i up to n, by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        both = []
        for step in (base, pow(base, -1, PRIME)):
            out = np.ones(1, np.uint64)
            while len(out) <= max(n, 1 << 16):
                out = np.concatenate([out, out * np.uint64(pow(step, len(out), PRIME)) % PRIME])
            both.append(out)
        have = _POWERS[base] = (both[0], both[1])
    return have


class Prefix:
    """Prefix arrays of a text: equality of spans, longest common extensions, hashes of all spans."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums, self.down = [], []
        for base in BASES:
            up, down = _powers(base, self.n)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * up[: self.n] % PRIME, out=sums[1:])
            sums %= np.uint64(PRIME)
            self.sums.append(sums)
            self.down.append(down)

    def span(self, start: int, stop: int) -> tuple[int, int]:
        """The hash of a span, the same wherever it stands."""
        return tuple(
            (int(s[stop]) - int(s[start])) * int(d[start]) % PRIME for s, d in zip(self.sums, self.down)
        )

    def extension(self, at: int, other: "Prefix", there: int) -> int:
        """Length of the longest common extension of two places."""
        low, high = 0, min(self.n - at, other.n - there)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(at, at + middle) == other.span(there, there + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def spans(self, stop: int | None = None) -> np.ndarray:
        """Hashes of all spans of SPAN code points before `stop`; of a shorter text its whole hash."""
        stop = self.n if stop is None else stop
        if stop < SPAN:
            whole = (self.span(0, stop)[0] + stop) % PRIME
            return np.array([whole] if stop else [], np.uint64)
        sums, down = self.sums[0], self.down[0]
        ahead = sums[SPAN : stop + 1] + np.uint64(PRIME) - sums[: stop + 1 - SPAN]
        return ahead % PRIME * down[: stop + 1 - SPAN] % PRIME


def scattered(h: np.ndarray) -> np.ndarray:
    h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (h >> np.uint64(7))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(32)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values after scattering."""
    values = scattered(hashes)
    if len(values) > 8 * SKETCH:
        few = np.unique(np.partition(values, 4 * SKETCH)[: 4 * SKETCH])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(values)[:SKETCH]


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    least = np.union1d(one, other)[:SKETCH]
    return float(np.isin(least, one).astype(int) @ np.isin(least, other).astype(int) / len(least))


def written_out(n: int, whole: tuple[int, int], values: np.ndarray) -> str:
    return f"{n:x}-{whole[0]:08x}{whole[1]:08x}-{values.astype('>u4').tobytes().hex()}"


class Document:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.prefix = doc_id, text, Prefix(text)
        self.spans = self.prefix.spans()
        self.sketch = sketch(self.spans)


def compared(one: Document, after: Document) -> tuple:
    """The row of a document, given the next one."""
    n = one.prefix.n
    cut = n - n // 3
    taken = min(n // 3, after.prefix.n)
    edited = one.text[:cut] + after.text[:taken]
    total = cut + taken
    if total < SPAN:
        spans = Prefix(edited).spans()
    else:
        seam = Prefix(one.text[max(0, cut - SPAN + 1) : cut] + after.text[: min(taken, SPAN - 1)])
        parts = [seam.spans()] if seam.n >= SPAN else []
        parts += [one.spans[: cut - SPAN + 1]] if cut >= SPAN else []
        parts += [after.spans[: taken - SPAN + 1]] if taken >= SPAN else []
        spans = np.concatenate(parts)
    left, right = one.prefix.span(0, cut), after.prefix.span(0, taken)
    whole = tuple((a + b * pow(base, cut, PRIME)) % PRIME for a, b, base in zip(left, right, BASES))
    changed = sketch(spans)
    return (
        one.doc_id,
        n,
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        written_out(n, one.prefix.span(0, n), one.sketch),
        written_out(total, whole, changed),
        likeness(one.sketch, changed),
        likeness(one.sketch, after.sketch),
        one.prefix.extension(0, after.prefix, 0),
    )


OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
        ("near_next", pa.float64()), ("common_prefix", pa.int64()),
    ]
)
OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix long"
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, its guest last: each own row meets the row after it."""
    before: Document | None = None
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            out = []
            part = batch.slice(start, 200)
            for guest, doc_id, text in zip(*(part.column(i) for i in range(3))):
                if guest.as_py() and before is None:
                    continue  # another row of the guest's id
                now = Document(doc_id.as_py(), text.as_py() or "")
                if before is not None:
                    out.append(compared(before, now))
                before = None if guest.as_py() else now
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(OUT.names, row)) for row in out], schema=OUT)


LAST = -(2**63)  # where null ids stand


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, the edited text's, and how alike they and the next are."""
    tasks = partitions(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(LAST)).alias("id"), doc_id.alias("doc_id"), "text")
    marks = docs.select(doc_id.cast("double").alias("id")).approxQuantile(
        "id", [i / tasks for i in range(1, tasks)], 1 / (4 * tasks)
    ) if tasks > 1 else []
    bounds = np.unique(np.array(marks, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    tops = {
        r["range"]: r["top"]
        for r in rows.select("id").groupBy(range_of("id").alias("range")).agg(F.max("id").alias("top")).collect()
    }
    used = sorted(tops)
    hosts = {tops[r]: used[i + 1] if i + 1 < len(used) else used[0] for i, r in enumerate(used)}
    keys = np.array(sorted(hosts), np.int64)
    above = np.array([hosts[k] for k in keys.tolist()], np.int32)

    @F.pandas_udf("int")
    def host_of(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy()
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        return pd.Series(np.where(keys[at] == values, above[at], -1).astype(np.int32))

    visits = F.array(
        F.struct(range_of("id").alias("range"), F.lit(False).alias("guest")),
        F.struct(host_of("id").alias("range"), F.lit(True).alias("guest")),
    )
    return (
        rows.withColumn("visits", visits)
        .select("id", "doc_id", "text", F.inline("visits"))
        .where("range >= 0")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionById(tasks, "range")
        .sortWithinPartitions("range", "guest", F.desc("id"), "tie")
        .select("guest", "doc_id", "text")
        .mapInArrow(_walk, OUT_DDL)
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
