"""Pack documents into sequences of fixed length by cutting-stock column generation.

A document's token ids, with an end id, are cut into whole sequences and one remainder. Only the
remainders' length histogram (at most `width - 1` counts, whatever the input) reaches the driver. There
a linear program over patterns, each a set of lengths that fits one sequence, is solved by column
generation: the program's prices go into a knapsack dynamic program, which finds the next pattern, until
none pays. Where that leaves more than `SPARE` of the sequences to padding (as when nearly all remainders have
one length over half a sequence), remainders may be cut once more, at multiples of `GRAIN` ids: a cut is one
more column of the program, which takes one length and gives two, and the prices say which cut pays.
Rounded-down patterns are opened as often as the program says; what rounding leaves over, a few
pieces per pattern, is packed by best fit. Documents are then ranked among those with a remainder of
their length, and the rank says whether a remainder is cut, and which slot of which sequence it or its parts
fill. A part's checksum follows from those that were noted at every multiple of `GRAIN`.

Ranks of a length that many documents share are not made in one task: a length is cut by the hash of
the id, each cut is ranked by itself, and the cuts' counts give where each one starts.

Sequences are padded to `width`, or to the next power of two where that is less.

Nulls: a null text is empty, and an empty text is one end id. Null ids are kept. Rows that agree in id
and text are packed each by itself and are interchangeable. Texts of any length are tokenized whole; white
space of any length, too. An
empty table gives an empty result. Further columns are not carried along and cannot clash.
"""

import base64
import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import documents, partitions, small_batches, written

SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what the pattern takes for white space
LONG = 10_000  # white space that long is not left to the pattern, which keeps a state for each character of it
GRAIN = 16  # remainders are cut at multiples of it
SPARE = 0.01  # padding, as a part of the fullest packing, from which on remainders are cut
CUT_COST = 1e-3  # of a sequence; what a cut must save at least
PIECES = "doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long"


def public_vocabulary() -> str:
    """Ranks of the vocabulary of byte_bpe_50k.json, whose ids they give."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Strings that are one id wherever they stand in a text, from the json of the same vocabulary."""
    found = json.loads(Path(vocabulary).with_suffix(".json").read_text("utf-8"))["added_tokens"]
    for token in found:
        if any(token[kind] for kind in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} takes more than its own string")
    return {token["content"]: token["id"] for token in found}


class Encoder:
    """Ids of a text as little-endian 32-bit bytes. A string of `added` is its one id and the text before
    and after it is split apart from it; without `added`, such strings are ordinary text.

    The encoder works on ranks; tests hold its ids against those that the tokenizers library gives for the
    same vocabulary.
    """

    def __init__(self, vocabulary: str, added: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.added = tuple(added or {})
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added or {}
        )
        # White space by itself: one piece, however long.
        self.spaces = tiktoken.Encoding("spaces", pat_str=f"[{SPACE}]+", mergeable_ranks=ranks, special_tokens={})
        self.long = re.compile(f"[{SPACE}]{{{LONG},}}")

    def whole(self, text: str) -> bytes:
        ids, at = [], 0
        for run in self.long.finditer(text) if len(text) >= LONG else ():
            start, end = run.span()
            if end < len(text) and not text.startswith(self.added, end):
                end -= 1  # the last one goes with the word after it, as the pattern has it
            ids += [self._ids(text[at:start]), self.spaces.encode_to_numpy(text[start:end])]
            at = end
        return np.concatenate([*ids, self._ids(text[at:])]).astype("<u4").tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def pieces(docs: DataFrame, vocabulary: str, width: int = 1024) -> DataFrame:
    """Each document cut into whole sequences and a remainder, with the ids' checksums; `marks` holds the
    checksums of a remainder's beginnings, as long as the multiples of `GRAIN`."""
    end = b"\0\0\0\0"
    added = added_tokens(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, added)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                ids = encoder.whole(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, width):
                    part = ids[4 * start : 4 * (start + width)]
                    sums, marks = 0, None
                    if len(part) < 4 * width:
                        marks = []
                        for at in range(0, len(part) - 4 * GRAIN, 4 * GRAIN):
                            sums = zlib.crc32(part[at : at + 4 * GRAIN], sums)
                            marks.append(sums)
                        sums = zlib.crc32(part[4 * GRAIN * len(marks) :], sums)
                        marks = np.array(marks, "<u4").tobytes()
                    else:
                        sums = zlib.crc32(part)
                    row = (doc_id.as_py(), key.as_py(), start, len(part) // 4, sums, total, marks)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:-1]), pa.array(out[-1], pa.binary())],
                ["doc_id", "text_key", "start", "length", "ids_crc32", "doc_tokens", "marks"],
            )

    return docs.select(F.xxhash64("text").alias("key"), F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, PIECES + ", marks binary"
    )


def rest_checksum(whole: int, beginning: int, length: int) -> int:
    """crc32 of the last `length` ids, from those of all ids and of the ids before."""
    zeros = bytes(4 * length)
    return whole ^ zlib.crc32(zeros, beginning) ^ zlib.crc32(zeros)


def _fill(prices: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Knapsack by dynamic programming: how often each length goes into the dearest pattern."""
    best = np.zeros(width + 1)
    took = np.full(width + 1, -1, np.int64)
    reach = np.searchsorted(lengths, np.arange(width + 1), "right")
    for space in range(1, width + 1):
        best[space] = best[space - 1]
        if n := reach[space]:
            value = best[space - lengths[:n]] + prices[:n]
            i = int(np.argmax(value))
            if value[i] > best[space] + 1e-12:
                best[space], took[space] = value[i], i
    uses, space = np.zeros(len(lengths)), width
    while space > 0:
        i = took[space]
        if i < 0:
            space -= 1
        else:
            uses[i] += 1
            space -= lengths[i]
    return uses


def _times(row: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Vector times matrix without the threads of a linear algebra library, which a driver need not have."""
    return np.einsum("i,ij->j", row, matrix)


def _first_basis(
    lengths: np.ndarray, counts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns that each use up one more length, fullest first, how often each is opened, and their
    inverse: a feasible start. No later pattern has a length that is used up, so the matrix is triangular
    in the order in which lengths are used up."""
    columns, amounts, turns, left = [], [], [], counts.astype(float)
    open_ = np.ones(len(lengths), bool)
    while open_.any():
        at = np.flatnonzero(open_)
        uses = np.zeros(len(lengths))
        uses[at] = _fill(lengths[at] ** 1.05, lengths[at], width)
        used = np.flatnonzero(uses)
        amount = (left[used] / uses[used]).min()
        left[used] -= amount * uses[used]
        done = used[left[used] <= 1e-9 * counts[used]]
        columns.append(uses)
        amounts.append(amount)
        for i in done[1:]:  # used up at the same time: patterns of their own that are not opened
            columns.append(np.where(np.arange(len(lengths)) == i, 1.0, 0.0))
            amounts.append(0.0)
        left[done] = 0
        open_[done] = False
        turns.extend(done.tolist())
    basis = np.array(columns).T
    inverse = np.zeros_like(basis)
    for i, length in enumerate(turns):
        unit = np.zeros(len(turns))
        unit[length] = 1
        inverse[i] = (unit - _times(basis[length, :i], inverse[:i])) / basis[length, i]
    return basis, np.array(amounts), inverse


class Program:
    """The linear program over patterns and cuts, with the basis that the simplex steps have reached.

    Every step's solution covers the histogram, so a bound on the steps bounds the work and not what is packed.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, width: int):
        self.lengths, self.counts, self.width = lengths, counts, width
        self.basis, self.amounts, self.inverse = _first_basis(lengths, counts, width)
        self.costs = np.ones(len(lengths))
        self.least = (lengths * counts).sum() / width

    def gap(self) -> float:
        """Sequences above what no packing can go below."""
        return float(self.costs @ self.amounts - self.least)

    def with_cuts(self) -> None:
        """Rows for all lengths that parts can have, besides the remainders' own; at first they have next to
        nothing to cover. A part is not cut again."""
        grid = np.arange(GRAIN, self.width, GRAIN)
        at, cut = np.nonzero(self.lengths[:, None] > grid)
        first, rest = grid[cut], self.lengths[at] - grid[cut]
        made = np.unique(np.concatenate([first, rest]))
        n, m = len(self.lengths), len(made)
        fit = (self.width // made).astype(float)
        for name, corner in (("basis", fit), ("inverse", 1 / fit)):
            square = np.zeros((n + m, n + m))
            square[:n, :n] = getattr(self, name)
            square[np.arange(n, n + m), np.arange(n, n + m)] = corner
            setattr(self, name, square)
        # Amounts that are not quite zero keep the steps from standing still.
        self.amounts = np.concatenate([self.amounts, 1e-5 * (1 + np.arange(m) / max(m, 1))])
        self.costs = np.ones(n + m)
        self.cut_rows = np.stack([at, n + np.searchsorted(made, first), n + np.searchsorted(made, rest)])
        self.lengths = np.concatenate([self.lengths, made])

    def best_pattern(self, prices: np.ndarray) -> np.ndarray:
        """The dearest pattern; of a remainder and a part of one length it takes the dearer."""
        order = np.lexsort((-prices, self.lengths))
        rows = order[np.concatenate([[True], np.diff(self.lengths[order]) > 0])]
        column = np.zeros(len(prices))
        column[rows] = _fill(prices[rows], self.lengths[rows], self.width)
        return column

    def solve(self, rounds: int, near: float, cuts: bool = False) -> None:
        """Simplex steps until the gap is below `near` sequences or no column pays."""
        for _ in range(rounds):
            if self.gap() < near:
                return
            prices = _times(self.costs, self.inverse)
            if prices.min() < -1e-9:  # a length that is better covered too often
                column, cost = -np.eye(len(self.lengths))[int(np.argmin(prices))], 0.0
            else:
                column, cost = self.best_pattern(prices), 1.0
            pays = prices @ column - cost
            if cuts:
                whole, first, rest = self.cut_rows
                saved = prices[whole] - prices[first] - prices[rest] - CUT_COST
                if len(saved) and saved.max() > pays:
                    best = int(np.argmax(saved))
                    pays, cost, column = saved[best], CUT_COST, np.zeros(len(self.lengths))
                    np.add.at(column, self.cut_rows[:, best], [1, -1, -1])
            if pays < 1e-7:
                return
            move = np.einsum("ij,j->i", self.inverse, column)
            ratio = np.where(move > 1e-9, self.amounts / np.where(move > 1e-9, move, 1), np.inf)
            out = int(np.argmin(ratio))
            if not np.isfinite(ratio[out]):
                return
            step = ratio[out]
            self.amounts = np.maximum(self.amounts - step * move, 0)
            self.amounts[out] = step
            self.inverse[out] /= move[out]
            move[out] = 0
            self.inverse -= move[:, None] * self.inverse[out]
            self.basis[:, out], self.costs[out] = column, cost

    def cuts(self) -> dict[tuple[int, int], int]:
        """(length, first part) -> how many remainders the program cuts so, rounded."""
        found: dict[tuple[int, int], int] = {}
        left = self.counts.copy()
        for at in np.flatnonzero((self.costs > 0) & (self.costs < 1)):
            whole = int(np.argmax(self.basis[:, at]))
            first = next(int(n) for n in self.lengths[self.basis[:, at] < 0] if n % GRAIN == 0)
            times = min(int(self.amounts[at] + 0.5), int(left[whole]))
            if times > 0:
                found[int(self.lengths[whole]), first] = times
                left[whole] -= times
        return found


def after_cuts(counts: dict[int, int], cuts: dict[tuple[int, int], int]) -> dict[int, int]:
    """The histogram with the parts in place of the remainders that were cut."""
    out = dict(counts)
    for (whole, first), times in cuts.items():
        for n, sign in ((whole, -1), (first, 1), (whole - first, 1)):
            out[n] = out.get(n, 0) + sign * times
    return out


def plan(
    counts: dict[int, int], width: int = 1024, rounds: int = 300, spare: float = SPARE
) -> tuple[dict[tuple[int, int], int], list[tuple[dict[int, int], int]]]:
    """Cuts, (length, first part) -> how many remainders; and patterns, (length -> pieces, times opened), with a
    place for every piece of the histogram after the cuts. Nothing is cut where padding is at most `spare`, or
    where cuts would not save a sequence."""
    made, gap, program = _packed(counts, width, rounds)
    if program is None or gap <= max(1.0, spare * program.least):
        return {}, made
    program.with_cuts()
    program.solve(4 * rounds, max(0.5, spare / 4 * program.least), cuts=True)
    cuts = program.cuts()
    other, _, _ = _packed(after_cuts(counts, cuts), width, rounds)
    saves = sum(times for _, times in other) < sum(times for _, times in made)
    return (cuts, other) if saves else ({}, made)


def _packed(
    counts: dict[int, int], width: int, rounds: int
) -> tuple[list[tuple[dict[int, int], int]], float, Program | None]:
    """Patterns for the histogram as it is, the program's gap, and the program."""
    made = [({width: 1}, counts[width])] if counts.get(width) else []
    lengths = np.array(sorted(n for n, c in counts.items() if c and n < width), np.int64)
    if not len(lengths):
        return made, 0.0, None
    left = np.array([counts[n] for n in lengths], np.int64)
    program = Program(lengths, left.copy(), width)
    program.solve(rounds, 0.5)
    columns, amounts = program.basis[:, program.costs > 0], program.amounts[program.costs > 0]
    for at in np.argsort(-amounts, kind="stable"):
        column, used = columns[:, at], np.flatnonzero(columns[:, at] > 0)
        times = min([int(amounts[at] + 0.5), *(int(left[i] // column[i]) for i in used)])
        if times > 0:
            made.append(({int(lengths[i]): int(column[i]) for i in used}, times))
            left[used] -= (column[used] * times).astype(np.int64)
    spaces: list[int] = []  # what rounding leaves over, by best fit, the longest first
    bins: list[dict[int, int]] = []
    for i in range(len(lengths) - 1, -1, -1):
        for _ in range(int(left[i])):
            n = int(lengths[i])
            fits = [(space, b) for b, space in enumerate(spaces) if space >= n]
            if fits:
                b = min(fits)[1]
            else:
                b = len(bins)
                bins.append({})
                spaces.append(width)
            bins[b][n] = bins[b].get(n, 0) + 1
            spaces[b] -= n
    return made + [(pattern, 1) for pattern in bins], program.gap(), program


def patterns(counts: dict[int, int], width: int = 1024, rounds: int = 300) -> list[tuple[dict[int, int], int]]:
    """(pattern: length -> pieces, times it is opened): a place for every piece of the histogram, none cut."""
    return plan(counts, width, rounds, float("inf"))[1]


def cut_table(counts: dict[int, int], cuts: dict[tuple[int, int], int]) -> dict[str, np.ndarray]:
    """For every cut: the length and the first rank that it takes, the first part's length, and the ranks of
    the parts of that first one. The last ranks of a length are cut; parts are ranked after uncut pieces."""
    taken: dict[int, int] = {}
    for (whole, _), times in cuts.items():
        taken[whole] = taken.get(whole, 0) + times
    start = {n: counts[n] - taken[n] for n in taken}
    filled = {n: c - taken.get(n, 0) for n, c in counts.items()}
    rows = []
    for (whole, first), times in sorted(cuts.items()):
        ranks = []
        for part in (first, whole - first):
            ranks.append(filled.get(part, 0))
            filled[part] = ranks[-1] + times
        rows.append((whole, start[whole], first, *ranks))
        start[whole] += times
    names = ("length", "rank", "first", "first_rank", "rest_rank")
    return {k: np.array(v, np.int64) for k, v in zip(names, zip(*rows) if rows else [[]] * len(names))}


def slots(made: list[tuple[dict[int, int], int]], width: int) -> dict[str, np.ndarray]:
    """For every length and pattern: the first rank, and where the pieces from there on go."""
    rows, sequence, given = [], 0, {}
    for pattern, times in made:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, given.get(length, 0), n, sequence, offset))
            given[length] = given.get(length, 0) + n * times
            offset += length * n
        sequence += times
    rows.sort()
    names = ("length", "rank", "each", "sequence", "offset")
    return {k: np.array(v, np.int64) for k, v in zip(names, zip(*rows) if rows else [[]] * len(names))}


def pack(docs: DataFrame, vocabulary: str, width: int = 1024) -> DataFrame:
    """Pieces with `sequence_id` and `offset`; in each sequence the pieces stand without a gap from 0."""
    spark = docs.sparkSession
    small_batches(spark)
    cuts = partitions(spark)
    cut = F.pmod(F.xxhash64("doc_id", "text_key", "start"), F.lit(cuts)).cast("int")
    held = written(pieces(docs, vocabulary, width), "pieces").withColumn("cut", cut)
    sizes = held.groupBy("length", "cut").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    cuts_made, places = plan(counts, width)
    table, halves = slots(places, width), cut_table(counts, cuts_made)
    span = 2 * sum(counts.values()) + 1  # (length, rank) as one number; no length has more pieces
    first = Window.partitionBy("length").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "cut", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "cut").orderBy("doc_id", "text_key", "start")
    ranked = held.join(starts, ["length", "cut"]).select(
        *held.columns[:-1], (F.col("first") + F.row_number().over(inside) - 1).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table["length"] * span + table["rank"]
        cut_keys = halves["length"] * span + halves["rank"]
        for batch in batches:
            names = ("start", "length", "ids_crc32", "rank")
            start, length, crc, rank = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in names)
            row = np.arange(len(length))
            at = np.searchsorted(cut_keys, length * span + rank, "right") - 1
            halved = np.flatnonzero(at >= 0)
            halved = halved[halves["length"][at[halved]] == length[halved]]
            if len(halved):
                how = at[halved]
                first, past = halves["first"][how], rank[halved] - halves["rank"][how]
                rest = length[halved] - first
                begin = np.array(
                    [
                        np.frombuffer(batch.column("marks")[int(i)].as_py(), "<u4")[n // GRAIN - 1]
                        for i, n in zip(halved, first)
                    ],
                    np.int64,
                )
                ends = [rest_checksum(*map(int, x)) for x in zip(crc[halved], begin, rest)]
                row = np.concatenate([row, halved])
                start = np.concatenate([start, start[halved] + first])
                crc = np.concatenate([crc, np.array(ends, np.int64)])
                length, rank = np.concatenate([length, rest]), np.concatenate([rank, halves["rest_rank"][how] + past])
                length[halved], crc[halved], rank[halved] = first, begin, halves["first_rank"][how] + past
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            past, each = rank - table["rank"][at], table["each"][at]
            doc_id, key, tokens = (batch.column(c).take(pa.array(row)) for c in ("doc_id", "text_key", "doc_tokens"))
            placed = (table["sequence"][at] + past // each, table["offset"][at] + past % each * length)
            yield pa.RecordBatch.from_arrays(
                [doc_id, key, pa.array(start), pa.array(length), pa.array(crc), tokens, *map(pa.array, placed)],
                ["doc_id", "text_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long").drop("text_key")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_vocabulary())
