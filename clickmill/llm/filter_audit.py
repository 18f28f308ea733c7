"""What each filter removes in every order of the filters, by difference arrays over Lehmer ranks.

A document is the set of filters that it fails, a mask. In a given order it goes at the first step whose
filter is in the mask. Orders that begin alike are neighbours in lexicographic order: all that begin with
p1 ... pk are the (n - k)! ranks from the one that the Lehmer digits of the prefix give. So a mask is removed
at step k in one interval of ranks for each prefix whose last filter alone is in the mask. Counts by mask are
added where an interval starts and taken off where it ends, a prefix sum along the ranks gives what every
step of every order removes, and all other figures follow from it.

Spark brings the documents down to counts by part and mask; a part then is at most 2**n rows, made into its
totals by itself. Copies have one text and thus one mask but for the last filter, which asks for a smaller
id anywhere with the same text: they are combined by text, part and label before their smallest id is
looked up, so that a large group of copies is a few rows.

Nulls: a null text is empty (both are the same text); a null lang is the part with the empty name, like an
empty lang. A null id is neither smaller nor larger than others: such a row never fails the last filter, nor
makes others fail it, and has no label. Rows that share id and text are documents of their own, none of
which has a smaller id than the other. Several labels of one id count if any is 1. Texts are read whole. An
empty table has no parts and gives an empty result. Other columns are not read and cannot clash.
"""

from collections.abc import Callable
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import WORD, documents

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def intervals(filters: int) -> list[np.ndarray]:
    """For every mask the rows (step, first rank, end) of the orders that remove it at that step."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(1 << filters)]

    def extend(prefix: tuple[int, ...], rank: int) -> None:
        rest = [f for f in range(filters) if f not in prefix]
        span = factorial(len(rest) - 1)
        passed = sum(1 << f for f in prefix)
        for digit, last in enumerate(rest):  # the Lehmer digit: smaller filters that are still to come
            start = rank + digit * span
            others = [f for f in rest if f != last]
            for chosen in range(1 << len(others)):  # masks with `last` and without the prefix
                mask = 1 << last | sum(1 << f for i, f in enumerate(others) if chosen >> i & 1)
                assert not mask & passed
                found[mask].append((len(prefix), start, start + span))
            if others:
                extend((*prefix, last), start)

    if filters:
        extend((), 0)
    return [np.array(rows, np.int64).reshape(-1, 3) for rows in found]


def removed_by_step(counts: np.ndarray, filters: int) -> np.ndarray:
    """counts[mask, measure] -> removed[step, rank, measure] over all orders."""
    steps = np.zeros((filters, factorial(filters) + 1, counts.shape[1]), np.int64)
    for mask, rows in enumerate(intervals(filters)):
        if len(rows) and counts[mask].any():
            np.add.at(steps, (rows[:, 0], rows[:, 1]), counts[mask])
            np.add.at(steps, (rows[:, 0], rows[:, 2]), -counts[mask])
    return steps.cumsum(1)[:, :-1]


def _totals(filters: str) -> Callable[[pa.Table], pa.Table]:
    """All steps of all orders of one part, from its rows `part`, `mask`, `n`, `good`, `toxic`."""

    def part(held: pa.Table) -> pa.Table:
        n = len(filters)
        masks = held.column("mask").to_numpy()
        counts = np.zeros((1 << n, len(MEASURES)), np.int64)
        np.add.at(counts, masks, np.stack([held.column(m).to_numpy() for m in MEASURES], 1))
        removed = removed_by_step(counts, n)
        orders = np.array(list(permutations(range(n))))  # lexicographic: row i has rank i
        at = orders.T  # the filter of [step, rank]
        documents_, good, toxic = (removed[:, :, i] for i in range(3))
        failing = np.array([counts[[m for m in range(1 << n) if m >> f & 1], 0].sum() for f in range(n)])
        alone = counts[[1 << f for f in range(n)], 0]
        shapley = np.array([documents_[at == f].sum() for f in range(n)])
        columns = [
            counts[:, 0].sum() - documents_.cumsum(0), documents_, failing[at] - documents_, alone[at], good, toxic,
            shapley[at],
        ]
        names = ["".join(filters[f] for f in order) for order in orders for _ in range(n)]
        return pa.table(
            [
                pa.array([held.column("part")[0].as_py()] * len(names), pa.string()),
                pa.array(names, pa.string()),
                pa.array(np.tile(np.arange(1, n + 1), len(orders)), pa.int32()),
                *(pa.array(c.T.ravel(), pa.int64()) for c in columns),
            ],
            [c.split()[0] for c in AUDIT.split(", ")],
        )

    return part


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """`part`, `mask` (bit i: the i-th filter fails), `n`, `good`, `toxic` -> one row per part, order and
    step. Meant for a few filters: a part has n! * n rows."""
    combined = counts.groupBy("part", "mask").agg(*(F.sum(m).cast("long").alias(m) for m in MEASURES))
    return combined.groupBy("part").applyInArrow(_totals(filters), AUDIT)


def own_failures(text: Column) -> Column:
    """The mask of the filters A to D, which look at one text only."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    conditions = [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`part`, `mask`, `n`, `good`, `toxic`: documents by what they fail, and how many of them have a label."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("part"), "doc_id", F.unhex(F.md5(text)).alias("key"),
        own_failures(text).alias("mask"),
    ).groupBy("key", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    marks = [F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(m) for c, m in (("quality", "is_good"), ("toxic", "is_toxic"))]
    marked = rows.join(labels.groupBy("doc_id").agg(*marks), "doc_id", "left").fillna(False)
    known = F.col("doc_id").isNotNull()
    classes = marked.groupBy("key", "part", "mask", "is_good", "is_toxic").agg(
        F.sum("n").alias("all"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.col("least.doc_id") == F.min("least.doc_id").over(Window.partitionBy("key"))
    later = F.col("known") - F.when(first, F.col("least.n")).otherwise(F.lit(0))
    split = classes.withColumn("later", F.coalesce(later, F.lit(0))).select(
        "part", "is_good", "is_toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), (F.col("all") - F.col("later")).alias("n")),
            F.struct((F.col("mask") + F.lit(16)).alias("mask"), F.col("later").alias("n")),
        )).alias("c"),
    ).select("part", "c.mask", "c.n", "is_good", "is_toxic").where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *(F.coalesce(F.sum(F.when(F.col(f"is_{m}"), F.col("n"))), F.lit(0)).alias(m) for m in ("good", "toxic")),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failures(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * len(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS f
  FROM words LEFT JOIN marks USING (doc_id)),
counts AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails GROUP BY part, f),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l a, l b, l c, l d, l e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
gone AS (  -- the step at which an order removes what fails exactly f; 6: never
  SELECT c.*, o, CASE WHEN f = '' THEN 6 ELSE list_min(list_transform(string_split(f, ''), lambda x: instr(o, x))) END AS hit
  FROM counts c, orders),
steps AS (
  SELECT part, o, s, substr(o, s, 1) AS x,
         sum(CASE WHEN hit > s THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit < s AND contains(f, substr(o, s, 1)) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f = substr(o, s, 1) THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit = s THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM gone, (SELECT unnest(range(1, 6)) AS s) GROUP BY part, o, s)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM steps
"""
