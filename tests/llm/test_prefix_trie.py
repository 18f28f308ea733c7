"""The prefix trie against rebuilt conversations that are written out."""

import hashlib
import random
import zlib

import pytest
from clickmill.llm import prefix_trie
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"


def reference(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:15]


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, reference(role or "", text or ""), text or ""))
    for held in own.values():
        held.sort()
    made = {}
    for c, held in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(abs(c) % 100 * (1 if c >= 0 else -1)), [])
        made[c] = [x[2:] for x in base[:h] + held[h:]]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, members in nodes.items():
        below, leaves, saved = [path], 0, 0
        while below:
            one = below.pop()
            leaves += one not in children
            saved += (len(nodes[one]) - 1) * (len(one[-1][1]) if one else 0)
            below += children.get(one, [])
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    len(children.get(path, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def trie(spark, rows, table=None):
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 6
    table = spark.createDataFrame(rows, SCHEMA) if table is None else table
    return sorted(str(tuple(r)) for r in prefix_trie.prefix_trie(table, conv - conv % 100, head).collect())


@pytest.fixture
def many_tasks(spark):
    """Small tables, too, are spread over all tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_random_conversations_equal_plain_version(spark, many_tasks):
    draw = random.Random(1)
    for spread in (8, 230):
        rows = [
            (draw.randint(0, spread), draw.choice([None, *range(12)]), draw.choice(["u", "a", None]), draw.choice(["x", "yé", "", None]))
            for _ in range(700)
        ]
        assert trie(spark, rows) == plain(rows)


def test_a_long_conversation_lies_in_several_tasks(spark, many_tasks):
    rows = [(c, t, "u", f"turn {t % 7}") for c in (0, 3, 103) for t in range(400 if c else 900)]
    held = prefix_trie.prefixes(spark.createDataFrame(rows, SCHEMA))
    assert rows and sorted(r.pos for r in held.where("conv_id = 0").collect()) == list(range(1, 901))
    assert trie(spark, rows) == plain(rows)


def test_copies_ends_in_chunks_and_turnless_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 20)
    rows = [(c, t, "u", "same") for c in range(200, 320) for t in range(3)]
    rows += [(c, 0, "u", "alone") for c in range(1, 60)]  # no base: conversation 0 is absent
    assert trie(spark, rows) == plain(rows)
    assert plain([(1, 0, "u", "x")]) == trie(spark, [(1, 0, "u", "x")])


def test_nulls_ties_repeated_rows_long_texts_and_negative_ids(spark):
    rows = [
        (None, 1, "u", "nobody's"), (5, None, None, None), (5, None, None, None), (5, 1, "", ""), (5, 1, "b", "a"),
        (5, 1, "a", "b"), (0, 0, "1:", "x"), (0, 1, "1", ":x"), (-7, 0, "u", "x"), (-100, 0, "u", "y"),
        (-107, 3, "u", "z"), (105, 0, "u", "long " * 500_000), (100, 0, "u", "long " * 500_000), (-5, 9, "é", "漢字😀"),
    ]
    assert trie(spark, rows) == plain(rows)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie(spark, [], empty) == []
    rows = [(c, t, "u", f"{c % 3} {t}") for c in range(130) for t in range(c % 7)]
    table = spark.createDataFrame(rows, SCHEMA)
    for c in ("depth", "product", "reference", "pos", "row", "chars", "n", "h", "k", "base", "head", "ends", "place", "task"):
        table = table.withColumn(c, F.lit("own"))
    assert trie(spark, rows, table) == plain(rows)


def test_products_compose():
    draw = random.Random(2)
    refs = [draw.randbytes(15) for _ in range(40)]

    def run(some):
        out = (0, 0)
        for r in some:
            out = prefix_trie.combined(out, (1, prefix_trie.single(r)))
        return out

    for _ in range(100):
        i, j = sorted((draw.randint(0, 40), draw.randint(0, 40)))
        assert prefix_trie.combined(run(refs[:i]), run(refs[i:])) == run(refs)
        assert prefix_trie.behind(run(refs[:j]), run(refs[:i])) == run(refs[i:j])


def test_two_references_at_one_node_stop_the_run(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "single", lambda reference: 1)  # all turns hash alike
    with pytest.raises(Exception, match="one fingerprint"):
        trie(spark, [(1, 0, "u", "x"), (2, 0, "u", "y"), (1, 1, "u", "z"), (2, 1, "u", "z")] + [(c, 0, "u", str(c)) for c in range(3, 40)])
