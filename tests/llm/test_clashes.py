"""Columns that are named like the operators' own, odd rows in the whole pipeline, and components."""

import random

import corpus_pipeline
from clickmill.llm import components, line_dedup, mixing, ngram_join, toxicity
from pyspark.sql import functions as F

NAMES = ["__key", "__lines", "__doc", "__gone", "__at", "__n", "__class", "__cut", "__rate", "__upto", "__copy", "__text"]


def marked(odd):
    return odd.withColumns({c: F.concat(F.lit(c), F.coalesce("source", F.lit("-"))) for c in NAMES})


def cells(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_clashing_columns_are_carried_through(odd):
    held = marked(odd)
    for operator in (line_dedup.shortened, ngram_join.one_of_each):
        out = operator(held)
        assert out.columns == held.columns
        assert cells(out.select(odd.columns)) == cells(operator(odd))
        assert all(r["__at"] == "__at" + (r["source"] or "-") for r in out.collect())
    mixed = mixing.mix(held)
    assert cells(mixed.drop(*NAMES)) == cells(mixing.mix(odd))
    emitted = mixing.emit(mixed, held.columns)
    assert emitted.columns == held.columns
    assert cells(emitted.select(odd.columns)) == cells(mixing.emit(mixing.mix(odd), odd.columns))
    assert all(r["__copy"] == "__copy" + (r["source"] or "-") for r in emitted.collect())


def test_repeated_rows_of_near_copies_are_one_pair(spark, docs, monkeypatch):
    body = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(body))] * 400 + [(2, " ".join([*body[:-1], "end"]))] * 400
    pairs = []
    verified = ngram_join._verified

    def counted(found, holders, percent):
        out = verified(found, holders, percent)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_verified", counted)
    for sent in (ngram_join.SENT, 0):  # 0: the sets of candidates are found by a join
        monkeypatch.setattr(ngram_join, "SENT", sent)
        pairs.clear()
        got = ngram_join.near_duplicates(docs(rows).repartition(8)).collect()
        assert len(got) == 800 and {r.component_id for r in got} == {1}
        assert sum(pairs) == 1


def test_sets_found_by_a_join_give_the_same_components(docs, odd, monkeypatch):
    draw = random.Random(3)
    bodies = [[draw.choice("abcdefgh") for _ in range(draw.choice([3, 30, 80]))] for _ in range(8)]
    rows = []
    for i in range(90):
        one = list(draw.choice(bodies))
        for _ in range(draw.randint(0, 3)):
            one[draw.randrange(len(one))] = "x"
        rows.append((i, " ".join(one)))
    want = cells(ngram_join.near_duplicates(docs(rows)))
    monkeypatch.setattr(ngram_join, "SENT", 0)
    assert cells(ngram_join.near_duplicates(docs(rows))) == want


def test_the_pipeline_takes_odd_rows_and_clashing_columns(spark, odd, folder):
    marks = spark.createDataFrame([*((i, 1, 0) for i in range(9)), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{folder}/labels.parquet")
    for name, table in (("odd", odd), ("marked", marked(odd))):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == table.columns, name
        assert docs.count() > 0
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
        assert sum(r.start == 0 for r in pieces) == docs.count()
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_components_are_the_smallest_node_that_is_reached(spark):
    draw = random.Random(4)
    edges = [(draw.randint(-40, 90), draw.randint(-40, 90)) for _ in range(70)] + [(i, i + 1) for i in range(200, 290)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    held = spark.createDataFrame([*edges, *edges[:9], (5, None), (None, 7), (400, 400)], "a long, b long")
    got = {r.node: r.root for r in components.components(held).collect()}
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components.components(held.limit(0)).count() == 0


def test_a_long_sample_is_bounded_by_its_bytes(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 1000)
    rows = [(i, f"text {i} " * 40) for i in range(60)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    held = toxicity._sampled(docs(rows), marks, 50).collect()
    for c in (0, 1):
        sizes = [len(r.text) for r in held if r.toxic == c]
        assert 0 < sum(sizes) <= 1000 and len(sizes) >= 2
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 10)
    held = toxicity._sampled(docs(rows), marks, 50).collect()
    assert sorted(r.toxic for r in held) == [0, 1]  # the first row always counts
