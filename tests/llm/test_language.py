"""Language identification against a plain version; many, rare and repeated languages."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import language

M = 2**32


def plain_buckets(data: bytes) -> Counter:
    """Every run of 2, 3 and 4 bytes and its bucket, one by one."""
    low, out = bytes(b + 32 if 65 <= b <= 90 else b for b in data), Counter()
    for n in (2, 3, 4):
        for i in range(len(low) - n + 1):
            h = low[i]
            for b in low[i + 1 : i + n]:
                h = (h * 0x01000193 % M) ^ b
            h = (h * 0x9E3779B1 + n * 0x7F4A7C15) % M
            h ^= h >> 15
            out[(h * 0x85EBCA6B % M) >> 16] += 1
    return out


def plain_prediction(text, model):
    buckets = plain_buckets((text or "").encode())
    values = sum((model["table"][b].astype(float) * n for b, n in buckets.items()), np.zeros(model["table"].shape[1]))
    values = values / max(1, sum(buckets.values()))
    if model["layer"] is not None:
        values = values @ model["layer"]
    e = np.exp((values - values.max()) / model["heat"])
    known = any(c.isalpha() for c in text or "")
    return (model["langs"][int(e.argmax())], float((e / e.sum()).max())) if known else ("und", 0.0)


def tagged(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("step", [1, 7, 1 << 19])
def test_histogram_counts_every_subword_of_the_whole_text(monkeypatch, step):
    monkeypatch.setattr(language, "STEP", step)
    for body in ("", "a", "Ab", "abc", "The old Cat sat é漢", "x" * 50):
        data = np.frombuffer(body.encode(), np.uint8)
        found, share = language.histogram(data)
        want = plain_buckets(body.encode())
        assert found.tolist() == sorted(want)
        assert share == pytest.approx([want[b] / sum(want.values()) for b in sorted(want)])


def words_of(n):
    draw = random.Random(n)
    return ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(4)]


def test_three_hundred_languages_are_all_learned_and_predictions_equal_the_plain_version(spark):
    draw = random.Random(1)
    rows = [
        (n * 10 + i, " ".join(draw.choice(words_of(n)) for _ in range(12)), f"l{n}") for n in range(300) for i in range(5)
    ]
    model = language.train(tagged(spark, rows), epochs=20, rate=2.0)
    assert model["langs"] == sorted({r[2] for r in rows}) and model["table"].shape == (language.BUCKETS, language.WIDTH)
    asked = tagged(spark, rows[::7] + [(-1, None, None), (-2, "1 2", None), (None, "", None), (-3, "ß", None)])
    got = language.predict(asked, model).collect()
    texts = {r[0]: r for r in rows}
    right = 0
    for r in got:
        body = texts[r.doc_id][1] if r.doc_id in texts else {-1: None, -2: "1 2", None: "", -3: "ß"}[r.doc_id]
        name, score = plain_prediction(body, model)
        assert r.lang_pred == name and r.score == pytest.approx(score, rel=1e-4)
        right += r.doc_id in texts and r.lang_pred == texts[r.doc_id][2]
    assert right > 0.5 * len(rows[::7])


def test_sample_has_rare_languages_and_equal_rows_once(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 60)
    rows = [(i, f"some common words {i}", "big") for i in range(3000)] + [(7, "again and again", "same")] * 500
    rows += [(9000, "rarely seen", "rare"), (9001, "ab", "short"), (9002, "a", "none"), (9003, None, "none"), (1, "x y", None)]
    langs, classes, texts = language._sampled(tagged(spark, rows))
    assert langs == ["big", "rare", "same", "short"]
    assert Counter(langs[c] for c in classes) == {"big": 20, "rare": 1, "same": 1, "short": 1}
    assert len(texts) == len(classes)
    again, other, _ = language._sampled(tagged(spark, rows[::-1]).repartition(7))
    assert again == langs and other.tolist() == classes.tolist()


def test_long_texts_fill_the_sample_but_leave_one_row_each(spark, monkeypatch):
    monkeypatch.setattr(language, "ENTRIES", 4000)
    draw = random.Random(3)
    rows = [(i, " ".join(words_of(draw.randint(0, 500))[0] for _ in range(300)), "ab"[i % 2]) for i in range(20)]
    langs, classes, texts = language._sampled(tagged(spark, rows))
    assert Counter(classes.tolist()) == {0: 1, 1: 1}
    ids = [min(range(20), key=lambda i: abs(len(plain_buckets(rows[i][1].encode())) - len(t[0]))) for t in texts]
    assert all(sorted(plain_buckets(rows[i][1].encode())) == t[0].tolist() for i, t in zip(ids, texts))


def test_no_language_is_ranked_whole_in_one_task(spark, monkeypatch):
    plans = []
    real = type(spark.range(1)).collect

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(type(spark.range(1)), "collect", kept)
    rows = tagged(spark, [(1, "ab cd", "x")]).withColumn("key", F.xxhash64("doc_id", "text"))
    language._chosen(rows)
    assert re.search(r"hashpartitioning\(lang#\d+, cut#\d+", plans[-1])
