"""What grows with the input is never gathered in the driver to be sent to every task."""

import random

import numpy as np
from clickmill.llm import components, ngram_join, topk_search


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_repeated_for_each_shard_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD", 64)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).round(2).tolist()) for i in range(500)]
    found = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert "BroadcastExchange" not in planned(found)
    assert len(found.collect()) == 50
    assert "BroadcastExchange" not in planned(found)  # nor by what adaptive execution has seen


def test_near_duplicates_broadcast_nothing(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", 4)
    monkeypatch.setattr(ngram_join, "TOGETHER", 4)
    draw, plans, written = random.Random(5), [], ngram_join.written

    def seen(df, name):
        plans.append(planned(df))
        return written(df, name)

    monkeypatch.setattr(ngram_join, "written", seen)
    body = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        one = list(body)
        for _ in range(6):
            one[draw.randrange(60)] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(one)))
    monkeypatch.setattr(components, "written", seen)
    plans.append(planned(ngram_join.one_of_each(docs(rows))))
    assert len(plans) > 10 and not any("BroadcastExchange" in p for p in plans)
    (repeated,) = [p for p in plans if "explode" in p]
    assert repeated.index("Generate explode") < repeated.index("SortMergeJoin")  # sets are met before rows are repeated
