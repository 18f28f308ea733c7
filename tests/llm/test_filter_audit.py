"""The filter audit against one pass over all documents for every order."""

import random
import re
from itertools import permutations

from clickmill.llm import filter_audit
from conftest import LABELS

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def plain(rows, labels):
    """{(part, order, step): figures} of (doc_id, text, lang) rows."""
    texts = {}
    for i, t, _ in rows:
        if i is not None:
            texts.setdefault(t or "", []).append(i)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > min(texts[t]),
        }
        held = [x for x in labels if x[0] == i and i is not None]
        docs.append((lang or "", {f for f, x in fails.items() if x}, any(x[1] == 1 for x in held), any(x[2] == 1 for x in held)))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in ORDERS:
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for order in ORDERS:
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def compared(spark, docs, rows, labels):
    """Rows (doc_id, text, lang) and (doc_id, quality, toxic)."""
    made = docs([(i, t, lang, "s") for i, t, lang in rows])
    marks = spark.createDataFrame(labels, LABELS)
    got = filter_audit.audit(filter_audit.failures(made, marks)).collect()
    assert {tuple(r[:3]): list(r[3:]) for r in got} == plain(rows, labels)
    assert len(got) == 600 * len({lang or "" for _, _, lang in rows})


def test_random_documents_equal_plain_version(spark, docs):
    draw = random.Random(1)
    words = ["a", "B", "cd", "É", "#", "x|y", "ZZ", "漢字", "w"]
    texts = [" ".join(draw.choice(words) + draw.choice(["", str(draw.randint(0, 200))]) for _ in range(draw.choice([3, 99, 100, 130])))
             for _ in range(25)]
    rows = [(draw.randint(0, 40), draw.choice(texts), draw.choice(["en", "de", None, ""])) for _ in range(160)]
    labels = [(draw.randint(0, 45), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(50)]
    compared(spark, docs, rows, labels)


def test_odd_rows(spark, docs, odd):
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    rows += [(None, "", None), (0, " ", "en"), (9, "A" * 3_000_000, "en"), (8, "word " * 400_000, "en")]
    compared(spark, docs, rows, [(1, 1, 1), (1, 0, 0), (4, 1, None), (None, 1, 1), (77, 1, 1)])
    compared(spark, docs, rows, [])


def test_empty_table_and_clashing_names(spark, odd):
    marks = spark.createDataFrame([(4, 1, 1)], LABELS)
    assert filter_audit.audit(filter_audit.failures(odd.limit(0), marks)).count() == 0
    own = odd
    for c in ("part", "mask", "key", "n", "good", "toxic", "quality", "is_good", "all", "known"):
        own = own.withColumn(c, odd["source"])
    want = filter_audit.audit(filter_audit.failures(odd, marks)).collect()
    assert sorted(filter_audit.audit(filter_audit.failures(own, marks)).collect()) == sorted(want)


def test_intervals_cover_every_order_that_removes_a_mask():
    for n in (1, 3, 4):
        orders = list(permutations(range(n)))
        for mask, rows in enumerate(filter_audit.intervals(n)):
            got = {(step, r) for step, start, end in rows for r in range(start, end)}
            assert len(got) == sum(end - start for _, start, end in rows)
            assert got == {
                (next(s for s, f in enumerate(o) if mask >> f & 1), r) for r, o in enumerate(orders) if mask
            }
