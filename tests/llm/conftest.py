import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField(c, t) for c, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
                                     ("source", T.StringType()), ("n_chars", T.LongType()))]
)
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def docs(spark):
    def make(rows, **more):
        """Rows (doc_id, text) or (doc_id, text, lang, source)."""
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (None, "a b c d e f g h", None, None),
    (1, None, "en", "x"),
    (2, "", "en", None),
    (3, " \t\n ", None, "x"),
    (4, "one two\nthree four\nfive six\nseven", "en", "x"),
    (4, "one two\nthree four\nfive six\nseven", "en", "x"),
    (5, "one two\nthree four\nfive six\nseven", "en", "y"),
    (6, "Ünï çødé ß 漢字", "de", "y"),
    (7, LONG, "en", "x"),
]


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, ties, repeated rows."""
    return docs(ODD)
