"""Small tables with the odd cases that every operator must take."""
from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("k1", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("words", T.IntegerType()), T.StructField("kept", T.StringType()),
    T.StructField("doc", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("padded", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("raw", T.StringType()),
])
COLUMNS = DOCS.names
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree"


def long_text(words: int = 30_000) -> str:
    return " ".join(f"w{i % 9973}" for i in range(words))


TEXTS = [
    (1, SENTENCE), (2, SENTENCE), (2, SENTENCE), (3, None), (4, ""), (5, "   \n\t "), (None, "text without an id"),
    (None, None), (6, "x" * 5000), (7, long_text()), (8, "\n\n".join([SENTENCE] * 3)), (9, "日本語 テキスト é"), (10, "a"),
    (11, "MIT License"), (12, "0 1 2 !"), (13, "#*$% &|<>"), (14, SENTENCE.upper()), (15, "a\x00b \x01\nc"), (3, "another text under id three"),
]


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en" if n % 3 else None, f"s{n % 2}" if n % 5 else None, None if t is None else len(t),
                                   *["clash"] * 4, 7, *["clash"] * 6) for n, (i, t) in enumerate(rows)], DOCS)


def empty(spark):
    return docs(spark).limit(0)


def by_id(rows, *names):
    return sorted(((r["doc_id"], *(r[n] for n in names)) for r in rows), key=repr)
