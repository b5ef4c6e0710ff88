from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from perishables.llm import queries
from perishables.llm import sketches as S
from tests.conftest import SF_SMALL
from tests.llm import cases


def shingles(text, size=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    return {hashlib.md5(" ".join(words[i:i + size]).encode()).hexdigest()[:16] for i in range(max(len(words) - size + 1, 1))} if words else set()


def plain(text, k=S.K, size=5):
    return sorted(shingles(text, size))[:k]


def likeness(a, b, k):
    union = sorted(set(a) | set(b))[:k]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


@pytest.mark.parametrize("k, step", [(4, 1), (4, 3), (8, 4096), (128, 7)])
def test_sketch_is_the_k_smallest_hashes(spark, k, step):
    rng = random.Random(k + step)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (0, 1, 4, 5, 6, 20, 300)] + [None, " \n a  b\tc \x0b d\re f\x0c", "é à ü x y z", "a\x00b \x01 c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in rows.select("i", S.sketch(F.col("t"), k, step=step).alias("s")).collect():
        assert r["s"] == plain(texts[r["i"]], k), texts[r["i"]]


def test_merged_parts_are_the_whole(spark):
    rng = random.Random(5)
    parts = [(rng.choice(["x", "y", None]), " ".join(rng.choices("abcdefg", k=rng.choice([0, 3, 40])))) for _ in range(60)]
    parts += [("hot", "one text under one key again and again")] * 200 + [("none", "")]
    got = S.merge_rows(spark.createDataFrame(parts, "key string, t string").withColumn("sketch", S.sketch(F.col("t"), 16)).repartition(7),
                       ["key"], k=16).collect()
    assert len(got) == len({k for k, _ in parts})
    for r in got:
        assert r["sketch"] == sorted(set().union(*(shingles(t) for k, t in parts if k == r["key"])))[:16]


def test_estimates(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(3000)]
    pairs = [("", ""), ("", "a b"), ("a b c", "a b c"), ("a b c", "c b a")]
    for share in (0.1, 0.5, 0.9):
        cut = int(len(base) * share)
        pairs.append((" ".join(base), " ".join(base[:cut] + [f"x{rng.random()}" for _ in range(len(base) - cut)])))
        pairs.append((" ".join(base[:cut]), " ".join(base)))
    rows = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<a:string,b:string>") \
        .select("i", S.sketch(F.col("p.a")).alias("a"), S.sketch(F.col("p.b")).alias("b"))
    for r in rows.select("i", "a", "b", S.resemblance(F.col("a"), F.col("b")).alias("r"), S.containment(F.col("a"), F.col("b")).alias("c"),
                         S.distinct_shingles(F.col("a")).alias("n")).collect():
        a, b = (shingles(t) for t in pairs[r["i"]])
        assert r["r"] == likeness(plain(pairs[r["i"]][0]), plain(pairs[r["i"]][1]), S.K)
        assert abs(r["r"] - (len(a & b) / len(a | b) if a | b else 1)) < 0.15
        assert abs(r["c"] - (len(a & b) / len(a) if a else 1)) < 0.2
        assert r["n"] == len(a) if len(a) < S.K else abs(r["n"] / len(a) - 1) < 0.3


def check_edits(spark, docs, rows, monkeypatch=None):
    """Against a loop over the rows in order; rows of one id follow each other in any order."""
    got = S.fingerprint_edits(docs, k=16).collect()
    assert len(got) == len(rows)
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0))
    texts = {i: [t or "" for j, t in rows if j == i] for i in ids}
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["sketch"] == plain(r["text"], 16) and r["edited_sketch"] == plain(r["edited"], 16)
    for at, i in enumerate(ids):
        mine = [r for r in got if r["id"] == i]
        assert sorted(r["text"] for r in mine) == sorted(texts[i])
        after = texts[ids[(at + 1) % len(ids)]]
        for r in mine:   # another row of the id, or one of the next id
            half = len(r["text"]) // 2
            follows = {r["text"][:len(r["text"]) - half] + t[:half] for t in texts[i] + after}
            assert r["edited"] in follows and r["next_sketch"] in [plain(t, 16) for t in texts[i] + after]
            if len(texts[i]) == 1:
                assert r["edited"] in {r["text"][:len(r["text"]) - half] + t[:half] for t in after}
    return got


def test_odd_cases(spark):
    check_edits(spark, cases.docs(spark), cases.TEXTS)
    assert S.fingerprint_edits(cases.empty(spark)).count() == 0
    one = S.fingerprint_edits(cases.docs(spark, [(1, "abcd")])).collect()
    assert [(r["edited"], r["n_chars"]) for r in one] == [("abab", 4)]


@pytest.mark.parametrize("cuts", [1, 3])
def test_next_rows_across_many_buckets(spark, monkeypatch, cuts):
    rng = random.Random(cuts)
    monkeypatch.setattr(S, "CUTS", cuts)
    rows = [(i * 7 % 997 - 300, " ".join(rng.choices("abcdef", k=rng.randrange(1, 9))) + f" {i}") for i in range(400)]
    got = check_edits(spark, cases.docs(spark, rows).repartition(5), rows)
    assert len({r["id"] for r in got}) == 400


def test_a_third_of_rows_alike(spark):
    rows = [(None, None)] * 100 + [(i, f"text {i}") for i in range(200)]
    got = check_edits(spark, cases.docs(spark, rows).repartition(4), rows)
    assert sum(r["id"] is None for r in got) == 100


def test_no_python_in_the_plan(spark):
    plan = queries.op11_document_fingerprints(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
