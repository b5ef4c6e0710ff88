from __future__ import annotations

import itertools

import numpy as np
import pytest

import __spark_entry__ as E
from perishables.llm import quality_crf as C
from perishables.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import cases


def test_marginals_are_sums_over_all_labellings():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        x = rng.normal(size=(n, 3))
        field = C.LineField(rng.normal(size=3), rng.normal(size=(2, 2)))
        emit = x @ field.weights
        total, good = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            p = np.exp(sum(emit[t] for t in range(n) if path[t]) + sum(field.moves[a, b] for a, b in zip(path, path[1:])))
            total += p
            good += p * np.array(path)
        assert field.marginals(x) == pytest.approx(good / total)
        p, pairs = C._Chains([x]).expectations(emit, field.moves)
        assert p == pytest.approx(good / total) and pairs.sum() == pytest.approx(n - 1)


def test_gradient_follows_the_likelihood():
    rng = np.random.default_rng(2)
    xs = [rng.normal(size=(n, 2)) for n in (3, 1, 4)]
    x, chains = np.concatenate(xs), C._Chains(xs)
    good = (rng.random(len(x)) > 0.5).astype(float)

    def likelihood(w, moves):
        at, out = 0, 0.0
        for own in xs:
            emit, y = own @ w, good[at:at + len(own)].astype(int)
            score = lambda path: sum(e for e, k in zip(emit, path) if k) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            out += score(y) - np.log(sum(np.exp(score(p)) for p in itertools.product((0, 1), repeat=len(own))))
            at += len(own)
        return out

    w, moves = rng.normal(size=2), rng.normal(size=(2, 2))
    p, pairs = chains.expectations(x @ w, moves)
    for k in range(2):
        step = np.eye(2)[k] * 1e-5
        assert (x.T @ (good - p))[k] == pytest.approx((likelihood(w + step, moves) - likelihood(w - step, moves)) / 2e-5, abs=1e-6)
    step = np.zeros((2, 2))
    step[0, 1] = 1e-5
    slope = (likelihood(w, moves + step) - likelihood(w, moves - step)) / 2e-5
    assert (chains.pair_counts(good) - pairs)[0, 1] == pytest.approx(slope, abs=1e-6)


def test_held_out_documents(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    marks = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    rows = E.queries()["op3_quality_crf"](spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    left = [(r["score"], marks[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    good, bad = ([s for s, q, _ in left if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97 and np.mean([q == p for _, q, p in left]) > 0.95


def test_odd_cases(spark):
    docs = cases.docs(spark)
    marks = spark.createDataFrame([(1, 1), (1, 1), (13, 0), (12, 0), (3, 1), (5, None), (None, 1), (999, 0)], "doc_id long, quality int")
    for labels in (marks, marks.limit(0)):
        field = C.train(docs, labels)
        rows = docs.select("text", C.score(docs, field).alias("s")).collect()
        assert len(rows) == len(cases.TEXTS) and all(0 <= r["s"] <= 1 for r in rows)
        assert len({r["s"] for r in rows if not r["text"]}) == 1
    assert {r["s"] for r in rows} == {0.5}
    assert cases.empty(spark).select(C.score(docs, field)).count() == 0


def test_the_bound_holds_for_rows(spark, monkeypatch):
    """Many rows under one id, or under both labels of it, do not reach the driver."""
    docs = cases.docs(spark, [(1, "one text"), (2, "another text")] * 500 + [(3, "third")])
    marks = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(C, "fit", lambda texts, labels: seen.append((texts, labels)))
    C.train(docs, marks, max_docs=10)
    texts, labels = seen[0]
    assert len(texts) == 10 and labels.count(0) == labels.count(1) == 5
