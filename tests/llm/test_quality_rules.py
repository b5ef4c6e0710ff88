from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from perishables.llm import quality_rules as Q
from perishables.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(re.findall("[A-Z]", text)))


def vector(n, chars, symbols, dup, repeat, upper):
    m = max(n, 1)
    x = (np.log(max(chars, 1) / m), np.log(1 + 20 * symbols / m), np.log(1 + 100 * dup / m), np.log(1 + 10 * repeat / m),
         np.log((upper + 1) / (chars + 10)))
    return [float(np.floor(1000 * v + 0.5)) if v >= 0 else -float(np.floor(0.5 - 1000 * v)) for v in x]


def plain_distances(x, s=Q.RobustSettings()):
    """Concentration steps on one group, from both starts."""
    floor = 1000 * np.array(s.floors)
    med = np.median(x, axis=0)
    mad = np.median(abs(x - med), axis=0)
    z = (x - med) / np.maximum(1.4826 * mad, floor)
    ends = []
    for start, d in enumerate(((z * z).sum(axis=1), (z * z).max(axis=1))):
        for _ in range(s.steps):
            rank = np.floor(200 * np.log(1 + d) + 0.5)
            near = x[rank <= np.quantile(rank, s.half)]
            mean = near.mean(axis=0)
            cov = s.consistency * (near.T @ near / len(near) - np.outer(mean, mean)) + np.diag(floor**2)
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        ends.append((np.linalg.slogdet(cov)[1], start, d))
    return min(ends, key=lambda e: e[:2])[2]


def plain(rows, s=Q.RobustSettings()):
    """(base counts, base_failed, distance) of (text, lang, source) rows."""
    found = [counts(t) for t, _, _ in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in found]
    sizes = Counter((lang, src) for (_, lang, src), f in zip(rows, failed) if not f)
    pools = Counter()
    for (lang, _), n in sizes.items():
        pools[lang] += n if n < s.min_group else 0
    groups = defaultdict(list)
    for i, ((_, lang, src), f) in enumerate(zip(rows, failed)):
        if not f:
            groups[(lang, src) if sizes[lang, src] >= s.min_group else (lang,) if pools[lang] >= s.min_group else ()].append(i)
    distance = [None] * len(rows)
    for own in groups.values():
        for i, d in zip(own, plain_distances(np.array([vector(*found[i]) for i in own]), s)):
            distance[i] = d
    return found, failed, distance


@pytest.mark.parametrize("sf", [SF_SMALL, SF_SMALL.replace("0.001", "0.01")])
def test_query_against_plain_estimates(spark, sf):
    docs = table(spark, sf, "documents").collect()
    found, failed, distance = plain([(r["text"], r["lang"], r["source"]) for r in docs])
    got = {r["doc_id"]: r for r in E.queries()["op5_quality_rules"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r, c, f, d in zip(docs, found, failed, distance):
        own = got[r["doc_id"]]
        assert tuple(own[n] for n in Q.BASE_COLUMNS) == c[:5] and own["base_failed"] == f
        assert (own["distance"] is None) == f and (f or own["distance"] == pytest.approx(d, rel=1e-6, abs=1e-6))
        assert own["kept"] == (not f and d <= Q.RobustSettings().cut)


def test_good_documents_stay_and_junk_goes(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    marks = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    rows = [r for r in E.queries()["op5_quality_rules"](spark, sf).collect() if not r["base_failed"] and r["doc_id"] in marks]
    good, bad = ([r["kept"] for r in rows if marks[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_odd_cases(spark):
    rows = Q.assess(cases.docs(spark)).select("doc.doc_id", "doc.text", *Q.BASE_COLUMNS, "base_failed", "kept").collect()
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        assert tuple(r[n] for n in Q.BASE_COLUMNS) == counts(r["text"])[:5]
    assert [r["text"] is None for r in rows if r["doc_id"] == 3].count(True) == 1
    kept = Q.keep_good(cases.docs(spark))
    assert kept.columns == cases.COLUMNS and Q.keep_good(cases.empty(spark)).count() == 0


def test_main_path_runs_no_python(spark):
    plan = Q.assess(cases.docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[1])


def test_a_third_of_far_off_copies_is_rejected(spark):
    rng = np.random.default_rng(9)
    rows = [(f"{' '.join('w' * int(rng.integers(3, 8)) + str(rng.integers(10**6)) for _ in range(120))}", "en", "web") for _ in range(200)]
    junk = "#$% " + " ".join("LONGUPPERCASEWORD" + str(i) + "#$%&*" for i in range(60)) + "\nX # Y $ Z" * 8
    rows += [(junk, "en", "web")] * 100
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in Q.assess(docs, carry=["doc_id"]).select("doc.doc_id", "base_failed", "kept").collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert not any(got[i]["kept"] for i in range(200, 300)) and np.mean([got[i]["kept"] for i in range(200)]) > 0.98
