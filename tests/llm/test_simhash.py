from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from perishables.llm import components, simhash
from perishables.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import cases


def plain_fingerprint(text, size=3):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split() if w]
    parts = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Least id that each row reaches, by comparing all pairs."""
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
            label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(rows))]


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in docs]
    want = sorted((i, f"{fp:016x}", c) for (i, fp), c in zip(prints, plain_components(prints)))
    got = E.queries()["op10_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_spark_hash_is_the_contracts(spark):
    texts = ["", "a", "the quick brown", "é" * 40, "x" * 100]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert [g % 2**64 for g in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


def test_index_finds_every_link(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 20, dtype=np.uint64)
    codes = set(centres.tolist())
    for c in centres.tolist():  # dense clouds
        for _ in range(60):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(b)
            codes.add(x)
    fps = np.array(sorted(codes), np.uint64)
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    want = {(i, j) for i, j in combinations(range(len(fps)), 2) if bin(int(fps[i] ^ fps[j])).count("1") <= 2}
    for frontier in (1 << 20, 64):
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        a, b = simhash.index_links(np.zeros(len(fps), int), fps, 2)
        assert set(zip(a.tolist(), b.tolist())) == want


def test_hot_nodes_are_split_without_losing_links(spark, monkeypatch):
    rng = random.Random(1)
    rows = []
    for centre in (0, rng.getrandbits(64), rng.getrandbits(64)):
        for i in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randrange(4)):
                x ^= 1 << b
            rows.append(x)
    fps = sorted(set(rows))
    for size in (512, 4):  # no split, and splits of every level
        monkeypatch.setattr(simhash, "NODE_ROWS", size)
        signed = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
        found = components.connected_components(simhash._links(simhash._nodes(signed), 2)).collect()
        got = {r["node"] % 2**64: r["root"] % 2**64 for r in found}
        groups = {}
        for x in fps:
            groups.setdefault(got.get(x, x), set()).add(x)
        want = {}
        for x, c in zip(fps, plain_components([(x, x) for x in fps])):
            want.setdefault(c, set()).add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_every_node_of_the_last_level_is_bounded():
    for nodes in simhash.block_masks(3).values():
        for _, mask in nodes:
            assert 64 - bin(mask % 2**64).count("1") <= 20


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = dict(components.connected_components(edges).collect())
    assert got == {**{i: 0 for i in range(1, 71)}, 101: 100}


def test_odd_cases(spark):
    rows = simhash.near_duplicates(cases.docs(spark)).select("id", "fp", "component").collect()
    prints = [(i, plain_fingerprint(t)) for i, t in cases.TEXTS]
    want = sorted(((i, fp, c) for (i, fp), c in zip(prints, plain_components(prints))), key=repr)
    assert sorted(((r["id"], r["fp"] % 2**64, r["component"]) for r in rows), key=repr) == want
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = cases.docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == cases.COLUMNS
    groups = plain_components([(n, plain_fingerprint(t)) for n, (_, t) in enumerate(cases.TEXTS)])
    rows = kept.collect()
    assert len(rows) == len(set(groups))
    assert sum(r["text"] == cases.SENTENCE for r in rows) == 1 and simhash.keep_one(cases.empty(spark)).count() == 0
