from __future__ import annotations

import hashlib
import random
import re

import pytest

from perishables.llm import decontaminate as D
from tests.llm import cases

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, items, window=10):
    """Hit words and items by trying every window at every place."""
    words = WORD.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, other in items:
        own = WORD.findall((other or "").encode().lower())
        size = min(window, len(own))
        for s in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at:at + size] == own[s:s + size]:
                    hit.update(range(at, at + size))
                    found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found)


def test_random_texts_against_every_window(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices("abc", k=rng.choice([0, 1, 2, 3, 4, 9])))) for i in range(12)]
    texts = [(i, " ".join(rng.choices("abcd", k=rng.randrange(30)))) for i in range(60)]
    table = spark.createDataFrame([*items, (3, None), (5, items[5][1])], "item_id long, text string")
    for limit in (200_000, 8):  # one automaton, and many small ones
        got = D.match_items(cases.docs(spark, texts), table, window=3, max_words=limit)
        for r in got.select("doc_id", "text", "n_words", D.hit_words().alias("n"), "items").collect():
            assert (r["n_words"], r["n"], r["items"]) == plain(r["text"], items, 3)


def test_an_item_longer_than_a_shard_is_cut_between_windows(spark):
    rng = random.Random(9)
    items = [(1, " ".join(rng.choices("abcdefgh", k=400))), (2, " ".join(rng.choices("abcdefgh", k=61))), (3, "a b")]
    words = items[0][1].split()
    texts = [(i, " ".join(["x", *words[i:i + rng.randrange(2, 12)], "y"])) for i in range(0, 396, 3)]
    table = spark.createDataFrame(items, "item_id long, text string")
    shards = list(D._shards(table, "item_id", "text", 4, 80))
    assert len(shards) > 5 and max(len(own) for shard in shards for _, own in shard) <= 10
    for r in D.match_items(cases.docs(spark, texts[::4]), table, window=4, max_words=160) \
            .select("doc_id", "text", "n_words", D.hit_words().alias("n"), "items").collect():
        assert (r["n_words"], r["n"], r["items"]) == plain(r["text"], items, 4)


def test_odd_cases(spark):
    items = spark.createDataFrame([(1, cases.SENTENCE), (2, "mit license"), (None, "another text under id three"), (3, None), (4, "")],
                                  "item_id long, text string")
    rows = D.match_items(cases.docs(spark), items).collect()
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        words, hit, found = plain(r["text"], [(1, cases.SENTENCE), (2, "mit license"), ("none", "another text under id three")])
        assert r["n_words"] == words and sum(s["stop"] - s["start"] for s in r["spans"]) == hit
        assert r["items"] == [i for i in found if i != "none"]
    assert D.match_items(cases.empty(spark), items).count() == 0
    none = D.match_items(cases.docs(spark), items.limit(0)).collect()
    assert all(r["spans"] == [] and r["items"] == [] for r in none)


def test_spans_are_cut_and_covered_documents_go(spark):
    item = spark.createDataFrame([(1, cases.SENTENCE)], "item_id long, text string")
    around = "Before A B it, é words " * 20
    docs = cases.docs(spark, [(1, f"{around}<{cases.SENTENCE}>. After"), (2, cases.SENTENCE), (3, None), (4, "clean")])
    got = {r["doc_id"]: r for r in D.decontaminate(docs, item).collect()}
    assert set(got) == {1, 3, 4} and got[1]["text"] == f"{around}<>. After" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] is None and got[4]["text"] == "clean" and list(got[1].asDict()) == cases.COLUMNS


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("seed", range(5))
def test_automaton_streams_like_search(seed):
    rng = random.Random(seed)
    items = [[bytes([c]) for c in rng.choices(b"ab", k=rng.randrange(12))] for _ in range(5)]
    machine = D.ItemAutomaton(items, 4)
    for _ in range(50):
        words = [bytes([c]) for c in rng.choices(b"abc", k=rng.randrange(25))]
        spans, found = machine.match(words)
        _, hit, ids = plain(" ".join(w.decode() for w in words), [(i, " ".join(w.decode() for w in it)) for i, it in enumerate(items)], 4)
        assert sum(b - a for a, b in spans) == hit and sorted(map(str, found)) == ids
