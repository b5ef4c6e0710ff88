from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from perishables.llm import variants as V
from tests.llm import cases


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(v, w)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, n, len(near), counts[form] if form else None]
    for w in counts:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return out


def grouped(spark, counts, **more):
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return {r["word"]: [r["form"], r["n"], r["n_near"], r["form_n"], r["root"]] for r in V.group_variants(table, **more).collect()}


@pytest.mark.parametrize("alphabet, longest, rows", [("ab", 9, 1 << 15), ("ab", 9, 8), ("abé日", 6, 20), ("a", 12, 1 << 15)])
def test_against_every_pair(spark, alphabet, longest, rows):
    rng = random.Random(longest + rows)
    words = {"".join(rng.choices(alphabet, k=rng.randrange(1, longest + 1))) for _ in range(500)}
    counts = {w: rng.choice([5, 5, 6, 30, 31, 200, 1500]) for w in words}
    assert grouped(spark, counts, list_rows=rows) == plain(counts)


def test_hot_lists_are_split(spark):
    """A third of the words share their first half, another third their last."""
    rng = random.Random(1)
    words = {"prefix" + "".join(rng.choices("abcd", k=6)) for _ in range(150)} | {"".join(rng.choices("abcd", k=6)) + "ending" for _ in range(150)}
    words |= {w[:i] + w[i + 1:] for w in list(words)[:40] for i in (0, 3, 8, 11)}
    counts = {w: rng.choice([5, 25, 125]) for w in words}
    want = plain(counts)
    assert grouped(spark, counts, list_rows=1 << 15) == want == grouped(spark, counts, list_rows=16)


def test_search_in_parts(monkeypatch, spark):
    rng = random.Random(2)
    counts = {"".join(rng.choices("abc", k=rng.randrange(3, 8))): 5 for _ in range(300)}
    monkeypatch.setattr(V, "FRONTIER", 64)
    monkeypatch.setattr(V, "HELD_DEPTHS", 2)
    lists = ["x"] * len(counts)
    words = list(counts)
    for m in range(3, 8):
        a, b = V.near_in_lists(lists, words, [m] * len(words), [m % 2 == 0] * len(words))
        want = {(w, v) for w in words for v in words if len(w) == m and one_edit(w, v)}
        assert {(words[i], words[j]) for i, j in zip(a, b)} == want and len(a) == len(want)


def plain_words(rows, least=6, count=5, modulus=199):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def test_words_of_whole_texts(spark, monkeypatch):
    rng = random.Random(4)
    stems = ["".join(rng.choices("abcdefgÀéß÷", k=rng.randrange(4, 12))) for _ in range(60)]
    rows = [(rng.choice([None, 1, 2, 3, n]), " ".join(rng.choices(stems, k=50)).replace("a", rng.choice("aA")) + "1x-") for n in range(120)] + [(9, None), (9, "")]
    monkeypatch.setattr(V, "TEXT_STEP", 17)
    monkeypatch.setattr(V, "HELD_WORDS", 20)
    got = V.words(cases.docs(spark, rows), edit=V.drop_by_checksum(7))
    assert {r["word"]: r["n"] for r in got.collect()} == plain_words(rows, modulus=7)
    # a word with a letter less is a variant of the word
    assert any(r["form"] for r in V.group_variants(got).collect())


def test_odd_cases(spark):
    rows = cases.TEXTS + [(20, "Letter letters " * 5 + "lettér " * 30 + "x" * 70_000 + " " + ("y" * 300 + " ") * 6 + ("y" * 299 + " ") * 40)]
    counts = plain_words(rows)
    got = V.words(cases.docs(spark, rows), edit=V.drop_by_checksum())
    assert {r["word"]: r["n"] for r in got.collect()} == counts
    assert {r["word"]: r["root"] for r in V.group_variants(got).collect()} == {w: v[4] for w, v in plain(counts).items()}
    assert V.group_variants(V.words(cases.empty(spark))).count() == 0
    with pytest.raises(ValueError):
        V.group_variants(got, ratio=1)
