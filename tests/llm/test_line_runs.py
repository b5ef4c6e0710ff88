from __future__ import annotations

import random
import re

from perishables.llm import line_runs as L
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, least):
    """Deleted lines of (id, text) rows: any run with enough words whose lines stand at an earlier place too."""
    docs = sorted({(i is None, i, t) for i, t in rows if t is not None}, key=lambda d: (d[0], d[1] or 0, d[2]))
    lines = [[(at, x) for at, x in enumerate(t.split("\n")) if WORD.search(x)] for _, _, t in docs]
    seen: dict[tuple, tuple] = {}
    for d, own in enumerate(lines):
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                seen.setdefault(tuple(x for _, x in own[s:e]), (d, s))
    gone = []
    for d, own in enumerate(lines):
        out = set()
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                run = tuple(x for _, x in own[s:e])
                if sum(len(WORD.findall(x)) for x in run) >= least and seen[run] < (d, s):
                    out.update(at for at, _ in own[s:e])
        gone.append(out)
    return {(i, t): sorted(out) for (_, i, t), out in zip(docs, gone)}


def test_random_line_sequences_against_every_run(spark):
    rng = random.Random(11)
    pool = ["a", "b b", "c c c", "d d d d d", "", " ", "e e"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(9)))) for i in range(40)]
    for least in (1, 3, 6, 7):
        want = plain(rows, least)
        for r in L.drop_later_copies(cases.docs(spark, rows), min_words=least).select("doc.doc_id", "doc.text", "deleted", "body").collect():
            assert r["deleted"] == want[r["doc_id"], r["text"]], (least, r)
            gone = set(r["deleted"])
            assert r["body"] == "\n".join(x for at, x in enumerate(r["text"].split("\n")) if at not in gone)


def test_long_repeated_passage_is_deleted_once(spark):
    passage = "\n".join(f"line number {i} of it" for i in range(40))
    rows = [(i, f"own {i} words of this one text\n{passage}\nend {i} of the text it is") for i in range(5)]
    got = {r["doc_id"]: r for r in L.drop_later_copies(cases.docs(spark, rows)).select("doc.doc_id", "deleted", "body").collect()}
    assert got[0]["deleted"] == [] and all(got[i]["deleted"] == list(range(1, 41)) for i in range(1, 5))


def test_odd_cases(spark):
    docs = cases.docs(spark)
    rows = L.drop_later_copies(docs).select("doc.doc_id", "doc.text", "body", "deleted").collect()
    want = plain(cases.TEXTS, 6)
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        if r["text"] is None:
            assert r["body"] is None and r["deleted"] == []
        else:
            assert r["deleted"] == want[r["doc_id"], r["text"]]
    kept = L.without_copies(docs)
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # the copies under id 2 and the repeated lines of 8 go, texts without lines stay
    assert kept.columns == cases.COLUMNS and (2, cases.SENTENCE) not in texts and (1, cases.SENTENCE) in texts
    assert (4, "") in texts and (3, None) in texts and not any(i == 8 for i, _ in texts)
    assert L.without_copies(cases.empty(spark)).count() == 0


def test_main_path_runs_no_python(spark):
    plan = L.drop_later_copies(cases.docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[1])


def test_ranks_count_what_stands_before(spark):
    rng = random.Random(0)
    keys = sorted({(rng.randrange(50), rng.randrange(50)) for _ in range(800)})
    sizes = [rng.randrange(1, 5) for _ in keys]
    got = {(r["a"], r["b"]): r["rank"] for r in L.ranked(
        spark.createDataFrame([(a, b, n) for (a, b), n in zip(keys, sizes)], "a long, b long, n long"), ["a", "b"], "rank").collect()}
    assert [got[k] for k in keys] == [sum(sizes[:i]) for i in range(len(keys))]


def test_common_prefixes_reveal_the_maximal_runs(spark):
    rng = random.Random(2)
    passage = [f"line {i} of a passage" for i in range(11)]
    rows = [(i, "\n".join(rng.choices(["a", "b b", "c", "", "d"], k=rng.randrange(8)))) for i in range(14)]
    rows += [(20 + i, "\n".join([f"own {i}", *passage[i:], "a", "b b"])) for i in range(3)] + [(None, "a\nb b\nc"), (20, None), (30, "")]
    rows += [rows[3], rows[15]]  # repeated rows are one document
    lines = {(i, t): [x for x in t.split("\n") if WORD.search(x)] for i, t in rows if t is not None}
    places: dict[tuple, list] = {}
    for key, own in lines.items():
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                places.setdefault(tuple(own[s:e]), []).append((key, s))
    want = []
    for (i, t), own in lines.items():
        longest = [max([n for n in range(1, len(own) - s + 1) if len(places[tuple(own[s:s + n])]) > 1], default=0) for s in range(len(own))]
        want += [(str(i), s, n) for s, n in enumerate(longest) if n and (s == 0 or longest[s - 1] <= n)]
    got = [(str(r["id"]), r["first"], r["lines"]) for r in L.maximal_runs(cases.docs(spark, rows)).collect()]
    assert sorted(got) == sorted(want) and max(n for _, _, n in got) >= 12
    assert L.maximal_runs(cases.empty(spark)).count() == 0
