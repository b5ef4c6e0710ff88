"""Every stage against a plain version on the rows that the stage before it kept."""
from __future__ import annotations

import numpy as np

import corpus_pipeline
from perishables.llm import pieces, quality_rules
from perishables.llm.common import store, table
from tests.conftest import SF_SMALL
from tests.llm import cases
from tests.llm.test_decontaminate import WORD
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_line_runs import WORD as LINE_WORD
from tests.llm.test_line_runs import plain as plain_lines
from tests.llm.test_quality_rules import plain as plain_quality
from tests.llm.test_simhash import plain_components, plain_fingerprint


def good(rows):
    _, failed, distance = plain_quality([(r["text"], r["lang"], r["source"]) for r in rows])
    return [r for r, f, d in zip(rows, failed, distance) if not f and d <= quality_rules.RobustSettings().cut]


def without_lines(rows):
    gone, out = plain_lines([(r["doc_id"], r["text"]) for r in rows], 6), []
    for r in rows:
        own = set(gone[r["doc_id"], r["text"]])
        lines = r["text"].split("\n")
        if own and len(own) == sum(bool(LINE_WORD.search(x)) for x in lines):
            continue
        out.append(r | ({"text": (t := "\n".join(x for i, x in enumerate(lines) if i not in own)), "n_chars": len(t)} if own else {}))
    return out


def one_each(rows):
    found = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    return [r for r, c in zip(rows, found) if r["doc_id"] == c]


def decontaminated(rows, items):
    out = []
    for r in rows:
        if plain_hits(r["text"], items)[1]:
            raw = r["text"].encode()
            places = [m.span() for m in WORD.finditer(raw.lower())]
            words = WORD.findall(raw.lower())
            hit = set()
            for _, item in items:
                own = WORD.findall(item.encode().lower())
                for s in range(len(own) - 9):
                    hit.update(k for at in range(len(words) - 9) if words[at:at + 10] == own[s:s + 10] for k in range(at, at + 10))
            if len(hit) > 0.5 * len(words):
                continue
            gone = np.zeros(len(raw), bool)
            for k in sorted(hit):
                gone[places[k][0]:places[k + 1][0] if k + 1 in hit else places[k][1]] = True
            text = bytes(b for b, g in zip(raw, gone) if not g).decode()
            r = r | {"text": text, "n_chars": len(text)}
        out.append(r)
    return out


def test_stages_against_plain_versions(spark):
    documents = table(spark, SF_SMALL, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    rows, frame = [r.asDict() for r in documents.collect()], documents
    plain = [good, without_lines, one_each, lambda rows: decontaminated(rows, items)]
    for (name, stage), step in zip(corpus_pipeline.STAGES, plain):
        rows = step(rows)
        frame = store(stage(spark, frame, SF_SMALL), f"test-{name}")
        assert frame.columns == documents.columns
        assert sorted((r.asDict() for r in frame.collect()), key=lambda r: r["doc_id"]) == sorted(rows, key=lambda r: r["doc_id"]), name
    model = pieces.PieceModel.read(corpus_pipeline.PIECE_MODEL)
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert len(last) == len(rows)
    for r in rows:
        own = last[r["doc_id"]]
        assert own["text"] == r["text"] == model.decode(own["ids"]) and own["round_trip"] and own["n_ids"] == len(own["ids"])


def test_stages_take_odd_rows_and_empty_tables(spark):
    for rows in (cases.docs(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF_SMALL)
            if name != "sentencepiece":
                assert out.columns == cases.COLUMNS
            assert out.count() <= len(cases.TEXTS)
