from __future__ import annotations

import re

from perishables.llm import license_rules as R
from perishables.llm import licenses as L
from tests.llm import cases


def found(spark, *texts):
    rows = L.scan(cases.docs(spark, list(enumerate(texts)))).select(
        "doc_id", "n_words", "places", "detections", L.labels("detections").alias("labels")).collect()
    return [r for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_every_match_of_a_rule_holds_its_keyword():
    rules = R.rules()
    written = {words for _, _, names in R.FAMILIES for words in names} | {words for _, _, words in R.PASSAGES}
    assert len(written) > 200 and len({r.label for r in rules}) > 80
    assert len({words for _, _, words in R.PASSAGES}) == len(R.PASSAGES)
    for r in rules:
        certain = re.sub(r"\(\?:[^()]*\)\?", "", r.pattern)  # what no match lacks
        parts = re.findall(r"\(\?:([^()]*)\)", certain)
        plain = re.sub(r"\(\?:[^()]*\)", "", certain)
        assert f" {r.keyword} " in plain or any(all(r.keyword in x for x in p.split("|")) for p in parts), r


def test_longer_and_higher_rules_suppress_what_they_cover(spark):
    rows = found(spark, "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-3.0",
                 "Released under the MIT License. All rights reserved.", "This work is licensed under CC BY-NC 4.0.", "no such thing")
    assert [r["labels"] for r in rows] == ["apache-2.0", "gpl-3.0", "all-rights-reserved,mit", "cc-by-nc-4.0", ""]
    assert [(d["first"], d["stop"]) for d in rows[0]["detections"]] == [(0, 8)]


def test_notices_and_full_texts(spark):
    rows = found(
        spark,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, including the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software.",
        "See https://creativecommons.org/licenses/by-nc-sa/4.0/ and http://www.apache.org/licenses/LICENSE-2.0",
        "The Software shall be used for Good, not Evil.", "for research purposes only; you may not reverse engineer, decompile or disassemble it")
    assert [r["labels"] for r in rows] == ["mit", "gpl,or-later", "bsd-3-clause", "apache-2.0,cc-by-nc-sa", "json",
                                           "eula,non-commercial"]


def test_base_places_stay_though_covered(spark):
    row, = found(spark, "The MIT-license, mit license; GNU General Public License v3 é")
    assert [(d["first"], d["label"]) for d in sorted(row["places"], key=lambda d: d["first"])] == [(1, "mit"), (3, "mit"), (6, "gpl")]
    assert row["n_words"] == 11


def test_odd_cases(spark):
    rows = L.scan(cases.docs(spark)).select("doc_id", "text", "n_words", "places", "detections").collect()
    assert len(rows) == len(cases.TEXTS)
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in rows:
        assert r["n_words"] == len(word.findall((r["text"] or "").encode().lower()))
        assert bool(r["places"]) == (r["text"] == "MIT License")
    assert L.scan(cases.empty(spark)).count() == 0


def test_many_detections_in_one_text(spark):
    row, = found(spark, "mit license " * 3000)
    assert len(row["places"]) == 3000 and row["places"][-1]["first"] == 5998


def test_main_path_runs_no_python(spark):
    plan = L.scan(cases.docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[1])
