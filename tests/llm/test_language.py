from __future__ import annotations

import math

import numpy as np
import pytest

import __spark_entry__ as E
from perishables.llm import language as L
from perishables.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import cases


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_differ_in_many_bits(n):
    words = L.codewords(n)
    distance = [(words[i] != words[j]).sum() for i in range(n) for j in range(i)]
    assert min(distance) >= max(1, words.shape[1] // 4)
    assert all(abs(column.sum()) < n for column in words.T)


def test_a_wrong_bit_is_corrected():
    words = L.codewords(5)
    model = L.CodeModel(list("abcde"), words, np.zeros((1 << L.BUCKETS_LOG2, words.shape[1])), words[3] * 4.0, np.ones(words.shape))
    for bit in range(words.shape[1]):
        model.bias = words[3] * 4.0
        model.bias[bit] *= -1
        assert model.predict(["text"], 1.0)["lang_pred"].tolist() == ["d"]


def plain_decoding(model, text, margin):
    """Language, score and ambiguity by loops over the model's codewords and bits."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, False
    counts: dict[int, int] = {}
    raw = "  ".encode() + "".join(c if not c.isascii() or c.isalpha() else " " for c in text.lower()).encode() + b" "
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        bucket = ((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> (32 - L.BUCKETS_LOG2)
        counts[bucket] = counts.get(bucket, 0) + 1
    total = sum(counts.values())
    losses = []
    for k in range(len(model.languages)):
        loss = 0.0
        for bit in range(model.words.shape[1]):
            value = model.bias[bit] + sum((n / total) ** 0.5 * model.weights[bucket, bit] for bucket, n in counts.items())
            loss += model.trust[k, bit] * math.log1p(math.exp(-model.words[k, bit] * value))
        losses.append(loss)
    best = min(range(len(losses)), key=losses.__getitem__)
    score = 1 / sum(math.exp(losses[best] - loss) for loss in losses)
    return model.languages[best], score, len(losses) > 1 and sorted(losses)[1] - losses[best] < margin


def test_loss_weighted_decoding_against_loops(spark):
    learned = table(spark, SF_SMALL, "documents").filter("doc_id % 2 = 0")
    model = L.train(learned, per_language=40)
    texts = [r["text"] for r in table(spark, SF_SMALL, "documents").filter("doc_id % 2 = 1").limit(40).collect()]
    texts += ["", None, "12 34", "a", "the der and und of die", "日本語のテキスト", texts[0][:40] + texts[1][:40]]
    got = model.predict(texts, 1.0)
    for text, name, score, unsure in zip(texts, got["lang_pred"], got["score"], got["ambiguous"]):
        want = plain_decoding(model, text, 1.0)
        assert (name, bool(unsure)) == (want[0], want[2]) and score == pytest.approx(want[1], abs=1e-4)


def test_held_out_texts(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = E.queries()["op4_language_id"](spark, sf).collect()
    left = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and 0.2 < len(left) / len(rows) < 0.3
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in left]) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_odd_cases(spark):
    docs = cases.docs(spark)
    for learned in (docs, docs.limit(0)):
        model = L.train(learned)
        rows = docs.select("text", L.predict(docs, model).alias("g")).collect()
        for r in rows:
            known = bool(learned.count()) and any(c.isalpha() for c in r["text"] or "")
            assert r["g"]["lang_pred"] == ("en" if known else "und") and r["g"]["score"] == float(known)
    assert cases.empty(spark).select(L.predict(docs, model)).count() == 0


def test_mixed_text_is_ambiguous(spark):
    rows = [(i, f"the and of to in that it is was for {i} " * 9, "en") for i in range(60)] + \
        [(100 + i, f"der die und in den von zu das mit sich {i} " * 9, "de") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(table)
    got = model.predict(["the and of that " * 20, "der die und von " * 20, "the and of to in der die und in den " * 20, "Ж"], margin=2.0)
    print(got)
    assert got["lang_pred"].tolist()[:2] == ["en", "de"] and got["ambiguous"].tolist() == [False, False, True, True]


def test_no_language_is_left_out(spark):
    rng = np.random.default_rng(6)
    own = {f"l{k:03d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(3)] for k in range(230)}
    rows = [(1000 * j + i, " ".join(words * 4), lang) for j in range(3) for i, (lang, words) in enumerate(own.items())]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(table, max_rows=460)
    assert model.languages == sorted(own)
    got = model.predict([" ".join(words * 3) for words in own.values()], 1.0)["lang_pred"]
    assert np.mean(got == list(own)) > 0.95


def test_rows_without_ids_are_learned_from_and_bounded(spark, monkeypatch):
    rows = [(None, f"the and of to in that it is was for {i} " * 4, "en") for i in range(900)] + \
        [(5, "der die und in den von zu das mit sich " * 4, "de")] * 900 + [(i, f"le la et les des en un une {i} " * 4, "fr") for i in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = []
    monkeypatch.setattr(L.CodeModel, "fit", classmethod(lambda cls, counts, names: learned.append(names)))
    L.train(table, per_language=20)
    assert {lang: learned[0].count(lang) for lang in set(learned[0])} == {"en": 20, "de": 1, "fr": 9}


def test_one_matrix_of_the_sample_is_held():
    counts = np.array([L.trigrams(t) for t in ("some words of a text", "日本語", "aaa " * 500)], np.float32)
    want = L._features(counts)
    L.CodeModel.fit(counts, ["a", "b", "c"])
    assert np.array_equal(counts, want)   # turned into features in place


def test_a_text_under_two_languages_is_learned_as_both(spark, monkeypatch):
    rows = [(i, "the and of to in that it is", "en") for i in range(3)] + [(9, "both of them", "en"), (9, "both of them", "de"), (9, "both of them", "de")]
    learned = []
    monkeypatch.setattr(L.CodeModel, "fit", classmethod(lambda cls, counts, names: learned.append(names)))
    L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(learned[0]) == ["de", "en", "en", "en", "en"]
