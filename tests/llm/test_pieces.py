from __future__ import annotations

import base64
import random
import time

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as E
from perishables.llm import pieces
from perishables.llm.common import table
from perishables.llm.queries import PIECE_MODEL
from tests.conftest import SF_SMALL
from tests.llm import cases


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.read(PIECE_MODEL)


def ids(model, text, cache=None):
    return np.frombuffer(model.encode([text.encode()], {} if cache is None else cache)[0], np.int32).tolist()


def plain(model, text):
    """Viterbi over characters of the whole text, without a trie, splits or blocks; whole-number scores are exact."""
    known = {p.decode(): i for i, p in enumerate(model.pieces) if model.kinds[i] == pieces.NORMAL}
    text = "▁" + text.replace(" ", "▁")
    longest = max(map(len, known))
    best = [(0.0, 0, 0)] + [None] * len(text)
    for start in range(len(text)):
        steps = [(text[start:end], end) for end in range(start + 1, min(len(text), start + longest) + 1)]
        for piece, end in steps:
            if piece in known:
                score = best[start][0] + float(model.scores[known[piece]])
                if best[end] is None or score > best[end][0]:
                    best[end] = (score, start, known[piece])
        if text[start] not in known and (best[start + 1] is None or best[start][0] + model.unknown_score > best[start + 1][0]):
            best[start + 1] = (best[start][0] + model.unknown_score, start, None)
    out, at = [], len(text)
    while at:
        _, start, i = best[at]
        out[:0] = [i] if i is not None else [model.byte_ids[b] for b in text[start:at].encode()]
        at = start
    return out


SAMPLES = ["a", " a", "a ", "a  b", "   ", "\n", "a\nb", "a \n b\n\n", "x\x00y", "\x01\n", "a \x01\nb", "日本語 テキスト", "naïve café!", "🙂 ok",
           "ab" * 300, "tab\there", "CamelCaseWords and_snake_case 12345"]


def test_best_paths_are_those_of_plain_viterbi(spark, model):
    texts = [r["text"][:400] for r in table(spark, SF_SMALL, "documents").limit(25).collect()]
    cache = {}
    for text in [*SAMPLES, *texts]:
        assert ids(model, text, cache) == plain(model, text), text


def test_no_path_of_the_public_library_scores_better(model):
    with open(PIECE_MODEL, "rb") as f:
        raw = f.read()
    spec = next(v for n, v in pieces._fields(raw) if n == 2)
    place = raw.index(spec) + spec.index(b"\x18\x02")  # the trainer's model type: 2 pair merges, 1 unigram
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[:place] + b"\x18\x01" + raw[place + 2:])
    rng = random.Random(2)
    words = ["".join(rng.choices(["th", "er", "on", "in", "st", "ble", "and", "é", "qu"], k=rng.randrange(1, 6))) for _ in range(400)]
    same = 0
    for word in words:
        ours, theirs = ids(model, word), library.encode(word)
        assert sum(model.scores[i] for i in ours) >= sum(model.scores[i] for i in theirs)
        same += ours == theirs
        assert library.decode(ours) == model.decode(ours) == word
    assert same > 0.95 * len(words)


def test_double_array_holds_exactly_the_pieces(model):
    for i, piece in enumerate(model.pieces):
        state = 0
        for byte in piece:
            child = model.base[state] + byte
            state = child if 0 < child < len(model.check) and model.check[child] == state else None
            if state is None:
                break
        assert (state is not None and model.value[state] == i) == (model.kinds[i] == pieces.NORMAL)


def test_cache_stays_bounded_and_does_not_matter(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    cache = {}
    for text in ["one two three four five", "five four", "one one six"]:
        assert ids(model, text, cache) == plain(model, text)


def test_odd_cases(spark):
    docs = cases.docs(spark)
    rows = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL).collect()
    assert len(rows) == len(cases.TEXTS)
    for r in rows:
        assert r["decoded"] == r["text"] and (r["ids"] is None) == (r["text"] is None)
        assert r["ids"] != [] or r["text"] == ""
    assert pieces.decode(pieces.encode(cases.empty(spark), PIECE_MODEL), PIECE_MODEL).count() == 0


def test_query_round_trips_every_text(spark):
    rows = E.queries()["op2_sentencepiece"](spark, SF_SMALL).collect()
    assert len(rows) == table(spark, SF_SMALL, "documents").count()
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)


@pytest.mark.parametrize("kind", ["japanese", "base64", "one letter", "marked"])
def test_unbroken_texts_are_cut_where_no_piece_spans(model, kind, monkeypatch):
    rng = random.Random(8)
    text = {"japanese": lambda n: "".join(chr(rng.choice([rng.randrange(0x3041, 0x3097), rng.randrange(0x4E00, 0x5E00)])) for _ in range(n)),
            "base64": lambda n: base64.b64encode(rng.randbytes(n)).decode(), "one letter": lambda n: "x" * n,
            "marked": lambda n: "\x01 " + "é日x" * n}[kind]
    short = text(300)
    assert ids(model, short) == plain(model, short)
    if kind != "one letter":   # nothing to cut: every stretch of that letter is in pieces
        began = time.monotonic()
        long = text(300_000)
        assert model.decode(ids(model, long)) == long
        assert time.monotonic() - began < 30
    monkeypatch.setattr(pieces, "LONG_WORD", 1 << 30)
    assert ids(model, short) == plain(model, short)


def test_bytes_that_are_no_text(model):
    broken = [model.byte_ids[0xE3], model.byte_ids[0x81]]
    assert model.decode(broken) == "\ufffd" and model.decode([]) == ""
