"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton holds every run of consecutive words of every item.  Documents are
streamed through it word by word; the state and the length of the longest
match that ends at each word say which item windows occur there.  A window is
``window`` consecutive words of one item; an item of fewer words (but at least one)
is a single window.

Items are cut into overlapping pieces of at most an eighth of ``max_words`` words (two windows, where that is more), and the
pieces dealt by hash to shards of about ``max_words`` words.  One shard's automaton is built on the driver and
broadcast, so its size is bounded by that parameter, however long an item; with more
shards the documents pass them one after the other, with a written table in between.

Defined cases: a null text has no words; a null item text has no window; an item
without id still marks words but is not listed; repeated items and documents are
treated alike; other columns of either table are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables.llm.common import plain_words, small_batches, store, with_text

ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each state.

    ``match`` streams one document and returns the merged word spans that lie in item
    windows and the positions (in the given list) of the items that occur.
    """

    def __init__(self, items: list[list[bytes]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for words in items]
        for words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.shortest = min([window, *(len(words) for words in coded if words)])
        self._note_items(coded)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for its strings of at most length(state) + 1 words."""
        twin = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = twin
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = twin
            state = self.link[state]
        return twin

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # the string is known from an earlier item
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def _note_items(self, coded: list[list[int]]) -> None:
        """Items of each state with strings of a window's length, and short items by the state of their text."""
        self.items: list[set[int] | None] = [None] * len(self.next)
        short: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(coded):
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and self.length[up] >= self.window:
                    found = self.items[up] = self.items[up] or set()
                    if item in found:
                        break
                    found.add(item)
                    up = self.link[up]
            if 0 < len(words) < self.window:
                short.setdefault(state, []).append((len(words), item))
        self.short: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] = (*short.get(state, ()), *self.short[self.link[state]])

    def _stream(self, codes: list[int], offset: int, spans: list[list[int]], found: set[int]) -> None:
        state = matched = 0
        following, link, length, window = self.next, self.link, self.length, self.window

        def cover(start: int, stop: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, stop])

        for at, word in enumerate(codes, offset + 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state, matched = following[state][word], matched + 1
            if matched >= window:
                cover(at - matched, at)
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                found |= self.items[up]
            for size, item in self.short[state]:
                if size <= matched:
                    cover(at - size, at)
                    found.add(item)

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        spans: list[list[int]] = []
        found: set[int] = set()
        if len(words) < self.shortest:
            return spans, found
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        # only runs of words that items have, and long enough for a window, can match
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        for start, stop in edges.reshape(-1, 2)[(edges[1::2] - edges[::2]) >= self.shortest].tolist():
            self._stream(codes[start:stop].tolist(), start, spans, found)
        return spans, found


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _pieces(items: DataFrame, id_col: str, text_col: str, window: int, max_words: int) -> DataFrame:
    """``(item, words)``: items of more than an eighth of ``max_words`` words in pieces that overlap by ``window`` - 1 words, so
    that each window of an item stands in exactly one piece."""
    most = max(2 * window, max_words // 8)
    words = F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(ANY_WORD), F.lit(0))
    starts = F.when(F.size("words") > most, F.sequence(F.lit(1), F.size("words") - window + 1, F.lit(most - window + 1))) \
        .otherwise(F.array(F.lit(1)))
    return items.select(F.col(f"`{id_col}`").cast("string").alias("item"), words.alias("words")).filter(F.size("words") > 0) \
        .select("item", F.explode(F.transform(starts, lambda at: F.slice("words", at, F.lit(most)))).alias("words"))


def _shards(items: DataFrame, id_col: str, text_col: str, window: int, max_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in lists of about ``max_words`` words; only one list is on the driver at a time."""
    slim = store(_pieces(items, id_col, text_col, window, max_words).distinct(), "decontaminate-items")
    size = slim.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, -(-size // max_words))
    dealt = slim.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)))
    for shard in range(shards):
        yield [(row["item"], plain_words(" ".join(row["words"]).encode())) for row in dealt.filter(F.col("shard") == shard).collect()]


def match_items(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text",
                item_id: str = "item_id", item_text: str = "text", max_words: int = 200_000) -> DataFrame:
    """``docs`` plus ``n_words``, ``spans`` (merged, in words, end exclusive) and ``items`` (sorted ids that occur).

    A column of ``docs`` by one of these names is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "spans", "items")]
    out = docs.select(*(F.col(f"`{c}`") for c in kept))
    schema = T.StructType([*out.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])
    for number, shard in enumerate(_shards(items, item_id, item_text, window, max_words)):
        automaton = spark.sparkContext.broadcast(
            ([item for item, _ in shard], ItemAutomaton([words for _, words in shard], window)))

        def step(batches, automaton=automaton, number=number):
            ids, machine = automaton.value
            for batch in batches:
                counts, spans, found = [], [], []
                for row, raw in enumerate(batch.column(text_col).cast(pa.string()).cast(pa.binary()).to_pylist()):
                    words = plain_words(raw)
                    own, names = machine.match(words)
                    got = {ids[i] for i in names} - {None}
                    if number:
                        own = _merged([[s["start"], s["stop"]] for s in batch.column("spans")[row].as_py()], own)
                        got |= set(batch.column("items")[row].as_py())
                    counts.append(len(words))
                    spans.append([{"start": a, "stop": b} for a, b in own])
                    found.append(sorted(got))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(counts, pa.int64()), pa.array(spans, SPAN_ARROW),
                     pa.array(found, pa.list_(pa.string()))], names=[*kept, "n_words", "spans", "items"])

        out = (store(out, "decontaminate") if number else out).mapInArrow(step, schema)
    return out


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  text_col: str = "text", **names) -> DataFrame:
    """``docs`` with the matching spans cut out of the text, without documents of which more than
    ``max_coverage`` of the words match.  A cut reaches from the first to the last matching word; what stands
    around it stays as it is.  Untouched texts (null ones too) come back unchanged."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    slim = docs.select(F.struct(*others, F.lit(None).cast("string").alias(text_col)).alias("doc"),
                       F.col(f"`{text_col}`").cast("string").alias("body"))
    hits = match_items(slim, items, window, "body", **names)
    rest = hits.filter(hit_words() <= F.col("n_words") * F.lit(max_coverage))
    touched = F.size("spans") > 0
    # only the few texts that are cut travel to Python again
    body = F.when(touched, _cut(F.when(touched, F.col("body")), F.col("spans"))).otherwise(F.col("body"))
    return with_text(rest.withColumn("body", body), docs, text_col, touched)


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, own in zip(texts, spans):
        if text is not None:
            raw = text.encode()
            places = [m.span() for m in WORD.finditer(raw.lower())]
            parts, at = [], 0
            for span in own:
                parts.append(raw[at:places[span["start"]][0]])
                at = places[span["stop"] - 1][1]
            text = b"".join([*parts, raw[at:]]).decode()
        out.append(text)
    return pd.Series(out, dtype=object)
