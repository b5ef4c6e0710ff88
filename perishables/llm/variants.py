"""Spelling variants: words within one edit of each other, found by dynamic programming over sorted lists.

Words are the letter runs of at least ``min_chars`` code points that occur ``min_count`` times overall.  Two words are
near if exactly one code point is inserted, deleted or replaced between them.

* Which lists.  Of two near words, let m be the length of the shorter and h = m // 2: they share the first h code
  points or the last m - h.  So every word stands in the lists (m, its first h) and (m, its last m - h) for m its own
  length and one less, and near words share a list.  A list of more than ``LIST_ROWS`` words is split the same
  way by halves of what its words do not share, level upon level, until its free parts have at most two code points.
* In a list.  The words are sorted (those that share their end, from their end), and adjacent words' longest common
  prefixes are taken.  Rows of the edit matrix belong to a prefix, so all words of the range that share
  it reuse its row; only the three cells around the diagonal can hold one edit.  Rows go down from a range to the
  ranges that its next code point opens, and a range whose prefix already exceeds one edit is skipped
  with all its words.  The rows of many words at once are numpy columns.

Defined cases: a null text has no words; a null id counts as empty in ``<id>:<run>``; rows are read one by one, so repeated rows
count again; equal counts go to the word smallest in code-point order; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perishables.llm.common import small_batches, store

RUN = re.compile("[a-zÀ-ÿ]+")   # of texts whose A-Z are lowered
GAP = re.compile("[^a-zÀ-ÿ]")
TEXT_STEP = 1 << 20     # code points whose runs are held at once
HELD_WORDS = 1 << 18    # distinct words that a task counts before it hands them on
LIST_ROWS = 1 << 15     # words of a list before it is split
SOLVE_ROWS = 1 << 16    # words (of whole lists) that a task solves at once
FRONTIER = 1 << 20      # (word, range) pairs that a search holds before it splits the words
HELD_DEPTHS = 64        # prefix lengths whose ranges a search remembers
FAR = 2                 # a cell beyond one edit

Edit = Callable[[str, str], str]


# ---------------------------------------------------------------- words
def drop_by_checksum(modulus: int = 199) -> Edit:
    """A planted misspelling: where ``modulus`` divides crc32 of ``<id>:<run>``, the run loses one code point."""

    def edit(row_id: str, run: str) -> str:
        h = zlib.crc32(f"{row_id}:{run}".encode())
        if h % modulus:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]

    return edit


def _runs(text: str) -> Iterator[list[str]]:
    """The runs of a text, a bounded stretch at a time; no stretch ends inside a run."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + TEXT_STEP)
        end = gap.start() if gap else len(text)
        yield RUN.findall(text, at, end)
        at = end


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5,
          edit: Edit | None = None) -> DataFrame:
    """``(word, n)`` of the words, after ``edit(id, run)`` of every run, counted over all documents."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("raw")).filter(F.col("raw").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for row_id, raw in zip(batch.column("id").to_pylist(), batch.column("raw")):
                for runs in _runs(raw.as_py().lower().decode()):   # bytes.lower: only A-Z
                    for run, n in Counter(runs).items():
                        if len(run) >= min_chars:
                            word = edit(row_id, run) if edit else run
                            if len(word) >= min_chars:
                                held[word] += n
                if len(held) > HELD_WORDS:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    found = slim.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= min_count)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                      names=["word", "n"])


# ---------------------------------------------------------------- lists
def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the two lists below its own: what its words share grows by one half of the free part.

    ``rows``: ``list`` (what the words share), ``word``, ``n``, ``size`` (m of the whole words), ``free`` (m of the
    part they need not share), ``front`` and ``back`` (code points of it that lie in shared ends), ``turned``.
    """
    half = F.floor(F.col("free") / 2).cast("int")
    rest = F.char_length("word") - F.col("front") - F.col("back")
    tail = F.col("free") - half
    first = F.struct(F.concat_ws("\x01", "list", F.lit("p"), F.substring("word", F.col("front") + 1, half)).alias("list"),
                     tail.alias("free"), (F.col("front") + half).alias("front"), F.col("back"),
                     F.coalesce("turned", F.lit(False)).alias("turned"))
    last = F.struct(F.concat_ws("\x01", "list", F.lit("s"), F.substring("word", F.col("front") + rest - tail + 1, tail)).alias("list"),
                    half.alias("free"), F.col("front"), (F.col("back") + tail).alias("back"),
                    F.coalesce("turned", F.lit(True)).alias("turned"))
    return rows.select("word", "n", "size", F.explode(F.array(first, last)).alias("l")).select("word", "n", "size", "l.*")


def _lists(vocabulary: DataFrame, list_rows: int) -> Iterator[DataFrame]:
    """Rows by lists of at most ``list_rows`` words (or with free parts of two code points)."""
    length = F.char_length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")) \
        .filter(F.col("size") > 0) \
        .select(F.col("size").cast("string").alias("list"), "word", "n", "size", F.col("size").alias("free"),
                F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit(None).cast("boolean").alias("turned"))
    while True:
        rows = store(_halves(rows), "variant-lists")
        # a list with words but no shorter one (or with one word) holds no pair that another list does not
        asks = (F.char_length("word") == F.col("size")).cast("int")
        sizes = store(rows.groupBy("list").agg(F.count(F.lit(1)).alias("held"), F.max(asks).alias("asked"), F.max("free").alias("most"))
                      .filter((F.col("held") > 1) & (F.col("asked") > 0)), "variant-sizes")
        big = (F.col("held") > list_rows) & (F.col("most") > 2)
        sized = rows.join(sizes, "list")
        yield sized.filter(~big).drop("held", "asked", "most")
        if sizes.filter(big).isEmpty():
            return
        rows = sized.filter(big).drop("held", "asked", "most")


def _search(points: np.ndarray, at: np.ndarray, size: np.ndarray, prefix: np.ndarray, starts: np.ndarray, stops: np.ndarray,
            ask: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(asking word, near word)`` of sorted lists.  ``points[at[i]:at[i] + size[i]]`` is word i, ``prefix[i]`` what it
    shares with the word before it in its list, ``starts`` and ``stops`` the asking words' lists."""
    todo = [(ask, starts, stops, np.full(len(ask), FAR, np.int8), np.zeros(len(ask), np.int8), np.ones(len(ask), np.int8), 0)]
    opening: dict[int, np.ndarray] = {}
    while todo:
        word, lo, hi, below, here, above, depth = todo.pop()
        if len(word) > FRONTIER:
            mid = len(word) // 2
            todo += [tuple(x[mid:] for x in (word, lo, hi, below, here, above)) + (depth,),
                     tuple(x[:mid] for x in (word, lo, hi, below, here, above)) + (depth,)]
            continue
        # the word that is the prefix itself comes first in its range
        ends = size[lo] == depth
        if ends.any():
            gap = size[word] - depth
            cell = np.where(gap == 0, here, np.where(gap == 1, above, np.where(gap == -1, below, FAR)))
            near = ends & (cell == 1)
            if near.any():
                yield word[near], lo[near]
            lo = lo + ends
            open_ = lo < hi
            word, lo, hi, below, here, above = (x[open_] for x in (word, lo, hi, below, here, above))
        if not len(word):
            continue
        # ranges that the next code point opens: they start where adjacent words share no more than this prefix
        if depth not in opening:
            if len(opening) == HELD_DEPTHS:
                opening.clear()
            opening[depth] = np.append(np.flatnonzero(prefix <= depth), len(prefix))
        opens = opening[depth]
        first, last = np.searchsorted(opens, lo), np.searchsorted(opens, hi)
        count = last - first
        pair = np.repeat(np.arange(len(word)), count)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        lo, hi = opens[k], np.minimum(opens[k + 1], hi[pair])
        word, below, here, above = word[pair], below[pair], here[pair], above[pair]
        point, long, base = points[at[lo] + depth], size[word], at[word]
        limit = len(points) - 1

        def differs(j: int) -> np.ndarray:   # code point j of the asking word against the range's
            if j < 0:
                return np.ones(len(word), bool)
            return (points[np.minimum(base + j, limit)] != point) | (long <= j)

        below_ = np.minimum(here + 1, below + differs(depth - 1)).astype(np.int8)
        below_[long < depth] = FAR
        here_ = np.minimum(np.minimum(above + 1, below_ + 1), here + differs(depth)).astype(np.int8)
        here_[long < depth + 1] = FAR
        above_ = np.minimum(here_ + 1, above + differs(depth + 1)).astype(np.int8)
        above_[long < depth + 2] = FAR
        keep = (below_ <= 1) | (here_ <= 1) | (above_ <= 1)
        todo.append((word[keep], lo[keep], hi[keep], below_[keep], here_[keep], above_[keep], depth + 1))


def near_in_lists(lists: list[str], held: list[str], sizes: list[int], turned: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of near words ``(asking, near)``; the asking words are those as long as their list's ``size``."""
    keyed = sorted(range(len(held)), key=lambda i: (lists[i], held[i][::-1] if turned[i] else held[i]))
    text = [held[i][::-1] if turned[i] else held[i] for i in keyed]
    size = np.fromiter(map(len, text), np.int64, len(text))
    at = np.cumsum(size) - size
    points = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
    new = np.ones(len(text), bool)
    new[1:] = [lists[a] != lists[b] for a, b in zip(keyed, keyed[1:])]
    # common prefixes of adjacent words of a list
    prefix = np.where(new, -1, 0)
    going, depth = np.flatnonzero(~new), 0
    while len(going):
        both = (size[going] > depth) & (size[going - 1] > depth)
        going = going[both]
        going = going[points[at[going] + depth] == points[at[going - 1] + depth]]
        depth += 1
        prefix[going] = depth
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(text))
    group = np.cumsum(new) - 1
    ask = np.flatnonzero(size == np.asarray(sizes)[keyed])
    found = list(_search(points, at, size, prefix, start[group[ask]], stop[group[ask]], ask))
    order = np.asarray(keyed)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate([a for a, _ in found])], order[np.concatenate([b for _, b in found])]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of whole lists; the rows come sorted by list."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.Table) -> pa.RecordBatch:
        word, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        a, b = near_in_lists(rows.column("list").to_pylist(), word, rows.column("size").to_pylist(), rows.column("turned").to_pylist())
        take = rows.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays([take.take(pa.array(a)), pa.array(n[a]), take.take(pa.array(b)), pa.array(n[b])],
                                          names=["a", "n_a", "b", "n_b"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SOLVE_ROWS:
            rows = pa.Table.from_batches(held)
            lists = rows.column("list").to_pylist()
            cut = len(lists)
            while cut and lists[cut - 1] == lists[-1]:
                cut -= 1
            if cut:
                yield solve(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        if rows.num_rows:
            yield solve(rows)


def near_words(vocabulary: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(word, n, near, near_n)``: every near pair of ``vocabulary(word, n)``, both ways; the words are distinct."""
    parts = None
    for rows in _lists(vocabulary, list_rows):
        dealt = rows.repartition("list").sortWithinPartitions("list").select("list", "word", "n", "size", "turned")
        pairs = store(dealt.mapInArrow(_solve, "a string, n_a bigint, b string, n_b bigint"), "variant-pairs")
        parts = pairs if parts is None else parts.unionAll(pairs)
    both = parts.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("p"))
    return both.select("p.*").distinct()


# ---------------------------------------------------------------- forms
def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: each word's forms followed to the last, by doubling; counts grow along forms, so there is no cycle."""
    now = store(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = store(step, "variant-roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def group_variants(vocabulary: DataFrame, ratio: int = 5, list_rows: int = LIST_ROWS) -> DataFrame:
    """``vocabulary(word, n)`` with ``n_near``, ``form``, ``form_n`` and ``root``.

    A word's form is its near word of largest n (ties: the smallest), if that n is at least ``ratio`` (2 or more) times its
    own, else null; the root is the last of its forms, or the word itself.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    vocabulary = store(vocabulary.select("word", "n"), "variant-words")
    best = store(near_words(vocabulary, list_rows).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
        .select("word", "n_near", F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(
            F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))).alias("best"))
        .select("word", "n_near", "best.form", "best.form_n"), "variant-best")
    roots = _roots(best.filter("form IS NOT NULL"))
    return vocabulary.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
