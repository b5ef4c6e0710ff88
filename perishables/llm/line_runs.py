"""Line deduplication by a suffix array over line-ID sequences, in DataFrame expressions only.

Documents are sequences of lines that hold a word (blank lines stand aside and always stay).  A run of lines counts as
repeated when it has ``min_words`` words or more and stands at an earlier place too; places are ordered by document id
(nulls last), then row, then line.  Later copies are deleted, and touching ones make up the maximal runs.

Suffixes are ranked by distributed prefix doubling: ranks over 2**k lines come from sorting pairs of ranks over half as
many, of which only those that occur twice go on.  Each ranking sorts distinct pairs by range, writes them, and adds
the counts of the ranges before.  Two suffixes lie in one interval of common prefixes of n lines exactly if
their ranks over 2**k lines agree at their starts and at n - 2**k lines behind (2**k <= n < 2**(k+1)).

Every repeated run is a union of runs that fall below ``min_words`` without their first or without their last line.  They have
at most ``min_words`` lines, so ranks over more lines would not split an interval that decides.
``maximal_runs`` goes on doubling to the whole suffix order and lists the maximal repeated runs by their common prefixes.

Defined cases: a null text stays null and has no lines; repeated rows (same id and text) are one document, whose rows
are all treated alike; a text without a word is left as it is; other columns are carried along or not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.llm.common import store, with_text
from perishables.llm.simhash import row_keys

BLANKS = " \t\n\x0b\x0c\r"
NO_WORD = r"[\x20\x09-\x0D]+"
DOC = ("k1", "k2")


def _worded(text: Column) -> Column:
    """(at, line) of the lines that hold a word; ``at`` counts all lines from 0."""
    lines = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    return F.filter(lines, lambda x: F.btrim(x["line"], F.lit(BLANKS)) != "")


def _n_words(line: Column) -> Column:
    return F.size(F.split(F.btrim(line, F.lit(BLANKS)), NO_WORD))


def _deciding_runs(words: Column, at: Column, min_words: int) -> Column:
    """Lengths of the runs from line ``at`` (from 0) that have enough words, but not without their first
    or not without their last line."""
    def enough(n: Column) -> Column:
        total = F.aggregate(F.slice(words, at + 1, n), F.lit(0), lambda a, b: a + b)
        shorter = total - F.greatest(F.get(words, at), F.get(words, at + n - 1))
        return (total >= min_words) & (shorter < min_words)

    return F.filter(F.sequence(F.lit(1), F.least(F.lit(min_words), F.size(words) - at)), enough)


def sequences(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """A row per line with a word: document, place, 128-bit line ID and the lengths of deciding runs from there."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *row_keys(id_col, text_col),
                       F.col(f"`{text_col}`").cast("string").alias("text")) \
        .withColumn("lines", _worded(F.col("text"))).drop("text") \
        .withColumn("words", F.transform("lines", lambda x: _n_words(x["line"])))
    placed = rows.select("id", *DOC, "words", F.posexplode("lines").alias("p", "x"))
    return placed.select("id", *DOC, "p", F.xxhash64("x.line").alias("h1"), F.xxhash64(F.lit(1), F.col("x.line")).alias("h2"),
                         _deciding_runs(F.col("words"), F.col("p"), min_words).alias("runs"))


def ranked(pairs: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """``pairs(*keys, n)``, whose keys are distinct, plus ``rank``: how many rows stand before them in key order.

    Rows are sorted by range and written with the number of their range, so the count within a range
    and the counts of the ranges before it are taken from the same rows.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = store(pairs.repartitionByRange(parts, *keys).withColumn("range", F.spark_partition_id()), "line-ranks")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sizes = ranges.groupBy("range").agg(F.sum("n").alias("size")) \
        .withColumn("offset", F.coalesce(F.sum("size").over(before.orderBy("range")), F.lit(0))).select("range", "offset")
    within = F.coalesce(F.sum("n").over(before.partitionBy("range").orderBy(*keys)), F.lit(0))
    return ranges.withColumn("within", within).join(sizes, "range") \
        .select(*keys, (F.col("offset") + F.col("within")).alias(rank))


def _at(distance: int, column: str) -> Column:
    """The value ``distance`` lines further on in the document, null if there is none."""
    ahead = Window.partitionBy(*DOC).orderBy("p").rangeBetween(distance, distance)
    return F.max(column).over(ahead) if distance else F.col(column)


def _between(column: str, least: int, most: int) -> Column:
    return F.filter(column, lambda n: n.between(least, most))


def _doubled(level: DataFrame, span: int) -> DataFrame:
    """Ranks over twice ``span`` lines of the suffixes that share them with another."""
    pairs = level.withColumn("next", _at(span, "rank")).filter(F.col("next").isNotNull())
    again = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    numbers = ranked(again, ["rank", "next"], "new")
    return pairs.join(numbers, ["rank", "next"]).select("id", *DOC, "p", "runs", F.col("new").alias("rank"))


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6) -> DataFrame:
    """``(k1, k2, first, lines)``: deciding runs that stand at an earlier place too."""
    lines = store(sequences(docs, id_col, text_col, min_words), "line-sequences")
    again = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    level = lines.join(ranked(again, ["h1", "h2"], "rank"), ["h1", "h2"]).select("id", *DOC, "p", "runs", "rank").distinct()
    span, found = 1, None
    while span <= min_words:
        level = store(level, "line-suffixes")
        own = _between("runs", span, 2 * span - 1)
        ahead = F.array(*(_at(d, "rank") for d in range(span)))
        runs = level.withColumn("own", own).withColumn("ahead", ahead) \
            .select("id", *DOC, "p", "rank", "ahead", F.explode("own").alias("lines")) \
            .withColumn("last", F.get("ahead", F.col("lines") - span)).filter(F.col("last").isNotNull()).drop("ahead")
        found = runs if found is None else found.unionAll(runs)
        level, span = _doubled(level, span), 2 * span
    place = F.struct(F.col("id").isNull().alias("none"), "id", *DOC, "p")
    found = store(found.withColumn("place", place).select("place", "lines", "rank", "last"), "line-runs")
    interval = ["lines", "rank", "last"]
    # the first place of each interval, where there are more; written, so that the join can split a hot interval
    firsts = store(found.groupBy(*interval).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
                   "line-firsts")
    return found.join(firsts, interval).filter(F.col("place") > F.col("first")) \
        .select(*(F.col(f"place.{k}").alias(k) for k in DOC), F.col("place.p").alias("first"), "lines")


def suffix_ranks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, DataFrame]]:
    """``(span, rows(id, k1, k2, p, rank))`` by prefix doubling to the end: ranks over 1, 2, 4, ... lines of every suffix, until
    no two suffixes that still share a rank differ further on.  A text's end stands before every line."""
    lines = store(sequences(docs, id_col, text_col, 1).select("id", *DOC, "p", "h1", "h2").distinct(), "suffix-lines")
    own = store(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "suffix-pairs")
    level = store(lines.join(ranked(own, ["h1", "h2"], "rank"), ["h1", "h2"]).select("id", *DOC, "p", "rank"), "suffix-ranks")
    levels, span, groups = [(1, level)], 1, own.count()
    while True:
        pairs = level.withColumn("next", F.coalesce(_at(span, "rank"), F.lit(-1).cast("bigint")))
        own = store(pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")), "suffix-pairs")
        size = own.count()
        if size == groups:
            return levels
        level = store(pairs.join(ranked(own, ["rank", "next"], "new"), ["rank", "next"]).select("id", *DOC, "p", F.col("new").alias("rank")),
                      "suffix-ranks")
        span, groups = 2 * span, size
        levels.append((span, level))


def maximal_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 1) -> DataFrame:
    """``(id, k1, k2, first, lines)``: the maximal runs of lines with a word that stand at another place too.

    Suffixes are numbered in order; the common prefix of two that follow each other is the rest of both if their last ranks agree,
    else found from the longest span down, as their ranks over it agree or not.  A place's run is the longer of its two common prefixes; it is maximal
    unless the run from the line before reaches as far.
    """
    levels = suffix_ranks(docs, id_col, text_col)
    rest = F.count(F.lit(1)).over(Window.partitionBy(*DOC)) - F.col("p")
    keys = ["rank", "none", "id", *DOC, "p", "rest"]
    last = levels[-1][1].withColumn("none", F.col("id").isNull()).withColumn("rest", rest).withColumn("n", F.lit(1))
    order = store(ranked(last, keys, "place"), "suffix-order")
    sides = [order.select((F.col("place") - back).alias("place"), *(F.col(c).alias(f"{c}_{side}") for c in (*DOC, "p", "rest")))
             for side, back in (("a", 0), ("b", 1))]
    beside = store(sides[0].join(sides[1], "place").withColumn("n", F.lit(0).cast("bigint")), "suffix-neighbours")
    for span, level in reversed(levels):
        for side in "ab":
            on = [F.col(f"{c}_{side}") == F.col(f"l.{c}") for c in DOC] + [F.col(f"p_{side}") + F.col("n") == F.col("l.p")]
            beside = beside.join(level.select(*DOC, "p", "rank").alias("l"), on, "left") \
                .select(*(F.col(c) for c in beside.columns), F.col("l.rank").alias(f"rank_{side}"))
        # the last ranks are those of whole suffixes
        reach = F.least("rest_a", "rest_b") if level is levels[-1][1] else F.lit(span).cast("bigint")
        same = F.when(F.col("rank_a") == F.col("rank_b"), reach).otherwise(F.lit(0))
        beside = store(beside.withColumn("n", F.col("n") + same).drop("rank_a", "rank_b"), "suffix-neighbours")
    runs = [beside.select(*(F.col(f"{c}_{side}").alias(c) for c in (*DOC, "p")), F.col("n").alias("lines")) for side in "ab"]
    longest = runs[0].unionAll(runs[1]).groupBy(*DOC, "p").agg(F.max("lines").alias("lines"))
    found = longest.withColumn("before", F.coalesce(_at(-1, "lines"), F.lit(0))) \
        .filter((F.col("before") <= F.col("lines")) & (F.col("lines") >= min_lines))
    return found.join(order.select("id", *DOC, "p"), [*DOC, "p"]).select("id", *DOC, F.col("p").alias("first"), "lines")


def drop_later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6) -> DataFrame:
    """``doc`` (the old row), ``body`` (the text without later copies), ``n_lines`` (with a word) and ``deleted`` (their places among
    all lines, from 0) of every row."""
    copies = later_copies(docs, id_col, text_col, min_words)
    gone = copies.select(*DOC, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lines") - 1)).alias("p")) \
        .groupBy(*DOC).agg(F.collect_set("p").alias("gone"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *row_keys(id_col, text_col)) \
        .join(gone, list(DOC), "left")
    text = F.col("doc")[text_col].cast("string")
    worded = F.when(F.col("gone").isNotNull(), _worded(text))
    none = F.array().cast("array<int>")
    rows = rows.withColumn("worded", worded).withColumn("deleted", F.when(
        F.col("gone").isNotNull(), F.array_sort(F.transform("gone", lambda p: F.get("worded", p)["at"]))).otherwise(none))
    lines = F.split(text, "\n")
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "deleted")
    body = F.when(F.size("deleted") > 0, F.array_join(F.transform(rest, lambda at: F.get(lines, at)), "\n")) \
        .otherwise(text)
    n_lines = F.size(F.coalesce(F.col("worded"), _worded(F.coalesce(text, F.lit("")))))
    return rows.select("doc", body.alias("body"), n_lines.cast("bigint").alias("n_lines"), "deleted")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6) -> DataFrame:
    """``docs`` without later copies of line runs; a document that loses its last line with a word goes."""
    rows = drop_later_copies(docs, id_col, text_col, min_words)
    left = rows.filter((F.size("deleted") == 0) | (F.size("deleted") < F.col("n_lines")))
    return with_text(left, docs, text_col, F.size("deleted") > 0)
