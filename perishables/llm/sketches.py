"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted ``k`` smallest distinct hashes (first 64 bits of MD5, as 16 hex digits) of a text's five-word shingles.
Sketches of parts merge into the sketch of the whole: the ``k`` smallest of both.  A text is sketched that way itself,
``STEP`` shingles at a time, so that a very long one never holds all its hashes.  From sketches follow

* resemblance: the share of the union's ``k`` smallest hashes that both have,
* containment: of one's hashes up to the smaller of the two last hashes, the share that the other has,
* the distinct shingle count: the sketch's size while it is not full, else (k - 1) / (the k-th hash as a fraction of all).

``with_next`` gives every row the one that follows it by id, without a window over all rows: a sample of the rows' order keys
(a few keys a partition) cuts the order into buckets, a row finds its bucket by binary search, and each
bucket's first row, which is the cut itself, is also dealt to the bucket before it.

Defined cases: a null text is empty; words are runs of anything but blanks, tabs and line ends, as they stand; fewer than five words are one
shingle, no words an empty sketch; two empty sketches are alike (1), an empty and another are not (0).  Rows without an id come first,
rows of one id follow each other in an order of their own (by text hash, then as read), and the last row is followed by the first; a
single row is followed by itself.  The input must be one that reads in the same order again, as files do.
Other columns are kept or not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.llm.common import store

K, WORDS = 128, 5
STEP = 4096            # shingles whose hashes are held at once
BUCKETS = 8            # buckets of the order per shuffle partition, so that tasks get about the same
CUTS = 2               # sampled order keys per bucket
BLANKS = r"[\x20\x09-\x0D]+"
HASHES = 18446744073709551616.0   # 2**64, how many hashes there are


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---------------------------------------------------------------- sketches
def words(text: Column) -> Column:
    trimmed = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), rf"^{BLANKS}|{BLANKS}$", "")
    return _let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANKS)))


def smallest(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return smallest(F.concat(a, b), k)


def sketch(text: Column, k: int = K, size: int = WORDS, step: int = STEP) -> Column:
    """The sketch of a text."""

    def of(w: Column) -> Column:
        last = F.greatest(F.size(w) - F.lit(size - 1), F.lit(1))

        def part(start: Column) -> Column:
            places = F.sequence(start, F.least(start + F.lit(step - 1), last))
            return F.transform(places, lambda p: F.substring(F.md5(F.array_join(F.slice(w, p, size), " ")), 1, 16))

        whole = F.aggregate(F.sequence(F.lit(1), last, F.lit(step)), F.array().cast("array<string>"),
                            lambda held, start: merge(held, part(start), k))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(whole)

    return _let(words(text), of)


def as_text(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either text that both have."""
    return _let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u).cast("double")))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has."""
    def last(hashes: Column) -> Column:   # no hash is greater, if all are held
        return F.when(F.size(hashes) < k, F.lit("g")).otherwise(F.element_at(hashes, -1))

    bound = F.least(last(a), last(b))
    return _let(bound, lambda top: _let(F.filter(a, lambda h: h <= top), lambda held: F.when(
        F.size(held) == 0, (F.size(a) == 0).cast("double")).otherwise(F.size(F.array_intersect(held, b)) / F.size(held).cast("double"))))


def distinct_shingles(hashes: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact while the sketch is not full)."""
    top = F.conv(F.element_at(hashes, k), 16, 10).cast("decimal(20,0)").cast("double")
    return F.when(F.size(hashes) < k, F.size(hashes).cast("bigint")).otherwise(
        F.floor(F.lit((k - 1) * HASHES) / F.greatest(top, F.lit(1.0))).cast("bigint"))


def merge_rows(parts: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """``keys`` and ``sketch_col``: the sketches of all parts of a key (documents of a source, say) merged.

    Distinct hashes are counted off before they meet: each task hands on the ``k`` smallest of each of its keys (a
    window group limit), so a key with very many parts stays small.  Empty sketches are kept; a null sketch is empty.
    """
    named = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)]
    by = [f"k{i}" for i in range(len(keys))]
    hashes = parts.select(*named, F.explode_outer(F.col(f"`{sketch_col}`")).alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("h").asc_nulls_last()))
    kept = hashes.withColumn("place", place).filter(F.col("place") <= k)
    return kept.groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias("h")).select(
        *(F.col(b).alias(c) for b, c in zip(by, keys)), F.col("h").alias(sketch_col))


# ---------------------------------------------------------------- the next row
def _placed(rows: DataFrame, cuts: Column, bits: int) -> DataFrame:
    """The rows with ``bucket``, the number of the last cut at or before ``key``: a binary search, one step a bit.

    The cuts are a subquery's value, which rows do not carry; higher-order functions do not take one.
    """
    rows = rows.withColumn("bucket", F.lit(0))
    for bit in reversed(range(bits)):
        far = F.col("bucket") + F.lit(1 << bit)
        rows = rows.withColumn("bucket", F.when(F.get(cuts, far) <= F.col("key"), far).otherwise(F.col("bucket")))
    return rows


def with_next(rows: DataFrame, id_col: str, text_col: str, prepare: dict[str, Column], wanted: list[str]) -> DataFrame:
    """The rows as ``id``, ``text`` (null: empty) and the ``prepare`` columns (over ``text``), with ``next_<name>`` of every wanted column."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = rows.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("at")) \
        .select("id", "text", F.struct("id", F.xxhash64("text").alias("h"), "at").alias("key"))
    buckets = BUCKETS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rate = max(1, rows.count() // (CUTS * buckets))
    sampled = F.col("key").isNotNull() & (F.pmod(F.xxhash64("key"), F.lit(rate)) == 0)
    sample = slim.agg(F.min("key").alias("least"), F.sort_array(F.collect_list(F.when(sampled, F.col("key")))).alias("keys"))
    found = sample.select(F.concat(F.array("least"), F.filter("keys", lambda k, i: ((i + 1) % CUTS == 0) & (k > F.col("least")))).alias("cuts"))
    cuts = store(found, "order-cuts").scalar()   # written once, as the sample would be read again for every use
    placed = _placed(slim, cuts, (4 * buckets).bit_length())
    # the first row of a bucket is also the last of the one before
    first = F.col("key") == F.get(cuts, F.col("bucket"))
    before = F.when(F.col("bucket") == 0, F.size(cuts) - 1).otherwise(F.col("bucket") - 1)
    dealt = placed.select("id", "text", "key", F.explode(F.when(first, F.array(
        F.struct("bucket", F.lit(False).alias("extra")), F.struct(before.alias("bucket"), F.lit(True).alias("extra"))))
        .otherwise(F.array(F.struct("bucket", F.lit(False).alias("extra"))))).alias("to"))
    dealt = dealt.select("id", "text", "key", "to.bucket", "to.extra").repartition("bucket")
    made = dealt.withColumns(prepare)
    order = Window.partitionBy("bucket").orderBy("extra", "key")
    ahead = made.withColumns({f"next_{c}": F.lead(c).over(order) for c in wanted})
    return ahead.filter(~F.col("extra")).drop("bucket", "extra", "key")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = WORDS) -> DataFrame:
    """Every row's sketch, its edited text and that one's sketch, and the next row's sketch.

    The edited text has the last half of the code points (rounded down) replaced by as many first ones of the next row's text.
    Columns: ``id, text, n_chars, sketch, edited, edited_sketch, next_sketch``.
    """
    ahead = with_next(docs, id_col, text_col, {"sketch": sketch(F.col("text"), k, size)}, ["text", "sketch"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    return ahead.withColumn("n_chars", F.char_length("text").cast("bigint")).withColumn("edited", edited) \
        .withColumn("edited_sketch", sketch(F.col("edited"), k, size)) \
        .select("id", "text", "n_chars", "sketch", "edited", "edited_sketch", "next_sketch")
