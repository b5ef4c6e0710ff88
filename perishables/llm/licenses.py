"""Licence scan by ordered signature rules, in DataFrame expressions only.

A document whose lower-cased text holds none of the rules' keywords is done after one look.  In the others the words
are taken, rules whose keyword stands there are matched, and every match becomes a detection
(first word, end, rule).  A detection is suppressed when another of the same or a higher priority
covers its words; among equal intervals of equal priority the earlier rule stays.  Base phrases are reported
besides, whatever covers them.

All work on a document happens in its row: no shuffle, and memory is bounded by the text.

Defined cases: a null text is empty; documents without detection have no words reported, empty labels and score 0;
repeated rows are scanned alike; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perishables.llm.common import fresh
from perishables.llm.license_rules import Rule, rules

# letters, digits and everything beyond ASCII
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DETECTION = "array<struct<first:bigint,stop:bigint,label:string,priority:int,confidence:double,rule:int,base:boolean>>"


def _rule_table(found: tuple[Rule, ...]) -> Column:
    return F.array(*(F.struct(
        F.lit(f" {r.keyword} ").alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"),
        F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"), F.lit(r.number).alias("rule"),
        F.lit(r.base).alias("base")) for r in found))


def _words_in(text: Column) -> Column:
    """Words of a piece of blank-padded text: each has two blanks."""
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def _detections(padded: Column, rule: Column) -> Column:
    """(first, stop) of every match: the matches and what stands between them, measured in words."""
    matches = F.regexp_extract_all(padded, rule["pattern"], F.lit(0))
    between = F.split(padded, rule["pattern"], -1)
    sized = F.transform(F.arrays_zip(matches.alias("m"), F.slice(between, F.lit(1), F.size(matches)).alias("g")),
                        lambda x: F.struct(_words_in(x["g"]).alias("gap"), _words_in(x["m"]).alias("size")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(DETECTION).alias("out"))

    def place(done: Column, own: Column) -> Column:
        first = done["at"] + own["gap"]
        one = F.struct(first.alias("first"), (first + own["size"]).alias("stop"), rule["label"].alias("label"),
                       rule["priority"].alias("priority"), rule["confidence"].alias("confidence"),
                       rule["rule"].alias("rule"), rule["base"].alias("base"))
        return F.struct((first + own["size"]).alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    return F.aggregate(sized, start, place)["out"]


def _unsuppressed(detections: Column, priorities: list[int]) -> Column:
    """Detections that none of at least their priority covers: one pass in order of the first word, the longest
    and highest first, keeps how far each priority has reached."""
    ordered = F.transform(
        F.sort_array(F.transform(detections, lambda d: F.struct(
            d["first"].alias("a"), (-d["stop"]).alias("b"), (-d["priority"]).alias("c"), d["rule"].alias("r"), d.alias("d")))),
        lambda x: x["d"])
    start = F.struct(*(F.lit(-1).cast("bigint").alias(f"p{p}") for p in priorities), F.array().cast(DETECTION).alias("out"))

    def place(done: Column, d: Column) -> Column:
        reach = F.greatest(*(F.when(d["priority"] <= p, done[f"p{p}"]).otherwise(F.lit(-1)) for p in priorities))
        return F.struct(*(F.when(d["priority"] == p, F.greatest(done[f"p{p}"], d["stop"])).otherwise(done[f"p{p}"]).alias(f"p{p}")
                          for p in priorities),
                        F.when(reach >= d["stop"], done["out"]).otherwise(F.concat(done["out"], F.array(d))).alias("out"))

    return F.aggregate(ordered, start, place)["out"]


def scan(docs: DataFrame, text_col: str = "text", found: tuple[Rule, ...] | None = None) -> DataFrame:
    """``docs`` plus ``n_words``, ``places`` (matches of base phrases) and ``detections`` (what is not suppressed).

    Columns of ``docs`` by these names are replaced.
    """
    found = found or rules()
    own = ("n_words", "places", "detections")
    kept = [c for c in docs.columns if c.lower() not in own]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keywords = sorted({r.keyword for r in found})
    gate = f"(?i)(?<![a-z0-9])(?:{'|'.join(keywords)})(?![a-z0-9])"
    words = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(ANY_WORD), F.lit(0))
    padded = F.when(text.rlike(gate), F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")))
    padding, present, every_match = fresh([*kept, *own], "padded", "present", "every")
    hits = docs.select(*(F.col(f"`{c}`") for c in kept), F.regexp_count(text, F.lit(ANY_WORD)).cast("bigint").alias("n_words"),
                       padded.alias(padding))
    standing = F.filter(F.array(*(F.lit(f" {k} ") for k in keywords)), lambda k: F.contains(F.col(padding), k))
    hits = hits.withColumn(present, F.when(F.col(padding).isNotNull(), standing))
    every = F.flatten(F.transform(F.filter(_rule_table(found), lambda r: F.array_contains(F.col(present), r["keyword"])),
                                  lambda r: _detections(F.col(padding), r)))
    none = F.array().cast(DETECTION)
    hits = hits.withColumn(every_match, F.when(F.size(present) > 0, every).otherwise(none))
    priorities = sorted({r.priority for r in found})
    return hits.select(*(F.col(f"`{c}`") for c in kept), "n_words", F.filter(every_match, lambda d: d["base"]).alias("places"),
                       F.when(F.size(every_match) > 0, _unsuppressed(F.col(every_match), priorities)).otherwise(none).alias("detections"))


def labels(detections: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def confidence(detections: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(detections, lambda d: d["confidence"])), F.lit(0.0))
