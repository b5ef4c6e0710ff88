"""Quality rules: robust multivariate outliers per language and source, in DataFrame and SQL expressions only.

Fixed base rules fail a document first.  The others become vectors of five transformed statistics, and
each (language, source) group gets minimum-covariance-determinant estimates of centre and scatter.  A document whose
squared Mahalanobis distance from its group's centre exceeds ``cut`` is rejected.

Estimates: from two starting subsets (the share ``half`` of rows nearest the medians by summed and by greatest
scaled deviation), concentration steps take the mean and covariance of the subset and then the nearest rows as the
next subset; the start that ends with the smaller determinant counts.  Vectors are whole thousandths, so that sums of
products are exact and no result depends on how rows are dealt out, and the quantiles that bound a subset come from
counts of a bounded number of distinct values.  A fixed variance is added to each statistic, so that groups in
which one never varies do not reject its first small value.

Only aggregates of one row per group meet the vectors again; texts are read once.  Groups of fewer than
``min_group`` vectors are pooled by language, and such pools once more.

Defined cases: a null text has no words and fails the base rules; null languages and sources are groups of their
own; repeated rows count as often as they occur; other columns are carried along or not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perishables.llm.common import fresh, store

BLANKS = " \t\n\x0b\x0c\r"
NO_WORD = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# the transformed statistics as SQL over whole-text counts, in thousandths
VECTOR = {
    "x1": "ln(greatest(word_chars, 1) / greatest(n_words, 1))",
    "x2": "ln(1 + 20 * n_symbols / greatest(n_words, 1))",
    "x3": "ln(1 + 100 * n_dup_lines / greatest(n_words, 1))",
    "x4": "ln(1 + 10 * n_repeat_words / greatest(n_words, 1))",
    "x5": "ln((n_upper + 1) / (word_chars + 10))",
}
X = tuple(VECTOR)
PAIRS = tuple((i, j) for i in range(len(X)) for j in range(i + 1))


@dataclass(frozen=True)
class RobustSettings:
    """``floors`` are the standard deviations added to each statistic, in its own unit."""

    half: float = 0.5
    steps: int = 4
    cut: float = 30.856        # the 0.99999 quantile of chi-square with five degrees of freedom
    consistency: float = 1.91  # of the covariance of the nearest half of normal rows in five dimensions
    min_group: int = 30
    floors: tuple[float, ...] = (0.075, 0.15, 0.3, 0.3, 0.375)


# ------------------------------------------------------------------ statistics
def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the base counts and ``n_upper`` of each whole text (columns by these names are replaced)."""
    own = (*BASE_COLUMNS, "n_upper")
    kept = [c for c in docs.columns if c.lower() not in own]
    body, words, triples, hashes, lines = fresh([*kept, *own], "body", "words", "triples", "hashes", "lines")
    out = docs.withColumn(body, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    trimmed = F.btrim(F.col(body), F.lit(BLANKS))
    out = out.withColumn(words, F.when(trimmed != "", F.split(trimmed, NO_WORD)).otherwise(F.array().cast("array<string>")))
    n = F.size(words)
    # (word, next, next but one, place); rows at the end without followers are cut off
    zipped = F.arrays_zip(F.slice(words, F.lit(1), n - 2).alias("a"), F.slice(words, F.lit(2), n - 2).alias("b"),
                          F.slice(words, F.lit(3), n - 2).alias("c"), F.sequence(F.lit(1), n - 2).alias("at"))
    out = out.withColumn(triples, F.when(n > 3, zipped))
    out = out.withColumn(hashes, F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])))
    # distinct hashes prove distinct windows; only other texts need the exact comparison
    repeated = F.when(F.size(hashes) > F.size(F.array_distinct(hashes)), _repeated_words(F.col(triples))) \
        .otherwise(F.lit(0).cast("bigint"))
    with_word = F.filter(F.split(F.col(body), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    out = out.withColumn(lines, with_word)
    return out.select(
        *(F.col(f"`{c}`") for c in kept), n.cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(F.col(body), F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), F.regexp_count(F.col(body), F.lit("[A-Z]")).cast("bigint").alias("n_upper"))


def _repeated_words(triples: Column) -> Column:
    """Words in windows that occur twice or more: equal windows meet by sorting."""
    ordered = F.sort_array(triples)
    beside = F.filter(F.arrays_zip(ordered.alias("p"), F.slice(ordered, F.lit(2), F.size(triples)).alias("q")),
                      lambda x: (x["p"]["a"] == x["q"]["a"]) & (x["p"]["b"] == x["q"]["b"]) & (x["p"]["c"] == x["q"]["c"]))
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(beside, lambda x: F.array(x["p"]["at"], x["q"]["at"])))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(places, start, lambda done, at: F.struct(
        (at + 2).alias("end"), (done["n"] + (at + 2 - F.greatest(done["end"], at - 1))).alias("n")))["n"]


def vectors(counted: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = counted.withColumn("base_failed", failed)
    return out.withColumns({x: F.expr(f"cast(round(1000 * {formula}) as bigint)") for x, formula in VECTOR.items()})


# ------------------------------------------------------- formulas, as SQL text
def cholesky(settings: RobustSettings) -> list[dict[str, str]]:
    """Columns, level by level, from the sums of a group (n, s<i>, s<i>_<j>) to its centre m<i>, the lower
    triangle l<i>_<j> of its scatter, and the scatter's log-determinant."""
    unit = 1000.0
    levels = [{f"m{i}": f"cast(s{i} as double) / n" for i in range(len(X))}]
    cov = {}
    for i, j in PAIRS:
        extra = f" + {(settings.floors[i] * unit) ** 2!r}D" if i == j else ""
        cov[f"c{i}_{j}"] = f"{settings.consistency!r}D * (cast(s{i}_{j} as double) / n - m{i} * m{j}){extra}"
    levels.append(cov)
    for j in range(len(X)):
        less = "".join(f" - l{j}_{k} * l{j}_{k}" for k in range(j))
        levels.append({f"l{j}_{j}": f"sqrt(c{j}_{j}{less})"})
        below = {}
        for i in range(j + 1, len(X)):
            less = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            below[f"l{i}_{j}"] = f"(c{i}_{j}{less}) / l{j}_{j}"
        if below:
            levels.append(below)
    levels.append({"logdet": " + ".join(f"ln(l{j}_{j})" for j in range(len(X)))})
    return levels


ESTIMATE = (*(f"m{i}" for i in range(len(X))), *(f"l{i}_{j}" for i, j in PAIRS))


def distance_levels() -> list[dict[str, str]]:
    """Columns from a vector and its group's estimate to the squared distance ``d``."""
    levels = []
    for i, x in enumerate(X):
        less = "".join(f" - l{i}_{j} * y{j}" for j in range(i))
        levels.append({f"y{i}": f"({x} - m{i}{less}) / l{i}_{i}"})
    levels.append({"d": " + ".join(f"y{i} * y{i}" for i in range(len(X)))})
    return levels


#: the place of a squared distance among few thousand distinct values, in order
RANK = "cast(round(200 * ln(1 + d)) as bigint)"


def start_levels(settings: RobustSettings) -> list[dict[str, str]]:
    scaled = {f"z{i}": f"abs({x} - med{i}) / greatest(1.4826D * mad{i}, {settings.floors[i] * 1000!r}D)" for i, x in enumerate(X)}
    z = [f"z{i}" for i in range(len(X))]
    return [scaled, {"d": f"case when start = 0 then {' + '.join(f'{v} * {v}' for v in z)} "
                          f"else greatest({', '.join(f'{v} * {v}' for v in z)}) end"}]


def _with(df: DataFrame, levels: list[dict[str, str]]) -> DataFrame:
    for level in levels:
        df = df.withColumns({name: F.expr(text) for name, text in level.items()})
    return df


# ------------------------------------------------------------------- estimates
def _grouped(rows: DataFrame, settings: RobustSettings) -> DataFrame:
    """(lang, source) of the vectors to the name of the group that estimates them."""
    big = f"n >= {settings.min_group}"
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    pools = counts.filter(f"not ({big})").groupBy("lang").agg(F.sum("n").alias("pool"))
    named = counts.alias("c").join(pools.alias("p"), F.col("c.lang").eqNullSafe(F.col("p.lang")), "left")
    return named.select(
        "c.lang", "c.source",
        F.when(F.expr(big), F.to_json(F.array("c.lang", "c.source")))
        .when(F.col("pool") >= settings.min_group, F.to_json(F.array("c.lang"))).otherwise("[]").alias("grp"))


def _to_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "grp")
    match = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return rows.join(g, match, "left").drop("g_lang", "g_source")


def estimates(rows: DataFrame, settings: RobustSettings) -> DataFrame:
    """One row per group: ``grp`` and its estimate, from ``rows(grp, x1..)``."""
    medians = store(rows.groupBy("grp").agg(*(F.percentile(x, 0.5).alias(f"med{i}") for i, x in enumerate(X))), "mcd-medians")
    spread = rows.join(medians, "grp").groupBy("grp") \
        .agg(*(F.percentile(F.abs(F.col(x) - F.col(f"med{i}")), 0.5).alias(f"mad{i}") for i, x in enumerate(X)))
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("start")
    scale = store(medians.join(spread, "grp").select("*", both), "mcd-scale")
    own, formula = scale, start_levels(settings)
    sums = [F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
            *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in PAIRS)]
    for _ in range(settings.steps):
        placed = _with(rows.join(own, "grp"), formula).withColumn("rank", F.expr(RANK))
        bound = store(placed.groupBy("grp", "start").agg(F.percentile("rank", settings.half).alias("bound")), "mcd-bound")
        nearest = placed.join(bound, ["grp", "start"]).filter("rank <= bound")
        own = store(_with(nearest.groupBy("grp", "start").agg(*sums), cholesky(settings))
                    .select("grp", "start", *ESTIMATE, "logdet"), "mcd-estimate")
        formula = distance_levels()
    first = F.min(F.struct("logdet", "start", *ESTIMATE)).alias("best")
    return own.groupBy("grp").agg(first).select("grp", *(F.col(f"best.{c}").alias(c) for c in ESTIMATE))


def assess(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           settings: RobustSettings = RobustSettings(), carry: list[str] | None = None) -> DataFrame:
    """A row per document: the columns ``carry`` (all by default) as struct ``doc``, the base counts,
    ``base_failed``, ``distance`` (null if failed) and ``kept``."""
    carry = docs.columns if carry is None else carry
    slim = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("doc") if carry else F.lit(None).cast("string").alias("doc"),
                       F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{source_col}`").cast("string").alias("source"))
    rows = store(vectors(base_statistics(slim).drop("text")), "quality-rules")
    usable = rows.filter(~F.col("base_failed")).select("lang", "source", *X)
    groups = store(_grouped(usable, settings), "mcd-groups")
    found = estimates(_to_group(usable, groups), settings)
    judged = _with(_to_group(rows, groups).join(found, "grp", "left"), distance_levels())
    distance = F.when(~F.col("base_failed"), F.col("d"))
    return judged.select("doc", *BASE_COLUMNS, "base_failed", distance.alias("distance"),
                         (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= settings.cut)).alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that are kept, as they are."""
    return assess(docs, **settings).filter("kept").select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
