"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)`` over whole tables,
and the DuckDB texts of those that SQL can express."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.llm import (decontaminate, language, licenses, line_runs, negatives, passages, pieces, quality_crf, quality_rules, simhash,
                             sketches, variants, warc)
from perishables.llm.common import table
from perishables.llm.license_rules import rules


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # a public vocabulary, read where it is


def held_out(modulus: int, left_out: int):
    """Whether crc32 of the id as text leaves this remainder; rows without id are learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == left_out, F.lit(False))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(table(spark, sf_dir, "documents"), least=40, similarity=0.8)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL)
    return coded.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_ids"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_crf.train(docs, table(spark, sf_dir, "labels").filter(~held_out(3, 1)))
    scored = docs.select("doc_id", held_out(3, 1).alias("held_out"), quality_crf.score(docs, field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(4, 2))
    model = language.train(docs.filter(~F.col("held_out")))
    return docs.select("doc_id", "held_out", language.predict(docs, model).alias("guess")) \
        .select("doc_id", "held_out", "guess.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_rules.assess(docs, carry=["doc_id"])
    return judged.select("doc.doc_id", *quality_rules.BASE_COLUMNS, "base_failed", "kept",
                         F.round("distance", 6).alias("distance"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.drop_later_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=6)
    return found.select("doc.doc_id", "n_lines", F.size("deleted").cast("bigint").alias("n_deleted"),
                        F.array_join("deleted", ",").alias("deleted_lines"), F.col("body").alias("text"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.match_items(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                     table(spark, sf_dir, "benchmark"), window=10)
    return hits.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_whole(spark, manifest, payloads=False).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("places", lambda d: d["first"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), licenses.labels(F.col("places")).alias("base_labels"),
        licenses.labels(F.concat("places", "detections")).alias("labels"),
        licenses.confidence(F.concat("places", "detections")).alias("score"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, limit=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketches.as_text(own).alias("fingerprint"),
        sketches.as_text(edited).alias("edited_fingerprint"), sketches.resemblance(own, edited).alias("near_edited"),
        sketches.resemblance(own, following).alias("near_next"), sketches.containment(edited, own).alias("edited_held"),
        sketches.distinct_shingles(own).alias("distinct_shingles"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved, scale=256.0, positives=5,
                                     negatives=10, window=(30, 90))
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                        F.col("negative").alias("negative_id"), "positive_score", "negative_score")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = variants.words(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, edit=variants.drop_by_checksum(199))
    return variants.group_variants(counted, ratio=5)


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_sentencepiece, op3_quality_crf, op4_language_id, op5_quality_rules, op6_line_dedup, op7_benchmark_decontamination, op8_warc, op9_license_scan,
    op10_simhash_near_dedup, op11_document_fingerprints, op12_hard_negatives, op13_spelling_variants)}

ORACLE_SQL: dict[str, str] = {}

# words: A-Z lowered, runs of letters, digits and non-ASCII characters
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL["op7_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT p.doc_id, p.s, p.size, x.item_id FROM places p JOIN windows x USING (size, words)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM
  (SELECT doc_id, unnest(range(s, s + size)) AS place FROM (SELECT DISTINCT doc_id, s, size FROM found)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
  sha256(coalesce(ids.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

ORACLE_SQL["op8_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
q AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = ", ".join(f"({r.number}, {_quoted(f' {r.keyword} ')}, {_quoted(r.pattern)}, {_quoted(r.label)}, {r.priority}, {r.confidence}, {r.base})"
                   for r in rules())
# blanks of a padded piece, two for each word
_BLANKS = "(length({0}) - length(replace({0}, ' ', ''))) // 2"

ORACLE_SQL["op9_license_scan"] = f"""
WITH rules(rule, keyword, pattern, label, priority, confidence, base) AS (VALUES {_RULES}),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS padded FROM d),
m AS (SELECT doc_id, rule, label, priority, confidence, base, regexp_extract_all(padded, pattern) AS hits,
        string_split_regex(padded, pattern) AS gaps
      FROM p JOIN rules ON contains(padded, keyword) WHERE regexp_matches(padded, pattern)),
e AS (SELECT * EXCLUDE (hits, gaps), {_BLANKS.format("array_to_string(gaps[1:i], '')")} + {_BLANKS.format("array_to_string(hits[1:i - 1], '')")} AS first,
        {_BLANKS.format("hits[i]")} AS size
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)),
x AS (SELECT *, first + size AS stop FROM e),
kept AS (SELECT * FROM x WHERE NOT EXISTS (
  SELECT 1 FROM x AS o WHERE o.doc_id = x.doc_id AND o.first <= x.first AND o.stop >= x.stop AND o.priority >= x.priority
    AND (o.size > x.size OR o.priority > x.priority OR o.rule < x.rule))),
b AS (SELECT doc_id, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM x WHERE base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score
      FROM (SELECT doc_id, label, confidence FROM kept UNION ALL SELECT doc_id, label, confidence FROM x WHERE base) GROUP BY doc_id)
SELECT p.doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM p LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""

_TRIMMED = r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"

ORACLE_SQL["op6_line_dedup"] = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, place, line, len(string_split_regex({_TRIMMED}, '[\\x20\\x09-\\x0D]+')) AS words
      FROM (SELECT doc_id, unnest(range(0, len(lines))) AS place, unnest(lines) AS line FROM d) WHERE {_TRIMMED} <> ''),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS p FROM l),
r AS (SELECT a.doc_id, a.p, n.n, string_agg(b.line, chr(10) ORDER BY b.p) AS run, sum(b.words) AS words,
        max(b.words) FILTER (b.p = a.p OR b.p = a.p + n.n - 1) AS longest, count(*) AS c
      FROM s AS a CROSS JOIN range(1, 7) AS n(n) JOIN s AS b ON b.doc_id = a.doc_id AND b.p BETWEEN a.p AND a.p + n.n - 1
      GROUP BY a.doc_id, a.p, n.n),
q AS (SELECT *, row_number() OVER (PARTITION BY n, run ORDER BY doc_id, p) AS copy FROM r WHERE c = n AND words >= 6 AND words - longest < 6),
x AS (SELECT DISTINCT q.doc_id, s.place FROM q JOIN s ON s.doc_id = q.doc_id AND s.p BETWEEN q.p AND q.p + q.n - 1 WHERE copy > 1),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS gone FROM x GROUP BY doc_id),
k AS (SELECT u.doc_id, string_agg(u.line, chr(10) ORDER BY u.place) AS text
      FROM (SELECT doc_id, unnest(range(0, len(lines))) AS place, unnest(lines) AS line FROM d) AS u
      LEFT JOIN x ON x.doc_id = u.doc_id AND x.place = u.place WHERE x.place IS NULL GROUP BY u.doc_id),
c AS (SELECT doc_id, count(*) AS n_lines FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(g.n, 0) AS n_deleted, coalesce(g.gone, '') AS deleted_lines,
  CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _quality_rules_sql(settings: quality_rules.RobustSettings = quality_rules.RobustSettings()) -> str:
    """The same statistics, starts and concentration steps as the operator, step by step."""
    q = quality_rules
    x = q.X

    def formulas(levels: list[dict[str, str]]) -> str:
        plain = [{name: re.sub(r"(\d)D\b", r"\1", text) for name, text in level.items()} for level in levels]
        return ", ".join(f"{text} AS {name}" for level in plain for name, text in level.items())

    sums = ", ".join(["count(*) AS n", *(f"sum({v}) AS s{i}" for i, v in enumerate(x)),
                      *(f"sum({x[i]} * {x[j]}) AS s{i}_{j}" for i, j in q.PAIRS)])
    estimate = ", ".join(q.ESTIMATE)
    vector = ", ".join(f"CAST(round(1000 * {formula}) AS BIGINT) AS {name}" for name, formula in q.VECTOR.items())
    ctes = [rf"""t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS lines FROM t),
places AS (SELECT doc_id, p, array_to_string(words[p:p + 2], ' ') AS three
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM w)),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS c FROM places) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS c FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS k FROM again) GROUP BY doc_id),
counts AS MATERIALIZED (SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words,
  CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN covered USING (doc_id)),
v AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {vector} FROM counts),
sizes AS (SELECT lang, source, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
pools AS (SELECT lang, sum(n) AS pool FROM sizes WHERE n < {settings.min_group} GROUP BY lang),
named AS (SELECT s.lang, s.source, CASE WHEN n >= {settings.min_group} THEN [coalesce(s.lang, '<none>'), coalesce(s.source, '<none>')]
  WHEN pool >= {settings.min_group} THEN [coalesce(s.lang, '<none>')] ELSE [] END AS grp
  FROM sizes s LEFT JOIN pools p ON s.lang IS NOT DISTINCT FROM p.lang),
x0 AS MATERIALIZED (SELECT doc_id, grp, {', '.join(x)} FROM v JOIN named ON v.lang IS NOT DISTINCT FROM named.lang
  AND v.source IS NOT DISTINCT FROM named.source WHERE NOT base_failed),
med AS (SELECT grp, {', '.join(f'quantile_cont({c}, 0.5) AS med{i}' for i, c in enumerate(x))} FROM x0 GROUP BY grp),
mad AS (SELECT grp, {', '.join(f'quantile_cont(abs({c} - med{i}), 0.5) AS mad{i}' for i, c in enumerate(x))}
  FROM x0 JOIN med USING (grp) GROUP BY grp),
scale AS (SELECT * FROM med JOIN mad USING (grp), (VALUES (0), (1)) AS starts(start)),
d0 AS MATERIALIZED (SELECT doc_id, grp, start, {', '.join(x)}, {q.RANK} AS rank
  FROM (SELECT *, {formulas(q.start_levels(settings))} FROM x0 JOIN scale USING (grp)))"""]
    for k in range(1, settings.steps + 1):
        ctes.append(f"""e{k} AS MATERIALIZED (SELECT *, {formulas(q.cholesky(settings))} FROM (
  SELECT grp, start, {sums} FROM d{k - 1} JOIN (SELECT grp, start, quantile_cont(rank, {settings.half}) AS bound FROM d{k - 1} GROUP BY grp, start)
  USING (grp, start) WHERE rank <= bound GROUP BY grp, start))""")
        ctes.append(f"""d{k} AS MATERIALIZED (SELECT doc_id, grp, start, {', '.join(x)}, {q.RANK} AS rank
  FROM (SELECT *, {formulas(q.distance_levels())} FROM x0 JOIN (SELECT grp, start, {estimate} FROM e{k}) USING (grp)))""")
    return "WITH " + ",\n".join(ctes) + f""",
best AS (SELECT grp, {estimate} FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY logdet, start) AS r FROM e{settings.steps}) WHERE r = 1),
found AS (SELECT doc_id, d FROM (SELECT *, {formulas(q.distance_levels())} FROM x0 JOIN best USING (grp)))
SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d, 0) <= {settings.cut} AS kept, round(d, 6) AS distance
FROM v LEFT JOIN found USING (doc_id)"""


ORACLE_SQL["op5_quality_rules"] = _quality_rules_sql()


def _document_fingerprints_sql(k: int = sketches.K, size: int = sketches.WORDS) -> str:
    def sketch(text: str) -> str:
        return rf"""(SELECT CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_sort(list_distinct(list_transform(
  range(1, greatest(len(w) - {size - 1}, 1) + 1), lambda i: substring(md5(array_to_string(w[i:i + {size - 1}], ' ')), 1, 16))))[1:{k}] END
  FROM (SELECT list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w))"""

    def likeness(a: str, b: str) -> str:
        union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{k}]"
        return f"CASE WHEN len({union}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_intersect({union}, {a}), {b})) / len({union})::DOUBLE END"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS place, count(*) OVER () AS docs FROM documents),
n AS (SELECT a.doc_id, a.text, length(a.text) AS n_chars, b.doc_id AS next_id,
        left(a.text, length(a.text) - length(a.text) // 2) || left(b.text, length(a.text) // 2) AS edited
      FROM d a JOIN d b ON b.place = a.place % a.docs + 1),
s AS MATERIALIZED (SELECT *, {sketch("text")} AS own, {sketch("edited")} AS other FROM n),
p AS (SELECT s.*, x.own AS following,
        least(CASE WHEN len(s.own) < {k} THEN 'g' ELSE s.own[-1] END, CASE WHEN len(s.other) < {k} THEN 'g' ELSE s.other[-1] END) AS top
      FROM s JOIN s AS x ON x.doc_id = s.next_id),
h AS (SELECT *, list_filter(other, lambda v: v <= top) AS held FROM p)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(other, '') AS edited_fingerprint,
  {likeness("own", "other")} AS near_edited, {likeness("own", "following")} AS near_next,
  CASE WHEN len(held) = 0 THEN (len(other) = 0)::INT::DOUBLE ELSE len(list_intersect(held, own)) / len(held)::DOUBLE END AS edited_held,
  CASE WHEN len(own) < {k} THEN len(own) ELSE CAST(floor({(k - 1) * sketches.HASHES!r}::DOUBLE / greatest(CAST(CAST('0x' || own[{k}] AS UBIGINT) AS DOUBLE), 1.0)) AS BIGINT) END
    AS distinct_shingles
FROM h
"""


ORACLE_SQL["op11_document_fingerprints"] = _document_fingerprints_sql()

ORACLE_SQL["op12_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

# crc32 byte by byte over a table that its polynomial gives; letters above ASCII are two bytes in UTF-8
ORACLE_SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS crcs FROM (SELECT unnest(range(256)) AS i)),
r AS (SELECT id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS bytes FROM r),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], bytes), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, t),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gone AS MATERIALIZED (SELECT word, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, v.word FROM gone g JOIN v ON g.rest = v.word
  UNION SELECT v.word, g.word FROM gone g JOIN v ON g.rest = v.word),
best AS MATERIALIZED (SELECT near.word, v.n, count(*) AS n_near, first(near.other ORDER BY o.n DESC, near.other) AS form, max(o.n) AS form_n
  FROM near JOIN v ON v.word = near.word JOIN v AS o ON o.word = near.other GROUP BY near.word, v.n),
f AS MATERIALIZED (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
walk AS (SELECT word, form AS root FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root),
roots AS (SELECT word, root FROM walk WHERE root NOT IN (SELECT word FROM f))
SELECT v.word, f.form, coalesce(roots.root, v.word) AS root, v.n, coalesce(best.n_near, 0) AS n_near, f.form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN f USING (word) LEFT JOIN roots USING (word)
"""
