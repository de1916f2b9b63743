"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import decontam, divergence, licences, lines, lm, mixing, neighbours, pii, quality, rules, simhash, simple8b, turns
from tabwright.llm.common import table


def op1_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "keep", F.round("p_good", 6).alias("p_good"), F.round("p_low", 6).alias("p_low"), F.round("p_toxic", 6).alias("p_toxic"))


def op2_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return simple8b.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("share", F.round("share", 6))


def op6_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.with_copies(table(spark, sf_dir, "documents"), seed=7, repetition_limit=2.0)
    return found.select("row.doc_id", "row.source", F.round("weight", 9).alias("weight"), "block", "place", "copies")


def op10_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 6))


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_turn_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.repair_report(turns.damage(rows), rows.select(F.col("conv_id").cast("bigint").alias("conv_id")))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op13_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), epsilon=0.02, alpha=0.05)
    return found.select("doc_id", *rules.BASE, "base_failed", "kept", "rule")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_weak_labels, op2_semi_markov_pii, op3_projected_neighbours, op4_simple8b, op5_template_decontamination, op6_partial_matching, op7_temperature_mixing, op8_simhash_trie, op9_line_dedup, op10_licence_dice, op11_turn_matrices, op12_divergence_audit, op13_controlled_rules)
}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ORACLES: dict[str, str] = {
    "op7_temperature_mixing": r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n, ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT key, count(*) AS docs, sum(n)::BIGINT AS tokens, ceil(count(*) / 2000)::BIGINT AS blocks FROM d GROUP BY key),
p AS (SELECT key, docs, tokens, blocks, ln(tokens / (SELECT sum(tokens) FROM s)) AS p FROM s),
e AS (SELECT min(p) AS least, max(p) AS most FROM p WHERE tokens > 0),
b AS (SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
  SELECT k + 1, CASE WHEN fits THEN lo ELSE mid END, CASE WHEN fits THEN mid ELSE hi END FROM (SELECT k, lo, hi, (lo + hi) / 2 AS mid,
    exp(((lo + hi) / 2 - 1) * least) / exp(((lo + hi) / 2 - 1) * most) <= 2 AS fits FROM b, e WHERE k < 48)),
w AS (SELECT *, exp((SELECT hi FROM b WHERE k = 48) * p) AS raw FROM p),
v AS (SELECT *, raw / (SELECT sum(raw) FROM w) AS weight FROM w),
r AS (SELECT *, round((weight / tokens) / (SELECT min(weight / tokens) FROM v), 9) AS repeats FROM v),
t AS (SELECT d.*, weight, repeats, place % blocks AS block FROM d JOIN r USING (key)),
u AS (SELECT *, sum(n) OVER (PARTITION BY key, block ORDER BY place) AS upto, sum(n) OVER (PARTITION BY key, block) AS total FROM t)
SELECT doc_id, source, round(weight, 9) AS weight, block, place,
  (floor(repeats) + CASE WHEN repeats > floor(repeats) AND upto - n / 2.0 <= (repeats - floor(repeats)) * total THEN 1 ELSE 0 END)::BIGINT AS copies FROM u""",
    "op9_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT rid, doc_id, line, i, {_LOWER.format(f"trim(line, {_WHITE})")} AS key FROM l),
bad AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, bad.key IS NOT NULL AS gone FROM k LEFT JOIN bad USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id""",
}

def _add(w: str, cost: int | str, letter: str) -> str:
    """A way, its cost in twelve digits before its audit, with another edit."""
    return f"(printf('%012d', {w}[1:12]::BIGINT + {cost}) || {w}[13:] || '{letter}')"
_EXTRA = "CASE WHEN r.truncated THEN 3 ELSE 0 END"

_ORACLES["op11_turn_matrices"] = rf"""
WITH RECURSIVE n AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(key, ''), lambda x: ascii(x)::UBIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS how FROM n),
d AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE WHEN how = 1 THEN '' WHEN how = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE how <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (SELECT *, not regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(rtrim(text, {_WHITE}), 1) NOT IN ('.', '!', '?') AS truncated, left(role, 1) AS k, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000000' AS w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3, NULL::VARCHAR AS w4 FROM f
  UNION ALL SELECT conv_id, i, {_add('w1', 4, 'D')},
    list_min([{_add('w2', 4, 'D')}, CASE WHEN may AND k = 's' THEN {_add('w1', 'extra', 'K')} END]),
    list_min([{_add('u', 4, 'D')}, CASE WHEN may THEN list_min([{_add('w1', '3 + extra', 'R')}, {_add('w2', '3 + extra', 'R')}, {_add('a', '3 + extra', 'R')}]) END,
      CASE WHEN may AND k = 'u' THEN list_min([{_add('w1', 'extra', 'K')}, {_add('w2', 'extra', 'K')}, {_add('a', 'extra', 'K')}]) END]),
    list_min([{_add('a', 4, 'D')}, CASE WHEN may THEN {_add('u', '3 + extra', 'R')} END, CASE WHEN may AND k = 'a' THEN {_add('u', 'extra', 'K')} END])
  FROM (SELECT *, list_min([w4, {_add('u', 3, 'I')}]) AS a FROM (SELECT r.conv_id, r.i, w1, w2, w4, r.k, not (r.blank OR r.again) AS may, {_EXTRA} AS extra,
    list_min([w3, {_add('w1', 3, 'I')}, {_add('w2', 3, 'I')}, {_add('w4', 3, 'I')}]) AS u FROM dp JOIN f r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1))),
l AS (SELECT conv_id, list_min([w1, w4, {_add('u', 3, 'I')}]) AS w FROM (SELECT *, list_min([w3, {_add('w1', 3, 'I')}, {_add('w2', 3, 'I')}, {_add('w4', 3, 'I')}]) AS u
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM dp) WHERE back = 1)),
e AS (SELECT conv_id, unnest(string_split(w[13:], '')) AS edit, unnest(range(1, len(w) - 11)) AS p FROM l WHERE len(w) > 12),
q AS (SELECT conv_id, p, edit, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS i, sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY p) AS j FROM e),
s AS (SELECT q.conv_id, p, edit, j, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text, max(CASE WHEN j = 1 AND edit = 'K' AND k = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS sys
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i WHERE edit <> 'D'),
t AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS text FROM s GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (not blank AND again) AS duplicate,
    count(*) FILTER (not blank AND not again AND truncated) AS truncated, count(*) FILTER (before || k NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w[1:12]::BIGINT, 0) AS cost, coalesce(w[13:], '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""

_ORACLES["op12_divergence_audit"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS in_lang FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v, sum(in_lang) AS lang_total FROM k GROUP BY lang),
c AS (SELECT o.lang, source, o.term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v.v)) AS p,
    (1 + (1000000000::HUGEINT * (k.in_lang + 2)) // (v.lang_total + 2 * v.v)) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
t AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM t WHERE part = 'pair' OR rank <= 10"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licences.TEMPLATES.items())
_GRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_ORACLES["op10_licence_dice"] = f"""
WITH t AS (SELECT licence, len(w) AS words, {_GRAMS} AS g FROM (SELECT licence, regexp_extract_all({_LOWER.format("text")}, '[a-z0-9]+') AS w FROM (VALUES {_TEMPLATES}) v(licence, text))),
d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, regexp_matches(line, '[A-Za-z0-9]') AS has, sum(CASE WHEN regexp_matches(line, '[A-Za-z0-9]') THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS part FROM l),
u AS (SELECT rid, doc_id, 'line' AS unit, i AS line, 1 AS n_lines, line AS text FROM k UNION ALL
  SELECT rid, doc_id, 'paragraph', min(i), count(*), string_agg(line, chr(10) ORDER BY i) FROM k WHERE has GROUP BY rid, doc_id, part HAVING count(*) > 1),
g AS (SELECT rid, doc_id, unit, line, n_lines, {_GRAMS} AS g FROM (SELECT rid, doc_id, unit, line, n_lines, regexp_extract_all({_LOWER.format("text")}, '[a-z0-9]+') AS w FROM u)),
f AS (SELECT rid, doc_id, unit, line, n_lines, licence, 2.0::DOUBLE * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice
  FROM g JOIN t ON len(g.g) > 0 AND 4 * len(g.g) <= 6 * len(t.g) AND 4 * len(t.g) <= 6 * len(g.g)),
wl AS (SELECT rid, doc_id, i, unnest(regexp_extract_all({_LOWER.format("line")}, '[a-z0-9]+')) AS word, generate_subscripts(regexp_extract_all({_LOWER.format("line")}, '[a-z0-9]+'), 1) AS j FROM l),
wd AS (SELECT rid, doc_id, list(word ORDER BY i, j) AS w, list(i ORDER BY i, j) AS ln FROM wl GROUP BY rid, doc_id HAVING count(*) > 1),
wb AS (SELECT *, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS b FROM wd),
wc AS (SELECT wb.*, licence, t.g, least(t.words, len(w)) AS n FROM wb JOIN t ON 3 * len(list_intersect(list_distinct(b), t.g)) >= 2 * len(t.g)),
ws AS (SELECT rid, doc_id, licence, g, n, ln, b, unnest(range(1, len(w) - n + 2)) AS s FROM wc),
wx AS (SELECT rid, doc_id, licence, n, ln, s, 2.0::DOUBLE * len(list_intersect(x, g)) / (len(x) + len(g)) AS dice FROM (SELECT *, list_distinct(b[s:s + n - 2]) AS x FROM ws)),
wy AS (SELECT *, CASE WHEN 2 * (s - lag(s) OVER (PARTITION BY rid, licence ORDER BY s)) < n THEN 0 ELSE 1 END AS new FROM wx WHERE dice >= 0.8),
wz AS (SELECT *, sum(new) OVER (PARTITION BY rid, licence ORDER BY s) AS run FROM wy),
best AS (SELECT *, row_number() OVER (PARTITION BY rid, licence, run ORDER BY dice DESC, s) AS r FROM wz)
SELECT doc_id, unit, line::BIGINT AS line, n_lines::BIGINT AS n_lines, licence, round(dice, 6) AS dice FROM f WHERE dice >= 0.8
UNION ALL SELECT doc_id, 'window', ln[s]::BIGINT, (ln[s + n - 1] - ln[s] + 1)::BIGINT, licence, round(dice, 6) FROM best WHERE r = 1"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
