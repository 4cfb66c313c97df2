"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import (
    decontaminate, licenses, lines, lm_scores, mixing, neighbours, pii, prefix_trie, repair, simhash, substrings,
    toxicity, wrappers)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its class of near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


SPACE = r"[\x20\x09-\x0D]+"

SUBSTRING_SQL = f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS ws FROM documents),
runs AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS run FROM (
 SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
twice AS (SELECT run FROM runs GROUP BY run HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS pos FROM runs SEMI JOIN twice USING (run)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""


@query("op5_substring_dedup", SUBSTRING_SQL)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 35 words that occur elsewhere."""
    found = substrings.repeated_substrings(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds, nearly or exactly."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits", "windows")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated toxicity."""
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


#: One template a leaf, the first; leaves with more of them are tested against a plain version.
LINES_SQL = f"""
WITH raw AS (SELECT doc_id, text, md5(text) AS d, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, d, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM raw),
t AS (SELECT doc_id, d, line, pos, list_transform(list_filter(string_split_regex(line, '{SPACE}'), lambda x: x <> ''),
  lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS ws FROM l),
forms AS (SELECT ws, len(ws) AS size, ws[1:{lines.DEPTH}] AS lead, count(DISTINCT d) AS n FROM t WHERE len(ws) > 0 GROUP BY ws),
leaves AS (SELECT size, lead FROM forms GROUP BY ALL HAVING count(*) > 1 AND sum(n) >= {lines.MIN_DOCS}),
mixed AS (SELECT forms.* FROM forms SEMI JOIN leaves USING (size, lead)),
places AS (SELECT size, lead, pos, token, sum(n) AS n FROM (
 SELECT size, lead, n, unnest(ws) AS token, unnest(range(1, size + 1)) AS pos FROM mixed) GROUP BY ALL),
common AS (SELECT size, lead, pos, token FROM places QUALIFY row_number() OVER (PARTITION BY size, lead, pos ORDER BY n DESC, encode(token) DESC) = 1),
close AS (SELECT m.ws, m.size, m.lead FROM (SELECT ws, size, lead, unnest(ws) AS token, unnest(range(1, size + 1)) AS pos FROM mixed) m
 JOIN common c ON m.size = c.size AND m.lead = c.lead AND m.pos = c.pos GROUP BY m.ws, m.size, m.lead
 HAVING count(*) FILTER (WHERE m.token = c.token) >= {lines.SIMILARITY}::DOUBLE*m.size),
recurring AS (SELECT size, lead FROM close JOIN t USING (ws) GROUP BY size, lead HAVING count(DISTINCT d) >= {lines.MIN_DOCS}),
gone AS (SELECT ws FROM forms WHERE n >= {lines.MIN_DOCS} UNION SELECT ws FROM close SEMI JOIN recurring USING (size, lead)),
marked AS (SELECT t.*, g.ws IS NOT NULL AS hit FROM t LEFT JOIN gone g ON t.ws = g.ws),
whole AS (SELECT doc_id, count(*) FILTER (WHERE len(ws) > 0) AS n_lines, count(*) FILTER (WHERE hit) AS hits,
  string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit) AS kept FROM marked GROUP BY doc_id)
SELECT r.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(hits, 0)::BIGINT AS n_dropped,
 CASE WHEN hits > 0 THEN coalesce(kept, '') ELSE r.text END AS text FROM raw r LEFT JOIN whole w ON r.doc_id = w.doc_id"""


@query("op10_line_dedup", LINES_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur across documents."""
    found = lines.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", "text")


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document go into the weighted mix."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies", "taken")


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    vecs = table(spark, sf_dir, "embeddings")
    return neighbours.search(neighbours.build(vecs), vecs.filter("vec_id % 20 = 0"), k=20)


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for the personal numbers, dates and addresses in it."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="corpus-2024")


_M = f"{lm_scores.SMOOTHING}::DOUBLE"


def _loss(model: str) -> str:
    """Bits of a bigram: smoothed by the unigram, which is smoothed over the vocabulary."""
    return (f"-log2((coalesce({model}2.c, 0) + {_M}*(coalesce({model}1.c, 0) + 1)/({model}n.n + size.v))"
            f"/(coalesce({model}0.c, 0) + {_M}))")


LM_SQL = f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '{SPACE}'), lambda x: x <> '') AS ws FROM documents),
size AS (SELECT count(DISTINCT word) + 2 AS v FROM (SELECT unnest(ws) AS word FROM w)),
tokens AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, 'w' || unnest(ws) AS token FROM w
 UNION ALL SELECT doc_id, 0, 's' FROM w UNION ALL SELECT doc_id, len(ws) + 1, 'e' FROM w),
pairs AS (SELECT a.doc_id, a.token AS v, b.token AS w, a.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good
 FROM tokens a JOIN tokens b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
b2 AS (SELECT v, w, count(*) AS c FROM pairs GROUP BY ALL), b1 AS (SELECT w, count(*) AS c FROM pairs GROUP BY ALL),
b0 AS (SELECT v, count(*) AS c FROM pairs GROUP BY ALL), bn AS (SELECT count(*) AS n FROM pairs),
t2 AS (SELECT v, w, count(*) AS c FROM pairs WHERE good GROUP BY ALL), t1 AS (SELECT w, count(*) AS c FROM pairs WHERE good GROUP BY ALL),
t0 AS (SELECT v, count(*) AS c FROM pairs WHERE good GROUP BY ALL), tn AS (SELECT count(*) AS n FROM pairs WHERE good),
bits AS (SELECT p.doc_id, {_loss('t')} AS t, {_loss('b')} AS b FROM pairs p CROSS JOIN size CROSS JOIN bn CROSS JOIN tn
 LEFT JOIN b2 ON b2.v = p.v AND b2.w = p.w LEFT JOIN b1 ON b1.w = p.w LEFT JOIN b0 ON b0.v = p.v
 LEFT JOIN t2 ON t2.v = p.v AND t2.w = p.w LEFT JOIN t1 ON t1.w = p.w LEFT JOIN t0 ON t0.v = p.v)
SELECT doc_id, (count(*) - 1)::BIGINT AS n_words, round(avg(t), 6) AS target_loss, round(avg(b), 6) AS background_loss,
 round(avg(t) - avg(b), 6) AS score FROM bits GROUP BY doc_id"""


@query("op8_lm_score", LM_SQL)
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cross-entropy difference to the documents labelled as of good quality."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    found = lm_scores.cross_entropy_difference(table(spark, sf_dir, "documents"), good)
    return found.select(F.col("id").alias("doc_id"), "n_words",
                        *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license, with its source and language as directories."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), path=path).withColumnRenamed("id", "doc_id")


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


_BLANK = r"NOT regexp_matches(text, '[^\x20\x09-\x0D]')"
_NEXT = "CASE st WHEN 2 THEN 3 ELSE 2 END"
_INSERTED = f"""SELECT conv_id, i, st, cost, audit, lines FROM e
 UNION ALL SELECT conv_id, i, {_NEXT}, cost + 5, audit || 'I', list_append(lines, CASE st WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM e
 UNION ALL SELECT conv_id, i, CASE st WHEN 2 THEN 2 ELSE 3 END, cost + 10, audit || 'II', list_concat(lines, CASE st WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END) FROM e"""

REPAIR_SQL = f"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS act FROM conversations),
damaged AS (SELECT conv_id, turn, CASE act WHEN 4 THEN 'user' ELSE role END AS role, unnest(range(CASE act WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
  CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM base),
placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS letter FROM placed),
t AS (SELECT *, CASE WHEN {_BLANK} THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 't' ELSE '' END AS fault,
  coalesce(lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter NOT IN ('su', 'ua', 'au'), false) AS bad FROM numbered),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
  count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE bad) AS illegal FROM t GROUP BY conv_id),
dp AS (SELECT conv_id, 0::BIGINT AS i, st, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM (
  SELECT * FROM (WITH e AS (SELECT conv_id, 0 AS i, 1 AS st, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counts) {_INSERTED})) GROUP BY conv_id, st
 UNION ALL SELECT conv_id, i, st, min({{'cost': cost, 'audit': audit, 'lines': lines}}) FROM (SELECT * FROM (WITH e AS (
  SELECT dp.conv_id, t.i, unnest(CASE WHEN fault IN ('b', 'd') THEN [{{'st': st, 'cost': best.cost + 2, 'audit': best.audit || 'D', 'lines': best.lines}}] ELSE
   list_concat([{{'st': st, 'cost': best.cost + 2, 'audit': best.audit || 'D', 'lines': best.lines}},
    {{'st': {_NEXT}, 'cost': best.cost + 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'audit': best.audit || 'R', 'lines': list_append(best.lines, CASE st WHEN 2 THEN 'assistant:' ELSE 'user:' END || text)}}],
    CASE WHEN (letter = 's' AND st = 1) OR (letter = 'u' AND st <> 2) OR (letter = 'a' AND st = 2) THEN
     [{{'st': CASE letter WHEN 's' THEN 0 WHEN 'u' THEN 2 ELSE 3 END, 'cost': best.cost + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'audit': best.audit || 'K', 'lines': list_append(best.lines, role || ':' || text)}}] ELSE [] END) END, recursive := true)
  FROM dp JOIN t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.i = dp.i + 1) {_INSERTED})) GROUP BY conv_id, i, st),
best AS (SELECT dp.conv_id, min(best) AS b FROM dp JOIN counts c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.i WHERE st IN (1, 3) GROUP BY dp.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
 coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
 sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` as they arrive: lost, emptied, cut, repeated or of another role, by a checksum."""
    def plain(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    act = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(F.col("act") == 1, "").when(F.col("act") == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    copies = F.when(F.col("act") == 0, 0).when(F.col("act") == 3, 2).otherwise(1)
    return rows.withColumn("act", act).select(
        "conv_id", "turn", F.when(F.col("act") == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(True), copies)).alias("copy")).drop("copy")


@query("op11_conversation_repair", REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and the cheapest edits that mend its structure."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(damaged(rows), rows).withColumnsRenamed({"id": "conv_id", "digest": "repaired_sha256"})


TRIE_SQL = f"""
WITH turns AS (SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS e,
  octet_length(encode(coalesce(text, ''))) AS size FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'e': e, 'size': size}} ORDER BY turn NULLS FIRST, e) AS ts, {_crc32('conv_id::VARCHAR')} % 9 AS h FROM turns GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS ts FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - (o.conv_id % 5 + 5) % 5),
steps AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM built),
paths AS (SELECT conv_id, depth, depth = len(ts) AS ends, array_to_string(list_transform(ts[1:depth], lambda x: x.e), '') AS key,
  array_to_string(list_transform(ts[1:depth - 1], lambda x: x.e), '') AS parent, coalesce(ts[depth].size, 0) AS size FROM steps),
nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n, min(parent) AS parent, min(size) AS size,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM paths GROUP BY depth, key),
kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sums AS (SELECT p.depth, p.key, sum((n.n - 1) * n.size) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves FROM nodes n
 LEFT JOIN kids k ON k.depth = n.depth AND k.key = n.key JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
 s.saved::BIGINT AS saved_tokens, n.ends_sha256 FROM nodes n JOIN sums s ON s.depth = n.depth AND s.key = n.key
LEFT JOIN kids k ON k.depth = n.depth AND k.key = n.key LEFT JOIN nodes u ON n.depth > 0 AND u.depth = n.depth - 1 AND u.key = n.parent"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


#: Pages of the given tables have one ``article`` each, with nothing in it that is not main text.
MAIN_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article[^>]*>(.*)</article>', 1, 's'), '</?(?:b|a|i|em|strong|span)(?:\s[^>]*)?>', '', 'g') AS inside FROM pages),
b AS (SELECT page_id, url, regexp_replace(inside, '<[^>]*>', ' ', 'g') AS plain FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(plain, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;?', '&', 'g') AS plain FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(plain, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d"""


@query("op13_main_text", MAIN_SQL)
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return wrappers.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
