"""One query for each operator over its whole table, with production parameters, next to its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.align import align_documents
from tablewright.llm.ann import nearest
from tablewright.llm.chat import rotate
from tablewright.llm.common import table
from tablewright.llm.html import extract
from tablewright.llm.langid import predict_languages
from tablewright.llm.line_dedup import drop_recurring
from tablewright.llm.lm import score_documents
from tablewright.llm.mixing import mix_sources
from tablewright.llm.packing import pack
from tablewright.llm.quality import quality
from tablewright.llm.search import search
from tablewright.llm.simhash import near_duplicates
from tablewright.llm.urlfilter import filter_urls

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return register


LINE_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                      generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
normed AS (SELECT doc_id, pos, raw,
                  trim(regexp_replace(regexp_replace(raw, '[0-9]+', '0', 'g'), '[ 	-
]+', ' ', 'g')) AS norm FROM lines),
parsed AS (SELECT *, string_split(norm, ' ') AS tokens, len(string_split(norm, ' ')) AS n FROM normed
           WHERE len(string_split(norm, ' ')) >= 5
             AND 2 * (length(norm) - length(replace(norm, '0', ''))) <= len(string_split(norm, ' '))),
by_line AS (SELECT norm, any_value(n) AS n, any_value(tokens) AS tokens, any_value(n || ':' || array_to_string(tokens[1:3], ' ')) AS leaf,
                   min(doc_id) AS first, max(doc_id) AS last FROM parsed GROUP BY norm),
leaves AS (SELECT leaf FROM by_line GROUP BY leaf HAVING count(*) > 1 AND min(first) != max(last)),
spelled AS (SELECT norm, leaf, n, first, last, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
            FROM by_line WHERE leaf IN (SELECT leaf FROM leaves)),
held AS (SELECT *, min(first) OVER w != max(last) OVER w AS constant FROM spelled WINDOW w AS (PARTITION BY leaf, place, token)),
general AS (SELECT norm, any_value(leaf) || ':' || string_agg(CASE WHEN constant THEN token ELSE '<*>' END, ' ' ORDER BY place) AS template
            FROM held GROUP BY norm
            HAVING count(*) FILTER (constant) < count(*) AND count(*) FILTER (constant) >= 0.8 * count(*)),
named AS (SELECT b.norm, coalesce(template, b.norm) AS template, first, last FROM by_line b LEFT JOIN general g ON b.norm = g.norm),
recurring AS (SELECT template, min(first) AS keeper FROM named GROUP BY template HAVING min(first) != max(last)),
losing AS (SELECT norm, keeper FROM named JOIN recurring USING (template)),
judged AS (SELECT l.doc_id, l.pos, l.raw, keeper IS NOT NULL AND keeper != l.doc_id AS gone
           FROM normed l LEFT JOIN losing USING (norm))
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) AS n_lines,
       count(*) FILTER (gone) AS n_dropped FROM judged GROUP BY doc_id
"""


@query("op1_line_dedup", LINE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUALITY_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
counts AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM texts),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)),
judged AS (SELECT doc_id, line, len(w) AS n, len(w) > 0 AND (
    regexp_matches(lower(line), 'lorem ipsum|javascript|terms of use|terms of service|privacy policy|cookie policy|uses cookies|use cookies|all rights reserved|licensed under|released under the|click here|sign in to|log in to|subscribe to our|share this|read more|skip to content|powered by|copyright ©')
    OR (len(w) > 1 AND len(list_filter(w, lambda x: regexp_full_match(x, '[|•·»›>/\\→←–—-]+'))) > 0.2 * len(w))
    OR length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 0.5 * len(w)
    OR (len(w) > 1 AND len(list_filter(w, lambda x: ends_with(x, '!!'))) > 0.5 * len(w))
    OR (len(w) >= 12 AND NOT regexp_matches(rtrim(line), '[.!?…。！？:;"''”’»)\]][^\p{L}\p{N}_]*$'))) AS fails FROM lines),
by_doc AS (SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (fails) AS n_lines_dropped,
                  coalesce(sum(n) FILTER (fails), 0)::BIGINT AS n_words_lost,
                  count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines, sum(n) AS words FROM judged GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
       n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words) AND NOT n_words_lost > 0.5 * words AS kept,
       n_lines, n_lines_dropped, n_words_lost
FROM counts JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)
"""


@query("op3_quality_rules", QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "n_lines", "n_lines_dropped", "n_words_lost")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op5_lattice_scores")
def op5_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


MIXING_SQL = r"""
WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS size FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0 / (SELECT count(*) FROM sizes WHERE size > 0)
                 * (SELECT sum(size) FROM sizes)::DOUBLE / size ELSE 0 END AS rate FROM sizes),
terms AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
          FROM rates, range(0, 400) AS r(k) WHERE rate > 0),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS f FROM terms),
drawn AS (SELECT doc_id, source, length(text) AS n_chars, (CAST(CONCAT('0x', substr(md5('mix:' || doc_id), 1, 13)) AS BIGINT) + 0.5)
                 / 4503599627370496.0 AS u FROM documents),
counts AS (SELECT doc_id, source, n_chars,
                  (SELECT count(*) FROM cdf WHERE cdf.source = drawn.source AND cdf.f < drawn.u) AS n FROM drawn)
SELECT doc_id, source, n_chars, CAST(c AS INTEGER) AS copy,
       md5('mix:order:' || doc_id || ':' || c) AS shuffle_key
FROM counts, LATERAL (SELECT unnest(range(0, n)) AS c)
"""


@query("op6_mix_sources", MIXING_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.length("text").cast("long").alias("n_chars"), F.col("_copy").cast("int").alias("copy"),
                        F.col("_order").alias("shuffle_key"))


#: Host, path, verdict: the rules that the contract gives.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))

URL_SQL = r"""
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests)
SELECT page_id, host, path, max_by(h || p, length(h) + length(p)) AS rule,
       coalesce(max_by(v, length(h) + length(p)), 'allow') AS verdict
FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""


@query("op7_url_filter", URL_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


@query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20)


CHAT_SQL = r"""
WITH said AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role,
                     replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role != 'system'),
parts AS (SELECT s.conv_id, speaker, turn, role, body, turn // 2048 AS block, role = speaker AS own,
                 CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                      ELSE '<|user name=' || role || '|>' END || chr(10) AS head, body || '<|end|>' || chr(10) AS rest
          FROM said s JOIN speakers p ON s.conv_id = p.conv_id),
placed AS (SELECT *, sum(length(head) + length(rest)) OVER (PARTITION BY conv_id, speaker, block ORDER BY turn, role, body) AS stop
           FROM parts)
SELECT conv_id, block, speaker, count(*) AS n_turns, string_agg(head || rest, '' ORDER BY turn, role, body) AS text,
       coalesce(string_agg(CAST(stop - length(rest) AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY turn, role, body)
                FILTER (own), '') AS spans,
       CAST(coalesce(sum(length(rest)) FILTER (own), 0) AS BIGINT) AS n_loss_chars
FROM placed GROUP BY conv_id, block, speaker
"""


@query("op9_chat_rotation", CHAT_SQL)
def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return seen.withColumn("spans", spans)


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


SEARCH_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT doc_id, len(w)::BIGINT AS n, w FROM words WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sizes),
asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
held AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM sizes)
         WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term),
weights AS (SELECT term, floor(1000 * ln((2 * (SELECT nn FROM totals) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM held GROUP BY term),
impacts AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll))) AS impact
            FROM held JOIN weights USING (term) CROSS JOIN totals),
scores AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


@query("op12_ranked_search", SEARCH_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_language_id")
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))
