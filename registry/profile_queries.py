"""Expressions, profiles and rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import query
from registry.dirty import (
    CELLS_SQL, COLUMNS, POSITION_SQL, TOKENS_SQL, dirty, disguised_sql, number_sql, present_sql,
    stamp_sql, table, with_dirty)
from tablewright.constants import ROW_ID
from tablewright.functions import temporal as tp
from tablewright.functions.numeric import parse_number_currency, parse_number_loose
from tablewright.functions.text import (
    as_text, display_number, is_disguised, normalize_token, title_case, values_equivalent)
from tablewright.operators import profile as pf
from tablewright.operators.cells import temporal, text_cells, with_temporal
from tablewright.operators.checks import format_distribution
from tablewright.operators.rules import fallback_key, rules_from_profile, schema_fingerprint

TITLE_SQL = ("list_aggregate(list_transform(regexp_extract_all(lower({0}), '[a-z]+|[^a-z]+'), "
             "lambda r: upper(r[1]) || r[2:]), 'string_agg', '')")

# ---------------------------------------------------------------- expressions


@query("token_usage", with_dirty(f"""
SELECT "column", lower(text) AS token, count(*) AS cells FROM cells
WHERE {disguised_sql('text')} GROUP BY ALL""", CELLS_SQL))
def token_usage(spark, sf):
    cells = text_cells(dirty(spark, sf)).where(is_disguised("value"))
    return cells.groupBy("column", normalize_token("value").alias("token")).agg(F.count("*").alias("cells"))


@query("numeric_loose", with_dirty(f"""
SELECT row_id, total_price AS raw, {number_sql('total_price')} AS loose,
  try_cast(trim(replace(total_price, '€', '')) AS DOUBLE) AS strict FROM dirty"""))
def numeric_loose(spark, sf):
    return dirty(spark, sf).select(
        F.col(ROW_ID).alias("row_id"), F.col("total_price").alias("raw"),
        parse_number_loose("total_price").alias("loose"), parse_number_currency("total_price").alias("strict"))


LABEL_SQL = """CASE WHEN {t} IS NULL OR lower(trim({t})) IN """ + TOKENS_SQL + """ THEN 'missing'
  WHEN {k} = 'year' THEN CASE WHEN regexp_full_match({t}, '(19|20)\\d{{2}}') THEN 'yyyy' ELSE 'invalid' END
  WHEN {k} = 'period' THEN CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}') THEN 'yyyy-mm'
    WHEN regexp_full_match({t}, '\\d{{2}}/\\d{{4}}') THEN 'mm/yyyy'
    WHEN regexp_full_match({t}, '\\d{{4}}/\\d{{2}}') THEN 'yyyy/mm' ELSE 'invalid' END
  WHEN {k} = 'date' THEN CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'yyyy-mm-dd'
    WHEN regexp_full_match({t}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN 'dd/mm/yyyy'
    WHEN {s} IS NOT NULL THEN 'other_parseable_date' ELSE 'invalid' END
  ELSE 'unknown' END"""


@query("format_distribution", with_dirty(f"""
SELECT "column", label, count(*) AS n FROM (
  SELECT "column", {LABEL_SQL.format(t='text', k='kind', s=stamp_sql('text'))} AS label
  FROM cells JOIN (VALUES ('order_date','date'),('order_period','period'),('order_year','year')) v(c, kind)
  ON c = "column") GROUP BY ALL""", CELLS_SQL))
def format_distribution_query(spark, sf):
    return format_distribution(dirty(spark, sf), {"order_date": "date", "order_period": "period",
                                                  "order_year": "year"})


@query("temporal_parts", with_dirty(f"""
SELECT row_id, CAST(CASE WHEN regexp_full_match(order_year, '(19|20)\\d{{2}}') THEN order_year END AS INTEGER) AS year,
  CAST(order_period[1:4] AS INTEGER) AS period_year, CAST(order_period[6:7] AS INTEGER) AS period_month,
  CAST(year({stamp_sql('order_date')}) AS INTEGER) AS date_year FROM dirty"""))
def temporal_parts(spark, sf):
    part = tp.parse_year_month("order_period")
    return dirty(spark, sf).select(
        F.col(ROW_ID).alias("row_id"), tp.parse_year("order_year").alias("year"), part["year"].alias("period_year"),
        part["month"].alias("period_month"), tp.parse_date_year("order_date").alias("date_year"))


@query("alternative_layouts", with_dirty(f"""
SELECT row_id, CASE WHEN order_date LIKE '%/%' THEN strftime({stamp_sql('order_date')}, '%Y-%m-%d')
    ELSE strftime({stamp_sql('order_date')}, '%d/%m/%Y') END AS other_date,
  order_period[6:7] || '/' || order_period[1:4] AS other_period FROM dirty"""))
def alternative_layouts(spark, sf):
    d = with_temporal(dirty(spark, sf), ["order_date", "order_period"])
    (date, date_shape, date_stamp), (period, period_shape, _) = temporal("order_date"), temporal("order_period")
    return d.select(
        F.col(ROW_ID).alias("row_id"),
        tp.render_alternative(date, "date", date_shape, date_stamp).alias("other_date"),
        tp.render_alternative(period, "period", period_shape).alias("other_period"))


@query("timestamp_layouts", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%d/%m/%Y %H:%M') AS eu,
  'iso_datetime' AS iso_label, 'eu_datetime' AS eu_label, 'us_textual_datetime' AS us_label,
  strftime(ts, '%Y-%m-%d') AS us_date FROM events""")
def timestamp_layouts(spark, sf):
    """Every event time written three ways, classified, and read back."""
    e = table(spark, sf, "events")
    text = e.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("a"),
                    F.date_format("ts", "dd/MM/yyyy HH:mm").alias("b"), F.date_format("ts", "MMM d, yyyy").alias("c"))
    (a, a_shape, a_stamp), (b, b_shape, b_stamp), (c, c_shape, c_stamp) = (temporal(x) for x in "abc")
    return with_temporal(text, ["a", "b", "c"]).select(
        "event_id", tp.render_iso(a_stamp, "datetime").alias("iso"),
        tp.render_alternative(a, "datetime", a_shape, a_stamp).alias("eu"),
        tp.classify_format(a, "datetime", a_stamp, a_shape).alias("iso_label"),
        tp.classify_format(b, "datetime", b_stamp, b_shape).alias("eu_label"),
        tp.classify_format(c, "datetime", c_stamp, c_shape).alias("us_label"),
        tp.render_iso(c_stamp).alias("us_date"))


@query("equivalent_values", with_dirty(f"""
SELECT coalesce(try_cast(total_price AS DOUBLE) = {number_sql('total_price')}, false) AS same, count(*) AS rows
FROM dirty GROUP BY ALL"""))
def equivalent_values(spark, sf):
    same = values_equivalent("total_price", parse_number_loose("total_price").cast("string"))
    return dirty(spark, sf).groupBy(same.alias("same")).agg(F.count("*").alias("rows"))


@query("display_numbers", """
SELECT l_orderkey, l_linenumber, raw, CAST(round(CAST(raw AS DECIMAL(18,6)), 2) AS DECIMAL(18,2))::VARCHAR AS shown
FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
   * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,6)) AS VARCHAR) AS raw FROM lineitem)""")
def display_numbers(spark, sf):
    raw = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
           * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,6)").cast("string")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn(
        "shown", display_number("raw"))


@query("title_case", f"""
SELECT doc_id, source, {TITLE_SQL.format('source')} AS titled, lang, {TITLE_SQL.format("(lang || '-' || source)")} AS both_titled
FROM documents""")
def title_case_query(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", "source", title_case(F.lower("source")).alias("titled"), "lang",
        title_case(F.lower(F.concat_ws("-", "lang", "source"))).alias("both_titled"))


# ---------------------------------------------------------------- profile

@query("completeness_profile", with_dirty(f"""
SELECT 'dirty' AS dataset, "column", count(*) FILTER (value IS NULL) AS null_count,
  count(*) FILTER ({disguised_sql('text')}) AS disguised_null_count,
  round(100 * (1 - count(*) FILTER (value IS NULL OR {disguised_sql('text')}) / count(*)::DOUBLE), 2)
    AS completeness_pct FROM cells GROUP BY ALL""", CELLS_SQL))
def completeness_profile(spark, sf):
    return pf.completeness_profile(dirty(spark, sf), "dirty")


@query("sparse_profile", """
SELECT 'documents' AS dataset, c AS "column", nulls AS null_count, 0::BIGINT AS disguised_null_count,
  round(100 * (1 - nulls / total::DOUBLE), 2) AS completeness_pct
FROM (SELECT count(*) AS total, count(*) FILTER (quality IS NULL) AS q, count(*) FILTER (toxic IS NULL) AS t
      FROM documents LEFT JOIN labels USING (doc_id)),
  LATERAL (VALUES ('quality', q), ('toxic', t)) v(c, nulls)
WHERE round(100 * (1 - nulls / total::DOUBLE), 2) < 85""")
def sparse_profile(spark, sf):
    """Documents joined with their labels: label columns are mostly empty."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return pf.sparse_profile(docs.join(table(spark, sf, "labels"), "doc_id", "left"), "documents")


FACTS_SQL = f"""
flags AS (SELECT *, {number_sql('text')} AS num, {stamp_sql('text')} AS stamp,
    {disguised_sql('text')} AS gone, {present_sql('text')} AS here FROM cells),
facts AS (SELECT "column", {POSITION_SQL} AS position, count(*) AS total,
  count(*) FILTER (value IS NULL) AS real_nulls, count(*) FILTER (gone) AS disguised_nulls,
  count(*) FILTER (text <> '') AS filled, count(*) FILTER (text <> '' AND num IS NOT NULL) AS numeric_cells,
  count(*) FILTER (text <> '' AND stamp IS NOT NULL) AS date_cells,
  count(*) FILTER (text <> '' AND (text LIKE '%:%' OR text LIKE '%T%')) AS time_cells,
  count(*) FILTER (regexp_full_match(text, '\\d{{4}}-\\d{{2}}')) AS period_cells,
  count(*) FILTER (regexp_full_match(text, '\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{2}}/\\d{{2}}/\\d{{4}}')) AS plain_date_cells,
  count(*) FILTER (here) AS present_count, count(*) FILTER (here AND num IS NOT NULL) AS present_numeric,
  count(*) FILTER (here AND num >= 0) AS present_nonneg, count(DISTINCT text) FILTER (here) AS nunique_present,
  bool_or(coalesce(text LIKE '%€%', false)) AS euro, bool_or(coalesce(text LIKE '%$%', false)) AS dollar,
  bool_or(coalesce(contains(text, '%'), false)) AS percent,
  bool_or(coalesce(regexp_matches(text, '[A-Za-z]{{2,}}'), false)) AS unit FROM flags GROUP BY "column"),
typed AS (SELECT *, CASE WHEN filled = 0 THEN 'unknown' WHEN numeric_cells / filled::DOUBLE >= 0.9 THEN 'numeric'
    WHEN date_cells / filled::DOUBLE >= 0.9 THEN 'date' ELSE 'string' END AS semantic_type FROM facts),
profiled AS (SELECT *,
  CASE WHEN semantic_type <> 'date' THEN NULL
    WHEN date_cells / filled::DOUBLE >= 0.85 AND time_cells / filled::DOUBLE >= 0.2 THEN 'datetime'
    WHEN period_cells / filled::DOUBLE >= 0.85 AND period_cells >= plain_date_cells THEN 'period'
    WHEN plain_date_cells / filled::DOUBLE >= 0.85 THEN 'date'
    WHEN date_cells / filled::DOUBLE >= 0.85 THEN 'date' END AS temporal_kind,
  real_nulls + disguised_nulls AS effective_missing,
  round(1 - (real_nulls + disguised_nulls) / total::DOUBLE, 4) AS completeness,
  round(coalesce(nunique_present / nullif(present_count, 0)::DOUBLE, 0), 4) AS unique_ratio,
  round(coalesce(present_numeric / nullif(present_count, 0)::DOUBLE, 0), 4) AS numeric_parse_rate,
  CASE WHEN semantic_type = 'numeric' AND present_nonneg / present_numeric::DOUBLE >= 0.98 THEN 0.0::DOUBLE END AS min_value,
  array_to_string(list_filter([CASE WHEN euro THEN '€' END, CASE WHEN dollar THEN '$' END,
     CASE WHEN percent THEN '%' END, CASE WHEN unit THEN 'unit_text' END], lambda x: x IS NOT NULL), ' ') AS tokens
  FROM typed)"""


@query("semantic_types", with_dirty("""
SELECT "column", semantic_type, temporal_kind FROM profiled""", CELLS_SQL, FACTS_SQL))
def semantic_types(spark, sf):
    counts = pf.column_counts(dirty(spark, sf)).withColumn("semantic_type", pf.semantic_type())
    kind = F.when(F.col("semantic_type") == "date", pf.temporal_kind())
    return counts.select("column", "semantic_type", kind.alias("temporal_kind"))


@query("column_profile", with_dirty("""
SELECT 'dirty' AS dataset, "column", CAST(position AS INTEGER) AS position, semantic_type, temporal_kind, total, real_nulls,
  disguised_nulls, effective_missing, completeness, present_count, nunique_present, unique_ratio,
  numeric_parse_rate, tokens AS forbid_tokens, min_value,
  (SELECT string_agg(text, '|' ORDER BY seen, text) FROM (SELECT text, min(row_id) AS seen FROM cells c
     WHERE c."column" = profiled."column" AND text <> '' GROUP BY text ORDER BY seen, text LIMIT 5)) AS samples
FROM profiled""", CELLS_SQL, FACTS_SQL))
def column_profile(spark, sf):
    p = pf.profile(dirty(spark, sf), "dirty")
    return (p.withColumn("forbid_tokens", F.array_join("forbid_tokens", " "))
             .withColumn("samples", F.array_join("samples", "|")))


@query("approximate_profile")
def approximate_profile(spark, sf):
    """Profile with sketched distinct counts, the opt-in for very wide or very unique tables."""
    p = pf.profile(dirty(spark, sf), "dirty", approximate=True)
    return p.withColumn("forbid_tokens", F.array_join("forbid_tokens", " ")).withColumn(
        "samples", F.array_join("samples", "|"))


@query("column_context", with_dirty("""
SELECT "column", 'string' AS dtype, count(DISTINCT value) AS n_unique, count(*) FILTER (value IS NULL) AS n_nulls,
  (SELECT string_agg(text, '|' ORDER BY seen, text) FROM (SELECT text, min(row_id) AS seen FROM cells c
     WHERE c."column" = cells."column" AND text <> '' GROUP BY text ORDER BY seen, text LIMIT 5)) AS samples
FROM cells WHERE "column" IN ('customer_id', 'status', 'priority', 'note') GROUP BY "column" """, CELLS_SQL))
def column_context(spark, sf):
    from registry.check_queries import facts_of
    from tablewright.operators.checks import check_nulls

    d = dirty(spark, sf)
    context = pf.column_context(d, check_nulls(d, "dirty", facts_of(d)))
    return context.withColumn("samples", F.array_join("samples", "|"))


RULES_SQL = """
ranked AS (SELECT *, sum(CASE WHEN is_key THEN 1 ELSE 0 END) OVER (ORDER BY position) AS key_no FROM (
  SELECT *, present_count > 0 AND unique_ratio >= 0.98 AND completeness >= 0.95 AS is_key FROM profiled)),
found_rules AS (SELECT "column", CAST(position AS INTEGER) AS position, semantic_type, temporal_kind,
  completeness >= 0.8 AND nunique_present > 1 AS required, min_value,
  CASE WHEN semantic_type = 'numeric' THEN trim(replace(tokens, 'unit_text', '')) ELSE '' END AS forbid_tokens,
  CASE WHEN is_key AND key_no <= 3 THEN CAST(key_no AS INTEGER) END AS key_rank FROM ranked)"""


@query("discovered_rules", with_dirty("""
SELECT 'dirty' AS dataset, * FROM found_rules""", CELLS_SQL, FACTS_SQL, RULES_SQL))
def discovered_rules(spark, sf):
    rules = rules_from_profile(pf.profile(dirty(spark, sf), "dirty"))
    return rules.withColumn("forbid_tokens", F.array_join("forbid_tokens", " "))


@query("schema_fingerprint", with_dirty("""
SELECT 'dirty' AS dataset, md5(string_agg(entry, ',' ORDER BY entry)) AS fingerprint FROM (
  SELECT '{"position":' || position || ',"column":"' || "column" || '","semantic_type":"' || semantic_type || '"'
    || CASE WHEN temporal_kind IS NULL THEN '' ELSE ',"temporal_kind":"' || temporal_kind || '"' END
    || CASE WHEN min_value IS NULL THEN '' ELSE ',"min_value":0.0' END
    || ',"forbid_tokens":[' || CASE WHEN forbid_tokens = '' THEN '' ELSE '"' || replace(forbid_tokens, ' ', '","') || '"' END
    || ']}' AS entry FROM found_rules)""", CELLS_SQL, FACTS_SQL, RULES_SQL))
def schema_fingerprint_query(spark, sf):
    return schema_fingerprint(rules_from_profile(pf.profile(dirty(spark, sf), "dirty")))


@query("fallback_key", """
SELECT 'documents' AS dataset, 'doc_id' AS "column", round(count(DISTINCT doc_id) / count(*)::DOUBLE, 6) AS unique_ratio
FROM documents""")
def fallback_key_query(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "source", "doc_id")
    return fallback_key(pf.profile(docs, "documents"))


@query("typed_profile", """
SELECT 'customer' AS dataset, c AS "column", kind AS semantic_type, total, nunique_present, min_value FROM (
  SELECT count(*) AS total, count(DISTINCT c_custkey) AS a, count(DISTINCT c_name) AS b, count(DISTINCT c_nationkey) AS n,
    count(DISTINCT c_acctbal) AS d, count(DISTINCT c_mktsegment) AS e,
    avg(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS positive FROM customer),
  LATERAL (VALUES ('c_custkey', 'numeric', a, 0.0::DOUBLE), ('c_name', 'numeric', b, 0.0::DOUBLE),
    ('c_nationkey', 'numeric', n, 0.0::DOUBLE),
    ('c_acctbal', 'numeric', d, CASE WHEN positive >= 0.98 THEN 0.0::DOUBLE END),
    ('c_mktsegment', 'string', e, NULL::DOUBLE)) v(c, kind, nunique_present, min_value)""")
def typed_profile(spark, sf):
    """Declared numeric columns skip text parsing; a column with 8 % negatives gets no minimum."""
    p = pf.profile(table(spark, sf, "customer"), "customer")
    return p.select("dataset", "column", "semantic_type", "total", "nunique_present", "min_value")


@query("nested_profile", """
SELECT 'embeddings' AS dataset, c AS "column", total, nulls AS real_nulls FROM (
  SELECT count(*) AS total, count(*) FILTER (vec_id IS NULL) AS a, count(*) FILTER (embedding IS NULL) AS b,
    count(*) FILTER (label IS NULL) AS d FROM embeddings),
  LATERAL (VALUES ('vec_id', a), ('embedding', b), ('label', d)) v(c, nulls)""")
def nested_profile(spark, sf):
    return pf.profile(table(spark, sf, "embeddings"), "embeddings").select("dataset", "column", "total", "real_nulls")


@query("text_profile", f"""
SELECT 'documents' AS dataset, count(*) AS total, count(DISTINCT trim(text, ' ' || chr(9) || chr(10) || chr(13)))
  FILTER ({present_sql('text')}) AS nunique_present FROM documents""")
def text_profile(spark, sf):
    """Whole texts as one column: exact distinct counts of long values."""
    docs = table(spark, sf, "documents").select("text")
    name = F.lit("documents").alias("dataset")
    counts = pf.distinct_counts(docs).select(name, "nunique_present")
    return docs.agg(F.count("*").alias("total")).select(name, "total").join(counts, "dataset", "left")


@query("numeric_exploration", with_dirty("""
SELECT 'total_price' AS "column", count(*) FILTER (contains(total_price, '€')) AS with_euro,
  count(*) FILTER (try_cast(total_price AS DOUBLE) < 0) AS negative,
  count(*) FILTER (total_price IS NOT NULL AND try_cast(total_price AS DOUBLE) IS NULL) AS unreadable,
  max(try_cast(total_price AS DOUBLE)) AS max_value,
  count(*) FILTER (try_cast(order_year AS DOUBLE) > try_cast(total_price AS DOUBLE)) AS pair_violations,
  round(quantile_cont(try_cast(total_price AS DOUBLE), 0.99), 4) AS p99,
  (SELECT string_agg(total_price, '|' ORDER BY seen, total_price) FROM (SELECT total_price, min(row_id) AS seen FROM dirty
    WHERE try_cast(total_price AS DOUBLE) IS NULL GROUP BY 1 ORDER BY seen LIMIT 6)) AS samples
FROM dirty"""))
def numeric_exploration(spark, sf):
    found = pf.numeric_exploration(dirty(spark, sf), "total_price", pair=("order_year", "total_price"))
    return found.withColumn("p99", F.round("p99", 4)).withColumn("samples", F.array_join("samples", "|"))


TABLES = {"region": (2, 1, 1, 0), "nation": (3, 2, 1, 0), "customer": (5, 3, 2, 0), "supplier": (4, 3, 1, 0),
          "part": (6, 3, 3, 0), "orders": (6, 3, 2, 1), "lineitem": (11, 8, 2, 1), "events": (6, 3, 2, 1),
          "documents": (5, 2, 3, 0), "labels": (3, 3, 0, 0), "pages": (3, 1, 2, 0), "conversations": (4, 2, 2, 0),
          "benchmark": (2, 1, 1, 0), "embeddings": (3, 2, 1, 0)}


@query("dataset_summaries", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, {c}::BIGINT AS cols, {n}::BIGINT AS numeric_cols, {s}::BIGINT AS string_cols, "
    f"{d}::BIGINT AS date_cols FROM {t}" for t, (c, n, s, d) in TABLES.items()))
def dataset_summaries(spark, sf):
    return reduce(DataFrame.unionByName, [pf.dataset_summary(table(spark, sf, t), t) for t in TABLES])


@query("preview_rows", with_dirty("SELECT row_id, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in COLUMNS)
                                  + " FROM dirty ORDER BY row_id LIMIT 8"))
def preview_rows(spark, sf):
    return pf.preview_rows(dirty(spark, sf)).withColumnRenamed(ROW_ID, "row_id")


@query("content_fingerprint")
def content_fingerprint(spark, sf):
    return pf.content_fingerprint(dirty(spark, sf))


@query("stripped_text", """
SELECT doc_id, length(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160))) AS stripped_chars,
  text IS NULL OR trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)) = '' AS is_empty
FROM documents""")
def stripped_text(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.length(as_text("text")).cast("long").alias("stripped_chars"),
        F.coalesce(as_text("text") == "", F.lit(True)).alias("is_empty"))


@query("fingerprint_permuted", with_dirty("SELECT count(*) AS rows, true AS same, 0::BIGINT AS differing FROM dirty"))
def fingerprint_permuted(spark, sf):
    """The same rows in another order have the same fingerprint, as a whole and in every range."""
    d = dirty(spark, sf)
    other = d.repartition(7, "status").sortWithinPartitions("total_price")
    one, two = pf.content_fingerprint(d), pf.content_fingerprint(other).withColumnRenamed("rows", "other_rows")
    differing = pf.differing_ranges(d, other, 1000).agg(F.count("*").alias("differing"))
    same = (F.col("fingerprint") == F.col("other_fingerprint")) & (F.col("rows") == F.col("other_rows"))
    return (one.join(two.withColumnRenamed("fingerprint", "other_fingerprint")).join(differing)
               .select("rows", same.alias("same"), "differing"))


@query("fingerprint_changed_cell", with_dirty("""
SELECT k // 1000 AS "range", count(*) AS rows, count(*) AS other_rows FROM dirty, (SELECT max(row_id) AS k FROM dirty WHERE note IS NULL)
WHERE row_id // 1000 = k // 1000 GROUP BY k"""))
def fingerprint_changed_cell(spark, sf):
    """One cell of one row is another: just the range of that row differs."""
    d = dirty(spark, sf)
    last = d.where("note IS NULL").agg(F.max(ROW_ID)).first()[0]
    changed = d.withColumn("note", F.when(F.col(ROW_ID) == last, "changed").otherwise(F.col("note")))
    return pf.differing_ranges(d, changed, 1000)


@query("fingerprint_lost_rows", with_dirty("""
SELECT row_id // 1000 AS "range", count(*) AS rows, count(*) FILTER (row_id % 10 <> 2) AS other_rows FROM dirty GROUP BY 1
HAVING count(*) <> count(*) FILTER (row_id % 10 <> 2)"""))
def fingerprint_lost_rows(spark, sf):
    """The ranges from which the key conflicts were taken out."""
    d = dirty(spark, sf)
    return pf.differing_ranges(d, d.where(F.col(ROW_ID) % 10 != 2), 1000)
