"""F-* scalar function families (one query per family) bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.functions.text import ACCENTED, PLAIN
from dossier.plans.common import AS_OF, T
from dossier.plans.registry import register


@register("f_str_1_trim_case_pad", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, lower(p_brand) AS brand_lower,
  upper(p_name) AS name_upper,
  array_to_string(list_transform(string_split(lower(p_name), ' '),
                                 lambda w: upper(w[1]) || w[2:]), ' ') AS name_initcap,
  lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_padded, ltrim('   ' || p_type) AS type_ltrim
FROM part""")
def f_str_1(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
                    F.lower("p_brand").alias("brand_lower"), F.upper("p_name").alias("name_upper"),
                    F.initcap("p_name").alias("name_initcap"),
                    F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_padded"),
                    F.ltrim(F.concat(F.lit("   "), "p_type")).alias("type_ltrim"))


@register("f_str_2_slice_locate", """
SELECT c_custkey, substring(c_name, 1, 8) AS head, left(c_name, 3) AS l3, right(c_name, 4) AS r4,
  split_part(c_name, '#', 1) AS before_hash, split_part(c_name, '#', -1) AS after_hash,
  CAST(instr(c_name, '#') AS INTEGER) AS hash_pos, CAST(position('1' IN c_name) AS INTEGER) AS first_one
FROM customer""")
def f_str_2(spark, sf):
    c = T(spark, sf).customer
    return c.select("c_custkey", F.substring("c_name", 1, 8).alias("head"),
                    F.left("c_name", F.lit(3)).alias("l3"), F.right("c_name", F.lit(4)).alias("r4"),
                    F.substring_index("c_name", "#", 1).alias("before_hash"),
                    F.substring_index("c_name", "#", -1).alias("after_hash"),
                    F.instr("c_name", "#").alias("hash_pos"),
                    F.locate("1", "c_name").alias("first_one"))


@register("f_str_3_replace_regex", f"""
SELECT doc_id, replace(source, 'src', 'source-') AS source_name,
  md5(translate(text, '{ACCENTED}', '{PLAIN}')) AS folded_md5,
  CAST(length(regexp_replace(text, '[^a-zA-Z ]', '', 'g')) AS INTEGER) AS n_plain,
  regexp_extract(text, '([A-Z][a-z]+)', 1) AS first_cap,
  regexp_matches(text, '[0-9]') AS has_digit, text LIKE '%the%' AS has_the
FROM documents""")
def f_str_3(spark, sf):
    d = T(spark, sf).documents
    return d.select("doc_id", F.replace("source", F.lit("src"), F.lit("source-")).alias("source_name"),
                    F.md5(F.translate("text", ACCENTED, PLAIN)).alias("folded_md5"),
                    F.length(F.regexp_replace("text", "[^a-zA-Z ]", "")).alias("n_plain"),
                    F.regexp_extract("text", "([A-Z][a-z]+)", 1).alias("first_cap"),
                    F.col("text").rlike("[0-9]").alias("has_digit"),
                    F.col("text").like("%the%").alias("has_the"))


@register("f_str_4_build_measure", """
SELECT p_partkey, p_brand || '-' || p_type AS brand_type,
  concat_ws('/', p_brand, NULL, p_type) AS path, CAST(length(p_name) AS INTEGER) AS name_len,
  CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words, contains(p_name, 'red') AS has_red,
  starts_with(p_name, 'blue') AS starts_blue
FROM part""")
def f_str_4(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", F.concat("p_brand", F.lit("-"), "p_type").alias("brand_type"),
                    F.concat_ws("/", "p_brand", F.lit(None).cast("string"), "p_type").alias("path"),
                    F.length("p_name").alias("name_len"),
                    F.size(F.split("p_name", " ")).alias("n_words"),
                    F.contains("p_name", F.lit("red")).alias("has_red"),
                    F.startswith("p_name", F.lit("blue")).alias("starts_blue"))


@register("f_date_1_parse_format", """
SELECT o_orderkey,
  strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::DATE AS parsed,
  try_strptime(strftime(o_orderdate, '%d/%m/%Y') || 'x', '%d/%m/%Y')::DATE AS bad_parsed,
  strptime(strftime(o_orderdate, '%Y%m%d') || 'T101500Z', '%Y%m%dT%H%M%SZ') AS stamp,
  strftime(o_orderdate, '%Y-%m') AS period, strftime(o_orderdate, '%A') AS weekday
FROM orders""")
def f_date_1(spark, sf):
    o = T(spark, sf).orders
    txt = F.date_format("o_orderdate", "dd/MM/yyyy")
    stamp = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T101500Z"))
    return o.select("o_orderkey", F.to_date(txt, "dd/MM/yyyy").alias("parsed"),
                    F.try_to_date(F.concat(txt, F.lit("x")), "dd/MM/yyyy").alias("bad_parsed"),
                    F.to_timestamp_ntz(stamp, F.lit("yyyyMMdd'T'HHmmss'Z'")).alias("stamp"),
                    F.to_char(F.to_date("o_orderdate"), F.lit("yyyy-MM")).alias("period"),
                    F.date_format("o_orderdate", "EEEE").alias("weekday"))


@register("f_date_2_arithmetic", f"""
SELECT o_orderkey,
  CAST(DATE '{AS_OF}' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days,
  CAST(trunc((DATE '{AS_OF}' - CAST(o_orderdate AS DATE)) / 7) AS BIGINT) AS age_weeks,
  CAST(o_orderdate AS DATE) + 30 AS plus_30, CAST(o_orderdate AS DATE) - 90 AS minus_90,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS add_1_month,
  last_day(CAST(o_orderdate AS DATE)) AS month_end
FROM orders""")
def f_date_2(spark, sf):
    o = T(spark, sf).orders
    d = F.to_date("o_orderdate")
    asof = F.lit(AS_OF).cast("date")
    return o.select("o_orderkey", F.datediff(asof, d).alias("age_days"),
                    F.expr(f"datediff(WEEK, to_date(o_orderdate), DATE'{AS_OF}')").alias("age_weeks"),
                    F.date_add(d, 30).alias("plus_30"), F.date_sub(d, 90).alias("minus_90"),
                    F.expr("CAST(dateadd(MONTH, 3, to_date(o_orderdate)) AS DATE)").alias("plus_3_months"),
                    F.add_months(d, 1).alias("add_1_month"), F.last_day(d).alias("month_end"))


@register("f_date_3_parts", f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo,
  make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start,
  CAST(len(generate_series(make_date(year(o_orderdate), month(o_orderdate), 1),
                           last_day(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS INTEGER)
    AS days_in_month,
  DATE '{AS_OF}' AS as_of
FROM orders""")
def f_date_3(spark, sf):
    o = T(spark, sf).orders
    start = F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1))
    days = F.size(F.sequence(start, F.last_day(F.to_date("o_orderdate")), F.expr("INTERVAL 1 DAY")))
    return o.select("o_orderkey", F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo"),
                    start.alias("month_start"), days.alias("days_in_month"),
                    F.lit(AS_OF).cast("date").alias("as_of"))


@register("f_num_math", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice, 0) AS price_round,
  CAST(floor(l_extendedprice / 1000) AS BIGINT) AS price_k, abs(l_discount - 0.05) AS disc_gap,
  l_extendedprice / nullif(l_discount, 0) AS per_discount
FROM lineitem""")
def f_num_math(spark, sf):
    li = T(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 0).alias("price_round"),
                     F.floor(F.col("l_extendedprice") / 1000).alias("price_k"),
                     F.abs(F.col("l_discount") - 0.05).alias("disc_gap"),
                     F.try_divide("l_extendedprice", F.nullif("l_discount", F.lit(0.0))).alias("per_discount"))


@register("f_num_random")
def f_num_random(spark, sf):
    """rand / uuid: not reproducible across engines (rows-only check)."""
    c = T(spark, sf).customer
    return c.select("c_custkey", F.rand(42).alias("r"), F.expr("uuid()").alias("u"))


@register("f_null_conditional", """
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'low') AS prio,
  ifnull(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '?') AS status,
  if(o_totalprice > 100000, 'big', 'small') AS size_class
FROM orders""")
def f_null_conditional(spark, sf):
    o = T(spark, sf).orders
    return o.select("o_orderkey",
                    F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("low")).alias("prio"),
                    F.ifnull(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
                             F.lit("?")).alias("status"),
                    F.expr("if(o_totalprice > 100000, 'big', 'small')").alias("size_class"))


@register("f_arr_functions", """
WITH a AS (SELECT l_orderkey, list_sort(list(l_partkey)) AS parts,
                  list_sort(list_distinct(list(l_returnflag))) AS flags,
                  list_sort(list_distinct(list(l_linestatus))) AS statuses
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CAST(len(parts) AS INTEGER) AS n_parts, list_extract(parts, 1) AS first_part,
  parts[1] AS first_part_idx, array_to_string(flags, ',') AS flags,
  CAST(len(list_distinct(parts)) AS INTEGER) AS n_distinct_parts, list_reverse_sort(parts)[1] AS max_part,
  list_contains(flags, 'R') AS has_r,
  array_to_string(list_sort(list_distinct(list_concat(flags, statuses))), ',') AS codes,
  CAST(len(flatten([flags, statuses])) AS INTEGER) AS n_codes,
  CAST(len(list_zip(parts, parts)) AS INTEGER) AS n_zip,
  CAST(len(list_filter(parts, lambda x: x > 1000)) AS INTEGER) AS n_big_parts,
  [l_orderkey, l_orderkey + 1] AS pair
FROM a""")
def f_arr_functions(spark, sf):
    li = T(spark, sf).lineitem
    a = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts"),
                                     F.array_sort(F.collect_set("l_returnflag")).alias("flags"),
                                     F.array_sort(F.collect_set("l_linestatus")).alias("statuses"))
    return a.select(
        "l_orderkey", F.size("parts").alias("n_parts"), F.element_at("parts", 1).alias("first_part"),
        F.col("parts")[0].alias("first_part_idx"), F.array_join("flags", ",").alias("flags"),
        F.size(F.array_distinct("parts")).alias("n_distinct_parts"),
        F.sort_array("parts", asc=False)[0].alias("max_part"),
        F.array_contains("flags", "R").alias("has_r"),
        F.array_join(F.array_sort(F.array_union("flags", "statuses")), ",").alias("codes"),
        F.size(F.flatten(F.array("flags", "statuses"))).alias("n_codes"),
        F.size(F.arrays_zip("parts", "parts")).alias("n_zip"),
        F.size(F.filter("parts", lambda x: x > 1000)).alias("n_big_parts"),
        F.array(F.col("l_orderkey"), F.col("l_orderkey") + 1).alias("pair"))


@register("f_json_struct", """
SELECT c_custkey, CAST(to_json({'id': c_custkey, 'name': c_name, 'nation': c_nationkey}) AS VARCHAR) AS doc
FROM customer""")
def f_json_struct(spark, sf):
    c = T(spark, sf).customer
    return c.select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("id"),
                                                    F.col("c_name").alias("name"),
                                                    F.col("c_nationkey").alias("nation"))).alias("doc"))


@register("f_hash_id", """
SELECT c_custkey, sha256(concat_ws('~', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS row_hash,
  md5(c_name) AS name_md5
FROM customer""")
def f_hash_id(spark, sf):
    c = T(spark, sf).customer
    return c.select("c_custkey",
                    F.sha2(F.concat_ws("~", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"),
                           256).alias("row_hash"),
                    F.md5("c_name").alias("name_md5"))


@register("f_conv_casts", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty_int,
  TRY_CAST(l_returnflag AS INTEGER) AS flag_int,
  replace(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS price_export,
  CAST(replace(replace(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR), '.', ','), ',', '.')
       AS DECIMAL(18, 2)) AS price_back
FROM lineitem""")
def f_conv_casts(spark, sf):
    li = T(spark, sf).lineitem
    export = F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("qty_int"),
                     F.col("l_returnflag").try_cast("int").alias("flag_int"),
                     export.alias("price_export"),
                     F.replace(export, F.lit(","), F.lit(".")).cast("decimal(18,2)").alias("price_back"))


@register("f_meta_input_file")
def f_meta_input_file(spark, sf):
    """input_file_name() as the hidden ``_metadata.file_path`` column (rows-only check)."""
    li = T(spark, sf).lineitem
    return li.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n_rows"))
