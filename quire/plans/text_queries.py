"""T, F and D: queries of scalar text functions, classes of lines, and detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import lint as D
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table


@query("t5_typos", f"WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, replace(replace(line, 'teh', 'the'), 'tiontion', 'tion') AS line FROM blocks")
def t5(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).select("doc_id", "bi", X.replaced(F.col("line"), [("teh", "the"), ("tiontion", "tion")]).alias("line"))


@query("t11_marker_number", r"""
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)
SELECT doc_id, regexp_extract(w, '^[\[(]?([0-9]+)[\])]?[.]?$', 1) AS n, count(*) AS cnt FROM w WHERE regexp_matches(w, '^[\[(]?[0-9]+[\])]?$') GROUP BY ALL""")
def t11(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w")).filter(F.col("w").rlike("^[\\[(]?[0-9]+[\\])]?$"))
    return w.groupBy("doc_id", X.marker_number(F.col("w")).alias("n")).agg(F.count("*").alias("cnt"))


@query("t15_roman", """
SELECT n, repeat('m', (n // 1000)::INT) || ['', 'c', 'cc', 'ccc', 'cd', 'd', 'dc', 'dcc', 'dccc', 'cm'][(n % 1000 // 100 + 1)::INT] || ['', 'x', 'xx', 'xxx', 'xl', 'l', 'lx', 'lxx', 'lxxx', 'xc'][(n % 100 // 10 + 1)::INT]
  || ['', 'i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix'][(n % 10 + 1)::INT] AS roman, n AS back FROM (SELECT DISTINCT 1 + n_chars % 3999 AS n FROM documents)""")
def t15(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "documents").select((1 + F.col("n_chars") % 3999).alias("n")).distinct()
    return n.select("n", X.roman(F.col("n")).alias("roman")).select("n", "roman", X.roman_value(F.col("roman")).cast("long").alias("back"))


@query("t17_line_width", f"""
WITH {BLOCKS}, c AS (SELECT doc_id, bi, line, length(line) AS n, length(regexp_replace(line, '[^ ]', '', 'g')) AS sp, length(regexp_replace(line, '[^iljtfr.,;:!|''()\\[\\]]', '', 'g')) AS na,
  length(regexp_replace(line, '[^mwMW]', '', 'g')) AS br, length(regexp_replace(line, '[^A-LN-VX-Z0-9]', '', 'g')) AS ca FROM blocks)
SELECT doc_id, bi::INT AS bi, (280 * sp + 320 * na + 850 * br + 620 * ca + 520 * (n - sp - na - br - ca))::BIGINT AS milli FROM c""".replace("\\\\", "\\"))
def t17(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).select("doc_id", "bi", X.width_milli(F.col("line")).alias("milli"))


@query("t19_latin_ratio", "SELECT doc_id, round(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / greatest(1, length(text)), 6) AS ratio FROM documents")
def t19(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(X.latin_ratio(F.col("text")), 6).alias("ratio"))


@query("t20_ranges", r"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+-[0-9]+')) AS r FROM documents), p AS (SELECT doc_id, r, string_split(r, '-') AS p FROM r),
f AS (SELECT doc_id, r, p[1] AS a, CASE WHEN length(p[2]) < length(p[1]) THEN left(p[1], length(p[1]) - length(p[2])) || p[2] ELSE p[2] END AS b FROM p)
SELECT doc_id, r AS range, a::BIGINT AS low, greatest(a::BIGINT, b::BIGINT) AS high, count(*) AS n FROM f GROUP BY ALL""")
def t20(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([0-9]+-[0-9]+)"), 1)).alias("range"))
    x = X.expand_range(F.split_part("range", F.lit("-"), F.lit(1)), F.split_part("range", F.lit("-"), F.lit(2)))
    return r.withColumn("x", x).groupBy("doc_id", "range", F.col("x.low").alias("low"), F.col("x.high").alias("high")).agg(F.count("*").alias("n"))


@query("t21_foreign_words", f"""
WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, array_to_string(list_filter(regexp_extract_all(line, '[A-Za-zÀ-ɏ]{{4,}}'), lambda w: lower(w) NOT IN ('dass', 'eine', 'einer', 'eines', 'from', 'into', 'that', 'with', 'dans', 'pour'))[1:3], ' ') AS words FROM blocks""")
def t21(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).select("doc_id", "bi", F.array_join(X.foreign_words(F.col("line")), " ").alias("words"))


@query("t22_norm_key", "SELECT doc_id, md5(regexp_replace(text, '[ \\t\\n\\r]', '', 'g')) AS key FROM documents")
def t22(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(X.norm_key(F.col("text")).cast("binary")).alias("key"))


_HEAD = "length(line) <= 46 AND NOT regexp_matches(line, '[。！？；：，、,.!?;:]$')"


@query("f2_short_lines", f"""
WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, CASE WHEN regexp_matches(line, '^[A-Z][.．]') THEN 3 WHEN regexp_matches(line, '^[0-9]+[.．]') THEN 2 WHEN regexp_matches(line, '^[A-ZÀ-Þ]') THEN 4 ELSE 5 END AS rank FROM blocks WHERE {_HEAD}""")
def f2(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import classify as C

    rules = [("^[A-Z][.．]", 3), ("^[0-9]+[.．]", 2), ("^[A-ZÀ-Þ]", 4)]
    return C.headings_by_pattern(blocks(spark, d), rules, 5).select("doc_id", "bi", "rank")


@query("f3_pattern_level", f"""
WITH {BLOCKS}, n AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY bi) AS before FROM blocks)
SELECT doc_id, bi::INT AS bi, length(line) <= 44 AND NOT regexp_matches(line, '[0-9.,;:!?|#$%&*@]') AND regexp_matches(line, '^[A-ZÀ-Þ]') AS name_like, coalesce(length(before) <= 46, false) AS after_heading FROM n WHERE length(line) <= 46""")
def f3(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import classify as C

    return C.name_like(blocks(spark, d), ["doc_id"]).filter(F.length("line") <= 46).select("doc_id", "bi", "name_like", "after_heading")


@query("f8_divider_pages", f"""
WITH {BLOCKS}, t AS (SELECT doc_id, sum(length(line)) AS n, count(*) AS parts, bool_and(length(line) <= 46) AS short FROM blocks GROUP BY doc_id)
SELECT doc_id, (n < 260 AND parts <= 10 AND short) AS divider FROM t""")
def f8(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import classify as C

    return C.divider_pages(blocks(spark, d), ["doc_id"])


@query("f9_page_numbers", r"""
WITH n AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS num FROM documents)
SELECT doc_id, count(*) FILTER (WHERE length(num) <= 4)::BIGINT AS short, count(*)::BIGINT AS numbers FROM n GROUP BY doc_id""")
def f9(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([0-9]+)"), 1)).alias("num"))
    return n.groupBy("doc_id").agg(F.sum((F.length("num") <= 4).cast("long")).alias("short"), F.count("*").alias("numbers"))


@query("d2_repeated_words", """
WITH w AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents)),
n AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w)
SELECT doc_id, count(*) AS n FROM n WHERE w = before AND length(w) >= 2 GROUP BY doc_id""")
def d2(spark: SparkSession, d: str) -> DataFrame:
    return D.repeated_words(table(spark, d, "documents"), "text").filter("n > 0")
