"""A and U: counts of characters, differences of multisets, unions and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table

_IGNORED = "('', ' ', chr(9), chr(10), chr(13), chr(8288), chr(8203), chr(12288), chr(8194), chr(65279), chr(160), chr(173))"
_CHARS = f"""chars AS (SELECT lang, ch, count(*) AS n FROM (SELECT lang, unnest(string_split(coalesce(text, ''), '')) AS ch FROM documents)
  WHERE ch NOT IN {_IGNORED} GROUP BY lang, ch)"""


@query("a1_char_multiset", f"WITH {_CHARS} SELECT lang, ch, n FROM chars")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return A.char_counts(table(spark, d, "documents"), "text", ["lang"])


@query("a3_top_chars", f"""
WITH {_CHARS} SELECT lang, ch, n, k::INT AS k FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ch) AS k FROM chars) WHERE k <= 10""")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return A.most_common(A.char_counts(table(spark, d, "documents"), "text", ["lang"]), ["lang"], "ch", 10)


@query("a4_mode_line_length", f"""
WITH {BLOCKS} SELECT lang, len, n FROM (SELECT lang, length(line) AS len, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, length(line)) AS k
  FROM blocks GROUP BY lang, length(line)) WHERE k = 1""")
def a4(spark: SparkSession, d: str) -> DataFrame:
    return A.mode(blocks(spark, d).select("lang", F.length("line").cast("long").alias("len")), ["lang"], "len")


@query("a5_threshold_extremum", f"""
WITH {BLOCKS}, counts AS (SELECT lang, length(line) AS len, count(*) AS n FROM blocks GROUP BY ALL),
total AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang)
SELECT lang, max(len)::BIGINT AS high, min(len)::BIGINT AS low FROM counts JOIN total USING (lang) WHERE n >= greatest(5, total // 200) GROUP BY lang""")
def a5(spark: SparkSession, d: str) -> DataFrame:
    return A.supported_extrema(blocks(spark, d).select("lang", F.length("line").cast("long").alias("len")), ["lang"], "len")


@query("a10_repair_counts", r"""
SELECT source, sum(len(regexp_extract_all(text, '[0-9][-–—~～－][0-9]')))::BIGINT AS ranges, sum(len(regexp_extract_all(text, ' {2,}')))::BIGINT AS spaces,
       sum(len(regexp_extract_all(text, '"')))::BIGINT AS quotes FROM documents GROUP BY source""")
def a10(spark: SparkSession, d: str) -> DataFrame:
    return A.repair_counts(table(spark, d, "documents"), "text", ["source"], {"ranges": "[0-9][-–—~～－][0-9]", "spaces": " {2,}", "quotes": '"'})


@query("a12_report_row", f"""
WITH {BLOCKS} SELECT source, count(DISTINCT doc_id)::BIGINT AS docs, count(*)::BIGINT AS lines, sum(length(line))::BIGINT AS chars,
  sum((length(line) <= 46)::INT)::BIGINT AS short, sum((regexp_matches(line, '[,;:!?]{{2,}}'))::INT)::BIGINT AS punct_runs FROM blocks GROUP BY source""")
def a12(spark: SparkSession, d: str) -> DataFrame:
    return A.report_rows(blocks(spark, d), ["source"])


@query("a13_codepoints", """
SELECT DISTINCT unicode(ch)::BIGINT AS cp FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents UNION ALL SELECT chr(i) FROM (SELECT unnest(range(32, 127))::INT AS i)) WHERE ch <> ''""")
def a13(spark: SparkSession, d: str) -> DataFrame:
    return A.codepoints(table(spark, d, "documents"), "text", [(32, 126)])


@query("a14_upper_median", f"""
WITH {BLOCKS}, r AS (SELECT source, length(line) AS len, row_number() OVER (PARTITION BY source ORDER BY length(line)) AS k, count(*) OVER (PARTITION BY source) AS n FROM blocks)
SELECT source, len::BIGINT AS med FROM r WHERE k = n // 2 + 1""")
def a14(spark: SparkSession, d: str) -> DataFrame:
    return A.upper_median(blocks(spark, d).select("source", F.length("line").cast("long").alias("len")), ["source"], "len").withColumnRenamed("len", "med")


@query("a15_text_len", "SELECT source, lang, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source, lang")
def a15(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.sum(F.length("text")).cast("long").alias("chars"))


@query("u2_set_difference", f"""
WITH a AS (SELECT DISTINCT ch FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE lang = 'fr') WHERE ch NOT IN {_IGNORED}),
b AS (SELECT DISTINCT ch FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE lang = 'en') WHERE ch NOT IN {_IGNORED})
SELECT ch FROM a EXCEPT SELECT ch FROM b""")
def u2(spark: SparkSession, d: str) -> DataFrame:
    c = A.char_counts(table(spark, d, "documents"), "text", ["lang"])
    return A.only_in_first(c.filter("lang = 'fr'"), c.filter("lang = 'en'"), ["ch"])


@query("u3_first_occurrence", f"""
WITH {BLOCKS}, r AS (SELECT source, line, doc_id, bi, row_number() OVER (PARTITION BY source, line ORDER BY doc_id, bi) AS k FROM blocks)
SELECT source, doc_id, bi::INT AS bi, line FROM r WHERE k = 1""")
def u3(spark: SparkSession, d: str) -> DataFrame:
    return A.first_occurrence(blocks(spark, d), ["source", "line"], ["doc_id", "bi"]).select("source", "doc_id", "bi", "line")


@query("o2_capped_samples", f"""
WITH {BLOCKS}, r AS (SELECT source, doc_id, bi, row_number() OVER (PARTITION BY source ORDER BY doc_id, bi) AS k, count(*) OVER (PARTITION BY source) AS n
  FROM blocks WHERE length(line) <= 46)
SELECT source, doc_id, bi::INT AS bi, greatest(n - 3, 0)::BIGINT AS more FROM r WHERE k <= 3""")
def o2(spark: SparkSession, d: str) -> DataFrame:
    return A.capped_samples(blocks(spark, d).filter(F.length("line") <= 46), ["source"], ["doc_id", "bi"], 3).select("source", "doc_id", "bi", "more")


@query("o3_longest_first", f"""
WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, (row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, bi))::INT AS k FROM blocks""")
def o3(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy(F.desc(F.length("line")), "bi")
    return blocks(spark, d).select("doc_id", "bi", F.row_number().over(w).alias("k"))


@query("o4_composite_top1", f"""
WITH {BLOCKS}, r AS (SELECT source, doc_id, bi, length(line) AS len, row_number() OVER (PARTITION BY source ORDER BY length(line) DESC, doc_id, bi) AS k FROM blocks)
SELECT source, doc_id, bi::INT AS bi, len::BIGINT AS len FROM r WHERE k = 1""")
def o4(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d).select("source", "doc_id", "bi", F.length("line").cast("long").alias("len"))
    best = b.groupBy("source").agg(F.max_by(F.struct("doc_id", "bi", "len"), F.struct("len", -F.col("doc_id"), -F.col("bi"))).alias("x"))
    return best.select("source", "x.doc_id", "x.bi", "x.len")
