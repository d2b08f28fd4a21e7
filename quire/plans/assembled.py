"""Queries over repairs and assembled modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly as A
from ..operators import repair as R
from ..operators import rules
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table

_WORDS = [("the", "ye"), ("der", "de"), ("la", "il")]


@query("t6_restore_words", f"""
WITH {BLOCKS}, w AS (SELECT doc_id, bi, string_split(line, ' ') AS w FROM blocks)
SELECT doc_id, bi::INT AS bi, md5(array_to_string(list_transform(w, lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^([^A-Za-zÀ-ɏ]*)the([^A-Za-zÀ-ɏ].*)?$', '\\1ye\\2'), '^([^A-Za-zÀ-ɏ]*)der([^A-Za-zÀ-ɏ].*)?$', '\\1de\\2'), '^([^A-Za-zÀ-ɏ]*)la([^A-Za-zÀ-ɏ].*)?$', '\\1il\\2')), ' ')) AS key FROM w""".replace("\\\\", "\\"))
def t6(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).select("doc_id", "bi", F.md5(R.restore_words(F.col("line"), _WORDS).cast("binary")).alias("key"))


@query("t7_restore_counts", f"""
WITH {BLOCKS}, w AS (SELECT unnest(regexp_extract_all(line, '[A-Za-zÀ-ɏ]+')) AS old FROM blocks) SELECT old, count(*) AS n FROM w WHERE old IN ('the', 'der', 'la') GROUP BY old""")
def t7(spark: SparkSession, d: str) -> DataFrame:
    return R.restore_counts(blocks(spark, d), "line", _WORDS)


@query("p14_slice_runs", f"""
WITH {BLOCKS}, t AS (SELECT doc_id, string_agg(line, '' ORDER BY bi) AS t FROM blocks GROUP BY doc_id) SELECT doc_id, substr(t, 101, 300) AS t FROM t WHERE length(t) > 100""")
def p14(spark: SparkSession, d: str) -> DataFrame:
    runs = blocks(spark, d).select("doc_id", F.col("bi").alias("run_no"), F.col("line").alias("t"), F.lit(100).cast("long").alias("a"), F.lit(400).cast("long").alias("b"))
    cut = R.slice_runs(runs, ["doc_id"], "a", "b")
    return cut.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run_no", "t"))), lambda x: x["t"]), "").alias("t"))


@query("w10_volume_units", """
WITH p AS (SELECT conv_id, turn, length(text) AS chars, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS u FROM conversations),
s AS (SELECT conv_id, u, sum(chars) AS n FROM p GROUP BY ALL),
t AS (SELECT a.conv_id, a.u, coalesce((SELECT min(b.u) FROM s b WHERE b.conv_id = a.conv_id AND b.u >= a.u AND b.n >= 800), (SELECT max(b.u) FROM s b WHERE b.conv_id = a.conv_id)) AS unit FROM s a)
SELECT p.conv_id, turn AS part_no, unit::BIGINT AS unit FROM p JOIN t USING (conv_id, u)""")
def w10(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("part_no"), F.length("text").alias("chars"), "role")
    return A.volume_units(parts, ["conv_id"], F.col("role") == "user").select("conv_id", "part_no", "unit")


@query("w18_short_right", f"""
WITH {BLOCKS}, n AS (SELECT *, lead(bi) OVER w AS nxt, lag(line) OVER w AS before FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY bi))
SELECT doc_id, bi::INT AS bi FROM n WHERE length(line) <= 46 AND nxt IS NULL AND length(before) > 46""")
def w18(spark: SparkSession, d: str) -> DataFrame:
    return A.short_right(blocks(spark, d), ["doc_id"], F.length("line") <= 46).filter("right").select("doc_id", "bi")


@query("w_islands", f"""
WITH {BLOCKS}, s AS (SELECT *, length(line) <= 46 AS f, bi - row_number() OVER (PARTITION BY doc_id, length(line) <= 46 ORDER BY bi) AS g FROM blocks)
SELECT doc_id, min(bi)::INT AS first, max(bi)::INT AS last, count(*) AS n FROM s WHERE f GROUP BY doc_id, g""")
def w_islands(spark: SparkSession, d: str) -> DataFrame:
    return A.centred_islands(blocks(spark, d), ["doc_id"], F.length("line") <= 46).select("doc_id", "first", "last", "n")


@query("j16_master_toc", """
WITH b AS (SELECT conv_id, min(left(text, 20)) AS title, count(*) AS npages FROM conversations GROUP BY conv_id),
m AS (SELECT conv_id, turn, role, left(text, 20) AS title, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)
SELECT conv_id, 'book' AS kind, title || ' ' || npages AS title, -1::BIGINT AS ord FROM b UNION ALL SELECT conv_id, 'volume', role, turn FROM m WHERE role IS DISTINCT FROM before
UNION ALL SELECT conv_id, 'module', title, turn FROM m WHERE turn % 2 = 0""")
def j16(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumn("title", F.left("text", F.lit(20)))
    books = c.groupBy("conv_id").agg(F.min("title").alias("title"), F.count("*").alias("npages"))
    modules = c.select("conv_id", F.col("turn").alias("ord"), "title", F.col("role").alias("volume"), (1 + F.col("turn") % 2).alias("level"), F.lit(False).alias("skip"))
    return A.master_toc(books, modules, ["conv_id"])


@query("l13_contents", f"""
WITH {BLOCKS}, h AS (SELECT doc_id, bi, 2 + length(line) % 3 AS rank FROM blocks WHERE length(line) <= 46), l AS (SELECT doc_id, -1 AS bi, 1 AS rank FROM documents UNION ALL SELECT * FROM h WHERE rank <= 3),
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM l) SELECT doc_id, bi::INT AS bi, rank::INT AS rank FROM n WHERE rank < 3 OR n <= 12""")
def l13(spark: SparkSession, d: str) -> DataFrame:
    modules = table(spark, d, "documents").select("doc_id", F.lit(0).alias("ord"), F.lit("").alias("title"))
    heads = blocks(spark, d).filter(F.length("line") <= 46).select("doc_id", F.lit(0).alias("ord"), "bi", (2 + F.length("line") % 3).alias("rank"), F.col("line").alias("title"))
    return A.contents(modules, heads, ["doc_id"], 12).select("doc_id", "bi", "rank")


@query("a2_filtered_chars", """
SELECT lang, ch, count(*) AS n FROM (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents WHERE source <> 'src0') WHERE ch NOT IN ('', ' ', chr(10)) GROUP BY lang, ch""")
def a2(spark: SparkSession, d: str) -> DataFrame:
    return A.filtered_counts(table(spark, d, "documents"), ["lang"], F.col("source") == "src0")


_STRIP = "regexp_replace(regexp_replace({}, '<[^>]*>', '', 'g'), '[ \\t\\r\\n' || chr(160) || ']', '', 'g')"


@query("u4_raw_missing", f"""
SELECT page_id, (length(h) - length(t))::BIGINT AS missing FROM (SELECT page_id, {_STRIP.format("html")} AS h, {_STRIP.format("regexp_replace(html, '<h1>.*</h1>', '')")} AS t FROM pages) WHERE h <> ''""")
def u4(spark: SparkSession, d: str) -> DataFrame:
    bare = lambda c: F.regexp_replace(c, "<[^>]*>", "")
    p = table(spark, d, "pages").select("page_id", "html")
    return A.raw_missing(p.select("page_id", bare("html").alias("text")), p.select("page_id", bare(F.regexp_replace("html", "<h1>.*</h1>", "")).alias("text")), ["page_id"])


@query("x5_move", f"""
WITH {BLOCKS}, p AS (SELECT doc_id, bi, CASE WHEN bi = 0 THEN 2.5 ELSE bi END AS place FROM blocks)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY place, bi) - 1)::INT AS item_no, bi::INT AS was FROM p""")
def x5(spark: SparkSession, d: str) -> DataFrame:
    items = blocks(spark, d).select(F.col("doc_id").alias("part"), F.col("bi").alias("item_no"), F.col("bi").alias("was"))
    moves = items.select("part").distinct().select("part", F.lit(0).alias("source"), F.lit(2).alias("after"))
    return rules.reorder(items, moves).select(F.col("part").alias("doc_id"), "item_no", "was")
