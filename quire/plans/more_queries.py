"""Queries of operators that others use, each for itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..lineage import cut
from ..operators import index_model as I
from ..operators import page_maps as PM
from ..operators import repair as R
from ..operators import sequence as Q
from ..operators.folding import ordered_fold
from ..registry import query
from ..sources.tables import BLOCKS, blocks
from .cjk_queries import nested
from .index_queries import _SERIES, _by_map, _place_of, _rounded, _series


@query("p15_apostrophes", f"""
WITH {BLOCKS}, c AS (SELECT doc_id, bi, translate(line, 'e', '’') AS t FROM blocks)
SELECT doc_id, bi::INT AS bi, coalesce(array_to_string(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN t[i] = '’' AND regexp_matches(t[i + 1], '^[A-Za-zÀ-ɏ]') AND (i = 1 OR regexp_matches(t[i - 1], '[A-Za-zÀ-ɏ \\t\\n　(（\\[]')) THEN 'ʼ' ELSE t[i] END), ''), '') AS line FROM c""")
def p15(spark: SparkSession, d: str) -> DataFrame:
    """Single closing quotes in the place of a common letter."""
    return blocks(spark, d).select("doc_id", "bi", X.apostrophes(F.translate("line", "e", "’")).alias("line"))


#: A family of another kind: no digits set apart, words broken at line ends.
_MAPS, _FIXES, _WORDS = [("x", "×"), ("q", "—")], [("([A-Z])([a-z]+)ing", "$1$2ĭng")], [("th", "þ"), ("þe", "ðe")]
_BROKEN = "replace(replace(line, ' ', '- ' || chr(10)), 'a', chr(160) || chr(160))"


@query("t3_family_chain", f"""
WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, replace(replace({nested(f"replace(replace(replace({_BROKEN}, chr(160), ' '), 'x', '×'), 'q', '—')", [("—{3,}", "'——'"), ("([A-Z])([a-z]+)ing", "'\\1\\2ĭng'"), (" {2,}", "' '"), ("([a-zà-ɏ])- ?\\n([a-zà-ɏ])", "'\\1\\2'")])}, 'th', 'þ'), 'þe', 'ðe') AS line FROM blocks""")
def t3(spark: SparkSession, d: str) -> DataFrame:
    broken = F.replace(F.replace("line", F.lit(" "), F.lit("- \n")), F.lit("a"), F.lit("  "))
    return blocks(spark, d).select("doc_id", "bi", R.family_chain(broken, _MAPS, _FIXES, _WORDS).alias("line"))


@query("w22_stitched_lines", f"""
WITH {BLOCKS}, p AS (SELECT doc_id, bi, line, bi // 3 AS g, bi % 3 AS k, CASE WHEN length(line) % 5 = 0 THEN -10 ELSE bi % 3 * 100 END AS x0 FROM blocks),
f AS (SELECT *, first_value(x0) OVER (PARTITION BY doc_id, g ORDER BY k) AS x_first, nth_value(x0, 2) OVER (PARTITION BY doc_id, g ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x_second FROM p),
h AS (SELECT *, CASE WHEN k >= 1 AND x_second < x_first THEN 1 ELSE 0 END + CASE WHEN k = 2 AND x0 < least(x_first, x_second) THEN 1 ELSE 0 END AS part FROM f)
SELECT doc_id, (min(bi) // 3 * 14.0 + min(k) * 0.2)::DOUBLE AS y, arg_min(x0, k)::DOUBLE AS x0, max(x0 + length(line))::DOUBLE AS x1, md5(string_agg(line, '' ORDER BY k)) AS key FROM h GROUP BY doc_id, g, part""")
def w22(spark: SparkSession, d: str) -> DataFrame:
    """Three pieces a line of a page, some of them left of the line's head."""
    k = F.col("bi") % 3
    b = blocks(spark, d).withColumn("x0", F.when(F.length("line") % 5 == 0, F.lit(-10.0)).otherwise(k * 100.0))
    y = F.floor(F.col("bi") / 3) * 14.0 + k * 0.2
    pieces = b.select(F.col("doc_id").alias("page"), y.alias("y"), "x0", (F.col("x0") + F.length("line")).alias("x1"), F.when(F.length("line") % 4 == 0, 10.5).otherwise(10.0).alias("size"), F.col("line").alias("text"))
    return Q.stitch_lines(pieces).select(F.col("page").alias("doc_id"), "y", "x0", "x1", F.md5(F.col("text").cast("binary")).alias("key"))


@query("i3_longest_rise", f"""
WITH {BLOCKS}, v AS (SELECT doc_id, list([{{'v': length(line) % 50, 'n': 0}}] ORDER BY bi) AS vs FROM blocks GROUP BY doc_id),
s AS (SELECT doc_id, list_reduce(list_prepend([]::STRUCT(v BIGINT, n INTEGER)[], vs), lambda a, x: list_append(a, {{'v': x[1].v, 'n': 1 + coalesce(list_max(list_transform(list_filter(a, lambda p: p.v <= x[1].v), lambda p: p.n)), 0)}})) AS a FROM v)
SELECT doc_id, list_max(list_transform(a, lambda p: p.n))::BIGINT AS n, true AS rises FROM s""")
def i3(spark: SparkSession, d: str) -> DataFrame:
    """How many lines of a document are in a longest sequence that never gets shorter, and that it is one."""

    def fold(rows):
        values = [n for _, n in rows]
        picked = [values[k] for k in I.lnds(values)]
        yield len(picked), picked == sorted(picked)

    sizes = blocks(spark, d).select("doc_id", "bi", (F.length("line") % 50).alias("n"))
    return ordered_fold(sizes, ["doc_id"], ["bi"], ["n"], "n long, rises boolean", fold)


_MAPPED = f"""{_SERIES},
lines AS (SELECT doc_id, regr_slope(y, start + off) AS slope, regr_intercept(y, start + off) AS line, count(*) AS n FROM anchors JOIN modules USING (doc_id, module) GROUP BY doc_id),
series AS (SELECT doc_id, coalesce(dens, 700.0)::DOUBLE AS dens, CASE WHEN n >= 6 AND slope > 0.3 / coalesce(dens, 700.0) AND slope < 3 / coalesce(dens, 700.0) THEN slope END AS slope, line FROM (SELECT DISTINCT doc_id FROM modules) LEFT JOIN dens USING (doc_id) LEFT JOIN lines USING (doc_id)),
own AS (SELECT doc_id, module, count(*) AS own, list({{'x': off::DOUBLE, 'y': y::DOUBLE}} ORDER BY off) AS points FROM anchors GROUP BY ALL),
maps AS (SELECT modules.*, coalesce(own, 0) AS own, points, dens, slope, CASE WHEN slope IS NOT NULL THEN line END AS line FROM modules JOIN series USING (doc_id) LEFT JOIN own USING (doc_id, module))"""


def _maps(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    words, tied = _series(spark, d)
    modules = PM.starts_of(words.groupBy("doc_id", "module").agg((F.count("*") * 18.0).alias("length")), ["doc_id"])
    kept = cut(PM.kept_anchors(tied, modules, ["doc_id"]))
    return PM.page_maps(kept, modules, ["doc_id"]), kept


@query("i5_page_maps", f"""
WITH {_MAPPED} SELECT doc_id, module::BIGINT AS module, start::DOUBLE AS start, own::BIGINT AS own, round(dens, 6) AS dens, round(coalesce(slope * 1000, -1), 6) AS slope, round(coalesce(line, -1), 4) AS line FROM maps""")
def i5(spark: SparkSession, d: str) -> DataFrame:
    maps = _maps(spark, d)[0]
    return maps.select("doc_id", "module", "start", "own", _rounded("dens", 6).alias("dens"), _rounded(F.coalesce(F.col("slope") * 1000, F.lit(-1.0)), 6).alias("slope"), _rounded(F.coalesce("line", F.lit(-1.0)), 4).alias("line"))


@query("i7_places_of_pages", f"""
WITH {_MAPPED}, ends AS (SELECT *, {_by_map("0.0")} AS low_page, {_by_map("length")} AS high_page FROM maps WHERE own >= 2 OR slope IS NOT NULL), asked AS (SELECT *, unnest(range(0, 60, 3)) + 0.5 AS page FROM ends)
SELECT doc_id, module::BIGINT AS module, page::DOUBLE AS page, round({_place_of("page")}, 1) AS place FROM asked WHERE page BETWEEN low_page - 0.6 AND high_page + 0.6""")
def i7(spark: SparkSession, d: str) -> DataFrame:
    """Where every third page is, in each module that reaches it."""
    maps, kept = _maps(spark, d)
    asked = maps.select("doc_id", "module", F.explode(F.sequence(F.lit(0), F.lit(57), F.lit(3))).alias("p")).select("doc_id", "module", (F.col("p") + 0.5).alias("asked"), F.lit(True).alias("page_asked"))
    found = PM.answered(maps, kept, asked, ["doc_id"]).filter("found IS NOT NULL")
    return found.select("doc_id", "module", F.col("asked").alias("page"), _rounded("found", 1).alias("place"))
