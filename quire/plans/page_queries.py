"""L, T21 and W18: queries of page geometry, plan costs, broken words, prefix keys and epigraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.hyphens import Breaker
from ..operators import assembly as A
from ..operators import geometry as G
from ..operators import index_model as I
from ..operators import layout as L
from ..registry import query
from ..sources import containers as S
from ..sources.tables import BLOCKS, blocks, table
from .cjk_queries import CJK, cjk_blocks

#: 24 blocks of a line a page of 30 slots; short ones are headings, some figures, some begin a page.
_PLAN = f"""{BLOCKS}, b AS (SELECT doc_id, bi, bi // 24 AS page_no, bi % 24 AS slot, CASE WHEN length(line) <= 46 THEN 'h' WHEN bi // 24 % 5 = 2 THEN 'img' ELSE 'p' END AS kind, length(line) % 5 = 0 AS brk FROM blocks),
p AS (SELECT *, max(slot) OVER pg + 1 AS foot, max(page_no) OVER (PARTITION BY doc_id) AS last, max(CASE WHEN kind = 'h' AND slot > 0 THEN slot END) OVER pg AS head, min((kind = 'img')::INT) OVER pg AS figures, max((brk AND slot = 0)::INT) OVER pg AS opens
  FROM b WINDOW pg AS (PARTITION BY doc_id, page_no)),
g AS (SELECT p.*, CASE WHEN p.page_no = p.last OR coalesce(o.opens, 0) = 1 THEN 0 ELSE 30 - foot END AS blank FROM p LEFT JOIN (SELECT DISTINCT doc_id, page_no - 1 AS page_no, opens FROM p) o ON o.doc_id = p.doc_id AND o.page_no = p.page_no),
y AS (SELECT doc_id, bi, page_no, CASE WHEN figures = 1 THEN slot + blank / 2.0 WHEN head IS NOT NULL THEN slot + CASE WHEN slot >= head THEN blank ELSE 0 END WHEN blank > 0 THEN slot * 29.0 / (29 - blank) ELSE slot END AS y FROM g)"""


def _places(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d).select("doc_id", "bi", "line")
    page = F.floor(F.col("bi") / 24)
    plan = b.select("doc_id", page.alias("page_no"), "bi", F.lit(0).alias("lo"), F.lit(1).alias("hi"), (F.col("bi") % 24).alias("slot"))
    kind = F.when(F.length("line") <= 46, "h").when(page % 5 == 2, "img").otherwise("p")
    return G.line_places(plan, b.select("doc_id", "bi", kind.alias("kind"), (F.length("line") % 5 == 0).alias("brk")), ["doc_id"], 30)


@query("l15_line_places", f"WITH {_PLAN} SELECT doc_id, bi::INT AS bi, page_no::BIGINT AS page_no, round(y, 6)::DOUBLE AS y FROM y")
def l15(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).select("doc_id", "bi", "page_no", F.round("y", 6).alias("y"))


@query("l15_anchor_places", f"""
WITH {_PLAN}, a AS (SELECT doc_id, bi, regexp_extract(line, '^[^ ]*') AS anchor FROM blocks)
SELECT doc_id, anchor, page_no::BIGINT AS page_no, round(y, 6)::DOUBLE AS y FROM a JOIN y USING (doc_id, bi) QUALIFY row_number() OVER (PARTITION BY doc_id, anchor ORDER BY bi) = 1""")
def l15a(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d).select("doc_id", "bi", "line")
    anchors = b.select("doc_id", "bi", F.lit(0).alias("at"), F.regexp_extract("line", "^[^ ]*", 0).alias("anchor"))
    starts = b.select("doc_id", "bi", F.lit(0).alias("line_no"), F.lit(0).alias("start"))
    return G.anchor_places(anchors, starts, _places(spark, d), ["doc_id"]).select("doc_id", "anchor", "page_no", F.round("y", 6).alias("y"))


@query("l5_plan_costs", f"""
WITH {BLOCKS}, b AS (SELECT doc_id, list([(1 + length(line) % 7)::DOUBLE] ORDER BY bi) AS sizes FROM blocks GROUP BY doc_id),
s AS (SELECT doc_id, list_reduce(list_prepend(list_transform(range(12), lambda u: CASE WHEN u = 0 THEN 0.0::DOUBLE ELSE 1e15 END), sizes), lambda a, x: list_transform(range(12), lambda v: least(
    CASE WHEN v = 0 THEN a[12 - x[1]::INT + 1] WHEN v >= x[1] THEN a[v - x[1]::INT + 1] ELSE 1e15 END,
    CASE WHEN v = x[1] THEN list_min(list_transform(range(1, 12), lambda u: a[u + 1] + 200.0 * (12 - u) + 500.0 * (11 - u) * (11 - u))) ELSE 1e15 END))) AS a FROM b)
SELECT doc_id, list_min(list_transform(range(12), lambda u: a[u + 1] + CASE WHEN u IN (1, 2) THEN 300.0 ELSE 0.0 END)) AS cost FROM s""")
def l5c(spark: SparkSession, d: str) -> DataFrame:
    """Blocks that are not split, on pages of 12 slots: the least cost of each document's plan."""
    sized = blocks(spark, d).select("doc_id", "bi", (1 + F.length("line") % 7).alias("nl"), F.lit(False).alias("splittable"))
    return L.paginate(sized, ["doc_id"], page=12).groupBy("doc_id").agg(F.max("cost").alias("cost"))


#: Patterns of the example: levels between letters, dots at a word's edges (fixed values).
_PATTERNS = ".th2 1ti 2tin 1re e1n 4ent n1d a2n an3g .un1 1ou s1t 2st. o1n 3ion. i2o 1er 2er. hea1 t1h 2th".split()
_LEVELS = """pats AS (SELECT p, regexp_replace(p, '[0-9]', '', 'g') AS letters, regexp_extract_all(p, '[0-9]?[^0-9]|[0-9]') AS pieces FROM (SELECT unnest({}) AS p)),
levels AS (SELECT letters, length(letters) AS size, k, max(level) AS level FROM (SELECT letters, unnest(list_transform(pieces, lambda x: coalesce(try_cast(left(x, 1) AS INT), 0))) AS level, generate_subscripts(pieces, 1) - 1 AS k FROM pats) WHERE level > 0 GROUP BY ALL)"""


@query("l10_broken_words", f"""
WITH {BLOCKS}, w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(line), '[a-z]+')) AS word FROM blocks), {_LEVELS.format(_PATTERNS)},
e AS (SELECT word, '.' || word || '.' AS edged, unnest(range(length(word) + 2)) AS spot FROM w),
hit AS (SELECT word, spot + k AS place, max(level) AS level FROM e JOIN levels ON substr(edged, spot + 1, size) = letters GROUP BY ALL),
cut AS (SELECT word, place - 1 AS i FROM hit WHERE level % 2 = 1 AND place BETWEEN 2 AND length(word))
SELECT w.word, coalesce(string_agg(i, ',' ORDER BY i), '') AS cuts FROM w LEFT JOIN cut USING (word) GROUP BY w.word""")
def l10(spark: SparkSession, d: str) -> DataFrame:
    words = blocks(spark, d).select(F.explode(F.regexp_extract_all(F.lower("line"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return words.mapInArrow(_broken, "word string, cuts string")


def _broken(batches):
    import pyarrow as pa

    breaker = Breaker(_PATTERNS)
    for batch in batches:
        cuts = [",".join(map(str, breaker(w))) for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(cuts, pa.string())], ["word", "cuts"])


_KEYS = f"""{CJK}, body AS (SELECT doc_id, bi, regexp_split_to_array(regexp_extract(line, '[一-鿿][\\s\\S]*'), '[，,；]\\s*([0-9]|第|见|另见)')[1] AS t FROM cjk),
every AS (SELECT doc_id, bi, list_filter(flatten(list_transform(regexp_split_to_array(t, '[，、（）()“”《》·\\s]+'), lambda w: [w, left(w, 4), left(w, 3), left(w, 2)])), lambda k: length(k) >= 2 AND regexp_matches(k, '^[一-鿿]')) AS every FROM body),
said AS (SELECT doc_id, bi, list_filter(every, lambda k, i: list_position(every, k) = i) AS ks FROM every)"""


@query("t21_prefix_keys", f"WITH {_KEYS} SELECT doc_id, bi::INT AS bi, len(ks)::BIGINT AS n, coalesce(ks[1], '') AS first, coalesce(ks[2], '') AS second FROM said")
def t21k(spark: SparkSession, d: str) -> DataFrame:
    keys = T.cjk_keys(F.col("line"))
    b = cjk_blocks(spark, d).select("doc_id", "bi", keys.alias("ks"))
    later = F.get("ks", F.lit(1))
    return b.select("doc_id", "bi", F.size("ks").cast("long").alias("n"), F.coalesce(F.get("ks", F.lit(0)), F.lit("")).alias("first"), F.coalesce(later, F.lit("")).alias("second"))


@query("t21_longest_known_key", f"""
WITH {_KEYS}, asked AS (SELECT doc_id, bi, unnest(ks) AS term, generate_subscripts(ks, 1) AS place FROM said WHERE bi % 2 = 0),
held AS (SELECT doc_id, unnest(ks) AS term FROM said WHERE bi % 2 = 1), n AS (SELECT doc_id, term, count(*) AS n FROM held GROUP BY ALL)
SELECT doc_id, bi::INT AS line_no, term, n::BIGINT AS n FROM asked JOIN n USING (doc_id, term) QUALIFY row_number() OVER (PARTITION BY doc_id, bi ORDER BY place) = 1""")
def t21l(spark: SparkSession, d: str) -> DataFrame:
    """Even lines are index lines, the keys of odd ones what occurs."""
    lines = cjk_blocks(spark, d).select("doc_id", F.col("bi").alias("line_no"), T.cjk_keys(F.col("line")).alias("terms"))
    held = lines.filter("line_no % 2 = 1").select("doc_id", F.explode_outer("terms").alias("term")).filter("term IS NOT NULL")
    return I.known_key(lines.filter("line_no % 2 = 0"), held, ["doc_id"])


@query("w18_epigraphs", f"""
WITH {BLOCKS}, b AS (SELECT doc_id, bi, CASE WHEN length(line) % 6 = 0 THEN 'h' WHEN length(line) % 6 = 1 THEN 'name' WHEN length(line) % 6 = 2 AND length(line) % 4 = 0 THEN 'other' ELSE 'body' END AS k FROM blocks),
o AS (SELECT *, max(CASE WHEN k <> 'body' THEN bi END) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, min(CASE WHEN k <> 'body' THEN bi END) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q FROM b)
SELECT o.doc_id, o.bi::INT AS bi FROM o JOIN b x ON x.doc_id = o.doc_id AND x.bi = o.p JOIN b y ON y.doc_id = o.doc_id AND y.bi = o.q WHERE o.k = 'body' AND x.k = 'h' AND y.k = 'name' AND q - p - 1 <= 4""")
def w18e(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("line") % 6
    name = n == 1
    styled = blocks(spark, d).select("doc_id", "bi", F.when(n == 0, "h").otherwise("p").alias("k"), F.when(name, "right").when((n == 2) & (F.length("line") % 4 == 0), "verse").otherwise("body").alias("style"), F.when(name, F.concat(F.lit(" ——"), "line")).otherwise(F.col("line")).alias("line"))
    return A.epigraphs(styled, ["doc_id"]).filter("epigraph").select("doc_id", "bi")


_EMS = "ceil((length({0}) * 520 - length(regexp_replace({0}, '[^iljtfr]', '', 'g')) * 200 + length(regexp_replace({0}, '[^mw]', '', 'g')) * 330) / 1000.0)::INT"


#: Tables of one row of words: a column for each of two lines' first words, as wide as they are.
@query("l9_column_widths", f"""
WITH {BLOCKS}, c AS (SELECT doc_id, bi, regexp_replace(left(line, 30), '[^a-z]', '', 'g') AS t FROM blocks), p AS (SELECT doc_id, bi // 2 AS tab, max(CASE WHEN bi % 2 = 0 THEN t END) AS a, max(CASE WHEN bi % 2 = 1 THEN t END) AS b FROM c GROUP BY ALL HAVING count(*) = 2)
SELECT doc_id, tab::BIGINT AS tab, {_EMS.format("a")} AS first, {_EMS.format("b")} AS second FROM p""")
def l9(spark: SparkSession, d: str) -> DataFrame:
    """Words that fit: each column as wide as its word needs."""
    cell = F.regexp_replace(F.left("line", F.lit(30)), "[^a-z]", "")
    pairs = blocks(spark, d).select("doc_id", F.floor(F.col("bi") / 2).alias("tab"), (F.col("bi") % 2).alias("side"), cell.alias("cell"))
    rows = pairs.groupBy("doc_id", "tab").agg(F.max(F.when(F.col("side") == 0, F.col("cell"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("cell"))).alias("b")).filter("b IS NOT NULL")
    widths = L.table_widths(rows.select("doc_id", "tab", F.lit(0).alias("row_no"), F.array("a", "b").alias("cells")), ["doc_id", "tab"], 60)
    return widths.select("doc_id", "tab", F.get("widths", F.lit(0)).alias("first"), F.get("widths", F.lit(1)).alias("second"))


@query("s2_pictures", """
WITH p AS (SELECT page_id, split_part(url, '/', 3) AS host, page_id % 3 AS f, page_id % 7 AS n, coalesce(html, '') AS html FROM pages),
t AS (SELECT DISTINCT host, 'OPS/Images/' || f || '/pic' || n || '.png' AS target, n FROM p),
named AS (SELECT host, target, CASE WHEN k = 1 THEN '' ELSE (k - 1) || '_' END || 'pic' || n || '.png' AS name FROM (SELECT *, row_number() OVER (PARTITION BY host, n ORDER BY target) AS k FROM t))
SELECT page_id, md5('<img alt="a" src="Images/' || name || '"/><img src="gone.png">' || html) AS markup FROM p JOIN named USING (host) WHERE target = 'OPS/Images/' || f || '/pic' || n || '.png'""")
def s2(spark: SparkSession, d: str) -> DataFrame:
    """Each host's pages are the parts of a book, which show pictures of like names in three folders."""
    n, folder = F.col("page_id") % 7, F.col("page_id") % 3
    shown = F.concat(F.lit("../Images/"), folder, F.lit("/pic"), n, F.lit(".png"))
    parts = table(spark, d, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("path"), F.col("page_id").alias("part_no"), F.concat(F.lit("OPS/Text/p"), "page_id", F.lit(".xhtml")).alias("source"), F.concat(F.lit('<img alt="a" src="'), shown, F.lit('"/><img src="gone.png">'), F.coalesce("html", F.lit(""))).alias("markup"))
    listed = S.picture_references(parts, ["path"]).filter(F.col("target").startswith("OPS/Images/")).select("path", "target").distinct()
    pictures = listed.withColumn("item_no", F.row_number().over(Window.partitionBy("path").orderBy("target")))
    out = S.with_pictures(parts, S.picture_names(pictures, ["path"]), ["path"])
    return out.select(F.col("part_no").alias("page_id"), F.md5(F.col("markup").cast("binary")).alias("markup"))
