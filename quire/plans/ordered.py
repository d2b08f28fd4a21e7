"""W: queries over ordered blocks; conversations stand for the modules of a book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import sequence as W
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table

KEY = ["doc_id"]
_HEAD = "length(line) <= 46 AND NOT regexp_matches(line, '[。！？；：，、,.!?;:]$')"


def short() -> Column:
    return F.length("line") <= 46


def head() -> Column:
    return short() & ~F.col("line").rlike("[。！？；：，、,.!?;:]$")


_ISLES = f"""WITH {BLOCKS}, s AS (SELECT *, length(line) <= 46 AS flag, ({_HEAD}) AS head FROM blocks),
c AS (SELECT *, (flag IS DISTINCT FROM lag(flag) OVER (PARTITION BY doc_id ORDER BY bi))::INT AS st FROM s),
i AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY bi) AS island FROM c),
g AS (SELECT *, count(*) OVER (PARTITION BY doc_id, island) AS size, row_number() OVER (PARTITION BY doc_id, island ORDER BY bi) AS nth,
      max(head::INT) OVER (PARTITION BY doc_id, island) AS held FROM i)"""


@query("w1_merge_broken", rf"""
WITH RECURSIVE {BLOCKS}, f AS (
  SELECT doc_id, bi, bi AS head, line AS t FROM blocks WHERE bi = 0
  UNION ALL
  SELECT b.doc_id, b.bi, CASE WHEN m THEN head ELSE b.bi END, CASE WHEN m THEN t || b.line ELSE b.line END FROM (
    SELECT f.*, b.line, b.bi AS nb, length(trim(f.t)) >= 20 AND NOT regexp_matches(rtrim(f.t, ' '), '[。！？…”」』）)：；:.!?\]】—―─·]$') AND NOT regexp_matches(b.line, '^[\[［（(][0-9]+[\]］）)]')
      AND (regexp_matches(b.line, '^[，、。；：）”’！？,;:)]') OR (length(rtrim(f.t, ' ')) >= 30 AND length(b.line) >= 3 AND NOT regexp_matches(b.line, '^[（(〔\[《“]|^[一二三四五六七八九十0-9]+[、.．]'))) AS m
    FROM f JOIN blocks b ON b.doc_id = f.doc_id AND b.bi = f.bi + 1) x JOIN blocks b ON b.doc_id = x.doc_id AND b.bi = x.nb)
SELECT doc_id, head::INT AS bi, max(length(t))::BIGINT AS len, count(*)::BIGINT AS parts FROM f GROUP BY doc_id, head""")
def w1(spark: SparkSession, d: str) -> DataFrame:
    return W.merge_broken(blocks(spark, d), KEY).select("doc_id", "bi", F.length("line").cast("long").alias("len"), "parts")


@query("w2_broken_pairs", rf"""
WITH {BLOCKS}, n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY bi) AS nxt FROM blocks)
SELECT doc_id, bi::INT AS bi FROM n WHERE line <> '' AND nxt IS NOT NULL
  AND NOT regexp_matches(line, '[。！？…”」』）)：；:.!?\]】—―─·]$|^[^ \t\n]{{0,14}}$') AND NOT regexp_matches(nxt, '^[　 \t]*[（(]?[一二三四五六七八九十0-9]')""")
def w2(spark: SparkSession, d: str) -> DataFrame:
    return W.broken_pairs(blocks(spark, d), KEY).select("doc_id", "bi")


@query("w3_short_islands", _ISLES + " SELECT doc_id, bi::INT AS bi, size::BIGINT AS size, (flag AND size >= 3 AND held = 1) AS centred FROM g")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return W.centre_weak_runs(blocks(spark, d), KEY, short(), head()).select("doc_id", "bi", "size", "centred")


@query("w4_keep_signatures", _ISLES + " SELECT doc_id, bi::INT AS bi, flag AS nostart, (flag AND nth < size) AS keep FROM g")
def w4(spark: SparkSession, d: str) -> DataFrame:
    return W.keep_signatures(blocks(spark, d), KEY, short()).select("doc_id", "bi", "nostart", "keep")


@query("w5_group_verse", f"WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, length(line) <= 26 AS verse FROM blocks")
def w5(spark: SparkSession, d: str) -> DataFrame:
    return blocks(spark, d).select("doc_id", "bi", (F.length(X.strip_markers(F.col("line"))) <= 26).alias("verse"))


@query("w6_merge_ordinals", _ISLES + """, l AS (SELECT *, flag AND nth % 2 = 1 AND lead(bi) OVER w IS NOT NULL AS leads, lead(line) OVER w AS nxt FROM g WINDOW w AS (PARTITION BY doc_id ORDER BY bi)),
m AS (SELECT *, coalesce(lag(leads) OVER (PARTITION BY doc_id ORDER BY bi), false) AS follows FROM l)
SELECT doc_id, bi::INT AS bi, CASE WHEN leads THEN line || chr(12288) || nxt ELSE line END AS line FROM m WHERE NOT follows""")
def w6(spark: SparkSession, d: str) -> DataFrame:
    return W.merge_ordinals(blocks(spark, d), KEY, short()).select("doc_id", "bi", "line")


_HEADS = f"WITH {BLOCKS}, heads AS (SELECT doc_id, bi, length(line) % 5 + 1 AS lvl FROM blocks WHERE length(line) <= 46)"


def heads(spark: SparkSession, d: str) -> DataFrame:
    """Short lines as headings; their length gives a level, as the test tables have none."""
    return blocks(spark, d).filter(short()).select("doc_id", "bi", (F.length("line") % 5 + 1).alias("lvl"))


@query("w7_rank", _HEADS + """, t AS (SELECT *, first_value(lvl) OVER (PARTITION BY doc_id ORDER BY bi) AS top FROM heads)
SELECT doc_id, bi::INT AS bi, (CASE WHEN lvl > top THEN least(9, 1 + dense_rank() OVER (PARTITION BY doc_id ORDER BY CASE WHEN lvl > top THEN lvl END NULLS LAST)) ELSE 1 END)::INT AS rank FROM t""")
def w7(spark: SparkSession, d: str) -> DataFrame:
    return W.rank_headings(heads(spark, d), KEY, "bi", "lvl").select("doc_id", "bi", "rank")


@query("w8_split_notes", f"""
WITH {BLOCKS}, s AS (SELECT *, (length(line) <= 200)::INT AS st, count(*) OVER (PARTITION BY doc_id) AS n FROM blocks),
r AS (SELECT *, avg(st) OVER (PARTITION BY doc_id ORDER BY bi DESC) AS share FROM s)
SELECT doc_id, coalesce(min(bi) FILTER (WHERE st = 1 AND share >= 0.6 AND bi >= 0.3 * n), -1)::INT AS first_note FROM r GROUP BY doc_id""")
def w8(spark: SparkSession, d: str) -> DataFrame:
    return W.split_notes(blocks(spark, d), KEY, F.length("line") <= 200).select("doc_id", F.coalesce("first_note", F.lit(-1)).alias("first_note"))


@query("w9_split_headings", f"""
WITH RECURSIVE {BLOCKS}, b AS (SELECT doc_id, bi, length(line) AS n, length(line) <= 46 AS h, sum(length(line)) OVER (PARTITION BY doc_id) AS total FROM blocks),
f AS (SELECT doc_id, bi, n AS since, n AS seen, false AS cut FROM b WHERE bi = 0
  UNION ALL SELECT b.doc_id, b.bi, CASE WHEN b.h AND f.since >= 1500 AND b.total - f.seen >= 350 THEN 0 ELSE f.since END + b.n, f.seen + b.n, b.h AND f.since >= 1500 AND b.total - f.seen >= 350
  FROM f JOIN b ON b.doc_id = f.doc_id AND b.bi = f.bi + 1)
SELECT doc_id, bi::INT AS cut FROM f WHERE cut""")
def w9(spark: SparkSession, d: str) -> DataFrame:
    return W.split_headings(blocks(spark, d), KEY, short())


_MODULES = """modules AS (SELECT conv_id, turn, role, 1 + length(text) // 600 AS npages, CASE WHEN role = 'system' OR turn = 0 THEN 'front' ELSE 'body' END AS zone FROM conversations)"""


def modules(spark: SparkSession, d: str) -> DataFrame:
    """Turns as modules: 600 characters a page, the first turn as front matter."""
    c = table(spark, d, "conversations")
    zone = F.when((F.col("role") == "system") | (F.col("turn") == 0), "front").otherwise("body")
    return c.select("conv_id", F.col("turn").alias("ord"), "role", (1 + F.floor(F.length("text") / 600)).cast("long").alias("npages"), zone.alias("zone"))


@query("w11_renumber", """
WITH notes AS (SELECT conv_id, turn, CASE WHEN length(text) % 3 > 0 THEN length(text) % 7 END AS anchor FROM conversations),
g AS (SELECT *, sum((anchor IS NOT NULL)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM notes),
marks AS (SELECT conv_id, length(text) % 5 AS anchor, min(1000 - turn) AS pos FROM conversations GROUP BY ALL),
h AS (SELECT g.conv_id, grp, row_number() OVER (PARTITION BY g.conv_id ORDER BY pos NULLS LAST, turn) AS n FROM g LEFT JOIN marks USING (conv_id, anchor) WHERE anchor IS NOT NULL)
SELECT g.conv_id, g.turn AS orig, coalesce(n, 0)::INT AS n FROM g LEFT JOIN h USING (conv_id, grp)""")
def w11(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    size = F.length("text")
    notes = c.select("conv_id", F.col("turn").alias("orig"), F.when(size % 3 > 0, size % 7).alias("anchor"))
    marks = c.select("conv_id", (size % 5).alias("href"), (1000 - F.col("turn")).alias("pos"))
    return W.renumber(notes, marks, ["conv_id"]).select("conv_id", "orig", "n")


@query("w12_flush_groups", """
WITH RECURSIVE o AS (SELECT conv_id, turn, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, 0 AS grp, CASE WHEN n >= 2400 THEN 0 ELSE n END AS held, n >= 2400 AS full_ FROM o WHERE k = 1
  UNION ALL SELECT o.conv_id, o.turn, o.k, f.grp + f.full_::INT, CASE WHEN f.held + o.n >= 2400 THEN 0 ELSE f.held + o.n END, f.held + o.n >= 2400 FROM f JOIN o ON o.conv_id = f.conv_id AND o.k = f.k + 1)
SELECT conv_id, turn, grp::INT AS grp FROM f""")
def w12(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("n"))
    return W.flush_groups(units, ["conv_id"], "turn", "n", 2400)


_PAGES = f"""{_MODULES}, b AS (SELECT *, coalesce(sum(npages) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM modules),
p AS (SELECT *, base + k AS page FROM (SELECT *, unnest(range(1, npages + 1)) AS k FROM b)),
seq AS (SELECT conv_id, turn, page, CASE WHEN zone = 'front' THEN 'r' ELSE 'D' END AS style, row_number() OVER (PARTITION BY conv_id, zone = 'front' ORDER BY page) AS label_no FROM p)"""


@query("w13_page_labels", f"WITH {_PAGES} SELECT conv_id, turn, page::BIGINT AS page, style, label_no::BIGINT AS label_no FROM seq")
def w13(spark: SparkSession, d: str) -> DataFrame:
    return W.page_sequence(modules(spark, d), ["conv_id"]).select("conv_id", F.col("ord").alias("turn"), "page", "style", "label_no")


@query("w14_page_of_offset", f"""
WITH {BLOCKS}, s AS (SELECT doc_id, bi, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM blocks),
q AS (SELECT doc_id, unnest(range(0, length(text), 700)) AS off FROM documents)
SELECT q.doc_id, off::BIGINT AS off, max(bi)::INT AS bi, (1 + max(bi) // 30)::BIGINT AS page FROM q JOIN s ON s.doc_id = q.doc_id AND start <= off GROUP BY q.doc_id, off""")
def w14(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import joins as J

    starts = W.series_offsets(blocks(spark, d), KEY).select("doc_id", "bi", "start_off")
    n = F.length("text")
    asked = table(spark, d, "documents").filter(n > 0).select("doc_id", F.explode(F.sequence(F.lit(0), n - 1, F.lit(700)).cast("array<bigint>")).alias("off"))
    return J.locate(asked, starts, KEY, "off").select("doc_id", "off", "bi", (1 + F.floor(F.col("bi") / 30)).cast("long").alias("page"))


@query("w15_outline_clamp", _HEADS.replace("WITH", "WITH RECURSIVE", 1) + """, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY bi) AS k FROM heads),
f AS (SELECT doc_id, bi, k, 1::BIGINT AS c FROM o WHERE k = 1 UNION ALL SELECT o.doc_id, o.bi, o.k, greatest(1, least(o.lvl, f.c + 1)) FROM f JOIN o ON o.doc_id = f.doc_id AND o.k = f.k + 1)
SELECT doc_id, bi::BIGINT AS bi, c::INT AS clamped FROM f""")
def w15(spark: SparkSession, d: str) -> DataFrame:
    return W.clamp_outline(heads(spark, d), KEY, "bi", "lvl")


@query("w16_label_ranges", f"""WITH {_PAGES}, l AS (SELECT *, lag(style) OVER (PARTITION BY conv_id ORDER BY page) AS last FROM seq)
SELECT conv_id, page::BIGINT AS page, style, label_no::BIGINT AS label_no FROM l WHERE last IS DISTINCT FROM style""")
def w16(spark: SparkSession, d: str) -> DataFrame:
    pages = W.page_sequence(modules(spark, d), ["conv_id"])
    return W.label_ranges(pages, ["conv_id"]).select("conv_id", "page", "style", "label_no")


@query("w20_series_offsets", f"""WITH {BLOCKS} SELECT doc_id, bi::INT AS bi, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_off FROM blocks""")
def w20(spark: SparkSession, d: str) -> DataFrame:
    return W.series_offsets(blocks(spark, d), KEY).select("doc_id", "bi", "start_off")


@query("w21_collapsed_outline", _ISLES.replace("length(line) <= 46 AS flag", "length(line) > 46 AS flag") + " SELECT doc_id, bi::INT AS bi, (CASE WHEN flag THEN size ELSE 1 END)::BIGINT AS n FROM g WHERE NOT flag OR nth = 1")
def w21(spark: SparkSession, d: str) -> DataFrame:
    return W.collapsed_outline(blocks(spark, d), KEY, ~short()).select("doc_id", "bi", "n")
