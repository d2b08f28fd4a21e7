"""Queries of notes that are printed without links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import notes as N
from ..registry import query
from ..sources.tables import BLOCKS, blocks

#: Every document is a part of its source's book; of eight lines the first is a heading, four are text with a mark in
#: front, the sixth announces notes, and two are notes. Parts whose number ends in 3 have their notes in the part before.
_ITEMS = f"""{BLOCKS}, items AS (
  SELECT source, doc_id AS part, bi, bi % 8 AS place, bi // 8 AS segment, length(line) % 4 AS n, length(line) % 7 = 0 AS raised FROM blocks),
notes AS (SELECT source, part, segment, place - 5 AS n, bi AS note_item FROM items WHERE place > 5),
marks AS (SELECT *, part % 10 = 3 AS away FROM items WHERE place BETWEEN 1 AND 4),
known AS (
  SELECT m.*, CASE WHEN away THEN m.part - 1 ELSE m.part END AS note_part, CASE WHEN away THEN 0 ELSE m.segment END AS note_segment, x.note_item FROM marks m
  LEFT JOIN notes x ON x.source = m.source AND x.n = m.n AND x.part = CASE WHEN away THEN m.part - 1 ELSE m.part END AND x.segment = CASE WHEN away THEN 0 ELSE m.segment END),
tied AS (
  SELECT *, CASE WHEN raised AND note_item IS NOT NULL THEN 'raised' WHEN raised THEN 'missing' ELSE 'order' END AS how FROM known
  WHERE raised OR note_item IS NOT NULL QUALIFY raised OR row_number() OVER (PARTITION BY source, part, segment, n, raised ORDER BY bi) = 1)"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d).select("source", F.col("doc_id").alias("part"), F.col("bi").alias("item_no"), "line")
    place, mark = F.col("item_no") % 8, F.concat(F.lit("("), F.length("line") % 4, F.lit(")"))
    quiet = F.translate("line", "()[]（）", "")
    text = F.when(place == 0, "head").when(place == 5, "注释：").when(place > 5, F.concat(F.lit("("), place - 5, F.lit(") "), quiet)).otherwise(F.concat(mark, quiet))
    raised = F.when(place.between(1, 4) & (F.length("line") % 7 == 0), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return b.select("source", "part", "item_no", F.when(place == 0, "h").otherwise("p").alias("k"), text.alias("text"), raised.alias("raised"))


def _links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    items = _items(spark, d)
    away = items.select("source", "part").distinct().filter("part % 10 = 3").withColumn("to_part", F.col("part") - 1)
    return N.link_plain_notes(items, ["source"], away)


@query("x5_plain_notes", f"""
WITH {_ITEMS} SELECT source, part, bi::INT AS item_no, segment::INT AS segment, n::INT AS n, how, CASE WHEN note_item IS NULL THEN -1 ELSE note_part END::BIGINT AS note_part, coalesce(note_item, -1)::INT AS note_item FROM tied""")
def x5n(spark: SparkSession, d: str) -> DataFrame:
    links = _links(spark, d)[0]
    return links.select("source", "part", "item_no", "segment", "n", "how", F.when(F.col("note_item").isNull(), -1).otherwise(F.col("note_part")).alias("note_part"), F.coalesce("note_item", F.lit(-1)).alias("note_item"))


@query("x5_plain_notes_back", f"""
WITH {_ITEMS}, back AS (SELECT source, note_part AS part, note_segment AS segment, n, min({{'p': part, 'i': bi}}) AS x FROM tied WHERE note_item IS NOT NULL GROUP BY ALL)
SELECT notes.source, notes.part, note_item::INT AS item_no, notes.n::INT AS n, coalesce(x.p, -1)::BIGINT AS mark_part, coalesce(x.i, -1)::INT AS mark_item FROM notes LEFT JOIN back USING (source, part, segment, n)""")
def x5b(spark: SparkSession, d: str) -> DataFrame:
    notes = _links(spark, d)[1]
    return notes.select("source", "part", "item_no", "n", F.coalesce("mark_part", F.lit(-1)).alias("mark_part"), F.coalesce("mark_item", F.lit(-1)).alias("mark_item"))


@query("x5_grouped_notes", f"""
WITH {BLOCKS}, last AS (SELECT source, max(doc_id) AS notes FROM documents GROUP BY source), chapters AS (SELECT source, doc_id AS part, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS chapter FROM documents JOIN last USING (source) WHERE doc_id <> notes),
entries AS (SELECT source, doc_id AS note_part, bi AS note_item, bi // 4 + 1 AS chapter, bi % 4 AS n FROM blocks JOIN last USING (source) WHERE doc_id = notes AND bi % 4 > 0)
SELECT b.source, b.doc_id AS part, b.bi::INT AS item_no, n::INT AS n, note_part, note_item::INT AS note_item FROM blocks b JOIN chapters c ON c.source = b.source AND c.part = b.doc_id JOIN entries e ON e.source = b.source AND e.chapter = c.chapter AND e.n = length(line) % 4
WHERE length(line) % 3 = 0""")
def x5g(spark: SparkSession, d: str) -> DataFrame:
    """The last part of each book has a line for each chapter and three notes under it."""
    b = blocks(spark, d).select("source", F.col("doc_id").alias("part"), F.col("bi").alias("item_no"), "line")
    last = b.groupBy("source").agg(F.max("part").alias("notes"))
    b = b.join(last, "source")
    place, quiet = F.col("item_no") % 4, F.translate("line", "()[]（）", "")
    listed = F.when(place == 0, "第一章").otherwise(F.concat(F.lit("["), place, F.lit("]"), quiet))
    text = F.when(F.col("part") == F.col("notes"), listed).otherwise(F.concat(F.lit("["), F.length("line") % 4, F.lit("]"), quiet))
    raised = F.when(F.length("line") % 3 == 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    items = b.select("source", "part", "item_no", F.lit("p").alias("k"), text.alias("text"), raised.alias("raised"), "notes")
    return N.link_grouped_notes(items, ["source"], F.col("notes"), "^第[一二三四五六七八九十]+章").select("source", "part", "item_no", "n", "note_part", "note_item")
