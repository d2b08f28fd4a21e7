"""Notes that a book prints without links: marks and entries tied by number, within a part and over several parts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folding import ordered_fold

#: Lines that announce notes; a number in round or square brackets.
LABELS = ("注释：", "注释:", "注释")
_NUMBER = r"[（(\[]([0-9]+)[）)\]]"


def note_segments(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items with ``role`` and ``segment``: in each part, notes follow a label up to a heading or a note of the author's.

    ``items``: keys, part, item_no, k, text and optionally author (a note of the
    author's own).  A label's lines are ``label``, then ``note``; others are
    ``text`` or ``anote``.  A part's first segment is 0; the next begins where notes end.
    """
    w = Window.partitionBy(*keys, "part").orderBy("item_no")
    label = (F.col("k") == "p") & F.trim("text").isin(*LABELS)
    author = F.coalesce("author", F.lit(False)) if "author" in items.columns else F.lit(False)
    ends = (F.col("k") == "h") | author
    event = F.when(label, 1).when(ends, 0)
    before = F.coalesce(F.last(event, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turned = F.sum((ends & ~label & (before == 1)).cast("int")).over(w)
    role = F.when(label, "label").when((before == 1) & ~ends, "note").when(author, "anote").otherwise("text")
    return items.withColumn("role", role).withColumn("segment", turned.cast("int"))


def marks_in(items: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, part, item_no, segment, role, start, end, n, raised`` of the bracketed numbers of texts, by place.

    ``items`` may have ``raised``, an array of the places where raised marks begin.
    """
    carried = [*keys, "part", "item_no", "segment", "role"]
    given = items.select(*carried, "text", F.col("raised") if "raised" in items.columns else F.array().cast("array<int>").alias("raised"))
    schema = T.StructType([*[given.schema[c] for c in carried], *T._parse_datatype_string("start int, end int, n int, raised boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, (text, up) in enumerate(zip(batch.column("text").to_pylist(), batch.column("raised").to_pylist())):
                for m in re.finditer(_NUMBER, text or ""):
                    rows.append(i)
                    found.append((m.start(), m.end(), min(int(m[1][-9:]), 2**31 - 1), m.start() in (up or ())))
            columns = list(zip(*found)) or [[], [], [], []]
            of = pa.array(rows, pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(of) for c in carried], *(pa.array(c, t) for c, t in zip(columns, kinds))], schema.fieldNames())

    return given.mapInArrow(run, schema)


def link_plain_notes(items: DataFrame, keys: list[str], elsewhere: DataFrame | None = None, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """X5 PNOTES: marks tied to the notes of their segment by number, and the notes with the mark that each goes back to.

    Raised marks count in any case.  A plain one counts if the segment has a
    note of its number that no plain mark took, and it is no more than ``most``
    from the last, so that years and list items are left alone.  A note that is
    left takes the first plain occurrence of its own text, ``(n)``, in the
    segment's text.  ``elsewhere`` (keys, part, to_part): marks of a part whose
    notes are another part's first segment.  A raised mark without a note
    stays, with ``how`` missing; a note without a mark has a null place.

    ``items`` as for ``note_segments`` and ``marks_in``.  Returns ``keys, part,
    item_no, segment, start, end, n, how, note_part, note_item`` and ``keys,
    part, item_no, segment, n, mark_part, mark_item, mark_start``.  Marks of a segment
    are a fold in their order; all else is joins on part, segment and number.
    """
    roles = note_segments(items, keys)
    place = [*keys, "part", "segment"]
    number = F.regexp_extract("text", r"^\s*" + _NUMBER, 1)
    said = F.regexp_extract("text", r"^\s*(" + _NUMBER + ")", 1)
    listed = roles.filter(F.col("role") == "note").withColumn("n", F.when(F.length(number) > 0, F.substring(number, -9, 9)).cast("int")).withColumn("said", said).filter("n IS NOT NULL")
    first = listed.groupBy(*place, "n").agg(F.min(F.struct("item_no", "said")).alias("x")).select(*place, "n", F.col("x.item_no").alias("note_item"), "x.said")

    marks = marks_in(roles.filter(F.col("role").isin("text", "anote")), keys)
    if elsewhere is None:
        marks = marks.withColumn("note_part", F.col("part")).withColumn("note_segment", F.col("segment"))
    else:
        marks = marks.join(elsewhere.select(*keys, "part", "to_part"), [*keys, "part"], "left")
        marks = marks.withColumn("note_part", F.coalesce("to_part", "part")).withColumn("note_segment", F.when(F.col("to_part").isNull(), F.col("segment")).otherwise(0)).drop("to_part")
    target = first.select(*keys, F.col("part").alias("note_part"), F.col("segment").alias("note_segment"), "n", "note_item", "said")
    known = marks.join(target, [*keys, "note_part", "note_segment", "n"], "left").withColumn("has", F.col("note_item").isNotNull())

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, taken = 0, set()
        for item, start, end, n, raised, has, role in rows:
            free = role == "anote"  # the author's own notes refer to any number that is left
            if raised:
                last = n
                yield item, start, end, n, "raised" if has else "missing"
            elif has and n not in taken and (free or abs(n - last) <= most):
                taken.add(n)
                last = last if free else max(n, last)
                yield item, start, end, n, "order"

    tied = ordered_fold(known, place, ["item_no", "start"], ["end", "n", "raised", "has", "role"], f"item_no {items.schema['item_no'].dataType.simpleString()}, start int, end int, n int, how string", fold)
    marked = known.select(*place, "item_no", "start", "raised", "note_part", "note_segment", "note_item", "said", "n", "end", "role")
    links = tied.join(marked.drop("n", "end", "said", "raised", "role"), [*place, "item_no", "start"])

    done = links.filter(F.col("how") != "missing").select(*keys, "note_part", "note_segment", "n").distinct()
    open_ones = target.join(done, [*keys, "note_part", "note_segment", "n"], "left_anti")
    again = marked.filter(~F.col("raised")).join(links.select(*place, "item_no", "start"), [*place, "item_no", "start"], "left_anti").filter((F.col("note_part") == F.col("part")) & (F.col("note_segment") == F.col("segment")))
    texts = roles.select(*place, "item_no", F.col("text").alias("__text"))
    same = again.drop("note_item", "said").join(open_ones, [*keys, "note_part", "note_segment", "n"]).join(texts, [*place, "item_no"]).filter(F.substr("__text", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("said"))
    late = same.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "note_part", "note_segment", "n").orderBy("item_no", "start"))).filter("k = 1").withColumn("how", F.lit("late"))
    columns = [*place, "item_no", "start", "end", "n", "how", "note_part", "note_item", "note_segment"]
    links = links.select(columns).unionByName(late.select(columns))

    back = links.filter("note_item IS NOT NULL").groupBy(*keys, "note_part", "note_segment", "n").agg(F.min(F.struct(F.col("part").alias("p"), F.col("item_no").alias("i"), F.col("start").alias("s"))).alias("x"))
    back = back.select(*keys, F.col("note_part").alias("part"), F.col("note_segment").alias("segment"), "n", F.col("x.p").alias("mark_part"), F.col("x.i").alias("mark_item"), F.col("x.s").alias("mark_start"))
    return links.drop("note_segment"), listed.select(*place, "item_no", "n").join(back, [*place, "n"], "left")


def link_grouped_notes(items: DataFrame, keys: list[str], notes_part: Column, heading: str) -> DataFrame:
    """X5 XNOTELINK: raised marks ``[n]`` of chapters and the entries ``[n]`` of one part, which has a heading for each chapter.

    ``items``: keys, part, item_no, k, text, raised; ``notes_part``: the part of
    a series that holds the notes; ``heading``: the pattern of its group heads;
    the k-th head is the k-th chapter's.  Returns ``keys, part, item_no, start, n,
    note_part, note_item``, an equi-join on chapter and number.
    """
    marked = items.withColumn("__notes", notes_part)
    inside = F.col("part") == F.col("__notes")
    w = Window.partitionBy(*keys).orderBy("item_no")
    heads = marked.filter(inside & (F.col("k") == "p")).withColumn("head", F.col("text").rlike(heading))
    number = F.regexp_extract("text", r"^\s*\[([0-9]{1,9})\]", 1)
    entries = heads.withColumn("chapter", F.sum(F.col("head").cast("int")).over(w)).filter(~F.col("head") & (F.length(number) > 0) & (F.col("chapter") > 0))
    entries = entries.select(*keys, "chapter", number.cast("int").alias("n"), F.col("part").alias("note_part"), F.col("item_no").alias("note_item"))
    entries = entries.groupBy(*keys, "chapter", "n").agg(F.min(F.struct("note_part", "note_item")).alias("x")).select(*keys, "chapter", "n", "x.note_part", "x.note_item")
    chapters = marked.filter(~inside).select(*keys, "part").distinct().withColumn("chapter", F.row_number().over(Window.partitionBy(*keys).orderBy("part")))
    found = marks_in(marked.filter(~inside).withColumn("segment", F.lit(0)).withColumn("role", F.lit("text")), keys).filter("raised")
    return found.join(chapters, [*keys, "part"]).join(entries, [*keys, "chapter", "n"]).select(*keys, "part", "item_no", "start", "n", "note_part", "note_item")
