"""W: operators over ordered blocks.

Windows are partitioned by document (module, book), so no task holds more than
one document's order.  Order is always by explicit columns.  What depends on
what was decided before (W1, W9, W12, W15, W22) is a fold over a document's
blocks, which are read as a stream.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folding import ordered_fold

#: Marks that end a sentence.
_END = "[。！？…”」』）)：；:.!?\\]】—―─·]$"
_MARKS_AT_END = re.compile("(?:\u2060?[\\[［](?:[0-9]+|注[一二三四五六七八九十]+)[\\]］][ \t\n\u3000\u2060]*)+$")


def _ordered(keys: list[str], order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def islands(df: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """Runs of neighbouring rows with the same ``flag``: adds ``flag``, ``island`` (by key), ``size`` and ``nth`` (from 1)."""
    w = _ordered(keys, order)
    df = df.withColumn("flag", F.coalesce(flag, F.lit(False)))
    start = (~F.lag("flag").over(w).eqNullSafe(F.col("flag"))).cast("int")
    df = df.withColumn("__start", start).withColumn("island", F.sum("__start").over(w)).drop("__start")
    own = Window.partitionBy(*keys, "island")
    return df.withColumn("size", F.count("*").over(own).cast("long")).withColumn("nth", F.row_number().over(own.orderBy(order)))


def merge_broken(blocks: DataFrame, keys: list[str], order: str = "bi", text: str = "line") -> DataFrame:
    """Paragraphs that stop in mid-sentence, merged with what goes on: ``keys, order, text, parts``.

    A fold, as the length that counts is that of the paragraph merged so far;
    only its end is looked at.
    """
    ends, note = re.compile(_END), re.compile("^[\\[［（(][0-9]+[\\]］）)]")
    on, own = re.compile("^[，、。；：）”’！？,;:)]"), re.compile("^[（(〔\\[《“]|^[一二三四五六七八九十0-9]+[、.．]")

    def fold(rows):
        first, pieces, size, tail = None, [], 0, ""
        for at, line in rows:
            line = line or ""
            joins = False
            if pieces and not note.match(line):
                bare = _MARKS_AT_END.sub("", tail).rstrip("\u2060 ")
                length = size - len(tail) + len(bare)
                joins = length >= 20 and not ends.search(bare) and bool(on.match(line) or (length >= 30 and len(line) >= 3 and not own.match(line)))
            if not joins:
                if pieces:
                    yield first, "".join(pieces), len(pieces)
                first, pieces, size, tail = at, [], 0, ""
            pieces.append(line)
            size, tail = size + len(line), (tail + line)[-1000:]
        if pieces:
            yield first, "".join(pieces), len(pieces)

    kind = blocks.schema[order].dataType.simpleString()
    return ordered_fold(blocks, keys, [order], [text], f"{order} {kind}, {text} string, parts long", fold)


def broken_pairs(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours of which the first seems to stop in mid-sentence."""
    w = _ordered(keys, "bi")
    nxt = F.lead("line").over(w)
    stops = ~F.col("line").rlike(_END + "|^[^ \\t\\n]{0,14}$") & nxt.isNotNull() & ~nxt.rlike("^[　 \\t]*[（(]?[一二三四五六七八九十0-9]")
    return blocks.withColumn("stops", stops).filter((F.col("line") != "") & F.col("stops")).drop("stops")


def centre_weak_runs(blocks: DataFrame, keys: list[str], short: Column, heading: Column, least: int = 3) -> DataFrame:
    """``centred``: runs of at least ``least`` short lines of which one is a heading."""
    found = islands(blocks.withColumn("__h", heading), keys, "bi", short)
    held = F.max(F.col("__h").cast("int")).over(Window.partitionBy(*keys, "island"))
    return found.withColumn("centred", F.col("flag") & (F.col("size") >= least) & (held == 1)).drop("__h")


def keep_signatures(blocks: DataFrame, keys: list[str], right: Column) -> DataFrame:
    """In a run of right-aligned blocks none starts a page, and all but the last stay with the next."""
    found = islands(blocks, keys, "bi", right)
    return found.withColumn("nostart", F.col("flag")).withColumn("keep", F.col("flag") & (F.col("nth") < F.col("size")))


def merge_ordinals(blocks: DataFrame, keys: list[str], ordinal: Column) -> DataFrame:
    """A bare ordinal and the heading after it become one; pairs are taken from the left and do not overlap."""
    found = islands(blocks, keys, "bi", ordinal)
    w = _ordered(keys, "bi")
    leads = F.col("flag") & (F.col("nth") % 2 == 1) & F.lead("bi").over(w).isNotNull()
    found = found.withColumn("leads", leads).withColumn("follows", F.coalesce(F.lag("leads").over(w), F.lit(False)))
    title = F.when(F.col("leads"), F.concat_ws("　", "line", F.lead("line").over(w))).otherwise(F.col("line"))
    return found.withColumn("line", title).filter(~F.col("follows")).drop("leads", "follows")


def rank_headings(heads: DataFrame, keys: list[str], order: str, level: str, most: int = 9) -> DataFrame:
    """``rank``: the first heading's level is 1, and so are levels not deeper; deeper levels count from 2."""
    w = _ordered(keys, order)
    heads = heads.withColumn("__top", F.first(level).over(w))
    deeper = F.when(F.col(level) > F.col("__top"), F.col(level))
    dense = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(deeper)))
    return heads.withColumn("rank", F.when(F.col(level) > F.col("__top"), F.least(F.lit(most), dense + 1)).otherwise(1)).drop("__top")


def split_notes(blocks: DataFrame, keys: list[str], is_start: Column, share: float = 0.6, at_least: float = 0.3) -> DataFrame:
    """``first_note``: the earliest note from which on ``share`` of the blocks are notes."""
    w = Window.partitionBy(*keys).orderBy(F.desc("bi"))
    b = blocks.withColumn("__s", is_start.cast("int"))
    b = b.withColumn("__share", F.avg("__s").over(w)).withColumn("__n", F.count("*").over(Window.partitionBy(*keys)))
    held = (F.col("__s") == 1) & (F.col("__share") >= share) & (F.col("bi") >= at_least * F.col("__n"))
    return b.groupBy(*keys).agg(F.min(F.when(held, F.col("bi"))).alias("first_note"))


def split_headings(blocks: DataFrame, keys: list[str], heading: Column, chars: int = 1500, tail: int = 350) -> DataFrame:
    """``cut``: headings at least ``chars`` after the last cut (or the start) and ``tail`` before the end."""
    total = F.sum(F.length("line")).over(Window.partitionBy(*keys))
    sized = blocks.select(*keys, "bi", F.length("line").alias("n"), heading.alias("h"), total.alias("total"))

    def fold(rows):
        since = seen = 0
        for bi, n, h, total in rows:
            if h and since >= chars and total - seen >= tail:
                since = 0
                yield (bi,)
            since, seen = since + n, seen + n

    return ordered_fold(sized, keys, ["bi"], ["n", "h", "total"], "cut int", fold)


def flush_groups(units: DataFrame, keys: list[str], order: str, size: str, least: int) -> DataFrame:
    """``grp``: units gathered until their sizes reach ``least``; then a new group begins."""

    def fold(rows):
        held = group = 0
        for at, n in rows:
            yield at, group
            held += n
            if held >= least:
                held, group = 0, group + 1

    kind = units.schema[order].dataType.simpleString()
    return ordered_fold(units, keys, [order], [size], f"{order} {kind}, grp int", fold)


def renumber(notes: DataFrame, marks: DataFrame, keys: list[str]) -> DataFrame:
    """Notes in the order of their first mark; notes without one after them, in their own order.

    ``notes``: keys, anchor (null: goes on with the note before), orig.
    ``marks``: keys, href, pos.  Adds ``n``, the note's new number.
    """
    w = _ordered(keys, "orig")
    grouped = notes.withColumn("grp", F.sum(F.col("anchor").isNotNull().cast("int")).over(w))
    first = marks.groupBy(*keys, F.col("href").alias("anchor")).agg(F.min("pos").alias("pos"))
    head = grouped.filter(F.col("anchor").isNotNull()).join(first, [*keys, "anchor"], "left")
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("pos"), "orig")
    numbered = head.select(*keys, "grp", F.row_number().over(order).alias("n"))
    return grouped.join(numbered, [*keys, "grp"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def page_sequence(modules: DataFrame, keys: list[str]) -> DataFrame:
    """A row a page: ``page`` over the book, ``label_no`` within the front matter or the rest, roman or arabic."""
    w = _ordered(keys, "ord")
    base = modules.withColumn("base", F.coalesce(F.sum("npages").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    pages = base.filter("npages > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("npages").cast("int")))).withColumn("page", (F.col("base") + F.col("k")).cast("long"))
    front = F.col("zone").isin("front", "cover")
    label = F.row_number().over(Window.partitionBy(*keys, front).orderBy("page"))
    return pages.withColumn("style", F.when(front, "r").otherwise("D")).withColumn("label_no", label.cast("long"))


def label_ranges(pages: DataFrame, keys: list[str]) -> DataFrame:
    """A record where the style of page labels changes."""
    w = _ordered(keys, "page")
    return pages.withColumn("__last", F.lag("style").over(w)).filter(F.col("__last").isNull() | (F.col("__last") != F.col("style"))).drop("__last")


def clamp_outline(heads: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    """A level is at most one deeper than the clamped level before; a fold over a book's headings."""

    def fold(rows):
        last = 0
        for at, deep in rows:
            last = max(1, min(deep, last + 1))
            yield at, last

    return ordered_fold(heads.withColumn(order, F.col(order).cast("long")), keys, [order], [level], f"{order} long, clamped int", fold)


def series_offsets(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Each block's first character in the text that joins the blocks with a break."""
    w = _ordered(keys, "bi").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("start_off", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).cast("long"))


def collapsed_outline(blocks: DataFrame, keys: list[str], long: Column) -> DataFrame:
    """Runs of long paragraphs as one row with their count; other blocks stand."""
    found = islands(blocks, keys, "bi", long)
    return found.filter(~F.col("flag") | (F.col("nth") == 1)).withColumn("n", F.when(F.col("flag"), F.col("size")).otherwise(1).cast("long"))


def stitch_lines(pieces: DataFrame) -> DataFrame:
    """Pieces of one visual line of a PDF page: y and size within 0.6 of the merged head, not left of it."""

    def fold(rows):
        head = None
        for y, x0, x1, size, text in rows:
            if head and abs(head[0] - y) < 0.6 and abs(head[3] - size) < 0.6 and x0 >= head[1]:
                head = [head[0], head[1], max(head[2], x1), head[3], head[4] + [text]]
                continue
            if head:
                yield (*head[:4], "".join(head[4]))
            head = [y, x0, x1, size, [text]]
        if head:
            yield (*head[:4], "".join(head[4]))

    return ordered_fold(pieces, ["page"], ["y", "x0", "x1", "size", "text"], [], "y double, x0 double, x1 double, size double, text string", fold)
