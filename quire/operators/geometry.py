"""Where the lines of planned pages stand, and the places of anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def line_places(plan: DataFrame, blocks: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``keys, page_no, bi, line_no, y``: each planned line's place, in slots from the top of its page.

    ``plan``: keys, page_no, bi, lo, hi, slot; ``blocks``: keys, bi and optionally
    kind (``h`` a heading, ``img`` a figure), slots (of a line) and brk (begins a page).
    Slots that a page leaves blank at its foot go above its last heading, but for one
    that opens the page; without a heading the lines are spread so that the last
    stands in the last slot; figures alone are centred.  The last page, and one
    before a block that begins a page, stays as it is.  All by windows over a
    page's pieces, which are as many as its slots at most.
    """
    given = lambda name, default: F.coalesce(F.col(name), F.lit(default)) if name in blocks.columns else F.lit(default)
    kinds = blocks.select(*keys, "bi", given("kind", "p").alias("kind"), given("slots", 1).alias("slots"), given("brk", False).alias("brk"))
    page, module = Window.partitionBy(*keys, "page_no"), Window.partitionBy(*keys)
    pieces = plan.join(kinds, [*keys, "bi"])
    foot = F.max(F.col("slot") + (F.col("hi") - F.col("lo")) * F.col("slots")).over(page)
    opens = F.max(F.struct((-F.col("slot")).alias("s"), ((F.col("lo") == 0) & F.col("brk")).alias("brk"))).over(page)["brk"]
    pieces = pieces.withColumns({"__foot": foot, "__top": F.min("slot").over(page), "__opens": opens, "__last": F.max("page_no").over(module), "__figures": F.min((F.col("kind") == "img").cast("int")).over(page)})
    ends = pieces.groupBy(*keys, "page_no").agg(F.max("__opens").alias("__brk")).select(*keys, (F.col("page_no") - 1).alias("page_no"), "__brk")
    pieces = pieces.join(ends, [*keys, "page_no"], "left")
    blank = F.when((F.col("page_no") == F.col("__last")) | F.coalesce("__brk", F.lit(False)), 0).otherwise(size - F.col("__foot"))
    pieces = pieces.withColumn("__blank", blank).withColumn("__head", F.max(F.when((F.col("kind") == "h") & (F.col("slot") > F.col("__top")), F.col("slot"))).over(page))
    figures = F.col("__figures") == 1
    spread = F.when((F.col("__blank") > 0) & F.col("__head").isNull() & ~figures & (F.col("__blank") < size - 1), (size - 1) / (size - 1 - F.col("__blank")).cast("double")).otherwise(1.0)
    shift = F.when(figures, F.col("__blank") / 2.0).when(F.col("slot") >= F.col("__head"), F.col("__blank").cast("double")).otherwise(0.0)
    lines = pieces.withColumns({"__spread": spread, "__shift": shift}).withColumn("line_no", F.explode(F.sequence("lo", F.col("hi") - 1)))
    y = (F.col("slot") + (F.col("line_no") - F.col("lo")) * F.col("slots")) * F.col("__spread") + F.col("__shift")
    return lines.select(*keys, "page_no", "bi", "line_no", y.alias("y"))


def anchor_places(anchors: DataFrame, starts: DataFrame, places: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, anchor, page_no, y``: anchors (keys, bi, at, anchor) stand with the line that holds their place; of equal names the first.

    ``starts``: keys, bi, line_no, start of the blocks' lines.
    """
    w = Window.partitionBy(*keys, "bi").orderBy("start")
    spans = starts.withColumn("__end", F.lead("start").over(w))
    held = anchors.join(spans, [*keys, "bi"]).filter((F.col("at") >= F.col("start")) & (F.col("__end").isNull() | (F.col("at") < F.col("__end"))))
    placed = held.join(places, [*keys, "bi", "line_no"])
    return placed.groupBy(*keys, "anchor").agg(F.min(F.struct("bi", "at", "page_no", "y")).alias("x")).select(*keys, "anchor", "x.page_no", "x.y")
