"""Q: audits over line records ``page, y, x0, x1, size, font, text`` of a finished document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import CLOSERS, OPENERS
from .aggregates import mode, supported_extrema

#: What all audits read; a reader of a print format gives such a table, and Parquet is one.
LINES = "page long, y double, x0 double, x1 double, size double, font string, text string"


def pdf_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line records by their declared schema; columns that are absent are null, others are left out."""
    return spark.read.schema(LINES).parquet(path)


def page_features(lines: DataFrame) -> DataFrame:
    """Q12: ``page, lines, first, last``."""
    return lines.groupBy("page").agg(F.count("*").alias("lines"), F.min("y").alias("first"), F.max("y").alias("last"))


def modal_pitch(lines: DataFrame) -> DataFrame:
    """A4: the most frequent distance of neighbouring baselines, to a tenth of a point."""
    w = Window.partitionBy("page").orderBy("y")
    steps = lines.select(F.round(F.col("y") - F.lag("y").over(w), 1).alias("pitch")).filter("pitch > 0").withColumn("all", F.lit(1))
    return mode(steps, ["all"], "pitch").select("pitch", "n")


def blank_feet(lines: DataFrame, bottom: float, pitch: float, opens: DataFrame) -> DataFrame:
    """Q1: pages whose last line stands a pitch or more above the bottom, unless the next opens a section."""
    w = Window.orderBy("page").partitionBy(F.floor(F.col("page") / 100_000))
    pages = page_features(lines).join(opens.withColumn("opens", F.lit(True)), "page", "left").withColumn("next_opens", F.lead("opens").over(w)).withColumn("more", F.lead("page").over(w))
    return pages.filter((F.lit(bottom) - F.col("last") >= 0.9 * pitch) & F.col("next_opens").isNull() & F.col("more").isNotNull()).select("page", "last")


def off_grid(lines: DataFrame, top: float, pitch: float, slack: float = 0.3) -> DataFrame:
    """Q2: lines whose baseline lies between grid lines."""
    return lines.withColumn("off", F.pmod(F.round(F.col("y") - top, 3), F.lit(pitch))).filter((F.col("off") > slack) & (F.col("off") < pitch - slack))


def kinsoku(lines: DataFrame) -> DataFrame:
    """Q3: lines that begin with a closer or end with an opener."""
    first, last = F.substr("text", F.lit(1), F.lit(1)), F.right("text", F.lit(1))
    wrong = F.when((first != "") & F.contains(F.lit(CLOSERS), first), "begins").when((last != "") & F.contains(F.lit(OPENERS), last), "ends")
    return lines.withColumn("fault", wrong).filter(F.col("fault").isNotNull())


def beyond_edges(lines: DataFrame, slack: float = 3.0) -> DataFrame:
    """Q4: lines that reach beyond the right edge that enough lines have."""
    edges = supported_extrema(lines.select(F.lit(1).alias("all"), F.round("x1").alias("x1")), ["all"], "x1").select(F.col("high").alias("edge"))
    return lines.join(F.broadcast(edges), F.col("x1") > F.col("edge") + slack)  # one row of edges


def lone_lines(lines: DataFrame) -> DataFrame:
    """Q5: pages of a single line, and lines of marks or a single character only."""
    n = F.count("*").over(Window.partitionBy("page"))
    fault = F.when(F.length(F.trim("text")) == 1, "short").when(F.col("text").rlike("^[\\p{Punct}，。、；：！？）】》”’—…\\s]+$"), "marks").when(n == 1, "lone")
    return lines.withColumn("fault", fault).filter(F.col("fault").isNotNull())


def page_ends(lines: DataFrame, heading: Column) -> DataFrame:
    """Q5: headings that end a page (head_bottom) and pages that begin with a note mark (markstart)."""
    up, down = (F.row_number().over(Window.partitionBy("page").orderBy(order)) for order in (F.desc("y"), F.asc("y")))
    fault = F.when((F.col("__up") == 1) & (F.col("__down") > 1) & heading, "head_bottom").when((F.col("__down") == 1) & F.col("text").rlike("^[\\[［(（〔〖]?[0-9]+[\\]］)）〕〗]"), "markstart")
    return lines.withColumns({"__up": up, "__down": down}).withColumn("fault", fault).filter(F.col("fault").isNotNull()).drop("__up", "__down")


def links_out_of_range(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Q8: links to pages past the last one."""
    last = pages.agg(F.max("page").alias("__last"))  # one row
    return links.join(F.broadcast(last)).filter(F.col("target") > F.col("__last")).drop("__last")


def empty_pages(lines: DataFrame, first: int, last: int) -> DataFrame:
    """Q8: pages of a range without a line."""
    return lines.sparkSession.range(first, last + 1).select(F.col("id").alias("page")).join(lines.select("page").distinct(), "page", "left_anti")


def drawn_fonts(lines: DataFrame, kinds: DataFrame) -> DataFrame:
    """Q8: pages with a font whose glyphs are drawn (Type 3), by a table of fonts (font, kind)."""
    return lines.join(F.broadcast(kinds.filter("kind = 'Type3'").select("font")), "font").select("page", "font").distinct()  # the fonts of a document


def broken_numbers(lines: DataFrame) -> DataFrame:
    """Q6: numbers broken at a dash, and Latin words broken without a hyphen."""
    w = Window.partitionBy("page").orderBy("y", "x0")
    nxt = F.lead("text").over(w)
    fault = F.when(F.col("text").rlike("[0-9][-–—]$") & nxt.rlike("^[0-9]"), "numbreak").when(F.col("text").rlike("[a-z]$") & nxt.rlike("^[a-z]") & ~F.col("text").contains(" "), "split")
    return lines.withColumn("fault", fault).filter(F.col("fault").isNotNull())


def joiner_faults(lines: DataFrame) -> DataFrame:
    """Q8: joiners that took up room: lines (with ``width`` measured) whose text has a joiner at an end."""
    return lines.filter(F.col("text").rlike("^\\u2060|\\u2060$"))


def bad_bottoms(lines: DataFrame, slack: float = 0.06) -> DataFrame:
    """Q10: pages whose last baseline is not the modal one, the last page aside."""
    feet = page_features(lines).withColumn("all", F.lit(1)).withColumn("foot", F.round("last", 2))
    usual = mode(feet, ["all"], "foot").select(F.col("foot").alias("usual"))
    end = feet.agg(F.max("page").alias("end"))
    return feet.join(F.broadcast(usual)).join(F.broadcast(end)).filter((F.abs(F.col("foot") - F.col("usual")) > slack) & (F.col("page") < F.col("end"))).select("page", "last")


def loose_lines(lines: DataFrame, width: float, ems: float = 3.0) -> DataFrame:
    """Q11: ``loose, total`` of justified lines (nat: natural width in ems)."""
    return lines.agg(F.sum((F.lit(width) - F.col("nat") > ems).cast("long")).alias("loose"), F.count("*").alias("total"))
