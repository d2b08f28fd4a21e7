"""F: predicates and classes of blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound
from ..model import CLOSERS, COUNT_WORDS, OPENERS, UNITS


def first_match(text: Column, rules: list[tuple[str, object]], default: object = None) -> Column:
    """The value of the first pattern that matches; rules keep their order in one CASE."""
    out = None
    for pattern, value in rules:
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return F.lit(default) if out is None else out.otherwise(default)


def headings_by_pattern(blocks: DataFrame, rules: list[tuple[str, int]], default: int, longest: int = 46) -> DataFrame:
    """short lines that end in no mark, with the rank of the first pattern that matches."""
    able = (F.length("line") <= longest) & ~F.col("line").rlike("[。！？；：，、,.!?;:]$")
    return blocks.filter(able).withColumn("rank", first_match(F.col("line"), rules, default))


def name_like(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """lines that look like a name, and whether a short line stands before them."""
    w = Window.partitionBy(*keys).orderBy("bi")
    name = (F.length("line") <= 44) & ~F.col("line").rlike("[0-9.,;:!?|#$%&*@。，；：！？]") & F.col("line").rlike("^[A-ZÀ-Þ]|·|^[一-鿿]{2,4}$")
    return blocks.withColumn("name_like", name).withColumn("after_heading", F.coalesce(F.length(F.lag("line").over(w)) <= 46, F.lit(False)))


def is_marker(run: Column) -> Column:
    """a linked or anchored run whose text is a number in brackets."""
    return (run["h"].isNotNull() | run["a"].isNotNull()) & F.trim(run["t"]).rlike("^[\\[［（(〔][0-9]+[\\]］）)〕]$")


def is_note_start(runs: Column) -> Column:
    """a paragraph whose first run is an anchored mark."""
    first = F.get(runs, F.lit(0))
    return F.coalesce(is_marker(first) & first["a"].isNotNull(), F.lit(False))


def is_separator(text: Column) -> Column:
    """a line of asterisks and spaces."""
    return text.rlike("^\\*(?:[ \\t　]*\\*)+$")


def legal_breaks(text: Column) -> Column:
    """positions (characters before the break) where a line may end.

    After a space, or between two characters of which one is CJK; never before
    a closer or after an opener.
    """
    wide = "[\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef]"

    def places(c: Column) -> Column:
        def may(i: Column) -> Column:
            a, b = F.get(c, i - 1), F.get(c, i)
            closer, opener = F.contains(F.lit(CLOSERS), b), F.contains(F.lit(OPENERS), a)
            return ~closer & ~opener & (b != " ") & ((a == " ") | a.rlike(wide) | b.rlike(wide))

        return F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(c) - 1)), may)

    chars = F.split(text, "")
    return F.when(F.length(text) < 2, F.array().cast("array<int>")).otherwise(bound(chars, places))


def divider_pages(blocks: DataFrame, keys: list[str], chars: int = 260, parts: int = 10) -> DataFrame:
    """F8: units of short lines only, with little text in few blocks."""
    t = blocks.groupBy(*keys).agg(F.sum(F.length("line")).alias("n"), F.count("*").alias("parts"), F.bool_and(F.length("line") <= 46).alias("short"))
    return t.select(*keys, ((F.col("n") < chars) & (F.col("parts") <= parts) & F.col("short")).alias("divider"))


def page_numbers(text: Column) -> Column:
    """numbers that may be pages: not before a unit, not after words of a count, not decimal."""
    quoted = lambda words: "|".join(f"\\Q{w}\\E" for w in words)
    return F.regexp_extract_all(text, F.lit(f"(?<![0-9.A-Za-z])(?<!{quoted(COUNT_WORDS)})([0-9]+)(?![0-9])(?!{quoted(UNITS)}|\\.[0-9])"), 1)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
