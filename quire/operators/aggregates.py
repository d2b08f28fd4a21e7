"""A, O and U: multisets, modes, medians, samples and set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import visible


def char_counts(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """A1: ``keys, ch, n`` over the visible characters.

    The characters of a row are counted before they meet those of others, so
    the shuffle holds a row for each key, character and task.
    """
    chars = df.select(*keys, F.explode(F.split(visible(F.coalesce(F.col(column), F.lit(""))), "")).alias("ch"))
    return chars.filter("ch <> ''").groupBy(*keys, "ch").agg(F.count("*").alias("n"))


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of both multisets and their difference both ways."""
    left = a.select(*[F.col(k).alias(f"__a_{k}") for k in keys], F.col("n").alias("n_src"))
    right = b.select(*[F.col(k).alias(f"__b_{k}") for k in keys], F.col("n").alias("n_out"))
    on = reduce(lambda x, y: x & y, [F.col(f"__a_{k}").eqNullSafe(F.col(f"__b_{k}")) for k in keys])
    x, y = F.coalesce("n_src", F.lit(0)).cast("long"), F.coalesce("n_out", F.lit(0)).cast("long")
    names = [F.coalesce(f"__a_{k}", f"__b_{k}").alias(k) for k in keys]
    return left.join(right, on, "full").select(*names, x.alias("n_src"), y.alias("n_out"), F.greatest(x - y, F.lit(0)).cast("long").alias("missing"), F.greatest(y - x, F.lit(0)).cast("long").alias("extra"))


def most_common(counts: DataFrame, keys: list[str], item: str, k: int) -> DataFrame:
    """A3: the k most frequent items of each key; ties in order of the item."""
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), item)
    return counts.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= k)


def mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A4: the most frequent value of each key, the smallest of equals."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col(value))).alias("x")).select(*keys, f"x.{value}", "x.n")


def supported_extrema(df: DataFrame, keys: list[str], value: str, least: int = 5, part: int = 200) -> DataFrame:
    """A5: the largest and smallest value that max(least, total // part) rows have."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    held = counts.join(total, keys).filter(F.col("n") >= F.greatest(F.lit(least), F.floor(F.col("total") / part)))
    return held.groupBy(*keys).agg(F.max(value).alias("high"), F.min(value).alias("low"))


def char_census(df: DataFrame, column: str, pattern: str, order: list[str], context: int = 16) -> DataFrame:
    """Characters of a class, how often they occur, and the first one by ``order`` with what is around it.

    A line gives a row for each different character of the class, with its count and its first place; no row holds a line.
    """
    t, ch = F.col("__t"), F.col("ch")
    found = F.array_distinct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
    per_line = df.filter(F.col(column).rlike(pattern)).select(*order, F.col(column).alias("__t")).select(*order, "__t", F.explode(found).alias("ch"))
    counted = per_line.withColumn("n", F.length(t) - F.length(F.replace(t, ch, F.lit("")))).withColumn("at", F.position(ch, t))
    near = F.substr(t, F.greatest(F.lit(1), F.col("at") - context), F.least(F.col("at") - 1, F.lit(context)) + context + 1)
    small = counted.select(*order, "ch", "n", "at", near.alias("near"))
    return small.groupBy("ch").agg(F.sum("n").cast("long").alias("n"), F.min_by("near", F.struct(*order, "at")).alias("context"))


def picture_use(items: DataFrame, context: int = 16) -> DataFrame:
    """``img, uses, where, context`` of each picture in the runs of items (part, item_no, k, runs).

    ``where`` holds inline, alone or heading; ``context`` is the text around its first use.
    """
    text = F.transform("runs", lambda r: F.when(r["i"].isNotNull(), F.lit("\ufffc")).otherwise(r["t"]))
    spread = items.select("part", "item_no", "k", F.array_join(text, "").alias("t"), F.size("runs").alias("n"), text.alias("ts"), F.posexplode("runs").alias("pos", "r")).filter("r.i IS NOT NULL")
    before = F.length(F.array_join(F.slice("ts", F.lit(1), F.col("pos")), ""))
    near = F.substr("t", F.greatest(F.lit(1), before + 1 - context), F.least(before, F.lit(context)) + context + 1)
    where = F.when(F.col("k") == "h", "heading").when(F.col("n") == 1, "alone").otherwise("inline")
    used = spread.select(F.col("r.i").alias("img"), where.alias("w"), near.alias("near"), F.struct("part", "item_no", "pos").alias("at"))
    return used.groupBy("img").agg(F.count("*").alias("uses"), F.sort_array(F.collect_set("w")).alias("where"), F.min_by("near", "at").alias("context"))


def unused_pictures(pictures: DataFrame, use: DataFrame) -> DataFrame:
    """Pictures that no item shows."""
    return pictures.select("img").distinct().join(use.select("img"), "img", "left_anti")


def repair_difference(df: DataFrame, before: Column, after: Column, keys: list[str]) -> DataFrame:
    """U1 of a text and its repair: ``keys, ch, n_src, n_out, missing, extra``, in one scan and one aggregation.

    A row that the repair leaves alone gives its characters once, for both
    sides; only others give the repaired ones too.
    """
    side = lambda t, src, out: F.struct(F.split(visible(F.col(t)), "").alias("chars"), F.lit(src).alias("s"), F.lit(out).alias("o"))
    both = df.select(*keys, F.coalesce(before, F.lit("")).alias("a"), F.coalesce(after, F.lit("")).alias("b"))
    sides = F.when(F.col("a") == F.col("b"), F.array(side("a", 1, 1))).otherwise(F.array(side("a", 1, 0), side("b", 0, 1)))
    found = both.select(*keys, F.inline(sides)).select(*keys, F.explode("chars").alias("ch"), "s", "o").filter("ch <> ''")
    counted = found.groupBy(*keys, "ch").agg(F.sum("s").cast("long").alias("n_src"), F.sum("o").cast("long").alias("n_out"))
    more = lambda x, y: F.greatest(F.col(x) - F.col(y), F.lit(0))
    return counted.select(*keys, "ch", "n_src", "n_out", more("n_src", "n_out").alias("missing"), more("n_out", "n_src").alias("extra"))


def forgiven(df: DataFrame, keys: list[str], before: str, after: str, lost: str, gained: str) -> DataFrame:
    """Characters of one class that a repair took away, and how many of these it made up for by another class."""
    count = lambda c, p: F.regexp_count(c, F.lit(p))
    sums = df.groupBy(*keys).agg(F.sum(count(before, lost) - count(after, lost)).cast("long").alias("missing"), F.sum(count(after, gained) - count(before, gained)).cast("long").alias("__made"))
    return sums.withColumn("forgiven", F.least("missing", "__made")).drop("__made")


def repair_counts(df: DataFrame, column: str, keys: list[str], patterns: dict[str, str]) -> DataFrame:
    """A10: occurrences of each family of repairs."""
    return df.groupBy(*keys).agg(*[F.sum(F.regexp_count(column, F.lit(p))).cast("long").alias(n) for n, p in patterns.items()])


def report_rows(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """One row of measures a key."""
    return blocks.groupBy(*keys).agg(
        F.count_distinct("doc_id").alias("docs"), F.count("*").alias("lines"), F.sum(F.length("line")).cast("long").alias("chars"),
        F.sum((F.length("line") <= 46).cast("long")).alias("short"), F.sum(F.col("line").rlike("[,;:!?]{2,}").cast("long")).alias("punct_runs"),
    )


def codepoints(df: DataFrame, column: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """Distinct code points of a corpus and of fixed ranges."""
    used = df.select(F.explode(F.split(column, "")).alias("ch")).filter("ch <> ''").distinct().select(codepoint("ch").alias("cp"))
    for a, b in ranges:
        used = used.union(df.sparkSession.range(a, b + 1).select(F.col("id").alias("cp")))
    return used.distinct()


def codepoint(ch):
    """The code point of a one-character string (``ascii`` reads UTF-16 units; UTF-32 bytes do not)."""
    return F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("long")


def upper_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Element n // 2 of the sorted values: from counts of values, so a key's rows never meet in one task."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("m"))
    w = Window.partitionBy(*keys).orderBy(value)
    run = counts.withColumn("upto", F.sum("m").over(w)).withColumn("n", F.sum("m").over(Window.partitionBy(*keys)))
    return run.filter(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(*keys).agg(F.min(value).alias(value))


def only_in_first(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of a that b lacks."""
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")


def first_occurrence(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("x"))
    return first.select(*keys, "x.*")


def capped_samples(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """O2: the first k rows of each key and how many more there are."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = df.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= k).drop("__k")
    total = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return first.join(total, keys).withColumn("more", F.greatest(F.col("__n") - k, F.lit(0)).cast("long")).drop("__n")
