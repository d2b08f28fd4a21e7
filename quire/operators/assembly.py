"""From blocks to modules, pages and collections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import char_counts, multiset_difference
from .sequence import islands


def volume_units(parts: DataFrame, keys: list[str], divider: Column, chars: int = 800) -> DataFrame:
    """``unit``: parts up to each divider; a unit under ``chars`` is carried into the next."""
    w = Window.partitionBy(*keys).orderBy("part_no")
    numbered = parts.withColumn("__u", F.sum(F.coalesce(divider, F.lit(False)).cast("int")).over(w))
    size = numbered.groupBy(*keys, "__u").agg(F.sum("chars").alias("__n"))
    carried = Window.partitionBy(*keys).orderBy("__u").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    last = Window.partitionBy(*keys)
    target = F.coalesce(F.first(F.when(F.col("__n") >= chars, F.col("__u")), ignorenulls=True).over(carried), F.max("__u").over(last))
    return numbered.join(size.withColumn("unit", target).drop("__n"), [*keys, "__u"]).drop("__u")


def merge_joined(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Parts that go on in the next one (``joined``) are one with it: ``keys, part_no, text, parts``."""
    w = Window.partitionBy(*keys).orderBy("part_no")
    begins = (~F.coalesce(F.lag("joined").over(w), F.lit(False))).cast("int")
    grouped = parts.withColumn("__begins", begins).withColumn("__g", F.sum("__begins").over(w))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("part_no", "text"))), lambda x: x["text"])
    return grouped.groupBy(*keys, "__g").agg(F.min("part_no").alias("part_no"), F.array_join(listed, "\n").alias("text"), F.count("*").alias("parts")).drop("__g")


def join_continued(items: DataFrame, keys: list[str], text: str = "(continued)") -> DataFrame:
    """Figures parted by a line that says they go on become one: ``fig`` numbers the joined figures."""
    w = Window.partitionBy(*keys).orderBy("item_no")
    bridge = (F.col("text") == text) & (F.lag("k").over(w) == "fig") & (F.lead("k").over(w) == "fig")
    marked = items.withColumn("__b", F.coalesce(bridge, F.lit(False)))
    start = (F.col("k") == "fig") & ~F.coalesce(F.lag("__b").over(w), F.lit(False))
    return marked.withColumn("fig", F.when(F.col("k") == "fig", F.sum(start.cast("int")).over(w))).filter(~F.col("__b")).drop("__b")


def short_right(blocks: DataFrame, keys: list[str], short: Column) -> DataFrame:
    """``right``: a short last line after a long one is a signature."""
    w = Window.partitionBy(*keys).orderBy("bi")
    return blocks.withColumn("right", short & F.lead("bi").over(w).isNull() & F.coalesce(F.length(F.lag("line").over(w)) > 46, F.lit(False)))


def epigraphs(blocks: DataFrame, keys: list[str], most: int = 4) -> DataFrame:
    """``epigraph``: body lines between a heading and the name under them (a right-hand line that begins with a dash).

    ``blocks``: keys, bi, k, style, line.  What follows decides: the line that is
    no body after a stretch must be such a name, the one before it a heading, and the stretch
    ``most`` lines at most.
    """
    w = Window.partitionBy(*keys).orderBy("bi")
    body = (F.col("k") == "p") & F.col("style").isin("body", "noindent")
    name = (F.col("k") == "p") & (F.col("style") == "right") & F.trim("line").startswith("——")
    other = F.when(~body, F.struct(F.row_number().over(w).alias("at"), F.when(F.col("k") == "h", "h").when(name, "name").otherwise("").alias("is")))
    marked = blocks.withColumn("__other", other)
    before = F.last("__other", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("__other", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    marked = marked.withColumns({"__before": before, "__after": after})
    quoted = body & (F.col("__before.is") == "h") & (F.col("__after.is") == "name") & (F.col("__after.at") - F.col("__before.at") - 1 <= most)
    return marked.withColumn("epigraph", F.coalesce(quoted, F.lit(False))).drop("__other", "__before", "__after")


def heading_line(text: Column, middle: bool = False) -> Column:
    """A heading's text on one line: breaks become spaces, soft ones between CJK characters go; ``middle`` takes the middle of three lines or more."""
    lines = F.split(text, "[\\n\u2028]")
    text = F.when(F.size(lines) >= 3, F.get(lines, F.lit(1))).otherwise(text) if middle else text
    joined = F.regexp_replace(text, "(?<=[\u3400-\u9fff，：；、])\u2028(?=[\u3400-\u9fff“《（])", "")
    return F.trim(F.translate(joined, "\n\u2028", "  "))


def display_formulas(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``piece``: a paragraph's runs (keys, run_no, t, m) cut at each formula, which takes a mark that follows."""
    w = Window.partitionBy(*keys).orderBy("run_no")
    formula = F.col("m").isNotNull()
    tail = F.coalesce(F.lag(formula).over(w), F.lit(False)) & F.col("t").rlike("^[，。；：,.;:]$")
    after = F.coalesce(F.lag(formula).over(w), F.lit(False)) & ~tail
    later = F.coalesce(F.lag(formula, 2).over(w) & F.lag("t").over(w).rlike("^[，。；：,.;:]$"), F.lit(False))
    return runs.withColumn("__cut", (formula | after | (later & ~tail)).cast("int")).withColumn("piece", F.sum("__cut").over(w)).drop("__cut")


def layout_facts(blocks: DataFrame, plan: DataFrame, styles: DataFrame, keys: list[str]) -> DataFrame:
    """Each placed piece with its block's style: equi-joins on module, block and style."""
    return plan.join(blocks, [*keys, "bi"]).join(F.broadcast(styles), "style", "left")


def master_toc(books: DataFrame, modules: DataFrame, keys: list[str]) -> DataFrame:
    """A line a book (title and pages), a line a new volume, and the modules of level 1: ``kind, title, ord``."""
    w = Window.partitionBy(*keys).orderBy("ord")
    heads = books.select(*keys, F.lit("book").alias("kind"), F.concat_ws(" ", "title", "npages").alias("title"), F.lit(-1).cast("long").alias("ord"))
    volumes = modules.withColumn("__v", F.lag("volume").over(w)).filter(F.col("volume").isNotNull() & ~F.col("volume").eqNullSafe(F.col("__v")))
    volume = volumes.select(*keys, F.lit("volume").alias("kind"), F.col("volume").cast("string").alias("title"), F.col("ord").cast("long").alias("ord"))
    module = modules.filter("level = 1 AND NOT skip").select(*keys, F.lit("module").alias("kind"), "title", F.col("ord").cast("long").alias("ord"))
    return heads.unionByName(volume).unionByName(module)


def contents(modules: DataFrame, heads: DataFrame, keys: list[str], most: int = 45) -> DataFrame:
    """Modules and headings of rank 2, and of rank 3 while there are no more than ``most`` lines."""
    line = modules.select(*keys, "ord", F.lit(-1).alias("bi"), F.lit(1).alias("rank"), "title").unionByName(heads.filter("rank <= 3").select(*keys, "ord", "bi", "rank", "title"))
    n = F.count("*").over(Window.partitionBy(*keys))
    return line.withColumn("__n", n).filter((F.col("rank") < 3) | (F.col("__n") <= most)).drop("__n")


def contents_pruned(modules: DataFrame, heads: DataFrame, keys: list[str], most: int = 45) -> DataFrame:
    """Modules and headings of as many ranks as give no more than ``most`` lines; modules stay in any case."""
    line = modules.select(*keys, "ord", F.lit(-1).alias("bi"), F.lit(1).alias("rank"), "title").unionByName(heads.select(*keys, "ord", "bi", "rank", "title"))
    upto = F.count("*").over(Window.partitionBy(*keys).orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return line.withColumn("__n", upto).filter((F.col("rank") == 1) | (F.col("__n") <= most)).drop("__n")


def contents_titled(modules: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Modules and headings of rank 2 that are more than a number."""
    bare = F.col("title").rlike("^[ 　]*(?:第?[一二三四五六七八九十百零〇0-9]+[部篇章节]?[、.．]?|[IVXLC]+[.．]?|[A-Za-z][.．]?)[ 　]*$")
    named = heads.filter((F.col("rank") == 2) & ~bare)
    return modules.select(*keys, "ord", F.lit(-1).alias("bi"), F.lit(1).alias("rank"), "title").unionByName(named.select(*keys, "ord", "bi", "rank", "title"))


def assemble(units: DataFrame, keys: list[str], zones: DataFrame) -> DataFrame:
    """Modules in order with their zone (by range of parts, configured): front, body, back; bodies before back."""
    z = F.broadcast(zones.select(*keys, "zone", "lo", "hi"))  # a few rows a book
    placed = units.join(z, keys, "left").filter(F.col("zone").isNull() | F.col("part_no").between(F.col("lo"), F.col("hi")))
    order = F.when(F.col("zone") == "cover", 0).when(F.col("zone") == "front", 1).when(F.col("zone") == "back", 3).otherwise(2)
    w = Window.partitionBy(*keys).orderBy(order, "part_no")
    return placed.withColumn("zone", F.coalesce("zone", F.lit("body"))).withColumn("ord", F.row_number().over(w)).drop("lo", "hi")


def retry(plan: Callable[[DataFrame], DataFrame], faults: Callable[[DataFrame], DataFrame], modules: DataFrame, wider: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Modules whose plan has faults are planned again with wider variants; the better plan of each stays.

    ``faults`` gives keys and n.  Only failing modules are planned twice.
    """
    first = plan(modules)
    bad = faults(first).filter("n > 0").select(*keys, F.col("n").alias("before"))
    again = plan(wider(modules.join(bad.select(*keys), keys, "left_semi")))
    better = bad.join(faults(again).select(*keys, "n"), keys, "left").filter(F.coalesce("n", F.lit(0)) < F.col("before")).select(*keys)
    return first.join(better, keys, "left_anti").unionByName(again.join(better, keys, "left_semi"))


def blank_foot_figures(plan: DataFrame, figures: DataFrame, keys: list[str], page: int, least: int = 4) -> DataFrame:
    """Figures at the top of a page after one with at least ``least`` blank slots."""
    foot = plan.groupBy(*keys, "page_no").agg(F.max(F.col("slot") + F.col("hi") - F.col("lo")).alias("foot"))
    blank = foot.filter(page - F.col("foot") >= least).select(*keys, (F.col("page_no") + 1).alias("page_no"))
    return plan.filter("slot = 0").join(figures.select(*keys, "bi"), [*keys, "bi"], "left_semi").join(blank, [*keys, "page_no"], "left_semi").select(*keys, "bi").distinct()


def plates(blocks: DataFrame, plan: Callable[[DataFrame], DataFrame], keys: list[str], page: int, rounds: int = 8) -> tuple[DataFrame, DataFrame]:
    """Blocks without the figures that leave a blank foot, and these, which go to the back as plates.

    Planned again until no figure leaves one, ``rounds`` times at most; each
    round's blocks are a checkpoint in the shared folder.
    """
    moved = blocks.limit(0).select(*keys, "bi")
    for _ in range(rounds):
        bad = blank_foot_figures(plan(blocks), blocks.filter("floating"), keys, page).checkpoint()
        if bad.isEmpty():
            break
        moved = moved.union(bad)
        blocks = blocks.join(bad, [*keys, "bi"], "left_anti").checkpoint()
    return blocks, moved


def variant_stats(plan: DataFrame) -> DataFrame:
    """How often each spacing variant was chosen."""
    return plan.groupBy("variant").agg(F.count("*").alias("n"))


def filtered_counts(items: DataFrame, keys: list[str], skip: Column) -> DataFrame:
    """A2: characters of items but for those left out."""
    return char_counts(items.filter(~F.coalesce(skip, F.lit(False))), "text", keys)


def raw_missing(raw: DataFrame, extracted: DataFrame, keys: list[str]) -> DataFrame:
    """U4: characters of the raw text that the extraction lacks: ``keys, missing``; both corrected alike before."""
    diff = multiset_difference(char_counts(raw, "text", keys), char_counts(extracted, "text", keys), [*keys, "ch"])
    return diff.groupBy(*keys).agg(F.sum("missing").alias("missing"))


def outline(modules: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Outline rows of modules and headings in order with clamped levels."""
    from .sequence import clamp_outline

    rows = modules.select(*keys, (F.col("ord").cast("long") * 1_000_000).alias("o"), F.lit(1).alias("level"), "title").unionByName(heads.select(*keys, (F.col("ord").cast("long") * 1_000_000 + F.col("bi") + 1).alias("o"), F.col("rank").alias("level"), "title"))
    return rows.join(clamp_outline(rows, keys, "o", "level"), [*keys, "o"]).withColumn("level", F.col("clamped")).drop("clamped")


def centred_islands(blocks: DataFrame, keys: list[str], flag: Column) -> DataFrame:
    """Runs of flagged blocks as rows: first, last and size."""
    found = islands(blocks, keys, "bi", flag).filter("flag")
    return found.groupBy(*keys, "island").agg(F.min("bi").alias("first"), F.max("bi").alias("last"), F.count("*").alias("n"))
