"""Repairs driven by tables of corrections, and operators on runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, chain, replaced, width_milli
from ..model import CLOSERS


def family_chain(text: Column, maps: list[tuple[str, str]], patterns: list[tuple[str, str]], words: list[tuple[str, str]], spaced_digits: bool = False) -> Column:
    """A family's repairs in order: gaps, its maps of glyphs, its patterns, spaces, its words.

    Dashes of three and more become two, a broken word at a line end is joined,
    and ``spaced_digits`` closes up digits set apart (twice, as they overlap).
    """
    out = replaced(F.replace(text, F.lit(" "), F.lit(" ")), maps)
    out = chain(out, [("(?<=[一-鿿])＞", "》"), ("—{3,}", "——"), *patterns, (" {2,}", " "), ("([a-zà-ɏ])- ?\\n([a-zà-ɏ])", "$1$2")])
    out = replaced(out, words)
    out = chain(out, [(" (?=[，。；：！？、）》”’】])", ""), ("(?<=[（《“‘【]) ", "")])
    return chain(out, [("([0-9]) (?=[0-9])", "$1")] * 2) if spaced_digits else out


def longest_first(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """O3: longer old texts first, then in their order."""
    return sorted(rules, key=lambda r: -len(r[0]))


def restore_words(text: Column, rules: list[tuple[str, str]], boundary: str = "A-Za-zÀ-ɏ") -> Column:
    """Whole words by one pass, longest first: what a rule made is not looked at again.

    The text is cut into matches of all old words and the rest; matches are
    looked up. One scan of a text for all rules.
    """
    if not rules:
        return text
    ordered = longest_first(rules)
    quote = lambda s: "\\Q" + s + "\\E"
    alternation = "|".join(quote(old) for old, _ in ordered)
    pattern = f"(?<![{boundary}])(?:{alternation})(?![{boundary}])"
    pieces = F.regexp_extract_all(text, F.lit(f"((?s)(?:{pattern})|.(?:(?!{pattern}).)*)"), 1)
    table = F.create_map(*[F.lit(x) for rule in ordered for x in rule])
    return F.when(text.rlike(pattern), F.array_join(F.transform(pieces, lambda p: F.coalesce(table[p], p)), "")).otherwise(text)


def restore_in_context(text: Column, rules: list[tuple[str, str, str, str]]) -> Column:
    """Entries ``(old, new, left, right)`` in order, each where its context stands; an empty context is any."""
    quote = lambda s: "\\Q" + s + "\\E"
    look = lambda kind, s: f"(?{kind}{quote(s)})" if s else ""
    return chain(text, [(look("<=", left) + quote(old) + look("=", right), new.replace("\\", "\\\\").replace("$", "\\$")) for old, new, left, right in rules])


def context_counts(df: DataFrame, text: str, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """``nth, n``: how often each entry applied, in the text that the entries before it left."""
    out, counts = F.col(text), []
    for k, rule in enumerate(rules):
        old, _, left, right = rule
        pattern = (f"(?<=\\Q{left}\\E)" if left else "") + f"\\Q{old}\\E" + (f"(?=\\Q{right}\\E)" if right else "")
        counts.append(F.sum(F.regexp_count(out, F.lit(pattern))).cast("long").alias(f"n{k}"))
        out = restore_in_context(out, [rule])
    sums = df.agg(*counts)
    return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("nth"), F.col(f"n{k}").alias("n")) for k in range(len(rules))])).alias("x")).select("x.*")


def restore_counts(df: DataFrame, text: str, rules: list[tuple[str, str]], boundary: str = "A-Za-zÀ-ɏ") -> DataFrame:
    """How often each entry applied: ``old, n``; entries are a parameter of a few hundred rows."""
    alternation = "|".join("\\Q" + old + "\\E" for old, _ in longest_first(rules))
    found = F.regexp_extract_all(text, F.lit(f"((?<![{boundary}])(?:{alternation})(?![{boundary}]))"), 1)
    return df.select(F.explode(found).alias("old")).groupBy("old").agg(F.count("*").alias("n"))


def fix_run_edges(runs: Column) -> Column:
    """A space at a border of runs before a closing mark goes, unless it parts two Latin words.

    Only runs with a space at an end are looked at closer; the others are passed on as they are.
    """
    latin_end, latin_start = "[A-Za-z0-9À-ɏ.,;:!?)\\]’']$", "^[A-Za-z0-9À-ɏ(\\[‘“\"]"

    def fixed(rs: Column) -> Column:
        def one(r: Column, i: Column) -> Column:
            before, after = F.get(rs, i - 1), F.get(rs, i + 1)
            t, gap = r["t"], F.lit(" ")
            word_space = (F.trim(t) == "") & F.coalesce(before["t"].rlike(latin_end) & after["t"].rlike(latin_start), F.lit(False))
            opens = F.startswith(t, gap) & (i > 0) & (F.ltrim(t) != "") & F.contains(F.lit(CLOSERS), F.left(F.ltrim(t), F.lit(1)))
            closed = F.endswith(t, gap) & r["i"].isNull() & F.coalesce((after["t"] != "") & F.contains(F.lit(CLOSERS), F.left(after["t"], F.lit(1))), F.lit(False))
            put = lambda t: F.struct(t.alias("t"), *[r[f].alias(f) for f in "bshaicm"])
            return F.when(opens & ~word_space, F.when(closed, put(F.trim(t))).otherwise(put(F.ltrim(t)))).when(closed & ~word_space, put(F.rtrim(t))).otherwise(r)

        return F.filter(F.transform(rs, one), lambda r: r["t"] != "")

    return bound(runs, fixed)


def head_fit(text: Column, milli: int) -> Column:
    """A running head that fits: whole, else up to a dash, bracket or colon, else a comma, else cut with dots."""
    cuts = F.array(*[F.substring_index(text, mark, 1) for mark in ("——", "（", "：")])
    fits = F.filter(cuts, lambda c: (c != text) & (c != "") & (width_milli(c) <= milli))
    comma = F.regexp_extract(text, "^(.*)[，；]", 1)
    most = milli // 280 + 1  # no character is narrower
    lengths = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(text), F.lit(most))))
    prefix = bound(text, lambda t: F.array_max(F.filter(lengths, lambda k: width_milli(F.substr(t, F.lit(1), k)) <= milli - 2000)))
    cut = F.concat(F.substr(text, F.lit(1), F.coalesce(prefix, F.lit(1))), F.lit("……"))
    return F.when(width_milli(text) <= milli, text).when(F.size(fits) > 0, F.get(fits, F.lit(0))).when((comma != "") & (width_milli(comma) <= milli), comma).otherwise(cut)


#: What is set apart from its text, by kind.
SPLITTERS = {
    "url": "https?://[^\\s，。；）]+", "exponent": "(?<=[0-9])\\^[0-9]+", "script": "[⁰¹²³⁴-⁹₀-₉]+", "operator": "[=≠≈≤≥±×÷∞∑√]",
    "latin": "[A-Za-zÀ-ɏ][A-Za-zÀ-ɏ'’-]*", "number": "[0-9]+(?:[.,][0-9]+)*",
}


def split_spans(text: Column, kind: str) -> Column:
    """The text in pieces, ``struct(t, hit)``: those of a kind and the rest, in order."""
    pattern = SPLITTERS[kind]
    pieces = F.regexp_extract_all(text, F.lit(f"((?s){pattern}|(?:(?!{pattern}).)+)"), 1)
    return F.transform(pieces, lambda p: F.struct(p.alias("t"), p.rlike(f"^(?:{pattern})$").alias("hit")))


def expand_pictures(runs: DataFrame, transcriptions: DataFrame, keep_missing: bool = True) -> DataFrame:
    """Runs (one a row) whose picture has a transcription take its text; others stay or are dropped.

    Runs without a picture meet nothing; they are dealt by what they hold, so that the join's shuffle has no task with all of them.
    """
    t = transcriptions.select(F.col("i").alias("__i"), F.col("text").alias("__text"))
    dealt = F.coalesce("i", F.xxhash64(*runs.columns).cast("string"))
    out = runs.withColumn("__k", dealt).join(t, (F.col("__k") == F.col("__i")) & F.col("i").isNotNull(), "left").drop("__k")
    if not keep_missing:
        out = out.filter(F.col("i").isNull() | F.col("__text").isNotNull())
    return out.withColumn("t", F.coalesce("__text", "t")).withColumn("i", F.when(F.col("__text").isNull(), F.col("i"))).drop("__i", "__text")


def dropped_pictures(runs: DataFrame, transcriptions: DataFrame) -> DataFrame:
    """Pictures without a transcription and how often they occur."""
    return runs.filter(F.col("i").isNotNull()).join(transcriptions.select("i"), "i", "left_anti").groupBy("i").agg(F.count("*").alias("n"))


def slice_runs(runs: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Of runs (keys, run_no, t) the characters from ``start`` to ``end`` (exclusive) of their whole text."""
    w = Window.partitionBy(*keys).orderBy("run_no").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("t")).over(w), F.lit(0))
    placed = runs.withColumn("__at", at)
    lo, hi = F.greatest(F.col(start) - F.col("__at"), F.lit(0)), F.least(F.col(end) - F.col("__at"), F.length("t").cast("long"))
    return placed.filter(hi > lo).withColumn("t", F.substr("t", (lo + 1).cast("int"), (hi - lo).cast("int"))).drop("__at")
