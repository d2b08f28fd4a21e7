"""D: detectors of doubtful text: ``category, loc..., context``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound
from ..model import ASCII_STOPS, CJK, WIDE_STOPS

_C, _LATIN, _DIGIT, _LIKE_DIGITS = f"[{CJK}]", "[A-Za-z]", "[0-9]", "[lIO]"
_QUOTES = "“”「」"


def _any(*patterns: str) -> str:
    return "|".join(patterns)


def _ascii_marks() -> str:
    """ASCII marks where wide ones belong: stops after a CJK character that goes on or ends the text, points and brackets next to CJK."""
    goes_on = f"(?=[{CJK}{_QUOTES}]|$)"
    return _any(f"{_C}[{ASCII_STOPS}]{goes_on}", f"{_C}\\.(?={_C})", f"{_C}\\((?={_C})", f"(?<={_C})\\)")


def _digit_likes() -> str:
    """Letters that look like digits between, before or after digits."""
    return _any(_DIGIT + _LIKE_DIGITS + _DIGIT, _LIKE_DIGITS + _DIGIT + "{3}", _DIGIT + "{3}" + _LIKE_DIGITS + f"(?!{_LATIN})")


def _stop_runs() -> str:
    """Two stops or more, and a stop before a closing quote that another stop follows or that takes no comma inside."""
    return _any(f"[{WIDE_STOPS}]{{2,}}", "，」", "，”(?=[，。])")


#: Category -> Java pattern; the whole match is the finding.
PATTERNS = {
    "dup-char": f"({_C})\\1",
    "dup-word": f"({_C}{{2,4}})\\1",
    "dup-word-latin": "\\b(\\w{2,})\\s+\\1\\b",
    "punct-run": _stop_runs(),
    "punct-run-ascii": f"[{ASCII_STOPS}]{{2,}}",
    "space-in-cjk": f"{_C}[ \\u00a0]+{_C}",
    "ascii-punct": _ascii_marks(),
    "digit-lookalike": _digit_likes(),
    "private-use": "[\\x{E000}-\\x{F8FF}\\x{FFFD}□]",
    "cyrillic": "[\\x{400}-\\x{4FF}]",
    "single-dash": f"(?<={_C})—(?={_C})",
    "single-ellipsis": "(?<!…)…(?!…)",
    "word-digit": f"{_LATIN}{{2,}}{_DIGIT}",
    "no-space-after": f"[a-z][,;]{_LATIN}",
    "straight-quote": "\"",
    "three-dots": "\\.\\.\\.",
    "odd-space": "[\\u2000-\\u200a\\u202f\\u205f]",
    "no-break-space": "\\u00a0",
    "adjacent-format": "</(i|b|em|strong)> <\\1>",
}
#: Runs of marks and doubled characters that are right (fixed values).
ALLOWED = {"punct-run": ["？！", "！？", "？？", "！！", "。」"], "dup-char": [c * 2 for c in "人天年日常往渐仅刚"]}
#: Marks that come in pairs (fixed values).
PAIRS = ("（）", "《》", "“”", "‘’", "「」", "『』", "〈〉", "()", "[]", "【】")


def findings(df: DataFrame, text: str, categories: list[str], around: int = 14) -> DataFrame:
    """A row a match: the columns of ``df``, ``category``, ``match``, ``nth`` and ``context``; a Catalyst plan, one explode.

    A text is split before each match, so each has its own context: up to
    ``around`` characters before it and after it.
    """
    clean = F.replace(F.col(text), F.lit(_CUT), F.lit(""))

    def of(category: str) -> Column:
        pieces = F.split(F.regexp_replace(clean, PATTERNS[category], _CUT + "$0"), _CUT)
        matches = F.regexp_extract_all(clean, F.lit(PATTERNS[category]), 0)  # 0: the whole match, so back-references keep their numbers

        def placed(ms: Column, ps: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                # A piece has a character at least, so so many pieces on both sides are enough.
                before = F.slice(ps, F.greatest(F.lit(1), i + 2 - around), F.least(F.lit(around), i + 1))
                after = F.slice(ps, i + 2, F.lit(around + 1))
                left = F.right(F.array_join(F.transform(before, lambda p: F.right(p, F.lit(around))), ""), F.lit(around))
                right = F.left(F.array_join(F.transform(after, lambda p: F.left(p, F.length(m) + around)), ""), F.length(m) + around)
                return F.struct(F.lit(category).alias("category"), m.alias("match"), i.alias("nth"), F.concat(left, right).alias("context"))

            return F.transform(ms, one)

        found = bound(F.struct(matches.alias("m"), pieces.alias("p")), lambda x: placed(x["m"], x["p"]))
        return F.when(clean.rlike(PATTERNS[category]), F.filter(found, lambda x: ~x["match"].isin(ALLOWED[category])) if category in ALLOWED else found)

    found = [F.coalesce(of(c), F.array().cast("array<struct<category:string,match:string,nth:int,context:string>>")) for c in categories]
    return df.select("*", F.explode(F.concat(*found)).alias("x")).select(*df.columns, "x.*")


#: Stands before a match while its context is cut out.
_CUT = "\u0001"


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("category").agg(F.count("*").alias("n"))


def counts(df: DataFrame, text: str, categories: list[str]) -> DataFrame:
    """``category, n`` of each category, without a row a match: matches are counted in place and summed in each task."""
    def of(category: str) -> Column:
        if category not in ALLOWED:
            return F.regexp_count(text, F.lit(PATTERNS[category]))
        return F.size(F.filter(F.regexp_extract_all(text, F.lit(PATTERNS[category]), 0), lambda m: ~m.isin(ALLOWED[category])))

    sums = df.agg(*[F.coalesce(F.sum(of(c)), F.lit(0)).alias(f"c{i}") for i, c in enumerate(categories)])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"c{i}").cast("long").alias("n")) for i, c in enumerate(categories)])).alias("x")).select("x.*")


def script_variants(df: DataFrame, text: str, variants: DataFrame) -> DataFrame:
    """Characters that are a variant of another by a table (variant, usual): ``ch, usual, n`` and the first row's number.

    The table is a parameter (a converter's character map, a few thousand
    rows); a text's characters meet it by an equi-join after they are counted.
    """
    chars = df.select("loc", F.explode(F.split(text, "")).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"), F.min("loc").alias("first"))
    return chars.join(variants.select(F.col("variant").alias("ch"), "usual"), "ch")


def unbalanced(text: Column) -> Column:
    """The pairs of marks that do not occur equally often, as an array; marks are counted among themselves, in texts that have any."""
    marks = re.escape("".join(PAIRS))

    def wrong(t: Column) -> Column:
        count = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
        return F.filter(F.array(*[F.when(count(a) != count(b), F.lit(a + b)) for a, b in PAIRS]), lambda x: x.isNotNull())

    return F.when(text.rlike(f"[{marks}]"), bound(F.regexp_replace(text, f"[^{marks}]+", ""), wrong)).otherwise(F.array().cast("array<string>"))


def known_wrong(df: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """D3: rows that hold a wrong word of the (broadcast, configured) list; overlapping occurrences count."""
    return df.join(F.broadcast(words), F.col(text).contains(F.col("wrong"))).withColumn("n", F.regexp_count(text, F.concat(F.lit("(?=\\Q"), F.col("wrong"), F.lit("\\E)"))))


def repeated_words(df: DataFrame, text: str) -> DataFrame:
    """D2 for words between spaces: ``doc_id, n``, words equal to the one before."""
    words = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")
    # Bound as a lambda variable: inside a lambda a plain expression would be computed for each element.
    count = lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)) & (F.length(x) >= 2)))
    return df.select("doc_id", F.element_at(F.transform(F.array(words), count), 1).cast("long").alias("n"))
