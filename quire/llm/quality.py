"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CLASS

#: A rule rejects a document where its condition holds.  All numbers are parameters of the method.
SYMBOLS_PER_100_WORDS = 10
DUPLICATE_LINES_PERCENT = 30
MEAN_WORD_CHARS = (2, 15)
SHOUTED_PERCENT = 50
UNLETTERED_WORDS_PERCENT = 40
EXCLAIMED_PERCENT = 30
#: Evaluations of a rule for each row of the sample, to measure its cost, and how often that is timed.
REPEATS, TIMED = 2, 2


def with_measures(docs: DataFrame, window: int = 5) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, __lines, __words``.

    ``n_repeat_words`` hashes each word and each window of words to 64 bits.
    Only a text whose windows are not all distinct sorts them to find the
    repeated ones, and sums the places these cover.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, WHITE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("__words")

    def covered(x: Column) -> Column:
        """Words under the windows that occur twice or more; x: the windows' hashes."""
        ordered = F.sort_array(F.transform(x, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def counted(s: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
            places = F.sort_array(F.transform(twice, lambda i: F.get(s, i)["i"]))
            start = F.struct(F.lit(0).alias("words"), F.lit(-window).alias("last"))
            step = lambda a, p: F.struct((a["words"] + F.least(F.lit(window), p - a["last"])).alias("words"), p.alias("last"))
            return F.aggregate(places, start, step, lambda a: a["words"])

        return F.element_at(F.transform(F.array(ordered), counted), 1)

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    def repeated(x: Column) -> Column:
        return F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(0)

    hashes = F.transform(F.col("__words"), lambda w: F.xxhash64(w))
    # A one-element array binds a value, so that it is computed once and not for each element.
    by_window = F.element_at(F.transform(F.transform(F.array(hashes), windows), repeated), 1)
    measured = docs.withColumn("__words", words).withColumn("__lines", lines)
    return measured.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.regexp_replace(text, WHITE_CLASS + "+", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.when(n > window, by_window).otherwise(0).cast("long"),
    })


def rules() -> dict[str, Column]:
    """Conditions, over the measures and the words and lines, under which a document is rejected."""
    words, chars = F.col("n_words"), F.col("word_chars")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    share = lambda found, percent: F.size(F.filter("__words", found)) * 100 > words * percent
    return {
        "symbols": F.col("n_symbols") * 100 > words * SYMBOLS_PER_100_WORDS,
        "duplicate_lines": F.col("n_dup_lines") * 100 > F.size("__lines") * DUPLICATE_LINES_PERCENT,
        "word_length": (chars < words * MEAN_WORD_CHARS[0]) | (chars > words * MEAN_WORD_CHARS[1]),
        "shouted": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) * 100 > F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) * SHOUTED_PERCENT,
        "unlettered": share(lambda w: ~w.rlike(r"\p{L}"), UNLETTERED_WORDS_PERCENT),
        "exclaimed": share(lambda w: w.endswith("!!"), EXCLAIMED_PERCENT),
    }


def _base() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def plan_cascade(docs: DataFrame, sample_rows: int = 1000) -> list[str]:
    """Rule names by rejections per second, measured on a sample of about ``sample_rows`` documents.

    The sample is kept with its measures, as the query has them anyway.  One
    job gives the verdicts of all rules on what passes the base; a rule's cost
    is the time of its evaluation alone, ``REPEATS`` times over each row, less
    that of a rule that does nothing.  Greedy order: at each place the rule
    with the most rejections per second among the documents that the rules
    before it leave; rules that reject no more of them come by cost.  The
    sample only sets the order; the verdict is the same in any order.
    """
    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(1, total)), seed=11) if total > sample_rows else docs.select("text")
    measured = with_measures(sample).filter(~_base()).persist()  # the rate bounds it
    try:
        by_name = rules()
        names = list(by_name)
        bits = sum((F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(by_name.values())), F.lit(0))
        verdicts = {r["bits"]: r["count"] for r in measured.groupBy(bits.alias("bits")).count().collect()}  # at most 2 ** rules rows
        n = max(1, sum(verdicts.values()))
        often = measured.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

        def seconds(rule: Column) -> float:
            taken = []
            for _ in range(TIMED):
                began = time.perf_counter()
                often.agg(F.sum(F.when(rule & (F.col("turn") > 0), 1).otherwise(0))).collect()
                taken.append(time.perf_counter() - began)
            return min(taken)

        nothing = seconds(F.col("turn") < 0)
        cost = {name: max(seconds(rule) - nothing, 1e-6) / (n * REPEATS) for name, rule in by_name.items()}
        order = []
        while len(order) < len(names):
            rejected = {x: sum(c for v, c in verdicts.items() if v >> names.index(x) & 1) for x in names if x not in order}
            order.append(min(rejected, key=lambda x: (-rejected[x] / cost[x], cost[x], x)))
            verdicts = {v: c for v, c in verdicts.items() if not v >> names.index(order[-1]) & 1}
        return order
    finally:
        measured.unpersist()


def quality_rules(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of each document.

    ``base_failed``: fewer than 10 words, or over 20 % of them in repeated
    windows.  Others go through the cascade: a CASE whose first true rule
    rejects, so later rules are not evaluated.  Defined cases: null, empty or
    blank text has no words and fails the base; a null doc_id is kept; repeated
    rows each give a row; no rows give no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    order = plan_cascade(docs) if order is None else order
    by_name = rules()
    verdict = F.when(F.col("base_failed"), False)
    for name in order:
        verdict = verdict.when(by_name[name], False)
    out = with_measures(docs).withColumn("base_failed", _base()).withColumn("kept", verdict.otherwise(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
