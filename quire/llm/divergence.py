"""Source divergence audit: how far each source's use of words is from the other sources of its language."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, cut, joined_bytes, mixed, released, small_batches, span_hashes, spans, string_arrays

#: Bytes of a term: small letters, and those of every character outside ASCII; and the byte with A-Z lower-cased.
_TERM, _LOWER = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_TERM[97:123] = _TERM[128:] = True
_LOWER[65:91] += 32
#: Ways that the vocabulary of a language is dealt in, where its groups meet it.
SALTS = 64
#: Counts that a task holds before it hands them on.
HELD_COUNTS = 2_000_000
_TEXT, _LANG, _SOURCE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class _Held:
    """Counts by language, source and term of a task's texts; a 64-bit hash stands for a term."""

    def __init__(self):
        self.codes: dict[str, int] = defaultdict(lambda: len(self.codes))
        self.names: dict[int, bytes] = {}
        self.rows: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, sources: np.ndarray) -> None:
        marked, text_ends = joined_bytes(data, offsets, 0)
        lowered = _LOWER[marked]
        starts, ends = spans(_TERM[lowered])
        if not len(starts):
            return
        term, text = span_hashes(lowered, starts, ends), np.searchsorted(text_ends, starts, side="right")
        _, first, n = np.unique(mixed(term + text.astype(np.uint64) * _TEXT), return_index=True, return_counts=True)
        row = _summed([term[first], langs[text[first]], sources[text[first]], n, np.ones(len(n), np.int64), first])
        raw, names = lowered.tobytes(), self.names
        for h, a, b in zip(row[0].tolist(), starts[row[5]].tolist(), ends[row[5]].tolist()):
            if h not in names:
                names[h] = raw[a:b]
        self.rows.append(row[:5])
        self.size += len(row[0])

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        """A row for each language and term: its documents, and its occurrences in each source."""
        if not self.rows:
            return
        term, lang, source, n, d = _summed([np.concatenate(x) for x in zip(*self.rows)])
        order = np.argsort(mixed(term + lang * _LANG), kind="stable")
        term, lang, source, n, d = (x[order] for x in (term, lang, source, n, d))
        begins = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])]))
        known = pa.array(list(self.codes), pa.string())
        named = lambda codes: known.take(pa.array(codes.astype(np.int64)))
        parts = pa.StructArray.from_arrays([named(source), pa.array(n)], ["source", "n"])
        offsets = pa.array(np.append(begins, len(n)).astype(np.int32))
        terms = pa.array([self.names[h] for h in term[begins].tolist()], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([named(lang[begins]), terms, pa.array(np.add.reduceat(d, begins)), pa.ListArray.from_arrays(offsets, parts)], ["lang", "term", "in_docs", "parts"])
        self.__init__()


def _summed(row: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (term, language, source, occurrences, documents, ...) with one for each of the first three; of the rest the first stays."""
    key = mixed(row[0] + row[1] * _LANG + row[2] * _SOURCE)
    order = np.argsort(key, kind="stable")
    begins = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    first = order[begins]
    sums = [np.add.reduceat(x[order], begins) for x in row[3:5]]
    return [*(x[first] for x in row[:3]), *sums, *(x[first] for x in row[5:])]


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of a task's texts, counted."""
    held = _Held()
    for batch in batches:
        data, offsets = string_arrays(batch.column("text"))
        langs, sources = (np.array([held.codes[x] for x in batch.column(c).to_pylist()], np.uint64) for c in ("lang", "source"))
        for a, b in chunks(offsets):
            held.add(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], langs[a:b], sources[a:b])
        if held.size > HELD_COUNTS:
            yield from held.handed_on()
    yield from held.handed_on()


def kept_counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """``lang, source, term, n`` of the terms in ``least_docs`` documents (rows) of their language.

    Tasks hand on a row for each language and term with its counts by source;
    one shuffle by language and term serves both the documents and the counts.
    """
    rows = docs.mapInArrow(released(_task_counts), "lang string, term string, in_docs long, parts array<struct<source:string,n:long>>")
    often = rows.withColumn("in_docs", F.sum("in_docs").over(Window.partitionBy("lang", "term"))).filter(F.col("in_docs") >= least_docs)
    return often.select("lang", "term", F.inline("parts")).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))


def _scaled(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10 ** 9 * (n + 2) / (total + 2 * v)), in decimals of 38 digits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(n + 2) * F.lit(1_000_000_000).cast("decimal(10,0)"), wide(total + 2 * v)) + F.lit(1).cast("long")


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame, least_docs: int = 10, most_terms: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by distance, and the terms a source has more of than its language.

    Terms are runs of letters with A-Z lower-cased; a language keeps those in
    ``least_docs`` of its documents.  Every group (lang, source) and every
    language gives each kept term a scaled, smoothed share p.  Part ``pair``:
    for each group, each other source of its language, with the sum over the
    kept terms of ``floor((p - q)^2 / (p + q))``.  Part ``term``: the
    ``most_terms`` first kept terms whose share in the group is above that in
    the language.  Ties go to the smaller item.

    Defined cases: null text, lang or source is ''; each row is a document of
    its own, also where a doc_id repeats; a group without terms has its pairs,
    and with no kept term at all their value is 0; a lone source has no pairs;
    no rows give no rows; other columns are ignored.

    Matches are counted in the task that finds them, where a 64-bit hash stands
    for a term; the shuffle carries these counts, with the terms themselves.  The groups meet
    the vocabulary of their language in ``SALTS`` parts, so one language that
    holds most documents is spread; the pairs are summed on the map side.
    """
    small_batches(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    counts = cut(kept_counts(docs, least_docs))
    groups = cut(docs.select("lang", "source").distinct())

    vocabulary = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    of_lang = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    of_group = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").fillna(0, ["total"]).join(of_lang, "lang")

    part = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    dealt = of_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dense = dealt.join(vocabulary.withColumn("salt", part), ["lang", "salt"]).join(counts, ["lang", "source", "term"], "left").fillna(0, ["n"])
    shares = cut(dense.select("lang", "source", "term", "n", _scaled(F.col("n"), F.col("total"), F.col("v")).alias("p"), _scaled(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")))

    one, other = shares.select("lang", "term", "source", "p"), shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"))
    sums = one.join(other, ["lang", "term"]).filter("source < item").groupBy("lang", "source", "item").agg(F.sum(_distance(F.col("p"), F.col("r"))).alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").filter("source <> item").join(both, ["lang", "source", "item"], "left").fillna(0, ["value"])

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.filter("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    ranked = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(above, "term").filter(F.col("rank") <= most_terms))
