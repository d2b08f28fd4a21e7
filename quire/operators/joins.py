"""J: joins of the document model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import bound
from ..lineage import cut


def windows(values: Column, n: int, sep: str) -> Column:
    """All runs of n neighbours in an array of strings, joined; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(values) - (n - 1)))
    return F.when(F.size(values) >= n, F.transform(starts, lambda i: F.array_join(F.slice(values, i, n), sep))).otherwise(F.array().cast("array<string>"))


def check_notes(marks: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """What is wrong between marks (keys, id, href, label) and notes (keys, anchor, back, label).

    ``fault``: missing note, other number, no mark for the back link, orphan,
    duplicate anchor.
    """
    m = marks.select(*keys, F.col("href").alias("anchor"), F.col("id").alias("mark"), F.col("label").alias("m_label"))
    n = notes.select(*keys, "anchor", F.col("back"), F.col("label").alias("n_label"))
    both = m.join(n.withColumn("here", F.lit(True)), [*keys, "anchor"], "full")
    fault = (
        F.when(F.col("mark").isNotNull() & F.col("here").isNull(), "missing note")
        .when(F.col("mark").isNotNull() & (F.col("m_label") != F.col("n_label")), "other number")
        .when(F.col("mark").isNull() & F.col("back").isNotNull(), "no mark for back link")
        .when(F.col("mark").isNull(), "orphan")
    )
    wrong = both.withColumn("fault", fault).filter(F.col("fault").isNotNull()).select(*keys, "anchor", "fault")
    twice = n.groupBy(*keys, "anchor").count().filter("count > 1").select(*keys, "anchor", F.lit("duplicate anchor").alias("fault"))
    return wrong.union(twice)


def resolve_links(links: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """A link's target by its whole key, else by the part before ``#``; external links stand."""
    exact = anchors.select(*keys, F.col("anchor").alias("__a"), F.col("page").alias("__p1"))
    part = anchors.select(*keys, F.col("anchor").alias("__b"), F.col("page").alias("__p2"))
    out = links.withColumn("__a", F.col("href")).withColumn("__b", F.substring_index("href", "#", 1))
    out = out.join(exact, [*keys, "__a"], "left").join(part, [*keys, "__b"], "left")
    how = F.when(F.col("href").rlike("^[a-z]+:"), "external").when(F.col("__p1").isNotNull(), "exact").when(F.col("__p2").isNotNull(), "part").otherwise("missing")
    return out.withColumn("page", F.when(how != "external", F.coalesce("__p1", "__p2"))).withColumn("how", how).drop("__a", "__b", "__p1", "__p2")


def link_numbers(marks: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """Marks to notes by number in a segment; each number links once, at its first mark."""
    w = Window.partitionBy(*keys, "n").orderBy("pos")
    first = marks.withColumn("__k", F.row_number().over(w)).filter("__k = 1").drop("__k")
    return first.join(notes, [*keys, "n"])


def term_occurrences(texts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Every occurrence of terms of one length in words, overlapping ones too: ``doc_id, term, pos``.

    Terms are sequences of words; texts give their word n-grams, so this is an
    equi-join and not a test of each term against each text.
    """
    sizes = [r["n"] for r in terms.select(F.size(F.split("term", " ")).alias("n")).distinct().orderBy("n").collect()]
    out = None
    for n in sizes:
        words = F.split(F.trim(F.regexp_replace(text, "[ \\t\\n]+", " ")), " ")
        grams = texts.select("doc_id", F.posexplode(bound(words, lambda w: windows(w, n, " "))).alias("pos", "term"))
        found = grams.join(terms.select("term").distinct(), "term")
        out = found if out is None else out.union(found)
    return out if out is not None else texts.select("doc_id").limit(0).select("doc_id", F.lit(0).alias("pos"), F.lit("").alias("term"))


#: White space that pieces leave out; the bits of a filter of wanted pieces; characters that a task looks at together.
_SPACES = " \t\n\x0b\f\r\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_BITS, _TOGETHER = 24, 1 << 20
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SOLID = np.ones(0x3002, bool)
_SOLID[[ord(c) for c in _SPACES]] = False


def missing_pieces(items: DataFrame, corpus: DataFrame, size: int = 12, share: float = 0.6) -> DataFrame:
    """``item_id, pieces, absent, flagged``: items most of whose pieces the corpus lacks.

    Pieces are cut every ``size`` characters of the item without white space.
    The corpus is the concatenation of its texts in order of doc_id without
    white space, and pieces may cross its texts: the last ``size - 1``
    characters of each text and as many of what comes next are looked at, too.

    Texts are read once.  A rolling hash of each place meets a filter of 2 ** 24
    bits, which the wanted pieces set; only what passes it becomes a row and is compared.
    """
    item = items.select("item_id", F.regexp_replace("text", f"[{_SPACES}]+", "").alias("t")).filter(F.length("t") >= size)
    starts = F.sequence(F.lit(1), F.length("t") - (size - 1), F.lit(size))
    pieces = cut(item.select("item_id", F.explode_outer(F.transform(starts, lambda i: F.substr("t", i, F.lit(size)))).alias("piece")))
    wanted = pieces.select("piece").distinct()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chars = _codes("".join(batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(_cells(_hashes(chars, size)[::size]).astype(np.int64) + 1)], ["cell"])

    by_bucket = wanted.mapInArrow(cells, "cell long").groupBy(F.bitmap_bucket_number("cell").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    held = {r["k"]: bytes(r["bits"]) for r in by_bucket.collect()}  # 512 rows of 4 kB at most
    bits = b"".join(held.get(k + 1, bytes(4096)) for k in range((1 << _BITS) // 32768))
    schema = T.StructType([T.StructField("doc_id", corpus.schema["doc_id"].dataType), *(T.StructField(c, T.StringType()) for c in ("head", "tail", "piece"))])
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            texts = batch.column(1)
            lengths = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + _TOGETHER, "right")))
                yield _scanned(batch.column(0)[at:end], texts[at:end], asked, size, arrow)
                at = end

    seen = cut(corpus.select("doc_id", "text").filter("text IS NOT NULL").mapInArrow(scan, schema))
    docs = seen.filter("doc_id IS NOT NULL")
    across = docs.join(_following(docs.select("doc_id", "head"), size - 1), "doc_id").select("doc_id", F.concat("tail", F.coalesce("after", F.lit(""))).alias("text"))
    found = seen.select("piece").union(across.mapInArrow(scan, schema).select("piece")).filter("piece IS NOT NULL")
    have = found.join(wanted, "piece", "left_semi").distinct()
    judged = pieces.join(have.withColumn("here", F.lit(1)), "piece", "left")
    out = judged.groupBy("item_id").agg(F.count("*").alias("pieces"), F.sum(F.col("here").isNull().cast("long")).alias("absent"))
    return out.withColumn("flagged", F.col("absent") > share * F.col("pieces"))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _hashes(chars: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` characters at each place."""
    n = max(0, len(chars) - size + 1)
    wide, out = chars.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(size):
        out *= _FACTOR
        out += wide[k : k + n]
    return out


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))) * _MIX >> np.uint64(64 - _BITS)


def _scanned(ids: pa.Array, texts: pa.Array, asked: np.ndarray, size: int, schema: pa.Schema) -> pa.RecordBatch:
    """A row for each text that is not all white space, with its first and last characters, and one for each different piece that may be wanted."""
    listed = texts.to_pylist()
    chars = _codes("".join(listed))
    solid = _SOLID[np.minimum(chars, len(_SOLID) - 1)]
    upto = np.concatenate([[0], np.cumsum(solid)])[np.cumsum([0, *map(len, listed)])]
    chars = chars[solid]
    text_of = lambda a, b: chars[a:b].tobytes().decode("utf-32-le")
    hashes = _hashes(chars, size)
    hits = np.flatnonzero(asked[_cells(hashes)])
    hits = hits[hits + size <= upto[np.searchsorted(upto, hits, "right")]]
    hits = hits[np.unique(hashes[hits], return_index=True)[1]]
    full = np.flatnonzero(np.diff(upto))
    heads = [text_of(upto[k], min(upto[k] + size - 1, upto[k + 1])) for k in full]
    tails = [text_of(max(upto[k + 1] - size + 1, upto[k]), upto[k + 1]) for k in full]
    none, found = [None] * len(hits), [text_of(i, i + size) for i in hits]
    columns = [pa.concat_arrays([ids.take(pa.array(full)), pa.nulls(len(hits), ids.type)]), [*heads, *none], [*tails, *none], [None] * len(full) + found]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], names=schema.names)


def _following(heads: DataFrame, size: int) -> DataFrame:
    """The first ``size`` characters that follow each text in order of doc_id.

    The order is cut into ranges of ids; windows run within a range, and a
    range's last texts take the heads of the next one's.
    """
    spread = heads.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).first()
    width = max(1, (spread["b"] - spread["a"] + 1) // max(1, spread["n"] // 50_000)) if spread["n"] else 1
    ranged = heads.withColumn("r", F.floor(F.col("doc_id") / width))
    lead = lambda w: F.concat(*[F.coalesce(F.lead("head", k).over(w), F.lit("")) for k in range(1, size + 1)])
    own = ranged.withColumn("after", lead(Window.partitionBy("r").orderBy("doc_id")))
    # A range's first texts, as many as can be needed, stand for its beginning.
    nth = F.row_number().over(Window.partitionBy("r").orderBy("doc_id"))
    first = ranged.withColumn("k", nth).filter(F.col("k") <= size).groupBy("r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "head"))), lambda x: x["head"]), "").alias("begin"))
    order = Window.orderBy("r")  # a row a range: 50,000 texts each
    after = first.withColumn("next", F.concat(*[F.coalesce(F.lead("begin", k).over(order), F.lit("")) for k in range(1, size + 1)])).select("r", "next")
    return own.join(after, "r").select("doc_id", F.substr(F.concat("after", "next"), F.lit(1), F.lit(size)).alias("after"))


def locate(asked: DataFrame, starts: DataFrame, keys: list[str], off: str) -> DataFrame:
    """The block with the greatest start up to each offset: an as-of join.

    Starts and offsets are sorted together and the last start is carried on,
    so a document costs its rows and not their product.
    """
    s = starts.select(*keys, F.col("start_off").alias("__at"), F.lit(0).alias("__kind"), "bi")
    a = asked.select(*keys, F.col(off).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("int").alias("bi"))
    w = Window.partitionBy(*keys).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = s.union(a).withColumn("bi", F.last("bi", ignorenulls=True).over(w))
    return both.filter("__kind = 1").select(*keys, F.col("__at").alias(off), "bi")


def nearest_candidate(refs: DataFrame, candidates: DataFrame, keys: list[str], most: float = 0.75) -> DataFrame:
    """For each ref (keys, ref, low, high) the candidate (keys, ref, key_no, occ, page) nearest to [low, high + 1]."""
    both = refs.join(candidates, [*keys, "ref"])
    far = F.greatest(F.lit(0.0), F.col("low") - F.col("page"), F.col("page") - (F.col("high") + 1))
    w = Window.partitionBy(*keys, "ref").orderBy("key_no", "far", "occ")
    return both.withColumn("far", far).filter(F.col("far") <= most).withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")


def rarest_candidate(refs: DataFrame, candidates: DataFrame, keys: list[str], most: float = 0.75, first: int = 3) -> DataFrame:
    """As ``nearest_candidate``, by the ``first`` keys with the fewest occurrences, the rarest first."""
    own = Window.partitionBy(*keys, "ref")
    held = candidates.withColumn("__n", F.count("*").over(Window.partitionBy(*keys, "ref", "key_no")))
    ranked = held.withColumn("rarity", F.dense_rank().over(own.orderBy("__n", "key_no"))).filter(F.col("rarity") <= first)
    named = ranked.withColumnRenamed("key_no", "__key").withColumnRenamed("rarity", "key_no")
    return nearest_candidate(refs, named, keys, most).drop("key_no", "__n").withColumnRenamed("__key", "key_no")


def in_stretch(refs: DataFrame, terms: DataFrame, keys: list[str], beyond: int = 500) -> DataFrame:
    """A term within [a, b) first, by order of keys; else the nearest within ``beyond`` for the first two keys; else a."""
    both = refs.join(terms, [*keys, "ref"], "left")
    inside = (F.col("off") >= F.col("a")) & (F.col("off") < F.col("b"))
    far = F.when(F.col("off") < F.col("a"), F.col("a") - F.col("off")).otherwise(F.col("off") - F.col("b") + 1)
    near = ~inside & (far <= beyond) & (F.col("key_no") <= 2)
    rank = F.when(inside, 0).when(near, 1).otherwise(2)
    by = F.struct(rank.alias("rank"), F.when(inside, F.col("key_no")).alias("key"), F.when(near, far).alias("far"), F.col("off").alias("off"))
    best = both.groupBy(*keys, "ref", "a", "b").agg(F.min(by).alias("x"))
    return best.select(*keys, "ref", F.when(F.col("x.rank") < 2, F.col("x.off")).otherwise(F.col("a")).alias("off"), F.get(F.lit(["term", "near", "start"]), F.col("x.rank")).alias("how"))


def span_overlaps(spans: DataFrame, height: float = 1.0, least: float = 1.5) -> DataFrame:
    """Spans of a page on one baseline that overlap: a self-join on page and y-bucket, the bucket and the next."""
    s = spans.withColumn("bucket", F.floor(F.col("y") / height))
    left = s.select("page", F.col("id").alias("a"), F.col("y").alias("ya"), F.col("x0").alias("a0"), F.col("x1").alias("a1"), F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket"))
    right = s.select("page", F.col("id").alias("b"), F.col("y").alias("yb"), F.col("x0").alias("b0"), F.col("x1").alias("b1"), "bucket")
    both = left.join(right, ["page", "bucket"]).filter((F.col("a") < F.col("b")) & (F.abs(F.col("ya") - F.col("yb")) <= height))
    common = F.least("a1", "b1") - F.greatest("a0", "b0")
    return both.withColumn("common", common).filter(F.col("common") > least).select("page", "a", "b", "common")


def compare_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    """Pages of two prints (page, line_no, text) whose lines differ."""
    lines = lambda df, name: df.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", F.regexp_replace("text", "⁠", "").alias("t")))), lambda x: x["t"]).alias(name))
    both = lines(old, "a").join(lines(new, "b"), "page", "full")
    how = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").when(F.col("a") != F.col("b"), "changed").otherwise("same")
    return both.select("page", how.alias("how"))


def page_bases(books: DataFrame, group: list[str], order: str) -> DataFrame:
    """The first page of each book of a collection, less one."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return books.withColumn("base", F.coalesce(F.sum("npages").over(w), F.lit(0)).cast("long"))


def uncovered(used: DataFrame, glyphs: DataFrame, order: Column | None = None) -> DataFrame:
    """Used code points (cp) without a glyph in the first face, and whether a fallback has one."""
    first = glyphs.filter("face = 0").select("cp")
    rest = glyphs.filter("face > 0").groupBy("cp").agg(F.min("face").alias("fallback"))
    return used.join(first, "cp", "left_anti").join(rest, "cp", "left")
