"""Line deduplication: explode, hash, count documents, drop, reassemble by position."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut, released, small_batches, string_arrays, unused

_WHITE = WHITE.encode()


def _line_rows(least: int):
    """Rows (doc_id, th, pos, h1, h2) of the lines whose key has ``least`` code points."""

    def run(batches):
        for batch in batches:
            data, offsets = string_arrays(batch.column("text"))
            raw = data.tobytes()
            ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            docs, texts, places, digests = [], [], [], []
            for k in range(len(ids)):
                for pos, line in enumerate(raw[offsets[k] : offsets[k + 1]].split(b"\n")):
                    key = line.strip(_WHITE).lower()
                    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
                        continue
                    docs.append(ids[k])
                    texts.append(ths[k])
                    places.append(pos)
                    digests.append(xxhash.xxh3_128_digest(key))
                if len(docs) > 100_000:
                    yield _rows(docs, texts, places, digests)
                    docs, texts, places, digests = [], [], [], []
            if docs:
                yield _rows(docs, texts, places, digests)

    return run


def _rows(docs, texts, places, digests) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(texts, pa.int64()), pa.array(places, pa.int32()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
        ["doc_id", "th", "pos", "h1", "h2"],
    )


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """Drop the lines found in ``least_docs`` documents or more, but for one document's.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in
    lower case; a 128-bit hash stands for it.  A key of at least ``least_chars``
    code points found in at least ``least_docs`` distinct doc_ids keeps its lines
    only in the largest doc_id that holds it.

    Returns the rows and columns of ``docs`` with ``text`` replaced by the lines
    that stay, joined by ``\\n``, and two more columns, ``n_lines`` and
    ``n_dropped`` (clashing names in ``docs`` are replaced).  Defined cases: null
    or empty text is one empty line and becomes ''; a document that loses all
    its lines stays, with ''; rows that repeat a doc_id count as one document
    and each give a row; a null doc_id is kept and its lines neither count nor
    go; no rows give no rows.

    Lines are counted over distinct (key, doc_id), so a key that most documents
    hold is summed before its shuffle; the join back is left to AQE to split.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    th, parts, gone, doc, at = (unused(docs, x) for x in ("th", "lines", "gone", "doc", "at"))
    keyed = docs.withColumn(th, F.xxhash64("text"))
    texts = keyed.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(th).alias("th"), F.col("text").cast("string").alias("text"))
    lines = texts.mapInArrow(released(_line_rows(least_chars)), "doc_id long, th long, pos int, h1 long, h2 long")
    found = lines.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
    often = cut(found.filter(F.col("n") >= least_docs).select("h1", "h2", "keep"))
    drops = lines.join(often, ["h1", "h2"]).filter("doc_id <> keep").groupBy(F.col("doc_id").alias(doc), F.col("th").alias(at)).agg(F.collect_set("pos").alias(gone))
    split = keyed.select(*[c for c in keyed.columns if c != "text"], F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n").alias(parts))
    joined = split.join(drops, (F.col("doc_id") == F.col(doc)) & (F.col(th) == F.col(at)), "left")
    n = F.size(parts)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col(gone)), lambda i: F.get(F.col(parts), i))
    text = F.when(F.col(gone).isNull(), F.array_join(parts, "\n")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*columns, n.cast("long").alias("n_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"))
