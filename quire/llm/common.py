"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the word and line contracts name.
WHITE = " \t\n\x0b\x0c\r"
#: The same as a Java regular-expression class.
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
#: Text bytes that a vectorised Python step works on at a time.
CHUNK_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_bpe_path() -> str:
    """The public vocabulary file that the BPE queries use by default."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only where none is set and all runs in one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return sc.getCheckpointDir()


def unused(df: DataFrame, name: str) -> str:
    """``name`` after as many underscores as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in the store that holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder.

    The files go when no frame refers to them any longer, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows in a task of a frame that was counted.
ROWS_A_TASK = 200_000


def narrow(df: DataFrame) -> DataFrame:
    """A frame that is cut, in as many tasks as its rows need: small ones leave few shuffle files."""
    return df.coalesce(max(1, -(-df.count() // ROWS_A_TASK)))


#: Keys that are broadcast at most: 8 bytes each, some 16 MB as a hash table.
BROADCAST_KEYS = 500_000


def rows_of(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is among the distinct ``keys`` (a frame that is cut, of 64-bit numbers).

    The keys are counted: few enough are broadcast, so ``df`` is not shuffled;
    more are joined by a shuffle.
    """
    few = keys.count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, column, "left_semi")


#: Rows that Spark hands to a Python worker at once, where texts are long: some 10 MB here.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bound what a batch of texts takes in the executor and the worker, unless the session says how many rows it has."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Hand memory that was freed to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives its memory back when its task ends.

    Python workers are reused for later tasks, and both Arrow's pool and the C
    library keep what was freed; several such workers and the executor share
    one bound.
    """

    @functools.wraps(run)
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def string_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array and its n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - (offsets[0] if len(offsets) else 0)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (a, b) whose texts hold about ``limit`` bytes; one long text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of ``h``."""
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


@functools.lru_cache(1)
def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of each."""
    out = [np.full(n, base, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
    for x in out:
        x[0] = 1
        np.cumprod(x, out=x)
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``: a polynomial in its bytes, as a difference of running sums moved to the span's own place."""
    powers, back = _powers(1 << len(data).bit_length())
    powers = powers[: len(data) + 1]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def joined_bytes(data: np.ndarray, offsets: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with one byte ``mark`` after each, and where each ends (its mark)."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, mark, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    return out, offsets[1:] + np.arange(n)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true values begin and end."""
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
