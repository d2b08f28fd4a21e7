"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

The n-grams of all documents share one order, rare ones first: by the number of
texts that hold them, ties by hash.  Hash ranges cut it into fragments, which
are worked on one by one and meet only in sums.

1. Every text is hashed once.  Exact copies of a set are one class, which has a
   64-bit key; each task sends a class at most once for each chunk it reads.
2. The first fragments, a share of the hash space, count in how many classes
   each n-gram is.  A set that links has at most ``n (q - p) / q`` n-grams that
   no other set has (threshold p / q), so a class with more of them in these
   fragments alone goes no further.
3. The sets of the classes left are dealt over fragments, counted again, and
   sent back with the counts.  A class whose shared n-grams are too few goes.
   The rest have all of their shared n-grams and the places of these in the order.
4. Two sets that link share an n-gram among the first ``n - ceil(n p / q) + 1``
   of each (its prefix), and the first shared one stands early enough in both to
   leave room for the overlap.  Inverted lists of prefixes give the candidates.
   Each list's members meet a hub first, the one with the fewest n-grams that
   are rarer than the list's: it has the fewest of its own, so in a group of
   near copies it is nearest to what they were copied from.  Pairs that are
   connected already need no test; what is left between components is paired
   in blocks of a list, if the sets' bitmaps allow it: a bit that differs, and
   an n-gram that no other set has, is a difference each.
5. For candidates, the overlap is counted in each fragment and summed per pair.

N-grams that very many classes hold (at most 2^20 of them, a bound that follows
from the counts) are known to all tasks and stand last in the order, so no
fragment has a list longer than about four millionths of all n-grams.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import chunks, cut, narrow, released, rows_of, small_batches, string_arrays
from .graph import components

#: N-grams that a task holds at a time.
CHUNK = 1_000_000
#: An n-gram is reported as frequent by a chunk in which so many classes hold it.
REPORTED = 4
#: N-grams of the frequent table at most; one is frequent from this part of all n-grams on, and from so many classes on.
FREQUENT, LEAST_FREQUENT = 1 << 20, 64
#: N-grams in a fragment, and fragments at least.
FRAGMENT, LEAST_FRAGMENTS = 1 << 19, 64
#: The first fragments hold this multiple of the share of n-grams in which two sets that link may differ.
FIRST = 1.5
#: Fragments in which the overlaps of candidates are counted.
COUNTING_FRAGMENTS = 8
#: Bits of a set's bitmap: the parity of its n-grams in each of as many classes.
BITS = 1024
#: Star rounds at least and at most before all remaining cross-component pairs are compared.
LEAST_ROUNDS, ROUNDS = 1, 4
#: Pairs are compared in full once there are no more than so many for each row of a list.
PAIRS_A_ROW = 100
#: Members of a list that are paired in one block.
BLOCK = 256

_MEASURED = "frequent boolean, doc_id long, v long, n_shingles long, f1 long, f2 long, first binary"
_DEALT = "key long, v binary, n binary, size binary, items binary"
_COUNTED = "key long, info boolean, v binary, n binary, size binary, items binary, df binary"
_SETS = "v long, n long, f int, items array<long>, prefix array<struct<gram: long, at: long>>, lone long, bits array<long>"


def _sets(batch: pa.RecordBatch, n: int):
    data, offsets = string_arrays(batch.column("text"))
    for a, b in chunks(offsets):
        yield from shingles.shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)


def _fingerprint(x: np.ndarray, salt: int) -> tuple[int, int, int]:
    """A 128-bit fingerprint of a set, and the 64-bit key of its class."""
    if not len(x):
        return 0, 0, 0
    both = np.array([np.add.reduce(shingles.mix(x ^ np.uint64(0x2545F4914F6CDD1D))), np.add.reduce(shingles.mix(x + np.uint64(0x9E6C63D0876A9A47)))])
    key = shingles.mix(both[:1] + shingles.mix(both[1:] + np.uint64(2 * salt + 1)) + np.uint64(len(x)))
    one, two = both.view(np.int64)
    return int(one), int(two), int(key.view(np.int64)[0])


def _measured(n: int, limit: int, salt: int):
    """A row a document, with the n-grams of the first fragments; and a row for each n-gram a chunk reports."""

    def reported(held: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        at = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, int)
        counts = np.diff(np.append(at, len(grams)))
        many = counts >= REPORTED
        m = int(many.sum())
        none = pa.nulls(m, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(m, bool)), none, pa.array(grams[at][many].view(np.int64)), pa.array(counts[many]), none, none, pa.nulls(m, pa.binary())], ["frequent", "doc_id", "v", "n_shingles", "f1", "f2", "first"])

    def run(batches):
        held, seen, total = [], set(), 0
        for batch in batches:
            size, one, two, key, first = [], [], [], [], []
            for x in _sets(batch, n):
                a, b, v = _fingerprint(x, salt)
                size.append(len(x))
                one.append(a)
                two.append(b)
                key.append(v)
                first.append(x[: np.searchsorted(x, np.uint64(limit), side="right")].tobytes())
                if v not in seen:
                    seen.add(v)
                    held.append(x)
                    total += len(x)
                if total >= CHUNK:
                    yield reported(held)
                    held, seen, total = [], set(), 0
            columns = [pa.array(np.zeros(len(size), bool)), batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (key, size, one, two)), pa.array(first, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["frequent", "doc_id", "v", "n_shingles", "f1", "f2", "first"])
        yield reported(held)

    return run


def _binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of an array as binary values."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(table: pa.Table, name: str, kind=np.int64) -> np.ndarray:
    """All binary values of a column, one after another."""
    return np.frombuffer(b"".join(x.as_py() or b"" for x in table.column(name)), kind)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal neighbours."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return at, np.diff(np.append(at, len(keys)))


def _place(keys: np.ndarray, parts: int, limit: int = 2**64 - 1) -> np.ndarray:
    """The part of ``[0, limit]`` that each unsigned key is in."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) // np.uint64((limit >> 32) + 1)


def _dealt(grams: np.ndarray, sizes: np.ndarray, v: np.ndarray, parts: int, limit: int) -> pa.RecordBatch:
    """A row a fragment: the classes in it, how many n-grams each has there, and these."""
    f = _place(grams, parts, limit)
    if parts <= 1 << 16:
        f = f.astype(np.uint16)  # sorted by radix
    order = np.argsort(f, kind="stable")
    f, grams, owner = f[order].astype(np.int64), grams[order], np.repeat(np.arange(len(sizes)), sizes)[order]
    at, runs = _runs(f * len(sizes) + owner)
    rows, many = _runs(f[at])
    names = [pa.array(f[at][rows]), _binaries(v[owner[at]], many), pa.nulls(len(rows), pa.binary()), _binaries(runs.astype(np.int32), many), _binaries(grams.view(np.int64), np.add.reduceat(runs, rows) if len(rows) else rows)]
    return pa.RecordBatch.from_arrays(names, ["key", "v", "n", "size", "items"])


def _split_hot(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(grams), bool)
    return hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams


def _first_fragments(parts: int, limit: int, frequent):
    """Rows ``(v, first)`` -> fragments, without the frequent n-grams; a class once for each task."""

    def made(v, first):
        hot, sizes = frequent.value[0], np.array([len(x) // 8 for x in first], np.int64)
        grams = np.frombuffer(b"".join(first), np.uint64)
        rare = ~_split_hot(grams, hot)
        owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
        return _dealt(grams[rare], np.bincount(owner, minlength=len(sizes)), np.array(v, np.int64), parts, limit)

    def run(batches):
        v, first, seen, total = [], [], set(), 0
        for batch in batches:
            for key, x in zip(batch.column("v").to_pylist(), batch.column("first").to_pylist()):
                if key not in seen:
                    seen.add(key)
                    v.append(key)
                    first.append(x)
                    total += len(x) // 8
                if total >= CHUNK:
                    yield made(v, first)
                    v, first, total = [], [], 0
        if v:
            yield made(v, first)

    return run


def _lone(parts: int):
    """A fragment -> for each class the n-grams that no other class has; a row a part of the class keys."""

    def run(table: pa.Table) -> pa.Table:
        grams, own = _values(table, "items", np.uint64), np.repeat(_values(table, "v"), _values(table, "size", np.int32))
        order = np.argsort(grams)
        at, _ = _runs(grams[order])
        own = own[order]
        alone = np.minimum.reduceat(own, at) == np.maximum.reduceat(own, at) if len(at) else np.zeros(0, bool)
        v, counts = np.unique(own[at][alone].view(np.uint64), return_counts=True)
        key = _place(v, parts).astype(np.int64)
        rows, many = _runs(key)
        return pa.table({"key": pa.array(key[rows]), "v": _binaries(v.view(np.int64), many), "size": _binaries(counts.astype(np.int32), many)})

    return run


def _lone_sums(table: pa.Table) -> pa.Table:
    v, at = np.unique(_values(table, "v"), return_inverse=True)
    return pa.table({"v": pa.array(v), "lone": pa.array(np.bincount(at, _values(table, "size", np.int32), len(v)).astype(np.int64))})


def _all_fragments(n: int, salt: int, parts: int, frequent):
    """Texts -> fragments, and, under keys below 0, the classes' sizes and frequent n-grams."""

    def made(v, sets):
        hot = frequent.value[0]
        sizes, grams, v = np.array([len(x) for x in sets], np.int64), np.concatenate(sets), np.array(v, np.int64)
        often, owner = _split_hot(grams, hot), np.repeat(np.arange(len(sizes)), sizes)
        yield _dealt(grams[~often], np.bincount(owner[~often], minlength=len(sizes)), v, parts, 2**64 - 1)
        order = np.argsort(v.view(np.uint64), kind="stable")
        held = np.bincount(owner[often], minlength=len(sizes))
        ends = np.concatenate([[0], np.cumsum(held)])
        frequent_of = grams[often]
        key = _place(v.view(np.uint64)[order], parts).astype(np.int64)
        rows, many = _runs(key)
        items = np.concatenate([frequent_of[ends[i] : ends[i + 1]] for i in order])
        sums = np.add.reduceat(held[order], rows)
        columns = [pa.array(-1 - key[rows]), _binaries(v[order], many), _binaries(sizes[order], many), _binaries(held[order].astype(np.int32), many), _binaries(items.view(np.int64), sums)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "v", "n", "size", "items"])

    def run(batches):
        v, sets, seen, total = [], [], set(), 0
        for batch in batches:
            for x in _sets(batch, n):
                key = _fingerprint(x, salt)[2]
                if len(x) and key not in seen:
                    seen.add(key)
                    v.append(key)
                    sets.append(x)
                    total += len(x)
                if total >= CHUNK:
                    yield from made(v, sets)
                    v, sets, total = [], [], 0
        if v:
            yield from made(v, sets)

    return run


def _counted(parts: int):
    """A fragment -> the n-grams that two classes or more have, with their counts; a row a part of the class keys."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _COUNTED.split(", ")]
        if key[0].as_py() < 0:
            rows = table.num_rows
            return pa.table([pa.array(np.full(rows, -1 - key[0].as_py())), pa.array(np.ones(rows, bool)), *(table.column(x) for x in ("v", "n", "size", "items")), pa.nulls(rows, pa.binary())], names)
        grams, own = _values(table, "items", np.uint64), np.repeat(_values(table, "v"), _values(table, "size", np.int32))
        order = np.argsort(grams, kind="stable")
        at, length = _runs(grams[order])
        order = order[np.repeat(length > 1, length)]
        order = order[np.lexsort((own[order], grams[order]))]
        grams, own = grams[order], own[order]
        fresh = np.concatenate([[True], (grams[1:] != grams[:-1]) | (own[1:] != own[:-1])]) if len(own) else np.zeros(0, bool)
        grams, own = grams[fresh], own[fresh]
        at, length = _runs(grams)
        df = np.repeat(length, length)
        grams, own, df = grams[df > 1], own[df > 1].view(np.uint64), df[df > 1]
        order = np.argsort(own, kind="stable")
        grams, own, df = grams[order], own[order], df[order]
        at, size = _runs(own)
        key_of = _place(own[at], parts).astype(np.int64)
        rows, many = _runs(key_of)
        items = np.add.reduceat(size, rows) if len(rows) else rows
        m = len(rows)
        return pa.table([pa.array(key_of[rows]), pa.array(np.zeros(m, bool)), _binaries(own[at].view(np.int64), many), pa.nulls(m, pa.binary()), _binaries(size.astype(np.int32), many), _binaries(grams.view(np.int64), items), _binaries(df.astype(np.int64), items)], names)

    return run


def _shared_sets(p: int, q: int, frequent):
    """A part of the class keys -> the classes that may link: shared n-grams by fragment, and the prefix's with their places."""

    def run(table: pa.Table) -> pa.Table:
        hot, hot_df = frequent.value
        is_info = np.array(table.column("info").to_pylist(), bool)
        infos, counted = table.filter(pa.array(is_info)), table.filter(pa.array(~is_info))
        v, first = np.unique(_values(infos, "v"), return_index=True)
        n, held = _values(infos, "n")[first], _values(infos, "size", np.int32).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(held)])
        hot_items = _values(infos, "items", np.uint64)
        often = [hot_items[ends[i] : ends[i + 1]] for i in first]
        hot_grams, hot_of = np.concatenate([*often, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(v)), held[first])
        own = np.searchsorted(v, np.repeat(_values(counted, "v"), _values(counted, "size", np.int32)))
        grams, df = _values(counted, "items", np.uint64), _values(counted, "df")
        of = np.concatenate([own, hot_of])
        grams = np.concatenate([grams, hot_grams])
        late = np.concatenate([np.zeros(len(own), bool), np.ones(len(hot_of), bool)])
        df = np.concatenate([df, hot_df[np.searchsorted(hot, hot_grams)] if len(hot_grams) else np.zeros(0, np.int64)])
        shared = np.bincount(of, minlength=len(v))
        able = shared * q >= p * n
        kept = able[of]
        of, grams, late, df = of[kept], grams[kept], late[kept], df[kept]
        order = np.lexsort((grams, df, late, of))
        starts = np.concatenate([[0], np.cumsum(np.where(able, shared, 0))])
        at = np.empty(len(of), np.int64)
        at[order] = np.arange(len(of)) - starts[of[order]] + (n - shared)[of[order]]
        prefix = at < (n - -(-n * p // q) + 1)[of]
        by_place = np.lexsort((at, of))
        by_place = by_place[prefix[by_place]]
        pairs_of = np.bincount(of[prefix], minlength=len(v))
        f = (grams >> np.uint64(64 - int(np.log2(COUNTING_FRAGMENTS)))).astype(np.int64)
        by_part = np.lexsort((grams, f, of))
        rows, size = _runs(of[by_part] * COUNTING_FRAGMENTS + f[by_part])
        who = of[by_part][rows]
        head = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.zeros(0, bool)
        lists = np.concatenate([[0], np.cumsum(np.where(head, pairs_of[who], 0))]).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(grams[by_place].view(np.int64)), pa.array(at[by_place])], ["gram", "at"])
        items = pa.ListArray.from_arrays(pa.array(np.append(rows, len(of)).astype(np.int32)), pa.array(grams[by_part].view(np.int64)))
        # A class's first row has its bitmap too.
        rank = np.cumsum(able) - 1
        parity = np.bincount(rank[of] * BITS + (grams % np.uint64(BITS)).astype(np.int64), minlength=int(able.sum()) * BITS) & 1
        words = np.packbits(parity.astype(np.uint8).reshape(-1, BITS), axis=1, bitorder="little").view(np.int64)
        bits = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(head, BITS // 64, 0))).astype(np.int32)), pa.array(words[rank[who[head]]].reshape(-1)), mask=pa.array(~head))
        columns = [pa.array(v[who]), pa.array(n[who]), pa.array(f[by_part][rows].astype(np.int32)), items, pa.ListArray.from_arrays(pa.array(lists), entries), pa.array((n - shared)[who]), bits]
        return pa.table(columns, ["v", "n", "f", "items", "prefix", "lone", "bits"])

    return run


def _verified(pairs: DataFrame, segments: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` whose overlaps, counted in each fragment and summed, reach the threshold."""
    left = segments.select(F.col("v").alias("a"), "f", F.col("items").alias("of_a"))
    right = segments.select(F.col("v").alias("b"), "f", F.col("items").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "f"]).select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.filter(F.col("common") * q >= (F.col("na") + F.col("nb") - F.col("common")) * p).select("a", "b")


def _room(na, ra, nb, rb, p: int, q: int) -> Column:
    """Sets with their first shared n-gram at these places may link, by their sizes and by what follows it."""
    na, ra, nb, rb = (F.col(x) for x in (na, ra, nb, rb))
    return (F.least(na, nb) * q >= F.greatest(na, nb) * p) & (F.least(na - ra, nb - rb) * (p + q) >= (na + nb) * p)


def _hub_pairs(lists: DataFrame, turn: int, p: int, q: int) -> DataFrame:
    """Each list's members paired with its hub, unless they are connected."""
    first = F.col("at") if turn == 0 else F.xxhash64("v", F.lit(turn))
    hubs = narrow(cut(lists.groupBy("gram").agg(F.min(F.struct(first.alias("by"), "v", "n", "at", "c")).alias("hub"))))
    met = lists.join(hubs.select("gram", F.col("hub.v").alias("hv"), F.col("hub.n").alias("hn"), F.col("hub.at").alias("hat"), F.col("hub.c").alias("hc")), "gram")
    met = met.filter((F.col("c") != F.col("hc")) & _room("n", "at", "hn", "hat", p, q))
    lower = F.col("v") < F.col("hv")
    return met.select(F.least("v", "hv").alias("a"), F.greatest("v", "hv").alias("b"), F.when(lower, F.col("n")).otherwise(F.col("hn")).alias("na"), F.when(lower, F.col("hn")).otherwise(F.col("n")).alias("nb")).distinct()


def _differences() -> Column:
    """N-grams at least in which the sets of a pair differ, by their bitmaps and their own n-grams."""
    odd = [F.bit_count(F.get("xa", F.lit(i)).bitwiseXOR(F.get("xb", F.lit(i)))) for i in range(BITS // 64)]
    return sum(odd, F.col("la") + F.col("lb"))


def _block_pairs(lists: DataFrame, marks: DataFrame, p: int, q: int) -> DataFrame:
    """All pairs of a list between components that sizes, places and bitmaps allow; long lists are cut into blocks, which meet two by two."""
    sizes = narrow(cut(lists.groupBy("gram").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))))
    placed = lists.join(sizes, "gram").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).join(marks, "v")
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = narrow(cut(placed.select("gram", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "v", "n", "at", "c", "lone", "bits")))
    side = lambda s: placed.select("gram", "x", "y", *[F.col(c).alias(k + s) for c, k in (("block", "b"), ("v", ""), ("n", "n"), ("at", "r"), ("c", "c"), ("lone", "l"), ("bits", "x"))])
    once = F.expr("a < b AND ca <> cb AND (x = y OR ba <> bb)")
    near = _differences() * (p + q) <= (F.col("na") + F.col("nb")) * (q - p)
    return side("a").join(side("b"), ["gram", "x", "y"]).filter(once & _room("na", "ra", "nb", "rb", p, q) & near).select("a", "b", "na", "nb").distinct()


def _merged(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components of all links so far: only what the new ones join is worked on, contracted to the components known."""
    if labels is None:
        return components(found)
    known = [labels.select(F.col("v").alias(x), F.col("c").alias(f"c{x}")) for x in "ab"]
    half = cut(found.join(known[0], "a", "left").select(F.coalesce("ca", "a").alias("a"), "b"))
    merged = components(half.join(known[1], "b", "left").select("a", F.coalesce("cb", "b").alias("b")))
    moved = labels.join(merged.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left").select("v", F.coalesce("to", "c").alias("c"))
    return narrow(cut(moved.union(merged.join(labels.select("v"), "v", "left_anti").select("v", "c"))))


def _links(lists: DataFrame, segments: DataFrame, marks: DataFrame, labels: DataFrame | None, p: int, q: int) -> DataFrame | None:
    """Components ``(v, c)`` of all links between members of the lists (gram, v, n, at), joined to those known."""
    lists = lists.withColumn("c", F.col("v"))
    if labels is not None:
        lists = lists.join(labels.withColumnRenamed("c", "to"), "v", "left").select("gram", "v", "n", "at", F.coalesce("to", "c").alias("c"))
    lists, before = narrow(cut(lists)), None
    for turn in itertools.count():
        by_part = lists.groupBy("gram", "c").agg(F.count("*").alias("m"))
        live = narrow(cut(by_part.groupBy("gram").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("mm"), F.count("*").alias("parts")).filter("parts > 1")))
        left = live.agg(F.sum((F.col("m") * F.col("m") - F.col("mm")) / 2).alias("pairs"), F.sum("m").alias("rows")).first()
        if not left["rows"]:
            return labels
        lists = narrow(cut(lists.join(live.select("gram"), "gram")))
        few = left["pairs"] <= PAIRS_A_ROW * left["rows"] or (before is not None and left["pairs"] > 0.7 * before)
        final = turn == ROUNDS or (turn >= LEAST_ROUNDS and few)
        before = left["pairs"]
        pairs = narrow(cut(_block_pairs(lists, marks, p, q) if final else _hub_pairs(lists, turn, p, q)))
        found = narrow(cut(_verified(pairs, segments, p, q)))
        if not found.isEmpty():
            labels = _merged(labels, found)
            lists = narrow(cut(lists.join(labels.withColumnRenamed("c", "to"), "v", "left").select("gram", "v", "n", "at", F.coalesce("to", "c").alias("c"))))
        if final:
            return labels


def _of_classes(docs: DataFrame, n: int, limit: int) -> tuple[DataFrame, DataFrame, int]:
    """Documents, classes ``(v, class_id, n)`` and the salt of the keys; a key that two sets share calls for another salt."""
    for salt in itertools.count():
        made = cut(docs.mapInArrow(released(_measured(n, limit, salt)), _MEASURED))
        able = made.filter("NOT frequent AND n_shingles > 0 AND doc_id IS NOT NULL")
        one = [F.min(x).alias(x) for x in ("n_shingles", "f1", "f2")] + [F.max(x).alias(f"{x}_") for x in ("n_shingles", "f1", "f2")]
        classes = cut(able.groupBy("v").agg(F.min("doc_id").alias("class_id"), *one))
        if classes.filter("n_shingles <> n_shingles_ OR f1 <> f1_ OR f2 <> f2_").isEmpty():
            return made, classes.select("v", "class_id", F.col("n_shingles").alias("n")), salt


def near_duplicates(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the smallest document with the same n-gram set;
    ``component_id`` the smallest one reachable by links.  ``threshold`` is p, q:
    linked if ``q * |A & B| >= p * |A | B|``.  Defined cases: a null, empty or
    blank text has no n-grams and links with nothing; a text of fewer than n
    words has its whole word sequence as one n-gram; rows that repeat a
    doc_id each give a row, and the number links with all its texts, which
    so are in one component; a null doc_id is kept and links with nothing; no
    rows give no rows; other columns are ignored.
    """
    p, q = threshold
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    limit = min(2**64 - 1, int(FIRST * (q - p) / q * 2**64))
    made, classes, salt = _of_classes(docs, n, limit)
    able = made.filter("NOT frequent AND n_shingles > 0 AND doc_id IS NOT NULL")

    sums = made.filter("NOT frequent").agg(F.sum("n_shingles").alias("n"), F.sum(F.length("first")).alias("bytes")).first()
    grams, first = sums["n"] or 0, (sums["bytes"] or 0) // 8
    # At most FREQUENT rows, as the counts of all rows sum to no more than the n-grams.
    least = max(LEAST_FREQUENT, grams // FREQUENT)
    table = made.filter("frequent").groupBy("v").agg(F.sum("n_shingles").alias("m")).filter(F.col("m") >= least).toArrow()
    hot, hot_df = table.column("v").to_numpy().astype(np.int64).view(np.uint64), table.column("m").to_numpy().astype(np.int64)
    order = np.argsort(hot)
    frequent = spark.sparkContext.broadcast((hot[order], hot_df[order]))

    parts = max(LEAST_FRAGMENTS, -(-first // FRAGMENT))
    dealt = able.select("v", "first").mapInArrow(released(_first_fragments(parts, limit, frequent)), _DEALT)
    lone = dealt.groupBy("key").applyInArrow(_lone(parts), "key long, v binary, size binary").groupBy("key").applyInArrow(_lone_sums, "v long, lone long")
    open_classes = narrow(cut(classes.join(lone, "v", "left").filter(F.coalesce("lone", F.lit(0)) * q <= F.col("n") * (q - p)).select("v", "class_id", "n")))

    grams = open_classes.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_FRAGMENTS, -(-grams // FRAGMENT))
    wanted = narrow(cut(open_classes.select(F.col("class_id").alias("doc_id")).distinct()))
    dealt = rows_of(docs, wanted, "doc_id").mapInArrow(released(_all_fragments(n, salt, parts, frequent)), _DEALT)
    counted = dealt.groupBy("key").applyInArrow(_counted(parts), _COUNTED)
    sets = cut(counted.groupBy("key").applyInArrow(_shared_sets(p, q, frequent), _SETS))
    lists = sets.select("v", "n", F.explode("prefix").alias("e")).select("e.gram", "v", "n", "e.at")

    # A doc_id with several texts joins their classes.
    several = able.groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("high")).filter("a < high").select("doc_id", "a")
    several = narrow(cut(able.select("doc_id", F.col("v").alias("b")).join(several, "doc_id").filter("a < b").select("a", "b").distinct()))
    marks = sets.filter("bits IS NOT NULL").select("v", "lone", "bits")
    labels = _links(lists, sets.select("v", "f", "items"), marks, None if several.isEmpty() else components(several), p, q)

    named = classes.select("v", "class_id")
    if labels is None:
        named = named.withColumn("component_id", F.col("class_id"))
    else:
        member = narrow(cut(labels.join(named, "v").select("v", "c", "class_id")))
        least = narrow(cut(member.groupBy("c").agg(F.min("class_id").alias("component_id"))))
        member = narrow(cut(member.join(least, "c").select("v", "component_id")))
        named = cut(named.join(member, "v", "left").select("v", "class_id", F.coalesce("component_id", "class_id").alias("component_id")))
    rows = made.filter("NOT frequent").select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("v")).alias("v"))
    return rows.join(named, "v", "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))
