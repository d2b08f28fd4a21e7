"""Nearest neighbours by a forest of random-projection trees with one shared priority queue.

Trees are grown on a bounded sample of the distinct vectors; each inner node
splits at the median of a projection on the difference of two of its points.
All distinct vectors are dealt to their leaf of each tree.  For a query, one
priority queue over the nodes of all trees gives the leaves in order of the
smallest margin by which the query would have to move to reach them, until they
hold enough candidates.  Candidates are scored exactly, in double precision, in
their leaves.

The candidates' scores are then a bound: a leaf of the first tree that could
hold a larger product by its centre and radius is scored whole.  So the result
is exact for every table; the trees only decide how much is scored for it.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Sample that the trees are grown on, trees, smallest share of the sample in a leaf, deepest leaf.
SAMPLE, TREES, LEAF_ROWS, DEPTH = 20_000, 48, 200, 14
#: A query looks at leaves until they hold this many candidates, counted in each tree.
SEARCH = 32_000
_BLOCK = 2048
#: Vectors of neighbouring leaves that the exact pass holds at a time, and queries that it scores at once.
GROUP_BYTES, _ASKED = 16 << 20, 256


def grow(points: np.ndarray, total: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 3) -> list[dict]:
    """Trees as arrays: ``w, t, left, right`` of inner nodes; a child below 0 is leaf ``-1 - child``."""
    rng = np.random.default_rng(seed)
    least = max(8, leaf_rows * len(points) // max(1, total))
    out = []
    for _ in range(trees):
        nodes: list[list] = []
        leaves = 0

        def split(index: np.ndarray, depth: int) -> int:
            nonlocal leaves
            if len(index) > least and depth < DEPTH:
                for _ in range(4):
                    a, b = rng.choice(index, 2, replace=False)
                    w = points[a] - points[b]
                    along = points[index] @ w
                    t = float(np.median(along))
                    low = along < t
                    if 0 < low.sum() < len(index):
                        k = len(nodes)
                        nodes.append([w, t, 0, 0])
                        nodes[k][2] = split(index[low], depth + 1)
                        nodes[k][3] = split(index[~low], depth + 1)
                        return k
            leaves += 1
            return -leaves

        root = split(np.arange(len(points)), 0)
        dim = points.shape[1]
        w = np.array([n[0] for n in nodes]).reshape(-1, dim)
        out.append({"root": root, "leaves": leaves, "w": w, "t": np.array([n[1] for n in nodes]), "left": np.array([n[2] for n in nodes], np.int64), "right": np.array([n[3] for n in nodes], np.int64), "norm": np.sqrt((w * w).sum(1)) + 1e-300})
    first = 0
    for tree in out:
        tree["first"] = first
        first += tree["leaves"]
    return out


def leaves_of(forest: list[dict], points: np.ndarray) -> np.ndarray:
    """The leaf (numbered over all trees) of each point in each tree."""
    out = np.empty((len(points), len(forest)), np.int64)
    for j, tree in enumerate(forest):
        node = np.full(len(points), tree["root"])
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            right = (points[inner] * tree["w"][at]).sum(1) >= tree["t"][at]
            node[inner] = np.where(right, tree["right"][at], tree["left"][at])
        out[:, j] = tree["first"] - 1 - node
    return out


def visited(forest: list[dict], sizes: np.ndarray, point: np.ndarray, search: int) -> list[int]:
    """Leaves in the order of the shared queue until they hold ``search`` candidates."""
    margins = [(tree["w"] @ point - tree["t"]) / tree["norm"] for tree in forest]
    queue = [(0.0, j, tree["root"]) for j, tree in enumerate(forest)]
    found, out = 0, []
    while queue and found < search:
        far, j, node = heapq.heappop(queue)
        tree = forest[j]
        while node >= 0:
            m = margins[j][node]
            near, other = (tree["right"][node], tree["left"][node]) if m >= 0 else (tree["left"][node], tree["right"][node])
            heapq.heappush(queue, (max(far, abs(m)), j, other))
            node = near
        leaf = tree["first"] - 1 - node
        out.append(int(leaf))
        found += int(sizes[leaf])
    return out


def grouped(sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The first group of each leaf and how many it has: small neighbouring leaves share one, a large leaf is split."""
    first, parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // rows))
    group = held = 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > rows:
            group, held = group + 1, 0
        first[k] = group
        held += size
        if parts[k] > 1:
            group, held = group + int(parts[k]), 0
    return first, parts


def _matrix(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, dim)


def _rows(x: np.ndarray, kind: str) -> pa.ListArray:
    """A matrix as lists, of single precision if that is what the table holds, so nothing is lost."""
    values = x.astype(np.float32 if kind == "float" else float).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(values))


def _lifted(points: np.ndarray, largest: float) -> np.ndarray:
    """One more component that makes all vectors equally long, so that the largest product is the nearest."""
    return np.concatenate([points, np.sqrt(np.maximum(0, largest**2 - (points * points).sum(1)))[:, None]], 1)


def _completed(points: DataFrame, bounds: DataFrame, tree: dict, largest: float, dim: int, k: int) -> DataFrame:
    """``q, p, score`` of all points that can be among a query's k + 1 best, given the score its best so far do not go below.

    For a leaf with centre c and radius r, no product is over q c + |q| r.
    Only queries that this does not rule out meet the leaf, and there all of
    its points.  A worker holds the vectors of one group of leaves.
    """
    spark = points.sparkSession
    sc = spark.sparkContext
    grown = sc.broadcast((tree, largest))

    def leaf(x):
        one, longest = grown.value
        return leaves_of([one], _lifted(x, longest))[:, 0]

    def blocks(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                yield batch.slice(at, _BLOCK)

    def sums(batches):
        total, size = np.zeros((grown.value[0]["leaves"], dim)), np.zeros(grown.value[0]["leaves"], np.int64)
        for part in blocks(batches):
            x = _matrix(part, "v", dim)
            at = leaf(x)
            np.add.at(total, at, x)
            size += np.bincount(at, minlength=len(size))
        some = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(list(total[some]), pa.list_(pa.float64()))], ["leaf", "n", "v"])

    sizes, centres = np.zeros(tree["leaves"], np.int64), np.zeros((tree["leaves"], dim))
    added = points.select("v").mapInArrow(sums, "leaf long, n long, v array<double>").groupBy("leaf")
    for r in added.agg(F.sum("n").alias("n"), *[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(dim)]).toLocalIterator():  # a row a leaf
        sizes[r["leaf"]], centres[r["leaf"]] = r["n"], np.array(r[2:]) / r["n"]
    middle = sc.broadcast(centres)

    def spread(batches):
        far = np.full(len(middle.value), -1.0)
        for part in blocks(batches):
            x = _matrix(part, "v", dim)
            at = leaf(x)
            np.maximum.at(far, at, np.sqrt(((x - middle.value[at]) ** 2).sum(1)))
        some = np.flatnonzero(far >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(far[some])], ["leaf", "far"])

    radius = np.full(tree["leaves"], -np.inf)
    for r in points.select("v").mapInArrow(spread, "leaf long, far double").groupBy("leaf").agg(F.max("far").alias("far")).toLocalIterator():
        radius[r["leaf"]] = r["far"]
    first, parts = grouped(sizes, max(1, GROUP_BYTES // (8 * dim)))
    pairs = np.stack([np.repeat(np.arange(len(parts)), parts), np.concatenate([a + np.arange(n) for a, n in zip(first, parts)])])
    pairs = pairs[:, np.argsort(pairs[1], kind="stable")]
    starts = np.flatnonzero(np.diff(pairs[1], prepend=-1))
    # Rounding of the products and bounds is far below this.
    slack = 1e-9 * largest * largest
    facts = sc.broadcast((radius, first, parts, pairs[0], starts, pairs[1][starts]))

    def possible(x, least, some=slice(None)):
        return x @ middle.value[some].T + np.sqrt((x * x).sum(1))[:, None] * facts.value[0][some] >= least[:, None] - slack

    names = ["grp", "kind", "leaf", "p", "least", "v"]

    def deal(batches):
        _, at_first, n_parts, *_ = facts.value
        for part in blocks(batches):
            at = leaf(_matrix(part, "v", dim))
            ids = part.column("p").to_numpy(zero_copy_only=False)
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            group = at_first[at] + (mixed % n_parts[at].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(np.zeros(len(at), np.int32)), pa.array(at), part.column("p"), pa.array(np.zeros(len(at))), part.column("v")], names)

    def ask(batches):
        _, _, _, owners, begins, groups = facts.value
        for batch in batches:
            for at in range(0, batch.num_rows, _ASKED):
                part = batch.slice(at, _ASKED)
                x, least = _matrix(part, "v", dim), part.column("least").to_numpy(zero_copy_only=False)
                need = np.logical_or.reduceat(possible(x, least)[:, owners], begins, axis=1)
                who, to = np.nonzero(need)
                who_ = pa.array(who)
                yield pa.RecordBatch.from_arrays([pa.array(groups[to]), pa.array(np.ones(len(who), np.int32)), pa.array(np.zeros(len(who), np.int64)), part.column("p").take(who_), pa.array(least[who]), part.column("v").take(who_)], names)

    def score(batches):
        group, held, ready = None, [], None
        for batch in batches:
            groups, kinds, leaves, ids, least = (batch.column(c).to_numpy(zero_copy_only=False) for c in names[:5])
            x = _matrix(batch, "v", dim)
            edges = np.flatnonzero(np.diff(groups) | np.diff(kinds)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if groups[a] != group:
                    group, held, ready = groups[a], [], None
                if kinds[a] == 0:
                    held.append((leaves[a:b].copy(), ids[a:b].copy(), x[a:b].copy()))
                    continue
                if not held:
                    continue
                if ready is None:
                    ready = [np.concatenate(y) for y in zip(*held)]
                    held = [ready]
                at_leaf, at_ids, vectors = ready
                begins = np.flatnonzero(np.diff(at_leaf, prepend=-1))
                for at in range(a, b, _ASKED):
                    c = min(b, at + _ASKED)
                    asked, low = x[at:c], least[at:c]
                    able = possible(asked, low, at_leaf[begins])
                    found = []
                    for j, (s, e) in enumerate(zip(begins, [*begins[1:], len(at_leaf)])):
                        who = np.flatnonzero(able[:, j])
                        if len(who):
                            made = asked[who] @ vectors[s:e].T
                            i, y = np.nonzero(made >= low[who][:, None] - slack)
                            found.append((who[i], at_ids[s + y], made[i, y]))
                    if not found:
                        continue
                    q, p, made = (np.concatenate(y) for y in zip(*found))
                    order = np.lexsort((p, -made, q))
                    q, p, made = q[order], p[order], made[order]
                    keep = np.arange(len(q)) - np.searchsorted(q, q) <= k
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at:c][q[keep]]), pa.array(p[keep]), pa.array(made[keep])], ["q", "p", "score"])

    schema = "grp long, kind int, leaf long, p long, least double, v array<double>"
    askers = points.filter("asked").select("p", "v").join(bounds, F.col("p") == F.col("q"), "left")
    askers = askers.select("p", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    both = points.select("p", "v").mapInArrow(deal, schema).union(askers.mapInArrow(ask, schema))
    return both.repartition("grp").sortWithinPartitions("grp", "kind", "leaf").mapInArrow(score, "q long, p long, score double")


def nearest(vectors: DataFrame, queries: str, k: int = 20, search: int = SEARCH, column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest others of each row where ``queries`` (SQL) holds.

    Nearest is the largest inner product, ties to the smaller vec_id.  Defined
    cases: vectors that are null, zero or have null or non-finite components
    take no part; a query is compared with the vectors of its own length, and
    each length has its own index; equal vectors are one point of the index,
    which keeps its k + 1 smallest vec_ids (no more can be in a result); rows
    that repeat a vec_id with one vector are one row; with k or fewer others
    all are returned; no rows give no rows; other columns are ignored.

    The scores of the k + 1 best points are added up once more in the order of
    the components, so equal products rank by vec_id whatever block they were
    found in.

    ``search`` is how many candidates the trees give a query for its bound; the
    result does not depend on it.

    The driver holds the sample and the trees, whose sizes are fixed; a worker
    holds the leaves' queries of its partition and one block of vectors, then
    the vectors of one group of leaves.
    """
    spark = vectors.sparkSession
    kind = "float" if vectors.schema[column].dataType.simpleString() == "array<float>" else "double"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.filter(fine).withColumn("dim", F.size("v"))
    lengths = [r["dim"] for r in v.select("dim").distinct().orderBy("dim").collect()]
    found = [_nearest_of(v.filter(F.col("dim") == dim), dim, kind, queries, k, search) for dim in lengths]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _nearest_of(v: DataFrame, dim: int, kind: str, queries: str, k: int, search: int) -> DataFrame:
    """``nearest`` over vectors (vec_id, v) of one length."""
    spark = v.sparkSession
    v = v.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")).distinct()
    points = cut(v.groupBy("h1", "h2").agg(F.min("vec_id").alias("p"), F.min_by("v", "vec_id").alias("v"), F.max(F.expr(queries)).alias("asked")))
    by_point = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = v.select("h1", "h2", "vec_id").withColumn("nth", F.row_number().over(by_point)).filter(F.col("nth") <= k + 1)
    members = cut(members.join(points.select("h1", "h2", "p"), ["h1", "h2"]).select("p", "vec_id"))

    facts = points.select(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("largest")).first()
    total, largest = facts["n"], float(np.sqrt(facts["largest"]))
    sampled = points.select("v").orderBy(F.xxhash64("h1", F.lit(7)), "p").limit(SAMPLE).toPandas()["v"]
    forest = grow(_lifted(np.stack([np.asarray(x, float) for x in sampled]), largest), total)
    n_leaves = sum(t["leaves"] for t in forest)
    shared = spark.sparkContext.broadcast((forest, largest))

    def deal(batches):
        trees, longest = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                x = _matrix(part, "v", dim)
                found = leaves_of(trees, _lifted(x, longest))
                ids = part.column("p").to_numpy(zero_copy_only=False)
                rows = _rows(x, kind)
                for j in range(found.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, j]), pa.array(np.ones(len(x), np.int32)), pa.array(ids), rows], ["leaf", "kind", "p", "v"])

    schema = f"leaf long, kind int, p long, v array<{kind}>"
    dealt = points.select("p", "v").mapInArrow(deal, schema)
    sizes = np.zeros(n_leaves, np.int64)
    for r in dealt.groupBy("leaf").count().collect():  # at most as many rows as leaves
        sizes[r["leaf"]] = r["count"]
    counts = spark.sparkContext.broadcast(sizes)

    def ask(batches):
        trees, longest = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x, ids = _matrix(part, "v", dim), part.column("p").to_pylist()
                lifted = np.concatenate([x, np.zeros((len(x), 1))], 1)
                leaves = [visited(trees, counts.value, y, search) for y in lifted]
                index = np.repeat(np.arange(len(x)), [len(y) for y in leaves])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(leaves).astype(np.int64)), pa.array(np.zeros(len(index), np.int32)), pa.array(np.array(ids)[index]), _rows(x, kind).take(pa.array(index))], ["leaf", "kind", "p", "v"])

    asked = points.filter("asked").select("p", "v").mapInArrow(ask, schema)

    def score(batches):
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        leaf, names, rows = None, [], []

        def merge(ids, made):
            for q, scores in zip(names, made):
                if q in best:
                    old_p, old_s = best[q]
                    p, s = np.concatenate([old_p, ids]), np.concatenate([old_s, scores])
                    p, first = np.unique(p, return_index=True)
                    s = s[first]
                else:
                    p, s = ids, scores
                keep = np.lexsort((p, -s))[: k + 1]
                best[q] = (p[keep], s[keep])

        for batch in batches:
            leaves, kinds, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "kind", "p"))
            x = _matrix(batch, "v", dim)
            edges = np.flatnonzero(np.diff(leaves) | np.diff(kinds)) + 1
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                if leaves[a] != leaf:
                    leaf, names, rows = leaves[a], [], []
                if kinds[a] == 0:
                    names += ids[a:b].tolist()
                    rows.append(x[a:b])
                elif names:
                    rows = [np.concatenate(rows)]
                    for at in range(a, b, _BLOCK):
                        merge(ids[at : min(b, at + _BLOCK)], rows[0] @ x[at : min(b, at + _BLOCK)].T)
        for at in range(0, len(best), 1000):
            part = list(best.items())[at : at + 1000]
            q = np.repeat([x for x, _ in part], [len(p) for _, (p, _) in part])
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(np.concatenate([p for _, (p, _) in part])), pa.array(np.concatenate([s for _, (_, s) in part]))], ["q", "p", "score"])

    both = asked.union(dealt).repartition("leaf").sortWithinPartitions("leaf", "kind")
    scored = both.mapInArrow(score, "q long, p long, score double").groupBy("q", "p").agg(F.max("score").alias("score"))
    near = Window.partitionBy("q").orderBy(F.desc("score"), "p")
    first = cut(scored.withColumn("nth", F.row_number().over(near)).filter(F.col("nth") <= k + 1).select("q", "p", "score"))
    bounds = first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounds = bounds.select("q", F.when(F.col("n") > k, F.col("least")).otherwise(F.lit(float("-inf"))).alias("least"))
    rest = _completed(points, bounds, forest[0], largest, dim, k)
    every = first.union(rest).groupBy("q", "p").agg(F.max("score").alias("score"))
    kept = cut(every.withColumn("nth", F.row_number().over(near)).filter(F.col("nth") <= k + 1).select("q", "p", "score"))
    vector = lambda name, at: points.select(F.col("p").alias(at), F.col("v").alias(name))
    product = F.aggregate(F.zip_with("__a", "__b", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    kept = kept.join(vector("__a", "p"), "p").join(vector("__b", "q"), "q").select("q", "p", product.alias("score"))
    # A point's results are found once, and all rows equal to it get them, without themselves.
    few = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = cut(kept.join(members, "p").select("q", "vec_id", "score").withColumn("nth", F.row_number().over(few)).filter(F.col("nth") <= k + 1).select("q", "vec_id", "score"))
    lists = listed.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("all"))
    askers = v.filter(F.expr(queries)).select("h1", "h2", F.col("vec_id").alias("query_id"))
    askers = cut(askers.join(points.select("h1", "h2", F.col("p").alias("q")), ["h1", "h2"]).select("q", "query_id"))
    others = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = askers.join(cut(lists), "q").select("query_id", F.posexplode(others).alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
