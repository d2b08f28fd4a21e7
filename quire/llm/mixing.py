"""Mixing documents to target domain weights, in DataFrame functions only.

A naive Bayes classifier learned from the labelled table gives each document its
posterior over domains.  A rate for each document, between 0 and a largest rate,
is then fitted so that the expected tokens of the domains, ``sum(rate * tokens *
posterior)``, meet the targets: weighted least squares by projected gradient.
Each step is one aggregation over all documents; a document's rate is a fold
over the steps' residuals, so nothing but these few numbers is carried along.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CLASS, cut, unused

#: Domains, first match wins, as conditions over the labelled table, and the weights to reach.
DOMAINS = {"toxic": "toxic = 1", "poor": "quality = 0", "good": "quality = 1"}
TARGETS = {"toxic": 0.12, "poor": 0.06, "good": 0.82}
#: The classifier learns from at most this many labelled documents and uses at most this many words.
TRAIN_DOCS, WORDS = 4000, 500
#: A word counts if this many training documents hold it, and this share of them.
LEAST_DOCS, LEAST_SHARE = 8, 0.005
#: Log-likelihoods are divided by this, as features are not independent.
TEMPERATURE = 1.5
#: Halvings that find the largest share of the scarcest domain's tokens at which targets can be met, and how much of it is
#: taken; where none is, as many tokens are drawn as at the last number, and the rates are the best fit.
HALVINGS, TAKEN, UNMET_SHARE = 14, 0.98, 0.9
#: Cells of posteriors, at most, in which documents are summed to find it.
CELLS = 4096
STEPS, TOLERANCE = 100, 1e-4
#: Targets are met if each is within this share.
MET = 0.01
_BINS = 8


def _measures() -> dict[str, Column]:
    """A bin from 0 to 7 for each shape measure of a text; ``__text`` and ``__n`` are given."""
    n = F.greatest(F.col("__n"), F.lit(1))
    left = lambda pattern: F.length(F.regexp_replace("__text", pattern, ""))
    total = F.length("__text")
    binned = lambda x: F.least(F.lit(_BINS - 1), F.floor(x * _BINS)).cast("int")
    return {
        "symbols": binned((total - left(r"[#*$%&|<>]+")) / (2 * n)),
        "exclaimed": binned((total - left("!+")) / (2 * n)),
        "upper": binned((total - left(r"\p{Lu}+")) / F.greatest(total, F.lit(1))),
        "distinct": binned(F.size(F.array_distinct("__words")) / n),
    }


def _described(docs: DataFrame) -> DataFrame:
    """``doc_id, th, n_tokens, m_*``: th tells apart the texts of a repeated doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), text.alias("__text"))
    base = base.withColumn("__words", F.filter(F.split("__text", WHITE_CLASS + "+"), lambda w: w != "")).withColumn("__n", F.size("__words"))
    return base.select("doc_id", "th", F.col("__n").cast("long").alias("n_tokens"), *[c.alias(f"m_{k}") for k, c in _measures().items()])


def _held_words(docs: DataFrame, known: Column | None = None) -> DataFrame:
    """``doc_id, th, word``: each distinct word of letters, in lower case, of each text; only those in the array ``known``, if it is given."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[^\p{L}]+")
    words = F.array_distinct(words) if known is None else F.array_intersect(words, known)
    return docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(words).alias("word")).filter("word <> ''")


@dataclass
class DomainModel:
    domains: list[str]
    prior: list[float]
    measures: dict[str, list[list[float]]]
    words: DataFrame


def learn_domains(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS) -> DomainModel:
    """Naive Bayes from the labelled documents that come first by a hash of doc_id."""
    names = list(domains)
    case = F.coalesce(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(domains.values())])
    labelled = labels.select("doc_id", case.alias("domain")).filter("domain IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # At most TRAIN_DOCS rows of two numbers: a proven bound for the broadcast.
    picked = F.broadcast(cut(labelled.orderBy(F.xxhash64("doc_id", F.lit("train")), "doc_id").limit(TRAIN_DOCS)))
    train = cut(docs.select("doc_id", "text").join(picked, "doc_id"))
    counts = {r["domain"]: r["count"] for r in train.groupBy("domain").count().collect()}
    per = np.array([counts.get(i, 0) for i in range(len(names))], float)
    prior = np.log((per + 1) / (per.sum() + len(names)))
    shape = _described(train).join(picked, "doc_id")
    measures = {}
    for m in ("symbols", "exclaimed", "upper", "distinct"):
        table = np.full((_BINS, len(names)), 0.5)
        for r in shape.groupBy(f"m_{m}", "domain").count().collect():
            table[r[f"m_{m}"], r["domain"]] += r["count"]
        measures[m] = np.log(table / table.sum(0)).tolist()
    n = [F.sum((F.col("domain") == i).cast("double")).alias(f"n{i}") for i in range(len(names))]
    found = _held_words(train).join(picked, "doc_id").groupBy("word").agg(*n).filter("+".join(f"n{i}" for i in range(len(names))) + f" >= {max(LEAST_DOCS, LEAST_SHARE * per.sum())}")
    # A word speaks if present: log P(word | domain), against the mean over the domains.
    logs = [F.log((F.col(f"n{i}") + 0.5) / (per[i] + 1.0)) for i in range(len(names))]
    mean = sum(logs[1:], logs[0]) / len(names)
    found = found.select("word", *[(x - mean).alias(f"w{i}") for i, x in enumerate(logs)])
    spread = F.greatest(*[F.abs(f"w{i}") for i in range(len(names))])
    words = cut(found.orderBy(F.desc(spread), "word").limit(WORDS))
    return DomainModel(names, prior.tolist(), measures, words)


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``doc_id, th, copies, n_tokens, p`` (an array in the order of ``model.domains``), a row for each distinct (doc_id, text)."""
    d = range(len(model.domains))
    # The vocabulary has at most WORDS rows; a text's words are cut down to it before they become rows.
    known = F.lit([r["word"] for r in model.words.select("word").collect()]).cast("array<string>")
    hits = _held_words(docs, known).join(F.broadcast(model.words), "word").groupBy("doc_id", "th").agg(*[F.sum(f"w{i}").alias(f"s{i}") for i in d])
    hits = hits.withColumnsRenamed({"doc_id": "__doc", "th": "__t"})
    rows = _described(docs)
    rows = rows.groupBy("doc_id", "th").agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in rows.columns if c not in ("doc_id", "th")])
    rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("th") == F.col("__t")), "left")
    score = []
    for i in d:
        shape = [F.get(F.lit([row[i] for row in table]), F.col(f"m_{m}")) for m, table in model.measures.items()]
        score.append(F.lit(model.prior[i]) + (sum(shape[1:], shape[0]) + F.coalesce(F.col(f"s{i}"), F.lit(0.0))) / TEMPERATURE)
    most = F.greatest(*score) if len(score) > 1 else score[0]
    raised = F.array(*[F.exp(x - most) for x in score])
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", "th", "copies", "n_tokens", raised.alias("p")).withColumn("p", F.transform("p", lambda x: x / total))


def _met_at(masses: np.ndarray, goal: np.ndarray, largest: float) -> np.ndarray | None:
    """``u`` such that cells' rates ``clip(start - p u)`` give ``goal``, by damped Newton steps on the cells' token masses; None if there is none."""
    share, start, u = masses / np.maximum(masses.sum(1, keepdims=True), 1e-12), min(1.0, largest), np.zeros(masses.shape[1])
    rates = lambda u: np.clip(start - share @ u, 0.0, largest)
    miss = lambda u: masses.T @ rates(u) - goal
    scale = np.maximum(goal, 1e-9 * max(1.0, goal.max()))
    for _ in range(80):
        off = miss(u)
        if (np.abs(off) <= 0.1 * MET * scale).all():
            return u
        r = rates(u)
        free = (r > 0) & (r < largest) | (share @ u == 0)
        slope = masses[free].T @ share[free]
        step = np.linalg.lstsq(slope + 1e-9 * np.trace(slope) * np.eye(len(u)), off, rcond=None)[0]
        size = 1.0
        while size > 1e-3 and np.linalg.norm(miss(u + size * step) / scale) > np.linalg.norm(off / scale):
            size /= 2
        u = u + size * step
    return None


def _attainable(masses: np.ndarray, goal: np.ndarray, largest: float) -> tuple[float, np.ndarray]:
    """``TAKEN`` of the largest share of ``goal`` that cells' rates can meet, and ``u``: where the descent begins.

    Rates that meet a share, scaled down, meet every smaller one, so the largest
    is found by halving, on the driver.  If none can be met, ``UNMET_SHARE`` and no ``u``.
    """
    low, high, begin = 0.0, 1.0, None
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        u = _met_at(masses, middle * goal, largest)
        low, high, begin = (middle, high, u) if u is not None else (low, middle, begin)
    if begin is None:
        return UNMET_SHARE, np.zeros(masses.shape[1])
    u = _met_at(masses, TAKEN * low * goal, largest)
    return (TAKEN * low, u) if u is not None else (low, begin)


def fit_rates(rows: DataFrame, targets: list[float], largest: float = 1.0) -> tuple[Column, dict]:
    """The column of rates over ``copies, n_tokens, p`` (a row stands for so many copies) and what it reaches.

    Targets are weights; they are scaled to a share of the most tokens that
    the scarcest domain allows at the largest rate: the largest at which soft
    memberships can meet them, by the sums of documents with like posteriors
    (``CELLS`` rows at most), which also give the first rates.  With the metric ``inverse(sum(tokens *
    p * p'))`` the gradient's Lipschitz constant over token-weighted rates is
    1, so steps of length 1 descend.
    """
    d = range(len(targets))
    p = [F.get("p", F.lit(i)) for i in d]
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    t = (F.col("n_tokens") * copies).cast("double")
    sums = rows.select(*[F.sum(t * p[i]).alias(f"s{i}") for i in d], *[F.sum(t * p[i] * p[j]).alias(f"m{i}_{j}") for i in d for j in d if j >= i]).first()
    have = np.array([sums[f"s{i}"] or 0.0 for i in d])
    weights = np.array(targets, float) / sum(targets)
    if not have.sum():
        return F.lit(min(1.0, largest)), {"targets": [0.0] * len(targets), "reached": [0.0] * len(targets), "steps": 0}
    most = min(largest * have[i] / weights[i] for i in d if weights[i] > 0)
    bins = int(CELLS ** (1 / max(1, len(targets) - 1)))
    cells = rows.groupBy(*[F.floor(p[i] * bins).cast("int").alias(f"c{i}") for i in d[:-1]]).agg(*[F.sum(t * p[i]).alias(f"s{i}") for i in d]).collect()
    masses = np.array(sorted(tuple(r[f"s{i}"] or 0.0 for i in d) for r in cells))
    budget, begin = _attainable(masses, weights * most, largest)
    goal = budget * weights * most
    gram = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] for j in d] for i in d])
    metric = np.linalg.pinv(gram, rcond=1e-10)
    moves: list[list[float]] = []
    start = float(min(1.0, largest))
    momentum = 1.0

    def state() -> Column:
        """``r`` after the moves so far and ``y``, where the next gradient is taken (with momentum)."""
        drawn = F.greatest(F.lit(0.0), F.least(F.lit(float(largest)), sum((p[i] * F.lit(-float(u)) for i, u in enumerate(begin)), F.lit(start))))
        first = F.struct(drawn.alias("r"), drawn.alias("y"))
        if not moves:
            return first

        def step(s: Column, u: Column) -> Column:
            along = sum((F.get("p", F.lit(i)) * F.get(u, F.lit(i)) for i in d[1:]), F.get("p", F.lit(0)) * F.get(u, F.lit(0)))
            # A one-element array binds the new rate, which the momentum needs twice.
            made = F.array(F.greatest(F.lit(0.0), F.least(F.lit(float(largest)), s["y"] - along)))
            return F.element_at(F.transform(made, lambda r: F.struct(r.alias("r"), (r + F.get(u, F.lit(len(targets))) * (r - s["r"])).alias("y"))), 1)

        return F.aggregate(F.lit(moves), first, step)

    reached, best = goal, None
    for _ in range(STEPS + 1):
        got = rows.select(state().alias("s"), "n_tokens", copies.alias("copies"), "p").select(*[F.sum(t * F.col(f"s.{x}") * p[i]).alias(f"{x}{i}") for i in d for x in "ry"]).first()
        reached, ahead = (np.array([got[f"{x}{i}"] or 0.0 for i in d]) for x in "ry")
        loss = float((reached - goal) @ metric @ (reached - goal))
        if np.abs(reached - goal).sum() <= TOLERANCE * goal.sum() or (best is not None and best - loss < 1e-5 * best and len(moves) > 8) or len(moves) == STEPS:
            break
        best = loss if best is None else min(best, loss)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moves.append([*(metric @ (ahead - goal)).tolist(), (momentum - 1) / following])
        momentum = following
    return F.round(state()["r"], 6), {"targets": goal.tolist(), "reached": reached.tolist(), "steps": len(moves)}


def mixing_rates(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS, targets: dict[str, float] = TARGETS, largest: float = 1.0) -> DataFrame:
    """``doc_id, th, n_tokens, rate``, ``p_<domain>``, ``weight_<domain>`` and ``met``, a row for each distinct (doc_id, text).

    ``th`` is xxhash64(text).  The weights are the shares of the expected
    tokens that the fit reaches, the same in all rows; ``met`` tells whether
    each token total is within ``MET`` of its target.  If they are not (soft
    memberships may not allow it), the rates are the best fit found and a
    warning says so.  Rows that repeat (doc_id, text) count in the totals as
    often as they are there.  Defined cases: null or empty text has no tokens,
    its rate follows from its posterior; with no labelled document the
    posteriors are the priors' (equal ones); a null doc_id is kept; no rows
    give no rows; other columns are ignored; labels that repeat a doc_id count
    once, with the first domain; labels of other documents are ignored.
    """
    docs = docs.select("doc_id", "text")
    model = learn_domains(docs, labels, domains)
    rows = cut(posteriors(docs, model))
    rate, facts = fit_rates(rows, [targets[k] for k in domains], largest)
    goal, reached = (np.array(facts[x]) for x in ("targets", "reached"))
    met = bool((np.abs(reached - goal) <= MET * goal).all())
    if not met:
        warnings.warn(f"the mixing targets are not met: {dict(zip(domains, goal.round()))} tokens wanted, {dict(zip(domains, reached.round()))} reached", stacklevel=2)
    weights = (reached / max(reached.sum(), 1e-300)).round(6).tolist()
    columns = [F.round(F.get("p", F.lit(i)), 6).alias(f"p_{k}") for i, k in enumerate(domains)] + [F.lit(w).alias(f"weight_{k}") for k, w in zip(domains, weights)]
    return rows.select("doc_id", "th", "n_tokens", rate.alias("rate"), *columns, F.lit(met).alias("met"))


def mix(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` that their rates draw: a hash of doc_id is the lot, so a rerun draws the same.

    Rows that repeat (doc_id, text) are drawn together, and counted so in the
    fit.  Nulls, empty texts, empty tables and other columns, whatever their
    names, are as in ``mixing_rates``; the columns stay those of ``docs``.
    """
    doc, t, th, rate = (unused(docs, x) for x in ("doc", "t", "th", "rate"))
    rates = mixing_rates(docs, labels, domains, targets).select(F.col("doc_id").alias(doc), F.col("th").alias(t), F.col("rate").alias(rate))
    keyed = docs.withColumn(th, F.xxhash64("text"))
    lot = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    drawn = keyed.join(rates, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(th) == F.col(t)))
    return drawn.filter(lot < F.col(rate)).select(*docs.columns)
