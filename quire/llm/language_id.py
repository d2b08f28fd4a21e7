"""Language ID by a linear-chain conditional random field over words.

Each word of a line gets a language; forward-backward gives the words'
marginals, and the document's language is the one with the largest mean
marginal.  So a text that switches between languages is labelled word by word.
A word's features are its affixes, its character n-grams and whether the
lexicon (words of the training sample, by language) holds it; transitions
between the languages of neighbouring words are learned with them.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, small_batches, unused

#: The classifier learns from the whole texts (each distinct line once) of at most this many documents of each language,
#: and of all together; with many languages each has fewer, and one at least.
TRAIN_DOCS_PER_LANG, TRAIN_DOCS = 64, 4096
#: Words of a chain at most; a longer line is several.
CHAIN_WORDS = 40
#: Hashed features, lexicon words per language.
BUCKETS, LEXICON_WORDS = 1 << 16, 4000
EPOCHS, BATCH, RATE, DECAY = 6, 512, 0.25, 1e-5
#: Words whose features a worker keeps.
WORDS_KEPT = 200_000
#: Cells (words with padding) that forward-backward works on at a time.
CELLS = 60_000
#: A word is a run of letters with their marks; numerals of any kind are none.
_ASCII_WORD, _WORD = re.compile("[A-Za-z]+"), regex.compile(r"\p{L}[\p{L}\p{M}]*")


class _Buckets(dict):
    """Feature name -> bucket; names recur, so their hashes are kept."""

    def __missing__(self, name: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[name] = bucket = xxhash.xxh32_intdigest(name) % BUCKETS
        return bucket


_BUCKETS = _Buckets()


def word_features(word: str) -> list[int]:
    """Buckets of a lower-case word's affixes and character n-grams."""
    marked = f"<{word}>"
    names = ["p" + word[:1], "p" + word[:2], "p" + word[:3], "s" + word[-1:], "s" + word[-2:], "s" + word[-3:], "s" + word[-4:]]
    names += [marked[i : i + 3] for i in range(len(marked) - 2)]
    names += [marked[i : i + 2] for i in range(len(marked) - 1)]
    return [_BUCKETS[x] for x in set(names)]


@dataclass
class Crf:
    """Weights: features x languages, lexicon x languages, start and transitions."""

    langs: list[str]
    lexicon: dict[str, int]
    features: np.ndarray
    known: np.ndarray
    start: np.ndarray
    trans: np.ndarray

    def potentials(self, words: list[str]) -> np.ndarray:
        """Summed weights of each word's features, a row a word."""
        found = [word_features(w) for w in words]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in found])[:-1]]).astype(np.int64)
        out = np.add.reduceat(self.features[[k for x in found for k in x]], begins)
        at = np.array([self.lexicon.get(w, -1) for w in words])
        out[at >= 0] += self.known[at[at >= 0]]
        return out


def forward_backward(unary: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Marginals (b, t, l) and summed transition marginals of chains padded to length t."""
    b, t, n = unary.shape
    step = np.exp(trans - trans.max())
    emit = np.exp(unary - unary.max(2, keepdims=True))
    alpha, beta = np.empty_like(emit), np.ones_like(emit)
    first = emit[:, 0] * np.exp(start - start.max())
    alpha[:, 0] = first / first.sum(1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ step) * emit[:, i]
        alpha[:, i] = x / x.sum(1, keepdims=True)
    for i in range(t - 2, -1, -1):
        x = (beta[:, i + 1] * emit[:, i + 1]) @ step.T
        x /= x.sum(1, keepdims=True)
        beta[:, i] = np.where((i + 1 < lengths)[:, None], x, 1.0)
    marginal = alpha * beta
    marginal /= marginal.sum(2, keepdims=True)
    real = np.arange(t)[None] < lengths[:, None]
    return marginal * real[..., None], alpha, beta, emit, step


def _transition_marginals(alpha, beta, emit, step, lengths) -> np.ndarray:
    t = alpha.shape[1]
    after = beta[:, 1:] * emit[:, 1:]
    both = alpha[:, :-1, :, None] * step[None, None] * after[:, :, None, :]
    both /= both.sum((2, 3), keepdims=True)
    both *= (np.arange(1, t)[None] < lengths[:, None])[..., None, None]
    return both.sum((0, 1))


def words_by_line(text: str) -> list[list[str]]:
    return [w for line in text.lower().split("\n") if (w := (_ASCII_WORD if line.isascii() else _WORD).findall(line))]


def _chains(text: str, key: int) -> list[list[str]]:
    """All lines of a text in an order drawn by ``key``; long lines are cut up."""
    lines = [line[i : i + CHAIN_WORDS] for line in words_by_line(text) for i in range(0, len(line), CHAIN_WORDS)]
    return [lines[k] for k in np.random.default_rng(abs(key) % 2**32).permutation(len(lines))]


def train(rows: list[tuple[int, str, str]]) -> Crf | None:
    """Fit to (doc_id, text, lang) rows by stochastic gradient ascent on the log-likelihood.

    All words of a document carry its language.  A tenth of the chains are
    joined from two documents' lines, so that switches are seen.
    """
    langs = sorted({lang for _, _, lang in rows})
    if not langs:
        return None
    index = {lang: i for i, lang in enumerate(langs)}
    chains = [(line, index[lang]) for key, text, lang in sorted(rows, key=lambda r: (r[0], r[1])) for line in _chains(text, key)]
    counts: list[dict[str, int]] = [{} for _ in langs]
    for line, y in chains:
        for w in line:
            counts[y][w] = counts[y].get(w, 0) + 1
    lexicon: dict[str, int] = {}
    for c in counts:
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon.setdefault(w, len(lexicon))
    n = len(langs)
    crf = Crf(langs, lexicon, np.zeros((BUCKETS, n)), np.zeros((max(1, len(lexicon)), n)), np.zeros(n), np.zeros((n, n)))
    if n == 1 or not chains:
        return crf
    vocabulary: dict[str, int] = {}
    coded = [(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in line]), np.full(len(line), y)) for line, y in chains]
    flat = [word_features(w) for w in vocabulary]
    lengths, flat = np.array([len(x) for x in flat]), np.concatenate([np.array(x) for x in flat])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    lex = np.array([lexicon.get(w, -1) for w in vocabulary])
    rng = np.random.default_rng(5)
    squares = [np.full_like(x, 1e-3) for x in (crf.features, crf.known, crf.start, crf.trans)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(coded))
        mixed = [coded[k] for k in order]
        joined = len(mixed) // 10
        for k in range(joined):
            other = mixed[-1 - k]
            mixed[k] = (np.concatenate([mixed[k][0], other[0]]), np.concatenate([mixed[k][1], other[1]]))
        for s in range(0, len(mixed), BATCH):
            batch = mixed[s : s + BATCH]
            sizes = np.array([len(x) for x, _ in batch])
            real = np.arange(sizes.max())[None] < sizes[:, None]
            ids, gold = np.zeros(real.shape, np.int64), np.zeros(real.shape, np.int64)
            ids[real], gold[real] = np.concatenate([x for x, _ in batch]), np.concatenate([y for _, y in batch])
            used, place = np.unique(ids[real], return_inverse=True)
            picks = np.concatenate([flat[begins[u] : begins[u] + lengths[u]] for u in used])
            table = np.add.reduceat(crf.features[picks], np.concatenate([[0], np.cumsum(lengths[used])[:-1]]))
            held = lex[used] >= 0
            table[held] += crf.known[lex[used[held]]]
            unary = np.zeros((*real.shape, n))
            unary[real] = table[place]
            marginal, alpha, beta, emit, step = forward_backward(unary, sizes, crf.start, crf.trans)
            wanted = np.eye(n)[gold] * real[..., None]
            error = np.zeros((len(used), n))
            np.add.at(error, place, (wanted - marginal)[real])
            steps = np.zeros((n, n))
            follows = real[:, 1:]
            np.add.at(steps, (gold[:, :-1][follows], gold[:, 1:][follows]), 1)
            by_feature = np.zeros_like(crf.features)
            np.add.at(by_feature, picks, np.repeat(error, lengths[used], axis=0))
            by_word = np.zeros_like(crf.known)
            by_word[lex[used[held]]] = error[held]
            grads = [by_feature, by_word, (wanted - marginal)[:, 0].sum(0), steps - _transition_marginals(alpha, beta, emit, step, sizes)]
            for w, g, q in zip((crf.features, crf.known, crf.start, crf.trans), grads, squares):
                g = g / len(batch) - DECAY * w
                q += g * g
                w += RATE * g / np.sqrt(q)
    return crf


class Labeller:
    """Predicts documents; the features of words are kept, up to ``WORDS_KEPT``."""

    def __init__(self, crf: Crf):
        self.crf, self.ids, self.filled, self.table = crf, {}, 0, np.zeros((1024, len(crf.langs)))

    def _ids(self, words: list[str]) -> list[int]:
        ids = self.ids
        return [ids[w] if w in ids else ids.setdefault(w, len(ids)) for w in words]

    def _fill(self) -> None:
        """Potentials of the words that are new since the last time."""
        fresh = list(itertools.islice(self.ids, self.filled, None))
        if fresh:
            if len(self.ids) > len(self.table):
                self.table = np.concatenate([self.table[: self.filled], np.zeros((2 * len(self.ids) - self.filled, self.table.shape[1]))])
            self.table[self.filled : len(self.ids)] = self.crf.potentials(fresh)
            self.filled = len(self.ids)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[np.ndarray], list[float]]:
        """Languages, scores, mean marginals, and means of the words' largest marginals; ``und`` and 0 for texts without a letter."""
        n = len(self.crf.langs)
        if len(self.ids) > WORDS_KEPT:
            self.ids.clear()
            self.filled = 0
        lines, owner = [], []
        for d, text in enumerate(texts):
            for line in words_by_line(text):
                lines.append(np.array(self._ids(line)))
                owner.append(d)
        self._fill()
        sums, count, best_of = np.zeros((len(texts), n)), np.zeros(len(texts)), np.zeros(len(texts))
        sizes = np.array([len(x) for x in lines], np.int64)
        order, owner = np.argsort(sizes, kind="stable"), np.array(owner, np.int64)
        at = 0
        while at < len(order):
            end = at + 1  # longer lines come later, so the last one sets the padding
            while end < len(order) and (end - at + 1) * sizes[order[end]] <= CELLS:
                end += 1
            pick = order[at:end]
            real = np.arange(sizes[pick].max())[None] < sizes[pick][:, None]
            unary = np.zeros((*real.shape, n))
            unary[real] = self.table[np.concatenate([lines[k] for k in pick])]
            marginal = forward_backward(unary, sizes[pick], self.crf.start, self.crf.trans)[0]
            np.add.at(sums, owner[pick], marginal.sum(1))
            np.add.at(best_of, owner[pick], marginal.max(2).sum(1))
            np.add.at(count, owner[pick], sizes[pick])
            at = end
        mean, fits = sums / np.maximum(count, 1)[:, None], np.minimum(1.0, best_of / np.maximum(count, 1))
        best = mean.argmax(1)
        langs = [self.crf.langs[b] if c else "und" for b, c in zip(best, count)]
        return langs, [min(1.0, max(0.0, float(mean[i, b]))) if count[i] else 0.0 for i, b in enumerate(best)], list(mean), fits.tolist()


def training_rows(docs: DataFrame) -> list[tuple[int, str, str]]:
    """The bounded sample: of each language, the documents that come first by a hash of doc_id, with all distinct lines of their texts.

    Texts and languages of held-out documents are not read.  One pass counts
    the languages, one takes what is under a bound on the hash that the counts
    give, somewhat more than is wanted; the rest goes on the driver.  All
    languages are learned, up to ``TRAIN_DOCS`` of them with a document each.
    Of rows that repeat a doc_id, the first text in order is taken.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    able = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    counts = able.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(TRAIN_DOCS).collect()
    if not counts:
        return []
    each = max(1, min(TRAIN_DOCS_PER_LANG, TRAIN_DOCS // len(counts)))
    enough = each + 8 * each**0.5 + 30  # eight standard deviations over
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, enough / r["count"])) for r in counts], "lang string, share double")  # TRAIN_DOCS rows at most
    lot = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    able = able.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang", lot.alias("lot"))
    lines = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    drawn = able.withColumn("text", lines).join(F.broadcast(shares), "lang").filter(F.col("lot") < F.col("share")).groupBy("lang", "doc_id", "lot").agg(F.min("text").alias("text"))
    rows = {lang: sorted(((r["lot"], r["doc_id"], r["text"]) for r in found)) for lang, found in _by_lang(drawn.collect()).items()}
    return [(i, text, r["lang"]) for r in counts for _, i, text in rows.get(r["lang"], [])[:each]]


def _by_lang(rows) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r)
    return out


def labelled(docs: DataFrame, crf: Crf | None = None, carry: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score`` and ``fit``, and of its columns those in ``carry`` (None: all).

    ``fit`` is the mean of the words' largest marginals: near 1 also for a text
    that switches between learned languages.  Without ``crf``, one is learned
    from ``docs`` (doc_id, text, lang).  Columns of these names are replaced;
    the other cases are those of ``identify``.
    """
    small_batches(docs.sparkSession)
    crf = train(training_rows(docs)) if crf is None else crf
    shared = docs.sparkSession.sparkContext.broadcast(crf)  # fixed size: BUCKETS and LEXICON_WORDS x languages
    carry = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "fit")] if carry is None else carry
    names, text = [*carry, "lang_pred", "score", "fit"], unused(docs, "text")

    def run(batches):
        labeller = Labeller(shared.value) if shared.value is not None else None
        for batch in batches:
            texts = batch.column(text)
            at = 0
            while at < len(texts):
                part, size = [], 0
                while at + len(part) < len(texts) and size < 1 << 20:
                    part.append(texts[at + len(part)].as_py() or "")
                    size += len(part[-1])
                langs, scores, _, fits = labeller.predict(part) if labeller else (["und"] * len(part), [0.0] * len(part), [], [0.0] * len(part))
                carried = [batch.column(c).slice(at, len(part)) for c in carry]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.float64())], names)
                at += len(part)
        _BUCKETS.clear()  # other tasks of this worker may be of other stages

    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType())])
    return docs.select(*carry, F.col("text").cast("string").alias(text)).mapInArrow(released(run), schema)


def identify(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each document, from its whole text.

    Without ``crf``, one is learned from ``docs`` itself (doc_id, text, lang),
    never from documents whose crc32(doc_id as text) mod 3 is 1.  The sample is
    bounded: whole texts of ``TRAIN_DOCS_PER_LANG`` documents of each language,
    of ``TRAIN_DOCS`` in all.  ``score`` is the mean marginal of the predicted language,
    ``fit`` that of the words' best ones.  Defined cases: ``und`` with
    score 0 if the text is null, empty or without a letter, or if there is
    nothing to learn from; ties go to the language first in order; a null
    doc_id is kept with a null ``held_out``; repeated rows each give a row; no
    rows give no rows; other columns are ignored.  One pass, no shuffle.
    """
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return labelled(docs, crf, ["doc_id"]).select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "lang_pred", "score", "fit")
