"""License scan, source divergence and collocations: SQL, brute force, odd inputs with a defined result."""

import collections
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.llm import collocations, divergence, licenses, oracles, queries

from test_llm import ODD, SCHEMA, SF, docs_of


def value(v):
    if v is None or v is pd.NA or v != v:
        return None
    return int(v) if isinstance(v, float) and v == int(v) else v


def rows(df, columns):
    return sorted([tuple(map(value, r)) for r in df[columns].astype(object).itertuples(index=False)], key=str)


def duck(name, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    return con.sql(oracles.ORACLES[name]).df()


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_source_divergence", "op13_collocations"])
def test_against_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck(name, duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet'").arrow())
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


RUN = {"op11_license_scan": licenses.scan_licenses, "op12_source_divergence": divergence.source_divergence, "op13_collocations": collocations.mine}


@pytest.mark.parametrize("name", RUN)
def test_odd_and_empty(spark, name):
    """Nulls, blanks, long and repeated texts, columns that clash, and no rows."""
    out = RUN[name](docs_of(spark, ODD)).collect()
    if name == "op11_license_scan":
        assert sorted((r["doc_id"] or 0, r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) for r in out) == sorted(
            (i or 0, len((t or "").split()), 0, None, "", 0.0) for i, t, *_ in ODD
        )
    elif name == "op12_source_divergence":
        assert [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in out if r["part"] == "term"] == []
        assert sorted((r["lang"], r["source"], r["item"], r["value"]) for r in out) == [("en", "a", "c", 0), ("en", "c", "a", 0)]
    else:
        assert [(r["lang"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in out] == [("de", "word word word", 19998, 20000, 19999, 20001, 999850)]
    assert RUN[name](docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("name", RUN)
def test_invented_texts(spark, name):
    """Texts of few words, with license statements at any place, phrases over line ends and long gaps, against SQL."""
    rnd = random.Random(7)
    stock = ["cc", "by", "CC", "general", "public", "license", "all", "rights", "reserved", "mit", "the", "x-y", "é", "ÀB", "a1", "z", "of", "gnu"]
    texts = [None, "", " \t\n", "CC  BY", "cc by cc by.cc\nby", "general public\nlicense", "all rights" + " é" * 3000 + " reserved all rights reserved"]
    for _ in range(120):
        words = [rnd.choice(stock) for _ in range(rnd.randrange(0, 90))]
        for _ in range(rnd.randrange(3)):
            words.insert(rnd.randrange(len(words) + 1), rnd.choice(licenses.TEMPLATES)[1])
        texts.append("".join(w + rnd.choice([" ", " ", " ", "  ", "\t", "\n", ". ", "!", "\r\n"]) for w in words))
    docs = [(i if i % 9 else None, t, rnd.choice(["en", "fr", None, ""]), rnd.choice(["s", "t", "t", "t", None]), 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, SCHEMA)
    got, want = RUN[name](df).toPandas(), duck(name, df.toArrow())
    assert len(got) > 10 and rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


def test_blocks_against_all_windows(spark):
    """Each window of each template is tried; half of the words of a template, in any order, and what is around it."""
    rnd = random.Random(3)
    templates = licenses.default_templates()
    texts = []
    for _ in range(60):
        words = list(rnd.choice(templates).words)
        rnd.shuffle(words)
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = "other"
        texts.append(" ".join(["before"] * rnd.randrange(80) + words + ["of the"] * rnd.randrange(20)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["label"], r["first"], round(r["score"], 9)) for r in licenses.license_blocks(docs, threshold=60).collect() if not r["phrase"]}
    want = set()
    for i, text in enumerate(texts):
        words = licenses.words_of(text)
        for t in templates:
            for at in range(0, len(words), t.step):
                shared = len(t.tokens & set(words[at : at + 2 * t.step]))
                if not t.phrase and shared >= t.least(60):
                    want.add((i, t.label, at, round(shared / len(t.tokens), 9)))
    assert want and got == want


def test_shares_are_exact(spark):
    n, total, v = 9 * 10**15 + 7, 4 * 10**16 + 1, 10**9 + 7
    got = spark.range(1).select(divergence._scaled(*[F.lit(x).cast("long") for x in (n, total, v)]).alias("p"), divergence._distance(F.lit(10**9 + 1).cast("long"), F.lit(3).cast("long")).alias("f")).first()
    assert (got["p"], got["f"]) == (1 + (10**9 * (n + 2)) // (total + 2 * v), (10**9 - 2) ** 2 // (10**9 + 4))


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    """A task that hands its counts on after each batch gives the same rows."""
    want = divergence.source_divergence(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    few = {}
    for held in (10**9, 0):
        monkeypatch.setattr(divergence, "HELD_COUNTS", held)
        batch = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").na.fill("").toArrow().to_batches(max_chunksize=40)
        total = collections.Counter()
        for b in divergence._task_counts(batch):
            for r in b.to_pylist():
                total[r["lang"], r["term"]] += r["in_docs"]
                for p in r["parts"]:
                    total[r["lang"], r["term"], p["source"]] += p["n"]
        few[held] = total
    assert few[0] == few[10**9] and want


def brute_collocations(docs, least=10, first=2000):
    f = collections.defaultdict(collections.Counter)
    for text, lang in docs:
        lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in often.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        scored = []
        for p, a in often.items():
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        n = sum(a for p, a in c.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize("set_to", [{}, {"RANGE_CHARS": 500}, {"AUTOMATON_PHRASES": 25}])
def test_collocations_against_brute_force(spark, monkeypatch, set_to):
    """Also with many ranges, and with many turns."""
    for name, value in set_to.items():
        monkeypatch.setattr(collocations, name, value)
    rnd = random.Random(5)
    docs = [("a a a a a a a a a a a a a b", "en"), (None, None), ("x" * 100_000, "en"), ("b " * 30_000, "fr"), ("É é é É é", "fr")]
    for _ in range(200):
        docs.append(("".join(rnd.choice("a bb Ab é c d e".split(" ")) + rnd.choice([" "] * 6 + ["\t", ". ", "\n", " , "]) for _ in range(rnd.randrange(40))), rnd.choice(["en", None, "fr"])))
    got = collocations.mine(spark.createDataFrame(docs, "text string, lang string"), first=40)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(docs, first=40)


def test_scores_are_exact(spark):
    a, l, r = 10**14 + 3, 10**14 + 9, 3 * 10**14 + 1
    got = spark.range(1).select(collocations._score(*[F.lit(x).cast("long") for x in (a, l, r)]).alias("s")).first()["s"]
    assert got == 10**6 * a * a // (l * r)


def test_guarded():
    assert collocations.guarded(" A  b.\tC,\n d") == [b"a", b"b", b"\xff", b"c", b"\xff", b"\xff", b"d"]
    assert [collocations.guarded(t) for t in ("", ".", "É.")] == [[], [b"\xff"], ["É".encode(), b"\xff"]]


def test_phrases_that_need_more_symbols_than_there_are():
    """Words are dealt to several automata; a break and an unknown word stop a phrase."""
    listed = [f"w{i} w{i + 1}" for i in range(50)] + ["w3"]
    texts = [collocations.guarded(t) for t in ("w3 w4 x w4 w5. w5 w6 w7", "w3 ", "")]
    for most in (7, 20, 1000):
        automata = collocations.Phrases.all_of(listed, most)
        assert sum((p.listed for p in automata), []) == listed and (len(automata) > 1) == (most < 100)
        found = {p.listed[i]: int(n) for p in automata for i, n in enumerate(p.counts(texts)) if n}
        assert found == {"w3 w4": 1, "w4 w5": 1, "w5 w6": 1, "w6 w7": 1, "w3": 2}


def test_sketch_handed_on_early(spark, monkeypatch):
    """Cells are the same however a task hands them on, and count each phrase at least as often as it occurs."""
    batches = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").na.fill("").toArrow().to_batches(max_chunksize=30)
    got = []
    for held in (10**9, 0):
        monkeypatch.setattr(collocations, "HELD_CELLS", held)
        parts = sorted((r for b in collocations._sketch(7, 10)(iter(batches)) for r in b.to_pylist()), key=lambda r: r["r"])
        rows = collocations.pa.RecordBatch.from_pylist(parts)
        got.append(sorted((r["cell"], r["bucket"]) for b in collocations._often(10)(iter([rows])) for r in b.to_pylist()))
    assert got[0] == got[1] and len(got[0]) > 10
