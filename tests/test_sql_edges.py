"""Queries agree with their SQL on rows that the smallest tables do not hold."""

import functools
import operator

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quire import registry


def agree(spark, folder, name, **tables):
    """The query's rows on these tables, which are also those of its SQL."""
    con = duckdb.connect()
    for table, rows in tables.items():
        pq.write_table(pa.Table.from_pylist(rows), folder / f"{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).itertuples(index=False)))
    got = rows(registry.queries()[name](spark, str(folder)).toPandas())
    assert got == rows(con.sql(registry.oracle_sql()[name]).df())
    return got


@pytest.mark.parametrize("name", ["p7_page_headings", "p11_visible_text"])
def test_references_without_semicolon(spark, tmp_path, name):
    """``&amp`` without its semicolon is text to the SQL; with it, it is a character."""
    agree(spark, tmp_path, name, pages=[{"page_id": k, "html": f"<html><head><title>x</title></head><body><h1>{h}</h1><p>b &amp; c</p></body></html>"} for k, h in enumerate(("a &amp;&amp", "a &amp; b", "&ampb", "&copy 1"))])


def test_heading_of_a_letter_alone(spark, tmp_path):
    """A line that is only a letter and a point gets its gap, with or without spaces after it."""
    lines = ["x"] * 6 + ["A.", "x", "A.", "x", "A.", "A.", "A.", "A.", "A. ", "x"] + ["x"] * 6 + ["A. b", "A.", "Ab."]
    got = agree(spark, tmp_path, "t12_regap_heading", documents=[{"doc_id": 1, "lang": "en", "source": "s", "text": "\n".join(lines)}])
    assert ("6", "1", "A.\u2002") in got


def test_rounding_as_in_sql(spark):
    """Halves go by the product with the power of ten, not by the number's spelling."""
    from quire.plans.index_queries import _rounded

    values = [1.005, 78.15, -78.15, 0.285, 2.5, -2.5, 0.0, 1.45, 8.345]
    for digits in (0, 1, 2):
        got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(_rounded("v", digits)).collect()]
        assert got == [duckdb.execute("SELECT round(?::DOUBLE, ?)", [v, digits]).fetchone()[0] for v in values]


def test_pages_to_the_last_bit():
    """Sums go anchor by anchor and powers are the C library's, so pages are those of plain arithmetic, however many are asked at once."""
    import math

    import numpy as np

    from quire.operators import page_maps as PM

    def plain(values):
        return functools.reduce(operator.add, values, 0.0)  # ``sum`` carries the rounding errors along

    def line(s):
        total = plain(w for _, _, w in s)
        mx, my = plain(w * x for x, _, w in s) / total, plain(w * y for _, y, w in s) / total
        b = plain(w * (x - mx) * (y - my) for x, y, w in s) / plain(w * (x - mx) * (x - mx) for x, _, w in s)
        return my - b * mx, b, mx, my

    def page(xs, ys, dens, at):
        near = sorted((abs(x - at), x, y) for x, y in zip(xs, ys))[:10]
        s = [(x - at, y, math.pow(1 - math.pow(d / (near[-1][0] + 1.0), 3), 3)) for d, x, y in near]
        for _ in range(3):
            a, b, *_ = line(s)
            miss = [abs(y - a - b * x) for x, y, _ in s]
            m = sorted(miss)[len(s) // 2]
            s = [(x, y, w * math.pow(max(0.0, 1 - math.pow(e / (6 * m + 0.05), 2)), 2)) for (x, y, w), e in zip(s, miss)]
            s = [p for p in s if p[2] > 0]
        a, b, mx, my = line(s)
        if not 0.2 / dens < b < 5 / dens:
            return near[0][2] + (at - near[0][1]) / dens
        k = min(1.0, (max(x for x, *_ in s) - min(x for x, *_ in s)) / (8 * dens))
        return my - (k * b + (1 - k) / dens) * mx

    rnd = np.random.default_rng(3)
    x = np.sort(rnd.integers(0, 30_000, 40).astype(float))
    y = np.sort(np.floor(x / 650 + rnd.normal(0, 0.4, 40))) + 0.5
    at, module = rnd.integers(0, 30_000, 500).astype(float), PM.Map(x, y, 650.0, 30_000)
    want = [page(x.tolist(), y.tolist(), 650.0, v) for v in at.tolist()]
    assert module.pages(at).tolist() == want
    assert [module.pages(at[k : k + 1])[0] for k in range(50)] == want[:50]


def test_questions_to_modules_that_go_on():
    """Modules and their questions may be cut anywhere when a task takes rows in pieces."""
    from quire.operators import page_maps as PM

    rows = []
    for book in (1, 2, 3):
        rows.append((book, 0, 0, 0, 0.0, 0.0, 700.0, 9000.0, 0.0, None, None))
        rows += [(book, 0, 0, 1, 700.0 * k, k + 0.5, *[None] * 5) for k in range(12)]
        rows += [(book, 0, 0, 2, 100.0 * k, how, *[None] * 5) for k in range(9) for how in (0.0, 1.0)]
    names = ["book", "module", "part", "kind", "x", "y", "dens", "length", "start", "line", "slope"]
    types = [pa.int64()] * 4 + [pa.float64()] * 7
    table = lambda some: pa.table([pa.array(c, t) for c, t in zip(zip(*some), types)], names)
    schema = pa.schema([("book", pa.int64()), ("module", pa.int64()), ("page_asked", pa.bool_()), ("asked", pa.float64()), ("found", pa.float64())])
    whole, _ = PM._answers(table(rows), ["book"], ["book", "module", "part"], schema)
    assert whole.num_rows == 54 and whole.column("found").null_count < 54
    for size in (1, 5, 17, 40):
        got, left = [], table(rows[:1]).slice(0, 0)
        for a in range(0, len(rows), size):
            told, left = PM._answers(pa.concat_tables([left, table(rows[a : a + size])]), ["book"], ["book", "module", "part"], schema)
            got += told.to_pylist()
        assert got == whole.to_pylist()


def test_longest_chain_looks_back_only_as_far_as_it_may_matter():
    """The same rows as from looking at all rows before each one, and a long module in time that grows with it."""
    import time

    import numpy as np

    from quire.operators import page_maps as PM

    def plain(at, page, module):
        length, before = np.ones(len(at), int), np.full(len(at), -1)
        for j in range(1, len(at)):
            forward, turned = at[j] - at[:j], page[j] - page[:j]
            most = forward / PM.DENSE_MIN + PM.SLACK + PM.CHAPTER_GAP * (module[:j] != module[j])
            reaches = np.where((turned >= 0) & (turned <= most) & (turned >= forward / PM.DENSE_MAX - 1.0), length[:j], 0)
            if reaches.any():
                before[j] = reaches.argmax()
                length[j] = reaches[before[j]] + 1
        out, j = [], int(length.argmax()) if len(at) else -1
        while j >= 0:
            out.append(j)
            j = int(before[j])
        return out[::-1]

    rnd = np.random.default_rng(9)
    for n in (0, 1, 5, 60, 400, 1500):
        for noise in (0, 3, 40):
            at = np.sort(rnd.integers(0, 100 * n + 1, n).astype(float))
            page = np.floor(at / 700 + rnd.integers(-noise, noise + 1, n) * (rnd.random(n) < 0.4))
            order = np.lexsort((page, at))
            rows = at[order], page[order], np.floor(at[order] / 9000)
            assert PM.longest_chain(*rows) == plain(*rows)
    at = np.arange(60_000) * 60.0
    began = time.perf_counter()
    assert len(PM.longest_chain(at, np.floor(at / 700), np.zeros(len(at)))) == len(at)
    assert time.perf_counter() - began < 5


def test_modules_without_an_anchor(spark, tmp_path):
    """Pages pass in modules without a long word; the anchors after them count, too."""
    words = ["considerable" if k < 3000 or k >= 11_500 else "a" for k in range(13_000)]
    got = agree(spark, tmp_path, "i14_page_errors", documents=[{"doc_id": k, "text": " ".join(words[: len(words) - k])} for k in range(3)])
    assert len(got) == 3


def test_marks_are_counted_in_one_rewrite(spark, tmp_path):
    """A line is rewritten once, not for each mark and filter; pairs are those of the SQL, in nested and empty lines, too."""
    lines = ["", "(", "()", ")) (", "a (b) c)", "（", "（)", "(）（", "no marks", "(" * 40 + ")" * 39]
    got = agree(spark, tmp_path, "d5_unbalanced", documents=[{"doc_id": k, "lang": "en", "source": "s", "text": t} for k, t in enumerate(["\n".join(lines), "x\n" + "\n".join(lines), "", None])])
    assert len(got) > 10
    plan = registry.queries()["d5_unbalanced"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2  # of even and odd lines


def test_every_long_word_is_resolved(spark, tmp_path):
    """The index has a reference for each long word, at every position."""
    texts = [" ".join("considerable" if k % 5 == 0 else f"w{k % 3}" if k % 2 else f"longword{k % 17}" for k in range(n)) for n in (1, 40, 300)]
    pq.write_table(pa.Table.from_pylist([{"doc_id": i, "text": t} for i, t in enumerate(texts)]), tmp_path / "documents.parquet")
    got = registry.queries()["i9_resolve_index"](spark, str(tmp_path)).toPandas().groupby("doc_id")["n"].sum().to_dict()
    assert got == {i: sum(len(w) >= 8 for w in t.split(" ")) for i, t in enumerate(texts)}


def test_references_meet_their_terms_once(spark):
    """What terms give is made once, though it decides which references ask the maps and is in the result, too."""
    from quire.operators import page_maps as PM

    refs = spark.createDataFrame([(1, 1, "a", 3, 3), (1, 2, "b", 4, 4), (1, 3, "c", 2, 3)], "book int, ref int, term string, low int, high int")
    anchors = spark.createDataFrame([(1, 700.0 * k, k) for k in range(9)], "book int, off double, page int")
    occurrences = spark.createDataFrame([(1, "a", 2200.0), (1, "b", 10.0), (1, "b", 2900.0)], "book int, term string, off double")
    out = PM.resolve(refs, anchors, occurrences, ["book"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") < 5
    assert {r["ref"]: (r["method"], r["off"]) for r in out.collect() if r["ref"] < 3} == {1: ("term1", 2200.0), 2: ("term", 2900.0)}


def test_only_pictures_meet_their_transcriptions(spark, tmp_path, monkeypatch):
    """other words stay with their line; lines without pictures, with many, and empty ones are those of the SQL."""
    from quire.plans import runs_queries

    given = []
    monkeypatch.setattr(runs_queries.R, "expand_pictures", lambda runs, *a, real=runs_queries.R.expand_pictures: given.append(runs) or real(runs, *a))
    lines = ["", " ", "one two", "abcdefgh", "zbcdefgh x ABCDEFGH  zbcdefgh", "abcdefgh " * 30 + "y", "x " * 50 + "Zbcdefgh"]
    agree(spark, tmp_path, "p16_expand_pictures", documents=[{"doc_id": k, "lang": "en", "source": "s", "text": t} for k, t in enumerate(["\n".join(lines), None, "\n", "zbcdefgh"])])
    assert given and given[0].filter("i IS NULL").count() == 0
