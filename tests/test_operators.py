"""Small fixtures for operators whose inputs the test tables do not have."""

import io
import random
import re
import struct
import zipfile

from pyspark.sql import functions as F

from quire.model import RUN
from quire.operators import assembly, audit, classify, index_model, joins, layout, lint, page_maps, repair, rules, sequence
from quire.sources import containers, markup
from quire.streaming import incremental


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def runs_of(spark, rows):
    return spark.createDataFrame([(k, [(t, 0, 0, None, None, i, None, m) for t, i, m in runs]) for k, runs in rows], f"id int, runs array<{RUN.simpleString()}>")


def epub() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="OEBPS/b.opf"/></rootfiles></container>')
        z.writestr("OEBPS/b.opf", '<package xmlns="urn:p" xmlns:dc="http://purl.org/dc/elements/1.1/"><metadata><dc:title>Book</dc:title></metadata><manifest><item id="x" href="t/two.html"/><item id="y" href="t/one.html"/></manifest><spine><itemref idref="y"/><itemref idref="x"/></spine></package>')
        z.writestr("OEBPS/t/one.html", '<p>a <a href="two.html#n">to two</a> <a href="http://x/">out</a></p>')
        z.writestr("OEBPS/t/two.html", "<p id='n'>b</p>")
    return out.getvalue()


def test_epub(spark, tmp_path):
    (tmp_path / "a.epub").write_bytes(epub())
    files = containers.read_binary(spark, str(tmp_path))
    parts = containers.unpack_epub(files).orderBy("part_no").collect()
    assert [p["part"] for p in parts] == ["part0000.xhtml", "part0001.xhtml"]
    assert 'href="part0001.xhtml#n"' in parts[0]["markup"] and 'href="http://x/"' in parts[0]["markup"]
    assert values(containers.metadata(files), "key", "value") == [("title", "Book")]


def test_images(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 30, 40)
    files = spark.createDataFrame([("a.png", png), ("b.txt", b"text")], "path string, content binary")
    assert values(containers.image_info(files), "path", "format", "height", "small") == [("a.png", "png", 40, True), ("b.txt", "", 0, False)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "n int, t string")
    containers.write_csv(df, str(tmp_path / "c"))
    containers.write_json(df, str(tmp_path / "j"), ["n"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2 and spark.read.json(str(tmp_path / "j")).count() == 2
    assert containers.markdown_table(df, ["n"], 1).splitlines()[-1] == "| … 1 more | |"
    assert containers.markdown_table(df, ["n"]) == "| n | t |\n| --- | --- |\n| 1 | a\\|b |\n| 2 |  |\n"


def test_parts_and_linear_text(spark, tmp_path):
    for name in ("part2.xhtml", "part1.xhtml", "note.txt"):
        (tmp_path / name).write_text("<p>x<sup>2</sup><img src='i/p.png'/></p>")
    parts = containers.list_parts(containers.read_parts(spark, str(tmp_path)))
    assert [(r["part_no"], r["path"][-11:]) for r in parts.orderBy("part_no").collect()] == [(1, "part1.xhtml"), (2, "part2.xhtml")]
    items = markup.items(parts.select(F.col("part_no").alias("n"), "markup"), "n", "markup")
    assert values(containers.linear_text(items), "text") == [("x^{2}⟦img⟧",)] * 2


def test_stream(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, "u", "<p>b</p>"), (2, "u", "<p>b</p>")], incremental.PAGES)
    pages.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second start sees nothing new
        q = incremental.write_new_items(incremental.page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(str(tmp_path / "out/items")).count() == 2


def test_stretch_and_markers(spark):
    refs = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 3, 5)], "book int, ref int, low int")
    marks = spark.createDataFrame([(1, 4, 100), (1, 5, 200), (1, 6, 300)], "book int, n int, off int")
    stretch = index_model.resolve_markers(refs, marks, ["book"])
    assert values(stretch, "ref", "a", "b") == [(1, 100, 200), (2, 200, 300), (3, 100, 200)]
    terms = spark.createDataFrame([(1, 1, 1, 150), (1, 1, 1, 120), (1, 2, 1, 700), (1, 2, 2, 320), (1, 3, 3, 250)], "book int, ref int, key_no int, off int")
    assert values(joins.in_stretch(stretch, terms, ["book"]), "ref", "off", "how") == [(1, 120, "term"), (2, 320, "near"), (3, 100, "start")]


def test_index_resolution(spark):
    """An anchor stands for the middle of its page, so page 5's middle is where the anchor of page 5 is."""
    anchors = spark.createDataFrame([(1, k * 700, k) for k in range(30)], "book int, off int, page int")
    occurrences = spark.createDataFrame([(1, "t", 7100), (1, "t", 14300)], "book int, term string, off int")
    refs = spark.createDataFrame([(1, 1, "t", 10, 10), (1, 2, "none", 5, 5), (1, 3, "t", 500, 500)], "book int, ref int, term string, low int, high int")
    out = {r["ref"]: r for r in page_maps.resolve(refs, anchors, occurrences, ["book"]).collect()}
    assert (out[1]["off"], out[1]["method"]) == (7100, "term") and out[2]["method"] == "interp" and abs(out[2]["off"] - 5 * 700) < 5 and out[3]["method"] == "none"
    labels = spark.createDataFrame([(1, 1, "x", "x"), (1, 2, "x", "x"), (1, 3, "x", "y")], "book int, ref int, label_low string, label_high string")
    lines = spark.createDataFrame([(1, 1, 0), (1, 2, 0), (1, 3, 0)], "book int, ref int, line_no int")
    assert values(index_model.remap(lines, labels, ["book"]), "ref", "text") == [(1, "x"), (3, "x—y")]


def test_parse_entries(spark):
    lines = spark.createDataFrame([(1, 0, "理性 3, 5—7"), (1, 1, None)], "book int, line_no int, text string")
    assert values(index_model.parse_entries(lines, ["book"]), "line_no", "low", "high") == [(0, 3, 3), (0, 5, 7)]


def test_pictures_formulas_and_figures(spark):
    runs = spark.createDataFrame([(1, 0, "￼", "a.png"), (1, 1, "￼", "b.png"), (1, 2, "x", None)], "p int, run_no int, t string, i string")
    known = spark.createDataFrame([("a.png", "λ")], "i string, text string")
    assert values(repair.expand_pictures(runs, known), "run_no", "t") == [(0, "λ"), (1, "￼"), (2, "x")]
    assert values(repair.expand_pictures(runs, known, keep_missing=False), "run_no", "t") == [(0, "λ"), (2, "x")]
    assert values(repair.dropped_pictures(runs, known), "i", "n") == [("b.png", 1)]
    pieces = spark.createDataFrame([(1, 0, "a", None), (1, 1, "f", "<m/>"), (1, 2, "，", None), (1, 3, "b", None)], "p int, run_no int, t string, m string")
    assert values(assembly.display_formulas(pieces, ["p"]), "run_no", "piece") == [(0, 0), (1, 1), (2, 1), (3, 2)]
    figs = spark.createDataFrame([(1, 0, "fig", ""), (1, 1, "p", "(continued)"), (1, 2, "fig", ""), (1, 3, "p", "x"), (1, 4, "fig", "")], "part int, item_no int, k string, text string")
    assert values(assembly.join_continued(figs, ["part"]).filter("fig IS NOT NULL"), "item_no", "fig") == [(0, 1), (2, 1), (4, 2)]


def test_stitched_lines(spark):
    p = spark.createDataFrame([(1, 10.0, 0.0, 5.0, 9.0, "a"), (1, 10.3, 6.0, 9.0, 9.2, "b"), (1, 24.0, 0.0, 4.0, 9.0, "c"), (1, 24.0, 5.0, 6.0, 6.0, "1")], "page int, y double, x0 double, x1 double, size double, text string")
    assert values(sequence.stitch_lines(p), "text", "x1") == [("1", 6.0), ("ab", 9.0), ("c", 4.0)]


def test_styles_and_variants(spark):
    blocks = spark.createDataFrame([("p", "16", None, 3), ("p", "32", None, None), ("q", "16", 9, None)], "style string, grid string, before int, fs int")
    table = spark.createDataFrame([("p", None, 1, 10), ("p", "16", 2, 11), ("q", None, 5, 8)], "style string, grid string, before int, fs int")
    assert values(layout.style_of(blocks, table, ["before", "fs"]), "style", "grid", "before", "fs") == [("p", "16", 2, 3), ("p", "32", 1, 10), ("q", "16", 9, 8)]
    v = spark.createDataFrame([(0.0, "。", [0.0], True, 2), (1.0, "字", [2.5], True, 2), (0.0, "words", [0.5], False, 1), (0.0, "[12]", [0.0], True, 3)], "m double, tail string, slack array<double>, j boolean, n int")
    got = v.select(layout.variant_penalty(F.col("m"), F.col("tail"), F.col("slack"), F.col("j"), F.col("n")).alias("x")).collect()
    assert [r["x"] for r in got] == [None, 2.5 + 10 + 4, 0.0, None]


def test_plans(spark):
    lines = spark.createDataFrame([("m", 0, 8), ("m", 1, 8), ("m", 2, 1), ("k", 0, 3)], "mid string, bi int, nl int")
    plan = layout.paginate(lines, ["mid"], 10)
    assert plan.groupBy("mid", "bi").agg(F.sum(F.col("hi") - F.col("lo")).alias("n")).join(lines, ["mid", "bi"]).filter("n <> nl").count() == 0
    facts = assembly.layout_facts(lines.withColumn("style", F.lit("p")), plan, spark.createDataFrame([("p", 10)], "style string, fs int"), ["mid"])
    assert facts.filter("fs = 10").count() == plan.count()
    worse = lambda df: df.groupBy("mid").agg(F.count("*").alias("n"))
    kept = assembly.retry(lambda m: m, worse, lines, lambda m: m.filter("bi = 0"), ["mid"])
    assert values(kept, "mid", "bi") == [("k", 0), ("m", 0)]
    figures = spark.createDataFrame([("m", 1)], "mid string, bi int")
    placed = spark.createDataFrame([("m", 0, 0, 0, 4, 0), ("m", 1, 1, 0, 6, 0)], "mid string, bi int, page_no int, lo int, hi int, slot int")
    assert values(assembly.blank_foot_figures(placed, figures, ["mid"], 10), "bi") == [(1,)]
    assert values(assembly.variant_stats(placed.withColumn("variant", F.col("bi"))), "variant", "n") == [(0, 1), (1, 1)]


def test_outline_and_assembly(spark):
    modules = spark.createDataFrame([("b", 1, "One"), ("b", 2, "Two")], "book string, ord int, title string")
    heads = spark.createDataFrame([("b", 1, 3, 5, "deep"), ("b", 1, 7, 2, "two")], "book string, ord int, bi int, rank int, title string")
    assert [(r["title"], r["level"]) for r in assembly.outline(modules, heads, ["book"]).orderBy("o").collect()] == [("One", 1), ("deep", 2), ("two", 2), ("Two", 1)]
    units = spark.createDataFrame([("b", 0), ("b", 1), ("b", 2)], "book string, part_no int")
    zones = spark.createDataFrame([("b", "back", 0, 0), ("b", "body", 1, 2)], "book string, zone string, lo int, hi int")
    assert [(r["part_no"], r["zone"]) for r in assembly.assemble(units, ["book"], zones).orderBy("ord").collect()] == [(1, "body"), (2, "body"), (0, "back")]


def test_audits(spark):
    rows = [(p, 50.0 + 14 * k, 40.0, 400.0, 10.0, "text of a line") for p in range(1, 5) for k in range(5)]
    rows = [r for r in rows if not (r[0] == 2 and r[1] > 90)] + [(5, 50.0, 40.0, 90.0, 10.0, "。"), (1, 120.0, 40.0, 430.0, 10.0, "pp. 12-"), (1, 134.0, 40.0, 90.0, 10.0, "13 end")]
    lines = spark.createDataFrame(rows, "page int, y double, x0 double, x1 double, size double, text string")
    assert audit.modal_pitch(lines).first()["pitch"] == 14.0
    assert values(audit.blank_feet(lines, 106.0, 14.0, spark.createDataFrame([(9,)], "page int")), "page") == [(2,)]
    assert values(audit.beyond_edges(lines), "page", "x1") == [(1, 430.0)]
    assert values(audit.lone_lines(lines), "page", "fault") == [(5, "short")]
    assert values(audit.broken_numbers(lines), "page", "fault") == [(1, "numbreak")]
    assert [r["page"] for r in audit.bad_bottoms(lines).orderBy("page").collect()] == [1, 2]
    assert audit.loose_lines(lines.withColumn("nat", F.lit(20.0)), 26.0).first()["loose"] == lines.count()
    assert audit.joiner_faults(lines.withColumn("text", F.lit("⁠a"))).count() == lines.count()


def test_lint_of_cjk(spark):
    text = "他们们说的的确确，，好 的a1234l5　но"
    df = spark.createDataFrame([(1, text), (2, "（不齐"), (3, "</i> <i>"), (4, "等…等")], "loc int, t string")
    found = {(r["loc"], r["category"]) for r in lint.findings(df, "t", list(lint.PATTERNS)).collect()}
    assert {(1, "dup-char"), (1, "punct-run"), (1, "space-in-cjk"), (1, "digit-lookalike"), (1, "cyrillic"), (3, "adjacent-format"), (4, "single-ellipsis")} <= found
    assert df.filter("loc = 2").select(lint.unbalanced(F.col("t")).alias("x")).first()["x"] == ["（）"]
    assert lint.known_wrong(df, spark.createDataFrame([("们们",)], "wrong string"), "t").first()["n"] == 1


def test_runs(spark):
    df = runs_of(spark, [(1, [("[1]", None, None), ("text", None, None)]), (2, [("he said ", None, None), ("，", None, None), (" ok", None, None)])])
    anchored = df.withColumn("runs", F.transform("runs", lambda r: F.struct(r["t"], r["b"], r["s"], r["h"], F.lit("n1").alias("a"), r["i"], r["c"], r["m"])))
    assert [r["x"] for r in anchored.orderBy("id").select(classify.is_note_start(F.col("runs")).alias("x")).collect()] == [True, False]
    fixed = df.filter("id = 2").select(repair.fix_run_edges(F.col("runs")).alias("x")).first()["x"]
    assert [r["t"] for r in fixed] == ["he said", "，", " ok"]
    out = rules.fix_item_runs(df, [("te", "T")]).orderBy("id").collect()
    assert [r["t"] for r in out[0]["runs"]] == ["[1]", "Txt"] and out[0]["hits"] == [1]


def test_family_chain_and_heads(spark):
    one = lambda f, t: spark.createDataFrame([(t,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]
    assert one(lambda t: repair.family_chain(t, [("", "ῥ")], [], [("Hegcl", "Hegel")], True), "Hegcl  理性＞ 1 7 8 1 —————") == "Hegel ῥ 理性》 1781 ——"
    assert one(lambda t: repair.head_fit(t, 5000), "论理性——其批判") == "论理性"
    assert one(lambda t: repair.head_fit(t, 4000), "一二三四五六七") == "一二……"
    assert one(lambda t: repair.restore_words(t, [("ab", "x"), ("abc", "y")]), "ab abc abd (ab)") == "x y abd (x)"
    assert [(p["t"], p["hit"]) for p in one(lambda t: repair.split_spans(t, "url"), "见 http://a.b/c。后")] == [("见 ", False), ("http://a.b/c", True), ("。后", False)]
    assert one(classify.is_separator, "* 　* *") is True and one(classify.page_numbers, "见12页、第3、45") == ["45"]
    assert one(classify.legal_breaks, "中文，好 a") == [1, 3, 5]


def test_missing_pieces_by_brute_force(spark):
    """pieces within texts and across them, over empty and short ones, with any white space and characters beyond 16 bits."""
    rng = random.Random(14)
    texts = ["".join(rng.choices("ab \n　\U0001f600", k=rng.choice([0, 1, 3, 40]))) for _ in range(300)] + [None, "a" * 3_000_000]
    items = ["".join(rng.choices("ab \U0001f600", k=rng.choice([0, 5, 12, 70]))) for _ in range(40)] + ["ab\U0001f600" * 40, "a" * 24 + "zz", None]
    bare = lambda t: re.sub("\\s", "", t or "")
    whole, want = "".join(map(bare, texts)), {}
    items += ["a" * 12 + "z" * 12, *(whole[k : k + 90] + "z" * 12 for k in range(0, 900, 30))]
    for i, t in enumerate(map(bare, items)):
        cut = [t[k : k + 12] for k in range(0, len(t) - 11, 12)]
        if cut:
            gone = sum(p not in whole for p in cut)
            want[i] = (len(cut), gone, gone > 0.6 * len(cut))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = joins.missing_pieces(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), docs)
    assert {r.item_id: (r.pieces, r.absent, r.flagged) for r in out.collect()} == want
    assert any(gone not in (0, n) for n, gone, _ in want.values())


def test_missing_pieces_over_sparse_ids(spark):
    """what follows a text may come from more than two ranges of ids after it."""
    last = spark.createDataFrame([(1_000_000, "b"), (2_000_000, "c"), (3_000_000, "defghijklmn")], "doc_id long, text string")
    docs = spark.range(150_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).union(last)
    items = spark.createDataFrame([(1, "xxxxxxxxxbcd"), (2, "xxxxxxxxxbce")], "item_id long, text string")
    assert {r.item_id: r.absent for r in joins.missing_pieces(items, docs).collect()} == {1: 0, 2: 1}


def test_run_edges_are_looked_at_once(spark):
    """runs are made once for each line; spaces at their borders go as rules over plain lists say."""
    from quire import registry

    plan = registry.queries()["t8_run_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(array(struct(") == 1
    rng, closers = random.Random(18), repair.CLOSERS
    lists = [[("".join(rng.choices(" a,。中'(", k=rng.choice([0, 1, 1, 2, 3]))), rng.choice([None, None, None, "p.png"])) for _ in range(rng.randint(0, 6))] for _ in range(1500)]

    def plain(rs):
        out = []
        for k, (t, i) in enumerate(rs):
            before, after = rs[k - 1][0] if k else None, rs[k + 1][0] if k + 1 < len(rs) else None
            apart = not t.strip(" ") and None not in (before, after) and re.search("[A-Za-z0-9À-ɏ.,;:!?)\\]’']$", before) and re.search("^[A-Za-z0-9À-ɏ(\\[‘“\"]", after)
            bare = t.lstrip(" ")
            if bare and bare[0] in closers and k and not apart:
                t = bare
            if after and after[0] in closers and not apart and i is None:
                t = t.rstrip(" ")
            out += [(t, i)] * (t != "")
        return out

    df = spark.createDataFrame([(k, [(t, 0, 0, None, None, i, None, None) for t, i in rs]) for k, rs in enumerate(lists)], "k int, r array<struct<t:string,b:int,s:int,h:string,a:string,i:string,c:string,m:string>>")
    got = df.select("k", repair.fix_run_edges(F.col("r")).alias("x")).orderBy("k").collect()
    assert [[(r["t"], r["i"]) for r in row.x] for row in got] == [plain(rs) for rs in lists]
