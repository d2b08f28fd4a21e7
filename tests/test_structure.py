"""Literal fixtures of structural corrections, notes and their ways back, and places in plans."""

import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.model import RUN
from quire.operators import assembly, index_model, layout, lint, page_maps, rules
from quire.operators import structure as S
from quire.sources import markup as M

NONE = {f.name: None for f in RUN.fields} | {"b": 0, "s": 0}


def run(t, **more):
    return NONE | {"t": t} | more


def item(*runs, k="p", **more):
    return dict.fromkeys(S.ITEM_FIELDS) | {"k": k, "cls": "", "runs": [r if isinstance(r, dict) else run(r) for r in runs]} | more


def texts(book):
    return [S.text_of(x) for x in book.items]


def book(*items):
    return S.Items([x if isinstance(x, dict) else item(x) for x in items])


def test_moves():
    b = book("one", "two", "three")
    assert b.move("three", "one") == 1 and texts(b) == ["three", "one", "two"]
    assert b.move("t", "one") == 0 and b.move("one", "x") == 0 and texts(b) == ["three", "one", "two"]  # two sources, no destination
    b = book("Table 1", item(k="table", rows=[["a"]]), "text", "after this")
    assert b.movetab("Table 1", "after") == 1 and [x["k"] for x in b.items] == ["p", "p", "p", "table"] and texts(b)[:3] == ["text", "after this", "Table 1"]
    b = book(item("a", run("￼", i="p.png"), "b"))
    assert b.imgout("p.png", "after") == 1 and [x["k"] for x in b.items] == ["p", "img"] and texts(b)[0] == "ab" and b.items[1]["src"] == "p.png"


def test_marks():
    mark = run("[3]", s=1, h="#n3", a="r3")
    b = book(item("x", mark, "y"), item(run("(7)", h="#a")))
    assert b.renum("2", "p#n{n}", "r{n}") == 1 and b.items[0]["runs"][1] | {} == mark | {"t": "[5]", "h": "p#n5", "a": "r5"}
    assert b.shift("7", "1") == 1 and texts(b)[1] == "(8)" and b.shift("9", "1") == 0
    assert b.relink("x", "[5]", "[6]", "#q", "z") == 1 and b.items[0]["runs"][1]["h"] == "#q"
    assert b.addmark("x", "y", "[9]", "#n9", "r9") == 1 and texts(b)[0] == "x[6]y[9]" and b.items[0]["runs"][-1]["s"] == 1
    assert b.href("(8", "(8)", "#new") == 1 and b.items[1]["runs"][0]["h"] == "#new"
    assert b.anchor("(8", "here") == 1 and b.anchor("(8", "there") == 0 and b.items[1]["runs"][0]["a"] == "here"
    assert b.noteback("(8)", "#back") == 1 and b.items[1]["runs"][0]["h"] == "#back"
    b = book("ends with text12")
    assert b.pgno("text12") == 1 and [(r["t"], r["c"]) for r in b.items[0]["runs"]] == [("ends with text", None), ("〔12〕", "pgno")]
    b = book("a [1] b [1] c [2]", item("[1] first", cls="note"))
    assert b.notelink("note", "p1") == 1
    assert [(r["t"], r["h"]) for r in b.items[0]["runs"]] == [("a ", None), ("[1]", "p1#nl-note1"), (" b [1] c [2]", None)]
    assert [(r["t"], r["h"], r["a"]) for r in b.items[1]["runs"]] == [("[1]", "p1#nl-ref1", "p1#nl-note1"), (" first", None, None)]


def test_paragraphs_and_tables():
    b = book(item("note one", run(" [2] note two", b=1)), "next")
    assert b.split("note", "[2]", "[2]", "#r", "n2") == 1 and texts(b) == ["note one", "[2] note two", "next"] and b.items[1]["runs"][0]["h"] == "#r"
    assert b.join("two", "next") == 1 and texts(b) == ["note one", "[2] note twonext"]
    assert b.para("[2]", "note t") == 1 and texts(b) == ["note one", "[2]", "note twonext"]
    assert b.head("note one", "2") == 1 and (b.items[0]["k"], b.items[0]["lvl"]) == ("h", 2) and b.headre("note", "3") == 1
    b = book("a  b", "1　　2", "x")
    assert b.paratable("a", "2") == 1 and b.items[0]["rows"] == [["a", "b"], ["1", "2"]] and b.cell("1", "1", "2", "5") == 1 and b.items[0]["rows"][1] == ["1", "5"]
    b = book(item("中(a", run("b(中)", b=1), "c) (x)"))
    assert b.fwparen("[一-鿿]") == 2 and texts(b) == ["中（ab（中）c） (x)"] and [len(r["t"]) for r in b.items[0]["runs"]] == [3, 4, 6]


def test_operations_of_parts(spark):
    fields = "part long, item_no int, k string, cls string, id string, lvl int, src string, rows array<array<string>>"
    rows = [(p, i, "p", "", None, None, None, None, [tuple(run(t).values())]) for p in (1, 2) for i, t in enumerate(("b", "a", "c"))]
    items = spark.createDataFrame(rows, f"{fields}, runs array<{RUN.simpleString()}>")
    out = S.apply_operations(items, [("1", "MOVE", ["a", "b"]), ("*", "HEAD", ["c", "1"]), ("2-5", "JOIN", ["b", "a"])])
    got = sorted((r["part"], r["item_no"], r["k"], "".join(x["t"] for x in r["runs"]), r["hits"]) for r in out.collect())
    assert got == [(1, 0, "p", "a", [1, 1, 0]), (1, 1, "p", "b", None), (1, 2, "h", "c", None), (2, 0, "p", "ba", [0, 1, 1]), (2, 1, "h", "c", None)]
    with pytest.raises(ValueError):
        S.apply_operations(items, [("*", "NONE", [])])


def test_patterns_over_runs():
    runs = [run("ab", b=1), run("￼", i="p"), run("cd1"), run("2")]
    out, hits = rules.fix_runs(runs, [rules.Pattern("b.c", "<>"), rules.Pattern("([a-z])([0-9]+)", "\\2\\1"), ("zz", "y")])
    assert [(r["t"], r["b"], r["i"]) for r in out] == [("a<>", 1, None), ("12d", 0, None)] and hits == [1, 1, 0]


@pytest.mark.parametrize("markup, want", [
    ("<aside epub:type='footnote' id='n1'><p>[1]text<a href='p#r1'>返回正文</a></p></aside>", [("note", [("[1]", "p#r1", "n1"), ("text", None, None)])]),
    ("<div class='footnote'><p><span id='x'></span>2. text <a href='#r'>back</a></p></div>", [("note", [("2.", "#r", "x"), (" text ", None, None)])]),
    ("<p>a<a class='duokan-footnote' id='ref12' href='#n'><img src='i.png'/></a>b</p>", [("p", [("a", None, None), ("12", "#n", "ref12"), ("b", None, None)])]),
    ("<p>a<a href='#n'>。［8］</a></p>", [("p", [("a。", None, None), ("［8］", "#n", None)])]),
    ("<pre>x\n\n y\n</pre><p>z</p>", [("p", [("x", None, None)]), ("p", [(" y", None, None)]), ("p", [("z", None, None)])]),
    ("<div class='toc'><p>gone</p></div><p>kept</p>", [("p", [("kept", None, None)])]),
])
def test_notes_and_dialects(markup, want):
    got = [(i["k"], [(r["t"], r["h"], r["a"]) for r in i["runs"]]) for i in M.read_items(markup)]
    assert got == want


def test_wide_parens_by_a_stack(spark):
    one = lambda t, **k: spark.createDataFrame([(t,)], "t string").select(X.wide_parens(F.col("t"), **k).alias("x")).first()["x"]
    assert one("(x(中)y)") == "（x（中）y）" and one("中(a) (b) )(") == "中（a） (b) )("
    assert one("中(a) 中(1-p)", inside="[a-z]{1}$") == "中（a） 中（1-p）" and one("中(a) 中(1-2)", inside="[a-z]") == "中（a） 中(1-2)"
    depth = spark.createDataFrame([("a(b[c)d]e)f",)], "t string").select(X.bracket_depth(F.col("t")).alias("x")).first()["x"]
    assert depth == [0, 1, 1, 2, 2, 2, 2, 1, 1, 0, 0]


def test_contexts_of_findings(spark):
    df = spark.createDataFrame([(1, "abc,, def,, ghi")], "loc int, t string")
    assert [(r["nth"], r["match"], r["context"]) for r in lint.findings(df, "t", ["punct-run-ascii"], 4).orderBy("nth").collect()] == [(0, ",,", "abc,, def"), (1, ",,", " def,, ghi")]


def test_page_of(spark):
    lines = spark.createDataFrame([(1, 0, 0, 0), (1, 0, 1, 10), (1, 1, 0, 0)], "doc int, bi int, line_no int, start int")
    plan = spark.createDataFrame([(1, 0, 0, 1, 0), (1, 0, 1, 2, 1), (1, 1, 0, 1, 1)], "doc int, bi int, lo int, hi int, page_no int")
    asked = spark.createDataFrame([(1, 0, 3), (1, 0, 10), (1, 1, 5)], "doc int, bi int, at int")
    assert sorted((r["bi"], r["at"], r["page_no"]) for r in S.page_of(asked, lines, plan, ["doc"]).collect()) == [(0, 3, 0), (0, 10, 1), (1, 5, 1)]


def test_maps_of_modules(spark):
    """Three modules, the second with one anchor: the series' line; places of pages; terms by rarity; a term where no map is."""
    pages = [(1, 1, k * 700, k) for k in range(20)] + [(1, 2, 0, 20)] + [(1, 3, k * 700, 40 + k) for k in range(10)]
    anchors = spark.createDataFrame(pages, "book int, module int, off int, page int")
    modules = spark.createDataFrame([(1, 1, 14_000), (1, 2, 14_000), (1, 3, 7_000), (2, 1, 100)], "book int, module int, length int")
    occurrences = spark.createDataFrame([(1, 1, "t", 7_000), (1, 1, "t", 100), (1, 3, "u", 1_400), (2, 1, "once", 5), (2, 1, "twice", 5), (2, 1, "twice", 9)], "book int, module int, term string, off int")
    refs = [(1, 1, ["x"], 5, 5), (1, 2, ["x"], 45, 45), (1, 3, ["x"], 30, 30), (1, 4, ["x"], 900, 900), (1, 5, ["t"], 3, 5), (1, 6, ["t", "u"], 42, 42), (1, 7, ["t"], 10, 10), (2, 8, ["once"], 3, 3), (2, 9, ["twice"], 3, 3), (2, 10, None, 3, 3)]
    out = page_maps.resolve(spark.createDataFrame(refs, "book int, ref int, terms array<string>, low int, high int"), anchors, occurrences, ["book"], modules)
    got = {r["ref"]: (r["module"], r["off"] and round(r["off"]), r["method"]) for r in out.collect()}
    assert got[1][0::2] == (1, "interp") and got[2] == (3, 3_500, "interp") and got[3][0::2] == (2, "interp")
    assert {k: got[k] for k in (4, 6, 7, 8, 9, 10)} == {4: (None, None, "none"), 6: (3, 1_400, "term1"), 7: (1, 7_000, "term"), 8: (1, 5, "term1"), 9: (None, None, "none"), 10: (None, None, "none")}
    ranged = next(r for r in out.collect() if r["ref"] == 5)
    assert (ranged["module"], ranged["method"]) == (1, "range") and ranged["off"] == pytest.approx(2.55 * 700, abs=5) and ranged["upto"] == pytest.approx(5.45 * 700, abs=5)


def test_anchors_are_dealt_once(spark):
    """pages and places meet in one shuffle; repeated pages count once, places as often as they occur."""
    rng = np.random.default_rng(23)
    draw = lambda most: [(int(rng.integers(2)), f"t{rng.integers(12)}", int(rng.integers(9))) for _ in range(most)] + [(None, "t1", 1), (1, None, 1)]
    refs, occurrences = draw(60), draw(60) + [(0, "t99", 1)]
    want = []
    for key in {r[:2] for r in refs if None not in r}:
        pages, offs = sorted({p for *k, p in refs if tuple(k) == key}), sorted(o for *k, o in occurrences if tuple(k) == key)
        want += [(*key, p, o) for p, o in zip(pages, offs) if len(pages) == len(offs)]
    got = index_model.collect_anchors(spark.createDataFrame(refs, "book int, term string, page long"), spark.createDataFrame(occurrences, "book int, term string, off int"), ["book"])
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "bigint", "int"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want
    plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_resolution_by_modules(spark):
    anchors = spark.createDataFrame([(1, 1 + k // 20, (k % 20) * 700, k) for k in range(40)], "book int, module int, off int, page int")
    modules = spark.createDataFrame([(1, 1, 14_000), (1, 2, 14_000)], "book int, module int, length int")
    occurrences = spark.createDataFrame([(1, 1, "t", 7_100), (1, 2, "t", 7_100), (1, 2, "rare", 350)], "book int, module int, term string, off int")
    refs = spark.createDataFrame([(1, 1, ["t", "rare"], 30, 30, False), (1, 2, ["rare", "t"], 20, 20, False), (1, 3, ["none"], 25, 27, False), (1, 4, ["t"], 5, 5, True)], "book int, ref int, terms array<string>, low int, high int, skip boolean")
    out = {r["ref"]: (r["module"], r["method"]) for r in page_maps.resolve(refs, anchors, occurrences, ["book"], modules).collect()}
    assert out == {1: (2, "term"), 2: (2, "term1"), 3: (2, "range"), 4: (None, "skip")}


def test_labels_to_a_fixpoint(spark):
    """An index before the text grows by its labels and moves the pages after it; the text is laid out once."""
    lines = [(1, 0, k, f"term{k} ?") for k in range(12)] + [(1, 1, k, "x" * 50) for k in range(40)] + [(2, 0, 0, "a ?"), (2, 1, 0, "y")]
    refs = [(1, 0, k, k, len(f"term{k} "), len(f"term{k} ?")) for k in range(12)] + [(2, 0, 0, 0, 2, 3)]
    places = [(1, k, 1, 3 * k, 3 * k + (k % 2)) for k in range(12)] + [(2, 0, 1, 0, 0)]
    laid = []

    def layout(df):
        laid.append(sorted({(r["book"], r["module"]) for r in df.collect()}))
        w = Window.partitionBy("book", "module").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("page", F.floor(F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)) / 60))

    given = [spark.createDataFrame(x, y) for x, y in ((lines, "book int, module int, line_no int, text string"), (refs, "book int, module int, line_no int, ref int, start int, end int"), (places, "book int, ref int, to_module int, to_line int, last_line int"))]
    out = index_model.remap_to_fixpoint(*given, layout, ["book"]).collect()

    def plain():
        texts = [t for b, m, _, t in lines if (b, m) == (1, 0)]
        while True:
            at, pages = 0, 0
            for t in texts:
                pages, at = at // 60 + 1, at + len(t) + 1
            label = lambda k: str(pages + k * 51 // 60 + 1)
            made = [f"term{k} " + (label(3 * k) if label(3 * k) == label(3 * k + k % 2) else f"{label(3 * k)}—{label(3 * k + 1)}") for k in range(12)]
            if made == texts:
                return made
            texts = made

    assert [r["text"] for r in sorted(out, key=lambda r: r["line_no"]) if (r["book"], r["module"]) == (1, 0)] == plain()
    assert {r["text"] for r in out if r["book"] == 2} == {"a 2", "y"} and all(r["converged"] for r in out)
    assert laid[0] == [(1, 0), (1, 1), (2, 0), (2, 1)] and all(x == [(1, 0)] for x in laid[2:]) and laid[1] == [(1, 0), (2, 0)]
    short = index_model.remap_to_fixpoint(*given, layout, ["book"], rounds=1).collect()
    assert {(r["book"], r["module"]): r["converged"] for r in short} == {(1, 0): False, (1, 1): True, (2, 0): False, (2, 1): True} and {r["rounds"] for r in short} == {1}


def test_text_without_references_is_dealt_once(spark):
    """rounds shuffle labels and index lines; the text after them only once, to tell its lines from those with references."""
    rng = np.random.default_rng(24)
    body = [(1, 1, k, rng.bytes(2000).hex()) for k in range(400)]
    lines = [(1, 0, k, f"term{k} ?") for k in range(40)] + body
    refs = [(1, 0, k, k, len(f"term{k} "), len(f"term{k} ?")) for k in range(40)]
    places = [(1, k, 1, 9 * k, 9 * k) for k in range(40)]

    def layout(df):
        w = Window.partitionBy("book", "module").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
        return df.select("book", "module", "line_no", F.length("text").alias("n")).withColumn("page", F.floor(F.coalesce(F.sum(F.col("n") + 1).over(w), F.lit(0)) / 60))

    def written():
        sc = spark.sparkContext
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()) if stages.apply(k).stageId() > last)

    given = [spark.createDataFrame(x, y) for x, y in ((lines, "book int, module int, line_no int, text string"), (refs, "book int, module int, line_no long, ref int, start int, end int"), (places, "book int, ref int, to_module int, to_line int, last_line int"))]
    last = spark.sparkContext.statusTracker().getJobInfo(max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1))
    last = max(last.stageIds) if last else -1
    df = index_model.remap_to_fixpoint(*given, layout, ["book"])
    out = df.collect()
    assert df.schema["line_no"].dataType.simpleString() == "int" and {r["rounds"] for r in out} <= set(range(3, 9)) and all(r["converged"] for r in out)
    assert sorted(tuple(r[:4]) for r in out if r["module"] == 1) == body
    time.sleep(1)
    assert 0 < written() < 2 * sum(len(t) for *_, t in body)


def test_hyphens_and_plates(spark):
    df = spark.createDataFrame([(1, "一二三四五六 extraordinary words"), (2, "short"), (3, None)], "bi int, t string")
    out = {r["bi"]: r["t"] for r in layout.hyphenated(df, [], "t", 10.0, lambda w: [2, 3, 5, 11]).collect()}
    assert out == {1: "一二三四五六 extra\u00adordinary words", 2: "short", 3: None}
    blocks = spark.createDataFrame([(1, 0, 6, False), (1, 1, 8, True), (1, 2, 3, False)], "book int, bi int, nl int, floating boolean")

    def plan(b):
        rows = [(r["bi"], r["floating"]) for r in b.orderBy("bi").collect()]
        made = [(1, 0, 0, 0, 6, 0)] + ([(1, 1, 1, 0, 8, 0)] if (1, True) in rows else []) + [(1, 1 if (1, True) in rows else 0, 2, 0, 3, 8)]
        return spark.createDataFrame(made, "book int, page_no int, bi int, lo int, hi int, slot int")

    left, moved = assembly.plates(blocks, plan, ["book"], 10)
    assert sorted(r["bi"] for r in left.collect()) == [0, 2] and [r["bi"] for r in moved.collect()] == [1]


def test_lines_fit():
    rng = np.random.default_rng(0)
    for _ in range(300):
        text = "".join(rng.choice(list("ab ,.-/中文，（）　W1m"), rng.integers(1, 60)))
        for a, b, w in layout.greedy_lines(text, 5000):
            assert w <= 5000 or b == a + 1 or text[b - 1] == " "


def test_anchors_by_level(spark):
    refs = [(1, 0, 1, ["pure reason", "reason"], 3), (1, 0, 2, ["pure reason", "reason"], 9), (1, 1, 3, ["idea", "reason"], 5), (1, 2, 4, ["gone", "reason"], 7)]
    refs = spark.createDataFrame(refs, "book int, line_no int, ref int, terms array<string>, page int")
    occ = [(1, "pure reason", 100), (1, "pure reason", 900), (1, "idea", 10), (1, "idea", 20), (1, "reason", 700)]
    out = index_model.anchors_by_level(refs, spark.createDataFrame(occ, "book int, term string, off int"), ["book"])
    # The first two are used up by their own key; "idea" occurs twice for one page; "reason" occurs once, as lines 1 and 2 each list it.
    assert sorted((r["term"], r["page"], r["off"]) for r in out.collect()) == [("pure reason", 3, 105), ("pure reason", 9, 905), ("reason", 5, 703), ("reason", 7, 703)]


def test_rules_in_order_against_plain_replacement(spark):
    """Thousands of rules with part ranges, chains and overlaps, over texts and over runs that cut them anywhere."""
    import random

    rnd = random.Random(11)
    rows = []
    for k in range(3000):
        old, new = ("".join(rnd.choice("abcd ") for _ in range(n)) for n in rnd.choice([(0, 2), (3, 3), (3, 2), (4, 4), (4, 5), (5, 3), (6, 0)]))
        rows.append((k, rnd.choice(["*", f"{rnd.randrange(9)}", f"{rnd.randrange(5)}-{rnd.randrange(5, 9)}", f"1,{rnd.randrange(9)}-7"]), old, new, ""))
    rules_df = spark.createDataFrame(rows, rules.RULES)
    texts = [(i % 9 if i % 10 else None, None if i == 7 else "".join(rnd.choice("abcd  ") for _ in range(rnd.randrange(60)))) for i in range(60)]

    def plain(part, text):
        hits = {}
        for k, spec, old, new, _ in rows:
            ranges = [tuple(map(int, x.split("-"))) if "-" in x else (int(x), int(x)) for x in spec.split(",") if x != "*"]
            if old and (not ranges or (part is not None and any(a <= part <= b for a, b in ranges))) and old in text:
                hits[k] = text.count(old)
                text = text.replace(old, new)
        return text, hits

    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "n int, part long, text string")
    got = {r["n"]: (r["text"], {h["rule_no"]: h["hits"] for h in r["h"]}) for r in rules.apply_literal(df, rules_df, hits="h").collect()}
    want = {i: (None, {}) if t is None else plain(p, t) for i, (p, t) in enumerate(texts)}
    assert got == want
    total = {}
    for _, hits in want.values():
        for k, n in hits.items():
            total[k] = total.get(k, 0) + n
    assert {r["rule_no"]: r["hits"] for r in rules.usage(df, rules_df).collect()} == {k: total.get(k, 0) for k in range(3000)}
    book = rules.RuleBook.of_rows([dict(zip(("rule_no", "spec", "old", "new"), r)) for r in rows])
    for part, text in texts:
        if text:
            cuts = sorted(rnd.sample(range(len(text) + 1), min(4, len(text))))
            runs = [{"t": text[a:b], "b": i} for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)]))]
            assert "".join(r["t"] for r in book.fix_runs(runs, part)[0]) == plain(part, text)[0]


def test_rules_take_no_longer_the_more_there_are():
    """Rules that a text has no use for are not tried."""
    book = rules.RuleBook([(k, f"old{k}x", "new", [(0, 9)]) for k in range(50_000)])
    tried = []
    found = book.found
    book.found = lambda text, k: tried.append(k) or found(text, k)
    assert book.fix("old7x and old40000x, old7x", 3) == ("new and new, new", {7: 2, 40000: 1}) and tried == [7, 40000]
    assert book.fix("old7x", 10) == ("old7x", {})
