"""The solver covers each line once; lines, titles and columns fit; the index chain is the longest."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators import index_model as I
from quire.operators import page_maps as PM
from quire.operators import layout as L
from quire.operators import rules as R
from quire.sources import markup as M

block = st.builds(L.LayoutBlock, lines=st.integers(1, 14), before=st.integers(0, 2), after=st.integers(0, 2), brk=st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(block, min_size=1, max_size=10))
def test_each_line_once(blocks):
    blocks[0].brk = False
    plan, cost, _ = L.solve(blocks, 10)
    assert cost >= 0
    for i, b in enumerate(blocks):
        spans = sorted((lo, hi) for _, k, lo, hi, _ in plan if k == i)
        assert [x for lo, hi in spans for x in range(lo, hi)] == list(range(b.lines))
    pages = [p for p, *_ in plan]
    assert pages == sorted(pages) and set(pages) == set(range(max(pages) + 1))
    for _, _, lo, hi, slot in plan:
        assert slot + hi - lo <= 10
    used = set()
    for p, _, lo, hi, slot in plan:
        for s in range(slot, slot + hi - lo):
            assert (p, s) not in used
            used.add((p, s))


def test_cheapest_break():
    """A single last line (50) is cheaper than a gap (200); both leave a short last page (300)."""
    plan, cost, _ = L.solve([L.LayoutBlock(9), L.LayoutBlock(12)], 20)
    assert cost == L.SINGLE_LAST + L.SHORT_TAIL and (1, 1, 11, 12, 0) in plan
    assert L.solve([L.LayoutBlock(9), L.LayoutBlock(14), L.LayoutBlock(1)], 20)[1] == 0


def test_figure_floats():
    plan, cost, _ = L.solve([L.LayoutBlock(6), L.LayoutBlock(1, slots=6, splittable=False, floating=True), L.LayoutBlock(8)], 10)
    assert cost < 1000 and {b for _, b, *_ in plan} == {0, 1, 2}


def all_plans(blocks, size, reserve):
    """The least cost of all plans, by trying everything on pages of slots; None if there is none."""
    top = lambda page: reserve if page < 2 else 0
    gap = lambda g: 200 * g + 500 * (g - 1) ** 2 if g else 0

    def demand(i, depth=0):
        b = blocks[i]
        own = b.lines + b.after
        if not b.keep or i + 1 == len(blocks) or blocks[i + 1].brk or depth >= L.KEEP_DEPTH:
            return own
        after = blocks[i + 1]
        return own + (after.before + demand(i + 1, depth + 1) if after.keep else min(b.keep, after.lines))

    def go(i, used, page, waits):
        if i == len(blocks):
            cost = 0
            if waits is not None:
                used += blocks[waits].lines
                if used > size:
                    used, page, cost = top(page + 1) + blocks[waits].lines, page + 1, 40
            yield cost + (300 if 0 < used - top(page) <= 2 else 0)
            return
        b, before = blocks[i], blocks[i - 1] if i else None
        kept = before.keep if before and not b.brk else 0
        if waits is not None and (b.floating or b.brk):
            return
        if b.floating and not reserve and used > top(page) and used + b.lines > size:
            yield from (20 + c for c in go(i + 1, used, page, i))
        figure = blocks[waits].lines if waits is not None else 0
        begins = []
        if used == top(page):
            if not b.nostart or i == 0:
                begins.append((used + (b.before if b.top_keep else 0), page, False, 0))
        elif not b.brk:
            begins += [(used + n, page, False, c) for n, c in b.choices() if used + n < size]
        if used > top(page) and not kept and not (b.nostart and i):
            blank = 0 if b.brk else gap(size - used)
            lead = [(figure + n, c) for n, c in b.choices()] if figure else [(b.before if b.top_keep else 0, 0)]
            begins += [(top(page + 1) + n, page + 1, True, c + blank) for n, c in lead if not figure or top(page + 1) + n < size]
        for at, on, turned, cost in begins:
            if figure and not turned and b.nofloat:
                continue
            highest = top(on) + (b.before if b.top_keep else 0) + (figure if turned else 0)
            if b.keep and at + demand(i) > size and at > highest:
                continue
            for lines, penalty in b.variants():
                if b.keep and at + lines > size:
                    continue
                for g1, g2 in itertools.product(range(3), range(2)):
                    filled, left, where, room, extra, pieces = at, lines, on, size, 0, []
                    if at + lines <= size:
                        if g1 or g2:
                            continue
                        pieces, end = [lines], at + lines
                    else:
                        if not b.splittable or size - at - g1 < 1 or size - at - g1 >= lines or (figure and not turned and size - figure < 2):
                            continue
                        pieces, extra, owed = [size - at - g1], gap(g1), g2
                        left = lines - pieces[0]
                        while left:
                            where += 1
                            begin = top(where) + (figure if len(pieces) == 1 and not turned else 0)
                            take = min(left, size - begin)
                            if owed and left > take and left - take <= size - top(where + 1):
                                take, owed, extra = take - 1, 0, extra + gap(1)
                            pieces.append(take)
                            left -= take
                            end = begin + take
                        if owed:
                            continue
                        extra += 50 * (pieces[0] < 2) + 50 * (pieces[-1] == 1) + 6 * (pieces[-1] == 2 and lines > 6)
                        if kept and pieces[0] < kept:
                            continue
                    still = None if turned or len(pieces) > 1 else waits
                    if end >= size:
                        where, end = where + 1, top(where + 1)
                        if still is not None:
                            end, still = end + figure, None
                    elif len(pieces) == 1 and end + b.after < size:
                        end += b.after
                    yield from (cost + penalty + extra + c for c in go(i + 1, end, where, still))

    return min(go(0, top(0 if reserve else 2), 0 if reserve else 2, None), default=None)


small = st.builds(
    L.LayoutBlock, lines=st.integers(1, 8), before=st.integers(0, 2), after=st.integers(0, 1), keep=st.sampled_from([0, 0, 0, 1, 2]), brk=st.sampled_from([False] * 5 + [True]), splittable=st.booleans(),
    penalties=st.sampled_from([(), ((2, 3.0),)]), spaces=st.sampled_from([(), ((1, 0.0), (2, 5.0), (0, 5.0))]), min_before=st.sampled_from([0, 0, 1]), noshrink=st.booleans(),
    nostart=st.sampled_from([False] * 4 + [True]), top_keep=st.sampled_from([False] * 3 + [True]), nofloat=st.booleans(), floating=st.sampled_from([False] * 3 + [True]),
)


@settings(max_examples=250, deadline=None)
@given(st.lists(small, min_size=1, max_size=4), st.integers(6, 8), st.sampled_from([0, 0, 2]))
def test_cheapest_of_all_plans(blocks, size, reserve):
    for b in blocks:
        if b.floating:
            b.splittable, b.keep, b.penalties, b.lines = False, 0, (), min(b.lines, 4)
    want = all_plans(blocks, size, reserve)
    if want is None:
        with pytest.raises(ValueError):
            L.solve(blocks, size, reserve=reserve)
        return
    plan, cost, variants = L.solve(blocks, size, reserve=reserve)
    assert cost == pytest.approx(want)
    for i, b in enumerate(blocks):  # each line once, each slot once
        assert sorted(x for _, k, lo, hi, _ in plan if k == i for x in range(lo, hi)) == list(range(b.variants()[variants[i]][0]))
    slots = [(p, s) for p, _, lo, hi, slot in plan for s in range(slot, slot + hi - lo)]
    assert len(slots) == len(set(slots)) and all(s < size and (s >= reserve or p > 1) for p, s in slots)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab ,.-中文，（）", min_size=1, max_size=60), st.integers(2, 12))
def test_lines_cover_the_text(text, width):
    lines = L.greedy_lines(text, width * 1000)
    assert "".join(text[a:b] for a, b, _ in lines) == text


def test_titles_and_columns():
    assert L.balance_title("第一章　论纯粹理性批判的总的构思与任务", 10)[0] == "第一章"
    assert len(L.balance_title("aaaa bbbb cccc dddd", 6)) == 2
    widths = L.column_widths([["short", "a much longer cell of text"], ["x", "y z"]], 20)
    assert sum(widths) <= 20 and widths[1] > widths[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=8))
def test_lnds(values):
    picked = I.lnds(values)
    assert all(values[a] <= values[b] for a, b in zip(picked, picked[1:]))
    best = max((len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c)), default=0)
    assert len(picked) == best


@settings(max_examples=120, deadline=None)
@given(st.integers(2, 3).flatmap(lambda n: st.lists(st.lists(st.text(alphabet="ab 中，-", max_size=14), min_size=n, max_size=n), min_size=1, max_size=3)), st.integers(8, 24), st.lists(st.booleans(), min_size=3, max_size=3), st.sampled_from([0.0, 1.0]))
def test_column_widths_against_all_widths(cells, total, code, pad):
    import math

    n = len(cells[0])
    milli = lambda t: sum(map(L.char_milli, t)) / 1000
    natural = [max(milli(r[j]) for r in cells) + pad * (j < n - 1) for j in range(n)]
    fixed = {j: math.ceil(x) for j, x in enumerate(natural) if x <= 4.5}
    flex = [j for j in range(n) if j not in fixed]
    room = total - sum(fixed.values())
    got = L.column_widths(cells, total, code[:n], pad)
    assert all(got[j] == w for j, w in fixed.items())
    least = {j: min(math.ceil(natural[j]), max(3, math.ceil(max(L.unbroken(r[j]) for r in cells) + pad))) for j in flex}
    share = sum(natural[j] for j in flex)
    if sum(least.values()) > room:
        assert all(got[j] == max(2, int(room * natural[j] / share)) for j in flex)
        return
    scores = []
    for ws in itertools.product(*[range(least[j], math.ceil(natural[j]) + 1) for j in flex]):
        if sum(ws) <= room:
            counts = [[max(1, len(L.greedy_lines(r[j], int((w - pad * (j < n - 1)) * 1000)))) for j, w in zip(flex, ws)] for r in cells]
            lines = sum(max([1, *c]) + sum(0.6 * (x - 1) for x, j in zip(c, flex) if code[j]) for c in counts)
            scores.append((round(lines, 3), max((abs(w / sum(ws) - natural[j] / share) for j, w in zip(flex, ws)), default=0.0), ws))
    assert tuple(got[j] for j in flex) == min(scores)[2]


def test_unbroken_pieces():
    assert L.unbroken("ab abcd") == pytest.approx(4 * 0.52) and L.unbroken("中中，中") == pytest.approx(2.0) and L.unbroken("") == 0.0


def test_index_line():
    refs = I.parse_entry("理性 Vernunft 12, 116—30；纯粹理性（见第3页）295—6，1781年")
    assert [(r["first"], r["last"]) for r in refs] == [("12", ""), ("116", "30"), ("295", "6")]
    assert "纯粹理性" in refs[2]["keys"] and refs[0]["foreign"] == ["Vernunft"] and refs[0]["keys"][-1] == "理性"
    refs = I.parse_entry("自由上254, 下56, 信14, v3, 2.5")
    assert [(r["first"], r["series"], r["letter"]) for r in refs] == [("254", "上", False), ("56", "下", False), ("14", "下", True), ("2", "下", False)][:3]


def test_prediction_is_exact_on_a_line():
    import numpy as np

    off = np.arange(0, 20000, 700.0)
    module = PM.Map(off, off / 700, 700.0, 20000)
    assert abs(module.pages(np.array([5000.0])) - 5000 / 700) < 1e-6
    assert abs(module.places(np.array([10.0])) - 7000) < 1 and np.isnan(module.places(np.array([90.0])))
    assert PM.longest_chain(np.array([0, 700, 1400, 2100]), np.array([1, 2, 90, 4]), np.zeros(4)) == [0, 1, 3]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 6), st.integers(0, 2)), max_size=9))
def test_longest_chain_against_all_chains(points):
    import numpy as np

    points = sorted((a * 200, p, m) for a, p, m in points)
    follows = lambda x, y: 0 <= y[1] - x[1] <= (y[0] - x[0]) / 300 + 1 + 8 * (x[2] != y[2]) and y[1] - x[1] >= (y[0] - x[0]) / 1300 - 1
    chains = [c for n in range(len(points) + 1) for c in itertools.combinations(points, n) if all(map(follows, c, c[1:]))]
    got = PM.longest_chain(*(np.array(x, float) for x in zip(*points))) if points else []
    assert len(got) == max(map(len, chains)) and all(follows(points[a], points[b]) for a, b in zip(got, got[1:]))


def test_local_pages_against_one_place_at_a_time():
    """Lines by numpy.polyfit through the ten nearest anchors, point by point."""
    import numpy as np

    rnd = np.random.default_rng(5)
    for n in (2, 3, 8, 40):
        x = np.sort(rnd.integers(0, 30_000, n).astype(float))
        y = x / 650 + rnd.normal(0, 0.4, n) + (rnd.random(n) < 0.1) * 9
        module = PM.Map(x, y, 650.0, 30_000)
        for at in (0.0, 29_000.0, float(x[0]), 12_345.0):
            pick = np.argsort(np.abs(x - at), kind="stable")[:10]
            px, py = x[pick], y[pick]
            far = np.abs(px - at)
            w = (1 - (far / (far.max() + 1)) ** 3) ** 3
            for _ in range(3):
                b, a = np.polyfit(px - at, py, 1, w=np.sqrt(w))
                miss = np.abs(py - a - b * (px - at))
                w = w * np.maximum(0, 1 - (miss / (6 * np.sort(miss[w > 0])[(w > 0).sum() // 2] + 0.05)) ** 2) ** 2
            b, a = np.polyfit(px - at, py, 1, w=np.sqrt(w))
            if 0.2 / 650 < b < 5 / 650:
                share = min(1.0, (px[w > 0].max() - px[w > 0].min()) / (8 * 650))
                want = (w * py).sum() / w.sum() + (share * b + (1 - share) / 650) * (at - (w * px).sum() / w.sum())
            else:
                want = py[0] + (at - px[0]) / 650
            assert module.pages(np.array([at]))[0] == pytest.approx(want, abs=1e-6)


def test_rules_over_runs():
    runs = [{"t": "ab", "b": 1, "i": None}, {"t": "cd", "b": 0, "i": None}]
    out, hits = R.fix_runs(runs, [("bc", "X")])
    assert [(r["t"], r["b"]) for r in out] == [("aX", 1), ("d", 0)] and hits == [1]


@pytest.mark.parametrize("markup, want", [
    ("<p>a<b>b</b><sup><a href='#n1' id='m1'>[1]</a></sup></p>", ["ab[1]"]),
    ("<h1>T</h1><p>x<p>y", ["T", "x", "y"]),
    ("<p>a<!-- c -->gone</p>", ["a"]),
    ("<script>x('</p>')</script><p>k &amp; l</p>", ["k & l"]),
    ("<ul><li>one<ul><li>two</li></ul></li></ul>", ["one", "two"]),
])
def test_markup(markup, want):
    assert ["".join(r["t"] for r in i["runs"]) for i in M.read_items(markup)] == want


def test_table_and_depth():
    items = M.read_items("<table><tr><th colspan=2>h</th></tr><tr><td>a</td><td>b<br>c</td></tr></table><ul><li>x<ul><li>y</li></ul></li></ul>")
    table = next(i for i in items if i["k"] == "table")
    assert table["rows"][0] == ["h"] and table["spans"][0] == [2] and table["heads"] == [True, False]
    assert [i["depth"] for i in items if i["k"] == "li"] == [1, 2]


def test_many_texts_at_once_as_each_alone():
    texts = ["", "a", "b" * 400, "word " * 90, "a-b," * 80, "，" * 60, "（" * 30, "一二三，四。" * 20, "Wide MW and 12, " * 30 + "）。", " " * 90]
    for width in (0, 300, 5_000, 26_000):
        ((block, *found),) = L.lines_of(texts, [width])
        assert [[tuple(map(int, x)) for b, *x in zip(block, *found) if b == k] for k in range(len(texts))] == [L.greedy_lines(t, width) for t in texts]


def test_lines_of_many_texts_take_one_pass(monkeypatch):
    """characters are looked at for all texts of a batch together, not text by text."""
    passes = []
    monkeypatch.setattr(L, "_codes", lambda text, codes=L._codes: passes.append(1) or codes(text))
    ((block, *_),) = L.lines_of(["some words " * 20] * 500, [26_000])
    assert len(set(block.tolist())) == 500 and len(passes) == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(block, min_size=1, max_size=8), min_size=2, max_size=5))
def test_plans_with_steps_kept(modules):
    known = {}
    for blocks in modules:
        blocks[0].brk = False
        assert L.solve(blocks, 10, known=known) == L.solve(blocks, 10)


def test_plan_checks_read_the_plan_once(spark):
    """pieces and pages are judged in one pass; a page's fault counts once."""
    plan = spark.createDataFrame([(1, 0, 0, 0, 5, 0), (1, 0, 1, 0, 1, 5), (1, 1, 1, 1, 3, 0), (1, 2, 2, 0, 2, 0)], "doc int, page_no int, bi int, lo int, hi int, slot int")
    blocks = spark.createDataFrame([(1, 0, 5, False), (1, 1, 3, True), (1, 2, 2, False)], "doc int, bi int, nl int, heading boolean")
    found = L.plan_checks(plan, blocks, ["doc"], 10)
    assert sorted((r.page_no, r.fault) for r in found.collect()) == [(0, "gap"), (0, "head_bottom"), (0, "orphan"), (1, "gap"), (1, "head_bottom"), (2, "short last page")]
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_widths_of_words_measure_no_lines(monkeypatch):
    """words that fit their column cost neither a search for line ends nor one for places to break."""
    asked = []
    monkeypatch.setattr(L, "line_ends", lambda *a, real=L.line_ends: asked.append(a) or real(*a))
    assert L.column_widths([["theword", "another"]], 60) == [4, 4] and L.unbroken("theword") == 3.57 and not asked


def test_plain_markup_goes_without_the_parser(monkeypatch):
    """The parser reads only what is not plain, and both ways give the same items."""
    fed = []
    monkeypatch.setattr(M._Reader, "feed", lambda self, markup, real=M._Reader.feed: fed.append(markup) or real(self, markup))
    plain = "<div class='box'><p id=\"a\">one <em>two</em><br/><span class='k'>three</span></p><ul><li>x<img src='a/b.png'/></ul></div>"
    want = M.read_items(plain)
    assert not fed and want
    monkeypatch.setattr(M, "_plain_tokens", lambda markup: None)
    assert M.read_items(plain) == want and fed == [plain]


def test_cells_go_without_the_parser(monkeypatch):
    """values without quotes are plain, and cells of text alone are taken together; both ways give the same items."""
    fed, begun = [], []
    monkeypatch.setattr(M._Reader, "feed", lambda self, markup, real=M._Reader.feed: fed.append(markup) or real(self, markup))
    monkeypatch.setattr(M._Reader, "handle_starttag", lambda self, tag, attrs, real=M._Reader.handle_starttag: begun.append(tag) or real(self, tag, attrs))
    plain = "<table><tr><th colspan=2><b>he</b>ad</th></tr><tr><td>a  b</td><td></td><td>c</td><td class=x>d<td>e</td></tr></table><td>f</td>"
    want = M.read_items(plain)
    assert not fed and begun.count("td") == 2 and want[0]["rows"] == [["head"], ["a b", "", "c", "d", "e"]] and want[0]["spans"] == [[2], [1] * 5]
    monkeypatch.setattr(M, "_plain_tokens", lambda markup: None)
    assert M.read_items(plain) == want and fed == [plain]


def test_elements_alike_are_made_once(monkeypatch):
    """an element with no attribute but a class is made once where it stands, also for parts that come later."""
    made = []
    monkeypatch.setattr(M._Element, "__init__", lambda self, d, tag, attrs, around, real=M._Element.__init__: made.append(tag) or real(self, d, tag, attrs, around))
    known = {}
    texts = ["<p>" + "a <em>b</em> <span class='kai'>c</span> " * 20 + "</p>" for _ in range(3)]
    got = [M.read_items(t, known=known) for t in texts]
    assert sorted(made) == ["em", "p", "span"]
    assert got[0] == got[2] and [r["c"] for r in got[0][0]["runs"]][:4] == [None, "it", None, "kai"]


def test_items_of_some_fields(spark):
    """lines of a pre element give rows of the fields asked for, the same as among all."""
    parts = spark.createDataFrame([(1, "<pre>a\n b \n\nc</pre><p>d <i>e</i></p>"), (2, None), (3, "<pre> \n </pre>")], "part long, markup string")
    some, every = M.items(parts, "part", "markup", fields=("part", "tag")), M.items(parts, "part", "markup")
    assert some.columns == ["part", "tag"] and some.collect() == every.select("part", "tag").collect()
    assert [r.runs[0].t for r in every.filter("tag = 'pre'").collect()] == ["a", " b", "c"]
    of_runs = M.items(parts, "part", "markup", M.Dialect(), ("part", "runs"), ("c",))
    assert [[x.c for x in r.runs] for r in of_runs.filter("part = 1").collect()][-1] == [None, "it"]


def test_items_take_runs_field_by_field(spark):
    parts = spark.createDataFrame([(1, "<p>a <b>b</b><a href='#x'>c</a></p>"), (2, None), (3, "<table><tr><td>t</td></tr></table>")], "part long, markup string")
    got = {(r.part, r.k): r for r in M.items(parts, "part", "markup").collect()}
    assert [(x.t, x.b, x.h) for x in got[1, "p"].runs] == [("a ", 0, None), ("b", 1, None), ("c", 0, "#x")]
    assert got[3, "table"].rows == [["t"]] and got[3, "table"].runs == [] and len(got) == 2


def test_rules_take_other_fields_along(spark):
    """of runs only texts and pictures are read; the rest, nulls and marks too, stays with its run, and emptied runs go."""
    run = "struct<t:string,b:int,s:int,h:string,a:string,i:string,c:string,m:string>"
    items = spark.createDataFrame([(1, [("th", 1, 0, None, "a", None, "it", None), ("e x", 0, 1, "#h", None, None, None, "m"), ("y", 0, 0, None, None, "p.png", None, None)]), (2, [])], f"n int, runs array<{run}>")
    got = {r.n: r for r in R.fix_item_runs(items, [("the", "A"), ("x", "")]).collect()}
    assert [tuple(r) for r in got[1].runs] == [("A", 1, 0, None, "a", None, "it", None), (" ", 0, 1, "#h", None, None, None, "m"), ("y", 0, 0, None, None, "p.png", None, None)]
    assert got[1].hits == [1, 1] and got[2].runs == [] and got[2].hits == [0, 0]
    assert "MapInArrow" in R.fix_item_runs(items, [])._jdf.queryExecution().optimizedPlan().toString()


def test_census_holds_no_line_for_each_place(spark):
    """a line gives a row for each different character, not one for each place, and none is sorted by a window."""
    from quire.operators import aggregates as A

    line = "twenty characters and %, @ and @ more words"
    df = spark.createDataFrame([(2, "x@" * 3_000), (1, line), (3, None)], "n int, line string")
    out = A.char_census(df, "line", "[□@%]", ["n"])
    assert {r.ch: (r.n, r.context) for r in out.collect()} == {"@": (3_002, line[9:42]), "%": (1, line[6:39])}
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_runs_without_a_picture_are_spread(spark):
    """runs without a picture do not share one key of the join."""
    from quire.operators import repair as P

    runs = spark.range(2_000).selectExpr("id", "concat('w', id) AS t", "CAST(IF(id % 100 = 0, 'pic', NULL) AS string) AS i").repartition(2)
    known = spark.createDataFrame([("pic", "T")], "i string, text string").hint("shuffle_hash")
    out = P.expand_pictures(runs, known)
    assert sorted((r.t == "T", r.i is None) for r in out.collect()) == [(False, True)] * 1_980 + [(True, True)] * 20
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [len(p) for p in P.expand_pictures(runs, known).rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 1_500
