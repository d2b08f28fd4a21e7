"""Corrections of structure, classes of elements, and places of pages.

Corrections of a part's items (X5) depend on one another, so a part's items are
read in order and an operation works on their list; a part is one file of a
book.  What is addressed by number or class (X6, F3, F4, F8, W14) is relational.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _widened
from ..model import GAP_CJK, RUN
from .classify import first_match
from .folding import ordered_fold

_PLAIN = {f.name: None for f in RUN.fields} | {"b": 0, "s": 0}
#: Fields of an item that operations see and change.
ITEM_FIELDS = ("k", "cls", "id", "lvl", "src", "runs", "rows")


def text_of(item: dict) -> str:
    return "".join(r["t"] for r in item["runs"] or () if not r["i"])


def _run(text: str, **more) -> dict:
    return _PLAIN | {"t": text} | more


def _cut_runs(runs: list[dict], at: int) -> tuple[list[dict], list[dict]]:
    """Runs before and after a place of their text (pictures have no length)."""
    left, right = [], []
    for r in runs:
        n = 0 if r["i"] else len(r["t"])
        if at >= n and not right and (at > n or n):
            left.append(r)
        elif at <= 0 or right:
            right.append(r)
        else:
            left.append(r | {"t": r["t"][:at]})
            right.append(r | {"t": r["t"][at:]})
        at -= n
    return left, right


class Items:
    """The items of a part while operations work on them; an operation that does not apply changes nothing and counts 0."""

    def __init__(self, items: list[dict]):
        self.items = items

    def starting(self, prefix: str, *kinds: str) -> list[int]:
        return [i for i, x in enumerate(self.items) if (not kinds or x["k"] in kinds) and text_of(x).startswith(prefix)]

    def _carry(self, found: list[int], size: int, to: str, after: bool, *kinds: str) -> int:
        """Move ``size`` items from the only place found to the only item that begins with ``to``."""
        if len(found) != 1:
            return 0
        moved, rest = self.items[found[0] : found[0] + size], self.items[: found[0]] + self.items[found[0] + size :]
        there = [i for i, x in enumerate(rest) if (not kinds or x["k"] in kinds) and text_of(x).startswith(to)]
        if len(there) != 1:
            return 0
        at = there[0] + after
        self.items = rest[:at] + moved + rest[at:]
        return 1

    def move(self, prefix: str, before: str) -> int:
        return self._carry(self.starting(prefix), 1, before, False)

    def movetab(self, title: str, after: str) -> int:
        titles = [i for i, x in enumerate(self.items[:-1]) if x["k"] == "p" and text_of(x) == title and self.items[i + 1]["k"] == "table"]
        return self._carry(titles, 2, after, True, "p")

    def imgout(self, picture: str, side: str) -> int:
        for i, x in enumerate(self.items):
            if x["k"] == "p" and any(r["i"] == picture for r in x["runs"]):
                x["runs"] = [r for r in x["runs"] if r["i"] != picture]
                alone = dict.fromkeys(ITEM_FIELDS) | {"k": "img", "cls": "", "src": picture, "runs": []}
                self.items.insert(i + (side == "after"), alone)
                return 1
        return 0

    def _marks(self, pattern: str, notes: bool):
        """Runs with a link whose whole text is a numbered mark: ``(run, number)``."""
        for x in self.items:
            for r in (x["runs"] or ()) if notes or x["k"] != "note" else ():
                m = re.fullmatch(pattern, r["t"]) if r["h"] else None
                if m:
                    yield r, int(m[1])

    def renum(self, delta: str, href: str, anchor: str) -> int:
        """Raised marks ``[n]`` renumbered, with links by two formats of ``{n}``."""
        found = [(r, n + int(delta)) for r, n in self._marks(r"\[(\d+)\]", False) if r["s"]]
        for r, n in found:
            r |= {"t": f"[{n}]", "h": href.format(n=n), "a": anchor.format(n=n)}
        return len(found)

    def shift(self, least: str, delta: str) -> int:
        found = [(r, n) for r, n in self._marks(r"\((\d+)\)", True) if n >= int(least)]
        for r, n in found:
            r["t"] = f"({n + int(delta)})"
        return len(found)

    def split(self, prefix: str, at: str, label: str, back: str, anchor: str) -> int:
        """A note that another one runs into: what follows ``at`` is a note of its own."""
        for i in self.starting(prefix):
            x = self.items[i]
            here = text_of(x).find(at)
            if here >= 0:
                head, tail = _cut_runs(x["runs"], here)
                _, tail = _cut_runs(tail, len(at))
                if head:
                    head[-1] = head[-1] | {"t": head[-1]["t"].rstrip()}
                self.items[i : i + 1] = [x | {"runs": [r for r in head if r["t"]]}, x | {"runs": [_run(label, h=back, a=anchor), *tail]}]
                return 1
        return 0

    def pgno(self, ending: str) -> int:
        """A printed page number that ran into the text, at the end of a run: set apart in brackets."""
        number = re.search(r"(?:[ivxlc]+|[0-9]+)$", ending)
        for x in self.items:
            for k, r in enumerate(x["runs"] or ()):
                if number and r["t"].endswith(ending) and not r["c"]:
                    x["runs"][k : k + 1] = [y for y in (r | {"t": r["t"].removesuffix(number[0])}, _run(f"〔{number[0]}〕", c="pgno")) if y["t"]]
                    return 1
        return 0

    def _only(self, prefix: str) -> dict | None:
        found = [self.items[i] for i in self.starting(prefix) if self.items[i]["k"] != "note"]
        return found[0] if len(found) == 1 else None

    def relink(self, prefix: str, mark: str, new: str, href: str, anchor: str) -> int:
        for r in (self._only(prefix) or {"runs": ()})["runs"]:
            if (r["s"] or r["h"]) and r["t"] == mark:
                r |= {"t": new, "s": 1, "h": href, "a": anchor}
                return 1
        return 0

    def addmark(self, prefix: str, after: str, new: str, href: str, anchor: str) -> int:
        x = self._only(prefix)
        here = text_of(x).find(after) if x else -1
        if here < 0:
            return 0
        left, right = _cut_runs(x["runs"], here + len(after))
        x["runs"] = [*left, _run(new, s=1, h=href, a=anchor), *right]
        return 1

    def noteback(self, label: str, back: str) -> int:
        for x in self.items:
            if x["k"] in ("note", "p") and x["runs"] and x["runs"][0]["t"] == label:
                x["runs"][0]["h"] = back
                return 1
        return 0

    def href(self, prefix: str, text: str, href: str) -> int:
        for i in self.starting(prefix):
            for r in self.items[i]["runs"] if self.items[i]["k"] != "note" else ():
                if r["t"] == text and r["h"]:
                    r["h"] = href
                    return 1
        return 0

    def anchor(self, prefix: str, anchor: str) -> int:
        for i in self.starting(prefix):
            x = self.items[i]
            if x["k"] != "note" and x["runs"]:
                fresh = not x["runs"][0]["a"]
                x["runs"][0]["a"] = x["runs"][0]["a"] or anchor
                return int(fresh)
        return 0

    def notelink(self, cls: str, part: str) -> int:
        """Plain marks ``[n]`` and entries ``[n]text`` of a class, linked both ways; each number once."""
        entries: set[str] = set()
        for x in self.items:
            if cls in (x["cls"] or "").split() and x["runs"] and not x["runs"][0]["h"]:
                m = re.match(r"\s*\[(\d+)\]", x["runs"][0]["t"])
                if m:
                    entries.add(m[1])
                    rest = x["runs"][0] | {"t": x["runs"][0]["t"][m.end() :]}
                    x["runs"][0:1] = [y for y in (_run(f"[{m[1]}]", h=f"{part}#nl-ref{m[1]}", a=f"{part}#nl-note{m[1]}"), rest) if y["t"]]
        used: set[str] = set()
        for x in self.items:
            if cls in (x["cls"] or "").split() or x["k"] not in ("p", "li"):
                continue
            made: list[dict] = []
            for r in x["runs"]:
                pieces = re.split(r"(\[\d+\])", r["t"]) if not (r["h"] or r["a"] or r["i"]) else [r["t"]]
                for piece in pieces:
                    n = piece[1:-1]
                    if re.fullmatch(r"\[\d+\]", piece) and n in entries and n not in used and not r["h"]:
                        used.add(n)
                        made.append(_run(piece, b=r["b"], s=1, h=f"{part}#nl-note{n}", a=f"{part}#nl-ref{n}"))
                    elif made and made[-1] | {"t": ""} == r | {"t": ""} and not r["i"]:
                        made[-1] = made[-1] | {"t": made[-1]["t"] + piece}
                    elif piece:
                        made.append(r | {"t": piece})
            x["runs"] = made
        return len(used)

    def headre(self, pattern: str, level: str) -> int:
        found = [x for x in self.items if x["k"] == "p" and re.match(pattern, text_of(x).strip())]
        for x in found:
            x |= {"k": "h", "lvl": int(level), "runs": [r | {"b": 0} for r in x["runs"]]}
        return len(found)

    def head(self, prefix: str, level: str) -> int:
        for i in self.starting(prefix, "p")[:1]:
            self.items[i] |= {"k": "h", "lvl": int(level), "runs": [r | {"b": 0} for r in self.items[i]["runs"]]}
            return 1
        return 0

    def paratable(self, prefix: str, count: str) -> int:
        """Lines padded with spaces as a table, its first line the head."""
        for i in self.starting(prefix, "p")[:1]:
            lines = self.items[i : i + int(count)]
            if len(lines) == int(count) and all(x["k"] == "p" and not any(r["i"] for r in x["runs"]) for x in lines):
                rows = [re.split(r"[\s　]{2,}", text_of(x).strip()) for x in lines]
                self.items[i : i + int(count)] = [dict.fromkeys(ITEM_FIELDS) | {"k": "table", "cls": "", "id": lines[0]["id"], "runs": [], "rows": rows}]
                return 1
        return 0

    def cell(self, first: str, column: str, old: str, new: str) -> int:
        for x in self.items:
            for row in x["rows"] or ():
                if row and row[0].strip() == first and len(row) > int(column) and old in row[int(column)]:
                    row[int(column)] = row[int(column)].replace(old, new)
                    return 1
        return 0

    def join(self, ending: str, beginning: str) -> int:
        for i, (a, b) in enumerate(zip(self.items, self.items[1:])):
            if a["k"] == b["k"] == "p" and text_of(a).endswith(ending) and text_of(b).startswith(beginning):
                self.items[i : i + 2] = [a | {"runs": a["runs"] + b["runs"]}]
                return 1
        return 0

    def para(self, prefix: str, begins: str) -> int:
        for i in self.starting(prefix, "p")[:1]:
            here = text_of(self.items[i]).find(begins)
            if here > 0:
                left, right = _cut_runs(self.items[i]["runs"], here)
                left[-1] = left[-1] | {"t": left[-1]["t"].rstrip()}
                self.items[i : i + 1] = [self.items[i] | {"runs": [r for r in left if r["t"]]}, self.items[i] | {"runs": right, "id": None}]
                return 1
        return 0

    def fwparen(self, before: str, inside: str | None = None) -> int:
        """T9 over the runs of each item: pairs may span runs, which keep their bounds."""
        first, held, hits = re.compile(before), re.compile(inside) if inside else None, 0
        for x in self.items:
            whole = "".join("\0" if r["i"] else r["t"] for r in x["runs"] or ())
            wide = _widened(whole, first, held) if "(" in whole else whole
            hits += sum(a != b for a, b in zip(whole, wide)) // 2
            at = 0
            for k, r in enumerate(x["runs"] or ()):
                n = 1 if r["i"] else len(r["t"])
                if not r["i"]:
                    x["runs"][k] = r | {"t": wide[at : at + n]}
                at += n
        return hits


#: Names of operations, and the order in which a part's go; within one name they keep their own.
ORDER = ("MOVE", "IMGOUT", "MOVETAB", "RENUM", "SHIFT", "SPLIT", "PGNO", "RELINK", "ADDMARK", "NOTEBACK", "HREF", "ANCHOR", "NOTELINK", "HEADRE", "PARATABLE", "CELL", "JOIN", "PARA", "HEAD", "FWPAREN")


def apply_operations(items: DataFrame, operations: list[tuple[str, str, list[str]]], key: str = "part") -> DataFrame:
    """Items (part, item_no, and ``ITEM_FIELDS``) after the operations ``(spec, name, arguments)`` of their part, numbered anew.

    ``spec`` is as in X1.  ``hits`` on a part's first item counts what each
    operation did, by its place in the list.
    """
    applies = [(i, _in_spec(spec), name.lower(), args) for name in ORDER for i, (spec, n, args) in enumerate(operations) if n == name]
    unknown = {n for _, n, _ in operations} - set(ORDER)
    if unknown:
        raise ValueError(f"unknown operations: {sorted(unknown)}")
    kinds = {f.name: f.dataType.simpleString() for f in items.schema.fields}
    fields = [f for f in ITEM_FIELDS if f in kinds]

    def fold(rows):
        found = [(r[0], dict.fromkeys(ITEM_FIELDS) | dict(zip(fields, r[2:])), r[1]) for r in rows]
        book = Items([x | {"runs": list(x["runs"] or [])} for _, x, _ in found])
        part, hits = found[0][2], [0] * len(operations)
        for i, test, name, args in applies:
            if test(part):
                hits[i] = getattr(book, name)(*args)
        for k, x in enumerate(book.items):
            yield (k, *(x[f] for f in fields), hits if k == 0 else None)

    out = "item_no int, " + ", ".join(f"{f} {kinds[f]}" for f in fields) + ", hits array<int>"
    return ordered_fold(items.withColumn("__part", F.col(key).cast("long")), [key], ["item_no"], ["__part", *fields], out, fold)


def _in_spec(spec: str) -> Callable[[int], bool]:
    ranges = [(int(lo), int(hi or lo)) for lo, _, hi in (x.partition("-") for x in spec.split(",") if x != "*")]
    return lambda part: "*" in spec.split(",") or any(a <= part <= b for a, b in ranges)


def fix_tree(markup: Column, rules: list[tuple[str, str]]) -> Column:
    """Literal rules in order over the text of markup, not over its tags."""
    fixed = lambda p: reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), rules, p)
    pieces = F.regexp_extract_all(markup, F.lit("(<[^>]*>|[^<]+|<)"), 1)
    return F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("<"), p).otherwise(fixed(p))), "")


def block_operations(blocks: DataFrame, ops: DataFrame, keys: list[str]) -> DataFrame:
    """Operations addressed by the blocks' original numbers, so they do not depend on one another's.

    ``blocks``: keys, bi, k, style, rank, line; ``ops``: op, lo, hi, value.
    style, rank (makes a heading), set (``k``), join (lo to hi, with value
    between), merge (lo and hi), gap (after a jammed ordinal), lstrip, drop;
    a later style or rank wins.  ``ops`` is configuration of a few rows.
    """
    numbered = ops.coalesce(1).withColumn("nth", F.monotonically_increasing_id())
    each = numbered.select("op", "value", "nth", F.explode(F.sequence("lo", "hi")).alias("bi"))
    by = lambda op: each.filter(F.col("op") == op)
    latest = lambda op: by(op).groupBy("bi").agg(F.max_by("value", "nth").alias(f"__{op}"))
    flag = lambda op: by(op).select("bi", F.lit(True).alias(f"__{op}")).distinct()
    joined = numbered.filter("op IN ('join', 'merge')").select(F.col("lo").alias("__into"), F.col("hi").alias("__last"), F.when(F.col("op") == "join", F.coalesce("value", F.lit(GAP_CJK))).otherwise("").alias("__sep"), F.col("op").alias("__how"))
    members = joined.select("__into", "__sep", F.explode(F.when(F.col("__how") == "merge", F.array("__into", "__last")).otherwise(F.sequence("__into", "__last"))).alias("bi"))
    out = blocks
    for part in (latest("style"), latest("rank"), latest("set"), flag("gap"), flag("lstrip"), flag("drop"), members):
        out = out.join(F.broadcast(part), "bi", "left")
    line = F.when(F.col("__gap"), F.regexp_replace("line", "^([一二三四五六七八九十百零〇]+)(?=[^一二三四五六七八九十百零〇 \\t\\n　、.．])", f"$1{GAP_CJK}")).otherwise(F.col("line"))
    out = out.withColumn("line", F.when(F.col("__lstrip"), F.regexp_replace(line, "^[　 ]+", "")).otherwise(line)).filter(F.col("__drop").isNull())
    head = F.col("__rank").isNotNull()
    out = out.withColumn("k", F.coalesce("__set", F.when(head, "h").when(F.col("__style").isNotNull(), "p"), "k"))
    out = out.withColumn("rank", F.when(head, F.col("__rank").cast("int")).otherwise(F.col("rank"))).withColumn("style", F.when(head, F.concat(F.lit("h"), "__rank")).otherwise(F.coalesce("__style", "style")))
    target = F.coalesce("__into", "bi")
    listed = F.sort_array(F.collect_list(F.struct("bi", "line", "k", "style", "rank", "__sep")))
    rows = out.groupBy(*keys, target.alias("__at")).agg(listed.alias("x"))
    return rows.select(*keys, F.col("__at").alias("bi"), *[F.get("x", F.lit(0))[c].alias(c) for c in ("k", "style", "rank")], F.expr("array_join(transform(x, r -> r.line), coalesce(x[0].__sep, ''))").alias("line"))


def pattern_level(text: Column, cls: Column, patterns: list[tuple[str, float]], keywords: list[tuple[str, float]], defaults: dict[str, float], deepest: float = 9.0) -> Column:
    """a heading's level: of the first numbering pattern, else of the first keyword, else of its class.

    Keywords of levels below ``deepest`` do not count against a class that has its own level.
    """
    own = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])[cls] if defaults else F.lit(None).cast("double")
    keyword = first_match(text, keywords)
    return F.coalesce(first_match(text, patterns), F.when((keyword > deepest) & own.isNotNull(), own).otherwise(keyword), own)


def elements(items: DataFrame, keys: list[str], styles: DataFrame, gap_classes: list[str]) -> DataFrame:
    """items as blocks: ``style`` by class (else by kind), ``gap`` before, ``box_starts``, ``note``; a title typed twice is one.

    ``items``: keys, item_no, k, cls, box, text; ``styles``: cls, style (a
    family's table, broadcast).  Notes are numbered among themselves, blocks too.
    """
    w = Window.partitionBy(*keys).orderBy("item_no")
    styled = items.join(F.broadcast(styles), "cls", "left")
    style = F.when(F.col("k") == "h", F.lit("heading")).otherwise(F.coalesce("style", F.when(F.col("k") == "li", "list").otherwise("body")))
    twice = (F.col("k") == "h") & (F.lag("k").over(w) == "h") & (F.lag("text").over(w) == F.col("text"))
    marked = styled.withColumns({"style": style, "note": F.col("k") == "note", "gap": F.col("cls").isin(gap_classes), "box_starts": F.col("box") & ~F.coalesce(F.lag("box").over(w), F.lit(False)), "__twice": F.coalesce(twice, F.lit(False))})
    own = Window.partitionBy(*keys, "note").orderBy("item_no")
    return marked.filter(~F.col("__twice")).withColumn("bi", F.row_number().over(own) - 1).drop("__twice")


def title_pages(blocks: DataFrame, keys: list[str], unit: str, chars: int = 260, parts: int = 10, longest: int = 40) -> DataFrame:
    """F8: units that are title pages: they begin with a heading, the next unit is deeper, and there is little text, all of it
    headings, centred or right lines, or short verse: ``keys, unit, divider``.

    ``blocks``: keys, unit, bi, k, style, lvl, line.
    """
    first = F.min_by(F.struct("k", "lvl"), "bi")
    plain = F.col("style").isin("body", "noindent") & (F.col("k") != "h")
    long_verse = F.col("style").isin("quote", "verse") & (F.length("line") > longest)
    intro = (F.col("k") == "h") & F.col("line").rlike("编者导言|前言|序言") & (F.col("bi") > 0)
    unlike = (F.col("bi") > 0) & ((plain & (F.col("k") == "p")) | long_verse | intro | ~F.col("k").isin("h", "p"))
    t = blocks.groupBy(*keys, unit).agg(first.alias("first"), F.sum(F.length("line")).alias("n"), F.count("*").alias("parts"), F.bool_or(unlike).alias("unlike"))
    deeper = F.lead("first.lvl").over(Window.partitionBy(*keys).orderBy(unit)) > F.col("first.lvl")
    divider = (F.col("first.k") == "h") & F.coalesce(deeper, F.lit(False)) & (F.col("n") < chars) & (F.col("parts") <= parts) & ~F.col("unlike")
    return t.withColumn("divider", divider).select(*keys, unit, "divider")


def link_in_order(marks: DataFrame, notes: DataFrame, keys: list[str], most: int = 3) -> DataFrame:
    """Marks to notes by number in a segment: ``keys, pos, n, note``.

    ``marks``: keys, pos, n, raised.  A raised mark links to its note in any
    case; a plain one if its number is not used yet and is no more than
    ``most`` from the last one linked, so years and list items are left alone.
    """
    known = marks.join(notes.select(*keys, "n").distinct().withColumn("__has", F.lit(True)), [*keys, "n"], "left").withColumn("__has", F.coalesce("__has", F.lit(False)))

    def fold(rows):
        last, used = 0, set()
        for pos, n, raised, has in rows:
            if raised:
                last = n
            elif has and n not in used and abs(n - last) <= most:
                last = max(n, last)
                used.add(n)
            else:
                continue
            if has:
                yield pos, n

    linked = ordered_fold(known, keys, ["pos"], ["n", "raised", "__has"], f"pos {marks.schema['pos'].dataType.simpleString()}, n {marks.schema['n'].dataType.simpleString()}", fold)
    return linked.join(notes, [*keys, "n"])


def page_of(asked: DataFrame, lines: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """``page_no`` of places in blocks (keys, bi, at): the line with the greatest start up to ``at``, on the page whose
    piece of the block holds it.

    ``lines``: keys, bi, line_no, start; ``plan``: keys, bi, lo, hi, page_no.
    An equi-join on the block; lines and pieces of a block are few.
    """
    from .joins import locate

    starts = lines.select(*keys, F.col("bi").alias("block"), F.col("start").alias("start_off"), F.col("line_no").alias("bi"))
    found = locate(asked.withColumnRenamed("bi", "block"), starts, [*keys, "block"], "at")
    placed = found.withColumnRenamed("bi", "line_no").withColumnRenamed("block", "bi")
    pieces = plan.select(*keys, "bi", "lo", "hi", "page_no")
    return placed.join(pieces, [*keys, "bi"]).filter((F.col("line_no") >= F.col("lo")) & (F.col("line_no") < F.col("hi"))).select(*keys, "bi", "at", "line_no", "page_no")
