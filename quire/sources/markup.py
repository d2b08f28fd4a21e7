"""Lenient reading of marked-up parts into items of runs.

A stack machine over the tokens of a part, in ``mapInArrow``: one pass, no
shuffle.  Class and element names that mean something are a dialect, a
configuration of fixed size; three families' dialects are given.  An item's note
is one that a note element or a note class marks; its way back, if it is a
link of its own, goes to its number (P12).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..model import BREAK, ITEM, PICTURE, RUN

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass(frozen=True)
class Dialect:
    """What a family of books marks by elements and classes."""

    skip: frozenset[str] = frozenset(("nav", "svg", "hr", "script", "style", "title", "head"))
    quotes: frozenset[str] = frozenset(("blockquote",))
    boxes: frozenset[str] = frozenset(("aside",))
    box_classes: frozenset[str] = frozenset(("box", "note", "ad"))
    headings: dict[str, int] = field(default_factory=lambda: {"h1": 1, "h2": 1, "h3": 2, "h4": 3, "h5": 4, "h6": 5})
    bold: frozenset[str] = frozenset(("b", "strong"))
    raised: frozenset[str] = frozenset(("sup",))
    raised_classes: frozenset[str] = frozenset(("math-super",))
    italic: frozenset[str] = frozenset(("i", "em", "cite"))
    #: Class of a run for an inline element's class (P2), and classes that mark a note, an icon as a note's mark, and no text at all.
    run_classes: dict[str, str] = field(default_factory=dict)
    note_classes: frozenset[str] = frozenset(("duokan-footnote-item", "footnote", "notetext"))
    icon_classes: frozenset[str] = frozenset(("duokan-footnote",))
    skip_classes: frozenset[str] = frozenset(("toc",))
    #: The words of a link that only leads back.
    back_words: frozenset[str] = frozenset(("返回正文", "返回", "↩", "↩︎", "back"))
    #: Whether a character reference may lack its semicolon, as in HTML; in XHTML, such a one is plain text.
    open_references: bool = True

    @cached_property
    def acting(self) -> frozenset[str]:
        """Elements that do more than to give what is in them a meaning."""
        return _BLOCKS | frozenset(self.headings) | frozenset("a br img main table td th tr".split())


#: Dialects of three families of books: one marks kinds by elements, one by classes of paragraphs, one by classes of spans.
FAMILIES = {
    "elements": Dialect(),
    "paragraph classes": Dialect(quotes=frozenset(("blockquote", "dd")), box_classes=frozenset(("box", "kuang")), run_classes={"kaiti": "kai", "fs": "fs", "sc": "sc"}),
    "span classes": Dialect(bold=frozenset(("b", "strong", "big")), raised_classes=frozenset(("math-super", "sup", "ref")), run_classes={"italic": "it", "bold": "b", "kai": "kai"}, skip_classes=frozenset(("toc", "nav", "copyright"))),
}


#: A run outside of all elements.
_RUN = {"t": "", "b": 0, "s": 0, "h": None, "a": None, "i": None, "c": None, "m": None}


class _Element:
    """An open element, and what it and those around it mean in a dialect: no text, a note, a box, and a run's attributes."""

    __slots__ = ("tag", "attrs", "skips", "notes", "boxes", "run")

    def __init__(self, d: Dialect, tag: str, attrs: dict, around: _Element | None):
        self.tag, self.attrs = tag, attrs
        classes = (attrs.get("class") or "").split() if attrs else ()
        self.skips = (around is not None and around.skips) or tag in d.skip or not d.skip_classes.isdisjoint(classes)
        self.notes = (around is not None and around.notes) or (tag == "aside" and "footnote" in (attrs.get("epub:type") or "")) or not d.note_classes.isdisjoint(classes)
        self.boxes = (around is not None and around.boxes) or tag in d.boxes or not d.box_classes.isdisjoint(classes)
        run = _RUN if around is None else around.run
        if tag in d.bold:
            run = run | {"b": 1}
        if tag in d.raised or not d.raised_classes.isdisjoint(classes):
            run = run | {"s": 1}
        if tag == "a" and attrs.get("href"):
            run = run | {"h": attrs["href"]}
        if tag in d.italic:
            run = run | {"c": "it"}
        if tag == "span" and classes:
            run = run | {"c": " ".join(dict.fromkeys(d.run_classes.get(c, c) for c in classes))}
        self.run = run


#: A token of plain markup: text without references, cells of text alone, an element of text alone with no attribute but
#: a class, a start tag, or an end tag. A value without quotes ends before a space or the tag's end.
_PLAIN = re.compile(
    r"""(([^<&]+)"""
    r"""|((?:<td>[^<&]*</td>)+)"""
    r"""|<([a-z][a-z0-9]*)(?: class=(?:"([^"<>&]*)"|'([^'<>&]*)'))?>([^<&]+)</\4>"""
    r"""|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_][a-zA-Z0-9_:.-]*=(?:"[^"<>&]*"|'[^'<>&]*'|[a-zA-Z0-9_.-]+(?=[ \t\n\r\f>])))*)[ \t\n\r\f]*(/?)>"""
    r"""|</([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*>)"""
)
_CELL = re.compile("<td>([^<]*)</td>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_][a-zA-Z0-9_:.-]*)=(?:"([^"]*)"|'([^']*)'|([a-zA-Z0-9_.-]+))""")
#: Elements whose content the parser reads in another way.
_RAW = re.compile("<(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext)", re.IGNORECASE)
_WIDE_SPACE = re.compile(r"[\t\r\n\f]|  ")
_SPACES = re.compile(r"[ \t\r\n\f]+")
_BLOCKS = frozenset("p li div section article ul ol blockquote figcaption pre figure aside body footer header".split())


def _plain_tokens(markup: str) -> list[tuple] | None:
    """The tokens of markup that is all plain, as ``_PLAIN``'s groups; None if any of it is not."""
    if "<!" in markup or "&" in markup or _RAW.search(markup):
        return None
    tokens = _PLAIN.findall(markup)
    return tokens if sum(len(t[0]) for t in tokens) == len(markup) else None


#: Elements that are kept to be used again.
KNOWN = 4096
#: Stands for no class attribute; one without a value is None.
_UNCLASSED = ()


class _Reader(HTMLParser):
    def __init__(self, dialect: Dialect, known: dict | None = None):
        super().__init__(convert_charrefs=True)
        self.known = {} if known is None else known
        self.d, self.items, self.stack = dialect, [], []
        self.runs: list[dict] = []
        self.kind: tuple[str, str, str | None, str | None, int | None] | None = None
        self.pending: str | None = None
        self.after_comment = False
        self.rows: list[list[str]] | None = None
        self.spans: list[list[int]] = []
        self.heads: list[bool] = []
        self.cell: list[str] | None = None

    # context ---------------------------------------------------------------------------------
    def _open(self, *names: str) -> int:
        return sum(1 for e in self.stack if e.tag in names)

    def _element(self, tag: str, attrs: dict) -> _Element:
        """The element where the reader is; those with no attribute but a class are made once."""
        around = self.stack[-1] if self.stack else None
        if attrs and (len(attrs) > 1 or "class" not in attrs):
            return _Element(self.d, tag, attrs, around)
        key = (around, tag, attrs["class"] if attrs else _UNCLASSED)
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            known = self.known[key] = _Element(self.d, tag, attrs, around)
        return known

    def _skipping(self) -> bool:
        return bool(self.stack) and self.stack[-1].skips

    def _noted(self) -> bool:
        return bool(self.stack) and self.stack[-1].notes

    def _put(self, text: str, within: _Element | None = None, **more) -> None:
        if self.cell is not None:
            self.cell.append(text)
            return
        run = (within.run if within else self.stack[-1].run if self.stack else _RUN).copy()
        run["t"], run["a"] = text, self.pending
        run.update(more)
        self.pending = None
        self.runs.append(run)

    def _flush(self) -> None:
        runs, self.runs = self.runs, []
        kind, self.kind = self.kind, None
        merged: list[dict] = []
        code = "".join(r["t"] for r in runs) if kind and kind[0] == "pre" else ""
        for r in runs:
            t = r["t"]
            if t != BREAK and _WIDE_SPACE.search(t):
                t = _SPACES.sub(" ", t)
            if not t:
                continue
            if r["h"] and merged and len(t) > 1 and t[0] in "。，；：、！？）」』”" and re.fullmatch(r"[［\[][0-9]+[］\]]", t[1:]):
                # a mark whose link also takes in the punctuation before it
                if merged[-1]["h"] or merged[-1]["i"] or merged[-1]["s"]:
                    merged.append(r | {"t": "", "h": None, "a": None, "s": 0})
                merged[-1]["t"] += t[0]
                t = t[1:]
            r["t"] = t
            last = merged[-1] if merged else None
            if last and last["c"] == r["c"] and last["s"] == r["s"] and last["b"] == r["b"] and last["h"] == r["h"] and last["a"] == r["a"] and BREAK not in (last["t"], t) and not (r["i"] or r["m"] or last["i"] or last["m"]):
                last["t"] += t
            else:
                merged.append(r)
        while merged and merged[0]["t"] in (BREAK, " "):
            merged.pop(0)
        while merged and merged[-1]["t"] in (BREAK, " "):
            merged.pop()
        if merged:
            merged[0]["t"] = merged[0]["t"].lstrip(" ")
            merged[-1]["t"] = merged[-1]["t"].rstrip(" \u3000")
        merged = [r for r in merged if r["t"]]
        if not merged:
            return
        tag, cls, ident, src, level = (kind[0], kind[1], kind[2], kind[3], kind[4]) if kind else ("p", "", None, None, None)
        if tag != "pre" and self._noted():
            self._item("note", tag, cls, ident, None, src, self._linked_back(merged, ident or next((e.attrs["id"] for e in reversed(self.stack) if e.attrs.get("id")), None)))
            return
        if tag == "pre":  # an item a line
            lines = [[merged[0] | {"t": line.rstrip()}] for line in code.split("\n") if line.strip()]
            if lines:
                self._item("p", "pre", cls, ident, None, src, lines[0])
                first = self.items[-1]
                self.items += [first | {"runs": line} for line in lines[1:]]
            return
        k = "h" if level else "img" if all(r["i"] for r in merged) else "li" if self._open("li") or tag == "li" else "p"
        self._item(k, tag, cls, ident, level, src, merged)

    def _linked_back(self, runs: list[dict], ident: str | None) -> list[dict]:
        """A note's number, as a run that links back to its mark and has the note's anchor; a link that only leads back goes."""
        ways = [r for r in runs if r["h"] and r["t"].strip() in self.d.back_words]
        if len(ways) != 1:
            return runs
        anchor = next((r["a"] for r in runs if r["a"]), None) or ident
        rest = [r | {"a": None} for r in runs if r is not ways[0]]
        m = re.match(r"\s*(\[\d+\]|\d+\.)", rest[0]["t"]) if rest else None
        if not m:
            return [r for r in runs if r is not ways[0]]
        label = rest[0] | {"t": m[1], "h": ways[0]["h"], "a": anchor}
        return [r for r in (label, rest[0] | {"t": rest[0]["t"][m.end() :], "h": None}, *rest[1:]) if r["t"]]

    def _item(self, k, tag, cls, ident, level, src, runs, **more) -> None:
        boxed = bool(self.stack) and self.stack[-1].boxes
        self.items.append({"k": k, "tag": tag, "cls": cls or "", "id": ident, "lvl": level, "depth": self._open("ul", "ol"), "q": self._open(*self.d.quotes) > 0, "box": boxed, "src": src, "runs": runs, "rows": None, "spans": None, "heads": None} | more)

    # events ----------------------------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        self.after_comment = False
        if self._skipping() and tag not in _VOID:
            self.stack.append(self._element(tag, attrs))
            return
        if tag not in self.d.acting and not attrs.get("id"):
            if tag not in _VOID:
                self.stack.append(self._element(tag, attrs))
            return
        classes = (attrs.get("class") or "").split()
        if tag == "a" and self.d.icon_classes.intersection(classes) and attrs.get("href"):
            number = re.search(r"[0-9]+$", attrs.get("id") or attrs["href"])  # an icon is a note's mark; its number is its id's
            self.stack.append(self._element(tag, attrs | {"icon": "1"}))
            if number:
                self._put(str(int(number[0])), s=1, h=attrs["href"], a=attrs.get("id"))
            return
        if tag == "img" and self.stack and self.stack[-1].attrs.get("icon"):
            return
        if tag == "br":
            self._put(BREAK)
        elif tag == "img":
            self._put(PICTURE, i=(attrs.get("src") or "").rsplit("/", 1)[-1])
        elif tag == "table":
            self._flush()
            self.rows, self.spans, self.heads = [], [], []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
            self.spans.append([])
            self.heads.append(True)
        elif tag in ("td", "th") and self.rows is not None:
            if not self.rows:
                self.rows, self.spans, self.heads = [[]], [[]], [True]
            self._end_cell()
            self.cell = []
            span = attrs.get("colspan") or "1"
            self.spans[-1].append(int(span) if span.isdigit() else 1)
            self.heads[-1] = self.heads[-1] and tag == "th"
        elif tag in _BLOCKS or tag == "main" or tag in self.d.headings:
            if self.cell is not None:
                self.cell.append(" ")
            else:
                self._flush()
                while self.stack and tag in ("p", *self.d.headings) and self.stack[-1].tag in ("p", "b", "i", "em", "strong", "a", "span"):
                    self.stack.pop()  # a paragraph ends one that was left open, and what was open in it
                if tag in self.d.headings or tag in ("p", "li", "figcaption", "pre"):
                    self.kind = (tag, attrs.get("class") or "", attrs.get("id"), None, self.d.headings.get(tag))
        elif attrs.get("id"):
            if self.runs and tag == "span" and self._noted():
                self.runs[-1]["a"] = self.runs[-1]["a"] or attrs["id"]  # a note's anchor may stand at its end
            else:
                self.pending = attrs["id"]
        if tag not in _VOID:
            self.stack.append(self._element(tag, attrs))

    def _end_cell(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
        self.cell = None

    def _cells(self, texts: list[str]) -> None:
        """Cells of a table that hold text alone."""
        self.after_comment = False
        if not self.rows:
            self.rows, self.spans, self.heads = [[]], [[]], [True]
        self._end_cell()
        self.rows[-1] += [" ".join(text.split()) for text in texts]
        self.spans[-1] += [1] * len(texts)
        self.heads[-1] = False

    def _leaf(self, tag: str, cls: str, text: str) -> None:
        """An element that holds text alone."""
        attrs = {"class": cls} if cls else {}
        if tag in self.d.acting or tag in _VOID or self._skipping():
            self.handle_starttag(tag, attrs)
            self.handle_data(text)
            self.handle_endtag(tag)
            return
        self.after_comment = False
        element = self._element(tag, attrs)
        if not element.skips:
            self._put(text, element)

    def handle_endtag(self, tag):
        self.after_comment = False
        if tag not in self.d.acting and self.stack and self.stack[-1].tag == tag:
            self.stack.pop()
            return
        if tag in ("td", "th", "tr", "table"):
            self._end_cell()
        if tag == "table" and self.rows is not None:
            rows, self.rows = self.rows, None
            self._item("table", "table", "", None, None, None, [], rows=rows, spans=self.spans, heads=[h and bool(r) for h, r in zip(self.heads, rows)])
        if tag in _BLOCKS or tag in self.d.headings:
            if self.cell is None:
                self._flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                break

    def handle_comment(self, data):
        self.after_comment = True

    def read(self, markup: str) -> None:
        """All of the markup; what is plain goes without the parser."""
        tokens = _plain_tokens(markup)
        if tokens is None:
            self.feed(markup)
            self.close()
        else:
            for _, text, cells, tag, cls, own, within, begun, attrs, closed, ended in tokens:
                if text:
                    self.handle_data(text)
                elif cells:
                    texts = _CELL.findall(cells)
                    if self.rows is not None and "td" not in self.d.skip and not self._skipping():
                        self._cells(texts)
                    else:
                        for text in texts:
                            self.handle_starttag("td", [])
                            if text:
                                self.handle_data(text)
                            self.handle_endtag("td")
                elif tag:
                    self._leaf(tag, cls or own, within)
                elif begun:
                    self.handle_starttag(begun.lower(), [(k.lower(), a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attrs)] if attrs else [])
                    if closed:
                        self.handle_endtag(begun.lower())
                else:
                    self.handle_endtag(ended.lower())
        self._flush()

    def handle_data(self, data):
        if self.after_comment:  # P11: the text right after a comment goes with it
            self.after_comment = False
            return
        if not self._skipping():
            self._put(data)


def _plain_ampersand(m: re.Match) -> str:
    return m[0] if m[1] or m[2] + ";" in html5 and m[3] else "&amp;" + m[0][1:]


def closed_references(markup: str) -> str:
    """The markup, where an ampersand that begins no reference with a semicolon is written as one."""
    return re.sub(r"&(?:(#(?:[0-9]+|[xX][0-9a-fA-F]+);)|([A-Za-z][A-Za-z0-9]*|)(;?))", _plain_ampersand, markup)


def read_items(markup: str | None, dialect: Dialect = Dialect(), known: dict | None = None) -> list[dict]:
    """Items of one part; ``known``: elements of parts read before, in the same dialect."""
    reader = _Reader(dialect, known)
    reader.read((markup or "") if dialect.open_references else closed_references(markup or ""))
    for k, item in enumerate(reader.items):
        item["item_no"] = k
    return reader.items


def items(parts: DataFrame, part: str, markup: str, dialect: Dialect = Dialect(), fields: tuple[str, ...] | None = None, run_fields: tuple[str, ...] | None = None) -> DataFrame:
    """A row an item of each part, in order of ``item_no``; all columns, or those of ``fields``, and of runs those of ``run_fields``."""
    kept = [f for f in ITEM.fields if fields is None or f.name in fields]
    if run_fields is not None:
        of_runs = T.ArrayType(T.StructType([f for f in RUN.fields if f.name in run_fields]))
        kept = [T.StructField("runs", of_runs) if f.name == "runs" else f for f in kept]
    schema = T.StructType(kept)
    arrow = to_arrow_schema(schema)

    def runs_array(lists: list[list[dict]], kind: pa.ListType) -> pa.Array:
        """Field by field, which costs a small part of what an array of dictionaries does."""
        flat, fields = list(itertools.chain.from_iterable(lists)), list(kind.value_type)
        columns = [pa.array([run[f.name] for run in flat], f.type) for f in fields]
        return pa.ListArray.from_arrays(pa.array([0, *itertools.accumulate(map(len, lists))], pa.int32()), pa.StructArray.from_arrays(columns, fields=fields)).cast(kind)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        columns = {f.name: [row[f.name] for row in rows] for f in arrow}
        return pa.RecordBatch.from_arrays([runs_array(columns["runs"], f.type) if f.name == "runs" else pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            rows, runs = [], 0
            for key, text in zip(batch.column("part").to_pylist(), batch.column("markup").to_pylist()):
                read = read_items(text, dialect, known)
                for item in read:
                    item["part"] = key
                rows += read
                runs += sum(len(item["runs"]) for item in read)
                if len(rows) + runs > 20_000:
                    yield batch_of(rows)
                    rows, runs = [], 0
            if rows:
                yield batch_of(rows)

    return parts.selectExpr(f"CAST({part} AS BIGINT) AS part", f"{markup} AS markup").mapInArrow(run, schema)
