"""Main-text extraction: structure of the page, then a suffix array over each host's pages.

A page is cut into blocks of text; those in menus, headers, footers, sidebars,
notices, adverts, forms, scripts and reader comments go by their elements, their
role, and classes that say nothing else.  All visible blocks of a host's pages,
these too, are token streams, and a suffix array (by prefix doubling, to the
depth of the shortest repeat that counts) finds the substrings that most distinct
pages of the host share.  Such boilerplate is removed wherever it is: a menu
that is marked on most pages is known on a page that does not mark it.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A repeat counts from this many tokens, if it is on at least this share of the
#: host's distinct pages, and these are at least as many.
REPEAT_TOKENS, REPEAT_SHARE, REPEAT_PAGES = 8, 0.5, 8
#: Pages of one host that are in one suffix array, at most; and their characters.
PAGES_TOGETHER, CHARS_TOGETHER = 1024, 4_000_000
#: A host with more than this share of all pages or bytes is dealt to several groups, each of at least so many pages or bytes.
BIG_SHARE, LEAST_PAGES, LEAST_BYTES = 1000, 256, 16 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_START = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
#: To the end of a tag; a quote counts only after ``=``, and only if it is closed.
_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+>""")
_RAW = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "title")}
#: One attribute: a name, and a value in quotes or without; what stands in quotes is no attribute.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?|"[^"]*"|'[^']*'""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("nav footer aside form button head dialog menu object video audio canvas map fieldset".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Words of a class that name what is not the article, and words that may stand beside one (``site-footer``).
#: A class is marked if all of its words are known and one is of the first kind.
_MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sidebar aside widget widgets footer masthead topbar toolbar"
    " comment comments commentlist disqus respond replies share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay".split()
)
_BESIDE = frozenset("site page post article main top bottom left right box list area section wrapper wrap container bar links link block unit slot item items posts articles row col column inner outer content header head title global primary secondary user reader form google".split())
_ROLES = frozenset("navigation banner complementary contentinfo search form menu menubar toolbar alert alertdialog dialog".split())
#: Block elements whose start ends an open paragraph.
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul".split())
#: Elements whose start ends open ones of these names, unless an element of the kind named last stands between.
_ENDS = {"li": (("li",), "list"), "dt": (("dt", "dd"), "list"), "dd": (("dt", "dd"), "list"), "tr": (("tr",), "table"), "td": (("td", "th"), "row"), "th": (("td", "th"), "row"), "tbody": (("thead", "tbody", "tfoot"), "table"), "tfoot": (("thead", "tbody", "tfoot"), "table"), "thead": (("thead", "tbody", "tfoot"), "table")}
_BARRIERS = {"p": frozenset("table td th caption button object template".split()), "list": frozenset("ul ol menu dir dl table td th article section aside nav main header footer form figure details blockquote".split()), "table": frozenset(["table"]), "row": frozenset(["table", "tr"])}


#: Pairs of words that name readers' comments, though each alone may stand in an article.
_PAIRS = [frozenset(x.split()) for x in ("reader notes", "reader letters", "user notes", "user reviews", "reader opinions")]


def _names_aside(names: str) -> bool:
    """Whether one of some class names or identifiers says what is not the article: all its words are known, numbers aside."""
    for word in names.lower().split():
        parts = {x for x in re.split(r"[-_]+", word) if x and not x.isdecimal()}
        if (not _MARKED.isdisjoint(parts) and all(x in _MARKED or x in _BESIDE for x in parts)) or any(pair <= parts for pair in _PAIRS):
            return True
    return False


def _is_marked(marks: str) -> bool:
    """Whether the attributes of an element say that it is hidden or not of the article; of equal names the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(marks):
        if name:
            found.setdefault(name.lower(), value.strip("\"'"))
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    return not _ROLES.isdisjoint(found.get("role", "").lower().split()) or _names_aside(found.get("class", "")) or _names_aside(found.get("id", ""))


class _Open:
    """The open elements, with the implied end tags of HTML; each step takes constant time on the average."""

    def __init__(self):
        self.stack: list[tuple[str, str] | None] = []  # None: an inline element that was closed below others
        self.at: dict[str, list[int]] = {}
        self.barriers: dict[str, list[int]] = {k: [] for k in _BARRIERS}
        self.count = {"dropped": 0, "article": 0, "main": 0, "": 0}

    def push(self, name: str, kind: str) -> None:
        for k, names in _BARRIERS.items():
            if name in names:
                self.barriers[k].append(len(self.stack))
        self.at.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, kind))
        self.count[kind] += 1

    def cut(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        while len(self.stack) > depth:
            entry = self.stack.pop()
            if entry:
                self.at[entry[0]].pop()
                self.count[entry[1]] -= 1
        for found in self.barriers.values():
            while found and found[-1] >= depth:
                found.pop()

    def implied(self, name: str) -> None:
        """Close what the start of ``name`` ends."""
        if name in _ENDS_P:
            self._end(("p",), "p")
        if name in _ENDS:
            self._end(*_ENDS[name])

    def _end(self, names: tuple[str, ...], barrier: str) -> None:
        depth = max((self.at[x][-1] for x in names if self.at.get(x)), default=-1)
        if depth >= 0 and not (self.barriers[barrier] and self.barriers[barrier][-1] > depth):
            self.cut(depth)

    def end(self, name: str) -> None:
        """An end tag: all elements inside go too, but for an inline one, which ends alone."""
        if not self.at.get(name):
            return
        depth = self.at[name][-1]
        if name not in _INLINE or depth == len(self.stack) - 1:
            self.cut(depth)
        else:
            self.at[name].pop()
            self.count[self.stack[depth][1]] -= 1
            self.stack[depth] = None
        while self.stack and self.stack[-1] is None:
            self.stack.pop()


def _tags(page: str):
    """``(text before, is an end tag, name, attributes)`` of each tag, in one pass; the last row and those of raw elements have no name.

    Once a tag's quotes swallow all that follows, quotes no longer count in the rest of the page.
    """
    at = here = 0
    quotes = True
    while m := _START.search(page, here):
        before = page[at : m.start()]
        if m[1]:
            end = page.find("-->", m.end())
            at = here = len(page) if end < 0 else end + 3
            yield before, False, "", ""
            continue
        found = quotes and m[4] and _REST.match(page, m.end())
        quotes = bool(found) or quotes and not m[4]
        end = found.end() if found else page.find(">", m.end()) + 1
        if not end:
            break
        name, marks = (m[4] or "").lower(), page[m.end() : end - 1]
        if name in _RAW and not m[3]:
            close = _RAW[name].search(page, end) if name != "svg" or not marks.endswith("/") else found or m
            at = here = max(end, close.end()) if close else len(page)
            yield before + " ", False, "", ""
            continue
        at = here = end
        yield before, bool(m[3]), name, marks
    yield page[at:], False, "", ""


def marked_blocks(page: str) -> list[str]:
    """All visible blocks of a page, each after a mark: ``+`` in its article, else in its main element, else in its body; ``-`` elsewhere."""
    tree = _Open()
    count = tree.count
    blocks: list[tuple[str, str]] = []
    text: list[str] = []
    aside: list[str] = []

    def flush(parts: list[str], region: str) -> None:
        if parts:
            block = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if block:
                blocks.append((region, block))

    def region() -> str:
        return "article" if count["article"] else "main" if count["main"] else "body"

    for before, closing, name, marks in _tags(page):
        if before:
            (aside if count["dropped"] else text).append(before)
        if not name:
            continue
        if name in _INLINE:
            if name == "br" or name == "img":
                (aside if count["dropped"] else text).append(" ")
                continue
        elif count["dropped"]:
            flush(aside, "aside")
        else:
            flush(text, region())
        if not closing:
            tree.implied(name)
            if aside and not count["dropped"]:
                flush(aside, "aside")
        if name in _VOID:
            continue
        if closing:
            tree.end(name)
            if not count["dropped"]:
                flush(aside, "aside")
            continue
        if name == "body":  # ends a head that was left open
            tree.cut(0)
        kind = ""
        if name in _DROPPED or (name == "header" and not count["article"]):
            kind = "dropped"
        elif marks and name not in ("html", "body") and _is_marked(marks):
            kind = "dropped"
        elif name == "article" or name == "main":
            kind = name
        if kind == "dropped" and name in _INLINE and not count["dropped"]:
            text.append(" ")
        tree.push(name, kind)
    flush(aside, "aside")
    flush(text, region())
    seen = {name for name, _ in blocks}
    chosen = next((name for name in ("article", "main", "body") if name in seen), None)
    return [("+" if name == chosen else "-") + block for name, block in blocks]


def parse_blocks(page: str) -> list[str]:
    """The blocks of a page's article, else of its main element, else of its body."""
    return [block[1:] for block in marked_blocks(page) if block[0] == "+"]


def _ranks(tokens: np.ndarray, least: int) -> np.ndarray:
    """The rank of each suffix by its first ``least`` tokens (prefix doubling); equal ranks are repeats."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < least:
        step = min(depth, least - depth)
        after = np.concatenate([rank[step:], np.full(min(step, len(rank)), -1)])
        key = rank * (rank.max() + 2) + after + 1
        rank, depth = np.unique(key, return_inverse=True)[1].astype(np.int64), depth + step
    return rank


def _stream(pages: list[list[str]]):
    """Of pages as marked blocks: token ids with a negative one after each stretch of one mark, the pages
    that own them, where a run of ``REPEAT_TOKENS`` may start, the 64-bit hashes of these runs, and which tokens are text."""
    ids: dict[str, int] = {}
    tokens: list[int] = []
    text: list[bool] = []
    lengths, end = [], 0
    for page in pages:
        before, mark = len(tokens), None
        for block in page:
            if mark is not None and block[0] != mark:
                end -= 1
                tokens.append(end)
                text.append(False)
            mark = block[0]
            words = block[1:].split(" ")
            tokens += [ids.setdefault(w, len(ids)) for w in words]
            text += [mark == "+"] * len(words)
        end -= 1
        tokens.append(end)
        text.append(False)
        lengths.append(len(tokens) - before)
    flat = np.array(tokens, np.int64)
    names = np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in ids), "<u8")
    hashed = np.where(flat >= 0, names[np.maximum(flat, 0)], np.uint64(0)) if len(names) else np.zeros(len(flat), np.uint64)
    padded = np.concatenate([hashed, np.zeros(REPEAT_TOKENS, np.uint64)])
    runs = np.zeros(len(flat), np.uint64)
    for j in range(REPEAT_TOKENS):
        runs = runs * _FACTOR + padded[j : j + len(flat)]
    ends = np.concatenate([[0], np.cumsum(flat < 0), np.full(REPEAT_TOKENS, len(pages) + len(flat) + 1)])
    starts = ends[REPEAT_TOKENS : REPEAT_TOKENS + len(flat)] == ends[: len(flat)]
    return flat, np.repeat(np.arange(len(pages)), lengths), starts, runs, np.array(text, bool)


def _on_pages(labels: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """On how many pages each label (below n) is."""
    pairs = np.unique(labels * (owner.max() + 1) + owner) if len(labels) else labels
    return np.bincount(pairs // (owner.max() + 1), minlength=n) if len(labels) else np.zeros(n, np.int64)


class Host:
    """The distinct pages of a host, or of a deal of one, packed; they are looked at in slices of bounded size.

    A run that is on a share of all pages is on that share of some slice's
    pages, so the runs found by the slices' suffix arrays are candidates for
    the whole host.  These are counted over all slices, so the slices do not
    show in the result.
    """

    def __init__(self, packed):
        self.place: dict[bytes, int] = {}
        for x in packed:
            self.place.setdefault(x, len(self.place))
        self.pages = list(self.place)
        self.unpacker = zstandard.ZstdDecompressor()
        self.whole: list | None = None

    def slices(self):
        at, room = 0, -(-len(self.pages) // max(1, -(-len(self.pages) // PAGES_TOGETHER)))
        while at < len(self.pages):
            out, size = [], 0
            while at + len(out) < len(self.pages) and len(out) < room and size < CHARS_TOGETHER:
                text = self.unpacker.decompress(self.pages[at + len(out)]).decode()
                out.append(text.split("\n") if text else [])
                size += len(text)
            yield out
            at += len(out)

    def streams(self):
        """The slices with their streams; those of a single slice are kept."""
        if self.whole is not None:
            yield from self.whole
            return
        for part in self.slices():
            made = part, _stream(part)
            if len(part) == len(self.pages):
                self.whole = [made]
            yield made

    def candidates(self) -> np.ndarray:
        found = [np.zeros(0, np.uint64)]
        for part, (flat, owner, starts, runs, _) in self.streams():
            if not starts.any():
                continue
            rank = _ranks(flat, REPEAT_TOKENS)[starts]
            pages = _on_pages(rank, owner[starts], int(rank.max()) + 1)
            found.append(np.unique(runs[starts][pages[rank] >= REPEAT_SHARE * len(part)]))
        return np.unique(np.concatenate(found))

    def counts(self, candidates: np.ndarray) -> np.ndarray:
        """On how many pages each candidate is, and of how many it is in the text."""
        out = np.zeros((2, len(candidates)), np.int64)
        for _, (_, owner, starts, runs, text) in self.streams() if len(candidates) else ():
            runs, owner, text = runs[starts], owner[starts], text[starts]
            at = np.minimum(np.searchsorted(candidates, runs), len(candidates) - 1)
            same = candidates[at] == runs
            out[0] += _on_pages(at[same], owner[same], len(candidates))
            out[1] += _on_pages(at[same & text], owner[same & text], len(candidates))
        return out

    def texts(self, repeats: np.ndarray) -> list[str]:
        """The text of each distinct page without the tokens that ``repeats`` (sorted) cover."""
        made = []
        if not len(repeats):
            return ["\n".join(b[1:] for b in page if b[0] == "+") for part in self.slices() for page in part]
        for part, (flat, owner, starts, runs, text) in self.streams():
            at = np.minimum(np.searchsorted(repeats, runs), len(repeats) - 1)
            edges = np.zeros(len(flat) + REPEAT_TOKENS + 1, np.int64)
            begin = np.flatnonzero(starts & (repeats[at] == runs))
            edges[begin] += 1
            edges[begin + REPEAT_TOKENS] -= 1
            cover = np.cumsum(edges)[: len(flat)] > 0
            stays, firsts = ~cover[text], np.searchsorted(owner[text], np.arange(len(part)))
            for page, at in zip(part, firsts.tolist()):
                kept = []
                for block in page:
                    if block[0] == "+":
                        words = block[1:].split(" ")
                        run = [w for w, stay in zip(words, stays[at : at + len(words)].tolist()) if stay]
                        at += len(words)
                        if run:
                            kept.append(" ".join(run))
                made.append("\n".join(kept))
        return made


def often(candidates: np.ndarray, counts: np.ndarray, pages: int) -> np.ndarray:
    """The candidates that are repeats of a host of so many distinct pages, without what is in the text of
    one page only: a menu or teaser on the others may quote its title."""
    return candidates[(counts[0] >= max(REPEAT_PAGES, int(np.ceil(REPEAT_SHARE * pages)))) & (counts[1] != 1)]


def repeats_of(host: Host) -> np.ndarray:
    """The repeats of a host that is held whole."""
    if len(host.pages) < REPEAT_PAGES:
        return np.zeros(0, np.uint64)
    found = host.candidates()
    return often(found, host.counts(found), len(host.pages))


def _pack(blocks: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("\n".join(blocks).encode())  # a block has no break in it


def unique_runs(pages: list[list[str]]) -> list[str]:
    """The texts of a host's pages, given as blocks, without what most of them repeat."""
    packed = [_pack(["+" + b for b in blocks]) for blocks in pages]
    host = Host(packed)
    made = host.texts(repeats_of(host))
    return [made[host.place[x]] for x in packed]


def _parsed(batches):
    """The blocks of each page, compressed: what is shuffled is some 0.4 of the text.  Equal pages are in one deal."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        at, pages = 0, batch.column("html")
        deals = batch.column("deals").to_pylist()
        while at < len(pages):
            packed, size = [], 0
            while at + len(packed) < len(pages) and size < 1 << 21:
                page = pages[at + len(packed)].as_py() or ""
                size += len(page)
                packed.append(packer.compress("\n".join(marked_blocks(page)).encode()))  # a block has no break in it
            part = [batch.column(c).slice(at, len(packed)) for c in ("page_id", "url", "host")]
            deal = [zlib.crc32(x) % n if n > 1 else 0 for x, n in zip(packed, deals[at:])]
            yield pa.RecordBatch.from_arrays([*part, pa.array(deal, pa.int32()), pa.array(packed, pa.binary())], ["page_id", "url", "host", "deal", "blocks"])
            at += len(packed)


def _hosts(batches):
    """Over rows in order of (host, deal): each group's host, page_ids, urls and packed pages."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("host", "deal", "page_id", "url", "blocks"))):
            if held and row[:2] != key:
                yield key[0], held
                held = []
            key = row[:2]
            held.append(row[2:])
    if held:
        yield key[0], held


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages`` (page_id, url, html).

    Blocks are joined by ``\\n``; inside one, white space is one space and
    character references are decoded.  Defined cases: null or empty html gives
    ''; a page without an article or main element gives its body's blocks;
    pages of a null or odd url share the host ''; equal pages count as one when
    repeats are counted; repeated rows each give a row; a null page_id is
    kept; no rows give no rows; other columns are ignored.

    Only the parsed blocks are shuffled, once, by host.  The hosts with over a
    thousandth of all pages or characters are at most two thousand; their
    pages are dealt to groups by content, the driver gets their candidates and
    counts, and their repeats are broadcast.  A worker holds one group's
    packed pages and one slice.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.withColumn("host", host)
    sizes = pages.groupBy("host").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).alias("size"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    least, most = max(LEAST_PAGES, -(-(total["n"] or 0) // BIG_SHARE)), max(LEAST_BYTES, -(-(total["size"] or 0) // BIG_SHARE))
    large = sizes.filter((F.col("n") > least) | (F.col("size") > most)).collect()
    big = {r["host"]: max(-(-r["n"] // least), -(-r["size"] // most)) for r in large}
    deals = F.create_map(*[F.lit(x) for pair in big.items() for x in pair])[F.col("host")] if big else F.lit(None)
    pages = pages.withColumn("deals", F.coalesce(deals, F.lit(1)).cast("int"))
    parsed = pages.mapInArrow(_parsed, "page_id long, url string, host string, deal int, blocks binary")
    dealt = parsed.repartition(F.col("host"), F.col("deal")).sortWithinPartitions("host", "deal")
    known = spark.sparkContext.broadcast(None)
    if big:
        # One shuffle serves all passes: its files belong to this RDD.
        rows = dealt._jdf.queryExecution().toRdd()
        dealt = DataFrame(dealt._jdf.sparkSession().internalCreateDataFrame(rows, dealt._jdf.schema(), False), spark)
        known = spark.sparkContext.broadcast(_big_repeats(dealt, set(big)))

    def texts(batches):
        for name, held in _hosts(batches):
            group = Host(x[2] for x in held)
            made = group.texts(known.value[name] if name in big else repeats_of(group))
            for at in range(0, len(held), PAGES_TOGETHER):
                part = held[at : at + PAGES_TOGETHER]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.string()), pa.array([made[group.place[x[2]]] for x in part], pa.string())], ["page_id", "url", "text"])

    out = dealt.mapInArrow(texts, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def _big_repeats(dealt: DataFrame, big: set[str]) -> dict[str, np.ndarray]:
    """The repeats of hosts that are dealt to several groups: candidates of all groups, counted over all groups."""
    sc = dealt.sparkSession.sparkContext

    def first(batches):
        for name, held in _hosts(batches):
            if name in big:
                group = Host(x[2] for x in held)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(group.pages)]), pa.array([group.candidates().tobytes()], pa.binary())], ["host", "n", "runs"])

    pages: dict[str, int] = dict.fromkeys(big, 0)
    found = {name: np.zeros(0, np.uint64) for name in big}
    for r in cut(dealt.mapInArrow(first, "host string, n long, runs binary")).toLocalIterator():
        pages[r["host"]] += r["n"]
        found[r["host"]] = np.union1d(found[r["host"]], np.frombuffer(r["runs"], np.uint64))
    shared = sc.broadcast(found)

    def second(batches):
        for name, held in _hosts(batches):
            if name in big:
                counts = Host(x[2] for x in held).counts(shared.value[name])
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([counts.tobytes()], pa.binary())], ["host", "counts"])

    total = {name: np.zeros((2, len(runs)), np.int64) for name, runs in found.items()}
    for r in cut(dealt.mapInArrow(second, "host string, counts binary")).toLocalIterator():
        total[r["host"]] += np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    return {name: often(runs, total[name], pages[name]) for name, runs in found.items()}
