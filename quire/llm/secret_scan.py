"""Secret scans with a worklist of decoded layers.

A span found in a layer is mapped back through all layers above it: URL and
Unicode escapes character by character, base64 by four characters for three
bytes, over line ends too.  What compressed data holds maps to the whole piece.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import codecs
import hashlib
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are maximal, so a least length in the pattern drops the same matches as a later test.
_HEX = re.compile(r"[0-9a-f]{24,}")
#: What may hold an escape; of each such token, the escapes are looked for in one pass.
_TOKEN = re.compile(r"[^\s\"'<>]+")
_URL_CUE, _URL_RUN = re.compile(r"%[0-9A-Fa-f]{2}"), re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE_CUE = re.compile(r"\\u[0-9A-Fa-f{]|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#x?[0-9A-Fa-f]")
_UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}(?![A-Za-z0-9+/_=-])")
#: Base64 over lines: whole lines of one length but the last, which may be shorter, as tools wrap it; quotes (``>``) and indents too.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t>]*[A-Za-z0-9+/_-]{1,})+={0,2}(?![A-Za-z0-9+/_=-])")
_BREAK = re.compile(r"[ \t]*\r?\n[ \t>]*")
#: A layer is unpacked in pieces, and a longer text in windows of about so many characters.
WINDOW = 1 << 20
#: No span and no encoded piece goes over white space, but an assignment's spaces next to its sign and base64 over line ends.
_SAFE = re.compile(r"(?<![:=\s>])[ \t]+(?=[^:=\s>])|(?<![A-Za-z0-9+/_\s>-])\r?\n")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind; code points, end exclusive."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _packed(head: bytes) -> bool:
    """Is this the start of gzip or zlib data?"""
    return head[:2] == b"\x1f\x8b" or (head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0)


def _unpack(pieces, members: int | None = None):
    """The unpacked pieces of gzip (all members) or zlib data; returns how many members are whole.

    What follows the last whole member is ignored; ``members`` stops after so many.
    """
    worker, rest, whole = zlib.decompressobj(wbits=47), b"", 0
    for data in pieces:
        data = rest + data
        rest = b""
        while True:
            if worker is None:  # between two members
                if len(data) < 2:
                    rest = data
                    break
                if data[:2] != b"\x1f\x8b":
                    return whole
                worker = zlib.decompressobj(wbits=31)
            try:
                out = worker.decompress(data, WINDOW)
            except zlib.error:
                return whole
            if out:
                yield out
            if worker.eof:
                data, worker, whole = worker.unused_data, None, whole + 1
                if whole == members:
                    return whole
                continue
            data = worker.unconsumed_tail
            if not data and len(out) < WINDOW:
                break
    return whole


def _opened(pieces):
    """``pieces`` (a function that gives an iterator of bytes) through all its gzip and zlib layers that are whole."""
    while True:
        head = b""
        for piece in pieces():
            head += piece
            if len(head) > 2:
                break
        if not _packed(head):
            return pieces
        test = _unpack(pieces())
        while True:
            try:
                next(test)
            except StopIteration as end:
                whole = end.value
                break
        if not whole:
            return pieces
        pieces = lambda below=pieces, n=whole: _unpack(below(), n)


def _windows(pieces):
    """The text of UTF-8 pieces (errors replaced) in windows that no span or encoded piece goes over; what has no such place stays whole."""
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    held, size, enough = [], 0, WINDOW
    for piece in pieces:
        held.append(decoder.decode(piece))
        size += len(held[-1])
        if size > enough:
            text = "".join(held)
            at = 0
            for at in (m.end() for m in _SAFE.finditer(text)):
                pass
            if at:
                yield text[:at]
            held, size = [text[at:]], len(text) - at
            enough = max(WINDOW, 2 * size)
    text = "".join(held) + decoder.decode(b"", True)
    if text:
        yield text


def _one(m: re.Match) -> str:
    value = int(next(g for g in m.groups()[:5] if g), 16) if any(m.groups()[:5]) else int(m[6])
    return chr(value) if value < 0x110000 and not 0xD800 <= value < 0xE000 else m[0]


def _url_run(m: re.Match) -> str:
    return bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape")


class _Bytes:
    """How many UTF-8 bytes the first characters of a text take; counted once, when first asked."""

    def __init__(self, text: str):
        self.text, self.sums = text, None

    def __call__(self, at: int) -> int:
        if self.sums is None:
            code = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
            escaped = (code >= 0xDC80) & (code < 0xDD00)  # a byte that is no text
            self.sums = np.concatenate([[0], np.cumsum(np.where(escaped, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))])
        return int(self.sums[at])


class _Places:
    """Maps spans of a token whose escapes are replaced to spans of the token; the table is made once, when first asked."""

    def __init__(self, token: str, pattern: re.Pattern, one):
        self.token, self.pattern, self.one = token, pattern, one
        self.keys: list[int] = []

    def _fill(self) -> None:
        made, source, self.starts = 0, 0, []  # (place in the layer, place in the token, its escape's end and bytes or None)
        for m in self.pattern.finditer(self.token):
            said = self.one(m)
            self.starts.append((made, source, None, None))
            made += m.start() - source
            self.starts.append((made, m.start(), m.end(), _Bytes(said) if self.pattern is _URL_RUN else None))
            made, source = made + len(said), m.end()
        self.starts.append((made, source, None, None))
        self.keys = [x[0] for x in self.starts]

    def _place(self, at: int, end: bool) -> int:
        # The end of a span is the end of its last character.
        made, source, until, run = self.starts[(bisect.bisect_left(self.keys, at) if end else bisect.bisect_right(self.keys, at)) - 1]
        if until is None:
            return source + at - made
        if run:
            return source + 3 * run(at - made)
        return until if end else source

    def __call__(self, a: int, b: int) -> tuple[int, int]:
        if not self.keys:
            self._fill()
        return self._place(a, False), self._place(b, True)


def _replaced(token: str, pattern: re.Pattern, one) -> tuple[str, Callable[[int, int], tuple[int, int]]]:
    """A token with its escapes replaced, and what maps a span of the result to one of the token."""
    return pattern.sub(one, token), _Places(token, pattern, one)


def decoded_layers(text: str):
    """``(start, end, layer, locate)``: the encoded pieces of a text and what they decode to, one level down.

    ``locate`` maps a span of the layer to one of the text; it is None if only the whole piece can be told.
    """
    for cue, pattern, one in ((_URL_CUE, _URL_RUN, _url_run), (_UNICODE_CUE, _UNICODE_ONE, _one)):
        if cue.search(text):
            for m in _TOKEN.finditer(text):
                if cue.search(m[0]):
                    layer, locate = _replaced(m[0], pattern, one)
                    if layer != m[0]:
                        yield m.start(), m.end(), layer, lambda a, b, at=m.start(), locate=locate: tuple(at + x for x in locate(a, b))
    for m in _BASE64.finditer(text):
        for layer, locate in _base64_layers(m[0]):
            yield m.start(), m.end(), layer, locate and (lambda a, b, at=m.start(), locate=locate: tuple(at + x for x in locate(a, b)))
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            for lines in _wrapped(m):
                start, end = lines[0][0], lines[-1][1]
                for layer, locate in _base64_layers("".join(text[a:b] for a, b in lines)):
                    yield start, end, layer, locate and (lambda a, b, lines=lines, locate=locate: _over_lines(lines, *locate(a, b)))


def _wrapped(m: re.Match):
    """The stretches of a run of base64 lines that one wrapping made: lines of one length, and a last one not longer."""
    lines, at = [], m.start()
    for stop in [*_BREAK.finditer(m.string, m.start(), m.end()), None]:
        end = stop.start() if stop else m.end()
        lines.append((at, end))
        at = stop.end() if stop else end
    k = 0
    while k < len(lines) - 1:
        size, last = lines[k][1] - lines[k][0], k
        while last + 1 < len(lines) and lines[last + 1][1] - lines[last + 1][0] == size:
            last += 1
        if last + 1 < len(lines) and lines[last + 1][1] - lines[last + 1][0] < size:
            last += 1
        if last > k and size >= 16:
            yield lines[k : last + 1]
        k = max(last, k + 1)


def _over_lines(lines: list[tuple[int, int]], a: int, b: int) -> tuple[int, int]:
    """A span of joined lines of one length (but for the last) as one of the text."""
    size = lines[0][1] - lines[0][0]
    first, last = min(a // size, len(lines) - 1), min((b - 1) // size, len(lines) - 1)
    return lines[first][0] + a - first * size, lines[last][0] + b - last * size


def _base64_layers(piece: str):
    """What a base64 piece decodes to, in windows if it was compressed, each with a map of its spans to the piece's."""
    body = piece.rstrip("=")
    if len(body) % 4 == 1:
        return
    try:
        raw = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return
    whole = lambda: iter([raw])
    opened = _opened(whole)
    if opened is not whole:
        yield from ((layer, None) for layer in _windows(opened()))
        return
    text = raw.decode(errors="surrogateescape")
    upto = _Bytes(text)

    def locate(a: int, b: int) -> tuple[int, int]:
        return upto(a) * 4 // 3, len(piece) if b == len(text) else -(-upto(b) * 4 // 3)

    yield text, locate


def all_spans(text: str) -> list[tuple[int, int, str]]:
    """Base spans and those of decoded layers, mapped to the text.

    The worklist goes depth first and holds one layer of each depth; a layer
    whose text (by digest) was seen under the same piece is not opened again,
    so cycles end.
    """
    found, seen = set(base_spans(text)), set()
    work = [(lambda a, b: (a, b), decoded_layers(text))]
    while work:
        above, layers = work[-1]
        start, end, layer, locate = next(layers, (0, 0, None, None))
        if layer is None:
            work.pop()
            continue
        a, b = above(start, end)
        key = a, b, hashlib.blake2b(layer.encode(errors="surrogatepass"), digest_size=16).digest()
        if key in seen or layer == text:
            continue
        seen.add(key)
        outer = (lambda x, y, above=above, locate=locate: above(*locate(x, y))) if locate else (lambda x, y, a=a, b=b: (a, b))
        found.update((*outer(x, y), kind) for x, y, kind in base_spans(layer))
        work.append((outer, decoded_layers(layer)))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


#: A text with none of these has no span, whatever it decodes to: an assignment needs ``:`` or ``=``,
#: the others and every encoded piece a run of 12 characters of this set, or an escape.
_CUE = re.compile(r"[:=%\\]|&#|[A-Za-z0-9+/_-]{12}")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of each document.

    The counts and the digest are of the base spans; ``spans`` lists these and
    the ones in decoded layers as ``kind:start:end``.  Defined cases: null or
    empty text has no spans (digest of ''); a layer that is not valid is
    not opened, and bytes that are no text are replaced in it; a null doc_id is kept;
    repeated rows each give a row; no rows give no rows; other columns are
    ignored.  One pass, no shuffle.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = all_spans(text) if _CUE.search(text) else []
                base = base_spans(text) if spans else []
                count = [sum(k == kind for _, _, k in base) for kind in KINDS]
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*rows), types))], names) if rows else pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([], t) for t in types)], names)

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
