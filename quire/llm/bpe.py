"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text sets its chunk borders, so a passage
that documents share falls into the same chunks wherever it stands.  A chunk is
encoded once and kept in a bounded store of the worker; so are words, which are
what chunks are encoded from.  A chunk border may cut a word: what stands
between a chunk's first and last white space does not depend on its neighbours
(the tokenizer never joins text over white space), and the two broken edges that
meet at a border are joined, over further chunks if these have no white space,
and encoded anew.  The result is exactly that of encoding the whole text.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, released, small_batches, string_arrays

#: Bytes under the rolling hash, and the bits that are zero at a border.
WINDOW, BORDER_BITS = 16, 8
#: Kept in each worker at most; a full store is emptied, and that of chunks at the end of a task too.
WORDS_KEPT, CHUNKS_KEPT = 200_000, 20_000
_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]+")


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted chunk borders of all texts, text ends among them; no border splits a character."""
    if len(data) > WINDOW:
        gear = _GEAR[data]
        rolled = np.zeros(len(data) - WINDOW + 1, np.uint32)
        for i in range(WINDOW):
            rolled += gear[i : i + len(rolled)] << np.uint32(i)
        at = np.flatnonzero(rolled >> np.uint32(32 - BORDER_BITS) == 0) + WINDOW
        at = at[at < len(data)]
        at = at[(data[at] & 0xC0) != 0x80]
    else:
        at = np.zeros(0, np.int64)
    return np.unique(np.concatenate([at, offsets]))


class ChunkCoder:
    """Encodes texts chunk by chunk; ``encode`` gives token count, packed ids and decoded text."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words: dict[bytes, tuple[bytes, str]] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.hits = self.misses = 0

    def _word(self, word: bytes) -> tuple[bytes, str]:
        """Encode a word; a comma or full stop after a letter is a token of its own, and ASCII case is folded."""
        if word[-1:] in (b",", b".") and word[-2:-1].isalpha() and b"<|" not in word:
            a, b = self.words.get(word[:-1]) or self._word(word[:-1])
            c, d = self.words.get(word[-1:]) or self._word(word[-1:])
            return a + c, f"{b} {d}"
        if word[:1].isupper() and word.isascii() and word.isalpha():
            lower = word.lower()
            return self.words.get(lower) or self._word(lower)
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        # A word's tokens are decoded together, and words are joined as decode() joins tokens.
        made = (struct.pack(f"<{len(ids)}I", *ids), self.tokenizer.decode(ids, skip_special_tokens=False) if ids else "")
        if len(self.words) >= WORDS_KEPT:
            self.words.clear()
        if len(word) <= 64:
            self.words[word] = made
        return made

    def _run(self, text: bytes) -> tuple[bytes, list[str]]:
        """Encode text whose ends are free: at a border of the text or next to white space."""
        get, made, ids, said = self.words.get, self._word, [], []
        for word in text.split():
            a, b = get(word) or made(word)
            ids.append(a)
            if a:
                said.append(b)
        return b"".join(ids), said

    def _chunk(self, chunk: bytes) -> tuple:
        """``(head, ids, said, tail)``; without white space all of it is head and tail is None."""
        kept = self.chunks.get(chunk)
        if kept is not None:
            self.hits += 1
            return kept
        self.misses += 1
        first = _SPACE.search(chunk)
        if first is None:
            made = (chunk, b"", "", None)
        else:
            tail = b"" if chunk[-1:].isspace() else chunk.rsplit(None, 1)[-1]
            ids, said = self._run(chunk[first.end() : len(chunk) - len(tail)])
            made = (chunk[: first.start()], ids, " ".join(said), tail)
        if len(self.chunks) >= CHUNKS_KEPT:
            self.chunks.clear()
        if len(chunk) <= 4096:
            self.chunks[chunk] = made
        return made

    def encode(self, pieces: list[bytes]) -> tuple[bytes, str]:
        """Packed ids and decoded text of the text that the pieces make up."""
        ids, said, open_edge = [], [], b""
        for piece in pieces:
            head, a, b, tail = self._chunk(piece)
            open_edge += head
            if tail is None:
                continue
            if open_edge:  # the repair: both edges of the border, encoded together
                again, words = self._run(open_edge)
                ids.append(again)
                said += words
            ids.append(a)
            if b:
                said.append(b)
            open_edge = tail
        if open_edge:
            again, words = self._run(open_edge)
            ids.append(again)
            said += words
        return b"".join(ids), " ".join(said)


def read_tokenizer(path: str) -> str:
    """The vocabulary file as text; it is read once, on the driver, and has a fixed size."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_CODERS: dict[str, ChunkCoder] = {}


def _coder(text: str) -> ChunkCoder:
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ChunkCoder(text)
    return _CODERS[key]


def encode_documents(docs: DataFrame, tokenizer_path: str, full: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if ``full``, ``ids`` and ``decoded``.

    For tokenizers whose tokens never span white space and whose decode joins
    tokens by a space (no decoder), such as ``word_bpe_49k.json``.  ids are
    packed as little-endian unsigned 32-bit integers for the digest.  Defined
    cases: a null or empty text has no tokens and decodes to ''; a null doc_id
    is kept; repeated rows each give a row; no rows give no rows; other columns
    are ignored.  One pass, no shuffle.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.list_(pa.int64())), ("decoded", pa.string())] if full else [])

    def run(batches):
        coder = _coder(shared.value)
        for batch in batches:
            data, offsets = string_arrays(batch.column("text"))
            docs_in = batch.column("doc_id")
            for a, b in chunks(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                at, raw, rows = borders(part, own), part.tobytes(), []
                where = np.searchsorted(at, own)
                cuts = at.tolist()
                for k in range(b - a):
                    edges = cuts[where[k] : where[k + 1] + 1]
                    ids, text = coder.encode([raw[x:y] for x, y in zip(edges, edges[1:])])
                    row = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]
                    rows.append(row + [np.frombuffer(ids, "<u4").astype(np.int64), text] if full else row)
                columns = [pa.array(x, t) for x, (_, t) in zip(zip(*rows), fields)]
                yield pa.RecordBatch.from_arrays([docs_in.slice(a, b - a), *columns], ["doc_id", *(n for n, _ in fields)])
        coder.chunks.clear()
        coder.words.clear()  # other tasks of this worker may be of other stages

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if full else "")
    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text").mapInArrow(released(run), schema)
