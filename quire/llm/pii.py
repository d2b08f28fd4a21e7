"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Each value is found by its form and, where the form has one, validated (issuer
and check digit of cards, areas of social security numbers, check digits of
IBANs, octets of addresses, the calendar).  A value's number within its format is
permuted by a Feistel network with cycle walking, so the pseudonym has the same
format and is valid too, equal values get equal pseudonyms in all documents, and
no two values of a format share one.  A value is permuted in its canonical form
(digits of a phone number without its country code, lower case of an address,
the day of a date), and its own spelling is laid over the result; so values that
are equal but for spelling stay linked as well.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
ROUNDS = 10
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Letters of Latin-1 other than ASCII that have both cases in it.
_LOWER_1 = "".join(chr(c) for c in range(0xE0, 0xFF) if c != 0xF7)
_UPPER_1 = _LOWER_1.upper()
#: Characters of an address at most (RFC 5321).
EMAIL_CHARS = 254
_ALPHABET = {c: a for a in (_LOWER, _UPPER, _DIGIT, _LOWER_1, _UPPER_1) for c in a}
#: Dates from the first to the last are permuted among themselves.
FIRST_DATE, LAST_DATE = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)

_PATTERNS = {
    "email": re.compile(r"(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"),
    "phone": re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?![\w]|-\d)|(?<![\w+])(?:\+\d{1,3}[ .-]?)(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w]|-\d)|(?<![\w+)])\(\d{3}\)[ .-]?\d{3}[.-]?\d{4}(?!\w)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w]|[.-]\d)"),
    "ip": re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"),
    "date": re.compile(r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4})(?![\w]|[./-]\d)"),
}
_CUE = re.compile(r"[@0-9]")


class Feistel:
    """Permutations of ``range(n)``, one for each key, kind and n."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _stream(self, said: bytes, size: int) -> bytes:
        """``size`` pseudorandom bytes; blake2b gives 64 at most."""
        if size <= 64:
            return hashlib.blake2b(said, key=self.key, digest_size=size).digest()
        return b"".join(hashlib.blake2b(b"%d|%s" % (k, said), key=self.key).digest() for k in range(-(-size // 64)))[:size]

    def permute(self, value: int, n: int, kind: str) -> int:
        if n < 2:
            return value
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = value >> half, value & mask
            for i in range(ROUNDS):
                said = b"%s|%d|%d|%d" % (kind.encode(), n, i, right)
                f = int.from_bytes(self._stream(said, 32 + half // 8), "big")
                left, right = right, left ^ (f & mask)
            value = left << half | right
            if value < n:  # a value outside the format walks on; the walk is a permutation too
                return value


def _permuted(text: str, feistel: Feistel, kind: str) -> str:
    """All letters and digits permuted together; each stays in its class, other characters stand."""
    value, n = 0, 1
    for c in text:
        if a := _ALPHABET.get(c):
            value, n = value * len(a) + a.index(c), n * len(a)
    form = "".join("x" if c in _LOWER else "X" if c in _UPPER else "0" if c in _DIGIT else "l" if c in _LOWER_1 else "L" if c in _UPPER_1 else c for c in text)
    value = feistel.permute(value, n, f"{kind}:{form}")
    out = []
    for c in reversed(text):
        if a := _ALPHABET.get(c):
            value, k = divmod(value, len(a))
            c = a[k]
        out.append(c)
    return "".join(reversed(out))


def _filled(pattern: str, digits: str) -> str:
    """``pattern`` with its letters and digits replaced in order by ``digits``."""
    rest = iter(digits)
    return "".join(next(rest) if c.isalnum() else c for c in pattern)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


#: Issuer prefixes of payment cards: first and last number of a range, and the lengths used.
_ISSUERS = (("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("6011", "6011", (16, 19)), ("644", "659", (16, 19)), ("300", "305", (14,)), ("36", "36", (14,)), ("38", "39", (14,)), ("3528", "3589", (16,)), ("62", "62", (16, 17, 18, 19)))


def _issuer(digits: str) -> int:
    return next((len(a) for a, b, sizes in _ISSUERS if len(digits) in sizes and a <= digits[: len(a)] <= b), 0)


def _card(text: str, feistel: Feistel) -> str | None:
    digits = re.sub(r"\D", "", text)
    prefix = _issuer(digits)
    if not prefix or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[prefix:-1]
    made = digits[:prefix] + str(feistel.permute(int(body), 10 ** len(body), f"card:{digits[:prefix]}")).zfill(len(body))
    return _filled(text, made + luhn_digit(made))


def _ssn(text: str, feistel: Feistel) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    index = area - 1 - (area > 666)
    value = feistel.permute((index * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    value, serial = divmod(value, 9999)
    index, group = divmod(value, 99)
    return f"{index + 1 + (index >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban(text: str, feistel: Feistel) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _permuted(plain[4:], feistel, f"iban:{plain[:2]}")
    return _filled(text, plain[:2] + f"{98 - _mod97(body + plain[:2] + '00'):02d}" + body)


#: Country calling codes of one and of two digits; all others have three.
_CODES_1 = "1 7".split()
_CODES_2 = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def _country_code(text: str) -> int:
    """Where the number after ``+`` and a country's code begins: what a separator ends, or else the code that the digits begin with; 0 without one."""
    m = re.match(r"\+(\d+)", text)
    if not m:
        return 0
    if len(m[1]) <= 3 and m.end() < len(text):
        return m.end()
    return 1 + (1 if m[1][:1] in _CODES_1 else 2 if m[1][:2] in _CODES_2 else 3)


def _phone(text: str, feistel: Feistel) -> str | None:
    if not 7 <= sum(c.isdigit() for c in text) <= 15:
        return None
    at = _country_code(text)
    digits = "".join(c for c in text[at:] if c.isdigit())
    return text[:at] + _filled(text[at:], _permuted(digits, feistel, "phone"))


def _email(text: str, feistel: Feistel) -> str | None:
    """All but the top domain; capitals stay where they are."""
    if len(text) > EMAIL_CHARS:
        return None
    at = text.rindex(".")
    made = _permuted("".join(c.lower() if c in _ALPHABET else c for c in text[:at]), feistel, "email")
    return "".join(m.upper() if c in _UPPER or c in _UPPER_1 else m for c, m in zip(text, made)) + text[at:]


def _ip(text: str, feistel: Feistel) -> str | None:
    octets = text.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in octets):
        return None
    value = feistel.permute(int.from_bytes(bytes(map(int, octets)), "big"), 2**32, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(text: str, feistel: Feistel) -> str | None:
    form = "%d.%m.%Y" if "." in text else "%Y/%m/%d" if "/" in text else "%Y-%m-%d"
    try:
        day = datetime.datetime.strptime(text, form).date()
    except ValueError:
        return None
    if not FIRST_DATE <= day <= LAST_DATE:
        return None
    span = (LAST_DATE - FIRST_DATE).days + 1
    return (FIRST_DATE + datetime.timedelta(feistel.permute((day - FIRST_DATE).days, span, "date"))).strftime(form)


_MAKERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date}


def pseudonymise(text: str, feistel: Feistel) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and ``(start, end, kind)`` of each replaced value in the input.

    Of values that overlap, the first to start stays, then the kind listed first.
    """
    if not _CUE.search(text):
        return text, []
    found = []
    for kind, pattern in _PATTERNS.items():
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if (made := _MAKERS[kind](m[0], feistel)) is not None:
                found.append((m.start(), KINDS.index(kind), m.end(), made))
    out, spans, at = [], [], 0
    for start, k, end, made in sorted(found):
        if start >= at:
            out += [text[at:start], made]
            spans.append((start, end, KINDS[k]))
            at = end
    return "".join(out) + text[at:], spans


def pseudonymise_documents(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_found`` and ``spans`` (``kind:start:end``, in the input) of each document.

    ``key`` is the secret of the permutation; whoever holds it can undo it.
    It must be kept and given again for later documents to stay linked with these.
    Defined cases: null text stays null with no spans; addresses of over 254
    characters are none and stand; empty text stays empty;
    values that do not validate stand; dates in ISO form, with slashes (year
    first) or with dots (day first) from 1900 to 2099; a null doc_id is kept;
    repeated rows each give a row; no rows give no rows; other columns are
    ignored.  One pass, no shuffle.
    """
    names = ["doc_id", "text", "n_found", "spans"]

    def run(batches):
        feistel = Feistel(key)
        for batch in batches:
            texts, counts, spans = [], [], []
            for text in batch.column("text").to_pylist():
                made, found = (None, []) if text is None else pseudonymise(text, feistel)
                texts.append(made)
                counts.append(len(found))
                spans.append(",".join(f"{k}:{a}:{b}" for a, b, k in found))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(spans, pa.string())], names)

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text").mapInArrow(run, "doc_id long, text string, n_found long, spans string")
