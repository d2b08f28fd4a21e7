"""X: correction rules: which apply, applying them, and which were of no use."""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..model import PICTURE, RUN

RULES = "rule_no int, spec string, old string, new string, note string"


def example_rules(spark: SparkSession) -> DataFrame:
    """A few rules over the test documents."""
    return spark.createDataFrame([
        (1, "*", "thr", "th-r", "spelling: all parts"), (2, "3,7,11", "tion", "sion", "spelling/part: three parts"),
        (3, "20-40", "qqqq", "", "stale"), (4, "0-99", " ,", ",", "space: before a comma"),
    ], RULES)


def rule_ranges(rules: DataFrame) -> DataFrame:
    """A row for each range of parts that a rule names: ``lo, hi``; ``*`` is all."""
    one = F.explode(F.split("spec", ",")).alias("one")
    ranged = rules.select("*", one)
    lo = F.when(F.col("one") == "*", F.lit(-(2**62))).otherwise(F.split_part("one", F.lit("-"), F.lit(1)).cast("long"))
    hi = F.when(F.col("one") == "*", F.lit(2**62)).when(F.col("one").contains("-"), F.split_part("one", F.lit("-"), F.lit(2)).cast("long")).otherwise(F.col("one").cast("long"))
    return ranged.withColumn("lo", lo).withColumn("hi", hi).drop("one")


def select_rules(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """``part`` with each rule that applies to it, once.

    Rules are configuration, a few thousand rows; Spark broadcasts them by
    their measured size.
    """
    r = rule_ranges(rules)
    return parts.join(r, (F.col("part") >= F.col("lo")) & (F.col("part") <= F.col("hi"))).drop("lo", "hi").distinct()


@dataclass(frozen=True)
class Pattern:
    """An old text given as a regular expression; the new one may refer to its groups (``\\1``)."""

    pattern: str
    new: str


class RuleBook:
    """Rules in their order, each ``(rule_no, old or Pattern, new, ranges of parts)``, ready to be applied to texts.

    One automaton holds the literal texts of all rules.  A scan tells which rules
    a text has any use for; these alone are tried, in order.  What a rule puts
    in may complete the old text of a later one, so the surroundings of each new
    text are scanned again.  The cost is a scan and a replacement for
    each rule that applies, however many rules there are.  An empty old text matches nothing.
    """

    def __init__(self, rules: list[tuple[int, str | Pattern, str, list[tuple[int, int]]]]):
        self.rules = rules
        self.by_literal: dict[str, list[int]] = {}
        self.patterns = {}
        for k, (_, old, _, _) in enumerate(rules):
            if isinstance(old, Pattern):
                self.patterns[k] = re.compile(old.pattern)
            elif old:
                self.by_literal.setdefault(old, []).append(k)
        self.longest = max(map(len, self.by_literal), default=0)
        self.automaton = ahocorasick.Automaton()
        for old, ks in self.by_literal.items():
            self.automaton.add_word(old, ks)
        if self.by_literal:
            self.automaton.make_automaton()

    @classmethod
    def of_rows(cls, rows: list[dict]) -> RuleBook:
        return cls([(r["rule_no"], r["old"], r["new"], _ranges(r["spec"])) for r in sorted(rows, key=lambda r: r["rule_no"])])

    def _applies(self, k: int, part: int | None) -> bool:
        ranges = self.rules[k][3]
        return not ranges or (part is not None and any(lo <= part <= hi for lo, hi in ranges))

    def _present(self, text: str) -> set[int]:
        return {k for _, ks in self.automaton.iter(text) for k in ks} if self.by_literal else set()

    def _walk(self, state, text_of, step, part: int | None):
        """Rules that may apply, in order; ``step`` tries one on the state and gives the places of its new texts."""
        text, hits = text_of(state), {}
        waiting = [k for k in self._present(text) | set(self.patterns) if self._applies(k, part)]
        heapq.heapify(waiting)
        queued = set(waiting)
        while waiting:
            k = heapq.heappop(waiting)
            state, places = step(state, k)
            if not places:
                continue
            hits[self.rules[k][0]] = hits.get(self.rules[k][0], 0) + len(places)
            text, near = text_of(state), self.longest - 1
            around = [text] if len(places) * 2 * self.longest >= len(text) else [text[max(0, a - near) : b + near] for a, b in places]
            for later in set().union(*map(self._present, around)) - queued:
                if later > k and self._applies(later, part):
                    heapq.heappush(waiting, later)
                    queued.add(later)
        return state, hits

    def found(self, text: str, k: int) -> list[tuple[int, int, str]]:
        """The places of a rule's old text, leftmost first without overlaps, and what each becomes."""
        _, old, new, _ = self.rules[k]
        if k in self.patterns:
            return [(m.start(), m.end(), m.expand(old.new)) for m in self.patterns[k].finditer(text) if m.end() > m.start()]
        out, at = [], text.find(old)
        while at >= 0:
            out.append((at, at + len(old), new))
            at = text.find(old, at + len(old))
        return out

    def fix(self, text: str, part: int | None = None) -> tuple[str, dict[int, int]]:
        """The text after all rules, and how often each applied."""

        def step(now: str, k: int):
            found = self.found(now, k)
            return (_spliced(now, found) if found else now), _new_places(found)

        return self._walk(text, lambda t: t, step, part)

    def fix_runs(self, runs: list[dict], part: int | None = None) -> tuple[list[dict], dict[int, int]]:
        """The same over runs: an occurrence may span runs; what replaces it takes the first run's attributes.

        A picture counts as one character, and goes if it stands inside an occurrence.
        """

        def step(now: list[dict], k: int):
            found = self.found(_flat(now), k)
            return (_replaced(now, found) if found else now), _new_places(found)

        return self._walk(runs, _flat, step, part)


def _flat(runs: list[dict]) -> str:
    return "".join(PICTURE if r.get("i") else r["t"] for r in runs)


def _spliced(text: str, found: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, new in found:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def _new_places(found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Where the new texts stand afterwards."""
    out, moved = [], 0
    for a, b, new in found:
        out.append((a + moved, a + moved + len(new)))
        moved += len(new) - (b - a)
    return out


def _ranges(spec: str) -> list[tuple[int, int]]:
    """``*``: no ranges, for all parts; else the ranges that a rule names."""
    parts = [] if spec == "*" else spec.split(",")
    if "*" in parts:
        return []
    return [(int(lo), int(hi or lo)) for lo, _, hi in (x.strip().partition("-") for x in parts)]


#: Rules that are sent to all tasks at most; a book has a few thousand.
MOST_RULES = 1_000_000


def _sent(rules: DataFrame):
    """The rules as a broadcast table: configuration, counted before."""
    n = rules.count()
    if n > MOST_RULES:
        raise ValueError(f"{n} rules are no configuration; at most {MOST_RULES} are broadcast")
    rows = [r.asDict() for r in rules.select("rule_no", "spec", "old", "new").collect()]
    return rules.sparkSession.sparkContext.broadcast(rows)


HITS = "array<struct<rule_no:int,hits:bigint>>"


def _fixed(texts: DataFrame, rules: DataFrame, text: str, part: str, hits: str, keep_text: bool) -> DataFrame:
    sent = _sent(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = RuleBook.of_rows(sent.value)
        for batch in batches:
            done = [("", {}) if t is None else book.fix(t, p) for t, p in zip(batch.column(text).to_pylist(), batch.column(part).to_pylist())]
            found = pa.array([[{"rule_no": k, "hits": n} for k, n in sorted(h.items())] for _, h in done], pa.list_(pa.struct([("rule_no", pa.int32()), ("hits", pa.int64())])))
            if not keep_text:
                yield pa.RecordBatch.from_arrays([found], [hits])
                continue
            fixed = pa.array([None if t is None else x for t, (x, _) in zip(batch.column(text).to_pylist(), done)], pa.string())
            yield pa.RecordBatch.from_arrays([*[fixed if c == text else batch.column(c) for c in batch.schema.names], found], [*batch.schema.names, hits])

    if not keep_text:
        return texts.select(text, part).mapInArrow(run, f"{hits} {HITS}")
    typed = texts.withColumn(text, F.col(text).cast("string"))
    return typed.mapInArrow(run, T.StructType([*typed.schema.fields, T.StructField(hits, T._parse_datatype_string(HITS))]))


def apply_literal(texts: DataFrame, rules: DataFrame, text: str = "text", part: str = "part", hits: str | None = None) -> DataFrame:
    """X2 over plain texts: each rule in order, every occurrence, in the text that the rules before it left.

    The rules are broadcast as one automaton, so neither the plan nor the scan
    grows with their number.  ``hits`` names a further column with how often each rule applied.
    Null text stays null; a null part is touched by rules for all parts only.
    """
    out = _fixed(texts, rules, text, part, hits or "__hits", True)
    return out if hits else out.drop("__hits")


def usage(texts: DataFrame, rules: DataFrame, text: str = "text", part: str = "part") -> DataFrame:
    """``rule_no, hits``: how often each rule applied, in the text that the rules before it left; 0: stale."""
    found = _fixed(texts, rules, text, part, "found", False).select(F.inline("found")).groupBy("rule_no").agg(F.sum("hits").alias("hits"))
    return rules.select("rule_no").join(found, "rule_no", "left").fillna(0, ["hits"])


def fix_runs(runs: list[dict], rules: list[tuple[str, str] | Pattern]) -> tuple[list[dict], list[int]]:
    """X2 over the runs of one item: rules ``(old, new)`` or ``Pattern`` in order, and how often each applied."""
    fixed, hits = _book(rules).fix_runs(runs)
    return fixed, [hits.get(k, 0) for k in range(len(rules))]


def _book(rules: list[tuple[str, str] | Pattern]) -> RuleBook:
    return RuleBook([(k, r, r.new, []) if isinstance(r, Pattern) else (k, *r, []) for k, r in enumerate(rules)])


def _replaced(runs: list[dict], found: list[tuple[int, int, str]]) -> list[dict]:
    """Runs with spans of their text replaced: each run's own stretches in order, a span's new text where it begins."""
    out, at, k = [], 0, 0
    for r in runs:
        picture = r.get("i")
        end = at + (1 if picture else len(r["t"]))
        pieces, here, touched = [], at, False
        while here < end:
            while k < len(found) and found[k][1] <= here:
                k += 1
            a, b, new = found[k] if k < len(found) else (end, end, "")
            if a > here:
                pieces.append(r["t"] if picture else r["t"][here - at : min(a, end) - at])
                here = min(a, end)
            else:
                touched = True
                if a >= at:
                    pieces.append(new)
                here = min(b, end)
        made = "".join(pieces)
        if made:
            out.append(r | {"t": made} | ({"i": None} if picture and touched else {}))
        at = end
    return out


def fix_item_runs(items: DataFrame, rules: list[tuple[str, str] | Pattern]) -> DataFrame:
    """Rules over the runs of items, in Arrow batches.

    Only the runs' texts and pictures are read; their other fields are taken along by number.
    """
    schema = T.StructType([*[f for f in items.schema.fields if f.name != "hits"], T.StructField("hits", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)
    kind = arrow.field("runs").type

    def fixed_runs(column: pa.Array, fixed: list[list[dict]]) -> pa.Array:
        flat, old = list(itertools.chain.from_iterable(fixed)), column.flatten()
        kept = pa.array([r["at"] for r in flat], pa.int64())
        made = [pa.array([r[f.name] for r in flat], f.type) if f.name in ("t", "i") else old.field(f.name).take(kept) for f in kind.value_type]
        ends = pa.array([0, *itertools.accumulate(map(len, fixed))], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(made, fields=list(kind.value_type))).cast(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = _book(rules)
        for batch in batches:
            column = batch.column("runs")
            flat, at, done = column.flatten(), 0, []
            ts, pictures = flat.field("t").to_pylist(), flat.field("i").to_pylist()
            for n in column.value_lengths().to_pylist():
                done.append(book.fix_runs([{"t": ts[k], "i": pictures[k], "at": k} for k in range(at, at + n)]))
                at += n
            hits = [[h.get(k, 0) for k in range(len(rules))] for _, h in done]
            made = {"runs": lambda: fixed_runs(column, [r for r, _ in done]), "hits": lambda: pa.array(hits, arrow.field("hits").type)}
            yield pa.RecordBatch.from_arrays([made[f.name]() if f.name in made else batch.column(f.name) for f in arrow], schema=arrow)

    return items.mapInArrow(run, schema)


def reorder(items: DataFrame, moves: DataFrame) -> DataFrame:
    """X5 MOVE: items (part, item_no) to the place after ``after``, if just one source and one destination match."""
    one = items.join(moves.select("part", F.col("source").alias("item_no"), "after"), ["part", "item_no"])
    good = one.groupBy("part", "item_no").agg(F.min("after").alias("after"), F.count("*").alias("n")).filter("n = 1").drop("n")
    placed = items.join(good, ["part", "item_no"], "left").withColumn("place", F.coalesce(F.col("after") + F.lit(0.5), F.col("item_no").cast("double"))).drop("after")
    w = Window.partitionBy("part").orderBy("place", "item_no")
    return placed.withColumn("item_no", F.row_number().over(w) - 1).drop("place")


def category(note: Column) -> Column:
    """The label before a colon or bracket within 8 characters, the first of a/b; a note of up to 8 is its own; else other."""
    label = F.regexp_extract(note, "^([^：:(]{1,8})[：:(]", 1)
    return F.when(label != "", F.split_part(label, F.lit("/"), F.lit(1))).when(F.length(note) <= 8, note).otherwise("other")


RUNS = f"array<{RUN.simpleString()}>"
