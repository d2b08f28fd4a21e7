"""I: queries of maps from places to printed pages, pooled over the modules of a series."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import index_model as IM
from ..operators import page_maps as PM
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table

#: Each document is a series of modules of 2,000 words; a word is 18 places wide, and a page 620 to 740 places. Two blank
#: pages stand between modules. The first word of ten letters or more on a page ties it to its place.
_WORDS = 2000
_SERIES = f"""
words AS (SELECT doc_id, w, pos, pos // {_WORDS} AS module, pos % {_WORDS} * 18.0 AS off, (pos * 18) // (620 + doc_id % 4 * 40) + pos // {_WORDS} * 2 AS page
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)),
modules AS (SELECT doc_id, module, count(*) * 18.0 AS length, module * {_WORDS} * 18.0 AS start FROM words GROUP BY ALL),
anchors AS (SELECT doc_id, module, off, page + 0.5 AS y, w AS term, page FROM words WHERE length(w) >= 10 QUALIFY row_number() OVER (PARTITION BY doc_id, module, page ORDER BY pos) = 1),
steps AS (SELECT doc_id, CASE WHEN y - lag(y) OVER m >= 3 THEN (off - lag(off) OVER m) / (y - lag(y) OVER m) END AS s FROM anchors WINDOW m AS (PARTITION BY doc_id, module ORDER BY off)),
dens AS (SELECT doc_id, s AS dens FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM steps WHERE s IS NOT NULL) WHERE k = n // 2 + 1)"""

_names = (f"v{i}" for i in itertools.count())


def _let(value: str, body) -> str:
    name = next(_names)
    return f"list_transform([{value}], lambda {name}: {body(name)})[1]"


def _each(items: str, body) -> str:
    name = next(_names)
    return f"list_transform({items}, lambda {name}: {body(name)})"


def _total(items: str, body) -> str:
    return f"coalesce(list_sum({_each(items, body)}), 0.0)"


def _centred(s: str, body) -> str:
    """``body`` of the sum of weights and the centre of weighted points."""
    return _let(_total(s, lambda p: f"{p}.w"), lambda t: f"CASE WHEN {t} > 0 THEN {_let(_total(s, lambda p: f'{p}.w * {p}.x') + f' / {t}', lambda x: _let(_total(s, lambda p: f'{p}.w * {p}.y') + f' / {t}', lambda y: body(x, y)))} END")


def _fit(s: str) -> str:
    """The weighted line through points {x, y, w}: its value at 0 and its slope, with the centre; null if there is none."""

    def line(x: str, y: str) -> str:
        spread = _total(s, lambda p: f"{p}.w * ({p}.x - {x}) * ({p}.x - {x})")
        slope = _total(s, lambda p: f"{p}.w * ({p}.x - {x}) * ({p}.y - {y})")
        return _let(spread, lambda q: f"CASE WHEN {q} >= 1e-9 THEN {_let(f'{slope} / {q}', lambda b: f'''{{'a': {y} - {b} * {x}, 'b': {b}, 'x': {x}, 'y': {y}}}''')} END")

    return _centred(s, line)


def _reweighted(s: str) -> str:
    def by(f: str) -> str:
        miss = lambda p: f"abs({p}.y - {f}.a - {f}.b * {p}.x)"
        weight = lambda p, m: f"{p}.w * pow(greatest(0.0, 1 - pow({miss(p)} / (6 * {m} + 0.05), 2)), 2)"
        point = lambda m: lambda p: f"{{'x': {p}.x, 'y': {p}.y, 'w': {weight(p, m)}}}"
        kept = next(_names)
        moved = _let(f"list_sort({_each(s, miss)})[len({s}) // 2 + 1]", lambda m: f"list_filter({_each(s, point(m))}, lambda {kept}: {kept}.w > 0)")
        return f"CASE WHEN {f} IS NULL THEN {s} ELSE {moved} END"

    return _let(_fit(s), by)


def _page_at(points: str, dens: str, c: str) -> str:
    """The page at ``c`` by a robust local line through the ten nearest of ``points`` {x, y}."""

    def by(near: str) -> str:
        first = lambda p: f"{{'x': {p}.x - {c}, 'y': {p}.y, 'w': pow(1 - pow({p}.d / ({near}[len({near})].d + 1.0), 3), 3)}}"
        nearest = f"({near}[1].y + ({c} - {near}[1].x) / {dens})"

        def line(s: str) -> str:
            span = f"list_max({_each(s, lambda p: f'{p}.x')}) - list_min({_each(s, lambda p: f'{p}.x')})"
            shrunk = lambda f: _let(f"least(1.0, ({span}) / (8 * {dens}))", lambda k: f"{f}.y - ({k} * {f}.b + (1 - {k}) / {dens}) * {f}.x")
            return _let(_fit(s), lambda f: f"CASE WHEN {f} IS NULL OR {f}.b <= 0.2 / {dens} OR {f}.b >= 5 / {dens} THEN {nearest} ELSE {shrunk(f)} END")

        return _let(_each(near, first), lambda s0: _let(_reweighted(s0), lambda s1: _let(_reweighted(s1), lambda s2: _let(_reweighted(s2), line))))

    point = lambda p: f"{{'d': abs({p}.x - {c}), 'x': {p}.x, 'y': {p}.y}}"
    return _let(f"list_slice(list_sort({_each(points, point)}), 1, 10)", by)


def _by_map(c: str) -> str:
    return f"CASE WHEN own >= 2 THEN {_page_at('points', 'dens', c)} ELSE line + slope * (start + {c}) END"


def _place_of(page: str) -> str:
    s, i = next(_names), next(_names)
    mid = f"(({s}.lo + {s}.hi) / 2)"
    step = f"CASE WHEN {_by_map(mid)} < {page} THEN {{'lo': {mid}, 'hi': {s}.hi}} ELSE {{'lo': {s}.lo, 'hi': {mid}}} END"
    whole = "{'lo': 0.0::DOUBLE, 'hi': length::DOUBLE}"
    return _let(f"list_reduce(list_transform(range(41), lambda {i}: {whole}), lambda {s}, {next(_names)}: {step})", lambda x: f"({x}.lo + {x}.hi) / 2")


def _rounded(value: Column | str, digits: int) -> Column:
    """As SQL rounds a double: the product with a power of ten, halves away from zero; ``F.round`` goes by the decimal spelling."""
    wide = F.abs(value) * 10.0**digits
    whole = F.floor(wide).cast("double")
    return F.signum(value) * (whole + F.when(wide - whole >= 0.5, 1.0).otherwise(0.0)) / 10.0**digits


def _series(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    words = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "w"))
    module = F.floor(F.col("pos") / _WORDS)
    page = F.floor(F.col("pos") * 18 / (620 + F.col("doc_id") % 4 * 40)) + module * 2
    words = words.select("doc_id", "w", "pos", module.alias("module"), (F.col("pos") % _WORDS * 18.0).alias("off"), page.alias("page"))
    first = F.row_number().over(Window.partitionBy("doc_id", "module", "page").orderBy("pos"))
    tied = words.filter(F.length("w") >= 10).withColumn("k", first).filter("k = 1").select("doc_id", "module", "off", "page", F.col("w").alias("term"), "pos")
    return words, tied


def _modules(words: DataFrame) -> DataFrame:
    return words.groupBy("doc_id", "module").agg((F.count("*") * 18.0).alias("length"))


@query("i14_page_errors", f"""
WITH {_SERIES}, beside AS (
  SELECT doc_id, off::DOUBLE AS off, y::DOUBLE AS y, list_concat(list({{'x': off::DOUBLE, 'y': y::DOUBLE}}) OVER (m ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), list({{'x': off::DOUBLE, 'y': y::DOUBLE}}) OVER (m ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)) AS points
  FROM anchors WINDOW m AS (PARTITION BY doc_id, module ORDER BY off)),
missed AS (SELECT doc_id, abs({_page_at("points", "dens", "off")} - y) AS miss FROM (SELECT beside.*, coalesce(dens, 700.0)::DOUBLE AS dens FROM beside LEFT JOIN dens USING (doc_id)) WHERE len(points) >= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY miss) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM missed)
SELECT doc_id, max(n) AS n, round(avg((miss <= 0.5)::INT), 6) AS half, round(avg((miss <= 1)::INT), 6) AS one, round(avg((miss <= 2)::INT), 6) AS two, round(max(CASE WHEN k = n // 2 + 1 THEN miss END), 6) AS med FROM ranked GROUP BY doc_id""")
def i14e(spark: SparkSession, d: str) -> DataFrame:
    words, tied = _series(spark, d)
    errors = PM.leave_one_out(tied.select("doc_id", "module", "off", "page"), ["doc_id"], _modules(words))
    return errors.select("doc_id", "n", *[_rounded(c, 6).alias(c) for c in ("half", "one", "two", "med")])


#: References: a word that ties a page, some on another page than its own, some over a range of pages.
_REFS = """refs AS (SELECT doc_id, module * 2000 + (off / 18)::BIGINT AS ref, term, page + length(term) % 4 * 3 AS low, page + length(term) % 4 * 3 + CASE WHEN length(term) % 5 = 0 THEN 2 ELSE 0 END AS high FROM anchors)"""


@query("i9_resolve_pooled", f"""
WITH {_SERIES}, {_REFS},
lines AS (SELECT doc_id, regr_slope(y, start + off) AS slope, regr_intercept(y, start + off) AS line, count(*) AS n FROM anchors JOIN modules USING (doc_id, module) GROUP BY doc_id),
series AS (SELECT doc_id, coalesce(dens, 700.0)::DOUBLE AS dens, CASE WHEN n >= 6 AND slope > 0.3 / coalesce(dens, 700.0) AND slope < 3 / coalesce(dens, 700.0) THEN slope END AS slope, line FROM (SELECT DISTINCT doc_id FROM modules) LEFT JOIN dens USING (doc_id) LEFT JOIN lines USING (doc_id)),
own AS (SELECT doc_id, module, count(*) AS own, list({{'x': off::DOUBLE, 'y': y::DOUBLE}} ORDER BY off) AS points FROM anchors GROUP BY ALL),
maps AS (SELECT modules.*, coalesce(own, 0) AS own, points, dens, slope, CASE WHEN slope IS NOT NULL THEN line END AS line FROM modules JOIN series USING (doc_id) LEFT JOIN own USING (doc_id, module)),
ends AS (SELECT *, {_by_map("0.0")} AS low_page, {_by_map("length")} AS high_page, CASE WHEN own >= 2 THEN {_by_map("points[1].x")} END AS own_low, CASE WHEN own >= 2 THEN {_by_map("points[own].x")} END AS own_high FROM maps),
occ AS (SELECT doc_id, module, w AS term, off, count(*) OVER (PARTITION BY doc_id, w) AS n FROM words WHERE w IN (SELECT term FROM refs)),
paged AS (SELECT doc_id, module, term, off, n, {_by_map("off")} AS q FROM occ JOIN maps USING (doc_id, module)),
single AS (SELECT * FROM refs WHERE low = high),
cand AS (SELECT s.doc_id, ref, module, off, n, greatest(0.0, low - q, q - (low + 1)) AS far FROM single s JOIN paged USING (doc_id, term) WHERE q IS NOT NULL AND greatest(0.0, low - q, q - (low + 1)) <= 0.75
  UNION ALL SELECT s.doc_id, ref, module, off, n, 0.0 FROM single s JOIN paged USING (doc_id, term) WHERE q IS NULL AND n = 1),
by_term AS (SELECT doc_id, ref, module, off, off AS upto, CASE WHEN n = 1 THEN 'term1' ELSE 'term' END AS method FROM cand QUALIFY row_number() OVER (PARTITION BY doc_id, ref ORDER BY far, module, off) = 1),
asked AS (SELECT doc_id, ref, low + 0.5 AS page, NULL::DOUBLE AS last FROM single ANTI JOIN by_term USING (doc_id, ref) UNION ALL SELECT doc_id, ref, low + 0.05, high + 0.95 FROM refs WHERE high > low),
pairs AS (SELECT * FROM asked JOIN ends USING (doc_id) WHERE page BETWEEN low_page - 0.6 AND high_page + 0.6),
placed AS (SELECT *, {_place_of("page")} AS spot, CASE WHEN last BETWEEN low_page - 0.6 AND high_page + 0.6 THEN {_place_of("last")} END AS last_at FROM pairs),
by_map AS (SELECT doc_id, ref, module, spot AS off, coalesce(last_at, spot) AS upto, CASE WHEN last IS NULL THEN 'interp' ELSE 'range' END AS method FROM placed
  QUALIFY row_number() OVER (PARTITION BY doc_id, ref ORDER BY CASE WHEN own >= 2 AND page BETWEEN own_low - 0.5 AND own_high + 0.5 THEN 0 WHEN own >= 2 THEN 1 ELSE 2 END, own DESC, start) = 1),
found AS (SELECT * FROM by_term UNION ALL SELECT * FROM by_map)
SELECT refs.doc_id, refs.ref, coalesce(module, -1)::BIGINT AS module, coalesce(round(off, 1), -1)::DOUBLE AS off, coalesce(round(upto, 1), -1)::DOUBLE AS upto, coalesce(method, 'none') AS method FROM refs LEFT JOIN found ON found.doc_id = refs.doc_id AND found.ref = refs.ref""")
def i9p(spark: SparkSession, d: str) -> DataFrame:
    words, tied = _series(spark, d)
    low = F.col("page") + F.length("term") % 4 * 3
    refs = tied.select("doc_id", F.col("pos").cast("long").alias("ref"), "term", low.alias("low"), (low + F.when(F.length("term") % 5 == 0, 2).otherwise(0)).alias("high"))
    occurrences = words.join(refs.select("doc_id", F.col("term").alias("w")).distinct(), ["doc_id", "w"]).select("doc_id", "module", F.col("w").alias("term"), "off")
    out = PM.resolve(refs, tied.select("doc_id", "module", "off", "page"), occurrences, ["doc_id"], _modules(words))
    return out.select("doc_id", "ref", F.coalesce("module", F.lit(-1)).cast("long").alias("module"), *[F.coalesce(_rounded(c, 1), F.lit(-1.0)).alias(c) for c in ("off", "upto")], "method")


#: An index stands before each document's text, a line for each block with a label in the end, as module 0; pages hold 300 characters.
_INDEX = f"""
{BLOCKS}, pages AS (
  SELECT doc_id, bi, regexp_extract(line, '^[^ ]*') || ' ' AS head, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 300 AS page FROM blocks),
size0 AS (SELECT doc_id, bi, head, page, length(head) + 2 AS n, (sum(length(head) + 2) OVER w - length(head) - 2) // 300 AS spot FROM pages WINDOW w AS (PARTITION BY doc_id ORDER BY bi)), n0 AS (SELECT doc_id, max(spot) + 1 AS base FROM size0 GROUP BY doc_id)"""
_TURNS = "".join(
    f""", size{k} AS (SELECT doc_id, bi, head, page, base, (sum(length(head || (base + page + 1)) + 1) OVER (PARTITION BY doc_id ORDER BY bi) - length(head || (base + page + 1)) - 1) // 300 AS spot FROM pages JOIN n{k - 1} USING (doc_id)),
n{k} AS (SELECT doc_id, max(spot) + 1 AS base FROM size{k} GROUP BY doc_id)"""
    for k in range(1, 7)
)


@query("i12_labels_to_fixpoint", f"""
WITH {_INDEX}{_TURNS}
SELECT doc_id, bi::INT AS line_no, head || (base + page + 1) AS text, true AS converged FROM pages JOIN n6 USING (doc_id)""")
def i12(spark: SparkSession, d: str) -> DataFrame:
    """The labels lengthen the index, which moves the pages after it, which moves the labels."""
    b = blocks(spark, d).select("doc_id", F.col("bi").cast("int").alias("line_no"), "line")
    head = F.concat(F.regexp_extract("line", "^[^ ]*", 0), F.lit(" "))
    index = b.select("doc_id", F.lit(0).alias("module"), "line_no", F.concat(head, F.lit("?")).alias("text"))
    refs = b.select("doc_id", F.lit(0).alias("module"), "line_no", F.col("line_no").alias("ref"), F.length(head).alias("start"), (F.length(head) + 1).alias("end"))
    places = b.select("doc_id", F.col("line_no").alias("ref"), F.lit(1).alias("to_module"), F.col("line_no").alias("to_line"), F.col("line_no").alias("last_line"))

    def layout(lines: DataFrame) -> DataFrame:
        before = Window.partitionBy("doc_id", "module").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
        sized = lines.select("doc_id", "module", "line_no", F.length("text").alias("n"))
        return sized.withColumn("page", F.floor(F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)) / 300))

    out = IM.remap_to_fixpoint(index.union(b.select("doc_id", F.lit(1), "line_no", F.col("line"))), refs, places, layout, ["doc_id"])
    return out.filter("module = 0").select("doc_id", "line_no", "text", "converged")
