"""T, F, D, A, U, P, W and Q: queries over a rewrite of the documents that has the characters of a CJK book.

The test tables have no CJK text, so rules for it would have nothing to do.  The
rewrite is a fixed map of characters (letters to ideographs, marks to wide ones
on every other line, and a few code points that detectors look for), the same in
DuckDB, and goes over all lines of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import classify as C
from ..operators import lint as D
from ..operators import repair as R
from ..registry import query
from ..sources.tables import BLOCKS, blocks

_LETTERS, _HAN = "etaoinshrdlu", "的一是不了在人有我他这中"
#: Maps of even and odd lines; private use, Cyrillic, spaces, dashes and dots stand for letters that the prose has few of.
EVEN = (_LETTERS + "kjxqz", _HAN + "—… ж")
ODD = (_LETTERS + ",.)01v", _HAN + "，。）Ol ")


def cjk(line: Column, bi: Column) -> Column:
    even = F.translate(F.replace(line, F.lit(", "), F.lit(",")), *EVEN)
    odd = F.replace(F.replace(F.translate(line, *ODD), F.lit("y"), F.lit("...")), F.lit("。 "), F.lit("。，"))
    return F.when(bi % 2 == 0, even).otherwise(odd)


def cjk_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d)
    return b.withColumn("line", cjk(F.col("line"), F.col("bi")))


CJK = f"""{BLOCKS}, cjk AS (SELECT doc_id, lang, source, bi, CASE WHEN bi % 2 = 0 THEN translate(replace(line, ', ', ','), '{EVEN[0]}', '{EVEN[1]}')
  ELSE replace(replace(translate(line, '{ODD[0]}', '{ODD[1]}'), 'y', '...'), '。 ', '。，') END AS line FROM blocks)"""
_C = "[一-鿿]"


def nested(expression: str, rules: list[tuple[str, str]]) -> str:
    """SQL that applies regular-expression replacements in order."""
    for pattern, new in rules:
        expression = f"regexp_replace({expression}, '{pattern}', {new}, 'g')"
    return expression


#: T1 without looking around: a rule whose match takes a character that the next one needs goes twice.
_REPAIRED = nested("replace(line, chr(160), ' ')", [
    *[(rf"([一-鿿”’）》])\{a}([一-鿿“‘（《])", rf"'\1{w}\2'") for a, w in zip(",;:!?", "，；：！？") for _ in range(2)],
    *[(rf"({_C})\{a}$", rf"'\1{w}'") for a, w in zip(",;:!?", "，；：！？")],
    (r"([A-Za-z0-9])[ 　]+([）】》”’，。；：！？、])", r"'\1\2'"), (" {2,}", "' '"),
    *[(r"([0-9])([-–—~～－])([0-9])", r"'\1\2' || chr(8288) || '\3'")] * 2,
    (r"(^|[^A-Za-z])(pp?\.) ([0-9])", r"'\1\2' || chr(160) || '\3'"),
])


@query("t1_repair", f"WITH {CJK} SELECT doc_id, bi::INT AS bi, {_REPAIRED} AS line FROM cjk")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return cjk_blocks(spark, d).select("doc_id", "bi", X.repair(F.col("line")).alias("line"))


_IGNORED = "('', ' ', chr(9), chr(10), chr(13), chr(8288), chr(8203), chr(12288), chr(8194), chr(65279), chr(160), chr(173))"


@query("u1_multiset_diff", f"""
WITH {CJK}, made AS (SELECT lang, line, {_REPAIRED} AS made FROM cjk),
c AS (SELECT lang, unnest(string_split(line, '')) AS ch, 1 AS s, 0 AS o FROM made UNION ALL SELECT lang, unnest(string_split(made, '')), 0, 1 FROM made),
n AS (SELECT lang, ch, sum(s)::BIGINT AS n_src, sum(o)::BIGINT AS n_out FROM c WHERE ch NOT IN {_IGNORED} GROUP BY lang, ch)
SELECT lang, ch, n_src, n_out, greatest(n_src - n_out, 0)::BIGINT AS missing, greatest(n_out - n_src, 0)::BIGINT AS extra FROM n""")
def u1(spark: SparkSession, d: str) -> DataFrame:
    return A.repair_difference(cjk_blocks(spark, d), F.col("line"), X.repair(F.col("line")), ["lang"])


@query("u5_forgiven_differences", f"""
WITH {CJK}, m AS (SELECT doc_id, line, {_REPAIRED} AS made FROM cjk),
n AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[,;:!?]')) - len(regexp_extract_all(made, '[,;:!?]')))::BIGINT AS ascii, sum(len(regexp_extract_all(made, '[，；：！？]')) - len(regexp_extract_all(line, '[，；：！？]')))::BIGINT AS wide FROM m GROUP BY doc_id)
SELECT doc_id, ascii AS missing, least(ascii, wide) AS forgiven FROM n""")
def u5(spark: SparkSession, d: str) -> DataFrame:
    b = cjk_blocks(spark, d).select("doc_id", "line", X.repair(F.col("line")).alias("made"))
    return A.forgiven(b, ["doc_id"], "line", "made", "[,;:!?]", "[，；：！？]")


@query("t4_dates", f"""
WITH {BLOCKS}, d AS (SELECT doc_id, bi, regexp_replace(regexp_replace(line, '([0-9])([0-9])[- ]([0-9])([0-9])', '（ \\1 年 \\2 月 \\3\\4 日 ）', 'g'), '([a-z]), ', '\\1 ，', 'g') AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, {nested("line", [("([0-9]) *年 *([0-9]{1,2}) *月", "'\\1年\\2月'"), ("月 *([0-9]{1,2}) *日", "'月\\1日'"), (" +([，。；：！？、）》】”])", "'\\1'"), ("([（《【“]) +", "'\\1'")])} AS line FROM d""")
def t4(spark: SparkSession, d: str) -> DataFrame:
    dated = F.regexp_replace(F.regexp_replace("line", "([0-9])([0-9])[- ]([0-9])([0-9])", "（ $1 年 $2 月 $3$4 日 ）"), "([a-z]), ", "$1 ，")
    return blocks(spark, d).select("doc_id", "bi", X.repair_dates(dated).alias("line"))


_NEST = "replace(replace(line, '(', '(p('), ')', '中)q)')"


@query("t9_wide_parens", f"""
WITH {BLOCKS}, n AS (SELECT doc_id, bi, {_NEST} AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, {nested("line", [(r"\(([^()]*[一-鿿][^()]*)\)", r"'（\1）'")] * 2)} AS line FROM n WHERE contains(line, '(')""")
def t9(spark: SparkSession, d: str) -> DataFrame:
    line = F.replace(F.replace("line", F.lit("("), F.lit("(p(")), F.lit(")"), F.lit("中)q)"))
    b = blocks(spark, d).withColumn("line", line).filter(F.contains("line", F.lit("(")))
    return b.select("doc_id", "bi", X.wide_parens(F.col("line")).alias("line"))


@query("f7_bracket_depth", f"""
WITH {BLOCKS}, n AS (SELECT doc_id, bi, {_NEST} AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, sum(length(m) - length(replace(replace(m, '(', ''), ')', '')))::BIGINT AS marks, max(CASE WHEN contains(line, '(p(') THEN 2 ELSE 0 END)::INT AS deepest FROM (SELECT *, line AS m FROM n) WHERE contains(line, '(') GROUP BY doc_id, bi""")
def f7(spark: SparkSession, d: str) -> DataFrame:
    line = F.replace(F.replace("line", F.lit("("), F.lit("(p(")), F.lit(")"), F.lit("中)q)"))
    b = blocks(spark, d).withColumn("line", line).filter(F.contains("line", F.lit("("))).withColumn("depth", X.bracket_depth(F.col("line")))
    steps = F.filter(F.transform("depth", lambda x, i: F.abs(x - F.coalesce(F.get("depth", i - 1), F.lit(0)))), lambda x: x > 0)
    return b.select("doc_id", "bi", F.size(steps).cast("long").alias("marks"), F.array_max("depth").alias("deepest"))


@query("t10_unbreak", f"""
WITH {CJK}, n AS (SELECT doc_id, bi, replace(replace(line, ' ', chr(8232)), '，', chr(8232) || '，') AS line FROM cjk)
SELECT doc_id, bi::INT AS bi, trim({nested("line", [("([A-Za-z0-9,.;:])" + chr(8232) + "([A-Za-z0-9(])", "'\\1 \\2'")] * 2 + [(chr(8232), "''")])}, ' ') AS line FROM n""")
def t10(spark: SparkSession, d: str) -> DataFrame:
    line = F.replace(F.replace("line", F.lit(" "), F.lit(" ")), F.lit("，"), F.lit(" ，"))
    return cjk_blocks(spark, d).select("doc_id", "bi", X.unbreak(line).alias("line"))


@query("t16_strip_markers", f"""
WITH {BLOCKS}, n AS (SELECT doc_id, bi, line || CASE bi % 4 WHEN 0 THEN '[3]' WHEN 1 THEN chr(8288) || '［12］ [注三]' WHEN 2 THEN ' ' ELSE '[x]' END AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, rtrim(regexp_replace(line, '(' || chr(8288) || '?[\\[［]([0-9]+|注[一二三四五六七八九十]+)[\\]］][ 　' || chr(8288) || ']*)+$', ''), ' ' || chr(8288)) AS line FROM n""")
def t16(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("bi") % 4
    end = F.when(k == 0, "[3]").when(k == 1, "⁠［12］ [注三]").when(k == 2, " ").otherwise("[x]")
    return blocks(spark, d).select("doc_id", "bi", X.strip_markers(F.concat("line", end)).alias("line"))


_HEADS = ["第一章 ", "一、", "3. ", "A.", "（二）", "甲 ", "", "第三节："]


@query("t12_regap_heading", f"""
WITH {CJK}, n AS (SELECT doc_id, bi, ['{"', '".join(_HEADS)}'][bi % 8 + 1] || line AS line, bi % 8 AS k FROM cjk WHERE line <> '' AND regexp_matches(line, '^[一-鿿a-zA-Z]'))
SELECT doc_id, bi::INT AS bi, CASE k WHEN 0 THEN regexp_replace(line, '^第一章 ', '第一章　') WHEN 2 THEN regexp_replace(line, '^3\\. ', '3.' || chr(8194))
  WHEN 3 THEN regexp_replace(line, '^A\\.', 'A.' || chr(8194)) WHEN 4 THEN regexp_replace(line, '^（二）', '（二）' || chr(8194)) WHEN 5 THEN regexp_replace(line, '^甲 ', '甲　') WHEN 6 THEN
    CASE WHEN regexp_matches(line, '^一 +[^ ]') THEN regexp_replace(line, '^一 +', '一　') WHEN regexp_matches(line, '^[A-Z][.．]') THEN regexp_replace(line, '^([A-Z][.．]) *', '\\1' || chr(8194)) ELSE line END ELSE line END AS line FROM n""")
def t12(spark: SparkSession, d: str) -> DataFrame:
    b = cjk_blocks(spark, d).filter((F.col("line") != "") & F.col("line").rlike("^[一-鿿a-zA-Z]"))
    line = F.concat(F.get(F.lit(_HEADS), F.col("bi") % 8), "line")
    return b.select("doc_id", "bi", X.regap_heading(line, untitled=True).alias("line"))


@query("t13_dedupe_title", f"""
WITH {CJK}, n AS (SELECT doc_id, bi, CASE WHEN bi % 2 = 0 AND length(line) BETWEEN 3 AND 40 THEN line || ' ' || line ELSE line END AS line FROM cjk),
s AS (SELECT doc_id, bi, line, list_max(list_filter(range(3, greatest(3, least(40, length(line) // 2)) + 1), lambda k: length(line) >= 2 * k AND left(line, k) = right(line, k) AND NOT regexp_matches(left(line, k), '[章节]$'))) AS k FROM n)
SELECT doc_id, bi::INT AS bi, CASE WHEN k IS NULL THEN line ELSE rtrim(left(line, length(line) - k), ' ') END AS line FROM s""")
def t13(spark: SparkSession, d: str) -> DataFrame:
    twice = F.when((F.col("bi") % 2 == 0) & F.length("line").between(3, 40), F.concat_ws(" ", "line", "line")).otherwise(F.col("line"))
    return cjk_blocks(spark, d).select("doc_id", "bi", X.dedupe_title(twice).alias("line"))


_MAPS, _FIXES, _WORDS = [("我", "吾"), ("w", "vv")], [("是([，。])", "$1")], [("的一", "D")]


@query("t2_family_chain", f"""
WITH {CJK} SELECT doc_id, bi::INT AS bi, {nested("replace(" + nested("replace(replace(replace(line, chr(160), ' '), '我', '吾'), 'w', 'vv')", [("—{3,}", "'——'"), ("是([，。])", "'\\1'"), (" {2,}", "' '")]) + ", '的一', 'D')", [(" ([，。；：！？、）》”’】])", "'\\1'"), ("([（《“‘【]) ", "'\\1'")] + [("([0-9]) ([0-9])", "'\\1\\2'")] * 4)} AS line FROM cjk""")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return cjk_blocks(spark, d).select("doc_id", "bi", R.family_chain(F.col("line"), _MAPS, _FIXES, _WORDS, spaced_digits=True).alias("line"))


@query("t21_clean_key", f"""
WITH {CJK} SELECT doc_id, bi::INT AS bi, {nested("line", [("[（(〔\\[［【][^）)〕\\]］】]*[）)〕\\]］】]", "''"), ("^[ 　，,、；;：:。.—–-]+|[ 　，,、；;：:。.—–-]+$", "''")])} AS line FROM cjk""")
def t21(spark: SparkSession, d: str) -> DataFrame:
    return cjk_blocks(spark, d).select("doc_id", "bi", X.clean_key(F.col("line")).alias("line"))


@query("f5_separators", f"""
WITH {BLOCKS}, n AS (SELECT doc_id, bi, CASE bi % 5 WHEN 0 THEN '* * *' WHEN 1 THEN '*' WHEN 2 THEN '*　*' ELSE line END AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, bi % 5 IN (0, 2) AS separator FROM n""")
def f5(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("bi") % 5
    line = F.when(k == 0, "* * *").when(k == 1, "*").when(k == 2, "*　*").otherwise(F.col("line"))
    return blocks(spark, d).select("doc_id", "bi", C.is_separator(line).alias("separator"))


WIDE = "\u2e80-\u9fff\uf900-\ufaff\uff00-\uffef"


@query("f6_break_legality", f"""
WITH {CJK}, c AS (SELECT doc_id, bi, string_split(line, '') AS c FROM cjk)
SELECT doc_id, bi::INT AS bi, len(list_filter(range(1, len(c)), lambda i: NOT contains('，。、；：！？）】》〉」』’”…—·,.;:!?)]}}', c[i + 1]) AND NOT contains('（【《〈「『‘“([{{', c[i]) AND c[i + 1] <> ' '
  AND (c[i] = ' ' OR regexp_matches(c[i], '[{WIDE}]') OR regexp_matches(c[i + 1], '[{WIDE}]'))))::BIGINT AS breaks FROM c""")
def f6(spark: SparkSession, d: str) -> DataFrame:
    return cjk_blocks(spark, d).select("doc_id", "bi", F.coalesce(F.size(C.legal_breaks(F.col("line"))), F.lit(0)).cast("long").alias("breaks"))


#: Each category in RE2, or as SQL over the line's characters ``c`` where a match looks around.
_HAN_ALT = "|".join(f"{c}{c}" for c in _HAN if c not in "人天年日常往渐仅刚")
_IS = lambda i: f"(c[{i}] IS NOT NULL AND c[{i}] >= '㐀' AND c[{i}] <= '鿿')"
_AT = lambda condition: f"len(list_filter(range(1, len(c) + 1), lambda i: {condition}))"
_RE = lambda pattern: f"len(regexp_extract_all(line, '{pattern}'))"
DETECTED = {
    "dup-char": _RE(_HAN_ALT) + " + " + _RE("人人") + " * 0",
    "punct-run": f"len(list_filter(regexp_extract_all(line, '[，。、；：！？]{{2,}}|，」'), lambda m: m NOT IN ('？！', '！？', '？？', '！！', '。」')))",
    "punct-run-ascii": _RE("[,;:!?]{2,}"),
    "space-in-cjk": _RE("[一-鿿][ " + " " + "]+[一-鿿]"),
    "ascii-punct": _AT(f"({_IS('i')} AND contains(',;:!?', coalesce(c[i + 1], '~')) AND ({_IS('i + 2')} OR i + 1 = len(c))) OR ({_IS('i')} AND contains('.(', coalesce(c[i + 1], '~')) AND {_IS('i + 2')}) OR (c[i] = ')' AND i > 1 AND {_IS('i - 1')})"),
    "private-use": _RE("[-�□]"),
    "cyrillic": _RE("[Ѐ-ӿ]"),
    "single-dash": _AT(f"c[i] = '—' AND i > 1 AND {_IS('i - 1')} AND {_IS('i + 1')}"),
    "single-ellipsis": _AT("c[i] = '…' AND (i = 1 OR c[i - 1] <> '…') AND coalesce(c[i + 1], '') <> '…'"),
    "word-digit": _RE("[A-Za-z]{2,}[0-9]"),
    "no-space-after": _RE("[a-z][,;][A-Za-z]"),
    "straight-quote": _RE('"'),
    "three-dots": _RE("\\.\\.\\."),
    "odd-space": _RE("[ -   ]"),
    "no-break-space": _RE(" "),
}


@query("d15_lint_summary", f"""
WITH {CJK}, p AS (SELECT string_split(line, '') AS c, line FROM cjk), n AS (SELECT unnest([{", ".join(f"{{'category': '{k}', 'n': {v}}}" for k, v in DETECTED.items())}]) AS x FROM p)
SELECT x.category AS category, sum(x.n)::BIGINT AS n FROM n GROUP BY x.category""")
def d15(spark: SparkSession, d: str) -> DataFrame:
    return D.counts(cjk_blocks(spark, d), "line", list(DETECTED))


def _detector(category: str):
    """A detector's findings a line, with the first one's context."""
    count = DETECTED[category]
    sql = f"WITH {CJK}, p AS (SELECT doc_id, bi, string_split(line, '') AS c, line FROM cjk), n AS (SELECT doc_id, bi, {count} AS n FROM p) SELECT doc_id, bi::INT AS bi, n::BIGINT AS n FROM n WHERE n > 0"

    def run(spark: SparkSession, d: str) -> DataFrame:
        return D.findings(cjk_blocks(spark, d).select("doc_id", "bi", "line"), "line", [category]).groupBy("doc_id", "bi").agg(F.count("*").alias("n"))

    return sql, run


for _name, _category in (
    ("d1_doubled_characters", "dup-char"), ("d4_wide_punct_runs", "punct-run"), ("d4_punct_runs", "punct-run-ascii"), ("d6_space_in_cjk", "space-in-cjk"), ("d7_ascii_punct", "ascii-punct"),
    ("d9_private_use", "private-use"), ("d10_cyrillic", "cyrillic"), ("d11_single_dash", "single-dash"), ("d11_single_ellipsis", "single-ellipsis"), ("d13_word_digit", "word-digit"),
    ("d13_no_space_after", "no-space-after"), ("d13_quotes", "straight-quote"), ("d13_three_dots", "three-dots"), ("d13_odd_space", "odd-space"), ("d13_no_break_space", "no-break-space"),
):
    query(_name, _detector(_category)[0])(_detector(_category)[1])


@query("d13_contexts", f"""
WITH {CJK}, p AS (SELECT doc_id, bi, line, instr(line, 'ж') AS place FROM cjk WHERE contains(line, 'ж'))
SELECT doc_id, bi::INT AS bi, substr(line, greatest(1, place - 14), least(place - 1, 14) + 15) AS context FROM p""")
def d13(spark: SparkSession, d: str) -> DataFrame:
    found = D.findings(cjk_blocks(spark, d).select("doc_id", "bi", "line"), "line", ["cyrillic"])
    return found.filter("nth = 0").select("doc_id", "bi", "context")


@query("d8_digit_lookalikes", f"""
WITH {CJK}, m AS (SELECT doc_id, bi, regexp_replace(line, '([lIO])([^A-Za-z]|$)', '\\1' || chr(1) || '\\2', 'g') AS line FROM cjk),
n AS (SELECT doc_id, bi, len(regexp_extract_all(line, '[0-9][lIO]\\x01?[0-9]|[lIO]\\x01?[0-9]{{3}}|[0-9]{{3}}[lIO]\\x01')) AS n FROM m) SELECT doc_id, bi::INT AS bi, n::BIGINT AS n FROM n WHERE n > 0""")
def d8(spark: SparkSession, d: str) -> DataFrame:
    found = D.findings(cjk_blocks(spark, d).select("doc_id", "bi", "line"), "line", ["digit-lookalike"])
    return found.groupBy("doc_id", "bi").agg(F.count("*").alias("n"))


@query("d5_unbalanced", f"""
WITH {CJK}, n AS (SELECT doc_id, bi, len(regexp_extract_all(line, '\\(')) AS a, len(regexp_extract_all(line, '\\)')) AS b, len(regexp_extract_all(line, '（')) AS e, len(regexp_extract_all(line, '）')) AS f FROM cjk)
SELECT doc_id, bi::INT AS bi, trim(CASE WHEN e <> f THEN '（） ' ELSE '' END || CASE WHEN a <> b THEN '()' ELSE '' END) AS pairs FROM n WHERE a <> b OR e <> f""")
def d5(spark: SparkSession, d: str) -> DataFrame:
    # A filter would go below the rewrite and make it anew for each mark.
    wrong = F.filter(F.array(D.unbalanced(F.col("line"))), lambda p: F.size(p) > 0)
    b = cjk_blocks(spark, d).select("doc_id", "bi", F.explode(wrong).alias("p"))
    return b.select("doc_id", "bi", F.array_join("p", " ").alias("pairs"))


@query("d12_script_variants", f"""
WITH {CJK}, c AS (SELECT doc_id, unnest(string_split(line, '')) AS ch FROM cjk), v AS (SELECT * FROM (VALUES ('这', '這'), ('我', '吾'), ('鿿', '鿾')) AS t(ch, usual))
SELECT ch, usual, count(*) AS n, min(doc_id) AS first FROM c JOIN v USING (ch) GROUP BY ch, usual""")
def d12(spark: SparkSession, d: str) -> DataFrame:
    variants = spark.createDataFrame([("这", "這"), ("我", "吾"), ("鿿", "鿾")], "variant string, usual string")
    return D.script_variants(cjk_blocks(spark, d).withColumn("loc", F.col("doc_id")), "line", variants)


@query("d3_known_wrong", f"""
WITH {CJK}, v AS (SELECT * FROM (VALUES ('的的'), ('一有的'), ('不存在')) AS t(wrong))
SELECT doc_id, bi::INT AS bi, wrong, len(list_filter(range(1, length(line) + 1), lambda i: substr(line, i, length(wrong)) = wrong))::BIGINT AS n FROM cjk JOIN v ON contains(line, wrong)""")
def d3(spark: SparkSession, d: str) -> DataFrame:
    words = spark.createDataFrame([("的的",), ("一有的",), ("不存在",)], "wrong string")
    return D.known_wrong(cjk_blocks(spark, d), words, "line").select("doc_id", "bi", "wrong", F.col("n").cast("long").alias("n"))


@query("d14_adjacent_format", f"""
WITH {BLOCKS}, n AS (SELECT doc_id, bi, '<b>' || replace(replace(line, ' t', '</b> <b>t'), ' a', '</b> <i>a') AS line FROM blocks)
SELECT doc_id, bi::INT AS bi, len(regexp_extract_all(line, '</b> <b>'))::BIGINT AS n FROM n WHERE contains(line, '</b> <b>')""")
def d14(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("<b>"), F.replace(F.replace("line", F.lit(" t"), F.lit("</b> <b>t")), F.lit(" a"), F.lit("</b> <i>a")))
    found = D.findings(blocks(spark, d).select("doc_id", "bi", line.alias("line")), "line", ["adjacent-format"])
    return found.groupBy("doc_id", "bi").agg(F.count("*").alias("n"))


@query("a9_replacement_census", f"""
WITH {CJK}, c AS (SELECT doc_id, bi, line, unnest(string_split(line, '')) AS ch, generate_subscripts(string_split(line, ''), 1) AS place FROM cjk),
f AS (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY doc_id, bi, place) AS k, count(*) OVER (PARTITION BY ch) AS n FROM c WHERE (ch >= chr(57344) AND ch <= chr(63743)) OR ch IN ('□', chr(65533), '@', '%'))
SELECT ch, n, substr(line, greatest(1, place - 16), least(place - 1, 16) + 17) AS context FROM f WHERE k = 1""")
def a9(spark: SparkSession, d: str) -> DataFrame:
    return A.char_census(cjk_blocks(spark, d), "line", "[\\x{E000}-\\x{F8FF}\\x{FFFD}□@%]", ["doc_id", "bi"])
