"""Schemas and constants of the document model."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed code points with a meaning of their own.
BREAK, PICTURE, JOINER, SOFT_HYPHEN, BREAK_POINT = "\n", "￼", "⁠", "­", "​"
GAP_CJK, GAP_EN = "　", " "
#: Characters that conservation checks leave out (fixed values): white space, joiners, gaps, soft hyphens.
IGNORED = " \t\r\n⁠​　 ﻿ ­"
CJK = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
#: Marks that no line may begin with, and ones that none may end with (fixed values).
CLOSERS = "，。、；：！？）】》〉」』’”…—·,.;:!?)]}"
OPENERS = "（【《〈「『‘“([{"

#: Fixed values that results depend on: stops of CJK and ASCII text, dashes, paired brackets, words after a number that
#: is no page, and words before a count.
WIDE_STOPS, ASCII_STOPS, DASHES = "，。、；：！？", ",;:!?", "—–-"
BRACKETS = {"（": "）", "(": ")", "〔": "〕", "[": "]", "［": "］", "【": "】"}
UNITS = "年 月 日 世纪 页 卷 章 节 篇 号 岁 个 种 届 次 % ％".split()
COUNT_WORDS = "前 约 公元 第 共 ？ ?".split()

RUN = T.StructType([
    T.StructField("t", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("s", T.IntegerType()),
    T.StructField("h", T.StringType()), T.StructField("a", T.StringType()), T.StructField("i", T.StringType()),
    T.StructField("c", T.StringType()), T.StructField("m", T.StringType()),
])
ITEM = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("item_no", T.IntegerType()), T.StructField("k", T.StringType()),
    T.StructField("tag", T.StringType()), T.StructField("cls", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("lvl", T.IntegerType()), T.StructField("depth", T.IntegerType()), T.StructField("q", T.BooleanType()),
    T.StructField("box", T.BooleanType()), T.StructField("src", T.StringType()), T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("heads", T.ArrayType(T.BooleanType())),
])
