"""Tables and the frames that the document model gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block is a line of a document: ``doc_id, lang, source, bi, line``."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("bi", "line"))


#: The same in DuckDB.
BLOCKS = """blocks AS (
  SELECT doc_id, lang, source, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS bi
  FROM (SELECT doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))"""
