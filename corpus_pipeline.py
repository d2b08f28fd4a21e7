"""A corpus pipeline of five of the training-data operators: language ID, line dedup, n-gram Jaccard join, mixing, BPE.

The stages are in ``quire.llm.pipeline``; this is their entry.
"""

from __future__ import annotations

from quire.llm.pipeline import STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]

#: SQL can't express the language model, the mixing fit and the tokenizer; a brute-force version tests run().
ORACLE_SQL = None
