"""Folds over the ordered rows of a key, for what depends on what was decided before.

One shuffle by key and a sort; a task then reads its rows as a stream, so a fold
costs each row once and holds what it carries, not the key's rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of a batch that a fold returns.
BATCH = 10_000


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], values: list[str], out: str, fold: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """``keys`` and the columns of ``out`` (a DDL string): what ``fold`` makes of each key's rows in order.

    ``fold`` gets an iterator of tuples (``order``, then ``values``) and yields
    tuples of ``out``; rows that it leaves unread are skipped.
    """
    columns = [*order, *values]
    given = df.select(*keys, *columns)
    schema = T.StructType([*[given.schema[k] for k in keys], *T._parse_datatype_string(out).fields])
    arrow, n = to_arrow_schema(schema), len(keys)

    def run(batches):
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        made: list[tuple] = []
        for key, group in itertools.groupby(rows, key=lambda row: row[:n]):
            for x in fold(row[n:] for row in group):
                made.append(key + tuple(x))
                if len(made) >= BATCH:
                    yield _batch(made, arrow)
                    made = []
        if made:
            yield _batch(made, arrow)

    return given.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)
