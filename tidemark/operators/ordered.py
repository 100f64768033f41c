"""Exact scans in one global order without sending all rows through one task.

``Window.orderBy`` without a partition puts every row into a single task. Here
Spark deals the rows into ranges of the key and sorts them there; in the same
stage each range is scanned once, batch by batch, and written. The rows are
shuffled once. A range then starts from the total of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import freeze

#: Number of the range that a row is in.
RANGE = "_range"

#: From a column's values of one batch, and what was carried: a column of results, and what to carry on.
Step = Callable[[pa.Array, object], tuple[pa.Array, object]]


def scanned(
    rows: DataFrame, keys: list[str], order: list[str], value: str, out: str, kind: T.DataType, step: Step
) -> DataFrame:
    """``rows`` dealt into ranges of ``keys`` and in ``order`` there, with ``RANGE`` and ``out``.

    ``out`` is what ``step`` makes of ``value``, from the first row of a range to its last.
    Spark samples the ranges. The rows are written once, so that a row's range is the same
    for every later reading, whatever the sample of another run would have been.
    """
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*order)
    dealt = dealt.withColumn(RANGE, F.spark_partition_id())
    place = dealt.columns.index(value)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if batch.num_rows:
                found, carried = step(batch.column(place), carried)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found], names=[*batch.schema.names, out]
                )

    schema = T.StructType([*dealt.schema.fields, T.StructField(out, kind)])
    return freeze(dealt.mapInArrow(scan, schema), "ranges")


def summed_before(values: pa.Array, carried: object) -> tuple[pa.Array, object]:
    known = values.fill_null(0).to_numpy(zero_copy_only=False)
    sums = np.cumsum(np.concatenate([[carried or known.dtype.type(0)], known]))
    return pa.array(sums[:-1], values.type), sums[-1]


def largest_before(values: pa.Array, carried: object) -> tuple[pa.Array, object]:
    known = values.is_valid().to_numpy(zero_copy_only=False)
    low = 0 if not known.any() else values.drop_null()[0].as_py()
    filled = values.fill_null(low).to_numpy(zero_copy_only=False)
    before, seen = (filled[0], False) if carried is None else (carried, True)
    # Nulls count as the largest value before them: they change nothing.
    least = np.iinfo(filled.dtype).min if filled.dtype.kind == "i" else -np.inf
    chain = np.concatenate([[before if seen else least], np.where(known, filled, least)])
    largest = np.maximum.accumulate(chain)
    any_before = seen | (np.concatenate([[0], np.cumsum(known)]) > 0)
    found = pa.array(largest[:-1], values.type, mask=~any_before[:-1])
    return found, largest[-1] if any_before[-1] else None


def last_so_far(values: pa.Array, carried: object) -> tuple[pa.Array, object]:
    """The last value that is not null, up to and with each row."""
    known = values.is_valid().to_numpy(zero_copy_only=False)
    at = np.maximum.accumulate(np.where(known, np.arange(1, len(values) + 1), 0))
    start = pa.nulls(1, values.type) if carried is None else carried
    found = pa.concat_arrays([start, values]).take(pa.array(at))
    return found, found.slice(len(found) - 1)


def totals_before(dealt: DataFrame, total: Column, fold: Callable[[str], Column], out: str) -> DataFrame:
    """(RANGE, out): the totals of the ranges before, folded; a row per range."""
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.groupBy(RANGE).agg(total.alias("_all")).select(RANGE, fold("_all").over(before).alias(out))


def scan_before(rows: DataFrame, key: str, value: str, out: str, how: str = "sum") -> DataFrame:
    """Add ``out``: sum (or max) of ``value``, a whole number or a double, over all rows
    with a smaller ``key``.

    ``key`` must be unique and not NULL. The first row gets 0 for a sum, NULL for a max.
    ``rows`` is read once.
    """
    whole = isinstance(rows.schema[value].dataType, T.IntegralType)
    kind = T.LongType() if whole else T.DoubleType()
    typed = rows.withColumn("_value", F.col(value).cast(kind))
    step, fold = (summed_before, F.sum) if how == "sum" else (largest_before, F.max)
    dealt = scanned(typed, [key], [key], "_value", "_inside", kind, step)
    # One row per range, as many as the session has shuffle partitions.
    starts = totals_before(dealt, fold("_value"), fold, "_start")
    joined = dealt.join(F.broadcast(starts), RANGE)
    if how == "sum":
        result = F.coalesce("_start", F.lit(0)) + F.col("_inside")
    else:
        result = F.greatest("_start", "_inside")
    return joined.withColumn(out, result).drop(RANGE, "_value", "_start", "_inside")
