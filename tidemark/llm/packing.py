"""Packs token sequences of documents into bins of one capacity, by minimum bin slack.

Only lengths matter for a plan, and there are no more of them than the capacity. So
the plan is made from the histogram of lengths: for the longest piece left, a bitset
subset-sum over the lengths still available finds the fullest bin that holds it, and
that bin is removed as often as the counts allow. Every piece then gets its rank among
the pieces of its length, from counts per (bucket, length), and the rank names its bin
and place. No piece passes through the driver; a length that a third of all pieces
share is dealt over all buckets.

Defined results: a null or empty text is its end id alone; equal rows are packed one by
one; rows without an id are packed like others; an empty table has no pieces; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.tokens import crc32, encoder

CAPACITY = 2048
END_ID = 0
#: Pieces in one bucket of ranks.
BUCKET = 500_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first can be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(a, capacity) for a in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, crc32[, ids]): the tokens of each text and an end id, cut."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "piece", "start", "length", "crc32"] + ["ids"] * with_ids

    def encode(batches):
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            rows, at, parts = [], [], []
            for k, ids in enumerate(encoder(tokenizer).batches(texts)):
                ids = np.append(ids, np.uint32(end_id))
                for j, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((j, start, length, crc32(part)))
                    at.append(k)
                    if with_ids:
                        parts.append(part.astype(np.int32))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.int64()] * 3)]
            if not rows:
                continue
            columns = [batch.column(0).take(pa.array(at)), *columns]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {id_type}, piece int, start long, length long, crc32 long"
    return docs.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(
        encode, schema + ", ids array<int>" * with_ids
    )


def fullest(counts: list[int], room: int, lengths: list[int]) -> Counter:
    """The lengths, each at most as often as it is there, that fill the room best.

    Bit s of a set is 1 if some combination has the sum s. Longer lengths come first,
    and the search ends when the room is filled.
    """
    limit = (1 << (room + 1)) - 1
    reach, before = 1, []
    for length in lengths:
        if length > room or not counts[length]:
            continue
        before.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... copies and the rest: every number of copies
            step = min(step, left)
            reach |= reach << (step * length) & limit
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, earlier in reversed(before):
        while not earlier >> total & 1:
            total -= length
            chosen[length] += 1
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """(lengths of a bin, number of such bins) for all pieces of a histogram."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    bins = []
    lengths = sorted(histogram, reverse=True)
    for longest in lengths:
        while counts[longest]:
            counts[longest] -= 1
            chosen = fullest(counts, capacity - longest, lengths)
            counts[longest] += 1
            chosen[longest] += 1
            times = min(counts[length] // k for length, k in chosen.items())
            for length, k in chosen.items():
                counts[length] -= k * times
            bins.append((chosen, times))
    return bins


def places(bins: list[tuple[Counter, int]]) -> dict[str, np.ndarray]:
    """Per length, ranges of ranks and the bins and offsets that they go to."""
    rows, used, bin_ = [], defaultdict(int), 0
    for chosen, times in bins:
        offset = 0
        for length, k in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], k, bin_, offset))
            used[length] += k * times
            offset += k * length
        bin_ += times
    rows.sort()
    return {
        name: np.array(column, np.int64)
        for name, column in zip(("length", "rank", "copies", "bin", "offset"), zip(*rows))
    }


def packed(pieces: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """``pieces`` (id, piece, length, crc32 and any others) with sequence_id and offset.

    Reads its input several times: give it a saved table.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(plan(histogram, capacity))
    if not table:
        return pieces.withColumns(
            {"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}
        )
    n_buckets = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), sum(histogram.values()) // bucket
    )
    order = ["id", "piece", "start", "crc32"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(n_buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("bucket", "length")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    inside = F.row_number().over(Window.partitionBy("bucket", "length").orderBy(*order)) - 1
    ranked = (
        dealt.withColumn("inside", inside)
        .join(offsets, ["bucket", "length"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("bucket", "before", "inside")
    )
    shared = spark.sparkContext.broadcast(table)  # at most capacity lengths per bin form
    kept = pieces.columns

    def assign(batches):
        t = shared.value
        span = int(max(t["rank"].max(), 1)) + 1
        keys = t["length"] * span + t["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(keys, length * span + np.minimum(rank, span - 1), "right") - 1
            past = rank - t["rank"][k]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(t["bin"][k] + past // t["copies"][k]),
                    pa.array(t["offset"][k] + past % t["copies"][k] * length),
                ],
                [*kept, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*kept, "rank").mapInArrow(
        assign, f"{schema}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """(id, piece, start, length, crc32, sequence_id, offset) of all documents' pieces."""
    return packed(saved(token_pieces(docs, **options), "pieces"), options.get("capacity", CAPACITY))


def sequences(packed_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each bin, for pieces that carry their ids."""
    return packed_with_ids.groupBy("sequence_id").agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]
            )
        ).alias("ids")
    )
