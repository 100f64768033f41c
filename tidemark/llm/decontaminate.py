"""Finds documents that hold passages of a benchmark, by a prefix-filtered set join.

The windows of an item are its runs of ``width`` words (a shorter item is one
window). A window can occur only where all its words do, so at a containment of
1 one word, the rarest in all documents, is the necessary prefix. Documents meet
a window at that word only; the word's place in the window and the window's
length bound where it can lie, and the candidate is compared word for word.

The benchmark is the stated query set and is read in blocks of bounded size; each
block's index is broadcast and passes over all documents, and the hits of the
blocks are merged per document.

Defined results: a null or empty text has no word and is clean; a null or empty
item has no window; an item without an id marks words but is not listed; items
or documents that repeat give the same result for each; empty tables are clean;
extra columns are ignored, or passed through by ``clean``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, saved

WIDTH = 13
#: Bytes of item text in one broadcast block.
BLOCK_BYTES = 4 << 20
#: A document is contaminated if at least this share of its words is hit: 1 in 20.
SHARE = 20

_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, with A-Z lower-cased."""
    return data.translate(_WORD).split()


def blocks_of(items: DataFrame, text: str, id_col: str, block_bytes: int):
    """Lists of (item id as text, words), each of about ``block_bytes`` bytes of text."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("string").alias("id"), bytes_of(text).alias("data"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["data"]))
        if not words:
            continue
        if block and size + len(row["data"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["id"], words))
        size += len(row["data"])
    yield block


def word_counts(docs: DataFrame, vocabulary: frozenset, text: str) -> dict[bytes, int]:
    """How often each word of the vocabulary stands in all documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(filter(known.value.__contains__, words_of(t.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            ["word", "n"],
        )

    counted = docs.select(bytes_of(text)).mapInArrow(count, "word binary, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def prefix_index(block, counts: dict[bytes, int], width: int):
    """prefix word: {(its place, window length): {window: item ids}}."""
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for item, words in block:
        size = min(width, len(words))
        for start in range(len(words) - size + 1):
            window = words[start : start + size]
            prefix = min(window, key=lambda w: (counts.get(w, 0), w))
            if counts.get(prefix):  # else it stands in no document
                index[prefix][window.index(prefix), size][b" ".join(window)].add(item)
    return {
        w: [(p, n, {k: tuple(v) for k, v in ws.items()}) for (p, n), ws in places.items()]
        for w, places in index.items()
    }


def occurrences(words: list[bytes], index) -> tuple[list[tuple[int, int]], set]:
    """Disjoint ranges of hit words, and the items whose windows occur."""
    found, items = [], set()
    for i in [i for i, w in enumerate(words) if w in index]:
        for place, size, windows in index[words[i]]:
            start = i - place
            if start < 0 or start + size > len(words):
                continue
            got = windows.get(b" ".join(words[start : start + size]))
            if got:
                found.append((start, start + size))
                items.update(got)
    found.sort()
    ranges: list[tuple[int, int]] = []
    for a, b in found:
        if ranges and a <= ranges[-1][1]:
            ranges[-1] = ranges[-1][0], max(b, ranges[-1][1])
        else:
            ranges.append((a, b))
    return ranges, items


RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def block_hits(docs: DataFrame, index, text: str, id_col: str) -> DataFrame:
    """(id, digest, n_words, ranges, items) per document, for one block."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    id_type = docs.schema[id_col].dataType.simpleString()

    def match(batches):
        for batch in batches:
            n_words, ranges, items = [], [], []
            for t in batch.column(2):
                words = words_of(t.as_py())
                r, i = occurrences(words, shared.value)
                n_words.append(len(words))
                ranges.append([{"a": a, "b": b} for a, b in r])
                items.append(sorted(x for x in i if x is not None))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(ranges, RANGES),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["id", "digest", "n_words", "ranges", "items"],
            )

    return docs.select(
        F.col(id_col).alias("id"), F.md5(bytes_of(text)).alias("digest"), bytes_of(text)
    ).mapInArrow(
        match,
        f"id {id_type}, digest string, n_words long, "
        "ranges array<struct<a:int,b:int>>, items array<string>",
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, digest, n_words, n_hit, items, contaminated): a row per document row."""
    passes = []
    for k, block in enumerate(blocks_of(items, item_text, item_id, block_bytes)):
        vocabulary = frozenset(w for _, words in block for w in words)
        index = prefix_index(block, word_counts(docs, vocabulary, text), width)
        passes.append(saved(block_hits(docs, index, text, id_col), f"block{k}"))
    hits = (
        reduce(DataFrame.unionByName, passes)
        .filter(F.size("ranges") > 0)
        .groupBy(F.col("id").alias("hit_id"), F.col("digest").alias("hit_digest"))
        .agg(
            F.sort_array(F.flatten(F.collect_set("ranges"))).alias("ranges"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(r["a"], s["end"]))).alias("n"),
            F.greatest(s["end"], r["b"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    hits = hits.select("hit_id", "hit_digest", covered.alias("n_hit"), "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        passes[0]
        .select("id", "digest", "n_words")
        .join(
            hits,
            (F.col("digest") == F.col("hit_digest")) & F.col("id").eqNullSafe(F.col("hit_id")),
            "left",
        )
        .select(
            "id",
            "digest",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated rows."""
    bad = (
        contamination(docs, items, text, id_col)
        .filter("contaminated")
        .select(F.col("id").alias("bad_id"), F.col("digest").alias("bad_digest"))
        .distinct()
    )
    return (
        docs.select(F.struct("*").alias("row"))
        .join(
            bad,
            (F.md5(bytes_of(f"row.{text}")) == F.col("bad_digest"))
            & F.col(f"row.{id_col}").eqNullSafe(F.col("bad_id")),
            "left_anti",
        )
        .select("row.*")
    )
