"""Near duplicates by SimHash fingerprints, linked through BK-trees.

Fingerprints are computed in Arrow batches. Two fingerprints that differ in at
most ``radius`` bits agree in some set of whole bit blocks, so only those that
share a block key are compared. Within a key the fingerprints are dealt into
shards of bounded size; the BK-tree of each shard is sent to the rows of every
shard of that key, and a search follows only the edges that the radius allows.
A key gives back one star per connected set, never its pairs. The stars are
joined into components by alternating large-star and small-star rounds.

Defined results: a null or empty text has no word and fingerprint zero; equal
rows, and rows with equal fingerprints, are one component; rows without an id
get a fingerprint and the smallest id of their component, or null; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, saved

RADIUS = 3
WIDTH = 3
SEED = 42
BLOCKS = 5
#: Fingerprints in one tree.
SHARD = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(data: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """Bit k is 1 if it is set in over half of the shingles' XXH64."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        n = len(words) - width + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8", copy=False).view(np.uint8)
        ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = WIDTH
) -> DataFrame:
    """(id, fp): one row per document; ``fp`` holds the 64 bits as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"]
            )

    return docs.select(F.col(id_col).alias("id"), bytes_of(text).alias("data")).mapInArrow(
        compute, f"id {id_type}, fp long"
    )


def block_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Masks of which one, at least, keeps two numbers within the radius equal."""
    if radius >= blocks:
        raise ValueError("the radius must be smaller than the number of blocks")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(each, blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


class Forest:
    """Union-find over positions; the smaller root wins."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


class BKTree:
    """Nodes in arrays; the children of a node are keyed by their distance to it."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        #: node: the distances of its children, and the children
        self.children: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        stack = [np.arange(len(values))] if len(values) else []
        while stack:
            members = stack.pop()
            node, rest = members[0], members[1:]
            if not len(rest):
                continue
            away = np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(away, kind="stable")
            away, rest = away[order], rest[order]
            keys, first = np.unique(away, return_index=True)
            groups = np.split(rest, first[1:])
            self.children[int(node)] = keys.astype(np.int64), np.array([g[0] for g in groups])
            stack += groups

    def search(self, queries: np.ndarray, radius: int):
        """Yields (node, positions of the queries within the radius), all queries at once."""
        stack = [(0, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while stack:
            node, at = stack.pop()
            away = np.bitwise_count(queries[at] ^ self.values[node]).astype(np.int64)
            near = at[away <= radius]
            if len(near):
                yield node, near
            for key, child in zip(*self.children.get(node, ((), ()))):
                inside = at[np.abs(away - key) <= radius]
                if len(inside):
                    stack.append((int(child), inside))


def stars(values: np.ndarray, tree_side: np.ndarray, query_side: np.ndarray, radius: int):
    """(member, root) of the connected sets that one shard tree shows."""
    forest = Forest(len(values))
    nodes, queries = np.flatnonzero(tree_side), np.flatnonzero(query_side)
    for node, near in BKTree(values[nodes]).search(values[queries], radius):
        a = int(nodes[node])
        for b in queries[near].tolist():
            forest.join(a, b)
    roots = np.array([forest.root(x) for x in range(len(values))])
    moved = np.flatnonzero(roots != np.arange(len(values)))
    return values[moved], values[roots[moved]]


def _runs(batches):
    """Arrow batches, cut so that each table holds whole runs of (key, i, j)."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        keys = [table.column(k).to_numpy() for k in ("t", "v", "i", "j")]
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        last = int(np.flatnonzero(new)[-1])
        if last:
            yield table.slice(0, last), new[:last]
        held = table.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield held, np.arange(held.num_rows) == 0


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): stars that connect all distinct ``fp`` within the radius of each other."""
    masks = [signed(m) for m in block_masks(radius)]
    keys = distinct.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
                    for t, m in enumerate(masks)
                )
            )
        ).alias("key"),
    ).select("fp", "key.t", "key.v")
    # Keys of one fingerprint link nothing. Larger keys are dealt into shards.
    sizes = (
        keys.groupBy("t", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("shards", F.ceil(F.col("n") / shard).cast("int"))
    )
    dealt = (
        keys.join(sizes, ["t", "v"])
        .withColumn("s", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            "t",
            "v",
            F.least("s", "other").alias("i"),
            F.greatest("s", "other").alias("j"),
            "s",
            "fp",
        )
    )

    def search(batches):
        for table, new in _runs(batches):
            values = table.column("fp").to_numpy().view(np.uint64)
            own, i, j = (table.column(k).to_numpy() for k in ("s", "i", "j"))
            edges = np.append(np.flatnonzero(new), len(values))
            found = [
                stars(values[a:b], own[a:b] == i[a], own[a:b] == j[a], radius)
                for a, b in zip(edges[:-1], edges[1:])
                if b - a > 1
            ]
            found = [x for x in found if len(x[0])]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in zip(*found)], ["a", "b"]
                )

    order = ["t", "v", "i", "j"]
    return (
        dealt.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(search, "a long, b long")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of (a, b) is connected with.

    Large-star and small-star rounds until the edges stay the same; each round is
    written to the shared folder.
    """

    def state(df):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(row)

    edges = saved(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := state(edges)) != before and now[0]:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .filter("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
        )
        edges = saved(
            small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a != b")
            .distinct(),
            "edges",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    radius: int = RADIUS,
    width: int = WIDTH,
    shard: int = SHARD,
) -> DataFrame:
    """(id, fp, component): the smallest id among all documents reachable over links."""
    rows = saved(fingerprints(docs, text, id_col, width), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    labels = saved(components(links(distinct.select("fp"), radius, shard)), "labels")
    member = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    of_label = member.groupBy("label").agg(F.min("least").alias("component"))
    of_fp = member.join(of_label, "label").select("fp", "component")
    return rows.join(of_fp, "fp").select("id", "fp", "component")


def one_per_component(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs``, unchanged, without the near duplicates of a row with a smaller id.

    Of rows that repeat an id the one with the smallest text bytes stays; rows
    without an id have nothing to be ranked by, and all of them stay.
    """
    found = near_duplicates(docs, text, id_col)
    kept = found.filter("id = component").select("id").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    first = Window.partitionBy("id").orderBy(F.md5(bytes_of(f"row.{text}")))
    joined = (
        rows.filter("id IS NOT NULL")
        .join(kept, "id", "left_semi")
        .withColumn("rank", F.row_number().over(first))
        .filter("rank = 1")
    )
    return joined.select("row.*").unionByName(rows.filter("id IS NULL").select("row.*"))
