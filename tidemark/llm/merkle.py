"""Merkle manifest of a dataset, with an inclusion proof for every row by pointer jumping.

Each row is a leaf, the SHA-256 of its fields. The leaves of a part ascend by id and are
hashed in pairs, level by level, to the part's subroot; the subroots, in the order of their
parts, are hashed in the same way to the root. The digest of a node without a neighbour is
that of its only child.

Places: rows are dealt by Spark into ranges of (part, id, leaf, row) and sorted there; the
numbers of rows per (range, part) give each row its place without a second sort.

Nodes: the digests of 1,024 neighbours meet in one group, which builds ten levels at once, so
that a tree of any size takes a tenth as many shuffles as it has levels.

Proofs: each node holds the segment of siblings on the way to an ancestor, at first its
parent. A self-join fetches the ancestor's own segment and appends it, which doubles the
distance: n rounds reach 2**n levels. In a round of distance d only nodes at heights that are
multiples of d are asked, so the table asked is 2**d times smaller than the leaves. Leaves
that have reached the root leave the rounds. Joins are on (tree, height, place): no part,
however large, is a hot key, and where few nodes are left to ask they are small enough that
Spark sends them to all tasks by its own size check.

Each round's nodes are written in the shared folder. A segment has 33 bytes a level: the side
of the sibling and its digest.

Defined results: nulls in fields are ``-``; a null part is a part of its own, before all
others; rows without id come first in their part, and rows that repeat an id are ordered by
their leaf; equal rows have leaves at neighbouring places, and each its own proof; an empty
table gives an empty table; other columns are not read. Numbers are hashed as decimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one group builds.
LEVELS = 10
#: An entry of a segment: a byte for where the sibling stands (or that there is none, or that
#: the digest is the subroot, met on the way) and a digest.
LEFT, RIGHT, ALONE, SUBROOT = b"\0", b"\1", b"\2", b"\3"
ENTRY = 33
#: The tree of the subroots; the name of a part's tree is never empty.
TOP = ""


def hashed(*values: Column) -> Column:
    """SHA-256 of the values, strung together, as lower-case hex."""
    return F.sha2(F.concat(*values), 256)


def written(value: Column) -> Column:
    """A field as it is hashed: the bytes of its text, counted, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    """The digest of a row's fields, as bytes."""
    return F.unhex(hashed(*map(written, fields)))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def bit_length(n: Column) -> Column:
    return F.when(n <= 0, 0).otherwise(F.length(F.bin(n)))


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (tree, ...) with pos, their place in their tree by ``order``, and depth, the
    number of levels above the leaves. The order must be total."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = saved(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    spread = F.shiftright("at", 33).alias("range")
    whole = Window.partitionBy("tree")
    parts = (
        at.groupBy(spread, "tree")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(whole.orderBy("range")) - F.col("n"))
        .withColumn("depth", bit_length(F.sum("n").over(whole) - 1))
        .drop("n")
    )
    return (
        at.withColumn("range", spread)
        .join(parts, ["range", "tree"])
        .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
        .drop("range", "at", "first", "before")
    )


def entry(side: bytes, digest: Column | None = None) -> Column:
    value = F.lit(bytes(ENTRY - 1)) if digest is None else F.unhex(digest)
    return F.concat(F.lit(side), value)


def parents(nodes: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")),
        lambda i: hashed(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))),
    )


def blocks(level: DataFrame, base: int) -> DataFrame:
    """(tree, depth, block, nodes, top, own) of the nodes (tree, depth, pos, digest, own) at
    one height: the nodes of up to ``LEVELS`` heights with their siblings, and the digest above."""
    grouped = level.groupBy("tree", "depth", F.shiftright("pos", LEVELS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "own"))).alias("rows")
    )
    steps = F.least(F.lit(LEVELS), F.col("depth") - base)

    def grown(levels: Column, _: Column) -> Column:
        return F.concat(levels, F.array(parents(F.element_at(levels, -1))))

    lowest = F.array(F.transform("rows", lambda r: r["digest"])).cast("array<array<string>>")
    levels = F.when(steps == 0, lowest).otherwise(
        F.aggregate(F.sequence(F.lit(1), steps), lowest, grown)
    )
    grouped = grouped.withColumn("steps", steps).withColumn("levels", levels)

    def node(nodes: Column, k: Column, i: Column) -> Column:
        odd, last = i % 2 == 1, i == F.size(nodes) - 1
        return F.struct(
            (k + base).alias("h"),
            (F.shiftleft(F.col("block"), LEVELS) / F.pow(F.lit(2), k) + i).cast("long").alias("pos"),
            F.when(odd, entry(LEFT, F.get(nodes, i - 1)))
            .when(last, entry(ALONE))
            .otherwise(entry(RIGHT, F.get(nodes, i + 1)))
            .alias("seg"),
            F.when(k == 0, F.get(F.col("rows"), i)["own"]).alias("own"),
        )

    nodes = F.flatten(
        F.transform(
            F.slice("levels", F.lit(1), F.col("steps")),
            lambda now, k: F.transform(now, lambda _, i: node(now, k, i)),
        )
    )
    return grouped.select(
        "tree",
        "depth",
        "block",
        nodes.alias("nodes"),
        F.element_at("levels", -1)[0].alias("top"),
        F.when(F.col("depth") == base, F.col("rows")[0]["own"]).alias("own"),
    )


def forest(leaves: DataFrame, max_depth: int, name: str) -> tuple[DataFrame, DataFrame]:
    """All nodes below the tops of the trees, with the key of their parents; and the tops."""
    level, nodes, tops = leaves, [], []
    for base in range(0, max(max_depth, 1), LEVELS):
        built = saved(blocks(level, base), f"{name}-{base}")
        nodes.append(built.select("tree", F.explode("nodes").alias("x")).select("tree", "x.*"))
        tops.append(built.filter(F.col("depth") <= base + LEVELS).select("tree", "depth", "top", "own"))
        level = built.filter(F.col("depth") > base + LEVELS).select(
            "tree", "depth", F.col("block").alias("pos"), F.col("top").alias("digest"), "own"
        )
    below = united(nodes).withColumns(
        {
            "up_tree": F.col("tree"),
            "up_h": F.col("h") + 1,
            "up_pos": F.shiftright("pos", 1),
        }
    )
    return below, united(tops)


def united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def jumped(nodes: DataFrame, distance: int, at_root: Column) -> DataFrame:
    """Nodes that point ``distance`` levels up, below the root, point twice as far.

    Leaves come through with what they asked for; other nodes only where a later round asks.
    """
    asked = nodes.filter(
        (F.col("tree") == TOP) | ((F.col("h") > 0) & (F.col("h") % distance == 0))
    ).select(
        F.col("tree").alias("up_tree"),
        F.col("h").alias("up_h"),
        F.col("pos").alias("up_pos"),
        F.struct("up_tree", "up_h", "up_pos", "seg").alias("next"),
    )
    asking = nodes.filter((F.col("tree") == TOP) | (F.col("h") % (2 * distance) == 0))
    return asking.filter(~at_root).join(asked, ["up_tree", "up_h", "up_pos"]).select(
        "tree",
        "h",
        "pos",
        F.concat("seg", "next.seg").alias("seg"),
        "own",
        "next.up_tree",
        "next.up_h",
        "next.up_pos",
    )


def proofs(leaves: DataFrame) -> DataFrame:
    """(id, leaf, claimed, seg, root) for each row of ``leaves`` (part, id, leaf, claimed).

    ``leaf`` is the row's digest as bytes and ``seg`` its siblings on the way to the root;
    ``claimed``, a digest to be checked in its place, is only handed through.
    """
    rows = saved(
        leaves.select(
            written(F.col("part")).alias("tree"),
            "part",
            F.struct("id", "leaf", "claimed").alias("own"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    low = saved(
        placed(rows.drop("part"), ["own.id", "own.leaf", "row"], "sorted").select(
            "tree", "depth", "pos", text_of(F.col("own.leaf")).alias("digest"), "own"
        ),
        "placed",
    )
    depth = low.agg(F.max("depth")).first()[0] or 0
    below, tops = forest(low, depth, "nodes")
    parts = rows.groupBy("tree").agg(F.first("part").alias("part"))
    of = F.struct("tree", "depth", "top", "own").alias("of")
    tops = tops.join(parts, "tree").select(F.lit(TOP).alias("tree"), "part", of)
    subroots = saved(placed(tops, ["part"], "subroots"), "subroots-placed")
    height = subroots.agg(F.max("depth")).first()[0] or 0
    above, roots = forest(
        subroots.select(
            "tree",
            "depth",
            "pos",
            F.col("of.top").alias("digest"),
            F.nullif(F.col("of.own"), F.col("of.own")).alias("own"),
        ),
        height,
        "top-nodes",
    )
    # A tree's top points to its place among the subroots.
    links = subroots.select(
        "of.tree",
        F.col("of.depth").alias("h"),
        F.lit(0).cast("long").alias("pos"),
        entry(SUBROOT, F.col("of.top")).alias("seg"),
        "of.own",
        F.lit(TOP).alias("up_tree"),
        F.lit(0).alias("up_h"),
        F.col("pos").alias("up_pos"),
    )
    at_root = (F.col("up_tree") == TOP) & (F.col("up_h") == height)
    is_leaf = F.col("own").isNotNull()
    nodes, distance, done = saved(united([below, above, links]), "jump-1"), 1, []
    while True:
        done.append(nodes.filter(at_root & is_leaf).select("own.*", "seg"))
        if distance >= depth + 1 + height:
            break
        at_top = nodes.filter(at_root & ~is_leaf)
        distance *= 2
        nodes = saved(jumped(nodes, distance // 2, at_root).unionByName(at_top), f"jump-{distance}")
    root = roots.first()
    return united(done).withColumn("root", F.lit(root["top"] if root else None).cast("string"))


def checked(rows: DataFrame) -> DataFrame:
    """``rows`` of ``proofs`` with subroot, siblings (an array of digests, from the leaf to the
    root), and folded: the root as it follows from the claimed leaf, or the leaf."""
    entries = F.transform(
        F.sequence(F.lit(0), (F.octet_length("seg") / ENTRY).cast("int") - 1),
        lambda i: F.struct(
            F.substring("seg", i * ENTRY + 1, F.lit(1)).alias("side"),
            text_of(F.substring("seg", i * ENTRY + 2, F.lit(ENTRY - 1))).alias("digest"),
        ),
    )

    def folded(acc: Column, e: Column) -> Column:
        return (
            F.when(e["side"] == LEFT, hashed(e["digest"], acc))
            .when(e["side"] == RIGHT, hashed(acc, e["digest"]))
            .when(e["side"] == ALONE, hashed(acc))
            .otherwise(acc)
        )

    start = text_of(F.coalesce("claimed", "leaf"))
    found = let(
        entries,
        lambda es: F.struct(
            F.filter(es, lambda e: e["side"] == SUBROOT)[0]["digest"].alias("subroot"),
            F.transform(
                F.filter(es, lambda e: e["side"] < ALONE), lambda e: e["digest"]
            ).alias("siblings"),
            F.aggregate(es, start, folded).alias("folded"),
        ),
    )
    return rows.withColumn("found", found).select("*", "found.*").drop("found")
