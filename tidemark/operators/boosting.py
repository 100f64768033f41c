"""Leaf-wise boosted trees for squared loss, grown from histograms that Spark adds up.

Columns are cut into bins at quantiles once. For each tree, Spark sums gradients and rows per
(node, column, bin); only these sums, whose size is nodes x columns x bins, reach the driver,
which picks the splits. The leaf with the largest gain is split next, up to a number of leaves.
A split's gain does not depend on the order of the splits, so all leaves that may come next are
summed in one pass over the rows, and a tree takes about as many passes as it is deep.

Rows with a NULL or NaN go with the smallest values. L1 and L2 terms shrink the leaves.
"""

from __future__ import annotations

import heapq
import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import freeze


@dataclass(frozen=True)
class Settings:
    """How trees grow. ``row_fraction`` of the rows is drawn anew every ``row_every`` rounds and
    ``column_fraction`` of the columns for each tree; with validation rows, fitting ends after
    ``patience`` rounds without a better error."""

    rounds: int = 100
    leaves: int = 31
    step: float = 0.1
    l1: float = 0.0
    l2: float = 0.0
    min_rows: int = 20
    min_gain: float = 1e-12
    bins: int = 255
    row_fraction: float = 1.0
    row_every: int = 1
    column_fraction: float = 1.0
    patience: int = 50
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number; a node without a column is a leaf."""

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def grow(self) -> int:
        for values, start in ((self.column, -1), (self.cut, 0), (self.left, -1), (self.right, -1)):
            values.append(start)
        self.value.append(0.0)
        self.gain.append(0.0)
        return len(self.column) - 1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of a matrix of bins."""
        column, cut, left, right = (
            np.array(v) for v in (self.column, self.cut, self.left, self.right)
        )
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins)) if column[0] >= 0 else np.zeros(0, np.int64)
        while len(rows):
            at = node[rows]
            low = bins[rows, column[at]] <= cut[at]
            node[rows] = np.where(low, left[at], right[at])
            rows = rows[column[node[rows]] >= 0]
        return node

    def added(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins)]


def binned(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin 0 for NULL and NaN, else 1 + the number of edges below the value."""
    out = np.zeros(values.shape, np.uint16)
    for k, cuts in enumerate(edges):
        known = ~np.isnan(values[:, k])
        out[known, k] = np.searchsorted(np.array(cuts), values[known, k], side="left") + 1
    return out


@dataclass
class Boosted:
    """A fitted model: columns, the edges of their bins, the first guess and the trees."""

    columns: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    errors: list[float]

    def predict(self, values: np.ndarray) -> np.ndarray:
        bins = binned(values, self.edges)
        return self.base + sum((t.added(bins) for t in self.trees), np.zeros(len(bins)))

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction; Arrow batches are scored where the rows are."""
        model = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(model.predict(batch.to_numpy(np.float64, na_value=np.nan)))

        run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.Series]}
        row = F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns])
        return df.withColumn(out, F.pandas_udf(run, "double")(row))

    def importance(self) -> list[tuple[str, float]]:
        """(column, share of the gain of all splits); the shares sum to 1 if there is a split."""
        gains = dict.fromkeys(self.columns, 0.0)
        for t in self.trees:
            for k, gain in zip(t.column, t.gain):
                if k >= 0:
                    gains[self.columns[k]] += gain
        total = sum(gains.values()) or 1.0
        return [(c, g / total) for c, g in gains.items()]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Boosted:
        read = json.loads(text)
        return Boosted(**{**read, "trees": [Tree(**t) for t in read["trees"]]})


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_split(sums: np.ndarray, s: Settings, allowed: Sequence[int]) -> tuple[float, int, int]:
    """(gain, column, cut) for sums of (gradient, rows) by column and bin; equal gains go to the
    first column and the lowest cut."""

    def score(part: np.ndarray) -> np.ndarray:
        return shrunk(part[..., 0], s.l1) ** 2 / np.maximum(part[..., 1] + s.l2, 1e-300)

    below = np.cumsum(sums, axis=1)
    whole = below[:, -1:, :]
    above = whole - below
    gain = score(below) + score(above) - score(whole)
    fits = (below[..., 1] >= s.min_rows) & (above[..., 1] >= s.min_rows)
    closed = np.ones(len(sums), bool)
    closed[list(allowed)] = False
    gain[~fits] = -np.inf
    gain[closed] = -np.inf
    at = int(np.argmax(gain))
    column, cut = divmod(at, gain.shape[1])
    return float(gain[column, cut]), column, cut


def drawn(key: np.ndarray, seed: int, fraction: float) -> np.ndarray:
    """A repeatable draw of rows by number, by the finaliser of a 64-bit mixing generator."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) / 2**53 < fraction


def matrix(batch: pd.DataFrame, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["bins"]), np.uint16).reshape(len(batch), width)


class Fit:
    """The rows of a fit, and the passes over them."""

    #: Trees that are applied anew in each pass before their sum is written to the rows.
    FRESH = 8

    def __init__(self, train: DataFrame, valid: DataFrame | None, columns: list[str], label: str, s: Settings) -> None:
        self.s, self.columns = s, columns
        numbers = [F.col(c).cast("double").alias(c) for c in columns]
        shares = [k / s.bins for k in range(1, s.bins)]
        found = train.select(*numbers).approxQuantile(columns, shares, 1 / (4 * s.bins))
        self.edges = edges = [sorted(set(e)) for e in found]
        known = F.col(label).isNotNull()
        rows = train.where(known).select(*numbers, F.col(label).cast("double").alias("_y"), F.lit(False).alias("_valid"))
        if valid is not None:
            rows = rows.unionByName(
                valid.where(known).select(*numbers, F.col(label).cast("double").alias("_y"), F.lit(True).alias("_valid"))
            )

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                bins = binned(batch[columns].to_numpy(np.float64, na_value=np.nan), edges)
                yield pd.DataFrame({"y": batch["_y"], "valid": batch["_valid"], "bins": [r.tobytes() for r in bins]})

        self.base = train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
        start = rows.mapInPandas(cut, "y double, valid boolean, bins binary")
        start = start.withColumns({"f": F.lit(self.base), "key": F.monotonically_increasing_id()})
        self.rows, self.fresh = freeze(start, "binned"), []
        self.size = 2 + max(map(len, edges), default=0)

    def added(self, tree: Tree) -> None:
        self.fresh.append(tree)
        if len(self.fresh) == self.FRESH:
            trees, width = self.fresh, len(self.columns)

            def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    bins = matrix(batch, width)
                    yield batch.assign(f=batch["f"] + sum(t.added(bins) for t in trees))

            self.rows, self.fresh = freeze(self.rows.mapInPandas(sum_up, self.rows.schema), "boosted"), []

    def sums(self, tree: Tree, wanted: list[int], seed: int) -> tuple[dict[int, np.ndarray], tuple[float, float]]:
        """{node: sums of (gradient, rows) by column and bin} of the wanted nodes of a tree, and
        (squared error, rows) of the validation rows before this tree."""
        trees, width, size, s = list(self.fresh), len(self.columns), self.size, self.s
        cells = width * size

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(wanted) * cells, 2))
            place = np.full(len(tree.column), -1)
            place[wanted] = np.arange(len(wanted))
            error = np.zeros(2)
            for batch in batches:
                bins = matrix(batch, width)
                gradient = batch["f"].to_numpy() + sum((t.added(bins) for t in trees), np.zeros(len(bins))) - batch["y"].to_numpy()
                held = batch["valid"].to_numpy()
                error += (gradient[held] ** 2).sum(), held.sum()
                used = ~held
                if s.row_fraction < 1:
                    used &= drawn(batch["key"].to_numpy(), seed, s.row_fraction)
                node = place[tree.nodes_of(bins)]
                used &= node >= 0
                bins, gradient, node = bins[used], gradient[used], node[used]
                for k in range(width):
                    cell = node * cells + k * size + bins[:, k]
                    total[:, 0] += np.bincount(cell, gradient, len(total))
                    total[:, 1] += np.bincount(cell, minlength=len(total))
            filled = np.flatnonzero(total[:, 1])
            yield pd.DataFrame({"cell": np.append(filled, -1), "g": np.append(total[filled, 0], error[0]), "n": np.append(total[filled, 1], error[1])})

        out = self.rows.mapInPandas(part, "cell long, g double, n double")
        got = out.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas()
        cell = got["cell"].to_numpy()
        whole = np.zeros((len(wanted) * cells, 2))
        whole[cell[cell >= 0]] = got.loc[cell >= 0, ["g", "n"]].to_numpy()
        error = got.loc[cell < 0, ["g", "n"]].to_numpy().sum(axis=0)
        per_node = whole.reshape(len(wanted), width, size, 2)
        return dict(zip(wanted, per_node)), (float(error[0]), float(error[1]))

    def tree(self, number: int) -> tuple[Tree, tuple[float, float]]:
        """The next tree, and the validation error before it."""
        s = self.s
        draw = random.Random(s.seed * 1_000_003 + number)
        n = max(1, math.ceil(s.column_fraction * len(self.columns)))
        allowed = sorted(draw.sample(range(len(self.columns)), n))
        seed = s.seed + 7919 * (number // s.row_every)
        tree = Tree()
        held, error = self.sums(tree, [0], seed)
        splits = {0: best_split(held[0], s, allowed)}
        while True:
            chosen, unknown = self._chosen(tree, splits)
            if not unknown:
                break
            # Of two children the first is summed; the other is what the parent has besides.
            firsts = [tree.left[p] for p in unknown]
            got, _ = self.sums(tree, firsts, seed)
            for p in unknown:
                one, two = tree.left[p], tree.right[p]
                held[one], held[two] = got[one], held[p] - got[one]
                splits[one], splits[two] = (best_split(held[c], s, allowed) for c in (one, two))
        return self._pruned(tree, chosen, splits, held), error

    def _chosen(self, tree: Tree, splits: dict) -> tuple[list[int], list[int]]:
        """The nodes that are split, best gain first, and those of them whose children are not
        summed yet; these get their two children here."""
        heap, chosen, unknown = [(-splits[0][0], 0)], [], []
        while heap and len(chosen) < self.s.leaves - 1:
            gain, node = heapq.heappop(heap)
            if -gain <= self.s.min_gain:
                break
            chosen.append(node)
            if tree.column[node] < 0:
                _, tree.column[node], tree.cut[node] = splits[node]
                tree.left[node], tree.right[node] = tree.grow(), tree.grow()
            if tree.left[node] not in splits:
                unknown.append(node)
                continue
            for child in (tree.left[node], tree.right[node]):
                heapq.heappush(heap, (-splits[child][0], child))
        return chosen, unknown

    def _pruned(self, tree: Tree, chosen: list[int], splits: dict, held: dict) -> Tree:
        """The tree of the chosen splits alone, with the values of its leaves."""
        out, keep = Tree(), set(chosen)
        todo = [(0, 0)]
        while todo:
            node, new = todo.pop()
            g, n = held[node][0].sum(axis=0)
            out.value[new] = float(-self.s.step * shrunk(np.array(g), self.s.l1) / max(n + self.s.l2, 1e-300))
            if node in keep:
                out.gain[new], out.column[new], out.cut[new] = splits[node]
                out.left[new], out.right[new] = out.grow(), out.grow()
                todo += [(tree.left[node], out.left[new]), (tree.right[node], out.right[new])]
        return out


def fit_boosted(
    train: DataFrame,
    valid: DataFrame | None,
    columns: Sequence[str],
    label: str,
    settings: Settings | None = None,
) -> Boosted:
    """Boosted trees on numeric columns; rows without a label are left out.

    With validation rows the trees up to the smallest error are kept, and ``errors`` has the
    error (root mean square) after 0, 1, 2, ... trees.
    """
    s = settings or Settings()
    fit = Fit(train, valid, list(columns), label, s)
    trees: list[Tree] = []
    errors: list[float] = []

    def note(error: tuple[float, float]) -> bool:
        """Whether to go on."""
        if error[1]:
            errors.append(math.sqrt(error[0] / error[1]))
        return len(errors) - 1 - int(np.argmin(errors)) < s.patience if errors else True

    for number in range(s.rounds):
        tree, error = fit.tree(number)
        if not note(error) or tree.column[0] < 0:
            break
        trees.append(tree)
        fit.added(tree)
    else:
        if valid is not None:
            note(fit.sums(Tree(), [0], 0)[1])
    if errors:
        trees = trees[: int(np.argmin(errors))]
    return Boosted(fit.columns, fit.edges, fit.base, trees, errors)
