"""Boosted trees of presence vectors, grown level by level from histograms.

A level of a tree is one aggregate, and one job unless all rows are one block: per node and
feature the number of rows that hold the feature, and the sums of their residuals and
curvatures. Rows without it follow by subtraction from the node's totals, which are those of
the split above. Both size bounds apply, the least number of rows of a node that is split and
of a leaf. Rows and columns are drawn by digests of their numbers. Residuals are added as
fixed-point numbers, so the trees depend neither on the order of addition nor on the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.sql import Column, DataFrame, functions as F

from litsieve.operators import blocks
from litsieve.operators.sgd import with_margin

#: Bits after the point of a residual; 2**22 rows of a task add up exactly.
_POINT = 30
#: Rows of a block, and rounds after which margins are stored anew.
BLOCK = 1 << 14
REFRESH = 32
#: Rows of a table of which a task grows whole trees, at most: one block.
WHOLE = BLOCK


@dataclass(frozen=True)
class Settings:
    rounds: int = 1600
    depth: int = 3
    step: float = 0.05
    least_split: int = 600
    least_leaf: int = 150
    columns: float = 0.7
    rows: float = 0.85
    seed: int = 0


@dataclass(frozen=True)
class Tree:
    """Nodes in heap order: the children of i are 2 i + 1 (feature absent) and 2 i + 2."""

    feature: tuple[int, ...]  # -1: a leaf
    value: tuple[float, ...]
    gain: tuple[float, ...]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(numbers: np.ndarray, share: float, *key: int) -> np.ndarray:
    """Which of the numbers a draw named by ``key`` takes; about ``share`` of them."""
    with np.errstate(over="ignore"):
        state = np.zeros(1, np.uint64)
        for k in key:
            state = _mixed(state + np.uint64(k & 0xFFFFFFFFFFFFFFFF) + np.uint64(0x9E3779B97F4A7C15))
        digest = _mixed(numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + state)
    return (digest >> np.uint64(11)) / 2.0**53 < share


class _Lookup:
    """Which rows hold a feature, from entries ordered by feature."""

    def __init__(self, n: int, terms: np.ndarray, rows: np.ndarray):
        self.n, self.terms, self.rows = n, terms, rows

    @classmethod
    def of(cls, starts: np.ndarray, terms: np.ndarray) -> _Lookup:
        order = np.argsort(terms, kind="stable")
        rows = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        return cls(len(starts) - 1, terms[order], rows[order])

    def holds(self, feature: int) -> np.ndarray:
        a, b = np.searchsorted(self.terms, [feature, feature + 1])
        out = np.zeros(self.n, bool)
        out[self.rows[a:b]] = True
        return out

    def nodes(self, tree_features: Sequence[int], depth: int) -> np.ndarray:
        """The node that each row ends in, by the splits so far."""
        at = np.zeros(self.n, np.int64)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                if node < len(tree_features) and tree_features[node] >= 0:
                    here = at == node
                    at[here] = 2 * node + 1 + self.holds(tree_features[node])[here]
        return at

    def add(self, margins: np.ndarray, trees: Sequence[Tree], step: float, depth: int) -> None:
        for tree in trees:
            margins += step * np.array(tree.value)[self.nodes(tree.feature, depth)]


_STATE = "block bigint, labels binary, terms binary, rows binary, margins binary"


def _margins(trees: Sequence[Tree], start: float, s: Settings) -> Callable[[blocks.Batches], blocks.Batches]:
    """Blocks by feature, with the margins that all trees so far give."""

    def run(batches: blocks.Batches) -> blocks.Batches:
        for batch in batches:
            out = []
            for rows in blocks.unpack(batch):
                look, margin = _Lookup.of(rows.starts, rows.terms), np.full(len(rows), start)
                look.add(margin, trees, s.step, s.depth)
                arrays = rows.labels, look.terms, look.rows, margin
                out.append((rows.block, *(a.tobytes() for a in arrays)))
            columns = [pa.array(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "labels", "terms", "rows", "margins"])

    return run


def _state(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, _Lookup, np.ndarray]]:
    """(block, labels, lookup, margins) of the blocks of a batch."""
    for row in batch.to_pylist():
        labels, margins = (np.frombuffer(row[c], "<f8") for c in ("labels", "margins"))
        terms, rows = (np.frombuffer(row[c], "<i4") for c in ("terms", "rows"))
        yield row["block"], labels, _Lookup(len(labels), terms, rows), margins.copy()


_HISTOGRAM = "node int, feature int, n bigint, r bigint, h bigint"


class _Sums:
    """Sums per active node and drawn feature over the drawn rows; feature -1: totals."""

    def __init__(self, splits: Sequence[int], active: Sequence[int], features: int, number: int, s: Settings):
        self.splits, self.active, self.features, self.number, self.s = splits, list(active), features, number, s
        self.level = (active[0] + 1).bit_length() - 1
        self.slot_of = np.full(2 ** (s.depth + 1), -1)
        self.slot_of[self.active] = np.arange(len(active))
        self.allowed = np.concatenate([drawn(np.arange(features), s.columns, s.seed, 1, number, node) for node in active])
        self.sums = np.zeros((3, len(active) * features))
        self.totals = np.zeros((3, len(active)))

    def add(self, block: int, labels: np.ndarray, look: _Lookup, f: np.ndarray) -> None:
        """The rows of a block with margins ``f``."""
        p = 1.0 / (1.0 + np.exp(-f))
        r = np.rint((labels - p) * 2.0**_POINT)
        h = np.rint(p * (1.0 - p) * 2.0**_POINT)
        slot = self.slot_of[look.nodes(self.splits, self.level)]
        numbers = block * BLOCK + np.arange(look.n)
        slot[~drawn(numbers, self.s.rows, self.s.seed, 2, self.number)] = -1
        there = slot >= 0
        for out, weight in zip(self.totals, (None, r, h)):
            out += np.bincount(slot[there], None if weight is None else weight[there], len(self.active))
        own = slot[look.rows]
        keep = own >= 0
        cell, row = own[keep] * self.features + look.terms[keep], look.rows[keep]
        for out, weight in zip(self.sums, (None, r, h)):
            out += np.bincount(cell, None if weight is None else weight[row], len(out))

    def table(self) -> dict[str, np.ndarray]:
        active, wide = np.array(self.active), max(self.features, 1)
        cells = np.flatnonzero((self.sums[0] > 0) & self.allowed)
        node = np.concatenate([active[cells // wide], active])
        feature = np.concatenate([cells % wide, np.full(len(active), -1)])
        columns = [np.concatenate([a[cells], b]).astype(np.int64) for a, b in zip(self.sums, self.totals)]
        return dict(zip(("node", "feature", "n", "r", "h"), (node.astype(np.int32), feature.astype(np.int32), *columns)))


def _histogram(recent: Sequence[Tree], splits: Sequence[int], active: Sequence[int], features: int, number: int,
               s: Settings) -> Callable[[blocks.Batches], blocks.Batches]:
    """The sums of a task."""

    def run(batches: blocks.Batches) -> blocks.Batches:
        sums = _Sums(splits, active, features, number, s)
        for batch in batches:
            for block, labels, look, f in _state(batch):
                look.add(f, recent, s.step, s.depth)
                sums.add(block, labels, look, f)
        yield pa.RecordBatch.from_pydict(sums.table())

    return run


def best_split(feature: np.ndarray, n1: np.ndarray, r1: np.ndarray, n: int, r: int,
               s: Settings) -> tuple[int, float]:
    """(index of the best split or -1, its gain): weighted squared difference of the means."""
    n0, r0 = n - n1, r - r1
    fits = (n1 >= s.least_leaf) & (n0 >= s.least_leaf) & (n1 > 0) & (n0 > 0)
    if n < s.least_split or not fits.any():
        return -1, 0.0
    one, none = np.maximum(n1, 1), np.maximum(n0, 1)
    gain = np.where(fits, one / n * none * (r1 / one - r0 / none) ** 2, -1.0)
    top = np.flatnonzero(gain == gain.max())
    best = int(top[np.argmin(feature[top])])
    return (best, float(gain[best] / 4.0**_POINT)) if gain[best] > 0 else (-1, 0.0)


def _leaf(r: int, h: int) -> float:
    return r / h if h else 0.0


def _tree(sums: Callable[[Sequence[int], Sequence[int]], dict[str, np.ndarray]], s: Settings) -> Tree:
    """One tree from ``sums`` of (splits so far, active nodes), a row per node and feature."""
    nodes = 2 ** (s.depth + 1) - 1
    feature, value, gain = [-1] * nodes, [0.0] * nodes, [0.0] * nodes
    active = [0]
    for _ in range(s.depth):
        table = sums(feature, active)
        deeper = []
        for node in active:
            own = table["node"] == node
            total = own & (table["feature"] < 0)
            n, r, h = (int(table[c][total][0]) for c in ("n", "r", "h"))
            value[node] = _leaf(r, h)
            cells = np.flatnonzero(own & (table["feature"] >= 0))
            at, found = best_split(table["feature"][cells], table["n"][cells], table["r"][cells], n, r, s)
            if at < 0:
                continue
            cell = cells[at]
            feature[node], gain[node] = int(table["feature"][cell]), found
            with_r, with_h, with_n = (int(table[c][cell]) for c in ("r", "h", "n"))
            value[2 * node + 1], value[2 * node + 2] = _leaf(r - with_r, h - with_h), _leaf(with_r, with_h)
            # a child too small to be split is done: its value is known
            deeper += [c for c, m in ((2 * node + 1, n - with_n), (2 * node + 2, with_n)) if m >= s.least_split]
        active = deeper
        if not active:
            break
    return Tree(tuple(feature), tuple(value), tuple(gain))


def grow(state: DataFrame, recent: Sequence[Tree], features: int, number: int, s: Settings) -> Tree:
    """One tree: a job per level. What reaches the driver is a row per node and feature."""

    def sums(splits: Sequence[int], active: Sequence[int]) -> dict[str, np.ndarray]:
        job = _histogram(recent, splits, active, features, number, s)
        got = state.mapInArrow(job, _HISTOGRAM).groupBy("node", "feature").agg(
            *[F.sum(c).alias(c) for c in ("n", "r", "h")]
        )
        return {k: v.to_numpy() for k, v in zip(got.columns, got.toArrow().columns)}

    return _tree(sums, s)


_TREES = "number int, feature array<int>, value array<double>, gain array<double>"


def _grown(features: int, first: int, rounds: int, s: Settings) -> Callable[[blocks.Batches], blocks.Batches]:
    """The next trees of a table of one block, which its task holds whole."""

    def run(batches: blocks.Batches) -> blocks.Batches:
        for batch in batches:
            for block, labels, look, f in _state(batch):
                for number in range(first, first + rounds):

                    def sums(splits: Sequence[int], active: Sequence[int]) -> dict[str, np.ndarray]:
                        level = _Sums(splits, active, features, number, s)
                        level.add(block, labels, look, f)
                        return level.table()

                    tree = _tree(sums, s)
                    look.add(f, [tree], s.step, s.depth)
                    columns = [number], [tree.feature], [tree.value], [tree.gain]
                    kinds = pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], ["number", "feature", "value", "gain"]
                    )

    return run


def grow_whole(state: DataFrame, features: int, first: int, rounds: int, s: Settings) -> list[Tree]:
    """The trees that ``grow`` gives one by one, by a single job over a table of one block."""
    rows = state.mapInArrow(_grown(features, first, rounds, s), _TREES).collect()
    return [Tree(tuple(r.feature), tuple(r.value), tuple(r.gain)) for r in sorted(rows, key=lambda r: r.number)]


def prior(packed: DataFrame) -> tuple[int, float]:
    """(rows, log-odds of the positive class)."""
    n = pos = 0
    count = packed.select("labels").mapInArrow(_count, "n bigint, pos bigint").agg(F.sum("n"), F.sum("pos"))
    n, pos = (v or 0 for v in count.first())
    share = min(max(pos / n, 1e-9), 1 - 1e-9) if n else 0.5
    return n, float(np.log(share / (1 - share)))


def _count(batches: blocks.Batches) -> blocks.Batches:
    for batch in batches:
        labels = [np.frombuffer(x, "<f8") for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([sum(map(len, labels))]), pa.array([int(sum(x.sum() for x in labels))])], ["n", "pos"]
        )


# -- the validation curve ------------------------------------------------------


def _staged(trees: Sequence[Tree], start: float, s: Settings) -> Callable[[blocks.Batches], blocks.Batches]:
    def run(batches: blocks.Batches) -> blocks.Batches:
        sums = np.zeros((5, len(trees) + 1), np.int64)
        for batch in batches:
            for rows in blocks.unpack(batch):
                look, f, y = _Lookup.of(rows.starts, rows.terms), np.full(len(rows), start), rows.labels > 0
                for k in range(len(trees) + 1):
                    if k:
                        look.add(f, trees[k - 1 : k], s.step, s.depth)
                    hit = f > 0
                    loss = np.rint(np.logaddexp(0.0, np.where(y, -f, f)) * 2.0**_POINT).sum()
                    sums[:, k] += [(hit & y).sum(), (hit & ~y).sum(), (~hit & y).sum(), (~hit & ~y).sum(), int(loss)]
        names = ["tp", "fp", "fn", "tn", "loss"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(trees) + 1)), *map(pa.array, sums)], ["round", *names]
        )

    return run


def validation_curve(packed: DataFrame, trees: Sequence[Tree], start: float, s: Settings,
                     beta: float = 2.0) -> DataFrame:
    """(round, deviance, f_beta, p, r, npv) of every beginning of the ensemble, in one pass."""
    sums = packed.mapInArrow(
        _staged(trees, start, s), "round bigint, tp bigint, fp bigint, fn bigint, tn bigint, loss bigint"
    ).groupBy("round").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "loss")])

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    b2 = beta * beta
    return sums.select(
        "round",
        (2.0 * F.col("loss") / 2.0**_POINT / (tp + fp + fn + tn)).alias("deviance"),
        ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("f_beta"),
        ratio(tp, tp + fp).alias("p"), ratio(tp, tp + fn).alias("r"), ratio(tn, tn + fn).alias("npv"),
    )


def fit_trees(packed: DataFrame, features: int, s: Settings, validation: DataFrame | None = None,
              patience: int = 100, beta: float = 2.0) -> tuple[list[Tree], float, int]:
    """(trees, start, rounds to use) over packed blocks.

    With a validation set the fit ends once its deviance has not fallen for ``patience``
    rounds, looked at every REFRESH rounds, and the rounds to use are those of the highest
    F-beta, the fewest of them.

    Margins up to a multiple of REFRESH rounds are kept with the blocks. They are always
    derived from the stored blocks, so there is no chain of results to recompute. Of a table
    of one block the rounds between two refreshes are one job.
    """
    n, start = prior(packed)
    trees: list[Tree] = []
    stored, state = 0, None
    try:
        while len(trees) < (s.rounds if n else 0):
            if state is None or len(trees) - stored == REFRESH:
                if (validation is not None and trees and len(trees) >= patience
                        and _settled(validation, trees, start, s, patience, beta)):
                    break
                if state is not None:
                    state.unpersist()
                stored = len(trees)
                state = packed.mapInArrow(_margins(trees, start, s), _STATE)
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
            if n <= WHOLE:
                trees += grow_whole(state, features, stored, min(REFRESH, s.rounds - stored), s)
            else:
                trees.append(grow(state, trees[stored:], features, len(trees), s))
    finally:
        if state is not None:
            state.unpersist()
    if validation is None or not trees:
        return trees, start, len(trees)
    best = validation_curve(validation, trees, start, s, beta).orderBy(F.desc("f_beta"), "round").first()
    return trees, start, best["round"] if best else len(trees)


def _settled(validation: DataFrame, trees: Sequence[Tree], start: float, s: Settings, patience: int,
             beta: float) -> bool:
    best = validation_curve(validation, trees, start, s, beta).orderBy("deviance", "round").first()
    return best is not None and len(trees) - best["round"] >= patience


# -- as a stage of a pipeline --------------------------------------------------


class _TreeParams(HasFeaturesCol, HasLabelCol, HasSeed):
    rounds = Param(Params._dummy(), "rounds", "trees, at most", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree's values that is added", TypeConverters.toFloat)
    leastSplit = Param(Params._dummy(), "leastSplit", "rows of a node that is split, at least", TypeConverters.toInt)
    leastLeaf = Param(Params._dummy(), "leastLeaf", "rows of a leaf, at least", TypeConverters.toInt)
    columns = Param(Params._dummy(), "columns", "share of the features drawn per node", TypeConverters.toFloat)
    rows = Param(Params._dummy(), "rows", "share of the rows drawn per tree", TypeConverters.toFloat)
    validationCol = Param(Params._dummy(), "validationCol", "rows that choose the rounds", TypeConverters.toString)
    patience = Param(Params._dummy(), "patience", "rounds without gain", TypeConverters.toInt)
    beta = Param(Params._dummy(), "beta", "of the F-beta that chooses the rounds", TypeConverters.toFloat)

    _DEFAULTS = dict(seed=0, rounds=1600, depth=3, stepSize=0.05, leastSplit=600, leastLeaf=150, columns=0.7,
                     rows=0.85, patience=100, beta=2.0)

    def settings(self) -> Settings:
        get = self.getOrDefault
        return Settings(get("rounds"), get("depth"), get("stepSize"), get("leastSplit"), get("leastLeaf"),
                        get("columns"), get("rows"), get("seed"))


class BoostedTrees(Estimator, _TreeParams):
    """Boosted trees of presence vectors; with ``validationCol``, as many as that set needs."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", seed: int = 0, rounds: int = 1600,
                 depth: int = 3, stepSize: float = 0.05, leastSplit: int = 600, leastLeaf: int = 150,
                 columns: float = 0.7, rows: float = 0.85, validationCol: str | None = None, patience: int = 100,
                 beta: float = 2.0):
        super().__init__()
        self._setDefault(**self._DEFAULTS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TreeModel:
        get, validation = self.getOrDefault, None
        names = get("featuresCol"), get("labelCol")
        one = dataset.select(names[0]).first()
        if self.isDefined("validationCol"):
            held = F.coalesce(F.col(get("validationCol")), F.lit(False))
            validation = blocks.pack(dataset.filter(held), BLOCK, *names, seed=get("seed"))
            dataset = dataset.filter(~held)
        packed = blocks.pack(dataset, BLOCK, *names, seed=get("seed"))
        trees, start, rounds = fit_trees(
            packed, one[0].size if one else 0, self.settings(), validation, get("patience"), get("beta")
        )
        return self._copyValues(TreeModel(trees, start, one[0].size if one else 0, rounds))


class TreeModel(Model, _TreeParams):
    """``trees`` holds all that were grown, ``rounds_used`` says how many of them count."""

    def __init__(self, trees: Sequence[Tree] = (), start: float = 0.0, features: int = 0, rounds_used: int = 0):
        super().__init__()
        self._setDefault(**self._DEFAULTS)
        self.trees, self.start, self.features, self.rounds_used = list(trees), start, features, rounds_used

    def truncated(self, rounds: int) -> TreeModel:
        """The model of the first rounds only."""
        return self._copyValues(TreeModel(self.trees, self.start, self.features, min(rounds, len(self.trees))))

    @property
    def featureImportances(self) -> DenseVector:
        """Gains of the splits by feature, as shares."""
        out = np.zeros(self.features)
        for tree in self.trees[: self.rounds_used]:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    out[feature] += gain
        return DenseVector(out / out.sum() if out.sum() > 0 else out)

    def margin(self) -> Column:
        trees, start, s = self.trees[: self.rounds_used], self.start, self.settings()

        def score(starts: np.ndarray, terms: np.ndarray) -> np.ndarray:
            out = np.full(len(starts) - 1, start)
            _Lookup.of(starts, terms).add(out, trees, s.step, s.depth)
            return out

        return blocks.over_vectors(score)(self.getOrDefault("featuresCol"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_margin(dataset, self.margin())

    def curve(self, dataset: DataFrame, beta: float = 2.0) -> DataFrame:
        """Scores of every beginning of the ensemble on labelled vectors, in one pass."""
        get = self.getOrDefault
        packed = blocks.pack(dataset, BLOCK, get("featuresCol"), get("labelCol"), seed=get("seed"))
        return validation_curve(packed, self.trees, self.start, self.settings(), beta)
