"""Quality rules: boosted trees over document statistics.

The trees are grown on the driver from a bounded sample of labelled documents, with
monotonic constraints on chosen statistics (more symbols, repeats, duplicate lines,
capitals or shouts can never raise the score), then flattened into numpy node arrays
that score a whole Arrow batch at once. Only the statistics of the sample, a few
numbers per document, ever reach the driver.

Null texts count as empty; empty texts fail the base rule; repeated rows get the same
verdict each; labels other than 0 and 1 are ignored; without labels of both kinds the
base rules alone decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve.llm import common

#: Labelled documents that the trees are grown on, at most.
SAMPLE = 20_000
MIN_WORDS = 50
WINDOW = 3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics and the direction in which the score may move with them: -1 down, 0 either way.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "capital_share": -1,
    "digit_share": -1,
    "shout_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "punctuation_share": 0,
    "line_words": 0,
    "short_word_share": 0,
    "closed_share": 0,
}


def _codes(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode("ascii"), np.uint8)


_WHITE = _codes(" \t\n\v\f\r")
_SYMBOLS = _codes("#*$%&|<>")
_SHOUTS = _codes("!?")
_STOPS = _codes(".,;:")


def repeated_words(ids: np.ndarray, kinds: int, window: int = WINDOW) -> int:
    """Words inside a window of word numbers that occurs at least twice."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.int64)
    for k in range(window):
        if k and kinds ** (k + 1) >= 2**62:  # number the pairs anew before they overflow
            key = np.unique(key, return_inverse=True)[1]
            if int(key.max() + 1) * kinds >= 2**62:
                raise OverflowError("a text of that many distinct words")
        key = key * kinds + ids[k : k + n]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    hit = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(seen.sum() - seen[0x80:0xC0].sum())  # continuation bytes are no code points
    n = len(words)
    word_chars = chars - int(seen[_WHITE].sum())
    symbols = int(seen[_SYMBOLS].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeats = repeated_words(ids, len(number))
    per, every = max(n, 1), max(word_chars, 1)
    letters = int(seen[65:91].sum() + seen[97:123].sum())
    return [n, word_chars, symbols, dup_lines, repeats], [
        float(np.log1p(n)),
        word_chars / per,
        symbols / every,
        dup_lines / max(len(lines), 1),
        repeats / per,
        int(seen[65:91].sum()) / max(letters, 1),
        int(seen[48:58].sum()) / every,
        int(seen[_SHOUTS].sum()) / per,
        len(number) / per,
        int(np.bincount(ids).max()) / per if n else 0.0,
        int(seen[_STOPS].sum()) / per,
        n / max(len(lines), 1),
        sum(len(w) == 1 for w in words) / per,
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / max(len(lines), 1),
    ]


@dataclass(frozen=True)
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good quality for each row of statistics."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go, self.left[at], self.right[at])
        return self.start + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _leaf(g: np.ndarray, h: np.ndarray, l2: float, low, high) -> np.ndarray:
    return np.clip(-g / (h + l2), low, high)


def grow(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 80, depth: int = 4,
    rate: float = 0.1, l2: float = 1.0, min_rows: int = 10, bins: int = 64,
) -> Trees:
    """Second-order boosting of logistic loss over binned statistics.

    A split on a constrained statistic is taken only if the two leaf values stand in the
    demanded order; their midpoint then bounds all values further down, so the order
    holds for the finished tree and for the sum of trees.
    """
    n, m = x.shape
    rate_up = np.clip(y.mean() if n else 1.0, 1e-3, 1 - 1e-3)
    start = float(np.log(rate_up / (1 - rate_up)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if n == 0 or len(np.unique(y)) < 2:
        return _flat(nodes, roots, depth, start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    codes = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)
    margin = np.full(n, start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(len(nodes))
        todo = [(np.arange(n), -np.inf, np.inf, 0, len(nodes))]
        nodes.append([0, np.inf, 0, 0, 0.0])
        while todo:
            rows, low, high, level, at = todo.pop()
            total_g, total_h = g[rows].sum(), h[rows].sum()
            value = float(_leaf(total_g, total_h, l2, low, high))
            best = None
            if level < depth and len(rows) >= 2 * min_rows:
                best = _best_split(codes[rows], g[rows], h[rows], cuts, signs, l2, low, high, min_rows)
            if best is None:
                nodes[at] = [0, np.inf, at, at, rate * value]
                margin[rows] += rate * value
                continue
            j, k, mid = best
            go = codes[rows, j] <= k
            lo, hi = len(nodes), len(nodes) + 1
            nodes += [[0, np.inf, lo, lo, 0.0], [0, np.inf, hi, hi, 0.0]]
            nodes[at] = [j, cuts[j][k], lo, hi, 0.0]
            bounds = ((low, high), (low, high))
            if signs[j] < 0:
                bounds = ((mid, high), (low, mid))
            elif signs[j] > 0:
                bounds = ((low, mid), (mid, high))
            todo.append((rows[go], *bounds[0], level + 1, lo))
            todo.append((rows[~go], *bounds[1], level + 1, hi))
    return _flat(nodes, roots, depth, start)


def _best_split(codes, g, h, cuts, signs, l2, low, high, min_rows):
    best, gain = None, 1e-6
    total_g, total_h, n = g.sum(), h.sum(), len(g)
    base = total_g**2 / (total_h + l2)
    for j, edges in enumerate(cuts):
        if not len(edges):
            continue
        size = len(edges) + 1
        gl = np.cumsum(np.bincount(codes[:, j], g, size))[:-1]
        hl = np.cumsum(np.bincount(codes[:, j], h, size))[:-1]
        cl = np.cumsum(np.bincount(codes[:, j], minlength=size))[:-1]
        gr, hr = total_g - gl, total_h - hl
        vl, vr = _leaf(gl, hl, l2, low, high), _leaf(gr, hr, l2, low, high)
        won = gl**2 / (hl + l2) + gr**2 / (hr + l2) - base
        fine = (cl >= min_rows) & (n - cl >= min_rows) & (signs[j] * (vr - vl) >= 0)
        won = np.where(fine, won, 0.0)
        k = int(won.argmax())
        if won[k] > gain:
            best, gain = (j, k, (vl[k] + vr[k]) / 2), won[k]
    return best


def _flat(nodes: list, roots: list, depth: int, start: float) -> Trees:
    a = np.array(nodes, float).reshape(-1, 5)
    whole = a[:, [0, 2, 3]].astype(np.int64)
    return Trees(
        whole[:, 0], a[:, 1], whole[:, 1], whole[:, 2], a[:, 4], np.array(roots, np.int64), depth, start
    )


def _measured(text: Column) -> Column:
    kind = "struct<base:array<bigint>,stats:array<double>>"

    @F.arrow_udf(kind)
    def measure(texts: pa.Array) -> pa.Array:
        both = [statistics(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [
                pa.array([b for b, _ in both], pa.list_(pa.int64())),
                pa.array([s for _, s in both], pa.list_(pa.float64())),
            ],
            ["base", "stats"],
        )

    return measure(text)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **growth) -> Trees:
    """Trees for ``labels.quality`` from at most ``sample`` labelled documents.

    A label that meets repeated documents counts once for each; what reaches the driver
    stays within ``sample`` rows all the same.
    """
    rows = common.labelled_texts(docs, labels, "quality", sample)
    rows = rows.select("label", _measured(F.col("text"))["stats"].alias("stats")).limit(sample)
    got = rows.toArrow()
    x = np.array(got["stats"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = got["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the rows come in any order; sums must not depend on it
    return grow(x[order], y[order], np.array(list(FEATURES.values())), **growth)


def verdicts(text: Column, model: Trees, cut: float = 0.5) -> Column:
    """Struct of the base counts, ``base_failed``, ``score`` and ``kept`` of a text."""
    kind = (
        "struct<" + ",".join(f"{c}:bigint" for c in BASE)
        + ",base_failed:boolean,score:double,kept:boolean>"
    )

    @F.arrow_udf(kind)
    def judge(texts: pa.Array) -> pa.Array:
        both = [statistics(t.as_py()) for t in texts]
        base = np.array([b for b, _ in both], np.int64).reshape(-1, len(BASE))
        score = model.score(np.array([s for _, s in both], float).reshape(-1, len(FEATURES)))
        failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])
        parts = [pa.array(base[:, j]) for j in range(len(BASE))]
        parts += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= cut))]
        return pa.StructArray.from_arrays(parts, [*BASE, "base_failed", "score", "kept"])

    return judge(text)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document row: doc_id, the base counts, base_failed, kept and the score."""
    model = train(docs, labels, sample)
    rows = docs.select(
        common.field("doc_id").alias("doc_id"), verdicts(common.text_of(), model).alias("v")
    )
    return rows.select("doc_id", *[f"v.{c}" for c in (*BASE, "base_failed", "kept", "score")])


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that pass, with all their columns."""
    model = train(docs, labels, sample)
    rows = common.packed(docs)
    rows = rows.filter(verdicts(F.coalesce(F.col("doc").getField("text"), F.lit("")), model)["kept"])
    return common.unpacked(rows, docs)
