"""Toxic passages by maximum-scoring segment search.

Every token has a log-odds of toxic against other documents under an informative Dirichlet
prior, shrunk by its uncertainty, less a drift that makes ordinary text score below zero;
beginnings of words are counted like words and speak for words that are rare or new.
A linear scan finds all maximal-scoring segments of a text. Their scores are calibrated by
extreme-value theory: how many segments of a score or more a token of clean text starts is
counted over the clean documents of the sample, and beyond the greatest of these it falls
off exponentially, at the rate that the token scores of clean documents imply. So the
number expected by chance follows from the score and the text's length. A document's
evidence is how improbable its best r segments are together, at the r where that is
greatest; logistic regression turns it into a probability.

The fit uses at most ``SAMPLE`` labelled documents. For the log-odds, those of one label
whose words are alike to ``ALIKE`` of a Jaccard similarity, estimated from ``HASHES``
min-hashes, count once; every other one counts. The model keeps at most ``VOCABULARY``
tokens, those of the greatest weight of evidence, so it has a bounded size at any input.
Every document is scored, over its whole text.

Null texts count as empty; a text without tokens has no evidence and gets the score of
that; repeated rows are each scored. Without labels of both kinds every score is the share
of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve import session
from litsieve.llm import common

#: Labelled documents that the model is fitted to, at most.
SAMPLE = 20_000
#: Tokens that the model keeps, at most.
VOCABULARY = 1 << 16
#: Strength of the prior, in documents.
PRIOR = 20.0
#: Deviations by which a log-odds is shrunk towards zero.
SHRINK = 3.0
#: What an ordinary token costs.
DRIFT = 0.5
#: Passages are significant if as many as good are this improbable by chance.
CHANCE = 0.05
#: Min-hashes of the words of a text, and how many of them make a band.
HASHES, BAND = 256, 8
#: Share of equal min-hashes, an estimate of the Jaccard similarity, that makes a near copy.
ALIKE = 0.8
#: Lengths of the beginnings of words that are counted beside the words.
STEMS = (4, 5, 6)

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def forms(token: str) -> list[int]:
    """Hashes of a token and of its beginnings, marked as such, as signed numbers."""
    found = [token, *("^" + token[:k] for k in STEMS if len(token) > k)]
    return [xxhash.xxh3_64_intdigest(f.encode("utf-8", "surrogatepass")) - 2**63 for f in found]


class _Forms(dict):
    """Forms of tokens, hashed once each; started anew when it grows large."""

    def __missing__(self, token: str) -> list[int]:
        if len(self) > 1 << 18:
            self.clear()
        self[token] = value = forms(token)
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (from, to, score), in time linear in the scores.

    Candidates are kept with the running sums at their ends; each remembers the nearest
    one before it that starts lower, so that no candidate is passed over twice.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # from, to, sum before, sum after, lower
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, sums[i], sums[i + 1]
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= low:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= high:
                stack.append((start, i + 1, low, high, at))
                break
            start, low = stack[at][0], stack[at][2]  # swallow that candidate and all after it
            before = stack[at][4]
            del stack[at:]
            at = before
    return [(a, b, float(r - l)) for a, b, l, r, _ in stack]


class _Line(dict):
    """Scores of tokens, looked up once each; started anew when it grows large."""

    def __init__(self, scores: dict[int, float], drift: float):
        super().__init__()
        self.scores, self.drift = scores, drift

    def __missing__(self, token: str) -> float:
        if len(self) > 1 << 20:
            self.clear()
        found = (self.scores.get(f, 0.0) for f in forms(token))
        self[token] = value = max(found, key=abs) - self.drift
        return value


@dataclass
class Model:
    """Scores of forms, the drift, the extreme-value law and the logistic weights."""

    scores: dict[int, float] = field(default_factory=dict)
    drift: float = DRIFT
    decay: float = 1.0
    tops: np.ndarray = field(default_factory=lambda: np.zeros(1))  # scores, rising
    rates: np.ndarray = field(default_factory=lambda: np.ones(1))  # clean segments a token as good
    weights: tuple[float, float] = (0.0, 0.0)

    def line(self) -> _Line:
        return _Line(self.scores, self.drift)

    def by_chance(self, scores: np.ndarray) -> np.ndarray:
        """Segments as good that a token of clean text starts."""
        at = np.minimum(np.searchsorted(self.tops, scores, side="left"), len(self.tops) - 1)
        return self.rates[at] * np.exp(-self.decay * np.maximum(scores - self.tops[-1], 0.0))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> tuple[float, list]:
        """Evidence of the segments of a text of n tokens, and those that make it up.

        With e segments expected as good as the r-th, r or more of them have a probability
        below exp(-(r log(r / e) - r + e)).
        """
        if not found:
            return 0.0, []
        best = sorted(found, key=lambda x: -x[2])
        r = np.arange(1, len(best) + 1)
        e = np.maximum(n * self.by_chance(np.array([x[2] for x in best])), 1e-300)
        rare = np.where(r > e, r * np.log(r / e) - r + e, 0.0)
        top = int(rare.argmax())
        value = float(rare[top])
        return value, sorted(best[: top + 1]) if value > -np.log(CHANCE) else []

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[0] + self.weights[1] * np.log1p(evidence))))


def passages(words: list[str], line: _Line) -> tuple[list[tuple[int, int, float]], np.ndarray]:
    """The maximal segments in tokens, and the token scores.

    Log-odds are of documents that hold a token, so only its first place in a candidate
    counts: a word said over and over is no more evidence than once. Each candidate is
    judged on its own, and what it repeats belongs to the segment before.
    """
    scores = np.fromiter((line[w] for w in words), float, len(words))
    found = []
    for start, end, score in segments(scores):
        telling = start + np.flatnonzero(scores[start:end] > 0)
        seen: set[str] = set()
        again = [i for i in telling.tolist() if words[i] in seen or seen.add(words[i])]
        if not again:
            found.append((start, end, score))
            continue
        scores[again] = -line.drift
        parts = segments(scores[start:end])
        for (a, _, part), (after, *_) in zip(parts, [*parts[1:], (end - start, 0, 0.0)]):
            last = telling[np.searchsorted(telling, start + after) - 1]
            found.append((start + a, int(last) + 1, part))
    return found, scores


def _decay(scores: np.ndarray, mass: np.ndarray) -> float:
    """The positive root of E exp(decay * score) = 1, for scores below zero on average."""
    if not (scores > 0).any() or (scores * mass).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    grown = lambda x: (mass * np.exp(np.minimum(x * scores, 500))).sum()
    while grown(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if grown(mid) < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> tuple[float, ...]:
    """Weights of a logistic regression by damped Newton steps; no weight below zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(h, x.T @ (y - p) - keep @ w)
        w = w + np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(float(v) for v in w)


_SHIFT = np.random.default_rng(0).integers(0, 2**64, (2, HASHES, 1), dtype=np.uint64) | np.uint64(1)


def _minima(text: str, memo: _Forms) -> np.ndarray:
    """Least values of ``HASHES`` hashes of the words of a text; all alike without words."""
    words = np.array([memo[w][0] for w in set(tokens(text))], np.int64).view(np.uint64)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(words), 4096):
        part = (words[at : at + 4096] * _SHIFT[0] + _SHIFT[1]) >> np.uint64(32)
        least = np.minimum(least, part.min(axis=1).astype(np.uint32))
    return least


def _signature(text: Column) -> Column:
    @F.arrow_udf("binary")
    def sign(texts: pa.Array) -> pa.Array:
        memo = _Forms()
        return pa.array([_minima(t.as_py(), memo).tobytes() for t in texts], pa.binary())

    return sign(text)


def distinct(signatures: np.ndarray) -> list[int]:
    """Rows that are no near copy of a row kept before, in the order of the signatures.

    Rows that agree in a band of hashes are compared; near copies agree in ``ALIKE`` of all.
    """
    bands: list[dict[bytes, list[int]]] = [{} for _ in range(HASHES // BAND)]
    kept = []
    for i in sorted(range(len(signatures)), key=lambda i: signatures[i].tobytes()):
        keys = [signatures[i, k * BAND : (k + 1) * BAND].tobytes() for k in range(len(bands))]
        near = list({j for band, key in zip(bands, keys) for j in band.get(key, ())})
        if near and ((signatures[near] == signatures[i]).mean(axis=1) >= ALIKE).any():
            continue
        kept.append(i)
        for band, key in zip(bands, keys):
            band.setdefault(key, []).append(i)
    return kept


def _single(rows: DataFrame, sample: int) -> DataFrame:
    """(label, text) of the rows (n, label, text, sign) without near copies of one label.

    The signatures of the sample are at most ``sample`` times one kilobyte.
    """
    seen = rows.select("n", "label", "sign").limit(sample).toArrow()
    n, label = seen["n"].to_numpy(), seen["label"].to_numpy()
    sign = np.frombuffer(b"".join(seen["sign"].to_pylist()), np.uint32).reshape(-1, HASHES)
    kept = [int(n[at[i]]) for at in (np.flatnonzero(label == k) for k in (0, 1)) for i in distinct(sign[at])]
    picked = rows.sparkSession.createDataFrame(pa.table({"n": pa.array(kept, pa.int64())}))
    return rows.join(F.broadcast(picked), "n").select("label", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(form, bad, good): documents of either label with a form, added up by the chunk."""
    memo = _Forms()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found, labels = [], []
            for label, text in zip(part["label"].to_pylist(), part["text"].to_pylist()):
                keys = {f for w in set(tokens(text)) for f in memo[w]}
                found.append(np.fromiter(keys, np.int64, len(keys)))
                labels.append(np.full(len(keys), label))
            keys, place = np.unique(np.concatenate(found), return_inverse=True)
            bad = np.bincount(place, np.concatenate(labels), len(keys)).astype(np.int64)
            every = np.bincount(place, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(bad), pa.array(every - bad)], ["form", "bad", "good"]
            )


_BINS = np.linspace(-10, 10, 201)


def _odds(rows: DataFrame, bad: int, good: int, vocabulary: int) -> dict[int, float]:
    """Shrunk log-odds of the forms of (label, text), at most ``vocabulary`` of them."""
    counts = rows.mapInArrow(_count, "form bigint, bad bigint, good bigint")
    counts = counts.groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    prior = PRIOR * (F.col("bad") + F.col("good")) / (bad + good)

    def odds(seen: Column, every: int) -> Column:
        return F.log((seen + prior) / (every + PRIOR - seen - prior))

    ratio = odds(F.col("bad"), bad) - odds(F.col("good"), good)
    spread = F.sqrt(1 / (F.col("bad") + prior) + 1 / (F.col("good") + prior))
    shrunk = F.signum(ratio) * F.greatest(F.abs(ratio) - SHRINK * spread, F.lit(0.0))
    kept = counts.select("form", shrunk.alias("score"), F.abs(ratio / spread).alias("z"))
    kept = kept.filter("score != 0").orderBy(F.desc("z"), "form").limit(vocabulary).toArrow()
    return dict(zip(kept["form"].to_pylist(), kept["score"].to_pylist()))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """Fit a model to ``labels.toxic``; what the driver sees is bounded by the parameters."""
    rows = common.labelled_texts(docs, labels, "toxic", sample)
    rows = rows.withColumns({"n": F.monotonically_increasing_id(), "sign": _signature(F.col("text"))})
    rows = session.materialise(rows, "toxic")
    # near copies count once, or a copied text would make words of its own look telling
    single = session.materialise(_single(rows, sample), "toxic-single")
    number = {r.label: r["count"] for r in single.groupBy("label").count().collect()}
    bad, good = number.get(1, 0), number.get(0, 0)
    scores = _odds(single, bad, good, vocabulary) if bad and good else {}
    if not scores:
        rate = min(max(bad / max(bad + good, 1), 1e-6), 1 - 1e-6)
        return Model(weights=(float(np.log(rate / (1 - rate))), 0.0))
    model = Model(scores)

    @F.arrow_udf("struct<n:bigint,tops:array<double>,bins:array<int>>")
    def scan(texts: pa.Array) -> pa.Array:
        line, cells = model.line(), ([], [], [])
        for t in texts:
            words = tokens(t.as_py())
            found, seen = passages(words, line)
            cells[0].append(len(words))
            cells[1].append([s for *_, s in found])
            cells[2].append(np.histogram(np.clip(seen, -9.99, 9.99), _BINS)[0].astype(np.int32))
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32())]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["n", "tops", "bins"])

    seen = rows.select("label", scan(F.col("text")).alias("v")).select("label", "v.*").limit(sample).toArrow()
    label, n = seen["label"].to_numpy(), seen["n"].to_numpy()
    found = [[(0, 0, s) for s in x] for x in seen["tops"].to_pylist()]
    clean = label == 0
    mass = np.array(seen["bins"].to_pylist(), float)[clean].sum(axis=0)
    model.decay = _decay((_BINS[:-1] + _BINS[1:]) / 2, mass / max(mass.sum(), 1))
    chance = np.sort([s for x, c in zip(found, clean) if c for *_, s in x])
    if len(chance):
        model.tops, first = np.unique(chance, return_index=True)
        model.rates = (len(chance) - first) / max(n[clean].sum(), 1)
    else:
        model.rates = np.array([1 / max(n[clean].sum(), 1)])
    evidence = np.array([model.evidence(k, x)[0] for k, x in zip(n, found)])
    order = np.lexsort((evidence, label))  # the same sums in every run
    model.weights = _logistic(np.log1p(evidence[order])[:, None], label[order].astype(float))
    return model


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def scores(text: Column, model: Model) -> Column:
    """Struct of score, n_passages and passages (token spans with their scores)."""

    @F.arrow_udf("struct<score:double,n_passages:bigint,passages:string>")
    def judge(texts: pa.Array) -> pa.Array:
        line, evidence, counts, spans = model.line(), [], [], []
        for t in texts:
            words = tokens(t.as_py())
            value, best = model.evidence(len(words), passages(words, line)[0])
            evidence.append(value)
            counts.append(len(best))
            spans.append(",".join(f"{a}:{b}:{s:.2f}" for a, b, s in best))
        return pa.StructArray.from_arrays(
            [pa.array(model.score(np.array(evidence, float))), pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
            ["score", "n_passages", "passages"],
        )

    return judge(text)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted, significant passages.

    Labels of held-out IDs are dropped before the fit.
    """
    model = train(docs, labels.filter(~held_out(common.field("doc_id"))), sample)
    ident = common.field("doc_id")
    rows = docs.select(
        ident.alias("doc_id"), held_out(ident).alias("held_out"), scores(common.text_of(), model).alias("v")
    )
    return rows.select(
        "doc_id", "held_out", "v.score", (F.col("v.score") >= 0.5).cast("int").alias("predicted"),
        "v.n_passages", "v.passages",
    )
