"""Main text of web pages by a tree-structured graphical model.

Every node of a page's tree, element or text, is content or not. Its own evidence is a
weighted sum of features (tag, words of class, id and role, length, share of linked text);
potentials between parent and child, by the kind of the child, say how much a child goes
with its parent. Sum-product messages up and down the tree give the exact marginal of every
node, and texts more likely content than not make up the main text. Weights are trained on
labelled pages by the gradient of the likelihood, which needs just these marginals.

Messages run level by level over all pages of a batch at once. Null, empty and broken pages
have the text that is left of them, "" if none; very long pages are read whole; repeated
rows are each returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litsieve.llm import common, labelled_pages
from litsieve.llm.html_tree import INLINE, Tree, parse, shown

# Names that pages give to their parts.
_CONCEPTS = {
    "main": "content article post entry story body text main",
    "nav": "menu nav navbar navigation breadcrumb breadcrumbs toc pagination pager tabs skip links",
    "header": "header masthead logo topbar hero branding",
    "footer": "footer bottom copyright legal colophon",
    "side": "sidebar aside widget rail related recommended recommendations trending popular recent complementary",
    "ad": "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner",
    "comment": "comment comments commentlist disqus reply replies discussion respond responses reviews",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter paywall signup subscribe privacy",
    "share": "share sharing social follow facebook twitter",
    "form": "form search login input register contact",
}
_CONCEPT = {w: c for c, words in _CONCEPTS.items() for w in words.split()}
_TAGS = (
    "html body div span p a ul ol li nav header footer aside main article section h1 h2 h3 h4 h5 h6 "
    "form label button fieldset table tr td th blockquote pre code b strong em i figure figcaption dl dt dd #text"
).split()
_KINDS = ("text", "inline", "block", "section")
_SECTIONS = frozenset("nav header footer aside main article section form div body ul ol table".split())

_FEATURES = (
    ["bias", "tag:other"] + [f"tag:{t}" for t in _TAGS] + [f"word:{c}" for c in _CONCEPTS]
    + [f"in:{t}" for t in ("article", "body", "nav", "ul", "div")]
    + [f"length:{k}" for k in range(8)] + [f"linked:{k}" for k in range(4)] + ["own:header in article"]
)
_NUMBER = {f: i for i, f in enumerate(_FEATURES)}


@dataclass
class Forest:
    """The trees of some pages in one set of arrays."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]  # nodes by depth, roots first
    node: np.ndarray  # with feature: which node has which feature
    feature: np.ndarray
    starts: list[int]

    @property
    def size(self) -> int:
        return len(self.parent)


def _features(tree: Tree) -> list[list[int]]:
    n = len(tree.tag)
    chars, linked = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):  # children after parents
        if tree.text[i] is not None:
            chars[i] = len(tree.text[i].strip())
        if tree.tag[i] == "a":
            linked[i] = chars[i]
        chars[tree.parent[i]] += chars[i]
        linked[tree.parent[i]] += linked[i]
    rows = []
    for i in range(n):
        tag, up = tree.tag[i], tree.tag[tree.parent[i]] if i else ""
        row = [0, _NUMBER.get(f"tag:{tag}", 1), _NUMBER[f"length:{min(chars[i].bit_length() // 2, 7)}"]]
        if (near := _NUMBER.get(f"in:{up}")) is not None:
            row.append(near)
        if tree.text[i] is None and chars[i]:
            row.append(_NUMBER[f"linked:{min(4 * linked[i] // chars[i], 3)}"])
        row += {_NUMBER[f"word:{_CONCEPT[w]}"] for w in tree.words[i] if w in _CONCEPT}
        if tag == "header" and up in ("article", "main", "section"):
            row.append(_NUMBER["own:header in article"])
        rows.append(row)
    return rows


def forest(trees: Sequence[Tree]) -> Forest:
    parent, kind, depth, node, feature, starts = [], [], [], [], [], []
    for tree in trees:
        base = len(parent)
        starts.append(base)
        for i, (up, tag) in enumerate(zip(tree.parent, tree.tag)):
            parent.append(up + base if i else -1)
            depth.append(depth[up + base] + 1 if i else 0)
            kind.append(0 if tag == "#text" else 1 if tag in INLINE else 3 if tag in _SECTIONS else 2)
        for i, row in enumerate(_features(tree)):
            node += [base + i] * len(row)
            feature += row
    level = np.array(depth, np.int64)
    order = np.argsort(level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    return Forest(
        np.array(parent, np.int64), np.array(kind, np.int64), np.split(order, cuts),
        np.array(node, np.int64), np.array(feature, np.int64), starts,
    )


@dataclass
class Model:
    """Feature weights, and potentials [kind of child, parent, child]."""

    weights: np.ndarray
    edges: np.ndarray


def _sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(model: Model, f: Forest, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability of content for every node; with ``pairs`` also that of (parent, child)."""
    up = np.zeros((f.size, 2))  # a node's evidence with all messages from below
    up[:, 1] = np.bincount(f.node, model.weights[f.feature], f.size)
    message = np.zeros((f.size, 2))  # to the parent
    for nodes in reversed(f.levels[1:]):
        message[nodes] = _sum(up[nodes][:, None, :] + model.edges[f.kind[nodes]], 2)
        for y in (0, 1):
            np.add.at(up[:, y], f.parent[nodes], message[nodes, y])
    belief = up.copy()
    for nodes in f.levels[1:]:
        rest = belief[f.parent[nodes]] - message[nodes]
        belief[nodes] += _sum(rest[:, :, None] + model.edges[f.kind[nodes]], 1)
        belief[nodes] -= belief[nodes].max(axis=1, keepdims=True)  # deep trees stay in range
    p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))
    if not pairs:
        return p, None
    rest = belief[f.parent] - message
    joint = rest[:, :, None] + model.edges[f.kind] + up[:, None, :]
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    return p, joint / joint.sum(axis=(1, 2), keepdims=True)


def _labels(tree: Tree) -> np.ndarray:
    """Content is what the nearest label around it says; unlabelled parts are not."""
    out = np.zeros(len(tree.tag), np.int64)
    for i, label in enumerate(tree.label):
        out[i] = label == "keep" if label else (out[tree.parent[i]] if i else 0)
    return out


def train(pages: Sequence[str], rounds: int = 250, rate: float = 0.1, l2: float = 0.02) -> Model:
    """Weights and potentials that make the labels of ``pages`` most likely."""
    trees = [parse(p) for p in pages]
    f = forest(trees)
    y = np.concatenate([_labels(t) for t in trees]) if trees else np.zeros(0, np.int64)
    inner = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((len(_KINDS), 2, 2))
    np.add.at(seen, (f.kind[inner], y[f.parent[inner]], y[inner]), 1)
    model = Model(np.zeros(len(_FEATURES)), np.zeros((len(_KINDS), 2, 2)))
    mean = [np.zeros_like(model.weights), np.zeros_like(model.edges)]
    square = [np.zeros_like(model.weights), np.zeros_like(model.edges)]
    for step in range(1, rounds + 1):
        p, joint = marginals(model, f, pairs=True)
        expected = np.zeros_like(seen)
        np.add.at(expected, f.kind[inner], joint[inner])
        slopes = [
            np.bincount(f.feature, (y - p)[f.node], len(_FEATURES)) - l2 * model.weights,
            seen - expected - l2 * model.edges,
        ]
        for k, values in enumerate((model.weights, model.edges)):
            mean[k] += 0.1 * (slopes[k] - mean[k])
            square[k] += 0.01 * (slopes[k] ** 2 - square[k])
            fixed = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
            values += rate * mean[k] / (1 - 0.9**step) / fixed
    return model


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages.pages())


def _texts(pages: Iterator[str], model: Model, nodes: int = 20_000) -> Iterator[str]:
    """Main texts; pages are put together until they have so many nodes."""
    held: list[Tree] = []

    def done() -> Iterator[str]:
        f = forest(held)
        keep = marginals(model, f)[0] >= 0.5
        for tree, start in zip(held, f.starts):
            yield shown(tree, keep[start : start + len(tree.tag)])

    size = 0
    for page in pages:
        held.append(parse(page))
        size += len(held[-1].tag)
        if size >= nodes:
            yield from done()
            held, size = [], 0
    if held:
        yield from done()


def main_text(html: Column, model: Model) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array(list(_texts((p.as_py() for p in pages), model)), pa.string())

    return extract(html)


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per page row: page_id, url, text and n_chars."""
    text = main_text(common.text_of("html"), model or default_model())
    rows = pages.select(common.field("page_id").alias("page_id"), common.field("url").alias("url"), text.alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
