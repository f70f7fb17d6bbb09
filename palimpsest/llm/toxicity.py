"""Toxicity by a classifier chain.

Categories are predicted one after the other; each linear model sees word and word-beginning
features plus the probabilities of the earlier categories. In training those probabilities are
out-of-fold predictions, so that a later model meets them as it will on unseen text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tidy

#: Labelled rows that a fit uses at most, taken by the hash of their id.
MAX_LABELLED = 8_000
FOLDS = 3

_WORD = re.compile(r"[^\W\d_]+|[^\w\s]+")
_PREFIXES = (4, 5)
_CACHED = 150_000


def features_of(word: str) -> list[int]:
    """Hashes of a lower-case word, or run of marks, and of its beginnings."""
    forms = [word, *(f"{word[:k]}~" for k in _PREFIXES if len(word) >= k)]
    return [crc32(f.encode("utf-8", "replace")) - (1 << 31) for f in forms]


def document_features(text: str | None) -> set[int]:
    """The distinct features of a text; none for a null, empty or blank one."""
    return {f for w in set(_WORD.findall((text or "").lower())) for f in features_of(w)}


@dataclass
class Link:
    """One category's model: sorted feature hashes, their weights, weights of earlier probabilities, bias."""

    name: str
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    threshold: float = 0.5

    def logits(self, x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return x @ self.weights + before @ self.earlier + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit_linear(x: np.ndarray, y: np.ndarray, l2: float = 2e-4, rounds: int = 150) -> np.ndarray:
    """Logistic regression with both classes weighing the same, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    positive = max(y.sum(), 1)
    weight = np.where(y > 0, 0.5 / positive, 0.5 / max(len(y) - positive, 1)).astype(np.float32)
    step = 1 / (0.25 * float((weight * (x * x).sum(1)).sum()) + l2)
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        gradient = x.T @ (weight * (_sigmoid(x @ v) - y)) + l2 * v
        new = v - step * gradient
        v, w = new + k / (k + 3) * (new - w), new
    return w


def _dense(rows: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), len(features)), np.float32)
    if len(features):
        for i, r in enumerate(rows):
            at = np.searchsorted(features, r)
            x[i, at[(at < len(features)) & (features[np.minimum(at, len(features) - 1)] == r)]] = 1
    return x


def _associated(rows: list[np.ndarray], y: np.ndarray, chance: float = 0.05, purity: float = 0.6) -> np.ndarray:
    """Features that speak for the category: of the rows with one, a share of ``purity`` at least is
    positive, and more than chance would give any of the features with as many rows. Rows with the
    same features and label (copies) count once."""
    kept = [*{(r.tobytes(), int(v)): i for i, (r, v) in enumerate(zip(rows, y))}.values()]
    rows, y = [rows[i] for i in kept], y[kept]
    ids, where = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int32), return_inverse=True)
    total = np.bincount(where, minlength=len(ids)).astype(float)
    hits = np.bincount(where, weights=np.repeat(y, [len(r) for r in rows]), minlength=len(ids))
    p = y.mean() if len(y) else 0.0
    if not 0 < p < 1:
        return ids[:0]
    rate = np.clip(hits / np.maximum(total, 1), 1e-9, 1 - 1e-9)
    excess = total * (rate * np.log(rate / p) + (1 - rate) * np.log((1 - rate) / (1 - p)))  # minus the log of a bound on the tail
    alike = np.bincount(total.astype(np.int64))[total.astype(np.int64)]
    best = np.flatnonzero((rate > p) & ((hits + 0.5) / (total + 1) >= purity) & (excess > np.log(alike / chance)))
    return ids[best]


def fit_chain(rows: list[np.ndarray], labels: dict[str, np.ndarray], fold: np.ndarray, folds: int = FOLDS) -> list[Link]:
    """The chain over ``labels`` (name to 0/1 per row, in order), from sorted feature arrays.

    ``fold`` deals rows to folds. A category without both classes gets a model that says never.
    """
    chain, before = [], np.zeros((len(rows), 0), np.float32)
    for name, y in labels.items():
        y = y.astype(np.float32)
        if not 0 < y.sum() < len(y):
            chain.append(Link(name, np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(before.shape[1], np.float32), -30.0))
            before = np.hstack([before, np.zeros((len(rows), 1), np.float32)])
            continue
        out = np.zeros(len(rows), np.float32)
        for k in range(folds):  # features are chosen, as weights are fitted, without the fold
            test = fold % folds == k
            if not test.any():
                continue
            own = _associated([r for r, t in zip(rows, test) if not t], y[~test])
            x = np.hstack([_dense(rows, own), before])
            w = _fit_linear(x[~test], y[~test])
            out[test] = _sigmoid(x[test] @ w[:-1] + w[-1])
        features = _associated(rows, y)
        w = _fit_linear(np.hstack([_dense(rows, features), before]), y)
        n = len(features)
        chain.append(Link(name, features, w[:n], w[n:-1], float(w[-1]), _threshold(out, y)))
        before = np.hstack([before, out[:, None]])
    return chain


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The out-of-fold threshold of best F0.5, which weighs precision more; halfway to the next lower score."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    score = hits / (np.arange(1, len(p) + 1) + 0.25 * y.sum())
    best = int(np.argmax(score))
    below = p[order[best + 1]] if best + 1 < len(p) else 0.0
    return float(np.clip((p[order[best]] + below) / 2, 0.05, 0.95))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED) -> list[Link]:
    """Fit a chain on at most ``max_labelled`` labelled documents.

    ``categories`` maps names, in chain order, to 0/1 columns over ``labels`` joined with ``docs``;
    null counts as 0. The sample is the labels of least hashed id, so it is the same in every run;
    only it is broadcast, and only features of ``max_labelled`` rows reach the driver. Labels without
    a document, and null ids, are ignored; of documents that share an id each counts, up to the bound. Of
    several labels of an id the greatest value of each column counts. Copies of a text are in one fold, so
    that no model is judged on what it was fitted to. Ids are whole numbers; others raise.
    """
    others = [F.max(F.col(f"`{c}`")).alias(c) for c in labels.columns if c != id_col]
    sample = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*others).orderBy(F.xxhash64(id_col), id_col).limit(max_labelled)
    joined = docs.join(F.broadcast(sample), id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [sorted(document_features(t)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(found, pa.list_(pa.int32()))], ["id", "y", "x"])

    marks = F.array(*[F.coalesce(c.cast("int"), F.lit(0)) for c in categories.values()])
    table = joined.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), marks.alias("y")).mapInArrow(
        tidy(run), "id long, y array<int>, x array<int>"
    ).orderBy(F.xxhash64("id"), "id", F.xxhash64("x")).limit(max_labelled).toArrow()
    order = pa.compute.sort_indices(table, [("id", "ascending")])
    table = table.take(order)
    rows = [np.asarray(r.values) for r in table.column("x")]
    y = np.array(table.column("y").to_pylist(), np.int64).reshape(len(rows), len(categories))
    fold = np.array([crc32(r.tobytes()) for r in rows], np.int64)
    return fit_chain(rows, {name: y[:, k] for k, name in enumerate(categories)}, fold)


def score(docs: DataFrame, chain: list[Link], text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """All rows of ``docs`` with a probability ``p_<category>`` and a flag ``is_<category>`` each.

    Every row is scored on its whole text; null and empty texts have no features. An added column
    replaces one of its name. The chain has a bounded number of features, and travels with the task.
    """
    added = [f"{prefix}{c.name}" for c in chain] + [f"is_{c.name}" for c in chain]
    rest = docs.drop(*added)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields]
                       + [f"`{a}` double" for a in added[: len(chain)]] + [f"`{a}` boolean" for a in added[len(chain) :]])
    union = np.unique(np.concatenate([c.features for c in chain])) if chain else np.zeros(0, np.int32)
    weights = np.zeros((len(union), len(chain)))
    for k, c in enumerate(chain):
        weights[np.searchsorted(union, c.features), k] = c.weights
    wanted = {int(f): i for i, f in enumerate(union)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}

        def hits(text: str | None) -> list[int]:
            words = set(_WORD.findall((text or "").lower()))
            for w in [w for w in words if w not in known]:
                known[w] = tuple(wanted[f] for f in features_of(w) if f in wanted)
            return list({i for w in words for i in known[w]})

        for batch in batches:
            for part in text_slices(batch, text_col):
                if len(known) > _CACHED:
                    known.clear()
                base = np.array([weights[h].sum(0) if (h := hits(t)) else np.zeros(len(chain)) for t in part.column(text_col).to_pylist()]).reshape(part.num_rows, len(chain))
                p = np.zeros((part.num_rows, len(chain)))
                for k, c in enumerate(chain):
                    p[:, k] = _sigmoid(base[:, k] + p[:, :k] @ c.earlier + c.bias)
                out = [pa.array(p[:, k]) for k in range(len(chain))] + [pa.array(p[:, k] >= c.threshold) for k, c in enumerate(chain)]
                yield pa.RecordBatch.from_arrays([*part.columns, *out], [*part.schema.names, *added])

    return rest.mapInArrow(tidy(run), schema)


def label_categories() -> dict[str, Column]:
    """The chain over the labels table: low quality, toxic in English, toxic in any language."""
    toxic = F.col("toxic") == 1
    return {"low_quality": F.col("quality") == 0, "toxic_en": toxic & (F.col("lang") == "en"), "toxic": toxic}


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` scored by a chain that is fitted to ``labels`` (doc_id, quality, toxic) and the documents they name."""
    chain = train(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"), label_categories())
    return score(docs, chain)
