"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees, boosted over one feature after the other in cycles, are summed into one lookup table
per feature; a few pairs of features get tables over both. A score is a sum of table
entries, taken for many rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import id_remainder, pieces, texts_of
from ranklight.llm.labelled import hashed_sample, labelled_rows
from ranklight.llm.text_stats import measure_all

_SMOOTH = 2.0


def features(texts: list[bytes]) -> np.ndarray:
    counts, ratios = measure_all(texts)
    return np.column_stack([np.log1p(counts[:, 0]), ratios]) if len(texts) else np.zeros((0, 16))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + _SMOOTH) + (all_g - left_g) ** 2 / (all_h - left_h + _SMOOTH)
    gain -= all_g**2 / (all_h + _SMOOTH)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The leaf values, per bin, of a tree of depth two over one feature."""
    _, middle = _best_cut(g, h)
    cuts = {0, middle, middle + _best_cut(g[middle:], h[middle:])[1], len(g)}
    cuts.add(_best_cut(g[:middle], h[:middle])[1])
    out = np.zeros(len(g))
    edges = sorted(cuts)
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + _SMOOTH)
    return out


def _pair_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts one feature, then the other on each side."""
    best = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, row = _best_cut(a.sum(1), b.sum(1))
        out, gain = np.zeros_like(a), 0.0
        for part in (slice(0, row), slice(row, None)):
            if not len(a[part]):
                continue
            more, column = _best_cut(a[part].sum(0), b[part].sum(0))
            gain += more
            for side in (slice(0, column), slice(column, None)):
                out[part, side] = a[part, side].sum() / (b[part, side].sum() + _SMOOTH)
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


@dataclass
class Gam:
    """Bin edges and tables; ``pairs`` holds (feature, feature, table)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        small = {f: np.searchsorted(self.coarse[f], x[:, f], side="right") for p in self.pairs for f in p[:2]}
        for i, j, table in self.pairs:
            total += table[small[i], small[j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -30, 30)))


def fit_gam(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 200,
    pair_rounds: int = 60,
    n_pairs: int = 8,
    rate: float = 0.1,
    bins: int = 48,
    coarse_bins: int = 12,
) -> Gam:
    """Learn the tables from features and labels; without rows of both labels a constant."""
    model = Gam(base=float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    if not 0 < y.sum() < len(y):
        return model
    width = x.shape[1]
    for f in range(width):
        for count, into in ((bins, model.edges), (coarse_bins, model.coarse)):
            into.append(np.unique(np.quantile(x[:, f], np.arange(1, count) / count)))
    placed = [np.searchsorted(model.edges[f], x[:, f], side="right") for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-logit))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            n = len(model.tables[f])
            step = rate * _step(np.bincount(placed[f], g, n), np.bincount(placed[f], h, n))
            model.tables[f] += step
            logit += step[placed[f]]
    small = [np.searchsorted(model.coarse[f], x[:, f], side="right") for f in range(width)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cell, n = small[i] * shape[1] + small[j], shape[0] * shape[1]
        return np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape)

    ranked = sorted(combinations(range(width), 2), key=lambda p: -_pair_step(*grid(*p))[0])
    chosen = ranked[:n_pairs]
    tables = {p: np.zeros([len(model.coarse[f]) + 1 for f in p]) for p in chosen}
    for _ in range(pair_rounds):
        for i, j in chosen:
            step = rate * _pair_step(*grid(i, j))[1]
            tables[i, j] += step
            logit += step[small[i], small[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **settings) -> Gam:
    """Fit on at most ``max_labelled`` labelled rows of the learning fold.

    The fold is every id whose crc32 modulo 3 is not 1. Features are measured on the executors;
    only they and the labels reach the driver.
    """
    fold = id_remainder(3) != 1
    rows = hashed_sample(labelled_rows(docs, labels, "quality", fold), max_labelled)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            x = features(texts_of(batch.column("text")))
            values = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), values], ["label", "x"])

    found = rows.select("text", "label").mapInArrow(measured, "label int, x array<double>").toPandas()
    if not len(found):
        return Gam()
    return fit_gam(np.stack(found["x"].to_list()), found["label"].to_numpy(float), **settings)


def score_quality(docs: DataFrame, model: Gam) -> DataFrame:
    """Every document's id and text with ``score``, high for good quality.

    Whole texts are scored, null as empty; text, not the id, decides the score.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            score = model.scores(features(texts_of(batch.column("text"))))
            yield batch.drop_columns(["text"]).append_column("score", pa.array(score))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(scored, f"{kinds}, score double")


def quality_digest(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and repeated ids are rows like others. Without labels of both kinds all scores
    are the share of label 1, smoothed.
    """
    model = fit_quality(docs, labels, **settings)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (id_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **settings) -> DataFrame:
    """The documents, all columns, whose score reaches ``threshold``."""
    model = fit_quality(docs, labels, **settings)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            score = model.scores(features(texts_of(batch.column("text"))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(kept, docs.schema)
