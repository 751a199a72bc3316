"""Toxicity classifier whose scores may not depend on which group a text mentions.

A logistic model over the words of a text and their beginnings. For each labelled text that mentions a group,
counterfactual texts name other groups of the same kind instead; the loss adds the
squared change of the logit, so that weight moves from the mention to what is said.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import id_remainder, pieces
from ranklight.llm.labelled import hashed_sample, labelled_rows

#: Groups of terms; a term may be swapped for another of its group.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
)
_GROUP = {t: g for g in IDENTITY_TERMS for t in g}
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (3, 4, 5, 6, 7)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def word_features(word: str, bits: int) -> list[int]:
    """Hashed ids of a word and of its beginnings."""
    shift = 64 - bits
    parts = ["=" + word, *[word[:k] for k in _BEGINNINGS if len(word) >= k]]
    return [xxhash.xxh64_intdigest(p) >> shift for p in parts]


def swaps(words: set[str]) -> list[set[str]]:
    """The words with every group mention moved on by one, two, ... terms of its group."""
    found = [w for w in words if w in _GROUP]
    if not found:
        return []
    longest = max(len(_GROUP[w]) for w in found)
    rest = words.difference(found)

    def moved(word: str, by: int) -> str:
        group = _GROUP[word]
        return group[(group.index(word) + by) % len(group)]

    return [rest | {moved(w, by) for w in found} for by in range(1, longest)]


@dataclass
class ToxicityModel:
    bias: float = 0.0
    bits: int = 20
    weights: dict[int, float] = field(default_factory=dict)

    def scorer(self):
        """A function from texts to scores that remembers the features of frequent words."""
        known: dict[str, tuple[int, ...]] = {}

        def active(word: str) -> tuple[int, ...]:
            found = known.get(word)
            if found is None:
                if len(known) >= 300_000:
                    known.clear()
                found = tuple(f for f in word_features(word, self.bits) if f in self.weights)
                known[word] = found
            return found

        def score(texts: list[str | None]) -> np.ndarray:
            logits = []
            for text in texts:
                present = {f for w in words_of(text) for f in active(w)}
                logits.append(self.bias + sum(sorted(self.weights[f] for f in present)))
            return 1.0 / (1.0 + np.exp(-np.clip(np.array(logits, float), -30, 30)))

        return score


def _ids(words: set[str], bits: int) -> list[int]:
    return sorted({f for w in words for f in word_features(w, bits)})


class _Rows:
    """Sparse 0/1 rows: forward and backward products."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.col = np.concatenate([np.zeros(0, np.int32), *rows])
        self.filled = np.flatnonzero(self.lengths)
        self.starts = (np.cumsum(self.lengths) - self.lengths)[self.filled]
        self.width = width

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.lengths))
        if len(self.filled):
            out[self.filled] = np.add.reduceat(w[self.col], self.starts)
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, np.repeat(g, self.lengths), self.width)


def fit_weights(
    texts: list[np.ndarray],
    labels: np.ndarray,
    changed: list[tuple[int, np.ndarray]],
    bits: int = 20,
    min_docs: int = 3,
    sparsity: float = 4e-4,
    fairness: float = 1.0,
    rounds: int = 150,
) -> ToxicityModel:
    """Accelerated proximal gradient on logistic loss + sparsity + fairness.

    ``changed`` pairs the number of a text with the features of one counterfactual.
    """
    positive = float(labels.sum())
    model = ToxicityModel(float(np.log((positive + 1) / (len(labels) - positive + 1))), bits)
    if not 0 < positive < len(labels):
        return model
    seen = np.bincount(np.concatenate(texts), minlength=1 << bits)
    kept = np.flatnonzero(seen >= min_docs)
    if not len(kept):
        return model
    place = np.full(1 << bits, -1, np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)

    def placed(ids: np.ndarray) -> np.ndarray:
        p = place[ids]
        return p[p >= 0]

    x = _Rows([placed(t) for t in texts], len(kept))
    # Of a text and its counterfactual only the features that differ change the logit.
    base = _Rows([placed(np.setdiff1d(texts[i], c)) for i, c in changed], len(kept))
    other = _Rows([placed(np.setdiff1d(c, texts[i])) for i, c in changed], len(kept))
    # Frequent features get shorter steps; the rest could otherwise hardly move.
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (len(labels) - positive))
    curve = x.back(weight) * 0.25 * np.sqrt(np.mean(x.lengths))
    if changed:
        reach = 2 * fairness * (base.lengths + other.lengths) / len(changed)
        curve = curve + base.back(reach) + other.back(reach)
    step = 1.0 / (curve + 1e-3)
    w = z = np.zeros(len(kept))
    bias = bias_z = 0.0
    t = 1.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x.dot(z) + bias_z, -30, 30)))
        slope = weight * (p - labels)
        gradient = x.back(slope)
        if changed:
            gap = 2 * fairness * (base.dot(z) - other.dot(z)) / len(changed)
            gradient += base.back(gap) - other.back(gap)
        moved = z - 0.3 * step * gradient
        moved = np.sign(moved) * np.maximum(np.abs(moved) - 0.3 * step * sparsity, 0)
        moved_bias = bias_z - 2.0 * slope.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (slope.sum() * (moved_bias - bias) + gradient @ (moved - w)) > 0:
            t_next, t = 1.0, 1.0
        z = moved + (t - 1) / t_next * (moved - w)
        bias_z = moved_bias + (t - 1) / t_next * (moved_bias - bias)
        w, bias, t = moved, moved_bias, t_next
    model.bias = float(bias)
    model.weights = {int(kept[i]): float(w[i]) for i in np.flatnonzero(w)}
    return model


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 6_000, bits: int = 20, **settings
) -> ToxicityModel:
    """Fit on at most ``max_labelled`` labelled rows whose id's crc32 modulo 5 is not 0.

    Feature ids are made on the executors; only they and the labels reach the driver.
    """
    fold = id_remainder(5) != 0
    rows = hashed_sample(labelled_rows(docs, labels, "toxic", fold), max_labelled)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            own = pa.array([_ids(w, bits) for w in words], pa.list_(pa.int32()))
            others = pa.array(
                [[_ids(c, bits) for c in swaps(w)] for w in words], pa.list_(pa.list_(pa.int32()))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), own, others], ["label", "own", "others"]
            )

    found = (
        rows.select("text", "label")
        .mapInArrow(encoded, "label int, own array<int>, others array<array<int>>")
        .toArrow()
    )
    texts = [np.array(x, np.int32) for x in _lists(found["own"])]
    changed = [
        (i, np.array(c, np.int32)) for i, cs in enumerate(found["others"].to_pylist()) for c in cs
    ]
    return fit_weights(texts, found["label"].to_numpy().astype(float), changed, bits, **settings)


def _lists(column: pa.ChunkedArray) -> Iterator[np.ndarray]:
    for chunk in column.chunks:
        values, ends = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        yield from (values[a:b] for a, b in zip(ends, ends[1:]))


def toxicity_digest(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score (high: toxic) and predicted of every document.

    Whole texts, null as empty; null and repeated ids are rows like others. Without
    labels of both kinds every score is the smoothed share of label 1.
    """
    model = fit_toxicity(docs, labels, **settings)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in pieces(batches, "text", 8 << 20):
            found = pa.array(score(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    done = docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")
    return done.select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
