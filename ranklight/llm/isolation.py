"""Quality rules: exact counts, a base rule, and an isolation forest over rule ratios.

Trees cut a random feature at a random value until rows are taken apart. Rows that few
cuts set apart are unusual; how few is too few is read off labelled rows. All documents
grow every tree, and all labelled rows of the learning fold set the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import id_remainder, pieces, texts_of
from ranklight.llm.labelled import labelled_rows
from ranklight.llm.text_stats import COUNTS, RATIOS, measure_all
from ranklight.operators.ordering import add_range, running_sums
from ranklight.session import settle

#: The ratios that the forest looks at: one for each way in which a page can be odd by itself. Repeated
#: passages are the base rule's subject; what only tells prose from lists or one script from another is left out.
RULES = tuple(
    RATIOS.index(r)
    for r in (
        "word_length",
        "symbol_share",
        "upper_share",
        "exclamations",
        "digit_share",
        "bars",
        "dup_line_share",
        "distinct_share",
        "twin_share",
        "longest_word",
    )
)


def _expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth at which a random tree of n rows sets one apart."""
    n = np.maximum(np.asarray(n, float), 1)
    m = np.maximum(n - 1, 1e-9)
    return np.where(n > 2, 2 * (np.log(m) + np.euler_gamma) - 2 * m / n, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as heaps: per node the feature (-1: leaf), the cut, and the depth a leaf stands for."""

    feature: np.ndarray
    cut: np.ndarray
    depth: np.ndarray
    usual: float
    threshold: float = 1.0

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus mean path over usual path: near 1 for odd rows."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, depth in zip(self.feature, self.cut, self.depth):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1)) - 1):
                f = feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += depth[node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.usual)


def fit_forest(x: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 11) -> Forest:
    """Grow ``trees`` trees on the rows of one array, each on ``rows`` drawn, to the depth log2(rows).

    ``grow_forest`` is the form for a table.
    """
    draw = np.random.default_rng(seed)
    rows = min(rows, len(x))
    levels = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    nodes = 2 ** (levels + 1) - 1
    feature = np.full((trees, nodes), -1)
    cut, depth = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        waiting = [(0, 0, x[draw.choice(len(x), rows, replace=False)])] if rows else []
        while waiting:
            node, level, own = waiting.pop()
            low, high = own.min(0), own.max(0)
            open_features = np.flatnonzero(high > low)
            if level == levels or len(own) < 2 or not len(open_features):
                depth[t, node] = level + _expected_path(len(own))
                continue
            f = int(draw.choice(open_features))
            at = draw.uniform(low[f], high[f])
            at = high[f] if at <= low[f] else at
            feature[t, node], cut[t, node] = f, at
            right = own[:, f] >= at
            waiting += [(2 * node + 1, level + 1, own[~right]), (2 * node + 2, level + 1, own[right])]
    return Forest(feature, cut, depth, float(_expected_path(max(rows, 2))))


def calibrate(anomaly: np.ndarray, good: np.ndarray) -> float:
    """The threshold with the best sum of the two recalls on labelled rows, that of good rows twice."""
    if not 0 < good.sum() < len(good):
        return 1.0
    order = np.argsort(anomaly, kind="stable")
    values, kept_good = anomaly[order], np.cumsum(good[order]) / good.sum()
    kept_bad = np.cumsum(~good[order]) / (~good).sum()
    gain = 2 * kept_good - kept_bad
    gain[:-1][values[:-1] == values[1:]] = -2  # a tie cannot be cut in two
    at = int(np.argmax(gain))
    return float((values[at] + values[min(at + 1, len(values) - 1)]) / 2)


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Fewer than 20 words, or over 30 percent of the words in repeated windows."""
    return (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])


def measured_rows(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and ``x``, the rules' ratios, of every document; null text is empty."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            counts, ratios = measure_all(texts_of(batch.column("text")))
            columns = [pa.array(counts[:, k]) for k in range(len(COUNTS))]
            x = pa.array(list(ratios[:, RULES]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(base_failed(counts)), x],
                ["doc_id", *COUNTS, "base_failed", "x"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(
        measured, f"doc_id {kind}, {counted}, base_failed boolean, x array<double>"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _level_nodes(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that a tree has not yet put into a leaf above ``level``, and their place in that level."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for _ in range(level):
        f = feature[node]
        inner = f >= 0
        rows, node, f = rows[inner], node[inner], f[inner]
        node = 2 * node + 1 + (x[rows, f] >= cut[node])
    return rows, node - (2**level - 1)


def _level_table(x: DataFrame, feature: np.ndarray, cut: np.ndarray, level: int, width: int) -> tuple:
    """Rows, least and largest values of each node of a level, over all of ``x``.

    Each task sends one row for each node that it meets, so their number depends on the trees alone.
    """
    trees, nodes = len(feature), 2**level
    lows, highs = [f"low{k}" for k in range(width)], [f"high{k}" for k in range(width)]

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((trees, nodes), np.int64)
        low, high = np.full((trees, nodes, width), np.inf), np.full((trees, nodes, width), -np.inf)
        for batch in batches:
            values = _matrix(batch.column("x"))
            for t in range(trees):
                rows, node = _level_nodes(values, feature[t], cut[t], level)
                if not len(rows):
                    continue
                order = np.argsort(node.astype(np.int16), kind="stable")
                found, starts, n = np.unique(node[order], return_index=True, return_counts=True)
                own = values[rows[order]]
                count[t, found] += n
                low[t, found] = np.minimum(low[t, found], np.minimum.reduceat(own, starts, axis=0))
                high[t, found] = np.maximum(high[t, found], np.maximum.reduceat(own, starts, axis=0))
        tree, node = np.nonzero(count)
        columns = [tree, node, count[tree, node], *low[tree, node].T, *high[tree, node].T]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in columns], ["tree", "node", "n", *lows, *highs]
        )

    kinds = ", ".join(["tree long, node long, n long", *[f"{c} double" for c in (*lows, *highs)]])
    partial = x.mapInArrow(ranged, kinds).groupBy("tree", "node")
    found = partial.agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs]
    ).toPandas()
    at = found["tree"].to_numpy(), found["node"].to_numpy()
    count, low, high = np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes, width)), np.zeros((trees, nodes, width))
    count[at], low[at], high[at] = found["n"], found[lows], found[highs]
    return count, low, high


def grow_forest(x: DataFrame, width: int, trees: int = 100, levels: int = 8, seed: int = 11) -> Forest:
    """Grow ``trees`` trees on all rows of ``x`` (a column x of ``width`` numbers), level by level.

    One pass for each level takes the rows and the range of every node over the whole table, so a cut
    is drawn from the range of all rows that reach it and a leaf stands for all rows in it. Only these
    bounded tables reach the driver. The same rows, however dealt, grow the same forest.
    """
    size = 2 ** (levels + 1) - 1
    feature, cut, depth = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
    total = 0
    for level in range(levels + 1):
        count, low, high = _level_table(x, feature, cut, level, width)
        total = int(count[0].sum()) if level == 0 else total
        can_open = (high > low) & (count > 1)[..., None] & (level < levels)
        choices = can_open.sum(-1)
        pick, share = np.random.default_rng([seed, level]).random((2, *count.shape))
        nth = np.minimum((pick * choices).astype(int), choices - 1)
        chosen = np.argmax(np.cumsum(can_open, -1) == nth[..., None] + 1, axis=-1)[..., None]
        least, most = (np.take_along_axis(v, chosen, -1)[..., 0] for v in (low, high))
        at = least + share * (most - least)
        at = np.where(at <= least, most, at)
        own, inner = slice(2**level - 1, 2 ** (level + 1) - 1), choices > 0
        feature[:, own] = np.where(inner, chosen[..., 0], -1)
        cut[:, own] = np.where(inner, at, 0.0)
        depth[:, own] = np.where(inner | (count == 0), 0.0, level + _expected_path(count))
        if not inner.any():
            break
    return Forest(feature, cut, depth, float(_expected_path(max(total, 2))))


def _calibrated(scored: DataFrame) -> float:
    """``calibrate`` on a table of label and anomaly, by running sums over its distinct values."""
    found = scored.groupBy("anomaly").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    counts = settle(found, "anomalies")
    good, bad = counts.agg(F.sum("good"), F.sum("bad")).first()
    if not good or not bad:
        return 1.0
    sums = {"kept_good": F.col("good"), "kept_bad": F.col("bad")}
    seen = running_sums(add_range(counts, "anomaly"), [], F.col("_range"), ["anomaly"], sums)
    gain = 2 * (F.col("kept_good") / float(good)) - F.col("kept_bad") / float(bad)
    at = -seen.agg(F.max(F.struct(gain.alias("gain"), (-F.col("anomaly")).alias("least")))).first()[0]["least"]
    above = counts.filter(F.col("anomaly") > at).agg(F.min("anomaly")).first()[0]
    return (at + (at if above is None else above)) / 2


def _fitted(rows: DataFrame, labels: DataFrame, **settings) -> Forest:
    """The forest of measured rows that pass the base rule, with its threshold."""
    passed = rows.filter(~F.col("base_failed")).select("doc_id", "x")
    forest = grow_forest(passed.select("x"), len(RULES), **settings)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anomaly = pa.array(forest.anomaly(_matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([batch.column("label"), anomaly], ["label", "anomaly"])

    known = labelled_rows(passed, labels, "quality", id_remainder(3) != 1, "x").select("label", "x")
    forest.threshold = _calibrated(known.mapInArrow(scored, "label int, anomaly double"))
    return forest


def _judged(rows: DataFrame, forest: Forest) -> DataFrame:
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False)
            kept = ~failed & (forest.anomaly(_matrix(batch.column("x"))) <= forest.threshold)
            yield batch.drop_columns(["x"]).append_column("kept", pa.array(kept))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "x"]
    return rows.mapInArrow(judged, ", ".join([*kinds, "kept boolean"]))


def fit_rules(docs: DataFrame, labels: DataFrame, **settings) -> Forest:
    """Grow the forest and set its threshold.

    The forest is grown on all documents, labelled or not; the threshold is the best over all rows with
    a quality label, of ids whose crc32 modulo 3 is not 1. Both look only at rows that pass the base rule.
    """
    return _fitted(settle(measured_rows(docs), "measured"), labels, **settings)


def apply_rules(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document, null text as empty.

    ``kept`` is false where the base rule fails, else where the forest calls the row odd.
    """
    return _judged(measured_rows(docs), forest)


def rules_digest(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Fit on the documents and judge them all; null and repeated ids are rows like others."""
    rows = settle(measured_rows(docs), "measured")
    return _judged(rows, _fitted(rows, labels, **settings))
