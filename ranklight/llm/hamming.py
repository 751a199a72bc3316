"""Links between fingerprints at a small Hamming distance, by the general pigeonhole principle.

If thresholds t_i over disjoint parts of the bits satisfy sum(t_i + 1) = radius + 1, then two
fingerprints within the radius differ in t_i bits or fewer in some part i; a part with
threshold -1 is not looked at. Bits that vary together share a part, and a dynamic program finds the
thresholds of least estimated work. For wide fingerprints and a large radius, where no thresholds that
guarantee every pair leave anything out, the same program takes parts that may share bits and asks
for a chance to find a pair instead of a guarantee.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.text_stats import mix

Parts = list[tuple[list[int], int]]

#: Work of one row dealt out and sorted, in compared pairs.
_ROW_WORK = 300.0
_SMALL_RUN = 8
_MATRIX_RUN = 768
_HEAVY_RUN = 8192
#: How finely the gain of a part is counted, and how many parts there may be.
_UNITS = 2_000
_MOST_PARTS = 2_000


def _unpacked(values: np.ndarray) -> np.ndarray:
    """Bits of each row of 64-bit words, the lowest of the first word first."""
    shifts = np.arange(64, dtype=np.uint64)
    bits = (values[:, :, None] >> shifts) & np.uint64(1)
    return bits.reshape(len(values), -1).astype(np.float32)


def _words(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """The words of a batch's fingerprints, one row each."""
    return np.column_stack([batch.column(c).to_numpy().view(np.uint64) for c in columns])


def bit_statistics(fingerprints: DataFrame, columns: list[str]) -> tuple[int, np.ndarray]:
    """How many fingerprints, and how many have bits i and j both set, over all of them."""
    width = 64 * len(columns)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), 0
        for batch in batches:
            x = _unpacked(_words(batch, columns))
            total += x.T @ x
            rows += len(x)
        values = [rows, *total.astype(np.int64).ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.int64()))], ["v"])

    partial = fingerprints.select(*columns).mapInArrow(counted, "v array<long>")
    summed = partial.select(F.posexplode("v").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))
    rows = summed.toPandas()  # one row for each two bits, whatever the input
    found = np.zeros(1 + width * width)
    found[rows["k"].to_numpy(int)] = rows["v"]
    return int(found[0]), found[1:].reshape(width, width)


def correlated_parts(n: int, both: np.ndarray, parts: int, first: np.ndarray | None = None) -> list[list[int]]:
    """Deal the bits to parts of nearly equal width; each takes the bits it varies with most.

    ``first`` gives the order in which bits open a part; without it, the most even bits do.
    """
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    link = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    turn = np.argsort(np.abs(p - 0.5), kind="stable") if first is None else first
    if first is not None:
        # Another dealing: the bits vary with each other by chance as well.
        link = link + np.random.default_rng(int(first[0])).random(link.shape)
    left, out = np.ones(len(p), bool), []
    for k in range(parts):
        width = (len(p) - sum(map(len, out))) // (parts - k)
        own = [int(turn[left[turn]][0])]
        left[own[0]] = False
        drawn = link[own[0]].copy()
        while len(own) < width:
            best = int(np.argmax(np.where(left, drawn, -1.0)))
            own.append(best)
            left[best] = False
            drawn += link[best]
        out.append(sorted(own))
    return out


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0, 1, ..., ``most`` of the bits differ, one chance for each bit."""
    exact = np.zeros(most + 1)
    exact[0] = 1.0
    for q in differ:
        exact[1:] = exact[1:] * (1 - q) + exact[:-1] * q
        exact[0] *= 1 - q
    return np.cumsum(exact)


def _costs(n: int, differ: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Estimated work of a part at thresholds 0 to ``most``: candidate pairs and rows dealt."""
    pairs = float(n) * n * _within(differ[bits], most)
    rows = [n * sum(comb(len(bits), k) for k in range(t + 1)) for t in range(most + 1)]
    return [float(c + _ROW_WORK * r) for c, r in zip(pairs, rows)]


def allocate(costs: list[list[float]], gains: list[list[int]], needed: int) -> tuple[float, list[int]]:
    """Thresholds whose gains reach ``needed`` at least cost; -1 costs and gains nothing."""
    best = np.full(needed + 1, np.inf)
    best[0] = 0.0
    steps = []
    for own, gain in zip(costs, gains):
        following, chosen, source = best.copy(), np.full(needed + 1, -1), np.arange(needed + 1)
        for t, (cost, step) in enumerate(zip(own, gain)):
            step = min(step, needed)
            value = np.full(needed + 1, np.inf)
            value[step:] = best[: needed + 1 - step] + cost
            where = np.arange(needed + 1) - step
            # What is beyond the need counts as the need.
            where[needed] = needed - step + int(np.argmin(best[needed - step :]))
            value[needed] = best[where[needed]] + cost
            better = value < following
            following[better], chosen[better], source[better] = value[better], t, where[better]
        best = following
        steps.append((chosen, source))
    if not np.isfinite(best[needed]):
        return float("inf"), []
    at, out = needed, []
    for chosen, source in reversed(steps):
        out.append(int(chosen[at]))
        at = int(source[at])
    return float(best[needed]), out[::-1]


def sure_parts(n: int, both: np.ndarray, radius: int, most: int = 2) -> Parts:
    """Parts and thresholds that find every pair within the radius, for the least work."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    choices = []
    for parts in range(2, radius + 2):
        dealt = correlated_parts(n, both, parts)
        costs = [_costs(n, differ, bits, most) for bits in dealt]
        gains = [[t + 1 for t in range(most + 1)]] * len(dealt)
        cost, thresholds = allocate(costs, gains, radius + 1)
        choices.append((cost, [(b, t) for b, t in zip(dealt, thresholds) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


def meeting_chance(parts: Parts, bits: int, differing: int, trials: int = 10_000) -> float:
    """The chance that two fingerprints of ``bits`` bits, ``differing`` of which differ, meet in
    some part; drawn, as parts that share bits do not find pairs independently."""
    draw = np.random.default_rng(7)
    member = np.zeros((bits, len(parts)), np.float32)
    for k, (own, _) in enumerate(parts):
        member[own, k] = 1.0
    thresholds = np.array([t for _, t in parts], np.float32)
    met = 0
    for _ in range(trials // 1000):
        order = draw.random((1000, bits)).argpartition(differing - 1, axis=1)[:, :differing]
        flipped = np.zeros((1000, bits), np.float32)
        np.put_along_axis(flipped, order, 1.0, axis=1)
        met += int(((flipped @ member) <= thresholds).any(1).sum())
    return met / (trials // 1000 * 1000)


def likely_parts(n: int, both: np.ndarray, share: float, recall: float = 0.999, most: int = 1) -> Parts:
    """Parts and thresholds that find a pair with a ``share`` of differing bits with chance
    ``recall``, for the least work; several dealings of the bits give parts enough.

    Parts that share bits find less than independent ones would; what is asked of the program is raised
    until the drawn chance is ``recall``.
    """
    differing = max(1, ceil(share * len(both) - 1e-9))
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    unit = -log(1 - recall) / _UNITS
    choices: list[tuple[float, Parts]] = []
    for width in range(8, 33, 2):
        found = _within(np.full(width, share), most)
        enough = ceil(-log(1 - recall) / -log(1 - found[0]) * 2) + 2
        if enough > _MOST_PARTS:
            break
        dealt: list[list[int]] = []
        while len(dealt) < enough:
            order = None if not dealt else np.random.default_rng(len(dealt)).permutation(len(p))
            dealt += [b for b in correlated_parts(n, both, len(p) // width, order)]
        costs = [_costs(n, differ, bits, most) for bits in dealt]
        gains = [[int(-log(1 - f) / unit) for f in _within(np.full(len(b), share), most)] for b in dealt]
        for raised in (1.0, 1.1, 1.2, 1.35, 1.5, 1.75, 2.0):
            cost, thresholds = allocate(costs, gains, int(_UNITS * raised))
            if choices and cost >= min(choices, key=lambda c: c[0])[0]:
                break
            parts = [(b, t) for b, t in zip(dealt, thresholds) if t >= 0]
            if parts and meeting_chance(parts, len(p), differing) >= recall:
                choices.append((cost, parts))
                break
    return min(choices, key=lambda c: c[0])[1]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int32)


def _linked(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of one run: each row to the row it was reached from."""
    waiting = np.arange(len(fps))
    if len(fps) <= _MATRIX_RUN:
        near = _distance(fps[:, None], fps[None, :]) <= radius
        waiting = np.flatnonzero(near.sum(1) > 1)
    child, parent = [np.zeros(0, int)], [np.zeros(0, int)]
    while len(waiting):
        front, waiting = waiting[:1], waiting[1:]
        while len(front) and len(waiting):
            block, front = front[:128], front[128:]
            near = np.zeros((len(block), len(waiting)), bool)
            for start in range(0, len(waiting), 4096):
                part = waiting[start : start + 4096]
                near[:, start : start + 4096] = _distance(fps[block][:, None], fps[part][None, :]) <= radius
            hit = near.any(0)
            if hit.any():
                child.append(waiting[hit])
                parent.append(block[near[:, hit].argmax(0)])
                front = np.concatenate([front, waiting[hit]])
                waiting = waiting[~hit]
    return np.concatenate(child), np.concatenate(parent)


def run_links(
    keys: np.ndarray, nodes: np.ndarray, fps: np.ndarray, index: np.ndarray, radius: int
) -> np.ndarray:
    """Links of nodes (two columns) among rows with equal keys; rows are sorted by key.

    A run without an indexed row holds probes alone and has no link of its own.
    """
    out = [np.zeros((0, 2), np.int64)]
    if not len(keys):
        return out[0]
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[cuts, len(keys)])
    indexed = np.logical_or.reduceat(index, cuts)
    cuts, lengths = cuts[indexed], lengths[indexed]
    for size in range(2, _SMALL_RUN + 1):
        starts = cuts[lengths == size]
        for i, j in combinations(range(size), 2):
            near = _distance(fps[starts + i], fps[starts + j]) <= radius
            out.append(np.column_stack([nodes[starts[near] + i], nodes[starts[near] + j]]))
    for start, size in zip(cuts[lengths > _SMALL_RUN], lengths[lengths > _SMALL_RUN]):
        child, parent = _linked(fps[start : start + size], radius)
        out.append(np.column_stack([nodes[start + child], nodes[start + parent]]))
    return np.concatenate(out)


def run_pairs(
    keys: np.ndarray,
    nodes: np.ndarray,
    fps: np.ndarray,
    index: np.ndarray,
    apart: np.ndarray,
    radius: int,
    allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> Iterator[np.ndarray]:
    """All pairs of nodes among rows with equal keys whose ``apart`` differs, in blocks.

    ``allowed`` says of the places of two rows each which pairs are to be returned.
    """
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    for start, end in zip(cuts, np.r_[cuts[1:], len(keys)]):
        if not index[start:end].any() or (apart[start:end] == apart[start]).all():
            continue
        for low in range(start, end, 128):
            high = min(low + 128, end)
            for first in range(low, end, 1024):
                last = min(first + 1024, end)
                near = _distance(fps[low:high, None], fps[None, first:last]) <= radius
                near &= apart[low:high, None] != apart[None, first:last]
                i, j = np.nonzero(near)
                once = low + i < first + j
                one, other = low + i[once], first + j[once]
                stay = allowed(one, other)
                if stay.any():
                    yield np.column_stack([nodes[one[stay]], nodes[other[stay]]])


def hamming_links(
    fingerprints: DataFrame,
    columns: list[str],
    radius: int,
    parts: Parts,
    apart: str | None = None,
    least_hubs: bool = False,
    bounds: Sequence[str] = (),
    similarity: float = 0.0,
) -> DataFrame:
    """Links a, b of ``node`` values whose fingerprints are within ``radius`` of each other.

    Needs a long ``node`` that is distinct for each distinct fingerprint, whose 64-bit words are in
    ``columns``. A chain of links joins two nodes where a chain of pairs that share a part
    does; of a dense group only a spanning part is returned, so there are fewer than four links
    for each row dealt out. Keys with very many rows are cut into chunks, and every two
    chunks meet in a task of their own. With ``apart``, a long column, all pairs that share a part
    and differ in that column are returned instead, each in the first part that it shares (under a key
    with very many rows more often). ``bounds`` then names the columns of ``difference_bounds``, and a
    pair that cannot reach ``similarity`` by them is left out where it is met. With ``least_hubs``
    the spanning part grows from the smallest node of a group, so that most parts return the same links.
    """
    masks = np.array(
        [[sum(1 << (b - 64 * w) for b in bits if b // 64 == w) for w in range(len(columns))] for bits, _ in parts],
        np.uint64,
    )
    carried = ["node", *columns, *([apart, *bounds] if apart else [])]
    names = ["key", *carried, "indexed", *(["part"] if apart else [])]
    thresholds = np.array([t for _, t in parts])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(batch, columns)
            rest = [batch.column(c) for c in carried]
            for number, (bits, threshold) in enumerate(parts):
                for k in range(threshold + 1):
                    for flipped in combinations(bits, k):
                        key = np.full(len(words), number + 1, np.uint64)
                        for w in range(len(columns)):
                            turned = sum(1 << (b - 64 * w) for b in flipped if b // 64 == w)
                            key = mix(key) ^ ((words[:, w] & masks[number, w]) ^ np.uint64(turned))
                        own = pa.array(mix(key).view(np.int64))
                        indexed = pa.array(np.full(len(words), k == 0))
                        part = [pa.array(np.full(len(words), number, np.int32))] if apart else []
                        yield pa.RecordBatch.from_arrays([own, *rest, indexed, *part], names)

    def first_met(rows: list[np.ndarray]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        _, nodes, fps, index, _, part, bound = rows

        def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            # A pair counts under the own key of one of the two: of the smaller node, unless they agree.
            stay = (index[i] & (index[j] | (nodes[i] < nodes[j]))) | (index[j] & (nodes[j] < nodes[i]))
            if bounds:
                least = _distance(bound[i, 1:], bound[j, 1:])
                most = (bound[i, 0] + bound[j, 0]).astype(float) * (1 - similarity) / (1 + similarity)
                stay &= least <= most + 1e-9
            at = np.flatnonzero(stay)
            differing = fps[i[at]] ^ fps[j[at]]
            for number in range(len(masks)):
                if not len(at):
                    break
                met = np.bitwise_count(differing & masks[number]).sum(1) <= thresholds[number]
                stay[at[met & (part[i[at]] > number)]] = False
                at, differing = at[~met], differing[~met]
            return stay

        return allowed

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def done(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for found in run_pairs(*rows[:5], radius, first_met(rows)) if apart else [run_links(*rows, radius)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"]
                )

        for batch in batches:
            rows = [
                batch.column("key").to_numpy(),
                batch.column("node").to_numpy(),
                _words(batch, columns),
                batch.column("indexed").to_numpy(zero_copy_only=False),
            ]
            if apart:
                rows += [batch.column(apart).to_numpy(), batch.column("part").to_numpy()]
                rows.append(_words(batch, bounds) if bounds else np.zeros((batch.num_rows, 0), np.uint64))
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows)]
            if not len(rows[0]):
                continue
            # The last key may go on in the next batch.
            cut = int(np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])[-1])
            yield from done([x[:cut] for x in rows])
            rest = [x[cut:] for x in rows]
        if rest is not None:
            yield from done(rest)

    kinds = ", ".join(f"{c} long" for c in ["key", *carried])
    kinds += ", indexed boolean" + (", part int" if apart else "")
    rows = fingerprints.select(*carried).mapInArrow(dealt, kinds)
    order = ["node"] if least_hubs else []
    heavy = (
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > _HEAVY_RUN)
        .select("key", F.ceil(F.col("n") * 2 / _HEAVY_RUN).cast("int").alias("chunks"))
    )
    marked = rows.join(heavy, "key", "left")
    light = marked.filter("chunks IS NULL").select(*names)
    cells = (
        marked.filter("chunks IS NOT NULL")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("indexed", F.lit(True))
        .select(*names)
    )
    found = [
        x.repartition("key").sortWithinPartitions("key", *order).mapInArrow(linked, "a long, b long")
        for x in (light, cells)
    ]
    return found[0].unionByName(found[1])
