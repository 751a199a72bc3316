"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklight.llm.common import fresh, lower_ascii, pieces, row_key, texts_of
from ranklight.llm.components import connected_components
from ranklight.llm.hamming import Parts, bit_statistics, hamming_links, likely_parts, sure_parts
from ranklight.llm.text_stats import mix
from ranklight.session import settle

_SEED = 42


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, _SEED)], np.uint64)
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], _SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    return np.array(found, np.uint64)


def simhash(hashes: np.ndarray, words: int = 1) -> list[int]:
    """Words of 64 bits that are set in over half the hashes; 0 without any.

    Each word after the first takes the hashes spread once more.
    """
    out = []
    for _ in range(words):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        majority = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
        out.append(int(np.packbits(majority, bitorder="little").view("<i8")[0]))
        hashes = mix(hashes)
    return out


def fingerprints(docs: DataFrame, width: int, words: int = 1, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keys`` of each document and the words fp0, fp1, ... of its fingerprint, as longs."""
    columns = [f"fp{k}" for k in range(words)]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            found = [simhash(shingle_hashes(t, width), words) for t in texts_of(batch.column("text"))]
            out = batch.drop_columns(["text"])
            for name, values in zip(columns, zip(*found)):
                out = out.append_column(name, pa.array(values, pa.int64()))
            yield out

    frame = docs.select(*keys, "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in frame.schema if f.name != "text"]
    return frame.mapInArrow(hashed, ", ".join(kinds + [f"{c} long" for c in columns]))


def _planned(nodes: DataFrame, columns: list[str], radius: int, share: float | None) -> Parts:
    n, both = bit_statistics(nodes, columns)
    return sure_parts(n, both, radius) if share is None else likely_parts(n, both, share)


def fingerprint_components(
    found: DataFrame, words: int, radius: int, share: float | None = None
) -> DataFrame:
    """``node`` and ``component_id``, the smallest doc_id reachable, of each distinct fingerprint.

    Copies share a fingerprint, so they are one node whose row count does not matter. ``share``
    asks for likely instead of sure parts (see ``hamming``).
    """
    columns = [f"fp{k}" for k in range(words)]
    nodes = settle(found.groupBy("node", *columns).agg(F.min("doc_id").alias("first_id")), "nodes")
    links = hamming_links(nodes, columns, radius, _planned(nodes, columns, radius, share))
    roots = connected_components(links).withColumnRenamed("node", "linked")
    rooted = nodes.join(roots, F.col("node") == F.col("linked"), "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("node", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    All fingerprints within ``radius`` bits link. Documents without words have fingerprint zero and
    link like others. Null ids never become a component's id unless there is no other;
    repeated ids are rows like others.
    """
    found = settle(fingerprints(docs, width).withColumn("node", F.col("fp0")), "fingerprints")
    components = fingerprint_components(found, 1, radius).withColumnRenamed("node", "place")
    return found.join(components, F.col("node") == F.col("place")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def differing_share(similarity: float) -> float:
    """The expected share of differing bits of two texts whose shingles have this similarity.

    Sets of similarity s have the cosine 2s / (1 + s); a bit differs with the angle over pi.
    """
    return acos(2 * similarity / (1 + similarity)) / pi


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """All columns but the text, and ``shingles``: its distinct shingle hashes, sorted, 8 bytes each."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 8 << 20):
            sets = [np.unique(shingle_hashes(t, width)).tobytes() for t in texts_of(batch.column("text"))]
            yield batch.drop_columns(["text"]).append_column("shingles", pa.array(sets, pa.binary()))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return docs.mapInArrow(hashed, ", ".join([*kinds, "shingles binary"]))


#: Words of the parities that ``difference_bounds`` takes: exact enough for texts of some hundred shingles.
_PARITY = 8


def difference_bounds(sets: DataFrame) -> DataFrame:
    """node, ``size`` (distinct shingles) and the longs q0, q1, ...: the parity of the count of each cell.

    Shingles are hashed to cells. Where the parities of two texts differ, one of them has a shingle that
    the other lacks, so they differ in at least as many shingles as bits: a proof, never a guess, that
    a pair is below a similarity. Its worth falls with the length of the texts.
    """
    columns = [f"q{k}" for k in range(_PARITY)]

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, words = [], []
            for held in batch.column("shingles").to_pylist():
                hashes = np.frombuffer(held, np.uint64)
                cells = (mix(hashes) % np.uint64(64 * _PARITY)).astype(np.int64)
                odd = np.bincount(cells, minlength=64 * _PARITY) & 1
                sizes.append(len(hashes))
                words.append(np.packbits(odd.astype(bool), bitorder="little").view("<i8"))
            table = np.array(words, np.int64).reshape(-1, _PARITY)
            arrays = [pa.array(table[:, k].copy()) for k in range(_PARITY)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sizes, pa.int64()), *arrays], ["node", "size", *columns]
            )

    kinds = ", ".join(f"{c} long" for c in ["node", "size", *columns])
    return sets.select("node", "shingles").mapInArrow(folded, kinds)


def sets_of_ends(links: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """node and ``shingles`` of every node at the end of a link.

    ``texts`` has node, its _row (see ``row_key``) and text; of each linked node the text of one row is
    taken, so copies do not travel.
    """
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    one = texts.select("node", "_row").groupBy("node").agg(F.min("_row").alias("_row")).join(ends, "node", "left_semi")
    single = texts.select("_row", "text").join(one, "_row").dropDuplicates(["_row"])
    return shingle_sets(single.select("node", "text"), width)


def verified_links(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b and ``alike`` of every link: whether the shared over all distinct shingles reach ``similarity``.

    ``sets`` has the shingles of all ends. A link moves the shingles of its two ends.
    """
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)):
            alike = []
            for s, t in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist()):
                least, most = sorted((len(s), len(t)))
                if least < similarity * most - 1e-9:
                    alike.append(False)
                    continue
                both = np.concatenate([np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                alike.append(shared >= similarity * (len(both) - shared) - 1e-9)
            yield batch.select(["a", "b"]).append_column("alike", pa.array(alike, pa.bool_()))

    met = links.join(left, "a").join(right, "b").select("a", "b", "s", "t")
    return met.mapInArrow(compared, "a long, b long, alike boolean")


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_roots(nodes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``nodes`` and the root of each as ``name``; a node without links is its own."""
    found = roots.select(F.col("node").alias("_linked"), F.col("root").alias(name))
    joined = nodes.join(found, F.col("node") == F.col("_linked"), "left").drop("_linked")
    return joined.withColumn(name, F.coalesce(name, "node"))


def similar_components(
    found: DataFrame, texts: DataFrame, words: int, radius: int, width: int, similarity: float
) -> DataFrame:
    """``node`` and ``root``: components of the links within ``radius`` that the shingles confirm.

    A dense group first proposes links that span it. Where the shingles refuse one, all pairs within
    the radius whose ends are not yet together are proposed as well, so a pair is not lost because
    the links around it failed; only pairs whose shingles provably differ in too many are refused
    at once (``difference_bounds``). Groups that hold together by their spanning links need no more.
    """
    columns = [f"fp{k}" for k in range(words)]
    nodes = settle(found.select("node", *columns).dropDuplicates(["node"]), "nodes")
    parts = _planned(nodes, columns, radius, radius / (64 * words))
    spanning = hamming_links(nodes, columns, radius, parts, least_hubs=True)
    links = settle(_ordered(spanning), "candidates")
    sets = settle(sets_of_ends(links, texts, width), "shingles")
    judged = settle(verified_links(links, sets, similarity), "judged")
    together = connected_components(judged.filter("alike").select("a", "b"))
    placed = settle(_with_roots(nodes, together, "apart"), "placed")
    # Components at the ends of refused links; any other pair within the radius is already together.
    torn = _between(judged.filter("NOT alike"), placed)
    edges = torn.select(F.col("apart_a").alias("apart")).union(torn.select("apart_b")).distinct()
    # Every node of such a component is the end of a link, so its shingles are there.
    opened = settle(placed.join(edges, "apart", "left_semi").join(difference_bounds(sets), "node"), "open")
    bounds = ["size", *[f"q{k}" for k in range(_PARITY)]]
    rest = _ordered(hamming_links(opened, columns, radius, parts, "apart", bounds=bounds, similarity=similarity))
    rest = settle(rest.join(judged.select("a", "b"), ["a", "b"], "left_anti"), "candidates")
    more = verified_links(rest, sets, similarity).filter("alike")
    # The components found so far are the nodes of what is left to join.
    joined = connected_components(_between(more, placed).select(F.col("apart_a").alias("a"), F.col("apart_b").alias("b")))
    last = joined.select(F.col("node").alias("_apart"), F.col("root").alias("_root"))
    rooted = placed.join(last, F.col("apart") == F.col("_apart"), "left")
    return rooted.select("node", F.coalesce("_root", "apart").alias("root"))


def _between(links: DataFrame, placed: DataFrame) -> DataFrame:
    """The distinct pairs of different components, ``apart_a`` and ``apart_b``, that links lie between."""
    at_a = placed.select(F.col("node").alias("a"), F.col("apart").alias("apart_a"))
    at_b = placed.select(F.col("node").alias("b"), F.col("apart").alias("apart_b"))
    ends = links.select("a", "b").join(at_a, "a").join(at_b, "b").filter("apart_a <> apart_b")
    return ends.select("apart_a", "apart_b").distinct()


def keep_one_per_group(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, words: int = 4
) -> DataFrame:
    """The documents, all columns, without those whose group has a smaller doc_id.

    Texts link where the distinct ``width``-word shingles they share are at least ``similarity`` of all
    they have; texts without words are alike. Pairs are proposed by fingerprints of ``words`` times 64
    bits that differ in no more bits than expected at ``similarity``, and 1.6 standard deviations (95 of
    100 pairs at the bound itself, nearly all above it); every link is then checked exactly. Of a group
    without ids, or of several rows with the smallest id, one row stays.
    """
    share, bits = differing_share(similarity), 64 * words
    radius = int(bits * share + 1.6 * sqrt(bits * share * (1 - share)))
    columns = [f"fp{k}" for k in range(words)]
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, row_key())
    narrow = docs.select("doc_id", "text", row_key().alias("_row"), _sequence_key().alias("node"))
    found = settle(fingerprints(narrow, width, words, ("doc_id", "_row", "node")), "fingerprints")
    components = similar_components(
        found.select("node", *columns), narrow.select("node", "_row", "text"), words, radius, width, similarity
    ).withColumnRenamed("node", "place")
    placed = found.join(components, F.col("node") == F.col("place"))
    # One row for each component by a partial minimum; a large group is never gathered.
    kept = placed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_kept")
    )
    number, place = fresh(docs, "_n"), fresh(docs, "_kept")
    rows = keyed.join(kept.select(F.col("_kept").alias(place)), F.col(row) == F.col(place))
    own = W.partitionBy(row).orderBy(F.lit(1))
    numbered = rows.withColumn(number, F.row_number().over(own)).filter(F.col(number) == 1)
    return numbered.select(*[f"`{c}`" for c in docs.columns])


def _sequence_key() -> Column:
    """A long that texts of the same words share."""
    words = F.trim(F.regexp_replace(lower_ascii(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+", " "))
    return F.xxhash64(words)
