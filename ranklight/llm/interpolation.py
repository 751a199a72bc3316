"""Language-model scores by deleted interpolation of n-gram estimates.

Documents are encoded once into chunks of word numbers. Each chunk asks for the counts of its distinct
n-grams: the questions are dealt by n-gram to buckets, which add them up and send back the
totals, so what is shuffled are distinct n-grams of chunks and never a table of all
n-grams per document. Mixture weights come from expectation-maximisation on training documents
whose own counts are deleted, one set of weights for each range of context counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import bucketed, id_remainder, parts_for, pieces, text_bytes, texts_of
from ranklight.llm.text_stats import mix
from ranklight.session import settle

END = b"\n"  # no word contains white space, so these two cannot be words
START = b"\r"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEPS = 24  # ranges of context counts per order: powers of two
_FLOOR = 1e-6


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, the high ones, mostly zero, left out or easy to compress."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    width = blob[0]
    body = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, :width] = body.T
    return out.view("<u8").ravel().astype(np.uint64)


def _deltas(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=np.uint64(0))


def encode_chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of texts of about ``chunk_bytes``; texts are never cut.

    ``docs`` has doc_id, text, training and held (training documents of which
    the weights are learned). A chunk holds either such documents alone or none.
    """
    names = ["chunk", "held", "ids", "training", "lengths", "words", "tokens"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        waiting: dict[bool, list[pa.RecordBatch]] = {True: [], False: []}
        sizes = {True: 0, False: 0}

        def chunk(held: bool) -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(waiting[held]).combine_chunks()
            waiting[held], sizes[held] = [], 0
            seen: dict[bytes, int] = {END: 0}
            found, lengths = [], []
            for text in texts_of(rows.column("text").combine_chunks()):
                words = text.lower().split()
                found.append(
                    np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
                )
                found.append(np.zeros(1, np.int64))
                lengths.append(len(words) + 1)
            tokens = np.concatenate(found)
            # Frequent words get small numbers, whose high byte planes are zero.
            order = np.argsort(-np.bincount(tokens, minlength=len(seen)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)[order]
            number += 1
            values = [
                [(TaskContext.get().partitionId() << 24) + number],
                [held],
                [rows.column("doc_id").to_pylist()],
                [rows.column("training").to_pylist()],
                [lengths],
                [hashes.tobytes()],
                [zlib.compress(planes(rank[tokens]), 1)],
            ]
            types = [
                pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.bool_()),
                pa.list_(pa.int64()), pa.binary(), pa.binary(),
            ]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

        for batch in pieces(batches, "text", max(1, chunk_bytes // 8)):
            for held in (True, False):
                own = batch.filter(batch.column("held") if held else pc.invert(batch.column("held")))
                size = sum(map(len, texts_of(own.column("text")))) + own.num_rows
                if sizes[held] and sizes[held] + size > chunk_bytes:
                    yield chunk(held)
                if own.num_rows:
                    waiting[held].append(own)
                    sizes[held] += size
        for held in (True, False):
            if waiting[held]:
                yield chunk(held)

    return docs.mapInArrow(
        encoded,
        "chunk long, held boolean, ids array<string>, training array<boolean>, "
        "lengths array<long>, words binary, tokens binary",
    )


class Chunk:
    """A decoded chunk with the n-gram keys of every token."""

    def __init__(self, words: bytes, tokens: bytes, lengths: list[int], order: int, bits: int):
        hashes = np.frombuffer(words, np.uint64)
        self.lengths = np.asarray(lengths, np.int64)
        self.token = from_planes(zlib.decompress(tokens)).astype(np.int64)
        self.hashes, self.order = hashes, order
        self.first = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(self.token)) - np.repeat(self.first, self.lengths)
        start = np.uint64(xxhash.xxh64_intdigest(START))
        own = hashes[self.token]
        self.place = place
        grams = []
        mask = np.uint64(2**bits - 1)
        for size in range(2, order + 1):
            key = np.full(len(own), size, np.uint64)
            for back in range(size - 1, -1, -1):
                shifted = np.full(len(own), start)
                shifted[back:] = own[: len(own) - back]
                key = key * _MULTIPLIER + mix(np.where(place >= back, shifted, start))
            grams.append(mix(key) & mask)
        joined = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.keys, self.inverse = np.unique(joined, return_inverse=True)
        # Words in hash order, as the buckets answer them.
        self.word_order = np.argsort(hashes, kind="stable")

    def counts(self, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the training documents have each word (in hash order) and each key."""
        used = np.repeat(training, self.lengths)
        words = np.bincount(self.token[used], minlength=len(self.hashes))[self.word_order]
        grams = np.bincount(self.inverse[np.tile(used, self.order - 1)], minlength=len(self.keys))
        return words, grams

    def by_token(self, words: np.ndarray, grams: np.ndarray) -> list[np.ndarray]:
        """Counts of the word, the bigram, ... that end at each token."""
        single = np.empty(len(words))
        single[self.word_order] = words
        n = len(self.token)
        found = grams[self.inverse].astype(float)
        return [single[self.token], *[found[k * n : (k + 1) * n] for k in range(self.order - 1)]]

    def estimates(
        self, counts: list[np.ndarray], n_tokens: float, n_words: float, n_docs: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each order (0: uniform) and the range of the longest seen context."""
        n = len(self.token)
        p = np.zeros((self.order + 1, n))
        p[0] = 1.0 / (n_words + 1)
        p[1] = counts[0] / n_tokens if n_tokens else 0.0
        ranges = np.zeros(n, np.int64)
        for size in range(2, self.order + 1):
            context = np.empty(n)
            context[1:] = counts[size - 2][:-1]
            context[self.first] = n_docs
            seen = context > 0
            p[size][seen] = np.minimum(counts[size - 1][seen] / context[seen], 1.0)
            step = np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64), _STEPS - 1)
            ranges[seen] = (size - 1) * _STEPS + step[seen]
        return p, ranges


def _questions(chunks: DataFrame, order: int, bits: int, buckets: int) -> DataFrame:
    """(bucket, chunk, held, words?, keys, counts): what each chunk has of each bucket's n-grams."""
    names = ["bucket", "chunk", "held", "single", "keys", "counts"]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Chunk(row["words"], row["tokens"], row["lengths"], order, bits)
                words, grams = own.counts(np.asarray(row["training"], bool))
                for single, keys, counts, width in (
                    (True, own.hashes[own.word_order], words, 64),
                    (False, own.keys, grams, bits),
                ):
                    cuts = _cuts(keys, width, buckets)
                    parts = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                    blobs = [planes(_deltas(keys[cuts[b] : cuts[b + 1]])) for b in parts]
                    numbers = [planes(counts[cuts[b] : cuts[b + 1]]) for b in parts]
                    n = len(parts)
                    columns = [
                        pa.array(parts, pa.int32()), pa.array([row["chunk"]] * n, pa.int64()),
                        pa.array([row["held"]] * n, pa.bool_()), pa.array([single] * n, pa.bool_()),
                        pa.array(blobs, pa.binary()), pa.array(numbers, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = "bucket int, chunk long, held boolean, single boolean, keys binary, counts binary"
    return chunks.select("chunk", "held", "training", "lengths", "words", "tokens").mapInArrow(asked, schema)


def _cuts(keys: np.ndarray, width: int, buckets: int) -> np.ndarray:
    """Where each bucket's range of the key space starts in the sorted keys."""
    edges = [(b << width) // buckets for b in range(1, buckets)]
    return np.r_[0, np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]


def _answered(key, own: pd.DataFrame) -> pd.DataFrame:
    """The totals of one bucket, sent to every chunk that asked, in the order of its keys.

    One more row, of chunk -1, tells how many training tokens and distinct words the bucket saw.
    """
    answers = []
    for single in (True, False):
        rows = own[own["single"] == single].sort_values("chunk")
        if not len(rows):
            continue
        keys = [np.cumsum(from_planes(k), dtype=np.uint64) for k in rows["keys"]]
        counts = np.concatenate([from_planes(c) for c in rows["counts"]]).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        held = np.repeat(rows["held"].to_numpy(bool), [len(k) for k in keys])
        # Sums of whole numbers below 2**53 are exact in doubles.
        total = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
        deleted = np.bincount(inverse[held], counts[held], len(distinct)).astype(np.int64)
        for chunk, is_held, end, own_keys in zip(rows["chunk"], rows["held"], ends, keys):
            mine = inverse[end - len(own_keys) : end]
            gone = planes(deleted[mine]) if is_held else b""
            answers.append((key[0], chunk, is_held, single, planes(total[mine]), gone, 0, 0, 0, 0))
        if single:
            kept = total - deleted
            stats = (int(total.sum()), int((total > 0).sum()), int(kept.sum()), int((kept > 0).sum()))
            answers.append((key[0], -1, False, True, b"", b"", *stats))
    return pd.DataFrame(answers, columns=_ANSWER)


_ANSWER = ["bucket", "chunk", "held", "single", "total", "deleted", "tokens", "words", "kept_tokens", "kept_words"]
_ANSWER_SCHEMA = (
    "bucket int, chunk long, held boolean, single boolean, total binary, deleted binary, "
    "tokens long, words long, kept_tokens long, kept_words long"
)


def _read_answers(rows: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.sort_values("bucket")
    out = []
    for single in (True, False):
        blobs = rows.loc[rows["single"] == single, column]
        out.append(np.concatenate([from_planes(b) for b in blobs]) if len(blobs) else np.zeros(0, np.uint64))
    return out[0].astype(np.int64), out[1].astype(np.int64)


def fit_weights(ranges: np.ndarray, p: np.ndarray, n: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Mixture weights per range of contexts by expectation-maximisation; rows sum to one.

    ``p[k]`` is what order k gives the tokens of a cell, ``n`` how many they are. Every
    range starts from, and is held a little to, the weights over all cells.
    """
    orders = len(p)
    total = np.full(orders, 1.0 / orders)
    for _ in range(rounds if len(n) else 0):
        share = total[:, None] * p
        share *= n / share.sum(0)
        total = (share.sum(1) + 0.1) / (n.sum() + 0.1 * orders)
    weights = np.tile(total, (orders * _STEPS, 1))
    for r in np.unique(ranges):
        own = ranges == r
        for _ in range(rounds):
            share = weights[r][:, None] * p[:, own]
            share *= n[own] / share.sum(0)
            weights[r] = (share.sum(1) + 10 * total) / (n[own].sum() + 10)
    # Orders above a range's longest seen context have no estimate there.
    for size in range(1, orders - 1):
        weights[size * _STEPS : (size + 1) * _STEPS, size + 2 :] = 0
    weights[:_STEPS, 2:] = 0
    weights[:, 0] = np.maximum(weights[:, 0], _FLOOR)
    return weights / weights.sum(1, keepdims=True)


def score_documents(
    docs: DataFrame,
    training: str = "training",
    order: int = 3,
    held_part: int = 10,
    chunk_bytes: int = 4 << 20,
    bucket_keys: int = 1_000_000,
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``training`` is a boolean column. A tenth (``held_part``) of the training documents, chosen by a hash of the
    id, teaches the weights, with its own counts deleted; scores use all training counts.
    Null texts are empty: one end token. Null and repeated ids are documents like others.
    Keys of words have 64 bits; keys of longer n-grams 18 bits more than the token count
    needs, 64 at most, so about one in 2**17 shares its counts with another.
    """
    held = F.col(training) & (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(held_part)) == 0)
    # Ids travel as text: lists of numbers with nulls would become floating point on the way.
    own_id = F.col("doc_id").cast("string").alias("doc_id")
    rows = docs.select(own_id, "text", F.col(training).alias("training"), held.alias("held"))
    count, bytes_ = text_bytes(docs)
    parts = parts_for(count + bytes_, chunk_bytes)
    chunks = bucketed(encode_chunks(rows, chunk_bytes), "lm-chunks", "chunk", parts)
    sized = chunks.select(
        F.size("ids").alias("n"),
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("tokens"),
        F.size(F.filter("training", lambda t: t)).alias("learned"),
        "held",
    ).agg(
        F.sum("tokens").alias("tokens"),
        F.sum("learned").alias("learned"),
        F.sum(F.when(F.col("held"), F.col("learned")).otherwise(0)).alias("held"),
    )
    size = sized.first()
    kind = docs.schema["doc_id"].dataType
    if size["tokens"] is None:
        none = docs.sparkSession.createDataFrame([], _SCORED)
        return none.withColumn("doc_id", F.col("doc_id").cast(kind))
    bits = min(64, int(size["tokens"]).bit_length() + 18)
    buckets = parts_for(order * int(size["tokens"]), bucket_keys)
    answers = settle(
        _questions(chunks, order, bits, buckets).groupBy("bucket").applyInPandas(_answered, _ANSWER_SCHEMA),
        "answers",
    )
    stats = (
        answers.filter("chunk = -1")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _ANSWER[6:]])
        .first()
    )
    kept = (float(stats["kept_tokens"]), float(stats["kept_words"]), float(size["learned"] - size["held"]))
    full = (float(stats["tokens"]), float(stats["words"]), float(size["learned"]))
    sent = answers.filter("chunk <> -1").select("bucket", "chunk", "held", "single", "total", "deleted")
    weights = _learned(chunks.filter("held"), sent.filter("held"), order, bits, kept)

    def scored(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        own = Chunk(row["words"], row["tokens"], row["lengths"], order, bits)
        counts = own.by_token(*_read_answers(right, "total"))
        p, ranges = own.estimates(counts, *full)
        mixed = np.einsum("nk,kn->n", weights[ranges], p)
        base = np.log10((counts[0] + 0.5) / (full[0] + 0.5 * (full[1] + 1)))
        return pd.DataFrame(
            {
                "doc_id": pd.Series(list(row["ids"]), dtype=object),
                "n_tokens": own.lengths,
                "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), own.first),
                "train_tokens": int(full[0]),
                "base_score": np.add.reduceat(base, own.first),
                "score": np.add.reduceat(np.log10(mixed), own.first),
            }
        )

    return (
        chunks.select("chunk", "ids", "lengths", "words", "tokens")
        .groupBy("chunk")
        .cogroup(sent.drop("held", "deleted").groupBy("chunk"))
        .applyInPandas(scored, _SCORED)
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


_SCORED = "doc_id string, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _learned(chunks: DataFrame, answers: DataFrame, order: int, bits: int, kept) -> np.ndarray:
    """Weights from all tokens of the held documents, gathered as counts of alike tokens.

    Probabilities are rounded to half powers of two, so the table of cells is
    bounded whatever the input; it is added up on the executors.
    """
    names = ["range", *[f"p{k}" for k in range(1, order + 1)]]

    def cells(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        own = Chunk(row["words"], row["tokens"], row["lengths"], order, bits)
        total, gone = _read_answers(right, "total"), _read_answers(right, "deleted")
        counts = own.by_token(total[0] - gone[0], total[1] - gone[1])
        p, ranges = own.estimates(counts, *kept)
        steps = np.where(p[1:] > 0, np.round(2 * np.log2(np.maximum(p[1:], 1e-30))), 1).astype(int)
        found = pd.DataFrame(dict(zip(names, [ranges, *steps])))
        return found.value_counts().rename("n").reset_index()

    schema = ", ".join(f"`{c}` int" for c in names) + ", n long"
    found = (
        chunks.select("chunk", "lengths", "words", "tokens")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(cells, schema)
        .groupBy(*names)
        .agg(F.sum("n").alias("n"))
        .orderBy(*names)
        .toPandas()
    )
    steps = found[names[1:]].to_numpy(float).T
    p = np.where(steps == 1, 0.0, np.minimum(2.0 ** (steps / 2), 1.0))
    uniform = np.full((1, len(found)), 1.0 / (kept[1] + 1))
    return fit_weights(found["range"].to_numpy(), np.vstack([uniform, p]), found["n"].to_numpy(float))


def interpolation_digest(docs: DataFrame, **settings) -> DataFrame:
    """Scores of every document by a model of those whose id's crc32 modulo 5 is not 1."""
    rows = docs.select("doc_id", "text").withColumn("training", id_remainder(5) != 1)
    return score_documents(rows, **settings).select(
        "doc_id",
        (id_remainder(5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
