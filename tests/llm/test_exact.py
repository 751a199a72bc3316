"""Operators with exact results, against brute force over small tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import rows_of
from ranklight.llm import decontaminate, interpolation, line_dedup, near_dedup, packing, repeats, sharding
from ranklight.llm.hamming import allocate, hamming_links, likely_parts, sure_parts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def texts(documents):
    return {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- sharding -----------------------------------------------------------------


def test_shards_hold_every_row_once_and_counts_differ_by_one(documents):
    found = sharding.shard_digest(documents, shards=8, bucket_rows=10).toPandas()
    want = texts(documents)
    assert sorted(found["doc_id"]) == sorted(want)
    assert all(s == len(want[i]) + 1 for i, s in zip(found["doc_id"], found["size"]))
    assert all(c == zlib.crc32(want[i]) for i, c in zip(found["doc_id"], found["text_crc32"]))
    counts = found.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["nunique"]).all()


def test_shuffle_repeats_itself_and_depends_on_the_seed(documents):
    first = rows(sharding.shard_digest(documents, bucket_rows=10))
    assert first == rows(sharding.shard_digest(documents.repartition(9), bucket_rows=10))
    assert first != rows(sharding.shard_digest(documents, bucket_rows=10, seed=18))


def test_fisher_yates_is_a_permutation_and_close_to_uniform(spark):
    found = spark.range(3000).select(
        sharding.fisher_yates(F.lit(4), 3, F.col("id")).alias("order")
    ).collect()
    orders = Counter(tuple(r["order"]) for r in found)
    assert len(orders) == 24 and min(orders.values()) > 75
    assert spark.range(1).select(sharding.fisher_yates(F.lit(0), 3, F.lit(1))).first()[0] == []


def test_sharding_of_odd_rows(odd_documents, empty_documents):
    found = sharding.shard_documents(odd_documents, shards=4)
    assert sorted(found.columns) == sorted(odd_documents.columns)
    assert found.count() == odd_documents.count() == found.select("shard", "slot").distinct().count()
    assert sharding.shard_documents(empty_documents).count() == 0
    assert sharding.shard_digest(odd_documents).count() == odd_documents.count()


def test_written_shards_hold_the_rows(documents, spark, tmp_path):
    sharding.write_shards(sharding.shard_documents(documents, 3), str(tmp_path / "shards"), 20)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back.select("doc_id", "text")) == rows(documents.select("doc_id", "text"))


# ---- lines --------------------------------------------------------------------


def lines_by_force(found, min_docs=3):
    space = " \t\n\x0b\x0c\r"
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = {}
    for i, text in found.items():
        for line in text.decode().split("\n"):
            holders.setdefault(line.strip(space).translate(upper), set()).add(i)
    out = []
    for i, text in found.items():
        own = text.decode().split("\n")
        keys = [line.strip(space).translate(upper) for line in own]
        drop = [len(k) >= 20 and len(holders[k]) >= min_docs and max(holders[k]) != i for k in keys]
        kept = "\n".join(x for x, d in zip(own, drop) if not d)
        out.append((i, len(own), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_shared_lines_go_but_from_the_largest_id(documents):
    found = rows(line_dedup.line_dedup_digest(documents))
    assert found == lines_by_force(texts(documents))
    assert sum(r[2] for r in found) > 5


def test_lines_of_odd_rows(odd_documents, empty_documents, spark):
    found = line_dedup.dedup_lines(odd_documents, min_chars=3, min_docs=2)
    assert set(odd_documents.columns) <= set(found.columns)
    kept = sorted(found.select("doc_id", "text", "n_dropped", "score").collect(), key=repr)
    assert len(kept) == odd_documents.count()
    assert [r for r in kept if r["doc_id"] == 1 and r["n_dropped"] == 1 and r["text"] == ""] != []
    assert all(r["text"] == "same text here" for r in kept if r["doc_id"] == 3)
    assert line_dedup.dedup_lines(empty_documents).count() == 0


# ---- fingerprints -----------------------------------------------------------------


def fingerprint_by_force(text, width=4):
    own = text.lower().split()
    if not own:
        return 0
    parts = [b" ".join(own[k : k + width]) for k in range(max(1, len(own) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_force(values, radius):
    ids = sorted(values)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (values[a] ^ values[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(documents):
    want = {i: fingerprint_by_force(t) for i, t in texts(documents).items()}
    roots = components_by_force(want, 4)
    found = rows(near_dedup.near_duplicates(documents))
    assert found == sorted(((i, f"{v:016x}", roots[i]) for i, v in want.items()), key=repr)
    assert len(set(roots.values())) < len(roots)


def test_chains_of_close_fingerprints_are_one_group(spark):
    values = {0: 0, 9: 0b1111, 5: 0b11111111, 7: 1 << 60, 8: (1 << 64) - 1}
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in values.items()]
    found = spark.createDataFrame(signed, "doc_id long, fp0 long").withColumn("node", F.col("fp0"))
    got = near_dedup.fingerprint_components(found, 1, 4)
    joined = found.join(got, "node").select("doc_id", "component_id")
    assert dict(rows(joined)) == {0: 0, 9: 0, 5: 0, 7: 0, 8: 8}


def test_dense_groups_return_few_links(spark):
    draw = np.random.default_rng(3)
    values = {0}
    while len(values) < 400:
        values.add(int(sum(1 << int(b) for b in draw.choice(60, 2, replace=False))))
    frame = spark.createDataFrame([(v, v) for v in values], "node long, fp0 long")
    parts = sure_parts(400, np.full((64, 64), 100.0) + np.eye(64) * 100, 4)
    links = hamming_links(frame, ["fp0"], 4, parts)
    assert links.count() <= 4 * 5 * 400  # there are 79,800 pairs
    assert all((a ^ b).bit_count() <= 4 for a, b in links.collect())


def test_thresholds_are_the_cheapest_that_suffice():
    costs = [[5.0, 6.0, 50.0], [1.0, 9.0, 50.0], [4.0, 40.0, 50.0]]
    cost, chosen = allocate(costs, [[1, 2, 3]] * 3, 3)
    assert (cost, sum(t + 1 for t in chosen)) == (7.0, 3)


def test_sure_parts_find_every_pair_within_the_radius():
    draw = np.random.default_rng(1)
    both = np.full((64, 64), 250.0) + np.eye(64) * 250
    parts = sure_parts(1000, both, 4)
    assert sum(t + 1 for _, t in parts) == 5
    for _ in range(500):
        flipped = set(draw.choice(64, 4, replace=False).tolist())
        assert any(len(flipped & set(bits)) <= t for bits, t in parts)


def test_likely_parts_reach_the_recall_asked_for():
    both = np.full((256, 256), 25000.0) + np.eye(256) * 25000
    parts = likely_parts(100_000, both, 0.15, recall=0.99)
    draw = np.random.default_rng(2)
    hit = 0
    for _ in range(300):
        flipped = draw.random(256) < 0.15
        hit += any(flipped[bits].sum() <= t for bits, t in parts)
    assert hit >= 290


def test_one_of_each_group_stays(documents, odd_documents, empty_documents):
    kept = near_dedup.keep_one_per_group(documents)
    assert kept.columns == documents.columns
    left = {r["doc_id"] for r in kept.collect()}
    by_text = {}
    for i, t in sorted(texts(documents).items()):
        by_text.setdefault(t, i)
    assert left <= set(by_text.values())
    shingles = {
        i: set(near_dedup.shingle_hashes(t, 5).tolist()) for i, t in texts(documents).items() if t.split()
    }
    ids = sorted(left & set(shingles))
    for a in ids:
        for b in ids:
            if a < b and len(shingles[a]) > 60:
                both = len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
                assert both < 0.85
    apart = [
        i for i in shingles
        if all(len(shingles[i] & shingles[j]) < 0.3 * len(shingles[i] | shingles[j]) for j in shingles if j != i)
    ]
    assert set(apart) <= left
    odd = near_dedup.keep_one_per_group(odd_documents)
    assert odd.columns == odd_documents.columns and odd.count() == 4
    assert near_dedup.keep_one_per_group(empty_documents).count() == 0
    assert near_dedup.near_duplicates(odd_documents).count() == odd_documents.count()
    assert near_dedup.near_duplicates(empty_documents).count() == 0


# ---- benchmark items --------------------------------------------------------------


def leaks_by_force(found, items, width=5, threshold=0.8):
    out = set()
    for i, text in found.items():
        own = decontaminate.words_of(text)
        for k, item in items.items():
            want = decontaminate.words_of(item)
            if not want:
                continue

            def grams(w):
                return Counter(tuple(w[s : s + width]) for s in range(max(1, len(w) - width + 1)))

            target = grams(want)
            for s in range(max(1, len(own) - len(want) + 1)):
                window = own[s : s + len(want)]
                if window and decontaminate.weighted_similarity(grams(window), target) >= threshold:
                    out.add((i, k))
                    break
    return sorted(out)


def test_leaks_equal_brute_force(documents, spark):
    found = texts(documents)
    words = {i: t.split() for i, t in found.items()}
    long = [i for i in sorted(words) if len(words[i]) > 70][:12]
    items = {k: b" ".join(words[i][5:65]) for k, i in enumerate(long)}
    edited = {100 + k: b" ".join([*words[i][5:60], b"new", b"end"]) for k, i in enumerate(long)}
    items |= edited | {200: b"", 201: b"a", 202: b"quite other words that no document has in it"}
    rows_ = [(k, t.decode()) for k, t in items.items()] + [(203, None)]
    benchmark = spark.createDataFrame(rows_, "item_id long, text string")
    want = leaks_by_force(found, items)
    for block in (1 << 24, 600):
        got = decontaminate.find_leaks(documents, benchmark, block_bytes=block)
        assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == want
    left = decontaminate.drop_leaking(documents, benchmark)
    assert {r["doc_id"] for r in left.collect()} == set(found) - {i for i, _ in want}
    assert len(want) > 12


def test_leaks_of_odd_rows(odd_documents, empty_documents, spark):
    items = spark.createDataFrame([(1, "Same TEXT, here!"), (1, "Same text here")], "item_id long, text string")
    got = decontaminate.find_leaks(odd_documents, items)
    assert got.count() == 6
    assert decontaminate.drop_leaking(odd_documents, items).count() == 6
    assert decontaminate.find_leaks(empty_documents, items).count() == 0
    assert decontaminate.find_leaks(odd_documents, items.limit(0)).count() == 0


def test_hamming_blocks_miss_nothing():
    draw = np.random.default_rng(4)
    values = [int(v) for v in draw.integers(0, 2**63, 200)]
    index = decontaminate.HammingBlocks(values, 20)
    for k in range(200):
        flipped = values[k]
        for b in draw.choice(64, 20, replace=False):
            flipped ^= 1 << int(b)
        assert index.near(flipped) == {i for i, v in enumerate(values) if (v ^ flipped).bit_count() <= 20}


# ---- packing ----------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [4000, 60])
def test_packed_pieces_are_the_tokens_and_fit(documents, block_rows):
    length = 128
    found = packing.pack_documents(documents, VOCABULARY, length, block_rows=block_rows)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = []
    for i, text in texts(documents).items():
        ids = np.array([*tokenizer.encode(text.decode(), add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            want.append((i, k, start, len(part), zlib.crc32(part.tobytes())))
    got = found.toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got[names].itertuples(index=False, name=None)) == sorted(want)
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id")["length"].cumsum()
    assert (ends - ordered["length"] == ordered["offset"]).all() and ends.max() <= length
    sizes = got["length"].to_numpy()
    plain = packing.best_fit(sizes, np.arange(len(sizes)), np.full(len(sizes), -1), length)
    blocks = 1 + len(sizes) // block_rows
    assert got["sequence_id"].nunique() <= plain.max() + 1 + (blocks if blocks > 1 else 0)


def test_packing_of_odd_rows(odd_documents, empty_documents):
    found = packing.pack_documents(odd_documents, VOCABULARY, 8)
    assert found.count() >= odd_documents.count()
    assert packing.pack_documents(empty_documents, VOCABULARY).count() == 0


def test_crossover_and_mutation_keep_a_packing():
    draw = np.random.default_rng(0)
    sizes = draw.integers(1, 60, 300)
    none = np.full(300, -1)
    a = packing.best_fit(sizes, np.arange(300), none, 100)
    b = packing.best_fit(sizes, draw.permutation(300), none, 100)
    for _ in range(20):
        child = packing.mutate(sizes, packing.crossover(sizes, a, b, 100, draw), 100, draw)
        assert (child >= 0).all() and np.bincount(child, sizes).max() <= 100
        assert len(np.unique(child)) == child.max() + 1
    best = packing.evolve(sizes, [], 100, [1])
    assert packing.fitness(sizes, best, 100) >= packing.fitness(sizes, a, 100)


# ---- repeats ------------------------------------------------------------------------


def repeats_by_force(found):
    seen, out = set(), []
    for i, text in sorted(found.items()):
        gone = bytearray(len(text))
        for s in range(len(text) - 99):
            window = text[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for k in range(len(text)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_repeats_equal_brute_force(documents, chunk_bytes):
    found = rows(repeats.remove_repeats(documents, chunk_bytes, digest=True))
    assert found == repeats_by_force(texts(documents))
    assert sum(r[3] for r in found) > 20


def test_repeats_inside_one_document_and_of_few_symbols(spark):
    own = {1: b"ab" * 300, 2: b"ab" * 50, 3: b"a" * 99, 4: b"a" * 100, 5: b"ba" * 60 + b"a" * 130}
    frame = spark.createDataFrame([(i, t.decode()) for i, t in own.items()], "doc_id long, text string")
    assert rows(repeats.remove_repeats(frame, 150, digest=True)) == repeats_by_force(own)


def test_repeats_of_odd_rows(odd_documents, empty_documents, spark):
    assert repeats.remove_repeats(odd_documents).count() == odd_documents.count()
    assert repeats.remove_repeats(empty_documents).count() == 0
    text = "".join(f"{k} " for k in range(100))
    frame = spark.createDataFrame([(7, text), (7, text), (None, text)], "doc_id long, text string")
    found = sorted((r["n_removed"], r["doc_id"]) for r in repeats.remove_repeats(frame).collect())
    assert [n for n, _ in found] == [0, len(text), len(text)] and found[0][1] is None


# ---- language model -------------------------------------------------------------------


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 3000])
def test_base_scores_equal_brute_force_and_the_model_beats_them(documents, chunk_bytes):
    found = interpolation.interpolation_digest(documents, chunk_bytes=chunk_bytes, bucket_keys=2000).toPandas()
    want, counts = {}, Counter()
    for i, text in texts(documents).items():
        tokens = [*text.lower().split(), b"\n"]
        want[i] = tokens
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    assert sorted(found["doc_id"]) == sorted(want)
    for row in found.itertuples():
        tokens = want[row.doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert (row.n_tokens, row.n_known) == (len(tokens), sum(counts[t] > 0 for t in tokens))
        assert row.train_tokens == n and row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 1)
        assert row.score < 0
    held = found[found["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_scores_do_not_depend_on_the_chunks(documents):
    a = rows(interpolation.interpolation_digest(documents))
    b = rows(interpolation.interpolation_digest(documents, chunk_bytes=3000, bucket_keys=1500))
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert np.allclose([r[5:] for r in a], [r[5:] for r in b])


def test_interpolation_of_odd_rows(odd_documents, empty_documents, spark):
    found = interpolation.interpolation_digest(odd_documents)
    assert found.count() == odd_documents.count()
    assert interpolation.interpolation_digest(empty_documents).count() == 0
    untrained = odd_documents.withColumn("training", F.lit(False))
    assert all(math.isfinite(r["score"]) for r in interpolation.score_documents(untrained).collect())


def test_weights_learn_which_order_to_trust():
    p = np.array([[0.01] * 4, [0.05] * 4, [0.5, 0.5, 0.0, 0.0]])
    ranges = np.array([30, 30, 25, 25])
    weights = interpolation.fit_weights(ranges, p, np.full(4, 1000.0))
    assert weights[30].argmax() == 2 and weights[25].argmax() == 1
    assert np.allclose(weights.sum(1), 1) and (weights[:24, 2] == 0).all()


def test_planes_round_trip():
    for values in ([], [0], [1, 2**40, 3], [2**64 - 1, 0]):
        own = np.array(values, np.uint64)
        assert (interpolation.from_planes(interpolation.planes(own)) == own).all()


def test_rows_helper_sorts_columns():
    assert rows_of(["b", "a"], [(1, 2)]) == (["a", "b"], [(2, 1)])
