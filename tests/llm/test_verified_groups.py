"""Groups of near copies are those that exact shingle similarity confirms; the whole pipeline beside brute force."""

import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from tests.llm.conftest import corpus, prose, words
from tests.llm.test_exact import components_by_force, leaks_by_force, lines_by_force, texts

from ranklight.llm import near_dedup, quality_gam
from ranklight.llm.hamming import hamming_links, sure_parts
from ranklight.session import settle

GIVEN = "/root/testdata/sf0.01"


def sets_of(found):
    return {i: set(near_dedup.shingle_hashes(t, 5).tolist()) for i, t in found.items()}


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def groups_by_force(found):
    """The smallest id each document is linked to, directly or not, by a similarity of 0.8."""
    sets = sets_of(found)
    ids = sorted(sets)
    least = {i: i for i in ids}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if alike(sets[a], sets[b]):
                low, high = sorted((root(a), root(b)))
                least[high] = low
    return {i: root(i) for i in ids}


def planted_groups():
    """Bases with copies at 0.95, whose bases are alike by 0.7 only, and loose singles at 0.72."""
    draw = random.Random(3)
    base = words(draw, 400)
    out = []
    for k in range(6):
        own = list(base)
        for p in range(0, 400, 22):
            own[p] = f"kind{k}"
        for c in range(5):
            copy = list(own)
            copy[40 + 7 * c] = f"copy{c}"
            out.append(" ".join(copy))
    for k in range(6):
        own = list(base)
        for p in range(3 + k, 400, 24):
            own[p] = f"single{k}"
        out.append(" ".join(own))
    out += [prose(draw, 60) for _ in range(20)]
    draw.shuffle(out)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(out)]


def test_groups_within_the_radius_are_split_by_their_shingles(spark):
    frame = spark.createDataFrame(planted_groups(), "doc_id long, text string, lang string, source string, n_chars long")
    want = groups_by_force(texts(frame))
    kept = {r["doc_id"] for r in near_dedup.keep_one_per_group(frame.repartition(4)).collect()}
    assert kept == set(want.values())
    assert len(kept) < len(want)


def test_given_documents_lose_only_copies_and_keep_few(spark):
    frame = spark.read.parquet(f"{GIVEN}/documents.parquet")
    found = texts(frame)
    want = groups_by_force(found)
    kept = {r["doc_id"] for r in near_dedup.keep_one_per_group(frame).collect()}
    gone = set(want) - kept
    should = {i for i, r in want.items() if r != i}
    assert gone <= should
    assert len(gone) >= 0.95 * len(should) > 0


def test_all_pairs_apart_are_proposed(spark):
    draw = np.random.default_rng(5)
    centre = int(draw.integers(0, 2**62))
    values = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 62, (40, 2))})
    nodes = [(n, v, n % 3) for n, v in enumerate(values)]
    frame = spark.createDataFrame(nodes, "node long, fp0 long, side long")
    n, both = near_dedup.bit_statistics(frame, ["fp0"])
    parts = sure_parts(n, both, 3)
    found = {tuple(sorted(r)) for r in hamming_links(frame, ["fp0"], 3, parts, apart="side").collect()}
    want = {
        (a, b)
        for a, x, s in nodes
        for b, y, t in nodes
        if a < b and s != t and (x ^ y).bit_count() <= 3
    }
    assert found == want and want
    assert components_by_force(dict(enumerate(values)), 4)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents, labels and a benchmark as a folder of tables."""
    root = str(tmp_path_factory.mktemp("planted"))
    own = [(i, t, "en", "s", len(t)) for i, t in corpus(n=150)]
    own.append((3000, None, None, None, None))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(own, schema).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], r[0] % 2, 0) for r in own]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    items = [(k, " ".join((own[i][1]).split()[5:35])) for k, i in enumerate(range(4, 40, 9))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_pipeline_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, docs, sf_dir), name)
        steps[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == before.columns

    before, after = steps["quality_classifier"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.fit_quality(before, labels)
    scored = quality_gam.score_quality(before.select("doc_id", "text"), model)
    good = {r["doc_id"] for r in scored.collect() if r["score"] >= 0.5}
    assert set(texts(after)) == good and 0 < len(good) < before.count()

    before, after = steps["line_dedup"]
    want = {r[0]: r[3] for r in lines_by_force(texts(before))}
    assert {i: hashlib.sha256(t).hexdigest() for i, t in texts(after).items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"])

    before, after = steps["simhash_near_dedup"]
    assert set(texts(after)) == set(groups_by_force(texts(before)).values())

    before, after = steps["benchmark_decontamination"]
    items = {r["item_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    leaking = {i for i, _ in leaks_by_force(texts(before), items)}
    assert set(texts(after)) == set(texts(before)) - leaking and leaking

    before, after = steps["best_fit_packing"]
    pieces = sorted((r["doc_id"], r["start"], r["length"]) for r in after.collect())
    assert {p[0] for p in pieces} == set(texts(before))
    ends = {}
    for doc, start, length in pieces:
        assert start == ends.get(doc, 0)
        ends[doc] = start + length
    whole = sorted(map(repr, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length").collect()))
    assert whole == sorted(map(repr, after.select("doc_id", "start", "length").collect()))


def test_bounds_never_exceed_what_texts_differ_in(spark):
    frame = spark.createDataFrame(planted_groups(), "doc_id long, text string, lang string, source string, n_chars long")
    sets = near_dedup.shingle_sets(frame.selectExpr("doc_id AS node", "text"), 5)
    rows = {r["node"]: r.asDict() for r in near_dedup.difference_bounds(sets).collect()}
    whole = sets_of(texts(frame))
    refused = 0
    for a in whole:
        assert rows[a]["size"] == len(whole[a])
        for b in whole:
            least = sum(((rows[a][f"q{k}"] ^ rows[b][f"q{k}"]) & (2**64 - 1)).bit_count() for k in range(8))
            assert least <= len(whole[a] ^ whole[b])
            refused += least > (len(whole[a]) + len(whole[b])) / 9
    assert refused > len(whole)


def test_pairs_apart_are_given_once_and_refused_by_their_bounds(spark):
    nodes = [(0, 1, 0, 9, 0), (1, 3, 1, 9, 1), (2, 3 | 4, 2, 9, 0b111), (3, 1 | 8, 3, 9, 0b11)]
    frame = spark.createDataFrame(nodes, "node long, fp0 long, side long, size long, q0 long")
    n, both = near_dedup.bit_statistics(frame, ["fp0"])
    parts = sure_parts(n, both, 3)
    found = hamming_links(frame, ["fp0"], 3, parts, "side", bounds=["size", "q0"], similarity=0.8).collect()
    # Of 18 shingles two may differ: nodes 0 and 2 have parities that differ in three.
    assert sorted(tuple(sorted(r)) for r in found) == [(0, 1), (0, 3), (1, 2), (1, 3), (2, 3)]
