"""Learned operators on planted structure, and their exact parts against brute force."""

import random
import re
import zlib

import numpy as np
import pytest

from ranklight.llm import isolation, quality_gam, text_stats, toxicity
from llm.conftest import prose, words


def fold(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


@pytest.fixture(scope="module")
def judged(spark):
    """Prose (good) and shouting or stuttering text (bad), some of both toxic."""
    draw = random.Random(8)
    docs, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        own = prose(draw, draw.randint(60, 200))
        if not good:
            own = own.upper().replace(" ", "!! ") if i % 2 else " ".join(w for w in words(draw, 30) for _ in "four")
        toxic = i % 5 == 0
        if toxic:
            own = own.replace(" ", " vilewords ", 1) + " vilewords"
        docs.append((i, own, "en", "s", len(own)))
        if i % 4:
            labels.append((i, int(good), int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_separates_held_out_documents(judged):
    docs, labels = judged
    found = {r["doc_id"]: r for r in quality_gam.quality_digest(docs, labels).collect()}
    assert len(found) == 300
    held = [i for i in found if found[i]["held_out"]]
    assert held and all(fold(i, 3) == 1 for i in held)
    assert np.mean([found[i]["predicted"] == int(i % 3 > 0) for i in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found.values())
    kept = quality_gam.keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["predicted"]}


def test_labels_outside_the_fold_do_not_matter(judged, spark):
    docs, labels = judged
    turned = [(r["doc_id"], r["quality"] if fold(r["doc_id"], 3) != 1 else 1 - r["quality"], r["toxic"]) for r in labels.collect()]
    other = spark.createDataFrame(turned, labels.schema)
    assert sorted(quality_gam.quality_digest(docs, labels).collect()) == sorted(
        quality_gam.quality_digest(docs, other).collect()
    )


def test_interactions_are_found():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality_gam.fit_gam(x, y, rounds=30, pair_rounds=60, n_pairs=1)
    assert model.pairs[0][:2] == (0, 2)
    assert np.mean((model.scores(x) >= 0.5) == y) > 0.95


def test_scores_are_sums_of_table_entries():
    draw = np.random.default_rng(1)
    x = draw.random((500, 2))
    model = quality_gam.fit_gam(x, (x[:, 0] > 0.3).astype(float), rounds=10, pair_rounds=5, n_pairs=1)
    total = model.base
    for f in range(2):
        total += model.tables[f][np.searchsorted(model.edges[f], x[7, f], side="right")]
    for i, j, table in model.pairs:
        a, b = (int(np.searchsorted(model.coarse[f], x[7, f], side="right")) for f in (i, j))
        total += table[a, b]
    assert model.logits(x)[7] == pytest.approx(total)


def test_toxicity_finds_held_out_words(judged):
    docs, labels = judged
    found = {r["doc_id"]: r for r in toxicity.toxicity_digest(docs, labels).collect()}
    held = [i for i in found if found[i]["held_out"]]
    assert held and all(fold(i, 5) == 0 for i in held)
    assert np.mean([found[i]["predicted"] == int(i % 5 == 0) for i in held]) > 0.95


def test_swaps_name_every_other_term_of_the_group():
    found = toxicity.swaps({"the", "women", "sing"})
    assert {"the", "men", "sing"} in found and len(found) == 3
    assert toxicity.swaps({"nothing", "here"}) == []


def test_counterfactuals_move_weight_off_the_mention():
    """Toxic texts mention one group more often; the penalty takes the mention's weight away."""
    draw = random.Random(2)
    texts, labels = [], []
    for k in range(600):
        toxic = k % 2
        own = {f"w{draw.randrange(80)}" for _ in range(8)}
        if draw.random() < (0.8 if toxic else 0.1):
            own.add("women")
        if toxic and draw.random() < 0.8:
            own.add("insult")
        texts.append(own)
        labels.append(float(toxic))
    bits = 16
    ids = [np.array(toxicity._ids(t, bits)) for t in texts]
    changed = [(k, np.array(toxicity._ids(c, bits))) for k, t in enumerate(texts) for c in toxicity.swaps(t)]
    plain = toxicity.fit_weights(ids, np.array(labels), [], bits)
    fair = toxicity.fit_weights(ids, np.array(labels), changed, bits, fairness=20.0)

    def gap(model):
        score = model.scorer()
        return float(score(["some women w1 w2"])[0] - score(["some men w1 w2"])[0])

    assert gap(plain) > 0.2 and abs(gap(fair)) < 0.3 * gap(plain)
    assert fair.scorer()(["insult w3 w4"])[0] > 0.5


def stats_by_force(text):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = {}
    for s in range(len(own) - 7):
        windows.setdefault(tuple(own[s : s + 8]), []).append(s)
    repeated = {k for places in windows.values() if len(places) > 1 for s in places for k in range(s, s + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (
        len(own),
        sum(map(len, own)),
        sum(c in "#*$%&|<>" for w in own for c in w),
        dup,
        len(repeated),
    )


def test_counts_equal_brute_force_and_rules_drop_odd_rows(documents, labels):
    found = {r["doc_id"]: r for r in isolation.rules_digest(documents, labels).collect()}
    for row in documents.collect():
        got = found[row["doc_id"]]
        n, _, _, _, repeats = want = stats_by_force(row["text"])
        assert tuple(got[c] for c in text_stats.COUNTS) == want
        assert got["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert not (got["kept"] and got["base_failed"])


def test_forest_marks_what_is_set_apart(judged):
    docs, labels = judged
    found = {r["doc_id"]: r["kept"] for r in isolation.rules_digest(docs, labels).collect()}
    assert np.mean([found[i] for i in found if i % 3]) > 0.85
    assert np.mean([found[i] for i in found if not i % 3]) < 0.2


def test_anomaly_is_higher_far_away():
    draw = np.random.default_rng(5)
    forest = isolation.fit_forest(draw.normal(size=(2000, 3)))
    near, far = forest.anomaly(np.zeros((1, 3)))[0], forest.anomaly(np.full((1, 3), 6.0))[0]
    assert far > 0.6 > 0.5 > near


def test_threshold_splits_the_labels():
    score = np.array([0.1, 0.2, 0.2, 0.5, 0.6])
    assert 0.2 < isolation.calibrate(score, np.array([True, True, True, False, False])) < 0.5
    assert isolation.calibrate(score, np.ones(5, bool)) == 1.0


@pytest.mark.parametrize("digest", [quality_gam.quality_digest, toxicity.toxicity_digest, isolation.rules_digest])
def test_odd_rows_and_empty_tables(digest, odd_documents, empty_documents, labels):
    assert digest(odd_documents, labels).count() == odd_documents.count()
    assert digest(empty_documents, labels).count() == 0
    assert digest(odd_documents, labels.limit(0)).count() == odd_documents.count()
    assert quality_gam.keep_quality(odd_documents, labels).columns == odd_documents.columns
