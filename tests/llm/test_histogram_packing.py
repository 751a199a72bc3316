"""Packing by combinations of lengths: exact round trips, no padding, few cuts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ranklight.llm import histogram_packing as packing
from ranklight.llm import tokens as tok

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    with open(VOCABULARY, encoding="utf-8") as file:
        return tok.WordIds(file.read())


def encoded(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}


def check_places(found, window):
    """Pieces cover each document once, sequences have no gaps and no padding."""
    for _, own in found.sort_values("start").groupby("row"):
        assert own["start"].tolist() == [0, *np.cumsum(own["length"])[:-1]]
        assert own["length"].sum() == own["doc_tokens"].iloc[0]
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]]
        size = own["length"].sum()
        assert size == window or size < window and size & (size - 1) == 0


def test_round_trip(documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    want = encoded(texts)
    pieces = packing.pack_by_histogram(documents, VOCABULARY, 256, block_rows=20)
    found = pieces.toPandas()
    check_places(found.assign(row=found["doc_id"]), 256)
    for r in found.itertuples():
        own = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids == own and r.ids_crc32 == zlib.crc32(own)
    whole = packing.sequences(pieces).toPandas()
    assert whole["tokens"].sum() == sum(map(len, want.values()))
    for r in whole.itertuples():
        own = found[found["sequence_id"] == r.sequence_id].sort_values("offset")
        assert r.ids == b"".join(own["ids"]) and list(r.documents) == own["doc_id"].tolist()
    shown = packing.padding(pieces, 256).first()
    assert (shown["sequences"], shown["padding"]) == (len(whole), 0)


def test_odd_rows(odd_documents, empty_documents):
    found = packing.packing_digest(odd_documents, VOCABULARY, 64).toPandas()
    assert len(found) == odd_documents.count() and found["doc_id"].isna().sum() == 3
    assert sorted(found[found["doc_tokens"] == 1]["ids_crc32"].unique()) == [zlib.crc32(b"\1\0\0\0")]
    assert packing.packing_digest(empty_documents, VOCABULARY).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.packing_digest(odd_documents, VOCABULARY, 100)


@pytest.mark.parametrize("name", ["usual", "one length", "long", "one row", "powers"])
def test_places_of_drawn_lengths(spark, name):
    draw = np.random.default_rng(4)
    lengths = {
        "usual": draw.lognormal(4.5, 1.0, 5000).astype(int) + 1,
        "one length": np.where(draw.random(3000) < 0.5, 37, draw.integers(1, 500, 3000)),
        "long": draw.integers(1, 9000, 300),
        "one row": np.array([1111]),
        "powers": 2 ** draw.integers(0, 9, 700),
    }[name]
    rows = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "_row long, tokens long")
    found = packing.place_tokens(rows.repartition(5), 256, block_rows=100).toPandas()
    check_places(found.rename(columns={"_row": "row"}).assign(doc_tokens=lambda f: lengths[f["row"]]), 256)
    needed = sum(-(-int(n) // 256) for n in lengths)
    if name == "usual":
        assert len(found) < 1.1 * needed


def test_combinations_are_all_there_are():
    histogram = np.zeros(33, np.int64)
    histogram[[1, 2, 3, 5, 7, 8, 11, 16, 22, 30]] = 1
    there = [0, *np.flatnonzero(histogram)]
    want = {
        (a, b, c)
        for a in there
        for b in there
        for c in there
        if a <= b <= c and c and (b or not a) and a + b + c in (1, 2, 4, 8, 16, 32)
    }
    found = [tuple(map(int, r)) for r in packing.combinations(histogram)]
    assert set(found) == want and len(found) == len(want)


def test_counts_are_not_negative_and_lower_the_residual():
    draw = np.random.default_rng(2)
    histogram = np.bincount(draw.integers(1, 65, 4000), minlength=65)
    combos = packing.combinations(histogram)
    residuals = []
    for rounds in (0, 5, 50, 400):
        counts = packing.repeat_counts(combos, histogram, rounds)
        assert (counts >= 0).all()
        used = sum(np.bincount(side, counts, 65) for side in combos.T)
        residuals.append(((histogram - used)[1:] ** 2).sum())
    assert residuals == sorted(residuals, reverse=True) and residuals[-1] < 1e-2 * residuals[0]
    whole = packing.rounded(combos, counts, histogram)
    left = histogram - sum(np.bincount(side, whole, 65) for side in combos.T)
    assert (left[1:] >= 0).all() and left[1:].sum() < 0.1 * histogram.sum()


def test_long_texts_are_encoded_slice_by_slice(words, monkeypatch):
    text = " ".join(f"Word{k}, über-{k % 7}!\n\t$5 don't" for k in range(3000))
    want = encoded({0: text})[0][:-1]
    monkeypatch.setattr(tok, "_SLICE", 500)
    import pyarrow as pa

    column = pa.array([text, None, "", " a ", text[:400]])
    found = [x.tolist() for x in tok.text_ids(words, column)]
    assert found[0] == want and found[1] == found[2] == []
    assert found[3] == encoded({0: "a"})[0][:-1] and found[4] == encoded({0: text[:400]})[0][:-1]


def test_other_vocabularies():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError, match="white space"):
            tok.WordIds(file.read())
