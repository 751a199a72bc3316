"""Anchors with very many contexts: equal results, and no group that holds them all."""

import random

import numpy as np
import pandas as pd
import pytest

from ranklight.llm import repeats
from tests.llm.conftest import words
from tests.llm.test_exact import repeats_by_force, rows, texts


def shared_passage(n=60):
    draw = random.Random(9)
    passage = " ".join(words(draw, 12))[:90]
    around = [(" ".join(words(draw, 40)), " ".join(words(draw, 40))) for _ in range(9)]
    return {k: draw.choice(around)[0] + f" {k % 7} " + passage + draw.choice(around)[1] for k in range(n)}


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 3000])
def test_crowded_anchors_equal_brute_force(documents, spark, chunk_bytes):
    found = rows(repeats.remove_repeats(documents, chunk_bytes, digest=True, most_contexts=2))
    assert found == repeats_by_force(texts(documents))
    own = shared_passage()
    frame = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    found = rows(repeats.remove_repeats(frame, chunk_bytes, digest=True, most_contexts=4))
    assert found == repeats_by_force({i: t.encode() for i, t in own.items()})


def test_contexts_of_crowded_anchors_are_not_gathered():
    own = {i: t.encode() for i, t in shared_passage().items()}
    chunk = repeats.Chunk([str(i) for i in own], [len(t) for t in own.values()], b"".join(own.values()))
    pieces, counts = np.unique(chunk.piece, return_counts=True)
    crowded = [(int(p), int(n)) for p, n in zip(pieces, counts) if n > 8]
    assert crowded
    edges = repeats._edges(3, crowded, 4)
    sizes = np.diff(chunk.cuts(edges))
    assert sizes.sum() == len(chunk.piece)
    for piece, n in crowded:
        assert sum(p == piece for p, _ in edges) == -(-n // 4)
    left = pd.DataFrame([{"ids": [str(i) for i in own], "lengths": [len(t) for t in own.values()], "data": b"".join(own.values())}])
    flags = pd.DataFrame({"bucket": [0], "flags": [repeats.zlib.compress(b"\3" * len(chunk.piece))]})
    hot = np.array([p for p, _ in crowded], np.uint64)
    sent = repeats._context_sender(edges, hot)((0,), left, flags)
    assert sum(len(b) for b in sent["before"]) == len(chunk.piece) - sum(n for _, n in crowded)
