"""Vector codes and whitening against brute force and numpy."""

import hashlib

import numpy as np
import pytest

from ranklight.llm import eigen, vector_codes, whitening
from ranklight.llm.vectors import integer_vectors
from tests.llm.test_exact import rows

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error int, x int, n int"


def table(spark, vectors, labels=None, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    labels = [k % 3 for k in range(len(vectors))] if labels is None else labels
    return spark.createDataFrame([(i, v, k, 0, 0, 0, 0) for i, v, k in zip(ids, vectors, labels)], SCHEMA)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Copies, null and repeated ids, null labels, vectors that have to go, clashing columns."""
    draw = np.random.default_rng(3)
    found = draw.normal(size=(150, 16)).astype("float32").tolist()
    found[20:60] = [found[4]] * 40
    found += [None, [None] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [-0.0] * 16]
    ids = [None if k in (9, 70) else 5 if k in (6, 7) else 1000 - k for k in range(len(found))]
    labels = [None if k % 7 == 0 else 1 if k < 80 else k % 5 for k in range(len(found))]
    return table(spark, found, labels, ids)


def kept(df):
    own = [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]
    own = [r for r in own if r[2] is not None and all(v is not None and np.isfinite(v) for v in r[2])]
    return sorted(own, key=lambda r: (r[0] is None, r[0], np.floor(4096 * np.array(r[2], float)).tolist()))


def codes_by_force(own, parts=8, entries=16, rounds=6):
    x = np.floor(4096 * np.array([r[2] for r in own], float)).astype(np.int64)
    cut = x.reshape(len(x), parts, -1)
    books = [[cut[r, p].copy() for r in range(min(entries, len(x)))] for p in range(parts)]

    def assigned():
        gaps = [[((cut[:, p] - e) ** 2).sum(1) for e in books[p]] for p in range(parts)]
        gaps = np.array(gaps).transpose(2, 0, 1)
        return gaps.argmin(2), gaps.min(2)

    for _ in range(rounds):
        code = assigned()[0]
        for p in range(parts):
            for e in range(len(books[p])):
                members = cut[code[:, p] == e, p]
                if len(members):
                    books[p][e] = np.array([int(c.sum()) // len(members) for c in members.T])
    code, gap = assigned()
    error = gap.sum(1)
    by_label = {k: sum(int(e) for e, r in zip(error, own) if r[1] == k) for k in {r[1] for r in own}}
    text = ",".join(str(v) for book in books for e in book for v in e)
    name = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{e:02x}" for e in c), int(g), by_label[r[1]], name) for r, c, g in zip(own, code, error)),
        key=repr,
    )


def test_codes_equal_brute_force(odd_vectors):
    assert rows(vector_codes.code_digest(odd_vectors)) == codes_by_force(kept(odd_vectors))


def test_codes_of_few_rows_and_none(spark):
    few = table(spark, [[0.5] * 8, [-0.5] * 8, [0.5] * 8])
    assert rows(vector_codes.code_digest(few)) == codes_by_force(kept(few))
    assert vector_codes.code_digest(few.limit(0)).count() == 0
    assert vector_codes.code_digest(table(spark, [[], []])).count() == 2
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.code_digest(table(spark, [[0.1] * 9]))
    with pytest.raises(ValueError, match="length"):
        vector_codes.code_digest(table(spark, [[0.1] * 8, [0.1] * 16]))


def test_decoded_vectors_are_the_entries(odd_vectors):
    own = integer_vectors(odd_vectors, ["vec_id"], vector_codes.SCALE)
    books = vector_codes.fit_codebooks(own, rounds=2)
    found = vector_codes.decode_vectors(vector_codes.code_vectors(own, books, ["vec_id"]), books)
    for r in found.collect():
        assert r["x"] == [int(v) for p, e in enumerate(r["code"]) for v in books[p][e]]


@pytest.mark.parametrize("size, width, spread", [(16, 8, 400), (300, 3, 400), (40, 3, 2), (200, 2, 1)])
def test_tree_finds_the_nearest_and_the_lower_index(size, width, spread):
    draw = np.random.default_rng(size)
    points = draw.integers(-spread, spread + 1, size=(size, width))
    queries = np.concatenate([draw.integers(-2 * spread, 2 * spread + 1, size=(2000, width)), points])
    tree = vector_codes.RangeTree(points)
    where, square = tree.nearest(queries)
    gaps = ((queries[:, None] - points[None]) ** 2).sum(2)
    assert (where == gaps.argmin(1)).all() and (square == gaps.min(1)).all()


def test_tree_skips_far_subtrees():
    draw = np.random.default_rng(1)
    centres = draw.integers(-100_000, 100_000, size=(16, 8))
    points = np.repeat(centres, 16, axis=0) + draw.integers(-500, 500, size=(256, 8))
    queries = points + draw.integers(-50, 50, size=points.shape)
    tree = vector_codes.RangeTree(points)
    where, _ = tree.nearest(queries)
    assert (where == ((queries[:, None] - points[None]) ** 2).sum(2).argmin(1)).all()
    assert tree.computed < 0.25 * len(points) * len(queries)


def test_roots_are_rounded_to_both_sides():
    squares = np.array([0, 1, 2, 3, 4, (1 << 28) ** 2 - 1, (1 << 28) ** 2, (1 << 28) ** 2 + 1])
    low, high = vector_codes.square_roots(squares)
    assert (low * low <= squares).all() and (squares < (low + 1) ** 2).all()
    assert (high * high >= squares).all() and ((high - 1) ** 2 < squares)[1:].all()


# ---- whitening ----------------------------------------------------------------


def hard_matrices():
    draw = np.random.default_rng(0)
    wilkinson = np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    glued = np.kron(np.eye(3), wilkinson)
    glued[20, 21] = glued[21, 20] = glued[41, 42] = glued[42, 41] = 1e-8
    wide = draw.normal(size=(40, 90))
    turn = np.linalg.qr(draw.normal(size=(32, 32)))[0]
    repeated = turn @ np.diag(np.repeat([5.0, 3, 1, 0.5], 8)) @ turn.T
    low = draw.normal(size=(30, 4))
    return {
        "usual": wide @ wide.T,
        "wilkinson": wilkinson,
        "glued": glued,
        "repeated": (repeated + repeated.T) / 2,
        "rank four": low @ low.T,
        "identity": np.eye(12),
        "spike": np.eye(12) + 10,
        "two": np.array([[3.0, 1], [1, 3]]),
        "one": np.array([[2.0]]),
        "zero": np.zeros((5, 5)),
        "tiny": wide @ wide.T * 1e-180,
    }


@pytest.mark.parametrize("name", hard_matrices())
def test_eigenpairs(name):
    a = hard_matrices()[name]
    size = max(np.abs(a).max(), 1e-300)
    values, vectors = eigen.leading_eigenpairs(a, 24)
    k = min(24, len(a))
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-12 * size
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_whitening_equals_numpy(odd_vectors):
    own = [r for r in kept(odd_vectors)]
    x = np.floor(64 * np.array([r[2] for r in own], float)).astype(np.int64) + 1_000_000
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors / np.sqrt(values)
    gaps = len(x) * x - x.sum(0)
    deviation = {r[0]: sum(int(v) ** 2 for v in g) for r, g in zip(own, gaps)}
    found = whitening.whitening_digest(odd_vectors).toPandas()
    assert len(found) == 16 * len(own) and set(found["component"]) == set(range(1, 17))
    assert found["n"].eq(len(own)).all() and found["identity_error"].nunique() == 1
    assert found["identity_error"].max() < 1e-10
    for k, part in found.groupby("component"):
        assert np.allclose(part["explained"], values[k - 1] / values.sum(), rtol=1e-9)
        near = np.sort(part["whitened"])
        assert np.allclose(near, np.sort(want[:, k - 1])) or np.allclose(near, np.sort(-want[:, k - 1]))
    once = found[found["vec_id"].notna() & found["vec_id"].ne(5)]
    assert all(deviation[int(i)] == d for i, d in zip(once["vec_id"], once["deviation"]))


def test_whitening_without_variance(spark):
    assert whitening.whitening_digest(table(spark, [[0.5] * 8] * 4)).count() == 0
    assert whitening.whitening_digest(table(spark, [[0.5] * 8])).count() == 0
    assert whitening.whitening_digest(table(spark, [[0.5] * 8]).limit(0)).count() == 0
    line = [[float(k), 2.0 * k, 0.0] for k in range(9)]
    found = whitening.whitening_digest(table(spark, line)).toPandas()
    assert set(found["component"]) == {1} and np.allclose(found["explained"], 1)
    assert abs(found["whitened"].pow(2).mean() - 1) < 1e-12


def test_deviations_beyond_64_bits_are_null():
    assert whitening._deviations(np.array([[3, 4], [1 << 33, 1]])) == [25, None]
    assert whitening._scaled_gaps(np.array([[1 << 40]]), 1 << 30, np.array([5]))[0, 0] == (1 << 70) - 5
