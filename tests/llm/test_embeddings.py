"""Near-duplicate embeddings and whitening against plain linear algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import descent, whitening


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, p int, id string")


@pytest.fixture(scope="module")
def groups():
    """Vectors in groups of near copies of 1 to 300, with a few equal ones."""
    draw = np.random.default_rng(4)
    out = []
    for size in [300, 60, 20] + [2] * 60 + [1] * 700:
        centre = draw.normal(size=24)
        out += [centre + draw.normal(size=24) * 0.12 * (size > 1) for _ in range(size)]
    out += [out[0]] * 40
    return np.array(out)


def test_links_match_brute_force(spark, groups):
    rows = [(i, [float(x) for x in v], 0, "x") for i, v in enumerate(groups)]
    got = {r["vec_id"]: r for r in descent.near_duplicates(_frame(spark, rows)).collect()}
    unit = groups / np.linalg.norm(groups, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.9) & ~np.eye(len(groups), dtype=bool)
    assert len(got) == len(groups)
    found = np.array([got[i]["n_links"] for i in range(len(groups))])
    assert (found <= true.sum(axis=1)).all()
    assert found.sum() >= 0.98 * true.sum()
    label = np.arange(len(groups))
    while True:
        new = np.minimum(label, np.where(true, label[None, :], len(label)).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(groups))]) > 0.99
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_links_of_odd_rows(spark):
    rows = [(1, None, 0, "a"), (2, [], 0, "a"), (3, [0.0, 0.0], 0, "a"), (4, [1.0, None], 0, "a"), (5, [1.0, float("nan")], 0, "a"),
            (6, [1.0, 0.0], 0, "a"), (7, [1.0, 0.0], 0, "a"), (8, [1e300, 1e299], 0, "a"), (9, [1.0, 0.0, 0.0], 0, "a"),
            (10, [-1.0, 0.0], 0, "a"), (7, [1.0, 0.0], 0, "a")]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in descent.near_duplicates(_frame(spark, rows)).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 9, 10)]
    assert got == sorted(alone + [(6, 3, 6, True), (7, 3, 6, False), (7, 3, 6, False), (8, 3, 6, False)])
    assert descent.near_duplicates(_frame(spark, [])).count() == 0
    assert descent.near_duplicates(_frame(spark, rows[:3])).count() == 3


def test_whitening_matches_eigenvectors(spark):
    draw = np.random.default_rng(2)
    values = draw.normal(size=(500, 40)) * np.linspace(3, 0.2, 40) + draw.normal(size=(500, 1))
    rows = [(i, [float(x) for x in v], 0, "x") for i, v in enumerate(values)]
    odd = [(900, None, 0, "x"), (901, [1.0, None], 0, "x"), (902, [float("inf")] * 40, 0, "x"), (903, [1.0], 0, "x"), (904, [], 0, "x")]
    got = whitening.whiten(_frame(spark, rows + odd)).orderBy("vec_id", "component").collect()
    x = np.floor(64 * values) + 1000000
    centred = x - x.mean(axis=0)
    cov = centred.T @ centred / len(x)
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1][:32], w[:, ::-1][:, :32]
    want = centred @ w / np.sqrt(e)
    white = np.array([r["whitened"] for r in got]).reshape(500, 32)
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-6
    assert np.allclose([r["explained"] for r in got[:32]], e / np.trace(cov), rtol=1e-9)
    exact = [sum((500 * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0))) for row in x]
    assert [r["deviation"] for r in got[::32]] == exact
    assert got[0]["identity_error"] < 1e-9 and {r["n"] for r in got} == {500}


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(_frame(spark, [])).count() == 0
    assert whitening.whiten(_frame(spark, [(1, [1.0, 2.0], 0, "x")] * 3)).count() == 0
    # Two directions of three vary, and one row comes twice without an id.
    rows = [(None, [1.0, 2.0, 5.0], 0, "x")] * 2 + [(1, [2.0, 0.0, 5.0], 0, "x"), (2, [4.0, 9.0, 5.0], 0, "x")]
    got = whitening.whiten(_frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 1), (0, 2), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]


@pytest.mark.parametrize("matrix", [np.diag([5.0, 5, 5, 1, 1, 0, 0]), np.zeros((3, 3)), np.eye(50), np.ones((4, 4))])
def test_contour_counts_repeated_values(matrix):
    values, vectors = whitening.Contour(matrix).largest(32)
    want = [e for e in np.linalg.eigvalsh(matrix)[::-1] if e > 1e-9][:32]
    assert np.allclose(values, want)
    assert np.allclose(matrix @ vectors, vectors * values) and np.allclose(vectors.T @ vectors, np.eye(len(want)))
