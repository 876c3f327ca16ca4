import math

import numpy as np
import pytest

from parcelwise.llm.whitening import principal, whiten

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def reference(vectors, k):
    """(whitened rows, eigenvalues over trace, exact deviations) by a dense eigenvalue decomposition."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    y = np.array([[float(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    cov = y.T @ y / n
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    return y @ q / np.sqrt(values), values / np.trace(cov), deviations


def check(spark, vectors, k):
    rows = [(i, [float(c) for c in v], 1, "x") for i, v in enumerate(vectors)]
    got = whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), block_mb=0.01).collect()
    white, explained, deviations = reference(vectors, k)
    assert len(got) == len(vectors) * k
    out = np.zeros((len(vectors), k))
    for r in got:
        assert r.n == len(vectors) and r.deviation == deviations[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        out[r.vec_id, r.component - 1] = r.whitened
    return out, white


def same(out, white):
    return np.abs(out - white * np.sign((out * white).sum(axis=0))).max()


def test_equals_dense_decomposition(spark):
    rnd = np.random.RandomState(1)
    out, white = check(spark, rnd.randn(500, 20), 8)
    assert same(out, white) < 1e-9
    out, white = check(spark, rnd.randn(300, 12) * 2.0 ** -np.arange(12) + 0.3, 8)   # deviations fall fast
    assert same(out, white) < 1e-7


def test_early_stop_and_values_that_occur_several_times():
    """With a steep spectrum steps end before the dimension; a value of several directions is found as often."""
    rnd = np.random.RandomState(2)
    for values in ([100.0 * 0.7 ** i for i in range(60)], [50, 50, 50, 9, 9, 3, 2, 1.5, 1.2, 1.1] + [1e-3 * 0.9 ** i for i in range(50)]):
        u, v = np.linalg.qr(rnd.randn(400, 60))[0], np.linalg.qr(rnd.randn(60, 60))[0]
        y, passes = u * np.array(values) @ v.T, []

        def product(p, earlier):
            passes.append(1)  # noqa: B023
            x = y @ p  # noqa: B023
            return (y @ earlier).T @ x, float(np.linalg.norm(x)), y.T @ x  # noqa: B023

        s, q = principal(product, 60, 8)
        assert np.allclose(s, values[:8], rtol=1e-12) and len(passes) <= 70
        assert np.abs(q.T @ q - np.eye(8)).max() < 1e-12
        assert np.abs(y.T @ (y @ q) - q * s ** 2).max() < 1e-10 * s[0] ** 2


def test_nulls_ties_lengths_and_repeated_rows(spark):
    rnd = np.random.RandomState(3)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(rnd.randn(40, 4))]
    other = [(100 + i, [float(c) for c in v]) for i, v in enumerate(rnd.randn(10, 3))]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (204, []), (205, [1e30, 0.0, 0.0, 0.0])]
    rows = [*good, *good[:15], *other, *bad, (None, good[0][1])]
    got = whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)).collect()
    assert sum(r.n == 56 for r in got) == 56 * 4 and sum(r.n == 10 for r in got) == 10 * 3
    assert {r.vec_id for r in got} == {i for i, _ in good} | {i for i, _ in other} | {None}
    assert max(r.identity_error for r in got) < 1e-9


def test_no_deviation_gives_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0], 1, "x")], [(1, [1.0, 2.0], 1, "x")] * 5):
        assert whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0], 1, "x") for i in range(9)]  # one direction only
    got = whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert len(got) == 9 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(i, [float(i) * 2.0 ** 30, 1.0], 1, "x") for i in range(4)]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and all(r.deviation is None for r in got) and got[0].identity_error < 1e-9


def test_query(spark, sf_small):
    import __spark_entry__

    rows = __spark_entry__.queries()["op12_whitening"](spark, sf_small).toPandas()
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").toPandas().sort_values("vec_id")
    white, explained, deviations = reference(table.embedding.tolist(), 8)
    out = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert same(out, white) < 1e-8 and rows.identity_error.max() < 1e-9
    assert rows[rows.component == 1].set_index("vec_id").loc[table.vec_id].deviation.tolist() == deviations
    assert np.allclose(rows.drop_duplicates("component").sort_values("component").explained, explained)
