import numpy as np
import pytest

from talklake.llm import whitening
from talklake.llm.queries import ALL

SCHEMA = "vec_id bigint, embedding array<float>, Component string, X int"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, "c", 1) for i, v in vectors], SCHEMA)


def plain(vectors):
    """Covariance and eigenvectors of the distinct whole-number vectors, by numpy alone."""
    x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    apart = fit - sums / n
    values, axes = np.linalg.eigh(apart.T @ apart / n)
    return x, n, sums, values[::-1], axes[:, ::-1]


def check(found, ids, vectors, components=4):
    x, n, sums, values, axes = plain(vectors)
    width = min(components, x.shape[1])
    rows = {}
    for r in found:
        rows.setdefault(r.component, []).append(r)
    assert sorted(rows) == list(range(1, width + 1))
    for c, own in rows.items():
        assert len(own) == len(ids) and {r.n for r in own} == {n}
        want = (x - sums / n) @ axes[:, c - 1] / np.sqrt(values[c - 1])
        order = np.argsort(ids, kind="stable")
        own = sorted(own, key=lambda r: (r.vec_id, r.deviation))
        got = np.array([r.whitened for r in own])
        key = np.array([((n * row - sums) ** 2).sum() for row in x])
        order = np.lexsort((key, ids))
        assert [r.deviation for r in own] == key[order].tolist()
        want = want[order]
        sign = np.sign(got @ want)
        assert np.allclose(got, sign * want, atol=1e-8)
        assert own[0].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-10)
        assert own[0].identity_error < 1e-9


def test_rank_one_updates_equal_a_full_decomposition():
    dice = np.random.default_rng(1)
    for size in (1, 2, 5, 20):
        whole = np.zeros((size, size))
        values, vectors = np.zeros(size), np.eye(size)
        for step in range(60):
            kind = step % 4
            v = dice.normal(size=size) * 10.0 ** dice.integers(-6, 6)
            if kind == 1:
                v = np.eye(size)[dice.integers(size)] * 3.0  # equal eigenvalues
            if kind == 2:
                v[dice.random(size) < 0.7] = 0
            rho = float(dice.random() * 2)
            whole += rho * np.outer(v, v)
            values, vectors = whitening.rank_one(values, vectors, v, rho)
        top = np.linalg.eigvalsh(whole)
        assert (np.diff(values) >= 0).all()
        assert np.abs(values - top).max() <= 1e-10 * top.max()
        assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-11
        assert np.abs(vectors * values @ vectors.T - whole).max() <= 1e-10 * top.max()


def test_secular_roots_close_to_poles_keep_their_digits():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0])
    z = np.array([1e-7, 0.5, 1e-9, 0.8])
    origin, x = whitening.secular_roots(d, z, 2.0)
    for j in range(4):
        away = (d - d[origin[j]]) - x[j]
        terms = 2.0 * z * z / away
        assert abs(1 + terms.sum()) <= 1e-12 * (1 + np.abs(terms).sum())
        assert d[j] <= d[origin[j]] + x[j] <= (d[j + 1] if j < 3 else 5 + 2 * (z @ z))


def test_spectra_combine_to_the_spectrum_of_all():
    dice = np.random.default_rng(2)
    rows = (dice.normal(size=(5000, 12)) * np.arange(1, 13) * 9).astype(np.int64)
    rows[:, 7] = rows[:, 3]
    whole = whitening.Spectrum.empty(12)
    for part in np.array_split(rows, 7):
        other = whitening.Spectrum.empty(12)
        other.add(part)
        whole.merge(whitening.Spectrum.from_row(*other.row(0)[1:]))
    apart = rows - rows.mean(axis=0)
    values = np.linalg.eigvalsh(apart.T @ apart)
    assert whole.n == 5000 and whole.sums == rows.sum(axis=0).tolist()
    assert np.allclose(whole.mean, rows.mean(axis=0))
    assert np.abs(whole.values - values).max() <= 1e-10 * values.max()


def test_query_equals_plain_numpy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = ALL["op13_whitening"](spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_hard_rows_and_a_hot_vector(spark):
    dice = np.random.default_rng(3)
    good = [(i, v) for i, v in enumerate((dice.normal(size=(200, 6)) * [9, 7, 5, 3, 1, 0.1]).tolist())]
    good += [(500, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])] * 400
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [1.0, 2.0]), (906, [1e30] * 6)]
    df = make(spark, good + bad).repartition(9)
    model = whitening.fit(df)
    found = whitening.whiten(df, model).collect()
    assert model.n == 201
    check(found, [i for i, _ in good], [v for _, v in good])


def test_many_small_partitions_combine_in_a_tree(spark):
    dice = np.random.default_rng(4)
    vectors = dice.normal(size=(3000, 5)).tolist()
    df = make(spark, list(enumerate(vectors))).repartition(300)
    points = whitening.gridded(df, 5, "vec_id", "embedding").repartition(300)
    whole = whitening._spectrum(points, 5)
    x = np.floor(256 * np.array(vectors, np.float32).astype(float))
    apart = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(apart.T @ apart)
    assert whole.n == 3000 and np.allclose(whole.values, values, rtol=1e-10)


def test_tables_without_variance(spark):
    empty = make(spark, [(1, [1.0])]).limit(0)
    assert whitening.fit(empty) is None and whitening.whiten(empty, None).collect() == []
    same = make(spark, [(1, [1.0, 2.0])] * 3)
    found = whitening.whiten(same, whitening.fit(same)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(found)] == [(1, 1, 0, None, 0.0, 0.0)] * 3 + [(2, 1, 0, None, 0.0, 0.0)] * 3
    line = make(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)])
    found = whitening.whiten(line, whitening.fit(line)).collect()
    assert {r.component for r in found if r.whitened is not None} == {1}
    assert all(r.explained == pytest.approx(1.0) for r in found if r.component == 1)


def test_deviations_beyond_64_bits_are_null():
    assert whitening.deviations(np.array([[2**40, 0]]), 2**30, (0, 0)) == [None]
    assert whitening.deviations(np.array([[3, 4]]), 10, (5, 5)) == [25**2 + 35**2]
    assert whitening.deviations(np.array([[2**31, 0]]), 1, (1, 0)) == [(2**31 - 1) ** 2]
