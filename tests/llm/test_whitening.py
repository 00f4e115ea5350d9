import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylake.llm import whitening

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    """(vec_id, component) to (n, deviation, |whitened|, explained), by dense algebra on all rows."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(x) for _, x in good)
    good = [(i, x + [0] * (width - len(x))) for i, x in good]
    held = sorted({tuple(x) for _, x in good})
    n, sums = len(held), np.array(held, object).sum(axis=0)
    centre = np.array([s / n for s in sums])
    a = np.array(held, float) - centre
    cov = a.T @ a / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    out = []
    for i, x in good:
        dev = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        w = (np.array(x) - centre) @ vectors / np.sqrt(values)
        out += [(i, k + 1, n, dev, abs(w[k]), values[k] / np.trace(cov)) for k in range(len(values))]
    return sorted(out)


def found(df):
    return sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in df.collect())


def same(one, other):
    assert len(one) == len(other)
    for a, b in zip(one, other):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-6, abs=1e-8)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS)


def test_equals_dense_algebra(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(whitening, "COLS_PER_BLOCK", 4)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    monkeypatch.setattr(whitening, "PANEL", 100)
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(9, 9)) * np.linspace(3, 0.2, 9)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(150, 9)) @ mix)]
    rows += [(500 + i, rows[3][1]) for i in range(80)] + [(600, None), (601, [None] * 9), (602, [float("nan")] * 9), (603, [float("inf")] + [0.0] * 8)]
    got = whitening.op11_whitening(table(spark, rows).repartition(4))
    same(found(got), brute(rows))
    assert {r[0] for r in got.select("identity_error").distinct().collect()}.pop() < 1e-9


def test_short_vectors_are_filled_up(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3 if i % 5 else 2)]) for i in range(30)]
    rows += [(None, rows[0][1]), (7, rows[0][1])]
    got = whitening.op11_whitening(table(spark, rows))
    assert got.where("vec_id is null").count() == 3
    same(found(got.where("vec_id is not null")), brute([r for r in rows if r[0] is not None]))


def test_signs_and_order_hold_for_all_rows(spark):
    """Whitened columns are those of one matrix: their inner products over the distinct rows are n times the identity."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(60, 5)))]
    wide = whitening.op11_whitening(table(spark, rows)).groupBy("vec_id").pivot("component", [1, 2, 3, 4]).agg(F.first("whitened")).toPandas()
    w = wide[["1", "2", "3", "4"]].to_numpy()
    assert np.abs(w.T @ w / 60 - np.eye(4)).max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [])], [(1, [0.5]), (2, [0.5]), (None, [0.5])]])
def test_nothing_varies(spark, rows):
    got = whitening.op11_whitening(table(spark, rows))
    assert got.count() == 0
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_components_than_asked(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    got = whitening.op11_whitening(table(spark, rows)).withColumn("__id", F.lit(0))
    assert {(r.component, round(r.explained, 9)) for r in got.collect()} == {(1, 1.0)}


def test_clashing_columns_and_too_large(spark):
    df = table(spark, [(i, [float(i % 3), float(i % 5)]) for i in range(20)])
    extra = df.withColumns({c: F.lit("own") for c in ("x", "index", "values", "__id", "__at", "__task", "at", "component", "a.b")})
    same(found(whitening.op11_whitening(extra)), found(whitening.op11_whitening(df)))
    with pytest.raises(Exception, match="too large"):
        whitening.op11_whitening(table(spark, [(1, [1e20]), (2, [1.0])])).count()
