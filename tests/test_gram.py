"""Blocked correlations against the plain formula over pairs of columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import gram
from millrace.operators import stats as Q


def plain(x, y):
    """None where there is nothing to tell, NaN where a value isn't finite."""
    both = [(a, b) for a, b in zip(x, y, strict=True) if a is not None and b is not None]
    if any(not math.isfinite(v) for pair in both for v in pair):
        return "NaN"
    if len(both) < 2 or len({a for a, _ in both}) == 1 or len({b for _, b in both}) == 1:
        return None
    return np.corrcoef(np.array(both).T)[0, 1]


@pytest.mark.parametrize("block", [1, 3, 4, 128])
def test_equals_the_plain_formula(spark, block):
    r = np.random.default_rng(block)
    n, columns = 120, 10
    data = r.normal(size=(n, columns)) * 10.0 ** r.integers(-3, 4, columns) + 1e5 * r.integers(0, 2, columns)
    data[:, 1] = data[:, 0] * 3 + data[:, 1]
    rows = [[None if r.random() < 0.1 * (c % 3) else float(v) for c, v in enumerate(row)] for row in data]
    for row in rows:
        row[8], row[9] = 0.1, None  # a constant, and no values at all
    rows[7][5] = float("nan")
    rows[9][6] = float("inf")
    names = [f"x{c}" for c in range(columns)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    got = gram.correlations(gram.gram_blocks(df, names, block), block).collect()
    assert len(got) == len({(g.i, g.j) for g in got}) == columns * columns
    for g in got:
        want = plain([row[g.i] for row in rows], [row[g.j] for row in rows])
        if want == "NaN":
            assert math.isnan(g.corr)
        else:
            assert g.corr == (want if want is None else pytest.approx(want, abs=1e-9))


def test_many_columns_leave_a_task_as_blocks(spark, plan):
    names = [f"x{c}" for c in range(300)]
    df = spark.range(500).select(*[F.sin(F.col("id") * (c + 1)).alias(name) for c, name in enumerate(names)])
    blocks = gram.gram_blocks(df, names)
    assert blocks.count() == 6  # three blocks of columns
    assert "Generate" not in plan(blocks)
    corr = Q.corr_matrix(df, names)
    assert corr.count() == 300 * 300 and corr.where("a = b AND abs(corr - 1) > 1e-9").isEmpty()


def test_no_rows(spark):
    assert Q.corr_matrix(spark.createDataFrame([], "a double, b int"), ["a", "b"]).count() == 0
