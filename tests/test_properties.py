"""Property checks (hypothesis, few examples: every example runs Spark jobs)."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wakeline.functions import psi_term
from wakeline.operators.quantiles import exact_quantiles
from wakeline.operators.stats import chi2_sf, f_sf

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.floats(0.01, 1.0), min_size=2, max_size=8), st.integers(0, 2**31 - 1))
def test_psi_non_negative(spark, weights, seed):
    rnd = np.random.default_rng(seed)
    ref = np.array(weights) / sum(weights)
    comp = rnd.dirichlet(np.ones(len(weights)))
    df = spark.createDataFrame([(float(c), float(r)) for c, r in zip(comp, ref)], "c double, r double")
    assert df.select(F.sum(psi_term("c", "r"))).first()[0] >= -1e-12


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=300),
       st.integers(2, 50), st.sampled_from([2, 3, 16]))
def test_exact_quantiles_equal_numpy(spark, values, limit, buckets):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    probs = {"a": 0.1, "b": 0.5, "c": 0.9}
    got = exact_quantiles(df, ["g"], "v", probs, method="linear", exact_limit=limit, n_buckets=buckets).first()
    want = np.quantile(np.array(values), [0.1, 0.5, 0.9])
    assert [got.a, got.b, got.c] == pytest.approx(list(want), rel=1e-9, abs=1e-6)


# Closed forms for an even numerator df (the form the DuckDB oracles use):
# P(F > f) = sum_{j < d1/2} G(a + j) / (G(a) j!) x^a (1 - x)^j, a = d2/2, x = d2/(d2 + d1 f)
# P(X > h) = sum_{i < k/2} e^-y y^i / i!, y = h/2
def _f_sf_even(f, d1, d2):
    a, x = d2 / 2.0, d2 / (d2 + d1 * f)
    return sum(math.exp(math.lgamma(a + j) - math.lgamma(a) - math.lgamma(j + 1) + a * math.log(x)
                        + (j * math.log1p(-x) if j else 0.0)) for j in range(d1 // 2))


def _chi2_sf_even(h, k):
    y = h / 2.0
    return sum(math.exp(-y - math.lgamma(i + 1) + (i * math.log(y) if i else 0.0)) for i in range(k // 2))


@settings(max_examples=200, deadline=None)
@given(st.floats(1e-4, 60.0), st.integers(1, 6), st.integers(1, 5000))
def test_f_tail_matches_even_df_series(f, half_d1, d2):
    d1 = 2 * half_d1
    assert f_sf(f, d1, d2) == pytest.approx(_f_sf_even(f, d1, d2), rel=1e-8, abs=1e-12)


@settings(max_examples=200, deadline=None)
@given(st.floats(1e-4, 200.0), st.integers(1, 8))
def test_chi2_tail_matches_even_df_series(h, half_k):
    k = 2 * half_k
    assert chi2_sf(h, k) == pytest.approx(_chi2_sf_even(h, k), rel=1e-8, abs=1e-12)


@pytest.mark.parametrize("d2", [1e9, 1e12, 1e15])
def test_f_tail_at_large_df_is_the_chi2_tail(d2):
    for d1, f in [(4, 0.9), (4, 8.0), (3, 2.5), (1, 0.1)]:
        assert f_sf(f, d1, d2) == pytest.approx(chi2_sf(d1 * f, d1), abs=1e-8)


def test_f_tail_is_smooth_where_the_form_changes():
    for d1, f in [(4, 0.9), (4, 8.0), (3, 2.5), (10, 1.5)]:
        assert f_sf(f, d1, 1e6) == pytest.approx(f_sf(f, d1, 1e6 + 1), abs=1e-9)
