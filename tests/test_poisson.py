import numpy as np
import pytest
from pyspark.sql import functions as F

from wordtide.functions import poisson


@pytest.mark.parametrize(
    "total,samples,width",
    [
        (0, 1, 7.425117), (1, 1, 7.425117), (5, 1, 13.071831), (20, 1, 24.314731),
        (100, 1, 52.640084), (0, 4, 2.980471), (20, 4, 11.803974), (100, 4, 26.023736),
        (20, 6, 9.591057),
    ],
)
def test_interval_width(total, samples, width):
    assert poisson.interval_width(np.array([total]), samples)[0] == pytest.approx(width, abs=1e-6)


def test_quantiles():
    assert poisson.chi_squared_quantile(0.995, np.array([10.0]))[0] == pytest.approx(25.188180, abs=1e-6)
    assert poisson.chi_squared_quantile(0.005, np.array([10.0]))[0] == pytest.approx(2.155856, abs=1e-6)


@pytest.mark.parametrize("alpha", [0.5, 0.9, 0.99, 0.999])
def test_against_a_second_implementation(spark, alpha):
    """Spark's class path holds a chi-squared distribution of its own."""
    law = spark._jvm.org.apache.commons.math3.distribution.ChiSquaredDistribution
    tail = (1 - alpha) / 2
    degrees = np.array([2.0, 4.0, 7.0, 40.0, 333.0, 2000.0, 9_998.0, 10_002.0, 200_000.0])
    for p in (tail, 1 - tail):
        mine = poisson.chi_squared_quantile(p, degrees)
        theirs = [law(float(d)).inverseCumulativeProbability(p) for d in degrees]
        assert np.allclose(mine, theirs, rtol=1e-9, atol=1e-7)


def test_quantiles_grow_evenly():
    """Neighbouring degrees differ by the same step wherever they are: there is no seam."""
    for at in (4_000.0, 10_000.0, 1e6):
        around = poisson.chi_squared_quantile(0.995, at + np.arange(6.0))
        steps = np.diff(around)
        assert np.abs(np.diff(steps, 2)).max() < 1e-7


@pytest.mark.parametrize("alpha", [1 - 1e-9, 1e-6])
def test_extreme_levels(spark, alpha):
    law = spark._jvm.org.apache.commons.math3.distribution.GammaDistribution
    tail = (1 - alpha) / 2
    degrees = np.array([2.0, 9.0, 400.0, 30_000.0, 4e6])
    for p in (tail, 1 - tail):
        for d, y in zip(degrees, poisson.chi_squared_quantile(p, degrees)):
            assert law(d / 2, 1.0).cumulativeProbability(y / 2) == pytest.approx(p, rel=1e-6, abs=1e-13)


def test_very_large_counts():
    width = poisson.interval_width(np.array([1e6, 1e9, 1e12]), 1)
    assert np.allclose(width, 1 + 2 * 2.5758293035489 * np.sqrt([1e6, 1e9, 1e12]), rtol=1e-5)


@pytest.mark.parametrize("samples", [1, 2, 4, 6, 30])
@pytest.mark.parametrize("textbook", [False, True])
def test_floor_is_below_the_width(spark, samples, textbook):
    totals = spark.range(0, 3000).unionAll(spark.range(10_000, 1_000_000, 9_973))
    for alpha in (0.5, 0.99):
        worst = totals.select(
            F.min(
                poisson.poisson_ci(F.col("id"), samples, alpha, textbook)
                - poisson.poisson_ci_floor(F.col("id"), samples, alpha, textbook)
            )
        ).first()[0]
        assert worst > 0


def test_textbook_drops_a_factor():
    assert poisson.interval_width(np.array([20]), 4, textbook=True)[0] == pytest.approx(24.314731 / 4, abs=1e-6)
    assert poisson.interval_width(np.array([20]), 1, textbook=True)[0] == pytest.approx(24.314731, abs=1e-6)
