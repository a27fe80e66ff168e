"""Catalogues of the basket and covariance studies come from the data."""

import datetime as dt

import pytest

from mercato.operators import portfolio
from mercato.plans import statistics


def _prices(spark, n):
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(d), f"C{a:02}", float(100 + a + (d * (a + 3)) % 17)) for d in range(20) for a in range(n)]
    return spark.createDataFrame(rows, "date date, asset string, price double")


def test_a_seventh_catalogue_takes_part(spark, monkeypatch):
    monkeypatch.setattr(statistics, "Tables", lambda *a: None)
    monkeypatch.setattr(statistics, "tracking", lambda t: None)
    monkeypatch.setattr(statistics, "daily_asset_prices", lambda t, days: _prices(spark, 7))
    assert sorted(r["pid"] for r in statistics.basket_simulation(spark, "").collect()) == list(range(1, 128))
    edges = statistics.partial_correlation_edges(spark, "").collect()
    assert {r["asset_b"] for r in edges} == {f"C{a:02}" for a in range(1, 7)} and len(edges) == 21


def test_more_assets_than_the_bound_are_an_error(spark):
    with pytest.raises(ValueError):
        portfolio.price_assets(_prices(spark, 17))
