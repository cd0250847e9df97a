from __future__ import annotations

import numpy as np
import pytest

from spendlens.functions.quantiles import percentiles

WANTED = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def test_groups_of_any_size(spark):
    """The large group holds most rows and many ties."""
    rng = np.random.default_rng(7)
    groups = {
        "tiny": [3.0, 1.0], "one": [5.0], "same": [2.0] * 40, "mid": rng.normal(0, 1, 103).tolist(),
        "large": np.concatenate([rng.exponential(5, 50_000), np.full(20_000, 4.25)]).tolist(),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("tiny", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    found = {r.g: r for r in percentiles(df, ["g"], "v", WANTED).collect()}
    assert set(found) == set(groups)
    for name, values in groups.items():
        for column, share in WANTED.items():
            assert found[name][column] == pytest.approx(np.percentile(values, share * 100), abs=1e-9), (name, column)


@pytest.mark.parametrize("large", [0, 3, 1000])
def test_groups_of_every_size_by_either_way(spark, large):
    """Small groups by one window, large ones by buckets, mixed by the bound between them."""
    import random

    from spendlens.functions.quantiles import percentiles_of_counts

    rng = random.Random(large)
    rows = [(g, rng.choice([None, *map(float, range(n))]), rng.randrange(1, 4)) for g, n in (("a", 1), ("b", 3), ("c", 500), (None, 9)) for _ in range(400)]
    rows += [("empty", None, 2)]
    df = spark.createDataFrame(rows, "g string, x double, n int")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: r for r in percentiles_of_counts(df, ["g"], "x", "n", wanted, large).collect()}
    assert got.keys() == {"a", "b", "c", None, "empty"}
    for g in ("a", "b", "c", None):
        values = sorted(x for k, x, n in rows if k == g and x is not None for _ in range(n))
        for name, share in wanted.items():
            at = (len(values) - 1) * share
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert abs(got[g][name] - (low + (high - low) * (at - int(at)))) < 1e-9
    assert got["empty"].p50 is None
