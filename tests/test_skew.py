"""A township holding most parcels, by the ranked layout and by selection, against a
brute-force pandas/numpy computation of the same statistics."""

import random
from functools import partial

import numpy as np
import pandas as pd
import pytest

from parcelbeam.operators import ratio as R

SCHEMA = ("pin string, township_name string, neighborhood_number string, sale_price double, "
          "model_value double, desk_review_value double")


def _rows(n=2400, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        town = "HOT" if rnd.random() < 0.6 else f"T{rnd.randint(0, 4)}"
        price = float(rnd.choice([rnd.randint(50, 900) * 1000, 250000]))  # many ties at 250,000
        if rnd.random() < 0.05:
            price = None
        model = round(price * rnd.uniform(0.7, 1.3)) if price else float(rnd.randint(50, 900) * 1000)
        desk = round(model * rnd.uniform(0.9, 1.1))
        rows.append((f"{i:014d}", town, f"{town}-N{rnd.randint(0, 3)}", price, float(model), float(desk)))
    return rows


def _brute(rows):
    df = pd.DataFrame(rows, columns=["pin", "town", "nbhd", "p", "model", "desk"])
    out = {}
    for town, g in df[df.p.notna()].groupby("town"):
        g = g.sort_values(["p", "pin"])
        n = len(g)
        i = np.arange(1, n + 1)
        res = {"number_of_sales": n}
        for stage, col in (("model", "model"), ("desk_review", "desk")):
            a, p = g[col].to_numpy(), g.p.to_numpy()
            r = a / p
            m = float(np.median(r))
            res[f"{stage}_ratio"] = m
            res[f"{stage}_cod"] = 100 * np.mean(np.abs(r - m)) / m
            res[f"{stage}_prd"] = r.mean() / (a.sum() / p.sum())
            res[f"{stage}_prb"] = np.polyfit(np.log2(0.5 * (a / m + p)), (r - m) / m, 1)[0]
            ga = (2 * (i * a).sum() / a.sum() - (n + 1)) / n
            gp = (2 * (i * p).sum() / p.sum() - (n + 1)) / n
            res[f"{stage}_mki"] = ga / gp
        out[town] = res
    return out


@pytest.mark.parametrize("most", [10_000, 50])
def test_hot_township_matches_brute_force(spark, monkeypatch, most):
    rows = _rows()
    monkeypatch.setattr(R, "select_ranks", partial(R.select_ranks, most=most, buckets=16))
    base = R.add_ratios(spark.createDataFrame(rows, SCHEMA))
    got = {r["township_name"]: r for r in R.town_stats(R.rank_by_price(base)).collect()}
    study = R.add_price_deciles(base)
    deciles = study.filter("sale_price is not null").groupBy("township_name", "price_decile").count().collect()
    want = _brute(rows)
    assert set(got) == set(want)
    for town, exp in want.items():
        for k, v in exp.items():
            assert got[town][k] == pytest.approx(v, abs=2e-6), (town, k)
    # NTILE sizes: the first n % 10 buckets hold one more row
    sizes = {}
    for r in deciles:
        sizes.setdefault(r["township_name"], {})[r["price_decile"]] = r["count"]
    for town, b in sizes.items():
        n = want[town]["number_of_sales"]
        assert [b[k] for k in range(1, 11)] == [n // 10 + (1 if k <= n % 10 else 0) for k in range(1, 11)]
