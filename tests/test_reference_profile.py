import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluiceway.operators import drift
from sluiceway.operators.drift import check_drift, chi2_statistics, ks_narrowed, ks_statistics, psi_bins, psi_scores
from sluiceway.operators.reference_profile import ReferenceProfile, merge_profiles, store_profile

ROWS = 1000


def _tables(spark):
    rng = np.random.default_rng(5)

    def make(n, shift, tail):
        return pd.DataFrame(
            {
                "spread": 10 ** rng.uniform(-200, 200 + tail, n),
                "one": np.ones(n),
                "hot": np.where(rng.random(n) < 0.4, 3.0, rng.normal(shift, 1, n)),
                "whole": rng.integers(0, 50, n),
                "kind": rng.choice(["a", "b", "c"], n, p=[0.5, 0.3, 0.2]),
                "id": [f"id{shift}-{i}" for i in range(n)],
            }
        )

    return make(ROWS, 0.0, 0), make(ROWS // 2, 0.1, 5)


def _brute(a, b):
    a, b = np.sort(a), np.sort(b)
    x = np.concatenate([a, b])
    return abs(np.searchsorted(a, x, side="right") / len(a) - np.searchsorted(b, x, side="right") / len(b)).max()


@pytest.mark.parametrize("window_rows", [1_000_000, 60])
def test_ks_equals_brute_force_whatever_the_window(spark, monkeypatch, window_rows):
    monkeypatch.setattr(drift, "KS_BINS", 4)
    monkeypatch.setattr(drift, "KS_CUTS", 16)
    ref, cur = _tables(spark)
    found = ks_statistics(spark.createDataFrame(ref), spark.createDataFrame(cur), window_rows=window_rows).collect()
    assert {r.column for r in found} == {"spread", "one", "hot", "whole"}
    for r in found:
        assert r.ks == pytest.approx(_brute(ref[r.column], cur[r.column]), abs=1e-15)


def test_windows_hold_no_more_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(drift, "KS_CUTS", 4)
    values = spark.range(500).select(
        F.lit(0).alias("r"), F.lit(0).cast("bigint").alias("cell"), F.exp(F.col("id").cast("double")).alias("v"),
        (F.col("id") % 2).alias("n_ref"), ((F.col("id") + 1) % 2).alias("n_cur"),
    )
    cells = spark.createDataFrame([(0, 0, 0, 0, 250, 250)], "r int, cell bigint, ref_before bigint, cur_before bigint, ref_rows bigint, cur_rows bigint")
    ranked, best = ks_narrowed(values, cells, spark.createDataFrame([(0, 0.0)], "r int, best double"), 7)
    assert (ranked.groupBy("r", "cell").count().agg(F.max("count")).first()[0] or 0) <= 7
    assert best.first().best <= 1 / 250 + 1e-15


@pytest.fixture
def stored(spark, tmp_path):
    ref, cur = map(spark.createDataFrame, _tables(spark))
    return ref, cur, store_profile(ref, str(tmp_path / "whole"))


def _rows(df, *keys):
    return sorted(map(tuple, df.select(*keys).collect()))


def test_profile_gives_the_same_results_as_the_table(spark, stored, tmp_path):
    ref, cur, profile = stored
    parts = [store_profile(ref.where(f"whole % 2 = {i}"), str(tmp_path / f"part{i}")) for i in range(2)]
    for p in (profile, merge_profiles(parts, str(tmp_path / "merged"))):
        again = ReferenceProfile(spark, p.path)
        keys = ("column", "ref_rows", "cur_rows", "ks")
        assert _rows(again.ks_statistics(cur), *keys) == _rows(ks_statistics(ref, cur), *keys)
        for buckets in (10, 7):
            keys = ("r", "column", "status", "ref_rows", "cur_rows", "bin", "n_ref", "n_cur")
            assert _rows(again.psi_bins(cur, buckets=buckets), *keys) == _rows(psi_bins(ref, cur, buckets=buckets), *keys)
        keys = ("column", "categories", "ref_share")
        assert _rows(again.chi2_statistics(cur), *keys) == _rows(chi2_statistics(ref, cur), *keys)
        mine, other = again.check_drift(cur).first(), check_drift(ref, cur).first()
        assert (mine.dataset_drift, mine.drift_score, mine.drifted_columns) == (other.dataset_drift, other.drift_score, other.drifted_columns)
        assert mine.details.keys() == other.details.keys()
        assert all(mine.details[c] == pytest.approx(other.details[c]) for c in mine.details)


def test_current_tables_alone_are_scanned(spark, stored):
    ref, cur, profile = stored
    ref.unpersist()
    plan = profile.psi_scores(cur)._jdf.queryExecution().optimizedPlan().toString()
    assert "numbers" not in plan and "psi_bins" in str(profile.psi_scores(cur).inputFiles())


def test_odd_columns(spark, tmp_path):
    schema = "a double, b double, c string, d double, is_ref string"
    ref = spark.createDataFrame([(1.0, math.inf, None, None, "x"), (math.nan, 2.0, None, None, "y"), (3.0, None, None, None, "x")], schema)
    cur = spark.createDataFrame([(2.0, 1.0, "q", 1.0, "x"), (None, -math.inf, None, None, "x")], schema)
    profile = store_profile(ref, str(tmp_path / "odd"))
    keys = ("column", "psi", "status")
    assert _rows(profile.psi_scores(cur).fillna(-1.0), *keys) == _rows(psi_scores(ref, cur).fillna(-1.0), *keys)
    keys = ("column", "ks")
    assert _rows(profile.ks_statistics(cur), *keys) == _rows(ks_statistics(ref, cur), *keys)
    empty = store_profile(ref.where("false"), str(tmp_path / "empty"))
    assert empty.ks_statistics(cur).count() == 0 and {r.status for r in empty.psi_scores(cur).collect()} == {"empty_reference"}
    assert profile.ks_statistics(cur.select("c")).count() == 0
    with pytest.raises(ValueError):
        merge_profiles([profile, store_profile(ref.select("a"), str(tmp_path / "other"))], str(tmp_path / "mixed"))
