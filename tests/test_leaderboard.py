"""The leaderboard and what follows it, with every kind of model cut down to a few trees."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelcraft.plans import models as m

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small(monkeypatch):
    """The kinds as they are, but of few trees and epochs (their sizes are tested below)."""
    def cut(x):
        return replace(x, hidden=(3,), epochs=4) if isinstance(x, m.Shape) else replace(x, trees=3)

    monkeypatch.setattr(m, "KINDS", {n: replace(k, members=tuple(map(cut, k.members))) for n, k in m.KINDS.items()})


def test_sizes_are_the_published_ones():
    k = m.KINDS
    assert list(k) == ["rf_balanced", "rf_smote", "extra_trees", "gbt_balanced", "gbt_pos_weight", "gbt_smote", "mlp_smote", "soft_vote", "balanced_rf"]
    trees = {n: [g.trees for g in x.members] for n, x in k.items() if n != "mlp_smote"}
    assert trees == {"rf_balanced": [500], "rf_smote": [500], "extra_trees": [500], "gbt_balanced": [400], "gbt_pos_weight": [400],
                     "gbt_smote": [350], "soft_vote": [300, 300, 300], "balanced_rf": [500]}
    assert k["gbt_balanced"].members[0].max_leaves == 15 and k["gbt_pos_weight"].members[0].l2 == 3 and k["gbt_smote"].members[0].l2 == 2
    assert k["mlp_smote"].members[0] == m.Shape(hidden=(128, 64, 32), l2=0.01, epochs=1000)
    assert {n for n, x in k.items() if x.smote} == {"rf_smote", "gbt_smote", "mlp_smote"}


def test_leaderboard_gap_and_champion(spark, small):
    board = m.model_leaderboard(spark, SF).collect()
    assert len(board) == 9 and {r["model"] for r in board} == set(m.KINDS)
    assert [r["f1"] for r in board] == sorted((r["f1"] for r in board), reverse=True)
    n = {r["tp"] + r["fp"] + r["fn"] + r["tn"] for r in board}
    assert len(n) == 1 and all(0 <= r["cv_f1"] <= 1 for r in board)
    gap = m.cv_test_gap(spark, SF).collect()
    assert len(gap) == 8
    scores = m.champion_scores_values(spark, SF)
    assert scores.columns == ["entity", "grp", "year", "flag", "risk_score"]
    assert scores.count() == scores.select("entity", "year").distinct().count() == 70
    assert scores.where(~F.col("risk_score").between(0, 1)).count() == 0


def test_single_queries_hold_their_checks(spark, small):
    for name in ("rf_smote", "balanced_rf"):
        r = getattr(m, name)(spark, SF).first()
        assert r["threshold_on_grid"] and r["rates_match_counts"] and r["n"] > 0
    assert m.model_save_load_score(spark, SF).where("not same_as_in_memory or not has_decision").count() == 0
    assert m.batch_score(spark, SF).where("not has_score").count() == 0
    assert {r["fold"] for r in m.cv_f1(spark, SF).collect()} == set(range(5))
    assert m.feature_importance(spark, SF).count() == 15
    r = m.feature_importance_check(spark, SF).first()
    assert r["n"] == r["n_features"] == len(m.c.FEATURES) and r["in_range"] and r["sums_to_one"] and r["differ"] and r["banded"]
    assert m.group_risk_check(spark, SF).where("not mean_matches").count() == 0
    assert m.group_risk_from_model(spark, SF).count() > 0


def test_registered_values_are_the_models_own(spark, small):
    import __spark_entry__ as e
    q = e.queries()
    assert {f"{k}_values" for k in ("rf_balanced", "rf_smote", "gbt_balanced", "gbt_pos_weight", "gbt_smote", "mlp_smote", "balanced_rf",
                                    "soft_vote_ensemble", "batch_score", "cv_f1", "champion_scores", "model_save_load_score")} <= set(q)
    r = q["rf_balanced_values"](spark, SF).first()
    assert set(m.RATES + m.COUNTS + ["threshold"]) <= set(r.asDict())
    assert q["batch_score_values"](spark, SF).select("score").distinct().count() > 1
    assert 0 <= q["cv_f1_values"](spark, SF).first()["cv_f1"] <= 1
    assert q["model_save_load_score_values"](spark, SF).select("score").distinct().count() > 1


def test_models_of_a_leaderboard_share_the_synthetic_rows(spark, small, monkeypatch):
    made, own = [], m._with_smote
    monkeypatch.setattr(m, "_with_smote", lambda train: made.append(1) or own(train))
    monkeypatch.setattr(m, "KINDS", {n: k for n, k in m.KINDS.items() if k.smote})
    board = m.model_leaderboard(spark, SF).collect()
    assert {r["model"] for r in board} == {"rf_smote", "gbt_smote", "mlp_smote"} and len(made) == 1
