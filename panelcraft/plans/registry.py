"""Key -> bound query, and key -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelcraft.plans import catalog as c
from panelcraft.plans import models as m
from panelcraft.plans.oracle import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources, cleaning, panel
    "season_features": c.season_features,
    "panel_scaffold": c.panel_scaffold,
    "membership_panel": c.membership_panel,
    "panel_left_join": c.panel_left_join,
    "panel_dim_join": c.panel_dim_join,
    "feature_panel": c.feature_panel,
    "dedupe_keep_first": c.dedupe_keep_first,
    "date_key_parts": c.date_key_parts,
    "json_series_flatten": c.json_series_flatten,
    "payload_daily_series": c.payload_daily_series,
    "sentinel_clamp": c.sentinel_clamp,
    "literal_lookup_table": c.literal_lookup_table,
    # rules and encodings
    "rule_cascade_risk": c.rule_cascade_risk,
    "intensity_bucket": c.intensity_bucket,
    "dictionary_encode": c.dictionary_encode_q,
    "composite_score": c.composite_score,
    # statistical features
    "interaction_features": c.interaction_features,
    "fill_and_round": c.fill_and_round,
    "smoothed_prior": c.smoothed_prior,
    "smoothed_prior_group": c.smoothed_prior_group,
    "entity_anomaly": c.entity_anomaly,
    "period_pressure": c.period_pressure,
    "select_available": c.select_available,
    # profile and reporting
    "dataset_profile": c.dataset_profile,
    "value_counts": c.value_counts,
    "positives_per_year": c.positives_per_year,
    "class_balance": c.class_balance,
    "group_risk_rank": c.group_risk_rank,
    # evaluation without models
    "confusion_at": c.confusion_at,
    "binary_metrics": c.binary_metrics,
    "roc_auc": c.roc_auc,
    "roc_auc_overall": c.roc_auc_overall,
    "threshold_sweep": c.threshold_sweep,
    "report_sweep": c.report_sweep,
    "best_threshold": c.best_threshold,
    "roc_curve": c.roc_curve,
    "roc_corners": c.roc_corners,
    "roc_curves_top8": c.roc_curves_top8,
    "argmax_tuple": c.argmax_tuple,
    "topk_by_metric": c.topk_by_metric,
    "soft_vote": c.soft_vote,
    "quantile_bands": c.quantile_bands,
    # sampling and rebalancing
    "stratified_split": c.stratified_split,
    "stratified_folds": c.stratified_folds,
    "split_year_distribution": c.split_year_distribution,
    "standardize": c.standardize,
    "class_weights": c.class_weights,
    "balanced_bags": c.balanced_bags,
    "knn_topk": c.knn_topk,
    "smote_oversample": c.smote_oversample,
    # sources, sinks, streams
    "csv_roundtrip_scan": c.csv_roundtrip_scan,
    "optional_source_fallback": c.optional_source_fallback,
    "resume_pending_keys": c.resume_pending_keys,
    "append_union": c.append_union,
    "event_map_explode": c.event_map_explode,
    "date_spine": c.date_spine,
    "seasonal_weight": c.seasonal_weight,
    "stream_incremental_ingest": c.stream_incremental_ingest,
    "stream_payload_ingest": c.stream_payload_ingest,
    # models (checked by what SQL can state of their output)
    "rf_balanced": m.rf_balanced,
    "rf_smote": m.rf_smote,
    "extra_trees": m.extra_trees,
    "gbt_balanced": m.gbt_balanced,
    "gbt_pos_weight": m.gbt_pos_weight,
    "gbt_smote": m.gbt_smote,
    "mlp_smote": m.mlp_smote,
    "balanced_rf": m.balanced_rf,
    "soft_vote_ensemble": m.soft_vote_ensemble,
    "batch_score": m.batch_score,
    "feature_importance": m.feature_importance,
    "feature_importance_check": m.feature_importance_check,
    "group_risk_check": m.group_risk_check,
    "champion_scores": m.champion_scores,
    "cv_f1": m.cv_f1,
    "model_leaderboard": m.model_leaderboard,
    "model_save_load_score": m.model_save_load_score,
    "cv_test_gap": m.cv_test_gap,
    "group_risk_from_model": m.group_risk_from_model,
    # and the scores and metrics themselves
    **m.VALUES,
}

LONGEST = ["model_leaderboard", "cv_test_gap", "champion_scores", "champion_scores_values"]
#: queries that fit models, the longest last
MODEL_FITS = [k for k, f in QUERIES.items() if f.__module__ == m.__name__ and k not in LONGEST]
MODEL_FITS += LONGEST


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
