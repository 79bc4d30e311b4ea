"""Print the SURVEY §2 coverage table (markdown): where each operator lives
and which registered queries exercise it (D = SQL oracle, P = rows-only)."""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from sparkmart.plans import registry  # noqa: E402

WHERE = {
    "S1": "sources/readers.read_data, operators/ingest.read_raw", "S2": "sources/readers.read_data (header on)",
    "S3": "sources/readers.read_legacy_csv", "S4": "sources/tables.table", "S5": "sources/readers.dated_path, read_partition",
    "S6": "sources/readers.jdbc_options, read_jdbc", "S7": "sources/readers.read_typed_csv",
    "S8": "sources/readers.read_json_flat, flatten; operators/pages.parse_category_tree",
    "S9": "sources/readers.run_sql_file",
    "K1": "sources/writers.write_partitioned, operators/ingest.write_silver", "K2": "config.TableConfig.extra_partition_columns",
    "K3": "sources/writers.write_partitioned (format check)", "K4": "sources/writers.write_data_product",
    "K5": "sources/model_store.save_versioned, save_table_versioned (scaler)", "K6": "sources/model_store.load_latest, list_versions",
    "K7": "sources/model_store.control_record, write_control_file", "K8": "sources/writers.replace_table",
    "K9": "sources/writers.append_table", "K10": "sources/writers.external_table", "K11": "sources/writers.create_and_load",
    "K12": "sources/writers.publish", "K13": "sources/writers.write_json_lines", "K14": "sources/model_store.keep_versions (model versions only)",
    "P1": "operators/ingest.column_expr", "P2": "operators/ingest.column_expr (new_columns)",
    "P3": "functions/rules.apply_trims", "P4": "functions/rules.parse_temporal", "P5": "functions/rules.parse_temporal",
    "P6": "operators/ingest.column_expr (round)", "P7": "functions/rules.typed", "P8": "operators/ingest.enrich (select)",
    "P9": "operators/ingest.enrich", "P10": "operators/ingest.partition_columns", "P11": "operators/clean.clean_transactions",
    "P12": "operators/series.pivot_counts (prefix), DataFrame drop/rename", "P13": "operators/profile.schema_listing",
    "P14": "functions/columns.safe_long_id, functions/rules.typed",
    "F1": "operators/rfm.drop_anonymous", "F2": "operators/profile.null_profile", "F3": "filters in plans/reports",
    "F4": "operators/profile.defects, line_class", "F5": "plans/reports.negative_brand_lines",
    "F6": "plans/reports.negative_brand_lines", "F7": "operators/profile.code_length_counts",
    "F8": "operators/basket.market_lines", "F9": "operators/profile.quality_probes", "F10": "operators/profile.line_class",
    "F11": "operators/profile.iqr_fence", "F12": "operators/profile.zscore_filter", "F13": "operators/profile.with_row_id",
    "F14": "operators/profile.drop_incomplete, operators/forecast.lag_frame",
    "N1": "operators/clean.clean_transactions", "N2": "operators/series.daily_series (coalesce 0)",
    "N3": "operators/rfm.recency_features (fallback to recency)", "N4": "operators/ingest.deduplicate",
    "N5": "operators/profile.keep_first_last; operators/rfm.owned_invoices", "N6": "operators/ingest.add_surrogate_key (sequence.dense_index)",
    "N7": "operators/profile.duplicate_rows", "N8": "operators/profile.row_counts",
    "J1": "operators/rfm.customer_profile", "J2": "operators/rfm.customer_profile", "J3": "operators/clean.repair_descriptions",
    "J4": "operators/series.daily_series (one conditional aggregate)", "J5": "operators/series.with_label_counts (inner join of the labels)",
    "J6": "operators/series.with_label_counts", "J7": "operators/series.add_holidays", "J8": "operators/basket (FPGrowth; SQL oracle self-join)",
    "J9": "crossJoin(broadcast(one-row aggregate)) in profile/segment/series",
    "A1": "operators/rfm", "A2": "operators/rfm", "A3": "operators/rfm.invoice_lines", "A4": "operators/rfm.monthly_features",
    "A5": "operators/series.daily_series", "A6": "operators/series.daily_series", "A7": "operators/clean.description_mode",
    "A8": "operators/profile.sum_by", "A9": "operators/profile.value_counts", "A10": "operators/profile.null_profile",
    "A11": "operators/profile.describe", "A12": "operators/series.pivot_counts", "A13": "operators/basket.baskets",
    "A14": "operators/quantiles.exact_quantiles, profile.describe", "A15": "operators/segment.single_cluster_inertia",
    "A16": "operators/interpret.classification_metrics", "A17": "operators/profile.correlation_long",
    "A18": "operators/profile.monthly_growth", "A19": "operators/profile.row_counts",
    "W1": "operators/rfm.owned_invoices, invoice_gaps (sequence.previous_rows)", "W2": "operators/rfm.recency_features",
    "W3": "operators/rfm.recency_features", "W4": "operators/rfm.customer_profile (compat flag)",
    "W5": "operators/interpret.top_features", "W6": "operators/series.add_lags", "W7": "operators/series.add_sma",
    "W8": "operators/series.add_sma(lagged=True)", "W9": "operators/series.autocorrelation", "W10": "operators/series.spectrum",
    "W11": "operators/series.calendar_features", "W12": "operators/series.time_series_folds",
    "W13": "operators/series.chronological_split", "W14": "operators/profile.head_tail, top_n",
    "T1": "operators/profile.top_n", "T2": "operators/profile.top_n(ascending_after)", "T3": "operators/interpret.top_features",
    "T4": "orderBy in plans/reports", "T5": "operators/basket.association_rules (sort by lift)",
    "U1": "sources/tables.union_all", "U2": "operators/interpret.unexplained_groups",
    "X1": "functions/rules.apply_trims", "X2": "operators/clean", "X3": "operators/profile.quality_probes",
    "X4": "operators/pages (URL_ID_PATTERN)", "X5": "operators/pages.path_levels", "X6": "operators/pages.slug",
    "X7": "functions/rules.parse_temporal, date_format", "X8": "year/month/dayofmonth/hour in ingest, series, reports",
    "X9": "functions/columns.round_half_up, ratio_half_up; operators/ingest.column_expr (round)", "X10": "operators/series.daily_series (abs)",
    "X11": "functions/columns.days_between", "X12": "operators/profile.quality_probes (startswith)",
    "X13": "explode(array(struct)) in interpret / segment", "X14": "operators/basket (size)", "X15": "operators/pages.zip_reviews, page_paragraphs",
    "X16": "functions/columns.binarize", "X17": "operators/pages.parse_category_tree, plans/pages.event_props",
    "X18": "functions/rules.typed (try_cast)",
    "M1": "operators/segment.robust_scale", "M2": "operators/profile.minmax_scale", "M3": "operators/segment.lloyd, inertia_sweep",
    "M4": "operators/segment.find_optimal_k", "M5": "operators/segment.cluster", "M6": "operators/segment.silhouette, silhouette_per_sample",
    "M7": "operators/interpret.holdout_split", "M8": "operators/boosting.binned, grow, search, root_gains; operators/interpret.train_interpreter", "M9": "operators/interpret.evaluate",
    "M10": "operators/interpret.retrain_decision", "M11": "operators/interpret.permutation_importance, partner",
    "M12": "operators/interpret.top_features", "M13": "operators/interpret.top_features, anomaly_exists",
    "M14": "operators/segment.segment_customers + interpret.interpret_clusters", "M15": "operators/interpret.surrogate_report, tree_rules",
    "M16": "operators/boosting.grow, root_gains; operators/interpret.class_report, surrogate_report", "M17": "operators/interpret.permutation_importance(group_col=None)",
    "M18": "not owed (inactive in the reference)", "M19": "operators/basket.frequent_itemsets", "M20": "operators/basket.association_rules",
    "M21": "operators/forecast.lag_cross_validation", "M22": "operators/forecast.sma_cross_validation",
    "M23": "operators/forecast.demand_features, random_search, fit_and_score; boosting.search", "M24": "operators/series.forecast_metrics, mean_baseline",
    "M25": "sources/model_store (Spark ML persistence)",
    "Q1": "config.parse_config", "Q2": "config._column", "Q3": "config.parse_config", "Q4": "config.validate_args",
    "Q5": "config.validate_uri", "Q6": "operators/ingest.null_violations, checked, quarantine", "Q7": "operators/ingest.quarantine (observed counts), logging",
    "C1": "operators/pages.url_frontier", "C2": "operators/pages.page_records", "C3": "operators/pages.path_levels",
    "C4": "operators/pages.page_paragraphs, zip_reviews", "C5": "operators/pages.page_links",
}


def main() -> None:
    cov = registry.coverage()
    orc = registry.oracle_sql()
    by_id: dict[str, list[str]] = {}
    for q, ids in cov.items():
        for i in ids:
            by_id.setdefault(i, []).append(f"`{q}`{'ᴰ' if q in orc else 'ᴾ'}")
    print("| ID | Implementation (under `sparkmart/`) | Registered queries |")
    print("| --- | --- | --- |")
    for i in WHERE:
        qs = ", ".join(sorted(set(by_id.get(i, [])))) or ("—" if WHERE[i].startswith("not ") else "unit tests")
        print(f"| {i} | {WHERE[i]} | {qs} |")


if __name__ == "__main__":
    main()
