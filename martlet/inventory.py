"""Inventory: each operator ID of the blueprint -> implementing code -> registered jobs.

``INVENTORY[id] = (what, ["module:function", ...], ["job", ...], note)``. Functions
are dotted paths under ``martlet``; jobs are keys of ``registry.jobs()``. A test
checks that every function and job named here exists; ``python -m martlet.inventory``
prints the table as markdown.
"""

from __future__ import annotations

I = {}


def _add(ids: str, what: str, funcs: list[str], jobs: list[str], note: str = "") -> None:
    for i in ids.split(","):
        I[i.strip()] = (what, funcs, jobs, note)


# ---------------------------------------------------------------- sources and sinks
_add("S1", "typed CSV scan", ["sources.io:read_csv"], ["s5_csv_roundtrip"])
_add("S2", "Parquet scan", ["sources.tables:read_table", "sources.tables:Tables"], ["q1_monthly_gmv_rural_urban"])
_add("S3", "fact table sink, partitioned by month", ["sources.io:write_parquet"], ["s3_parquet_roundtrip"])
_add("S4", "KPI JSON sink", ["sources.io:write_json"], ["s4_kpi_json_roundtrip"])
_add("S5", "CSV sink", ["sources.io:write_csv"], ["s5_csv_roundtrip"])
_add("S6", "records JSON sink (JSON lines)", ["sources.io:write_json", "sources.io:sanitize"], ["s4_kpi_json_roundtrip"])
_add("S7", "records CSV sink", ["sources.io:write_csv", "sources.io:sanitize"], ["s5_csv_roundtrip"])
_add("S8", "content-named output", ["sources.io:content_fingerprint", "sources.io:content_name",
                                    "sources.io:write_content_named"], ["s8_content_fingerprint"])
_add("S9", "sanitize for charts", ["sources.io:sanitize"], ["s9_sanitize"])
_add("S10", "measurement type per column", ["sources.io:infer_measure_types"], [], "schema metadata; unit test")
_add("S11", "row-limit guard", ["sources.io:limit_rows"], ["s11_row_limit_guard"])
_add("S12", "sequence source", ["sources.io:sequence_source"], [], "literal input; unit test")
_add("S13", "schema applied at read", ["sources.tables:SCHEMAS", "sources.io:schema_for", "sources.tables:by_dtype"],
     ["q1_monthly_gmv_rural_urban"])
_add("S14", "catalog filter", ["sources.io:catalog", "sources.io:catalog_filter"], [], "metadata only")
_add("S15", "GeoJSON features", ["sources.io:geojson_features"], [], "no GeoJSON input; unit test")
_add("S16", "inline rows", ["sources.io:inline_rows"], [], "literal input; unit test")

# ---------------------------------------------------------------- projections, filters, predicates
_add("P1", "column pruning before joins", ["plans.fact:build_fact"], ["fact_sales"])
_add("P2", "margin", ["plans.fact:build_fact"], ["fact_sales", "q4_category_margin"])
_add("P3", "year_month", ["functions.numeric:year_month"], ["fact_sales", "q1_monthly_gmv_rural_urban"])
_add("P4", "delivered-only filter (pushed to the scan)", ["sources.mart:with_status"], ["fact_sales"])
_add("P5", "dashboard filters", ["plans.fact:filter_fact"], ["k3_filtered_kpis"])
_add("P6", "filter options", ["plans.fact:filter_options"], ["p6_filter_options"])
_add("P7", "segment label", ["plans.fact:segment"], ["d1_monthly_segment_revenue", "n2_rural_urban_split"])
_add("P8", "CASE WHEN inside aggregates", ["functions.numeric:sum_if", "functions.numeric:count_if"],
     ["q1_monthly_gmv_rural_urban", "q13_cancel_return_rate"])
_add("P9", "calculate", ["operators.transforms:calculate"], ["p9_calculate"])
_add("P10", "filter", ["operators.transforms:filter_"], ["p10_filter"])
_add("P11", "when / then / otherwise", ["operators.selections:when_chain"], ["p11_when_chain"])
_add("P12", "field predicates", ["operators.selections:field_equal", "operators.selections:field_range",
                                 "operators.selections:field_one_of", "operators.selections:field_lt",
                                 "operators.selections:field_valid"], ["p10_filter"])
_add("P13", "predicate algebra", ["operators.selections:and_", "operators.selections:or_",
                                  "operators.selections:not_"], ["p10_filter"])
_add("P14", "named parameters", ["operators.selections:sql_with_params"], ["p14_named_params"])
_add("P15", "point selection", ["operators.selections:point_select", "operators.selections:point_predicate"],
     ["p15_point_selection"])
_add("P16", "interval selection", ["operators.selections:interval_predicate"], ["p16_interval_selection"])
_add("P17", "index selection", ["operators.selections:index_select"], ["p17_index_selection"])
_add("P18", "selection resolve", ["operators.selections:resolve"], ["p18_selection_resolve"])
_add("P19", "tolerance match", ["operators.joins:within_delta", "operators.joins:tolerance_join"],
     ["p19_tolerance_join"])
_add("P20", "invalid filter", ["operators.selections:drop_invalid"], ["p20_invalid_filter"])

# ---------------------------------------------------------------- joins
_add("J1", "inner star joins", ["plans.commerce:q1_monthly_gmv_rural_urban"], ["q1_monthly_gmv_rural_urban"])
_add("J2", "USING joins", ["plans.commerce:q3_top_sellers"], ["q3_top_sellers"])
_add("J3", "inner + left enrichment", ["plans.fact:build_fact"], ["fact_sales"])
_add("J4", "join to the row's own per-key aggregate", ["plans.commerce:q15_new_vs_returning",
                                                       "plans.commerce:q6_cohort_retention"],
     ["q15_new_vs_returning", "q6_cohort_retention"])
_add("J5", "lookup", ["operators.joins:lookup"], ["j5_lookup"])
_add("J6", "membership (semi / anti)", ["operators.joins:semi", "operators.joins:indata"],
     ["j6_membership", "j6_semi_anti"])
_add("J7", "as-of occurrence", ["operators.joins:asof"], ["j7_asof"])
_add("J8", "occurrences between", ["operators.joins:between"], ["j8_between"])

# ---------------------------------------------------------------- the analytics queries
for _n, _f in [("1", "q1_monthly_gmv_rural_urban"), ("2", "q2_monthly_aov"), ("3", "q3_top_sellers"),
               ("4", "q4_category_margin"), ("5", "q5_state_revenue_rural_share"), ("6", "q6_cohort_retention"),
               ("7", "q7_repeat_rate"), ("8", "q8_payment_mix"), ("9", "q9_delivery_efficiency"),
               ("10", "q10_rfm_scores"), ("11", "q11_growing_categories"), ("12", "q12_customer_ltv"),
               ("13", "q13_cancel_return_rate"), ("14", "q14_seller_scorecard"), ("15", "q15_new_vs_returning")]:
    _add(f"Q{_n}", _f.split("_", 1)[1].replace("_", " "), [f"plans.commerce:{_f}"], [_f])

# ---------------------------------------------------------------- KPIs, dashboard, notebook
_add("K1", "headline KPIs", ["plans.kpis:headline_kpis"], ["k1_headline_kpis"])
_add("K2", "quarter-on-quarter growth", ["plans.kpis:qoq_growth"], ["k2_qoq_growth"])
_add("K3", "filtered KPIs", ["plans.kpis:filtered_kpis"], ["k3_filtered_kpis"])
_add("K4", "Indian money format", ["plans.kpis:inr_format"], ["k4_inr_format"])
for _n, _f, _j in [("1", "monthly_segment_revenue", "d1_monthly_segment_revenue"),
                   ("2", "payment_revenue_mix", "d2_payment_revenue_mix"),
                   ("3", "delivery_trend", "d3_delivery_trend"),
                   ("4", "repeat_rate_filtered", "d4_repeat_rate_filtered"),
                   ("5", "age_band_revenue", "d5_age_band_revenue"),
                   ("6", "seller_leaderboard", "d6_seller_leaderboard"),
                   ("7", "category_table", "d7_category_table"),
                   ("8", "state_segment_revenue", "d8_state_segment_revenue")]:
    _add(f"D{_n}", _f.replace("_", " "), [f"plans.kpis:{_f}"], [_j])
_add("D9", "history plus forecast", ["plans.forecast:history_plus_forecast"], ["d9_history_plus_forecast"])
_add("N1", "monthly GMV", ["plans.kpis:monthly_gmv"], ["n1_monthly_gmv"])
_add("N2", "rural / urban split", ["plans.kpis:rural_urban_split"], ["n2_rural_urban_split"])
_add("N3", "top sellers by name", ["plans.kpis:top_sellers_by_name"], ["n3_top_sellers_by_name"])

# ---------------------------------------------------------------- forecast
_add("F1", "monthly series", ["plans.forecast:monthly_series"], ["f1_monthly_series"])
_add("F2", "linear trend", ["plans.forecast:trend_fit"], ["f2_linear_trend"])
_add("F3", "seasonal index", ["plans.forecast:seasonal_index"], ["f3_seasonal_index"])
_add("F4", "rolling backtest", ["plans.forecast:backtest", "plans.forecast:backtest_summary"], ["f4_rolling_backtest"])
_add("F5", "forecast horizon", ["plans.forecast:forecast", "plans.forecast:forecast_from_series"],
     ["f5_forecast_horizon"])

# ---------------------------------------------------------------- table transforms
_add("T1", "aggregate", ["operators.transforms:aggregate"], ["t1_aggregate"])
_add("T2", "bin", ["operators.stats:bin_", "operators.stats:nice_bins"], ["t2_bin"])
_add("T3", "density", ["operators.stats:density"], ["t3_density"])
_add("T4", "impute", ["operators.stats:impute"], ["t4_impute", "t4_impute_methods"])
_add("T5", "joinaggregate", ["operators.transforms:joinaggregate"], ["t5_joinaggregate"])
_add("T6", "extent", ["operators.transforms:extent"], ["t6_extent"])
_add("T7", "flatten", ["operators.transforms:flatten"], ["t7_flatten"])
_add("T8", "fold", ["operators.transforms:fold"], ["t8_fold"])
_add("T9", "loess", ["operators.loess:loess"], ["t9_loess"])
_add("T10", "pivot", ["operators.transforms:pivot"], ["t10_pivot"])
_add("T11", "quantile", ["operators.transforms:quantile"], ["t11_quantile"])
_add("T12", "regression", ["operators.stats:regression", "operators.stats:regression_params"],
     ["t12_regression", "t12_regression_poly"])
_add("T13", "sample", ["operators.transforms:sample", "operators.transforms:sample_fraction"], ["t13_sample"])
_add("T14", "stack", ["operators.transforms:stack"], ["t14_stack"])
_add("T15", "timeunit", ["functions.timeunits:timeunit", "functions.timeunits:timeunit_transform"],
     ["t15_timeunit"])
_add("T16", "window", ["operators.transforms:window", "operators.dwindow:window_distributed"],
     ["t16_window", "t16_window_distributed"])
_add("T17", "lookup", ["operators.joins:lookup"], ["j5_lookup"])
_add("T18", "filter", ["operators.transforms:filter_"], ["p10_filter"])
_add("T19", "calculate", ["operators.transforms:calculate"], ["p9_calculate"])
_add("T20", "field shorthand as keywords", ["operators.encoding:agg"], ["t20_keyword_agg"])
_add("T21", "ordered transform chain", ["operators.transforms:chain"], ["t21_transform_chain"])
_add("T22", "boxplot statistics", ["operators.stats:boxplot_stats", "operators.stats:boxplot_outliers"],
     ["t22_boxplot", "t22_boxplot_outliers"])
_add("T23", "error extent", ["operators.stats:error_extent"], ["t23_error_extent", "t23_quartiles"])
_add("T24", "repeat columns", ["operators.transforms:repeat_columns"], ["t24_repeat"])
_add("T25", "facet groups", ["operators.transforms:facet_aggregate"], ["t25_facet"])
_add("T26", "scale binning", ["operators.stats:quantize_bucket", "operators.stats:threshold_bucket",
                              "operators.stats:quantile_bucket"], ["t26_scale_binning", "t26_quantile_scale"])
_add("T27", "sort by another field", ["operators.transforms:sort_by_field"], ["t27_sort_by_field"])
_add("T28", "layered datasets", ["operators.transforms:layered"], ["t28_layered"])
_add("T29", "encoded aggregate", ["operators.encoding:chart_aggregate"], ["t29_encoded_aggregate"])

# ---------------------------------------------------------------- aggregate ops
_add("A1,A2,A3,A4,A5,A7,A8,A9,A10,A11,A12,A13", "aggregate ops by name", ["operators.aggregates:agg_column"],
     ["t1_aggregate"])
_add("A6", "product", ["operators.aggregates:agg_column"], ["a6_product"])
_add("A14", "bootstrap confidence interval", ["operators.stats:bootstrap_ci"], ["a14_bootstrap_ci"])
_add("A15", "values", ["operators.aggregates:agg_column"], ["a15_values"])
_add("A16,A17", "exponential / exponentialb", ["operators.stats:exponential", "operators.stats:exponential_both"], ["a16_exponential", "a16_running_exponential"])

# ---------------------------------------------------------------- window ops
_add("W1,W2,W3,W4,W5,W6,W7,W8,W9,W10,W11,W12,W13", "window ops and frames",
     ["operators.transforms:window", "operators.dwindow:window_distributed", "operators.scan:running"],
     ["t16_window", "t16_window_distributed"])
_add("W14", "frames widened to peer groups", ["operators.dwindow:window_distributed"], ["w14_peer_frame", "w14_peer_frame_all_ops"])
_add("W15", "no sort rejected", ["operators.transforms:window"], [], "unit test")
_add("W16", "SQL windows of the queries", ["operators.ranking:global_ntile"],
     ["q8_payment_mix", "q10_rfm_scores", "q11_growing_categories"])

# ---------------------------------------------------------------- date and time
_add("C1,C2,C3", "time units", ["functions.timeunits:timeunit", "functions.timeunits:parse_unit"], ["t15_timeunit"])
_add("C4,C5", "date parts (local and UTC)", ["functions.timeunits:date_part"], ["c4_date_parts"])
_add("C6", "datetime build", ["functions.timeunits:datetime_"], ["c6_c8_build_offset"])
_add("C7", "now / time / timezone offset", ["functions.timeunits:time_ms", "functions.timeunits:timezone_offset"],
     ["c7_timezone_offset", "c4_date_parts"])
_add("C8", "time offset", ["functions.timeunits:time_offset"], ["c6_c8_build_offset"])
_add("C9", "time sequence", ["functions.timeunits:time_sequence"], ["c9_time_sequence"])
_add("C10", "format / parse / names", ["functions.timeunits:time_format", "functions.timeunits:time_parse",
                                       "functions.timeunits:day_format", "functions.timeunits:month_format"],
     ["c10_time_format", "c10_time_parse"])
_add("C11", "month difference", ["functions.calendar:month_diff"], ["c11_month_diff"])
_add("C12", "calendar shift", ["functions.calendar:calendar_shift"], ["c12_calendar_shift"])
_add("C13", "recurrence calendar", ["functions.calendar:recurrence"], ["c13_recurrence", "c13_nth_weekday", "c13_subdaily"])
_add("C14", "recurrence set", ["functions.calendar:recurrence_set"], ["c14_recurrence_set"])
_add("C15", "Easter dates", ["functions.calendar:easter"], ["c15_easter"])
_add("C16", "DST audit", ["functions.calendar:dst_audit"], ["c16_dst_audit"])
_add("C17", "zone conversion", ["functions.calendar:zone_convert"], ["c17_zone_convert"])
_add("C18", "date normalisation", ["functions.calendar:normalise_dates", "functions.calendar:parse_date_any"],
     ["c18_date_normalise"])

# ---------------------------------------------------------------- scalar functions
_add("E1", "operators", ["functions.expr:div", "functions.expr:mod", "functions.expr:strict_eq"], ["e7_math"])
_add("E2", "field access", ["functions.expr:field"], ["e3_e6_e2_constants_branch_fields"])
_add("E3", "constants", ["functions.expr:const"], ["e3_e6_e2_constants_branch_fields"])
_add("E4", "type tests", ["functions.expr:is_valid", "functions.expr:is_nan", "functions.expr:is_finite",
                          "functions.expr:type_test"], ["e4_type_tests"])
_add("E5", "coercion", ["functions.expr:to_number", "functions.expr:to_boolean", "functions.expr:to_string",
                        "functions.expr:to_date"], ["e5_coercion"])
_add("E6", "if", ["functions.expr:if_"], ["e3_e6_e2_constants_branch_fields"])
_add("E7", "math", ["functions.expr:clamp", "functions.expr:js_round", "functions.expr:nan_max"], ["e7_math"])
_add("E8", "random", ["functions.expr:random", "functions.expr:sample_normal"], ["e8_random"])
_add("E9", "distributions", ["functions.expr:cumulative_normal", "functions.expr:quantile_normal",
                             "functions.expr:density_normal", "functions.expr:cumulative_uniform"],
     ["e9_distributions", "e9_normal_cdf_quantile"])
_add("E10", "arrays", ["functions.expr:extent", "functions.expr:slice_", "functions.expr:sequence",
                       "functions.expr:lerp", "functions.expr:clamp_range", "functions.expr:lastindexof",
                       "functions.expr:pluck"], ["e10_arrays", "e10_array_more"])
_add("E11", "strings", ["functions.expr:pad", "functions.expr:truncate", "functions.expr:replace_first",
                        "functions.expr:parse_float", "functions.expr:btoa"], ["e11_strings", "e11_base64_roundtrip"])
_add("E12", "object merge", ["functions.expr:merge"], ["e12_merge"])
_add("E13", "number format", ["functions.expr:number_format"], ["e13_number_format"])
_add("E14", "regular expressions", ["functions.expr:test", "functions.expr:regexp_replace"], ["e14_regex"])
_add("E15", "table references", ["operators.joins:indata"], ["j6_membership"])
_add("E16", "tree paths", ["operators.hierarchy:ancestors", "operators.hierarchy:tree_path",
                           "operators.hierarchy:tree_ancestors"], ["e16_tree_path", "e16_tree_path_pairs"])

# ---------------------------------------------------------------- sorts, sets, registry
_add("X1,X2", "order by / top-k", ["plans.commerce:q3_top_sellers"], ["q3_top_sellers", "q12_customer_ltv"])
_add("X3", "tail slices", ["plans.kpis:qoq_growth"], ["k2_qoq_growth"])
_add("X4", "union", ["plans.forecast:history_plus_forecast"], ["d9_history_plus_forecast"])
_add("X5,X6", "except / distinct / intersect", ["functions.calendar:recurrence_set"],
     ["x5_x6_set_ops", "c14_recurrence_set"])
_add("U1", "lambda aggregate as a native expression", ["plans.kpis:seller_leaderboard"], ["d6_seller_leaderboard"])
_add("U2", "transform registry", ["operators.transforms:TransformRegistry"], ["u2_transform_registry"])
_add("U3", "UDAF / UDTF", [], [], "none in the reference")

# ---------------------------------------------------------------- text profile
_add("G1", "symbol noise", ["plans.text_profile:symbol_noise"], ["g1_char_noise", "g1_noise_scores"])
_add("G2", "accent noise", ["plans.text_profile:accent_noise"], ["g2_g12_accent_isolated", "g1_char_noise"])
_add("G3", "unprintable noise", ["plans.text_profile:unprintable_noise"], ["g1_char_noise"])
_add("G4", "case-flip noise", ["plans.text_profile:case_flip_noise"], ["g4_case_flip"])
_add("G5", "noise report", ["plans.text_profile:noise_report"], ["g5_noise_report"])
_add("G6", "letter profile", ["plans.text_profile:letter_profile"], ["g6_letter_profile"])
_add("G7", "language coherence", ["plans.text_profile:language_coherence",
                                  "plans.text_profile:coherence_accuracy"], ["g7_language_coherence"])
_add("G8", "UTF-8 audit", ["plans.text_profile:utf8_audit"], ["g8_utf8_audit"])
_add("G9", "duplicate-accent noise", ["plans.text_profile:duplicate_accent_noise"], ["g1_char_noise"])
_add("G10", "script-mix noise", ["plans.text_profile:script_mix_noise"], ["g1_char_noise"])
_add("G11", "suspicious-word noise", ["plans.text_profile:weird_word_table",
                                      "plans.text_profile:weird_word_noise"], ["g11_weird_words"])
_add("G12", "isolated-form and rare-CJK noise", ["plans.text_profile:isolated_form_noise",
                                                 "plans.text_profile:rare_cjk_noise",
                                                 "plans.text_profile:common_cjk"],
     ["g2_g12_accent_isolated", "g1_noise_scores"])

INVENTORY = I


def markdown() -> str:
    import re

    def key(i: str):
        m = re.match(r"([A-Z])(\d+)", i)
        return ("SPJQKDNFTAWCEXUG".index(m.group(1)), int(m.group(2)))

    lines = ["| ID | What | Code | Registered jobs | Note |", "|---|---|---|---|---|"]
    for i in sorted(I, key=key):
        what, funcs, jobs, note = I[i]
        code = ", ".join(f"`{f}`" for f in funcs) or "-"
        js = ", ".join(f"`{j}`" for j in jobs) or "-"
        lines.append(f"| {i} | {what} | {code} | {js} | {note} |")
    return "\n".join(lines)


if __name__ == "__main__":
    print(markdown())
