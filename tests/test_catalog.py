"""Every query with an SQL twin agrees with it on the smallest tables; the others return rows."""

import os

import duckdb
import pytest

from catalog import load
from check import TABLES, close, table_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols, got = table_of(df.columns, df.collect())
    cur = con.execute(ORACLES[name])
    want_cols, want = table_of([d[0] for d in cur.description], cur.fetchall())
    assert cols == want_cols
    assert len(got) == len(want)
    assert all(close(a, b) for x, y in zip(got, want) for a, b in zip(x, y))


def test_every_operator_has_a_query():
    names = """scan_csv write_predictions write_results_tsv submission_template_check schema_profile drop_columns select_columns
    select_by_dtype rename_columns add_constant_or_missing_column truncate_to_int drop_columns_with_nulls drop_constant_columns
    reorder_to_training_columns name_components null_count_profile drop_null_rows fill_median distinct_rows duplicate_rows
    quantile_trim_sequential quantile_trim_snapshot quantile_trim_component_space iqr_fence_upper iqr_fence_two_sided range_filter
    equality_subset exclude_ids attach_label attach_ids knn_join grid_cross_product describe_table value_counts quantiles
    distinct_values n_unique class_balance column_extents_across_tables mean_std_of_scores histogram histogram_by_class kde_curve
    scatter_sample gram_matrix correlation_matrix target_correlation_ranked select_by_correlation null_aware_target_correlation
    max_correlation_column mutual_information rfe feature_importance_table label_encode label_encode_independent
    label_encode_frozen label_encode_union standard_scale minmax_scale minmax_state_table robust_scale inverse_scale
    polynomial_features scaled_poly_components_model pca_fit pca_transform explained_variance_table fast_ica neighbour_graph
    truncated_svd incremental_pca lda_projection holdout_split kfold_shuffled kfold_contiguous kfold_stratified leak_free_holdout
    random_oversample random_undersample smote tomek_links edited_nearest_neighbours smote_tomek smote_enn adjust_proportion
    linear_regression ridge lasso elastic_net lars lasso_lars orthogonal_matching_pursuit bayesian_ridge ard_regression
    huber_regression passive_aggressive_regression knn_regress knn_classify theil_sen ransac logistic_regression
    gaussian_naive_bayes decision_tree_classify decision_tree_regress random_forest_classify random_forest_regress
    extra_trees_regress gradient_boosting_classify gradient_boosting_regress boosted_trees hist_gradient_boosting adaboost_regress
    adaboost_classify linear_svm_classify svr kernel_ridge mlp_regress kmeans refit_on_all_and_score param_grid grid_search_cv
    random_search_cv param_distributions multi_metric_search cv_score_table benchmark_models product_sweep trim_sweep
    cross_val_predict mse rmse rmspe r2 accuracy confusion_matrix classification_report roc_auc f1_score residuals
    prediction_sample silhouette custom_scorer compare_prediction_tables sort_values head top_k_features concat_rows
    concat_columns column_set_difference""".split()
    assert [n for n in names if n not in QUERIES] == []


@pytest.mark.parametrize("name", ["huber_regression", "theil_sen", "ransac", "feature_importance_table", "pca_wide", "neighbour_graph"])
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
