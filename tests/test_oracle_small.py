"""SQL twins at sf0.001 for a representative set of catalogue queries."""

import pytest

duckdb = pytest.importorskip("duckdb")

NAMES = ["a3_missing_tokens", "a4_type_inference", "b2_semantic_type", "b5_sample_values", "b10_target_union",
         "b13_column_summary", "c4_top_values", "c5_histogram", "c6_correlation", "d1_preprocess",
         "d6_label_encoding", "e4_scale_all", "e7_stratified_split", "e10_unseen_class_filter",
         "g7_leaderboard_classification", "g11_best_model", "h8_top_features", "i3_scenario_table",
         "j1_eda_facts", "j5_route_replies", "k1_cap_per_dataset"]


@pytest.fixture(scope="module")
def con(small_dir):
    from tools.oracle_check import duck
    return duck(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, small_dir, name):
    import __spark_entry__ as entry
    from tools.oracle_check import compare
    msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], small_dir)
    assert msg.startswith("OK"), msg


def test_every_sql_query_is_registered():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90
