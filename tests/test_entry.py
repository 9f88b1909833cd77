def test_entry_smoke(spark, small_dir):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and "semantic_type" in df.columns


def test_save_and_reload(spark, small_dir, tmp_path):
    from quillstat.plans.results import save_table
    from quillstat.plans import views as V
    from quillstat.operators import metrics as G
    board = G.leaderboard(G.classification_metrics(V.order_status_rules(spark, small_dir)), "classification")
    path = save_table(board, str(tmp_path / "leaderboard"))
    assert spark.read.parquet(path).count() == 4
