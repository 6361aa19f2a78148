from spanforge.llm import chat


def test_long_paths_are_not_one_plan(spark):
    """The driver plans a few doublings at a time, so that what it holds doesn't grow with the length of paths."""
    rows = spark.range(100).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "'x' AS text")
    paths = chat.best_paths(chat.linear_tree(rows))
    assert "Join" not in paths._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.node_id, r.from_leaf) for r in paths.collect()) == [(i + 1, 99 - i) for i in range(100)]
