"""The shared folder and written tables."""

import pytest

from twosided import session


def test_tables_go_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == folder
    df, rows = session.materialise_counted(spark.range(25).selectExpr("id", "id % 3 AS k"), "numbers")
    assert rows == 25 and df.count() == 25
    assert all(f"{folder}/numbers-" in path for path in df.inputFiles())
    plan = df.filter("k = 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,1)]" in plan


def test_a_cluster_without_a_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_sessions_do_not_share_written_views(spark):
    assert spark.conf.get("spark.app.id")


def test_shuffles_begin_with_partitions_by_rows(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        session.spread_shuffles(spark, usual * session.ROWS_A_PARTITION)
        assert spark.conf.get(key, None) is None
        session.spread_shuffles(spark, (usual + 3) * session.ROWS_A_PARTITION - 1)
        session.spread_shuffles(spark, 1)
        assert int(spark.conf.get(key)) == usual + 3
    finally:
        spark.conf.unset(key)


def test_small_splits_end_with_the_block(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, within in (("128m", session.CACHED_SPLIT), ("1m", 1 << 20), ("134217728b", session.CACHED_SPLIT)):
            spark.conf.set(key, given)
            with session.small_splits(spark):
                assert int(spark.conf.get(key).rstrip("b")) == within
            assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)


def test_shuffles_go_when_a_table_is_written(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, during = spark.conf.get(key), []
    observed = type(spark.range(1)).observe

    def observe(df, *args):
        during.append(spark.conf.get(key))
        return observed(df, *args)

    monkeypatch.setattr(type(spark.range(1)), "observe", observe)
    assert session.materialise(spark.range(1000).groupBy("id").count(), "counted").count() == 1000
    assert during == ["true"] and spark.conf.get(key) == before


def test_filled_histories_are_shuffled_once_by_team(spark):
    from twosided.catalog import impute_queries
    from twosided.operators import impute
    from twosided.plans.contest_view import ROW_KEY, contest_table

    df = impute_queries.fill_history(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # a written table: its shuffles are gone
    plain = impute.fill_along_history(contest_table(spark, "/root/testdata/sf0.001").drop("date"), ROW_KEY, drop=())
    assert df.columns == plain.columns and sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))
