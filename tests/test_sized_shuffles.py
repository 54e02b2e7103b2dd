"""Shuffles of large inputs: enough partitions for the input, the same rows, the session's settings left alone."""

import pytest

import __spark_entry__ as E
from weekly_impact import session
from weekly_impact.operators import weekly
from weekly_impact.sources import files

SF = "/root/testdata/sf0.001"
KEY = "spark.sql.shuffle.partitions"
TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MAX_SPLIT = "spark.sql.files.maxPartitionBytes"
WEEKLY = ["subcategory_funnel", "subcategory_weekly", "product_funnel", "category_funnel", "delivery_tier_weekly", "category_summary", "category_weekly"]
SHARED = ["product_weekly", "units_per_tx", "change_impact_product"]


@pytest.fixture
def large(monkeypatch):
    """The small tables count as large ones: a partition for each 4 KB."""
    monkeypatch.setattr(session, "PARTITION_BYTES", 4 << 10)


@pytest.fixture
def written(spark, monkeypatch):
    """Name and shuffle partitions of each table that is stored."""
    seen = []
    real = session.materialize

    def noted(df, name="stage", partition_by=()):
        seen.append((name, int(spark.conf.get(KEY))))
        return real(df, name, partition_by)

    monkeypatch.setattr(session, "materialize", noted)
    return seen


def test_input_files_are_counted_in_bytes(spark, tmp_path):
    one, many = str(tmp_path / "a b=1"), str(tmp_path / "many")
    spark.range(1000).coalesce(1).write.parquet(one)
    spark.range(1000).repartition(20).write.parquet(many)
    size = {p: sum(f.stat().st_size for f in __import__("pathlib").Path(p).glob("part-*")) for p in (one, many)}
    assert files.size(spark, spark.read.parquet(one).inputFiles()) == size[one]
    assert size[many] <= files.size(spark, spark.read.parquet(many).inputFiles()) <= size[many] * 1.5  # with the folder's other files
    assert files.size(spark, []) == 0


def test_small_inputs_stay_lazy(spark, written):
    E.queries()["subcategory_funnel"](spark, SF)
    assert written == []


@pytest.mark.parametrize("name", [*WEEKLY, *SHARED])
def test_large_inputs_get_their_partitions_and_the_same_rows(spark, large, written, monkeypatch, name):
    before = spark.conf.get(KEY)
    got = E.queries()[name](spark, SF).collect()
    asked = -(-sum(files.size(spark, [f"file://{SF}/{t}.parquet"]) for t in ("orders", "lineitem", "part")) // 4096)
    assert asked > int(before) and written and max(n for _, n in written) >= asked
    assert spark.conf.get(KEY) == before
    monkeypatch.setattr(session, "PARTITION_BYTES", 1 << 30)
    want = E.queries()[name](spark, SF).collect()
    assert got and got == want


@pytest.mark.parametrize("name", ["subcategory_weekly", "category_funnel", "delivery_tier_weekly", "category_summary"])
def test_runtime_joins_partitions_up_to_one_share_only(spark, large, monkeypatch, name):
    """A session with partitions enough for the input, which Spark's target of 64 MB would join again."""
    seen, real = [], session.materialize
    kept = {KEY: spark.conf.get(KEY), TARGET: spark.conf.get(TARGET)}

    def noted(df, name="stage", partition_by=()):
        seen.append([spark.conf.get(k) for k in (KEY, TARGET, MAX_SPLIT)])
        return real(df, name, partition_by)

    monkeypatch.setattr(session, "materialize", noted)
    try:
        spark.conf.set(KEY, "100")
        spark.conf.set(TARGET, "64m")
        E.queries()[name](spark, SF)
        assert seen and all(x == ["100", str(4 << 10), str(16 << 20)] for x in seen)
        assert spark.conf.get(KEY) == "100" and spark.conf.get(TARGET) == "64m"
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_smaller_settings_of_the_session_stay(spark, large):
    kept = {k: spark.conf.get(k) for k in (TARGET, MAX_SPLIT)}
    df = spark.read.parquet(f"{SF}/orders.parquet")
    try:
        for k in kept:
            spark.conf.set(k, "2k")
        with session.sized_shuffles(df) as more:
            assert more and all(spark.conf.get(k) == "2048" for k in kept)
        assert all(spark.conf.get(k) == "2k" for k in kept)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_partitions_come_back_after_a_failure(spark, large):
    before = spark.conf.get(KEY)
    df = spark.read.parquet(f"{SF}/orders.parquet")
    with pytest.raises(ZeroDivisionError), session.sized_shuffles(df) as more:
        assert more and int(spark.conf.get(KEY)) == session.partitions_for(df) > int(before)
        1 / 0
    assert spark.conf.get(KEY) == before


def test_tables_without_files_ask_for_nothing(spark, large):
    df = spark.createDataFrame([("2024-01-01", "a", "view_item", "u")], "week string, k string, event_name string, user string")
    assert session.partitions_for(df) == 0
    assert weekly.weekly_metrics(df, ["k"], [weekly.distinct("users", "view_item", "user")]).collect()[0]["users"] == 1
