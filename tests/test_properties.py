"""Properties: top-K is bounded and order-independent; the unnest keeps item revenue."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekly_impact.operators.items import item_fact
from weekly_impact.operators.topk import top_k
from weekly_impact.sources.events import EVENT_SCHEMA

names = st.sampled_from([f"p{i}" for i in range(12)])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(names, st.integers(0, 5)), min_size=1, max_size=60), st.integers(1, 6), st.randoms())
def test_top_k_bounded_and_stable_under_shuffling(spark, rows, k, rnd):
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    a = spark.createDataFrame(rows, "product_name string, v int").repartition(3)
    b = spark.createDataFrame(shuffled, "product_name string, v int").repartition(5)
    ta = [r.product_name for r in top_k(a, "product_name", F.sum("v"), k).collect()]
    tb = [r.product_name for r in top_k(b, "product_name", F.sum("v"), k).collect()]
    assert ta == tb and len(ta) <= k and len(set(ta)) == len(ta)


prices = st.integers(0, 99999).map(lambda c: c / 100)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(prices, st.integers(1, 9)), max_size=4), min_size=1, max_size=20))
def test_unnest_keeps_item_revenue(spark, baskets):
    rows = [("purchase", "u", [], ("t", 1.0), [("n", "C", "S", p, q) for p, q in b], "20240102") for b in baskets]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    got = item_fact(df).agg(F.sum("item_rev_u")).collect()[0][0] or 0
    want = sum(round(p * 100) * q for b in baskets for p, q in b) * 100
    assert abs(float(got) - want / 10_000) < 1e-9  # money is a decimal of currency units
