import re

from weekly_impact.llm import decontamination as D
from weekly_impact.llm.queries import op6_minhash_containment

from .conftest import make


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(rows, items, width=5, threshold=0.8):
    out = []
    for j, t in items:
        w = words(t)
        k = min(width, len(w))
        q = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i, text in rows:
            d = words(text)
            n = len(q & {tuple(d[x:x + k]) for x in range(len(d) - k + 1)}) if q else 0
            if q and n >= threshold * len(q) - 1e-9:
                out.append((i, j, len(q), n))
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def got(df, items):
    return sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in D.find_leaks(df, items).collect()), key=str)


def test_whole_table(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = brute(rows, items)
    assert want and sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in op6_minhash_containment(spark, small_dir).collect()), key=str) == want


def test_thresholds_long_documents_and_short_items(spark):
    item = " ".join(f"w{i}" for i in range(24))  # 20 shingles, 16 needed
    noise = " ".join(f"n{i % 1500}" for i in range(20_000))
    rows = [(1, noise + " " + item.upper() + " " + noise), (2, "x " + " ".join(f"w{i}" for i in range(20))),
            (3, " ".join(f"w{i}" for i in range(19))), (4, "alpha beta gamma"), (5, "alpha gamma beta"), (6, ""), (7, None),
            (None, item), (1, "another text"), (8, item), (8, item), (9, item.replace("w12", "zz"))]
    items = [(1, item), (2, "Alpha, BETA!"), (3, ""), (4, None), (5, "one two three four five"), (None, item), (6, item), (6, item)]
    clash = make(spark, rows).withColumnsRenamed({"lang": "item_id", "source": "hash"})
    assert got(clash, items_of(spark, items)) == brute(rows, [(1, item), (2, "Alpha, BETA!"), (5, "one two three four five"), (6, item)])


def test_drop_leaks_keeps_clean_rows(spark):
    rows = [(1, "a b c d e f"), (2, "clean words only"), (None, "x a b c d e f"), (None, None), (2, "clean words only")]
    kept = D.drop_leaks(make(spark, rows), items_of(spark, [(1, "a b c d e f")]))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("2", "clean words only")] * 2 + [("None", "None")]
    assert kept.columns == make(spark, []).columns


def test_empty_tables(spark):
    assert got(make(spark, []), items_of(spark, [(1, "a b")])) == []
    assert got(make(spark, [(1, "a b")]), items_of(spark, [])) == []


def test_plan_is_native(spark, small_dir):
    plan = op6_minhash_containment(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
