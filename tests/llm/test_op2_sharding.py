import zlib
from collections import Counter, defaultdict

import pytest

from weekly_impact.llm import sharding as S

from .conftest import make


def feistel(x, a, b, keys):
    l, r = x % a, x // a
    for i, (p, q, c) in enumerate(keys):
        v = (r % S.PRIME * p + q) % S.PRIME
        l, r = r, (l + (v * v + c) % S.PRIME) % (a if i % 2 == 0 else b)
    return l * (a if len(keys) % 2 else b) + r


def brute(rows, shards):
    rows = sorted(rows, key=lambda d: (d[0] is not None, d[0] or 0, zlib.crc32((d[1] or "").encode()), len((d[1] or "").encode())))
    n = len(rows)
    a, b = S.rectangle(n)
    keys = S.round_keys(42)
    out = []
    for number, (i, t) in enumerate(rows):
        p = feistel(number, a, b, keys)
        while p >= n:
            p = feistel(p, a, b, keys)
        data = (t or "").encode()
        out.append((i, len(data) + 1, zlib.crc32(data), "rows", p % shards, p // shards, None))
    return out


def got(df, shards=16):
    return [tuple(r[c] for c in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")) for r in S.shard_rows(df, shards).collect()]


@pytest.mark.parametrize("n", [1, 3, 17, 250])
def test_matches_brute_force(spark, n):
    rows = [(i * 7 % n, f"text {i % 9}") for i in range(n)]
    assert Counter(got(make(spark, rows))) == Counter(brute(rows, 16))


def test_law_and_gapless_slots(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    out = got(odd_docs, 4)
    assert Counter(out) == Counter(brute(rows, 4))
    slots = defaultdict(list)
    for r in out:
        slots[r[4]].append(r[5])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(4)) <= 1


def test_many_repeated_rows(spark):
    rows = [(5, "same")] * 300 + [(i, "x") for i in range(100)]
    assert Counter(got(make(spark, rows))) == Counter(brute(rows, 16))


def test_long_runs_of_copies_are_spread(spark):
    df = make(spark, [(None, "same")] * 200 + [(i % 9, "x") for i in range(50)]).select("doc_id", "text")
    numbers = [S.global_numbers(df, ["doc_id", "text"], run)[0].orderBy("number").collect() for run in (7, 199, 10_000)]
    assert numbers[0] == numbers[1] == numbers[2]
    assert [r.number for r in numbers[0]] == list(range(250))


def test_empty_and_clashing_columns(spark):
    assert got(make(spark, [])) == []
    df = make(spark, [(1, "a"), (2, "b")]).withColumnsRenamed({"lang": "shard", "source": "number", "n_chars": "copies"})
    assert len(got(df)) == 2


def test_permutation_is_a_bijection():
    for n in (1, 2, 5, 37, 1000):
        a, b = S.rectangle(n)
        assert n <= a * b < n + a
        assert sorted(feistel(x, a, b, S.round_keys(42)) for x in range(a * b)) == list(range(a * b))


def test_the_registered_query_on_a_whole_table(spark):
    import zlib

    from weekly_impact.llm.queries import op2_feistel_shards

    path = "/root/testdata/sf0.01"
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    df = op2_feistel_shards(spark, path)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "number", "place"]
    out = df.collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((i, len(t) + 1, zlib.crc32(t)) for i, t in docs)
    slots = {}
    for r in out:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
