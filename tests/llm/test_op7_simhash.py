import random

import numpy as np
import xxhash

from weekly_impact.llm import simhash as S
from weekly_impact.llm.components import components
from weekly_impact.llm.queries import op7_simhash_bk_trees

from .conftest import make


def print_of(text):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] if ws else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, radius=2):
    rows = [(i, print_of(t)) for i, t in rows]
    pairs = [(x, y) for x, (_, f) in enumerate(rows) for y, (_, g) in enumerate(rows) if x < y and (f ^ g).bit_count() <= radius]
    root = roots(pairs, range(len(rows)))
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root[x]] = min(i, least.get(root[x], i))
    return sorted(((i, f"{f:016x}", least.get(root[x])) for x, (i, f) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()), key=str)


def test_whole_table(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op7_simhash_bk_trees(spark, small_dir).collect()), key=str) == brute(rows)


def test_odd_documents(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(odd_docs.withColumnsRenamed({"lang": "fp", "source": "component"})) == brute(rows)
    assert got(make(spark, [])) == []


def test_tree_search_equals_scan():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(8)} | set(base)
    tree = S.BKTree(np.array(sorted(near), dtype=np.uint64))
    for q in base:
        for r in (0, 1, 2, 3):
            assert sorted(tree.search(q, r)) == sorted(x for x in near if (x ^ q).bit_count() <= r)


def test_forest_over_shards_keeps_every_link(spark, monkeypatch):
    monkeypatch.setattr(S.link_forest, "__defaults__", (16,))
    rng = random.Random(5)
    hub = rng.getrandbits(64)
    values = {hub}
    for _ in range(400):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = S.link_forest(spark.createDataFrame([(v,) for v in signed], "fp long"), 2)
    found = {r.node: r.component for r in components(links).collect()}
    ordered = sorted(signed)
    pairs = [(a, b) for x, a in enumerate(ordered) for b in ordered[x + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert {v: found.get(v, v) for v in signed} == roots(pairs, ordered)


def test_components_chain_and_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
