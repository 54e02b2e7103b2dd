import hashlib

import numpy as np
import pyarrow as pa
import pytest

from weekly_impact.llm import line_dedup as L
from weekly_impact.llm.queries import op4_mph_line_dedup

from .conftest import make


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=10):
    holders = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if i is not None and len(k) >= least:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in L.dedup_lines(df).collect()), key=str)


def test_whole_table(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)}
    assert {tuple(r) for r in op4_mph_line_dedup(spark, small_dir).collect()} == want
    assert any(d for _, _, d, _ in brute(rows))


def test_odd_documents(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(odd_docs.withColumnsRenamed({"lang": "KEPT", "source": "shard"})) == brute(rows)
    assert got(make(spark, [])) == []


def test_keys(spark):
    rows = [(3, "Shared LINE here\r\nown line of three\nshort"), (1, "  shared line HERE\t\nÀccent line one\nshort"),
            (2, "shared line here \nàccent line one\n\nshared line here"), (4, "shared line here\nshared line here\n"), (None, "shared line here")]
    assert got(make(spark, rows)) == brute(rows)


def test_hot_line_in_every_document(spark):
    rows = [(i, f"the very same line\nown line number {i}\nthe very same line") for i in range(3000)]
    assert got(make(spark, rows)) == brute(rows)


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        mph = L.PerfectHash.from_bytes(L.PerfectHash.build(keys).to_bytes())
        assert sorted(mph.places(keys).tolist()) == list(range(len(keys)))


def test_shards_are_built_one_after_another():
    rng = np.random.default_rng(3)
    rows = sorted((int(s), int(rng.integers(-2**62, 2**62)), int(rng.integers(-2**62, 2**62)), i, 2) for i, s in enumerate(rng.integers(0, 9, 500)))
    names = ["shard", "copies", "h1", "h2", "owner", "n_lines"]
    columns = [[r[0] for r in rows], [1 + r[0] % 2 for r in rows], *[[r[i] for r in rows] for i in range(1, 5)]]
    table = pa.table([pa.array(c, pa.int32() if i < 2 else pa.int64()) for i, c in enumerate(columns)], names)
    for size in (7, 64, 500):
        out = pa.Table.from_batches(L._build_shards(table.to_batches(max_chunksize=size)))
        assert list(zip(out["shard"].to_pylist(), out["copy"].to_pylist())) == [(s, c) for s in range(9) for c in range(1 + s % 2)]
        assert sum(n for n, c in zip(out["n_keys"].to_pylist(), out["copy"].to_pylist()) if c == 0) == 500
    with pytest.raises(ValueError):
        L.PerfectHash.build(np.array([5, 5], dtype=np.uint64))
