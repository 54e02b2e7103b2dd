import numpy as np
import pytest

from weekly_impact.llm import vector_graph as G
from weekly_impact.llm.queries import op1_pruned_graph


def brute(rows, least=0.95):
    good = {i: (k, np.array(v, dtype=float) / max(map(abs, v))) for i, (k, v) in enumerate(rows)
            if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    keys, out = list(good), {i: [k, 0, k] for i, (k, _) in enumerate(rows)}
    up = {i: i for i in keys}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, i in enumerate(keys):
        for j in keys[a + 1:]:
            x, y = good[i][1], good[j][1]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                out[i][1] += 1
                out[j][1] += 1
                up[find(i)] = find(j)
    least_id = {}
    for i in keys:
        least_id[find(i)] = min(good[i][0], least_id.get(find(i), good[i][0]))
    for i in keys:
        out[i][2] = least_id[find(i)]
    return sorted(((k, n, c, k == c) for k, n, c in out.values()), key=str)


def got(df, **kw):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in G.link_vectors(df, **kw).collect()), key=str)


def test_whole_table(spark, small_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in op1_pruned_graph(spark, small_dir).collect()), key=str) == brute(rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(30, 8)).tolist()
    rows = [(i, v[i % 20]) for i in range(30)] + [(50, None), (51, []), (52, [0.0] * 8), (53, [float("nan")] * 8), (54, [1.0, None] + [1.0] * 6),
            (None, v[0]), (55, [2 * x for x in v[0]]), (3, v[3]), (56, v[1][:5]), (57, [1e300] * 8), (58, [float("inf")] + [1.0] * 7), (59, [1e-300] * 8)]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<double>, node string, shards int")
    assert got(df) == brute(rows)
    assert got(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")) == []


def test_shards_tiles_and_dense_groups(spark, monkeypatch):
    for name, value in (("HOME", 100), ("TILE", 120)):
        monkeypatch.setattr(G, name, value)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 16))
    x = np.concatenate([base, base[0] + 0.05 * rng.normal(size=(250, 16)), base[:60] + 0.04 * rng.normal(size=(60, 16))])
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    want, have = brute(rows), got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [r[0] for r in want] == [r[0] for r in have]
    assert sum(min(a[1], b[1]) for a, b in zip(want, have)) >= 0.99 * sum(r[1] for r in want)
    assert all(b[1] <= a[1] for a, b in zip(want, have))


def fast_brute(x, least=0.95):
    """brute() for plain vectors, by one matrix product."""
    v = G.unit(x)
    hit = v @ v.T >= least
    np.fill_diagonal(hit, False)
    comp = np.full(len(v), -1)
    for i in range(len(v)):
        if comp[i] < 0:
            comp[i], todo = i, [i]
            while todo:
                new = np.flatnonzero(hit[todo.pop()] & (comp < 0))
                comp[new] = i
                todo += new.tolist()
    return sorted(((i, int(hit[i].sum()), int(comp[i]), i == comp[i]) for i in range(len(v))), key=str)


def mixed(dim, background, groups, pairs, seed):
    """Random vectors, groups of near copies and scattered pairs."""
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal((background, dim))]
    for size in groups:
        c = rng.standard_normal(dim)
        out.append(c + 0.14 * np.linalg.norm(c) / np.sqrt(dim) * rng.standard_normal((size, dim)))
    p = rng.standard_normal((pairs, dim))
    out += [p, p + 0.26 * np.linalg.norm(p, axis=1, keepdims=True) / np.sqrt(dim) * rng.standard_normal((pairs, dim))]
    x = np.concatenate(out)
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("dim", [64, 256])
def test_groups_of_near_copies_and_scattered_pairs(spark, dim):
    x = mixed(dim, 1500, (50, 300, 900), 500, dim)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    out = G.link_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=str) == fast_brute(x)
    assert out[0].audited_recall >= G.GOAL


def test_blocks_are_compared_exactly_where_the_search_fails(spark, monkeypatch):
    for name, value in (("HOME", 60), ("TILE", 50), ("MAX_OVERLAP", 3)):
        monkeypatch.setattr(G, name, value)
    monkeypatch.setattr(G, "audit", lambda *a: 0.5)
    used = []
    compare = G.compare_blocks
    monkeypatch.setattr(G, "compare_blocks", lambda *a: used.append(1) or compare(*a))
    x = np.concatenate([mixed(16, 300, (120, 40), 60, 3), np.random.default_rng(1).standard_normal((40, 16)) * [1] * 1])
    x[:200] = x[200:400] + 0.01 * x[:200]  # chains of blocks
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    out = got(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    assert used and out == fast_brute(x)


def test_audit_sees_small_losses(spark):
    x = mixed(32, 500, (200,), 150, 9)
    true = np.array([n for _, n, _, _ in sorted(fast_brute(x))])
    nodes = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "node long, v array<double>, copies long")
    found = true.copy()
    whole = G.audit(nodes, spark.createDataFrame([(i, int(n)) for i, n in enumerate(found)], "node long, n long"), 0.95)
    pairs = np.flatnonzero(true == 1)[:15]
    found[pairs] = 0  # a few isolated pairs: 15 of about 40,000 links
    less = G.audit(nodes, spark.createDataFrame([(i, int(n)) for i, n in enumerate(found)], "node long, n long"), 0.95)
    assert whole == 1.0 and less < G.GOAL
    linked = (true > 0).sum()
    assert less == pytest.approx(1 - 15 / linked, abs=0.01)


def test_every_node_is_reached_from_the_medoid():
    x = G.unit(mixed(24, 300, (400,), 40, 5))
    lists = G.build_graph(x)
    seen = np.zeros(len(x), dtype=bool)
    start = G.medoid(x)
    seen[start] = True
    G.reach(lists, [start], seen)
    assert seen.all()
    apart = [np.array([1]), np.array([0]), np.array([3]), np.array([2])]  # two islands
    joined = G.attach(x[:4], apart, 0)
    seen = np.array([True, False, False, False])
    G.reach(joined, [0], seen)
    assert seen.all() and all(set(a) <= set(b) for a, b in zip(apart, joined))
