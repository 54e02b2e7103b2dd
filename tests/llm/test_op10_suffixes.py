import hashlib
import random

import numpy as np

from weekly_impact.llm import suffix_dedup as S
from weekly_impact.llm.queries import op10_deep_shallow

from .conftest import make


def brute(rows, n=100):
    """(doc_id, bytes, removed, spans, kept) for rows of distinct ids."""
    seen, out = set(), []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (t or "").encode()
        go = np.zeros(len(data) + 1, dtype=bool)
        for s in range(len(data) - n + 1):
            w = data[s:s + n]
            if w in seen:
                go[s:s + n] = True
            seen.add(w)
        keep = bytes(c for c, g in zip(data, go) if not g)
        out.append((i, len(data), int(go.sum()), int((go[:-1] & ~np.append(False, go[:-1])[:-1]).sum()), keep))
    return out


def got(df, **how):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(df, **how).collect()), key=str)


def test_whole_table(spark, small_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    want = {(i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute(rows)}
    assert {tuple(r) for r in op10_deep_shallow(spark, small_dir).collect()} == want
    assert any(x[2] for x in want)


def test_shared_passages_at_every_shift(spark):
    rng = random.Random(8)
    letters = "abcdefgh é\n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (99, 100, 101, 130, 220, 700)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(shared)
            cut = rng.randrange(0, 40)
            parts += [p[cut:], text(rng.randrange(0, 60))]
        rows.append((i * 3 % 61, "".join(parts)))
    assert got(make(spark, rows)) == sorted(brute(rows), key=str)


def test_edits_periods_and_copies(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(1500))
    near = []
    for _ in range(40):
        at = rng.randrange(len(base))
        near.append(base[:at] + rng.choice(["X", "", "YZ"]) + base[at + 1:])
    texts = [base, *near, base, "a" * 400, "ab" * 300, "a" * 130, "\x00" * 250, base[:99], base[700:800], "", None, "é" * 120]
    rows = list(enumerate(texts))
    assert got(make(spark, rows)) == sorted(brute(rows), key=str)


def test_odd_documents(spark, odd_docs):
    out = got(odd_docs.withColumnsRenamed({"lang": "kept", "source": "lead"}))
    assert len(out) == odd_docs.count() and all(r[2] == 0 for r in out if r[0] is None)
    one = sorted(brute([(r.doc_id, r.text) for r in odd_docs.dropDuplicates(["doc_id", "text"]).collect()]), key=str)
    assert sorted({r for r in out if r[0] is not None}, key=str) == one
    assert got(make(spark, [])) == []


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 500)
    monkeypatch.setattr(S, "CHUNK", 900)
    rng = random.Random(10)
    base = "".join(rng.choice("abcdef") for _ in range(2600))
    rows = [(1, base), (2, base[300:1800] + "zz" + base[100:700]), (3, base[::-1] + base[480:520] + base[450:620])]
    assert got(make(spark, rows)) == sorted(brute(rows), key=str)


def test_blind_trie_sorts():
    rng = random.Random(11)
    strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(12)) for _ in range(400)]
    trie = S.BlindTrie()
    for i in range(len(strings)):
        trie.add(strings, i)
    assert [strings[i] for i in trie.ordered()] == sorted(strings)


def test_order_and_common_prefixes():
    rng = np.random.default_rng(12)
    rows = rng.integers(0, 2, (500, 100)).astype(np.uint8)
    rows[100:400] = rows[0]
    rows[200:400, 60:] = rng.integers(0, 2, (200, 40))
    group = rng.integers(0, 3, 500)
    order, lcp = S.sorted_with_lcp(group, rows)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for x in range(1, 500):
        (g, a), (h, b) = keys[x - 1], keys[x]
        assert lcp[x] == (-1 if g != h else next((i for i in range(100) if a[i] != b[i]), 100))


def test_hot_leads_are_dealt_by_window(spark):
    rng = random.Random(10)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    phrase, tails = text(60), [text(rng.randrange(20, 90)) for _ in range(6)]
    rows = [(i, text(rng.randrange(0, 40)) + rng.choice(tails) + phrase + rng.choice(tails) + text(30)) for i in range(80)]
    want = sorted(brute(rows), key=str)
    assert sum(r[2] for r in want)
    df = make(spark, rows)
    for hot, local in ((1, 1000), (5, 1000), (1000, 16), (1000, 1), (1, 1)):
        assert got(df, hot_kinds=hot, local_kinds=local) == want
    # hot in some batches only: those of few rows meet the others by the marker
    uneven = make(spark, rows[:70]).coalesce(1).unionByName(make(spark, rows[70:]).repartition(5))
    assert got(uneven, local_kinds=8) == want


def test_texts_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(20)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    a, b, c = text(300), text(300), text(500)
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (3, c[:250] + text(50)), (4, b[50:250])]
    out = {}
    for r in S.remove_repeats(make(spark, rows)).collect():
        out.setdefault((r.doc_id, r.n_bytes), []).append((r.n_removed, bytes(r.kept)))
    assert out[1, 300] == [(0, a.encode())]
    lost = sorted(x[0] for x in out[2, 300])
    assert lost == [0, 0, 300] and [x[1] for x in out[2, 300] if x[0] == 0] == [b.encode()] * 2  # a goes, both rows of b stay
    assert sorted(x[0] for k in ((3, 500), (3, 300)) for x in out[k]) == [0, 250]
    assert out[4, 200] == [(200, b"")]


def test_multikey_quicksort():
    rng = np.random.default_rng(3)
    for n, top in ((0, 3), (1, 3), (2000, 3), (2000, 2**63)):
        words = rng.integers(0, top, (n, 4), dtype=np.uint64)
        group = rng.integers(0, 5, n)
        order = S.multikey_quicksort(group, words)
        keys = [(group[i], *words[i]) for i in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)
