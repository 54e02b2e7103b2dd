import zlib

import numpy as np
import pytest

from weekly_impact.llm import toxicity as X
from weekly_impact.llm.queries import op9_toxic_neighbours

from .conftest import make

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = op9_toxic_neighbours(spark, sf).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, toxic[r.doc_id], r.predicted) for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    assert np.mean([y == p for _, y, p in held]) >= 0.9
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) >= 0.95


def test_nearest_equals_brute_force_cosine():
    rng = np.random.default_rng(1)
    idf = {f"t{i}": 1 + i / 10 for i in range(60)}
    texts = [" ".join(f"t{i}" for i in rng.integers(0, 60, rng.integers(0, 12))) for _ in range(700)]
    vectors = [X.vector(t, idf) for t in texts]
    index = X.BlockMaxIndex(list(range(700)), [i % 2 for i in range(700)], vectors)
    for q in vectors[:60]:
        sims = sorted((-sum(w * v.get(t, 0) for t, w in q.items()), i) for i, v in enumerate(vectors))
        want = [(-s, i) for s, i in sims if s < 0][:X.NEIGHBOURS]
        near = index.nearest(q, X.NEIGHBOURS)
        assert np.allclose([s for s, _, _ in near], [s for s, _ in want])
        edge = want[-1][0] + 1e-9 if want else 1
        assert {i for s, i, _ in near if s > edge} == {i for s, i in want if s > edge}


def test_isotonic_is_increasing():
    rng = np.random.default_rng(2)
    v = rng.random(400)
    knots, p = X.isotonic(v.tolist(), (rng.random(400) < v).astype(int).tolist())
    assert knots == sorted(knots) and p == sorted(p) and 0 < p[0] and p[-1] < 1


def test_odd_tables(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1), (4, 0, 0), (99, 0, 1)], LABELS)
    out = X.score_toxicity(odd_docs.withColumnsRenamed({"lang": "Score", "source": "evidence"}), labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert X.score_toxicity(make(spark, []), labels).collect() == []
    none = X.score_toxicity(odd_docs, spark.createDataFrame([], LABELS)).collect()
    assert len({r.score for r in none}) == 1 and not any(r.predicted for r in none)


def test_labels_of_held_out_rows_change_nothing(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = make(spark, [(i, ("awful nasty " if i % 3 == 0 else "nice calm ") + f"w{i % 40} v{i % 7}") for i in range(400)])
    right = [(i, 1, int(i % 3 == 0)) for i in range(400)]
    wrong = [(i, q, 1 - t if i in set(held) else t) for i, q, t in right]
    a, b = ({r.doc_id: r.score for r in X.score_toxicity(docs, spark.createDataFrame(x, LABELS)).collect()} for x in (right, wrong))
    assert a == b and all((a[i] >= 0.5) == (i % 3 == 0) for i in range(400))


@pytest.mark.parametrize("n", [24, 60])
def test_few_labels_are_enough(spark, n):
    ids = [i for i in range(10 * n) if zlib.crc32(str(i).encode()) % 5][:n]
    text = {i: ("awful nasty vile " if i % 2 else "nice calm kind ") + f"w{i % 11} v{i % 7}" for i in range(10 * n)}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], LABELS)
    out = X.score_toxicity(make(spark, list(text.items())), labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in out)


def brute_scores(docs, labels, k=X.NEIGHBOURS):
    """Scores by whole passes in plain Python: no index, no sharing between documents."""
    toxic = {}
    for i, y in labels:
        if zlib.crc32(str(i).encode()) % 5:
            toxic[i] = max(y, toxic.get(i, 0))
    text = dict(docs)
    train = sorted(i for i in toxic if i in text)
    t = sum(toxic[i] for i in train)
    c = len(train) - t
    has = {i: set(X.terms_of(text[i])) for i in train}
    idf, every = {}, set().union(*has.values())
    for term in every:
        a = sum(term in has[i] for i in train if toxic[i])
        b = sum(term in has[i] for i in train if not toxic[i])
        table = np.array([[a, t - a], [b, c - b]], dtype=float)
        want = np.outer(table.sum(1), table.sum(0)) / table.sum()
        if (want > 0).all() and ((table - want) ** 2 / want).sum() >= X.least_chi2(len(every), len(train)):
            idf[term] = np.log((1 + len(docs)) / (1 + sum(term in X.terms_of(x) for _, x in docs))) + 1

    def vector(x):
        n = {}
        for term in X.terms_of(x):
            if term in idf:
                n[term] = n.get(term, 0) + 1
        w = {term: (1 + np.log(m)) * idf[term] for term, m in n.items()}
        norm = np.sqrt(sum(v * v for v in w.values()))
        return {term: v / norm for term, v in w.items()}

    examples = {i: vector(text[i]) for i in train}

    def vote(x, but=None):
        q = vector(x)
        sims = [(sum(w * e.get(term, 0) for term, w in q.items()), -i, toxic[i]) for i, e in examples.items() if i != but]
        near = sorted((s for s in sims if s[0] > 1e-12), reverse=True)[:k]
        w = [s / (1.05 - min(s, 1)) for s, _, _ in near]
        return sum(a for a, s in zip(w, near) if s[2]) / sum(w) if near else None

    votes = [(vote(text[i], i), toxic[i]) for i in train]
    silent = [y for v, y in votes if v is None]
    known = sorted((v, y) for v, y in votes if v is not None)
    # Pooled labels by the max-min formula of isotonic regression.
    y = np.array([b for _, b in known], dtype=float)
    fit = [max(min(y[a:z + 1].mean() for z in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
    knots, at = [], 0
    while at < len(y):
        end = at
        while end + 1 < len(y) and abs(fit[end + 1] - fit[at]) < 1e-12:
            end += 1
        knots.append((np.mean([v for v, _ in known[at:end + 1]]), (y[at:end + 1].sum() + 0.5) / (end - at + 2)))
        at = end + 1
    out = {}
    for i, x in docs:
        v = vote(x)
        out[i] = (sum(silent) + 0.5) / (len(silent) + 5) if v is None else float(np.interp(v, *zip(*knots)))
    return out


def test_whole_scores_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"word{chr(97 + i % 26)}{i}" for i in range(120)]
    docs, labels = [], []
    for i in range(220):
        y = int(rng.random() < 0.3)
        mine = rng.choice(words, 8).tolist() + (rng.choice(["vile", "nasty", "awful"], 2).tolist() if y and rng.random() < 0.9 else [])
        docs.append((i, " ".join(mine)))
        if i < 150:
            labels.append((i, y))
    docs.append((900, "nothing known"))
    table = spark.createDataFrame([(i, 1, y) for i, y in labels], LABELS)
    out = {r.doc_id: r.score for r in X.score_toxicity(make(spark, docs), table).collect()}
    want = brute_scores(docs, labels)
    assert out.keys() == want.keys()
    assert max(abs(out[i] - want[i]) for i in want) < 1e-9
