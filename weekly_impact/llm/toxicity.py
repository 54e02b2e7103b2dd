"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of the labelled training rows.  The terms that
separate their labels are the vocabulary: those whose chi-square is so large
that among as many terms without any relation one would reach it with the
probability ``FALSE_TERM`` only, or at least half its largest possible value,
the number of examples, where these are too few for that.  Inverse document frequencies
are counted over all documents.  An example is its L2-normalised TF-IDF vector
over the vocabulary.  The inverted index keeps, per term, the
postings cut into blocks of examples and each block's largest weight; a query
visits blocks in the order of their upper bounds and stops when no block left
can beat the k-th similarity, so the k nearest are exact.  Neighbours vote by
similarity; an isotonic fit of the votes that training examples get from the
others turns votes into probabilities.  The neighbours are the evidence.

The index is bounded by ``MAX_EXAMPLES`` and their words whatever the tables'
size, which is what allows sending it to all tasks; every document is scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import release
from .common import slices, without, written

MAX_EXAMPLES = 8192
FALSE_TERM = 0.01
NEIGHBOURS = 25
BLOCK = 64
STEM = 4
WORD = re.compile(r"[^\W_]+")
ADDED = ("held_out", "score", "predicted", "evidence")
EVIDENCE = "array<struct<doc_id:long,similarity:double,toxic:int>>"


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def terms_of(text: str | None) -> list[str]:
    """The lower-cased words, and the stems (first ``STEM`` letters) of longer ones."""
    words = WORD.findall((text or "").lower())
    return words + [w[:STEM] + "~" for w in words if len(w) > STEM]


def training_examples(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, toxic) of at most ``max_examples`` labelled training ids, chosen by hash.

    Rows with a null id or label are no examples; an id with several labels is
    toxic if one says so; a repeated id gives its smallest text.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold() != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)  # the sample's documented bound
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def term_counts(examples: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many examples of either label a term occurs, counted per task first."""

    def run(batches):
        for b in batches:
            by = (Counter(), Counter())
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                by[y].update(set(terms_of(t)))
            terms = list(by[0] | by[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in (by[1], by[0])]], ["term", "toxic", "clean"])

    counts = examples.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
    return counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def least_chi2(terms: int, examples: int) -> float:
    """The quantile of chi-square with one degree of freedom at 1 - ``FALSE_TERM`` / terms (by its tail's expansion)."""
    rare = 2 * math.log(max(terms, 1) / FALSE_TERM)
    return min(rare - math.log(rare) - math.log(math.pi / 2), examples / 2)


def vocabulary(examples: DataFrame) -> list[str]:
    """The terms that separate the labels, sorted."""
    n = examples.agg(F.count_if(F.expr("toxic = 1")).alias("t"), F.count_if(F.expr("toxic = 0")).alias("c")).first()
    t, c = n["t"], n["c"]
    if not t or not c:
        return []
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    # A term of all examples separates nothing (0 / 0).
    chi2 = (t + c) * F.pow(a * (c - b) - b * (t - a), 2) / (F.lit(float(t) * c) * (a + b) * F.greatest(t + c - a - b, F.lit(0.5)))
    counted = written(term_counts(examples).withColumn("chi2", chi2), "terms")
    rows = counted.where(F.col("chi2") >= least_chi2(counted.count(), t + c)).select("term").collect()  # words of at most max_examples texts
    release(counted)
    return sorted(r["term"] for r in rows)


def document_frequencies(docs: DataFrame, terms: list[str], text_col: str = "text") -> dict[str, float]:
    """Smoothed inverse document frequencies of the terms over all documents; tasks count first."""
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(terms))

    def run(batches):
        counts: Counter[str] = Counter()
        n = 0
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                n += 1
                counts.update(wanted.value.intersection(terms_of(t)))
        counts[""] = n  # no term is empty: the number of documents
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    known = {r["term"]: r["n"] for r in counted.collect()}  # one row a term
    wanted.destroy()
    n = known.get("", 0)
    return {t: math.log((1 + n) / (1 + known.get(t, 0))) + 1 for t in terms}


def vector(text: str | None, idf: dict[str, float]) -> dict[str, float]:
    """The L2-normalised TF-IDF vector; empty if no term occurs."""
    n = Counter(filter(idf.__contains__, terms_of(text)))
    w = {t: (1 + math.log(k)) * idf[t] for t, k in n.items()}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / norm for t, x in w.items()}


class BlockMaxIndex:
    """Exact k nearest examples by cosine; examples with an empty vector are not in it."""

    def __init__(self, ids: list[int], toxic: list[int], vectors: list[dict[str, float]]):
        # like examples share blocks: by label and strongest term, so that upper bounds are tight
        order = sorted((i for i, v in enumerate(vectors) if v), key=lambda i: (toxic[i], max(vectors[i], key=lambda t: (vectors[i][t], t)), ids[i]))
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.toxic = np.array([toxic[i] for i in order], dtype=np.int64)
        self.blocks: list[dict[str, tuple[np.ndarray, np.ndarray]]] = []
        largest: dict[str, list[tuple[int, float]]] = {}
        for start in range(0, len(order), BLOCK):
            postings: dict[str, list[tuple[int, float]]] = {}
            for slot, i in enumerate(order[start:start + BLOCK]):
                for t, x in vectors[i].items():
                    postings.setdefault(t, []).append((slot, x))
            self.blocks.append({t: (np.array([s for s, _ in p]), np.array([x for _, x in p])) for t, p in postings.items()})
            for t, p in postings.items():
                largest.setdefault(t, []).append((start // BLOCK, max(x for _, x in p)))
        self.largest = {t: (np.array([b for b, _ in p]), np.array([x for _, x in p])) for t, p in largest.items()}

    def nearest(self, q: dict[str, float], k: int, but: int | None = None) -> list[tuple[float, int, int]]:
        """(similarity, id, label) of the k nearest with a similarity over 0; ties go to the smaller id."""
        bound = np.zeros(len(self.blocks))
        for t, w in q.items():
            if t in self.largest:
                at, x = self.largest[t]
                bound[at] += w * x
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] < -best[-1][0] - 1e-12:
                break
            score = np.zeros(BLOCK)
            for t, w in q.items():
                if (p := self.blocks[b].get(t)) is not None:
                    score[p[0]] += w * p[1]
            least = -best[-1][0] if len(best) == k else 0.0
            for s in np.flatnonzero((score > 0) & (score >= least)):
                i = int(b) * BLOCK + int(s)
                if self.ids[i] != but:
                    best.append((-float(score[s]), int(self.ids[i]), int(self.toxic[i])))
            best = sorted(best)[:k]
        return [(-s, i, y) for s, i, y in best]


def vote(near: list[tuple[float, int, int]]) -> float:
    """The share of toxic neighbours, weighted by the inverse of the distance 1 - cosine."""
    w = [1 / (1.05 - min(s, 1.0)) * s for s, _, _ in near]
    return sum(x for x, n in zip(w, near) if n[2]) / sum(w)


def isotonic(votes: list[float], labels: list[int]) -> tuple[list[float], list[float]]:
    """Pool-adjacent-violators fit: knots (vote, probability), both increasing, smoothed by one pseudo-count each way."""
    pools: list[list[float]] = []  # sum of votes, of labels, count
    for v, y in sorted(zip(votes, labels)):
        pools.append([v, y, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            p = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], p)]
    return [p[0] / p[2] for p in pools], [(p[1] + 0.5) / (p[2] + 1) for p in pools]


class Model:
    """Vocabulary, index and calibration; small by its bounds."""

    def __init__(self, idf, index, knots=None, no_evidence=0.0):
        self.idf, self.index, self.knots, self.no_evidence = idf, index, knots, no_evidence

    def raw(self, text, but=None):
        q = vector(text, self.idf)
        near = self.index.nearest(q, NEIGHBOURS, but) if q else []
        return (vote(near) if near else None), near

    def score(self, text):
        v, near = self.raw(text)
        if v is None or not self.knots or not self.knots[0]:
            return (self.no_evidence if v is None else v), near
        return float(np.interp(v, *self.knots)), near


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model from at most ``max_examples`` labelled training rows; without both labels it scores all alike."""
    examples = written(training_examples(docs, labels, max_examples, id_col, text_col), "examples")
    idf = document_frequencies(docs, vocabulary(examples), text_col)

    def vectors(batches):
        for b in batches:
            v = [vector(t, idf) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic"), pa.array([list(x) for x in v], pa.list_(pa.string())),
                 pa.array([list(x.values()) for x in v], pa.list_(pa.float64()))], ["doc_id", "toxic", "terms", "weights"])

    made = examples.mapInArrow(vectors, "doc_id long, toxic int, terms array<string>, weights array<double>")
    rows = made.orderBy("doc_id").collect()  # at most max_examples rows
    index = BlockMaxIndex([r["doc_id"] for r in rows], [r["toxic"] for r in rows], [dict(zip(r["terms"], r["weights"])) for r in rows])
    model = Model(idf, index)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def left_out(batches):
        for b in batches:
            v = [shared.value.raw(t, i)[0] for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.float64()), b.column("toxic")], ["vote", "toxic"])

    votes = examples.mapInArrow(left_out, "vote double, toxic int").collect()  # at most max_examples pairs
    shared.destroy()
    known = [(r["vote"], r["toxic"]) for r in votes if r["vote"] is not None]
    silent = [r["toxic"] for r in votes if r["vote"] is None]
    model.knots = isotonic([v for v, _ in known], [y for _, y in known])
    model.no_evidence = (sum(silent) + 0.5) / (len(silent) + 5)
    release(examples)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """The input's columns and held_out, score, predicted and evidence (nearest examples, at most ``NEIGHBOURS``).

    Only the text is an input of a score.  Null and empty texts, and texts
    without any term of the vocabulary, get the smoothed toxic share of such
    examples.  A null id is not held out and never an example; repeated rows
    stay; an empty table gives no rows; clashing columns are replaced.
    """
    model = model or fit(docs, labels, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = without(docs, *ADDED).withColumn("held_out", F.coalesce(fold(id_col) == 0, F.lit(False)))
    at, n = docs.columns.index(text_col), len(docs.columns)
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
              T.StructField("evidence", T.ArrayType(T.StructType([
                  T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("toxic", T.IntegerType())])))]
    near_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        for b in slices(batches):
            done = [shared.value.score(t) for t in b.column(at).to_pylist()]
            scores = [min(1.0, max(0.0, s)) for s, _ in done]
            near = [[{"doc_id": i, "similarity": s, "toxic": y} for s, i, y in x] for _, x in done]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(near, near_type)],
                [*b.schema.names, *ADDED[1:]])

    assert n == len(docs.columns)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
