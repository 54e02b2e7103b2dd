import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from weekly_impact.llm import bpe, toxicity
from weekly_impact.llm.common import table

from . import test_op4_line_dedup as op4
from . import test_op6_decontamination as op6
from . import test_op7_simhash as op7


def test_run_equals_brute_force(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    model = toxicity.fit(docs, table(spark, small_dir, "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model.score(t)[0] < 0.5]
    rows = [(i, t) for i, _, _, t in op4.brute(rows)]
    keep = {i for i, _, c in op7.brute(rows) if i == c}
    rows = [(i, t) for i, t in rows if i in keep]
    leaks = {x[0] for x in op6.brute(rows, [(r.item_id, r.text) for r in table(spark, small_dir, "benchmark").collect()])}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {i: own.encode_ordinary(t) for i, t in rows if i not in leaks}
    out = C.run(spark, small_dir).collect()
    assert {r.doc_id: r.ids for r in out} == want and len(out) == len(want) < docs.count()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)


def test_stages_keep_columns_and_survive_odd_rows(spark, odd_docs, small_dir):
    docs = odd_docs
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, small_dir)
        assert docs.columns == odd_docs.columns, name
    kept = docs.collect()
    assert len([r for r in kept if r.doc_id is None]) == 2 and len({r.doc_id for r in kept if r.doc_id is not None}) == len(kept) - 2
    assert C.STAGES[-1][1](spark, docs, small_dir).count() == len(kept)
    empty = odd_docs.limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, small_dir)
    assert empty.count() == 0


def test_texts_of_one_id_in_different_groups_both_stay(spark, docs_of, small_dir):
    a, b = ("alpha beta gamma delta epsilon zeta eta theta " * 3).strip(), ("one two three four five six seven eight nine " * 3).strip()
    docs = docs_of([(1, a), (1, b), (2, a), (3, b), (1, a), (5, "something else altogether that is alone here"), (None, a)])
    kept = C.one_of_each_group(spark, docs.withColumns({"text_a": docs.lang, "_TEXT_B": docs.lang}), small_dir)
    assert kept.columns[-2:] == ["text_a", "_TEXT_B"] and {r.text_a for r in kept.collect()} == {"en"}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (1, b), (5, "something else altogether that is alone here"), (None, a)], key=str)
