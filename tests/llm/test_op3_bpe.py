import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from weekly_impact.llm import bpe
from weekly_impact.llm.queries import op3_byte_bpe

from .conftest import make

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_query_equals_tiktoken_on_the_whole_table(spark, small_dir, own):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = op3_byte_bpe(spark, small_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = own.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_documents_round_trip(odd_docs, own):
    extra = odd_docs.withColumnsRenamed({"lang": "IDS", "source": "decoded"})
    out = bpe.decode_documents(bpe.encode_documents(extra, PATH, P.PATTERN), PATH, P.PATTERN)
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids == own.encode_ordinary(r.text or "")


def test_special_texts(spark, own):
    texts = ["<|endoftext|> ▁ x\u0000y", "x" * 3000, " " * 500 + "z", "a\n\n  b\t\tc   ", "’s don't 12345 ½ Ⅷ é", "\x85 　 q"]
    rows = bpe.encode_documents(make(spark, list(enumerate(texts))), PATH, P.PATTERN).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}


def test_empty_table(spark):
    out = bpe.decode_documents(bpe.encode_documents(make(spark, []), PATH, P.PATTERN), PATH, P.PATTERN)
    assert out.collect() == [] and out.columns[-2:] == ["ids", "decoded"]
