import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekly_impact.llm import chat_format as C
from weekly_impact.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in groups.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def results(df):
    rows = df.collect()
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_and_the_probe(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    out = Q.op12_chat_format(spark, path)
    assert out.columns[:6] == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert results(out) == brute(rows + probe)
    lengths = {c: sum(len(t) for x, _, _, t in rows if x == c) for c in {r[0] for r in rows}}
    assert all(r.formatted_chars > lengths.get(r.conv_id, 0) for r in out.collect())


def test_odd_rows(spark):
    rng = random.Random(3)
    bits = [*C.INSTRUCT.controls, "\\", "\\\\", "<", "/s>", "s>", "[", " ", "\n", "ok", "naïve 日本 😀", "[/INST", "{role}"]
    roles = ["user", "assistant", "system", "tool", "", None, "[TEXT]", "us\\er", "a</s>"]
    rows = [(c, None if rng.random() < 0.1 else rng.randint(0, 5), rng.choice(roles), "".join(rng.choices(bits, k=rng.randint(0, 9))))
            for c in range(40) for _ in range(rng.randint(1, 9))]
    rows += [(None, None, None, None)] * 3 + [(7, 1, "user", "x")] * 4 + [(99, 1, "assistant", "long <s> \\ " * 40_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("place", "segments", "state", "Valid"):
        df = df.withColumn(name, F.lit("other"))
    assert results(C.digest_conversations(C.format_turns(df))) == brute(rows)
    assert C.digest_conversations(C.format_turns(df.limit(0))).count() == 0


def test_a_conversation_over_many_batches(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} [INST]") for t in range(3000)] + [(2, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = C.digest_conversations(C.format_turns(df))
    assert results(out) == brute(rows)
    assert {r.conv_id: (r.valid, r.first_fault) for r in out.collect()} == {1: (True, None), 2: (False, None)}


@pytest.mark.parametrize("roles, valid, fault", [
    ("system user assistant", True, None), ("user assistant user assistant", True, None), ("assistant", False, 0), ("user user", False, 1),
    ("system", False, None), ("user system", False, 1), ("user assistant tool assistant", False, 2), ("user assistant assistant user", False, 2)])
def test_machine(spark, roles, valid, fault):
    df = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(roles.split())], SCHEMA)
    r = C.digest_conversations(C.format_turns(df)).first()
    assert (r.valid, r.first_fault) == (valid, fault)


def test_segments_and_another_template(spark):
    rows = [(1, 0, "user", "Hi <|x|> <|end|>"), (1, 1, "assistant", "Yo")]
    own = C.Template(turns={"user": ("<|user|>", "<|end|>"), "assistant": ("<|bot|>", "<|end|>")}, other=("<|role|>{role}<|x|>", "<|end|>"),
                     loss=frozenset({"user"}), moves={C.START: ("user",), "user": ("assistant",), "assistant": ("user",)}, final=("assistant",),
                     controls=("<|user|>", "<|bot|>", "<|role|>", "<|x|>", "<|end|>"))
    out = C.format_turns(spark.createDataFrame(rows, SCHEMA), own).orderBy("place").collect()
    assert [(s.text, s.loss) for s in out[0].segments] == [("<|user|>", False), ("Hi <\\|x|> <\\|end|>", True), ("<|end|>", False)]
    text = "".join(s.text for r in out for s in r.segments)
    assert C.read_back(text, own, C.reader(own)) == [("user", "Hi <|x|> <|end|>"), ("assistant", "Yo")]
    with pytest.raises(ValueError):
        C.Template(turns={"user": ("U", "<e>")}, other=("<r>{role}<t>", "<e>"), loss=frozenset(), moves={}, final=(), controls=("<r>", "<t>", "<e>"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*C.INSTRUCT.controls, "\\", "<", "[", "/", "s>", " ", "x"]), max_size=12))
def test_escape_is_reversible(bits):
    text = "".join(bits)
    out = text.replace("\\", "\\\\")
    for c in C.INSTRUCT.controls:
        out = out.replace(c, c[0] + "\\" + c[1:])
    assert C.unescape(out) == text and not any(c in out for c in C.INSTRUCT.controls)
