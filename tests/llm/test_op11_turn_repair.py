import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from weekly_impact.llm import queries as Q
from weekly_impact.llm import turn_repair as T

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"
SHORT = {"Keep": "K", "Rerole": "R", "Delete": "D", "Insert": "I"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        x = zlib.crc32(key.encode()) % 20
        if x == 0:
            continue
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        out += [(conv, turn, "user" if x == 4 else role, text)] * (2 if x == 3 else 1)
    return out


def brute_one(rows):
    """rows of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        fault = ""
        if not text.strip(WS):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(WS)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
    known = [r[1] for r in rows if r[1] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, audit, lines as tuple) of the rest; at most two inserts in a row pay."""
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            for initial, role in (("u", "user"), ("a", "assistant")):
                if (state, initial) in step:
                    c, a, t = best(i, initial, inserts + 1)
                    found.append((c + 2, "I" + a, ((role, ""), *t)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, a, t = best(i + 1, state, 0)
            found.append((c + 3, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                if (state, initials[i]) in step:
                    c, a, t = best(i + 1, step[state, initials[i]], 0)
                    found.append((c + late, "K" + a, ((role, text), *t)))
                for initial, new in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in step:
                        c, a, t = best(i + 1, initial, 0)
                        found.append((c + 2 + late, "R" + a, ((new, text), *t)))
        return min(found, default=(10**9, "", ()), key=lambda x: x[:2])

    for i in range(len(rows), 0, -1):  # keeps the recursion shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)


def brute(rows):
    kept = damaged(rows)
    groups = {r[0]: [] for r in rows}
    for r in kept:
        groups[r[0]].append(r)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {k: brute_one(v) if v else empty for k, v in groups.items()}


def results(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:9] for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(rng, convs, most, start=0):
    texts = ["Hello there.", "Yes", "No!", "", "  ", "Why?\n", "a.b", "x. y", ".", "Hm\t", "ok ok."]
    roles = ["user", "assistant", "system", "tool", "uncle", "", None]
    rows = []
    for c in range(start, start + convs):
        for t in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.05 else t + rng.choice([0, 0, 0, 5])
            text = None if rng.random() < 0.03 else rng.choice(texts) + (str(rng.random()) + "." if rng.random() < 0.5 else "")
            rows.append((c, turn, rng.choices(roles, [40, 40, 10, 4, 2, 2, 2])[0], text))
    return rows


@pytest.mark.parametrize("chunk", [2, 5, T.CHUNK])
def test_equals_brute_force(spark, chunk):
    rng = random.Random(chunk)
    rows = random_rows(rng, 60, 9) + random_rows(rng, 2, 120, 100)
    rows += [rows[3]] * 40 + [(None, None, None, None)] * 30 + [(None, 2, "user", "Hi."), (900, 5, "user", "   ")]
    # A chain of chunks that hold only rows to delete, between rows that stay.
    rows += [(777, t, "user", "Same.") for t in range(60)] + [(777, 99, "assistant", "End.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert results(T.repair_damaged(df, chunk)) == brute(rows)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(Q.op11_turn_repair(spark, path)) == brute(rows)


def test_repaired_rows_are_legal_and_chunks_make_no_difference(spark):
    rows = random_rows(random.Random(5), 30, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    damage = T.damage_turns(df)
    whole = T.repaired_turns(damage).orderBy("conv_id", "chunk", "step", "part").collect()
    cut = T.repaired_turns(damage, 3).orderBy("conv_id", "chunk", "step", "part").collect()
    assert [(r.conv_id, r.role, r.text, r.edit) for r in whole] == [(r.conv_id, r.role, r.text, r.edit) for r in cut]
    got = {}
    for r in whole:
        got.setdefault(r.conv_id, []).append(r.role[0])
        assert (r.edit == "insert") <= (r.text == "")
    assert all(re.fullmatch("s?(ua)+", "".join(x)) for x in got.values())


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair_damaged(empty).count() == 0
    rows = [(1, 1, "user", "Hi."), (1, 2, "assistant", "x" * 300_000 + ".")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cs", "k", "times", "audit", "gaps", "Part"):
        df = df.withColumn(name, F.lit("other"))
    assert results(T.repair_damaged(df)) == brute(rows)


def test_rerun_equals_a_run_from_the_start():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 12)
        codes = "".join(rng.choice("suao") + rng.choice("bdtff") for _ in range(n))
        copies = [rng.randint(1, 3) if codes[2 * i + 1] in "bd" else 1 for i in range(n)]
        old = T.run_back("uf" + "at", [1, 1], T.END)
        new = T.run_back("sfat", [1, 1], T.END)
        assert T.rerun(codes, copies, old, T.run_back(codes, copies, old), new) == T.run_back(codes, copies, new)
