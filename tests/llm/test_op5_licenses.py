import re
from itertools import product
from re import _parser

from weekly_impact.llm import licenses as L
from weekly_impact.llm.license_rules import rules
from weekly_impact.llm.queries import op5_license_scan

from .conftest import make

COLS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    ws = words_of(text)
    joined = " " + "".join(w + " " for w in ws)
    places = []
    for phrase, label in L.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]
    found = []
    for r in rules():
        if r["keyword"] in joined:
            for m in re.finditer(r["regex"], joined):
                start = joined[: m.start()].count(" ") - 1
                found.append((start, start + m.group().count(" ") + 1, r["priority"], r["n"], r["label"]))

    def beats(e, d):
        return e[0] <= d[0] and e[1] >= d[1] and (e[2], e[1] - e[0], -e[3]) > (d[2], d[1] - d[0], -d[3])

    kept = [d for d in found if not any(beats(e, d) for e in found)]
    base = sorted({x for _, x in places})
    score = max([L.CONFIDENCE[d[2]] for d in kept] + [0.4] * bool(places), default=0.0)
    return (len(ws), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(base), ",".join(sorted({*base, *(d[4] for d in kept)})), score)


def check(df):
    for r in L.scan_licenses(df).collect():
        assert tuple(r[c] for c in COLS) == brute(r.text), (r.doc_id, (r.text or "")[:80])


def test_whole_table(spark, small_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = op5_license_scan(spark, small_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COLS) == brute(texts[r.doc_id])


def test_odd_documents(odd_docs):
    check(odd_docs)
    assert L.scan_licenses(odd_docs).count() == odd_docs.count()


def test_overlaps_and_priorities(spark):
    texts = [
        "CC-BY cc by cc by-sa 4.0; Creative Commons Attribution-ShareAlike 4.0 International.",
        "GNU Lesser General Public License version 2.1, GNU GENERAL PUBLIC LICENSE v3 or Apache License, Version 2.0",
        "All rights reserved all RIGHTS reserved. Some rights reserved. Copyright (c) 2020",
        "the MIT License; Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "general public licence; general  public\nlicense, xgeneral public license", "É cc by", "ccé by", "cc by" * 50,
    ]
    check(make(spark, list(enumerate(texts))))


def test_every_rule_compiles_and_rules_are_unique(spark):
    rs = rules()
    assert len(rs) > 190 and len({(r["label"], r["regex"]) for r in rs}) == len(rs)
    for r in rs:
        re.compile(r["regex"])


def one_of(members):
    """A character class again, from its parsed members."""
    kinds = {"CATEGORY_NOT_SPACE": r"\S"}
    text = ""
    for op, v in members:
        text += re.escape(chr(v)) if str(op) == "LITERAL" else f"{re.escape(chr(v[0]))}-{re.escape(chr(v[1]))}" if str(op) == "RANGE" else kinds[str(v)]
    return f"[{text}]"


def strings_of(parsed):
    """Strings that a parsed regex matches: every branch, the ends of classes, repeats at their least and one more."""
    parts = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "IN":
            found = [c for c in map(chr, range(32, 127)) if re.fullmatch(one_of(arg), c)]
            parts.append([found[0], found[-1]])
        elif name == "SUBPATTERN":
            parts.append(strings_of(arg[3]))
        elif name == "BRANCH":
            parts.append([x for b in arg[1] for x in strings_of(b)])
        elif name == "MAX_REPEAT":
            parts.append([x * n for n in {arg[0], min(arg[0] + 1, int(arg[1]))} for x in strings_of(arg[2])])
        else:
            assert name == "ASSERT", name
    return sorted({"".join(p) for p in product(*parts)})


def test_every_match_holds_its_keyword():
    for r in rules():
        for s in strings_of(_parser.parse(r["regex"])):
            assert re.search(r["regex"], f" {s} "), (r, s)
            assert r["keyword"] in f" {s} ", (r["label"], r["keyword"], s)


def test_matches_that_a_strict_keyword_dropped(spark):
    texts = ["under the Open RAIL-M licence here", "Licence Ouverte 2.0", "see licence MIT here", "Etalab 2.0", "license: MIT", "OpenRAIL"]
    out = {r.doc_id: r.labels for r in L.scan_licenses(make(spark, list(enumerate(texts)))).collect()}
    want = ["openrail-m", "etalab-2.0", "mit", "etalab-2.0", "mit", "openrail-m"]
    assert all(w in out[i].split(",") for i, w in enumerate(want)), out


def test_plan_is_native_without_shuffle(spark):
    df = L.scan_licenses(make(spark, [(1, "cc by")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty_table_and_clashing_columns(spark):
    assert L.scan_licenses(make(spark, [])).collect() == []
    df = make(spark, [(1, "cc by x")]).withColumnsRenamed({"lang": "Labels", "source": "_words"})
    check(df)
