import hashlib
import math
import random
import re

import pytest

from weekly_impact.llm import pii as X
from weekly_impact.llm.queries import op8_pii_disclosure

from .conftest import make

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        odd = sum(int(c) for c in digits[-1::-2])
        even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
        return 12 <= len(digits) <= 19 and (odd + even) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    out = []
    for n, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), n, m.end()) for m in re.finditer(p, text or "") if passes(kind, m.group())]
    return sorted(out)


TEXTS = [
    "a@b.c@d.e x@y.z-1.q, .@a.b @c.d joe.b+x%y@mail8.example.com. me@host", "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.3.4 1.2.3 9.9.9.9.9",
    "4111 1111 1111 1111, 4111-1111-1111-1112 378282246310005 4111  1111", "+49 (30) 1234-5678 +1 2 +123456789012345678 ++44 20 7946 0958.",
    "0" * 5000, "a" * 5000 + "@x", "١٢٣.1.1.1.1 é@é.com 😀 x@y.zz", "", "+1.2.3.4 5.6.7.8@9.10", "1.1.1.1 4.111111111111111",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_the_patterns(text):
    assert X.base_spans(text) == brute(text)


def test_whole_table(spark, small_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = op8_pii_disclosure(spark, small_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        line = ",".join(f"{X.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_disclosing_term_near_an_entity(spark):
    rows = [(i, f"text {i} by Zanzibarov write to joe@corp.example now with thanks") for i in range(6)]
    rows += [(100 + i, f"thanks text with plain words number{i} write more") for i in range(60)]
    out = {r.doc_id: r for r in X.sanitise_documents(make(spark, rows)).collect()}
    assert out[0].disclosed["zanzibarov"] == pytest.approx(1.0) and "thanks" not in out[0].disclosed
    assert "Zanzibarov" not in out[0].redacted and "[EMAIL]" in out[0].redacted
    assert out[100].redacted is None and out[100].spans == []
    start = rows[0][1].index("Zanzibarov")
    assert ("term", start, start + 10) in [tuple(s) for s in out[0].spans]


def test_copies_of_one_text_give_no_statistics(spark):
    rows = [(i, "by Zanzibarov write to joe@corp.example") for i in range(6)] + [(100 + i, f"other words {i}") for i in range(60)]
    assert all(not r.disclosed for r in X.sanitise_documents(make(spark, rows)).collect())


def test_values_of_a_single_text_are_judged(spark):
    rows = [(0, "write soon to Quillfeather at jane@solo.example now thanks")]
    rows += [(i, f"reach us at the Ostrander desk via u{i}@guild.example now thanks") for i in range(10, 15)]
    rows += [(100 + i, f"write soon to us at the desk via post now thanks word{chr(97 + i % 26)}{i // 26}") for i in range(900)]
    out = {r.doc_id: r for r in X.sanitise_documents(make(spark, rows)).collect()}
    # one text: smoothed, so generalised and not removed; words that stand everywhere are left
    assert X.GENERALISE_AT <= out[0].disclosed["quillfeather"] < X.REMOVE_AT
    assert "[NAME] at [EMAIL]" in out[0].redacted and "thanks" not in out[0].disclosed
    # five addresses, each in one text: the mail domain says more than one text alone
    assert "Ostrander" not in out[10].redacted and "now thanks" in out[10].redacted
    assert out[10].disclosed["ostrander"] > out[0].disclosed["quillfeather"] * 0.99


def test_levels_of_the_kinds():
    text = "A@B.c 10.1.2.3, 4111-1111-1111-1111, +1 (017) 555-7713"
    assert [X.levels(text, x) for x in X.base_spans(text)] == [
        ["email:a@b.c", "email:@b.c", "email"], ["ip:10.1.2.3", "ip:10.1.2.*", "ip:10.1.*", "ip"],
        ["card:4111111111111111", "card:411111*", "card"], ["phone:10175557713", "phone:1017555*", "phone:1017*", "phone"]]


def test_disclosing_terms_are_masked_in_all_documents(spark):
    gap = " " * 200
    rows = [(i, f"plain words by Kim{gap}write to kim@corp.example plain words more plain words then Kim number{i}") for i in range(6)]
    rows += [(50, "plain words Kim, with more words"), (51, "KIM at 10.1.2.3 with words")]
    rows += [(100 + i, f"plain words by others write to more then at with number{i}") for i in range(200)]
    out = {r.doc_id: r for r in X.sanitise_documents(make(spark, rows)).collect()}
    # three letters, over 160 characters from the value, five words after it, and documents without the value
    assert "Kim" not in out[0].redacted and out[0].redacted.count("plain words") == 3
    assert out[50].redacted == "plain words , with more words" and [tuple(s) for s in out[50].spans] == [("term", 12, 15)]
    assert out[51].redacted == " at [IP] with words" and set(out[51].disclosed) == {"kim"}
    assert out[100].redacted is None and out[100].spans == [] and not out[100].disclosed


def test_term_filter_knows_its_terms(spark):
    terms = [f"wörd{i}" for i in range(3000)] + ["a", "日本語"]
    bits = X.term_filter(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert all(X.may_be_term(t, bits) for t in terms)
    assert sum(X.may_be_term(f"other{i}", bits) for i in range(3000)) < 10


def test_odd_documents(spark, odd_docs):
    out = X.sanitise_documents(odd_docs.withColumnsRenamed({"lang": "row", "source": "base"})).collect()
    assert len(out) == odd_docs.count()
    assert X.sanitise_documents(make(spark, [])).collect() == []


def brute_terms(rows):
    """term -> disclosure, document by document from the definition."""
    docs = [(t or "") for _, t in rows]
    n = len(docs)
    level_docs, pair_docs, pair_texts, term_docs, own = {}, {}, {}, {}, set()
    for t in docs:
        spans = X.base_spans(t)
        for w in {w.lower() for w in re.findall(r"[^\W\d_]+", t)}:
            term_docs[w] = term_docs.get(w, 0) + 1
        covered = [any(s <= i < e for s, _, e in spans) for i in range(len(t))]
        words = [m for m in re.finditer(r"[^\W\d_]+", t) if not any(covered[m.start():m.end()])]
        seen, levels = set(), set()
        for s, k, e in spans:
            held = X.levels(t, (s, k, e))
            levels.update(held)
            near = [m for m in words if m.end() <= s][-X.WINDOW:] + [m for m in words if m.start() >= e][:X.WINDOW]
            for m in near:
                for level in held:
                    own.add((held[0], level, m.group().lower()))
                    seen.add((level, m.group().lower()))
        for x in levels:
            level_docs[x] = level_docs.get(x, 0) + 1
        for x in seen:
            pair_docs[x] = pair_docs.get(x, 0) + 1
            pair_texts.setdefault(x, set()).add(t)
    best = {}
    for entity, level, term in own:
        seen = len(pair_texts[level, term])
        weight = seen / (seen + max(X.TRUSTED - seen, 0) * X.PRIOR / (X.TRUSTED - 1))
        lift = n * pair_docs[level, term] / (level_docs[level] * term_docs[term])
        pmi = math.log(weight * lift + 1 - weight)
        best[entity, term] = max(pmi, best.get((entity, term), -math.inf))
    out = {}
    for (entity, term), pmi in best.items():
        ic = math.log(n / level_docs[entity])
        out[term] = max(out.get(term, 0.0), min(pmi / ic, 1.0) if ic > 0 else 0.0)
    return {t: s for t, s in out.items() if s >= X.GENERALISE_AT}


@pytest.mark.parametrize("redacted", [True, False])
def test_terms_equal_brute_force(spark, redacted):
    rng = random.Random(6)
    names, plain = ["Abelard", "Kim", "Ostrander", "Zo", "Quill"], [f"w{chr(97 + i)}x" for i in range(15)]
    rows = []
    for i in range(160):
        words = rng.choices(plain, k=rng.randint(3, 14))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            who = rng.choice(names)
            value = rng.choice([f"{who.lower()}@corp.example", f"10.1.{len(who)}.{rng.randint(1, 3)}", "+1 (017) 555-7713"])
            at = rng.randint(0, len(words))
            words[at:at] = [who, value] if rng.random() < 0.7 else [value]
        rows.append((i, " ".join(words)))
    rows += [rows[3]] * 4 + [(900, None), (901, "")]
    want = brute_terms(rows)
    assert want
    told = {}
    out = X.sanitise_documents(make(spark, rows), redacted=redacted).collect()
    for r in out:
        told.update(r.disclosed)
    assert told.keys() == want.keys() and all(told[t] == pytest.approx(want[t]) for t in want)
    texts = dict(rows)
    for r in out:
        t = texts[r.doc_id] or ""
        spans = X.base_spans(t)
        expected = [(X.KINDS[k], s, e) for s, k, e in spans] + [
            ("term", m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", t)
            if m.group().lower() in want and not any(s < m.end() and m.start() < e for s, _, e in spans)]
        assert [tuple(x) for x in r.spans] == sorted(expected, key=lambda x: (x[1], X.KINDS.index(x[0])))
    assert ("redacted" in out[0].asDict()) == redacted
