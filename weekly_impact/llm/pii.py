"""Personal data: patterns, and terms that give away what the patterns protect.

Base spans (email, ip, card, phone) come from fixed patterns.  Their values
are the protected entities.  Over the whole corpus, the documents in which a
term stands near an entity (``WINDOW`` words on either side, whatever is between
them) are counted, and the documents of each entity and of each term.  Pointwise mutual information
against the entity's own information content,

    PMI(entity; term) / IC(entity),   PMI = ln(N n_et / (n_e n_t)),  IC = ln(N / n_e),

is the share of the entity's information that the term discloses: 1 if the
term occurs only where the entity does.  In all documents, with the entity or
without it, terms at or over ``REMOVE_AT`` for any entity are removed, those at
or over ``GENERALISE_AT`` are replaced by their shape class.  Words of any length
can be terms: the PMI is at most a term's own information content, so that
common short words stay.

No pair is too rare to be judged.  Co-occurrence is counted at the value and at
the coarser entities that hold it (mail domain, networks, phone and card
prefixes, kind); as P(value | term) = P(value | coarse) P(coarse | term), the
PMI of a coarser entity is an estimate of the value's own, and the largest is
taken.  At each of them the estimate is smoothed for rare pairs: the lift
N n_et / (n_e n_t) of a pair seen in k < ``TRUSTED`` different texts (counts
over 5 are taken as they are, as in Katz's discounting) is mixed with that of
independence, 1, with the weight k / (k + PRIOR (TRUSTED - k) / (TRUSTED - 1)).
Exact copies are one text: in a small corpus they give no statistics, in a large
one a word that only stands at one value still discloses it.

Counts are summed per task before they are shuffled.  The disclosing terms are
joined with the words of all documents in a shuffle; a Bloom filter of fixed
size keeps words that are no such term out of it.  What is written for a
document are its base spans and the places of the words that pass, not its
text; the text goes along only where the redacted text is asked for.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release
from .common import join_spread, slices, written

WINDOW = 4
TRUSTED = 6
PRIOR = 8.0
GENERALISE_AT = 0.5
REMOVE_AT = 0.8
COUNTED_TERMS = 200_000
FILTER_BITS = 25
CHUNK_BITS = 32_768
KINDS = ("email", "ip", "card", "phone", "term")
WORD = re.compile(r"[^\W\d_]+")
RUN_AT = re.compile(r"[A-Za-z0-9._%+-]+@?")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping matches, found from each run that an @ ends (linear in the text)."""
    end = 0
    if "@" in text:
        for m in RUN_AT.finditer(text):
            if m.group()[-1] == "@":
                start = max(m.start(), end)
                if start < m.end() - 1 and (d := DOMAIN.match(text, m.end())):
                    end = d.end()
                    yield start, end


def addresses(text: str):
    """Four dotted numbers of at most 255; a longer chain is cut into fours from its left."""
    for m in DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            length = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, at + length
            at += length + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order."""
    out = [(s, 0, e) for s, e in emails(text)] + [(s, 1, e) for s, e in addresses(text)]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def levels(text: str, span) -> list[str]:
    """The protected entities of a span: its value first, then coarser ones, its kind last."""
    s, k, e = span
    kind, value = KINDS[k], text[s:e].lower()
    if kind == "email":
        coarse = ["@" + value.rpartition("@")[2]]
    elif kind == "ip":
        parts = value.split(".")
        coarse = [".".join(parts[:n]) + ".*" for n in (3, 2)]
    else:
        value = re.sub("[^0-9]", "", value)
        coarse = [value[:6] + "*"] if kind == "card" else [value[:-n] + "*" for n in (4, 7)]
    return [f"{kind}:{x}" for x in (value, *coarse)] + [kind]


def words_outside(text: str, spans) -> list[re.Match]:
    """The words that overlap no span; ``spans``: (start, kind, end), sorted."""
    starts, ends = [], []
    for s, _, e in spans:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return [m for m in WORD.finditer(text) if not (i := bisect_left(starts, m.end())) or ends[i - 1] <= m.start()]


def near_terms(text: str, spans) -> set[tuple[str, str, str]]:
    """(entity, level, term) of one text: the lower-cased ``WINDOW`` words outside all spans before and after each span."""
    words = words_outside(text, spans)
    at = [m.start() for m in words]
    pairs = set()
    for s, k, e in spans:
        held = levels(text, (s, k, e))
        i, j = bisect_left(at, s), bisect_left(at, e)
        for m in words[max(0, i - WINDOW):i] + words[j:j + WINDOW]:
            pairs.update((held[0], x, m.group().lower()) for x in held)
    return pairs


SPANS = "array<struct<kind:string,start:int,end:int>>"
PAIRS = "array<struct<entity:string,level:string,term:string>>"
FOUND = f"text_key long, levels array<string>, pairs {PAIRS}, counted array<struct<level:string,term:string>>"
SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_pairs(docs: DataFrame) -> DataFrame:
    """(text_key, levels, pairs, counted) of the rows whose text has a span."""
    triple = pa.list_(pa.struct([("entity", pa.string()), ("level", pa.string()), ("term", pa.string())]))
    pair = pa.list_(pa.struct([("level", pa.string()), ("term", pa.string())]))

    def run(batches):
        for b in slices(batches):
            found = [(t, s) for t in b.column("text").to_pylist() if (s := base_spans(t or ""))]
            keys = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for t, _ in found]
            held = [sorted({x for span in s for x in levels(t, span)}) for t, s in found]
            pairs = [sorted(near_terms(t, s)) for t, s in found]
            counted = [sorted({(x, w) for _, x, w in p}) for p in pairs]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(held, pa.list_(pa.string())),
                pa.array([[{"entity": a, "level": x, "term": w} for a, x, w in p] for p in pairs], triple),
                pa.array([[{"level": x, "term": w} for x, w in p] for p in counted], pair),
            ], ["text_key", "levels", "pairs", "counted"])

    return docs.select("text").mapInArrow(run, FOUND)


def term_documents(docs: DataFrame) -> DataFrame:
    """(term, n_t): in how many documents each word occurs; tasks count first, in a bounded table."""

    def run(batches):
        counts: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

        for b in slices(batches):
            for t in b.column("text").to_pylist():
                counts.update({w.lower() for w in WORD.findall(t or "")})
            if len(counts) > COUNTED_TERMS:
                yield out()
                counts.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, disclosure, n_t) of the terms at or over the lower threshold: the largest share over all entities, the documents with the term."""
    n = float(max(docs.count(), 1))
    level = found.select(F.explode("levels").alias("level")).groupBy("level").agg(F.count("*").alias("n_l"))
    per_text = found.select("text_key", F.explode("counted").alias("p")).groupBy("p.level", "p.term", "text_key").agg(F.count("*").alias("n"))
    pair = per_text.groupBy("level", "term").agg(F.sum("n").alias("n_lt"), F.count("*").alias("texts"))
    # the kinds are in most rows, so their counts do not go through a join on the level
    kinds = {r["level"]: r["n_l"] for r in level.where(F.col("level").isin(*KINDS)).collect()}  # one row a kind
    of_kind = F.coalesce(*[F.when(F.col("level") == k, F.lit(c)) for k, c in kinds.items()], F.lit(None).cast("long"))
    is_kind = F.col("level").isin(*KINDS)
    counted = written(pair.where(~is_kind).join(level, "level").unionByName(pair.where(is_kind).withColumn("n_l", of_kind)), "pairs")
    # only terms of such pairs are looked up, so the vocabulary is cut to them where it is counted
    wanted = counted.select("term").distinct()
    terms = term_documents(docs).join(wanted, "term", "left_semi")
    lift = F.lit(n) * F.col("n_lt") / (F.col("n_l") * F.col("n_t"))
    weight = F.col("texts") / (F.col("texts") + F.greatest(F.lit(TRUSTED) - F.col("texts"), F.lit(0)) * (PRIOR / (TRUSTED - 1)))
    scored = counted.join(terms, "term").select(
        "level", "term", "n_t", F.log(weight * lift + 1 - weight).alias("pmi"), F.log(F.lit(n) / F.col("n_l")).alias("ic"))
    own = found.select(F.explode("pairs").alias("p")).select("p.*").distinct()
    information = F.max(F.when(F.col("level") == F.col("entity"), F.col("ic")))
    judged = own.join(scored, ["level", "term"]).groupBy("entity", "term").agg(F.max("pmi").alias("pmi"), information.alias("ic"), F.max("n_t").alias("n_t"))
    share = F.when(F.col("ic") > 0, F.least(F.col("pmi") / F.col("ic"), F.lit(1.0))).otherwise(0.0)
    return judged.groupBy("term").agg(F.max(share).alias("disclosure"), F.max("n_t").alias("n_t")).where(F.col("disclosure") >= GENERALISE_AT)


def term_filter(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of the terms, 2^``FILTER_BITS`` bits whatever their number: two places a term, from its xxhash64."""
    h, places = F.xxhash64("term"), 2 ** FILTER_BITS
    at = terms.select(F.explode(F.array(h, F.shiftrightunsigned(h, FILTER_BITS))).alias("h")).select(F.col("h").bitwiseAND(places - 1).alias("at"))
    bits = at.groupBy(F.floor(F.col("at") / CHUNK_BITS).alias("chunk")).agg(F.bitmap_construct_agg(F.col("at") % CHUNK_BITS).alias("bits"))
    out = np.zeros(places // 8, dtype=np.uint8)
    for r in bits.collect():  # 2^FILTER_BITS / CHUNK_BITS rows at most
        out[r["chunk"] * CHUNK_BITS // 8:(r["chunk"] + 1) * CHUNK_BITS // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def may_be_term(word: str, bits: np.ndarray) -> bool:
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=42)  # as Spark's xxhash64
    return all(bits[(x := y % 2 ** FILTER_BITS) >> 3] >> (x & 7) & 1 for y in (h, h >> FILTER_BITS))


PLACES = "array<struct<term:string,start:int,end:int>>"


def mark(docs: DataFrame, bits: np.ndarray, with_text: bool) -> DataFrame:
    """(doc_id, base, words[, text]): the base spans and the places of words that may be terms; texts only where there are any."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    place = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        known: dict[str, bool] = {}
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            spans = [base_spans(t) for t in texts]
            words = []
            for t, s in zip(texts, spans):
                if len(known) > COUNTED_TERMS:
                    known.clear()
                found = words_outside(t, s) if s else WORD.finditer(t)
                own = []
                for m in found:
                    w = m.group().lower()
                    if (may := known.get(w)) is None:
                        may = known[w] = may_be_term(w, shared.value)
                    if may:
                        own.append({"term": w, "start": m.start(), "end": m.end()})
                words.append(own)
            columns = [b.column("doc_id"), pa.array([[{"kind": KINDS[k], "start": x, "end": y} for x, k, y in s] for s in spans], SPAN), pa.array(words, place)]
            if with_text:
                columns.append(pa.array([t if s or w else None for t, s, w in zip(texts, spans, words)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "words", "text"][:len(columns)])

    return docs.mapInArrow(run, f"doc_id long, base {SPANS}, words {PLACES}" + (", text string" if with_text else ""))


def redact(text: str, spans, terms: dict[str, float]) -> str:
    """The text with base values masked, terms removed or generalised; ``spans``: (start, kind, end) in order."""
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            word = text[s:e]
            mask = f"[{kind.upper()}]" if kind != "term" else "" if terms[word.lower()] >= REMOVE_AT else "[NAME]" if word[0].isupper() else "[WORD]"
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitise_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redacted: bool = True) -> DataFrame:
    """(doc_id, spans, disclosed[, redacted]), one row per input row.

    ``spans``: base and term spans (kind, start, end; code points, end
    exclusive) by start, then kind.  ``disclosed``: the terms with their
    disclosure.  ``redacted``: the sanitised text, null where nothing was
    found and the text stays as it is; without it no text is written or
    shuffled.  Null texts count as empty; null ids and repeated rows stay rows
    of their own; an empty table gives no rows; other columns, whatever their
    names, are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(find_pairs(texts), "found")
    disclosing = written(disclosing_terms(found, texts), "disclosing")
    release(found)
    marked = written(mark(texts, term_filter(disclosing), redacted).withColumn("row", F.monotonically_increasing_id()), "marked")
    own = marked.where(F.size("words") > 0).select("row", F.explode(F.array_distinct("words.term")).alias("term"))
    own = join_spread(own, disclosing, ["term"], "n_t").where("disclosure is not null")
    per_row = own.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("disclosed"))
    none = F.expr("cast(map() as map<string,double>)")
    told = marked.join(per_row, "row", "left").withColumn("disclosed", F.coalesce("disclosed", none))
    # By start, then kind as listed; terms never overlap base spans.
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("kind"), s["end"].alias("end")))
    terms = F.transform(F.filter("words", lambda w: F.map_contains_key("disclosed", w["term"])),
                        lambda w: F.struct(w["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("kind"), w["end"].alias("end")))
    both = F.when(F.size("disclosed") == 0, base).otherwise(F.array_sort(F.concat(base, terms)))
    spans = F.transform(both, lambda s: F.struct(F.element_at(kinds, s["kind"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = told.select("doc_id", spans.alias("spans"), "disclosed", *(["text"] if redacted else []))
    if not redacted:
        return out

    def run(batches):
        for b in slices(batches):
            done = [redact(t, [(s["start"], s["kind"], s["end"]) for s in found], dict(terms)) if found else None
                    for t, found, terms in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "disclosed")))]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "spans", "disclosed")], pa.array(done, pa.string())],
                                             ["doc_id", "spans", "disclosed", "redacted"])

    return out.mapInArrow(run, f"doc_id long, spans {SPANS}, disclosed map<string,double>, redacted string")
