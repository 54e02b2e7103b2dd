"""Licence scan: ordered signature rules over a text's words, overlaps resolved.

Each rule's regex runs only on texts holding its keyword.  Every match is an
interval of words.  An interval lying inside another one is suppressed if the
other has the higher priority, or the same priority and more words, or the
same priority and words and an earlier rule.  The three base phrases (see
``license_rules``: labels gpl, cc-by, reserved) are also counted on their own,
wherever their words stand, and their labels always stay.

Only DataFrame functions and no shuffle: everything about a document happens
in its row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, without
from .license_rules import rules

# Fixed by the contract: phrase (words) and its label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CONFIDENCE = {3: 1.0, 2: 0.8, 1: 0.4}
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")


def blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def word_string(text: Column) -> Column:
    """Blank, the words joined by one blank, blank; one blank if there are no words."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    inner = F.trim(F.regexp_replace(lower, NOT_WORD, " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def intervals(words: Column, rule: Column) -> Column:
    """All matches of a rule as structs (start, end, priority, n, label); words from 0, end exclusive."""
    gaps = F.split(words, rule["regex"], -1)
    hits = F.regexp_extract_all(words, rule["regex"], F.lit(0))

    def step(acc, i):
        start = acc["before"] + blanks(F.get(gaps, i)) - 1
        stop = start + blanks(F.get(hits, i)) + 1
        # a match's own words but the last end with a blank inside it
        return F.struct((acc["before"] + blanks(F.get(gaps, i)) + blanks(F.get(hits, i))).alias("before"),
                        F.array_append(acc["out"], F.struct(start.alias("start"), stop.alias("end"))).alias("out"))

    none = F.struct(F.lit(0).alias("before"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))
    order = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    found = F.aggregate(order, none, step, lambda s: s["out"])
    return F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("minus_end"), (-rule["priority"]).alias("minus_priority"),
        rule["n"].alias("n"), rule["label"].alias("label")))


def unsuppressed(found: Column) -> Column:
    """The detections that no better one contains, by one sweep.

    In the order start, longest, best priority, rule, whatever contains a
    detection and beats it stands before it; the furthest end so far of each
    priority and above then decides.
    """
    spans = "array<struct<start:int,minus_end:int,minus_priority:int,n:int,label:string>>"
    none = F.struct(*[F.lit(-1).alias(f"end{p}") for p in (1, 2, 3)], F.expr(f"cast(array() as {spans})").alias("kept"))

    def step(acc, d):
        end, priority = -d["minus_end"], -d["minus_priority"]
        best = F.when(priority == 3, acc["end3"]).when(priority == 2, acc["end2"]).otherwise(acc["end1"])
        ends = [F.when(priority >= p, F.greatest(acc[f"end{p}"], end)).otherwise(acc[f"end{p}"]).alias(f"end{p}") for p in (1, 2, 3)]
        return F.struct(*ends, F.when(best >= end, acc["kept"]).otherwise(F.array_append(acc["kept"], d)).alias("kept"))

    return F.aggregate(F.array_sort(found), none, step, lambda s: s["kept"])


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input's columns and n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``detections``: the unsuppressed intervals (label, priority, start, end).
    ``score``: the confidence of the best one (1.0, 0.8 or 0.4 by priority),
    0 without any.  Null and empty texts: no words, no labels, null first and
    last word, score 0.  Repeated rows stay; input columns with one of these
    names are replaced.
    """
    table = rules()
    docs = without(docs, *ADDED, "_words", "_rules", "_kept")
    kind = "array<struct<label:string,priority:int,keyword:string,n:int,regex:string>>"
    all_rules = F.from_json(F.lit(json.dumps(table)), kind)
    keywords = F.array(*[F.lit(k) for k in dict.fromkeys(r["keyword"] for r in table)])
    base = "|".join(BASE)
    w = F.col("_words")
    worded = docs.withColumn("_words", word_string(text_of(text_col)))
    present = F.filter(keywords, lambda k: F.contains(w, k))
    gated = worded.withColumn("_keys", present).withColumn(
        "_rules", F.when(F.size("_keys") > 0, F.filter(all_rules, lambda r: F.array_contains(F.col("_keys"), r["keyword"])))
    )
    found = F.flatten(F.transform("_rules", lambda r: intervals(w, r)))
    kept = F.when(F.size("_rules") > 0, unsuppressed(found))
    detected = gated.withColumn("_kept", F.coalesce(kept, F.expr("cast(array() as array<struct<start:int,minus_end:int,minus_priority:int,n:int,label:string>>)")))
    start = rf" (?=(?:{base}) )"
    n_base = F.when(F.size("_keys") > 0, F.regexp_count(w, F.lit(start))).otherwise(F.lit(0)).cast("long")
    first = blanks(F.substring_index(F.regexp_replace(w, rf"(?s){start}.*$", "\u0000"), "\u0000", 1))
    last = blanks(F.regexp_extract(w, rf"(?s)^(.*){start}", 1))
    based = detected.withColumn("n_base", n_base)
    some = F.col("n_base") > 0
    base_labels = F.array_compact(F.array(*[F.when(some & F.contains(w, F.lit(f" {p} ")), F.lit(v)) for p, v in BASE.items()]))
    confidence = F.create_map(*[x for p, c in CONFIDENCE.items() for x in (F.lit(-p), F.lit(c))])
    best = F.aggregate("_kept", F.lit(0.0), lambda a, d: F.greatest(a, F.element_at(confidence, d["minus_priority"])))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return based.select(
        *own,
        F.greatest(blanks(w) - 1, F.lit(0)).cast("long").alias("n_words"),
        "n_base",
        F.when(some, first).cast("long").alias("first_word"),
        F.when(some, last).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("_kept", lambda d: d["label"])))), ",").alias("labels"),
        F.greatest(best, F.when(some, F.lit(CONFIDENCE[1])).otherwise(F.lit(0.0))).alias("score"),
        F.transform("_kept", lambda d: F.struct(d["label"].alias("label"), (-d["minus_priority"]).alias("priority"),
                                                d["start"].alias("start"), (-d["minus_end"]).alias("end"))).alias("detections"),
    )
