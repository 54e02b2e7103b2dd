"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents contain at least ``threshold`` of a test item's distinct word
shingles?  Items are partitioned by size class (powers of two of their shingle
count).  An item is sketched by the smallest hashes of its shingles, as many
as its class may miss plus one: a document that holds the threshold then holds
at least one sketched shingle, whatever its length, so the search loses
nothing.  Documents only meet classes that they are large enough to contain.
The candidates are verified by the exact shingles (strings, not hashes).

Only DataFrame functions.  The join with the sketches is left to the planner:
it broadcasts them while they are small and shuffles both sides beyond that,
hot shingles being split by the skew-join rule.  Equal texts are one candidate;
where copies of a text meet again, texts with very many copies are joined by a
broadcast of at most ``HOT_KEYS`` keys (``join_spread``), the others in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_spread, text_of, written


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array if there are none."""
    joined = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(joined == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(joined, " ", -1))


def _starts(words: Column, width: int) -> Column:
    return F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width)).otherwise(F.expr("cast(array() as array<int>)"))


def shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of the ``width``-word shingles, repeats included."""
    return F.transform(_starts(words, width), lambda i: F.xxhash64(F.lit(width), *[F.get(words, i + j) for j in range(width)]))


def shingle_texts(words: Column, width: int) -> Column:
    """The distinct shingles themselves."""
    return F.array_distinct(F.transform(_starts(words, width), lambda i: F.array_join(F.slice(words, i + 1, width), " ")))


def _by_width(widths: list[int], words: Column, make) -> Column:
    """``make(words, width)`` for the row's own ``width`` column."""
    out = F.lit(None)
    for w in widths:
        out = F.when(F.col("width") == w, make(words, w)).otherwise(out)
    return out


def sketches(items: DataFrame, threshold: float = 0.8, width: int = 5) -> DataFrame:
    """(item_id, width, shingles, n, needed, size_class, sketch) of the items that have a word."""
    worded = items.select("item_id", words_of(text_of("text")).alias("words")).where(F.size("words") > 0)
    worded = worded.withColumn("width", F.least(F.size("words"), F.lit(width)))
    widths = list(range(1, width + 1))
    sized = worded.select(
        "item_id", "width", _by_width(widths, F.col("words"), shingle_texts).alias("shingles"),
        F.array_sort(F.array_distinct(_by_width(widths, F.col("words"), shingle_hashes))).alias("hashes"))
    n = F.size("shingles")
    needed = F.ceil(n * threshold - 1e-9).cast("int")
    size_class = F.floor(F.log2(n.cast("double"))).cast("int")
    # The largest size of the class is 2^(class + 1) - 1; what it may miss bounds what any size of the class may miss.
    most = F.pow(F.lit(2.0), size_class + 1) - 1
    length = F.least(F.size("hashes"), (most - F.ceil(most * threshold - 1e-9) + 1).cast("int"))
    return sized.select("item_id", "width", "shingles", n.alias("n"), needed.alias("needed"), size_class.alias("size_class"),
                        F.slice("hashes", F.lit(1), length).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, text_col: str = "text") -> DataFrame:
    """(text_a, text_b, item_id, n_shingles, n_shared, containment): the items that each distinct text contains.

    text_a, text_b: two 64-bit hashes of the text (``text_key``).  Items of
    fewer than ``width`` words are one shingle of all their words; items and
    texts without words (null, empty) contain nothing and are not contained.
    Items with a null id are ignored; a repeated item counts once.
    """
    table = written(sketches(items.where("item_id is not null").dropDuplicates(["item_id", "text"]), threshold, width), "sketches")
    widths = sorted(r["width"] for r in table.select("width").distinct().collect())  # at most ``width`` numbers
    if not widths:
        return docs.sparkSession.createDataFrame([], "text_a long, text_b long, item_id long, n_shingles int, n_shared int, containment double")
    sketch = table.select(F.explode("sketch").alias("hash"), "item_id", "needed")
    keyed = docs.select(*text_key(text_of(text_col)), text_of(text_col).alias("text"))
    worded = keyed.select("text_a", "text_b", words_of(F.col("text")).alias("words"))
    hashes = F.concat(*[shingle_hashes(F.col("words"), w) for w in widths])
    exploded = worded.select("text_a", "text_b", F.size("words").alias("n_words"), F.explode(hashes).alias("hash"))
    # a document of n words has at most n shingles of a width
    met = exploded.join(sketch, "hash").where(F.col("n_words") >= F.col("needed"))
    candidates = written(met.select("text_a", "text_b", "item_id").distinct(), "candidates")
    full = candidates.join(table.select("item_id", "width", "shingles", "n", "needed"), "item_id")
    keys = _copies(docs, candidates, text_col)
    distinct = join_spread(keyed, keys, ["text_a", "text_b"], "rows", "inner")
    one_each = distinct.groupBy("text_a", "text_b").agg(F.any_value("text").alias("text"))
    pairs = one_each.select("text_a", "text_b", words_of(F.col("text")).alias("words")).join(full, ["text_a", "text_b"])
    own = _by_width(widths, F.col("words"), shingle_texts)
    shared = pairs.withColumn("n_shared", F.size(F.array_intersect("shingles", own)))
    return shared.where("n_shared >= needed").select(
        "text_a", "text_b", "item_id", F.col("n").alias("n_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text."""
    return [F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(1), text).alias("text_b")]


def _copies(docs: DataFrame, texts: DataFrame, text_col: str) -> DataFrame:
    """(text_a, text_b, rows): the distinct keys in ``texts`` with the number of documents that have the text."""
    every = docs.select(*text_key(text_of(text_col))).groupBy("text_a", "text_b").agg(F.count("*").alias("rows"))
    return written(every.join(texts.select("text_a", "text_b").distinct(), ["text_a", "text_b"], "left_semi"), "copies")


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), one row per input document row and item it contains.

    Only clean documents, and documents without words, have no row.
    """
    found = contained_items(docs, items, threshold, width, text_col)
    found = written(found, "found")
    counted = written(found.join(_copies(docs, found, text_col), ["text_a", "text_b"]), "found")
    keys = docs.select(F.col(id_col).alias("doc_id"), *text_key(text_of(text_col)))
    return join_spread(keys, counted, ["text_a", "text_b"], "rows", "inner").drop("text_a", "text_b")


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, text_col: str = "text") -> DataFrame:
    """The input rows, with all their columns, whose text contains no item."""
    found = written(contained_items(docs, items, threshold, width, text_col).select("text_a", "text_b").distinct(), "leaks")
    a, b = text_key(text_of(text_col))
    return docs.join(found, (a == found["text_a"]) & (b == found["text_b"]), "left_anti")
