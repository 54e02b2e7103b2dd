"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation's rows are steps; the states say which role initials the
repaired conversation holds so far: nothing, ``s``, up to a ``u``, up to an
``a``.  A cost vector gives, per state, the cheapest cost of all later rows.

Rows are sorted over the cluster and cut into chunks, so a conversation that
holds a third of all rows is many chunks in many tasks.  Every chunk first
runs backwards from a speculative cost vector.  Fix-up passes then rerun the
chunks whose successor gave another vector than they had assumed; a rerun
steps the old and the new vector together and stops as soon as they differ by
a constant only, as all earlier vectors then differ by it too.  When no
vector is wrong by more than a constant, the chunks' costs add up, and each
chunk maps its first state to its last one along its cheapest, ASCII-least
edits.  These maps are composed over the chain by doubling, so every chunk
knows its first state, and its edits are traced from the stitched costs.

Texts take no part: rows are known by the MD5 of their text (128 bits) until
the repaired lines are written.  Rows that are equal in all columns are one
row with a count, so a row repeated any number of times costs one step.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_spread, ordered_digest, written

CHUNK = 1024
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state that an insert or a rerole leads to
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
END = (0, 4, 2, 0)  # inserts that complete the conversation after the last row
DELETE, REROLE, INSERT = 3, 2, 2
LEGAL = ("su", "ua", "au")


def damage_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): the contract's damage, decided by crc32 of ``conv_id:turn``.

    Nulls count as one space, in the checksum as in role and text.  ``times``
    is 2 where a row is repeated.  Of other columns nothing is read.
    """
    space = F.lit(" ")
    row = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    return row.withColumn("fault", fault).where("fault <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("times"))


def _known(turns: DataFrame) -> DataFrame:
    """The rows with keys that hold no null: cs (conversation), ts (turn), role, d (digest of the text)."""
    space = F.lit(" ")
    return turns.select(
        F.coalesce(F.col("conv_id").cast("string"), space).alias("cs"), F.coalesce(F.col("turn").cast("string"), space).alias("ts"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.col("times").cast("long") if "times" in turns.columns else F.lit(1).cast("long")).alias("times"),
    ).withColumn("d", F.unhex(F.md5(F.col("text").cast("binary"))))


def _rows(known: DataFrame) -> DataFrame:
    """One row per different row, with its count."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    state = F.when(blank, "b").when(ended, "f").otherwise("t")
    return written(known.withColumn("state", state).groupBy("cs", "turn", "ts", "role", "d", "state").agg(F.sum("times").alias("n")), "turns")


def _steps(rows: DataFrame) -> DataFrame:
    """Rows in order of kind: code (role initial and b, d, t or f) and how often the step stands there."""
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    key = ["cs", "role", "d"]
    repeated = written(rows.groupBy(*key).agg(F.min(at).alias("first"), F.count("*").alias("kinds")).where("kinds > 1"), "repeated")
    told = join_spread(rows, repeated, key, "kinds")
    later = F.col("first").isNotNull() & (at != F.col("first"))
    first = F.when(F.col("state") == "b", "b").when(later, "d").otherwise(F.col("state"))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    goes = first.isin("b", "d")
    # Of equal rows the first may stay, all others are duplicates.
    kinds = F.array(
        F.struct(F.lit(0).alias("extra"), F.concat(initial, first).alias("code"), F.when(goes, F.col("n")).otherwise(1).alias("copies")),
        F.struct(F.lit(1).alias("extra"), F.concat(initial, F.lit("d")).alias("code"), F.when(goes, 0).otherwise(F.col("n") - 1).alias("copies")))
    return told.select("cs", "turn", "ts", "role", "d", F.inline(F.filter(kinds, lambda k: k["copies"] > 0)))


def _chunks(steps: DataFrame, chunk: int) -> DataFrame:
    """(cs, k, chunks, live, c, codes, copies, rows): the k-th of a conversation's chunks of at most ``chunk`` rows.

    ``c`` counts the earlier chunks that are ``live``: that hold a row which
    may stay.  The others add a constant to any cost vector and keep any
    state, so only live chunks form the chain that is solved.
    """
    order = ["cs", "turn", "role", "d", "extra"]
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = steps.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("row", row)
    piece = dealt.withColumn("off", F.col("row") % chunk).withColumn("piece", ((F.col("row") - F.col("off")) / chunk).cast("long"))
    found = piece.groupBy("cs", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct("off", "ts", "role", "d", "code", "copies"))).alias("rows"))
    found = written(found.withColumn("codes", F.array_join("rows.code", "")).withColumn("live", F.col("codes").rlike("[ft]")), "chunks")
    # First within a partition (at most its rows over ``chunk``), then over a conversation's partitions.
    live = F.sum(F.col("live").cast("long"))
    inside, earlier = Window.partitionBy("cs", "part").orderBy("piece"), Window.partitionBy("cs").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = found.select("cs", "part", "piece", (F.row_number().over(inside) - 1).alias("k"),
                          F.coalesce(live.over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("c"))
    spans = found.groupBy("cs", "part").agg(F.count("*").alias("m"), live.alias("l"))
    spans = spans.select("cs", "part", F.sum("m").over(Window.partitionBy("cs")).alias("chunks"),
                         F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("k0"), F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("c0"))
    return written(found.join(places, ["cs", "part", "piece"]).join(spans, ["cs", "part"]).select(
        "cs", (F.col("k0") + F.col("k")).alias("k"), "chunks", "live", (F.col("c0") + F.col("c")).alias("c"), "codes", F.col("rows.copies").alias("copies"),
        F.transform("rows", lambda r: F.struct(r["ts"].alias("ts"), r["role"].alias("role"), r["d"].alias("d"))).alias("rows")), "numbered")


def step_back(v: tuple, initial: str, state: str, copies: int) -> tuple:
    """The cost vector before a row, from the one after it."""
    if state in "bd":
        return tuple(x + DELETE * copies for x in v)
    late = state == "t"
    out = [min(v[s] + DELETE, v[NEXT[s]] + REROLE + late) for s in range(4)]
    for s, to in KEPT[initial].items():
        out[s] = min(out[s], v[to] + late)
    u, a = out[USER], out[ASSISTANT]
    out[USER], out[ASSISTANT] = min(u, a + INSERT), min(a, u + INSERT)
    out[START], out[SYSTEM] = min(out[START], out[USER] + INSERT), min(out[SYSTEM], out[USER] + INSERT)
    return tuple(out)


def level(v: tuple) -> tuple:
    """The vector without its constant: its least entry becomes 0."""
    low = min(v)
    return tuple(x - low for x in v)


def run_back(codes: str, copies: list, last: tuple) -> tuple:
    """The chunk's first vector, levelled."""
    v = last
    for i in range(len(copies) - 1, -1, -1):
        v = step_back(v, codes[2 * i], codes[2 * i + 1], copies[i])
    return level(v)


def rerun(codes: str, copies: list, old: tuple, out: tuple, new: tuple) -> tuple:
    """``run_back`` from ``new``, given its result ``out`` from ``old``: ends where both differ by a constant."""
    for i in range(len(copies) - 1, -1, -1):
        if level(new) == level(old):
            return out
        old = step_back(old, codes[2 * i], codes[2 * i + 1], copies[i])
        new = step_back(new, codes[2 * i], codes[2 * i + 1], copies[i])
    return level(new)


def trace(codes: str, copies: list, last: tuple, s: int, ends: bool) -> tuple[list[str], int, tuple]:
    """The cheapest edits from state ``s`` on, ASCII-least at ties, the state after them, and the first vector.

    One token per row, and one for inserts after the last row where the
    conversation ends: u and a are inserted roles; then D, K or the new role, U or A.
    """
    vectors = [last]
    for i in range(len(copies) - 1, -1, -1):
        vectors.append(step_back(vectors[-1], codes[2 * i], codes[2 * i + 1], copies[i]))
    vectors.reverse()
    tokens = []
    for i in range(len(copies)):
        initial, state = codes[2 * i], codes[2 * i + 1]
        here, after, token, late = vectors[i], vectors[i + 1], "", state == "t"
        if state in "bd":
            tokens.append("D")
            continue
        while here[s] != after[s] + DELETE and here[s] == here[NEXT[s]] + INSERT:
            s = NEXT[s]
            token += "u" if s == USER else "a"
        if here[s] == after[s] + DELETE:
            token += "D"
        elif here[s] == after[KEPT[initial].get(s, s)] + late and s in KEPT[initial]:
            s = KEPT[initial][s]
            token += "K"
        else:
            s = NEXT[s]
            token += "U" if s == USER else "A"
        tokens.append(token)
    tail = ""
    while ends and s not in (START, ASSISTANT):
        s = NEXT[s]
        tail += "u" if s == USER else "a"
    return tokens + [tail], s, vectors[0]


VECTORS = "cs string, c long, codes string, copies array<long>, entry array<long>, first array<long>, changed boolean"
LONGS = pa.list_(pa.int64())


def _fields(b: pa.RecordBatch, *names: str):
    return zip(*[b.column(n).to_pylist() for n in names])


def _speculate(batches):
    """Every chunk from the vector of a conversation's end, which is right for the last chunk only."""
    for b in batches:
        first = [run_back(codes, copies, END) for codes, copies in _fields(b, "codes", "copies")]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([END] * b.num_rows, LONGS), pa.array(first, LONGS), pa.array([True] * b.num_rows, pa.bool_())],
            [*b.schema.names, "entry", "first", "changed"])


def _fix(batches):
    """A rerun of the chunks whose successor gave another vector."""
    for b in batches:
        entry, first, changed = [], [], []
        for codes, copies, old, out, new in _fields(b, "codes", "copies", "entry", "first", "given"):
            was = out
            if new is not None and new != old:
                old, out = new, list(rerun(codes, copies, tuple(old), tuple(out), tuple(new)))
            entry.append(old)
            first.append(out)
            changed.append(out != was)
        yield pa.RecordBatch.from_arrays(
            [*[b.column(n) for n in ("cs", "c", "codes", "copies")], pa.array(entry, LONGS), pa.array(first, LONGS), pa.array(changed, pa.bool_())],
            ["cs", "c", "codes", "copies", "entry", "first", "changed"])


def _maps(batches):
    """The last state that each of the four first states leads to."""
    for b in batches:
        out = ["".join(str(trace(codes, copies, tuple(entry), s, False)[1]) for s in range(4)) for codes, copies, entry in _fields(b, "codes", "copies", "entry")]
        yield pa.RecordBatch.from_arrays([b.column("cs"), b.column("c"), pa.array(out, pa.string())], ["cs", "c", "leads"])


def _trace(batches):
    """Audit, counts, the chunk's share of the cost, and the tokens of the rows that stay or have inserts before them."""
    for b in batches:
        out = {n: [] for n in ("audit", "at", "token", "blank", "duplicate", "truncated", "illegal", "cost")}
        fields = _fields(b, "codes", "copies", "entry", "start", "k", "chunks", "live", "c")
        for codes, copies, entry, start, k, chunks, live, c in fields:
            tokens, _, vector = trace(codes, copies, tuple(entry), start, k == chunks - 1)
            edits = [t.translate(AUDIT) * (n if t == "D" else 1) for t, n in zip(tokens, [*copies, 1])]
            out["audit"].append("".join(edits))
            stay = [(i, t) for i, t in enumerate(tokens) if t not in ("D", "")]
            out["at"].append([i for i, _ in stay])
            out["token"].append([t for _, t in stay])
            for name in ("blank", "duplicate", "truncated"):
                out[name].append(sum(n for i, n in enumerate(copies) if codes[2 * i + 1] == name[0]))
            initials = codes[::2]
            out["illegal"].append(sum(n - 1 for n in copies) + sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])))
            # Levelled vectors: of a later chunk, only the constant that it adds counts here.
            out["cost"].append(vector[START] if live and c == 0 else min(vector))
        kinds = [pa.string(), LONGS, pa.list_(pa.string())] + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays(
            [*[b.column(n) for n in ("cs", "k", "rows")], *[pa.array(v, t) for v, t in zip(out.values(), kinds)]], ["cs", "k", "rows", *out])


TRACED = ("cs string, k long, rows array<struct<ts:string,role:string,d:binary>>, audit string, at array<long>, token array<string>, "
          "blank long, duplicate long, truncated long, illegal long, cost long")
AUDIT = str.maketrans("uaUA", "IIRR")


def _converge(chain: DataFrame) -> DataFrame:
    """Fix-up passes over the conversations of several chunks, until all vectors agree up to constants."""
    while chain.where("changed").limit(1).count():
        given = chain.select("cs", (F.col("c") - 1).alias("c"), F.col("first").alias("given"))
        chain = written(chain.drop("changed").join(given, ["cs", "c"], "left").mapInArrow(_fix, VECTORS), "vectors")
    return chain


def _starts(chain: DataFrame) -> DataFrame:
    """(cs, c, start): the state after c live chunks, by composing the chunks' state maps by doubling."""
    maps = written(chain.mapInArrow(_maps, "cs string, c long, leads string"), "maps")
    longest = maps.agg(F.max("c")).first()[0] or 0
    step = 1
    while step <= longest:
        before = maps.select("cs", (F.col("c") + step).alias("c"), F.col("leads").alias("earlier"))
        both = F.when(F.col("earlier").isNull(), F.col("leads")).otherwise(F.expr("translate(earlier, '0123', leads)"))
        maps = written(maps.join(before, ["cs", "c"], "left").select("cs", "c", both.alias("leads")), "maps")
        step *= 2
    return maps.select("cs", (F.col("c") + 1).alias("c"), F.substring("leads", 1, 1).cast("int").alias("start"))


def _traced(rows: DataFrame, chunk: int) -> DataFrame:
    """Per chunk: audit, counts, share of the cost and tokens."""
    chunks = _chunks(_steps(rows), chunk)
    end = F.array(*[F.lit(x).cast("long") for x in END])
    one, many = chunks.where("chunks = 1"), chunks.where("chunks > 1")
    chain = _converge(written(many.where("live").select("cs", "c", "codes", "copies").mapInArrow(_speculate, VECTORS), "vectors"))
    solved = many.join(chain.select("cs", "c", "entry"), ["cs", "c"], "left").join(_starts(chain), ["cs", "c"], "left")
    solved = solved.withColumn("entry", F.when(F.col("live"), F.col("entry")).otherwise(end)).withColumn("start", F.coalesce("start", F.lit(START)))
    solved = one.withColumn("entry", end).withColumn("start", F.lit(START)).unionByName(solved)
    traced = written(solved.mapInArrow(_trace, TRACED), "traced")
    # Where one chunk ends and the next one begins, two initials meet as well.
    last = many.select("cs", (F.col("k") + 1).alias("k"), F.expr("substring(codes, -2, 1)").alias("last"))
    met = many.select("cs", "k", F.substring("codes", 1, 1).alias("next")).join(last, ["cs", "k"])
    met = met.where(~F.concat("last", "next").isin(*LEGAL)).select("cs", "k", F.lit(1).alias("met"))
    return traced.join(met, ["cs", "k"], "left").withColumn("illegal", F.col("illegal") + F.coalesce("met", F.lit(0))).drop("met")


def _repaired(known: DataFrame, traced: DataFrame) -> DataFrame:
    """(cs, k, at, j, role, text, edit): the repaired rows, in order of k, at, j."""
    token = F.arrays_zip("at", "token")
    marks = traced.select("cs", "k", "rows", F.inline(token)).withColumn(
        "row", F.when(F.col("at") < F.size("rows"), F.element_at("rows", F.least(F.col("at") + 1, F.greatest(F.size("rows"), F.lit(1))).cast("int")))
    ).drop("rows").select("cs", "k", "at", "row.*", F.posexplode(F.split("token", "(?<=.)(?=.)")).alias("j", "mark"))
    marks = marks.where("mark <> 'D'")
    added = marks.where("mark in ('u', 'a')").withColumn("text", F.lit("")).withColumn("edit", F.lit("insert"))
    texts = known.groupBy("cs", "ts", "role", "d").agg(F.first("text").alias("text"))
    stays = marks.where("mark in ('K', 'U', 'A')").join(texts, ["cs", "ts", "role", "d"]).withColumn(
        "edit", F.when(F.col("mark") == "K", "keep").otherwise("rerole"))
    role = F.when(F.lower("mark") == "u", "user").when(F.lower("mark") == "a", "assistant").otherwise(F.col("role"))
    cols = ["cs", "k", "at", "j", role.alias("role"), "text", "edit"]
    return added.select(*cols).unionByName(stays.select(*cols))


def repaired_turns(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, step, part, role, text, edit): the repaired conversations' rows, ordered by chunk, step, part.

    ``edit`` is keep, rerole or insert.  See ``repair_conversations``.
    """
    known = _known(turns)
    out = _repaired(known, _traced(_rows(known), chunk))
    conv = F.when(F.col("cs") != " ", F.col("cs").try_cast("long"))
    return out.select(conv.alias("conv_id"), F.col("k").alias("chunk"), F.col("at").alias("step"), F.col("j").alias("part"), "role", "text", "edit")


def repair_conversations(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; ``times``, if there, repeats a row).

    conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit
    and repaired_sha256, as the contract defines them.  Rows stand by turn
    (null turns first), then role, then MD5 of the text; equal rows stand
    together.  Null role and text count as one space, a null conv_id is a
    conversation of its own.  Empty texts are blank; texts of any length are
    taken whole.  gaps is null where it goes beyond a long.  A conversation
    whose rows all go has the hash of the empty string.  An empty table gives
    no rows; other columns, whatever their names, are not read.
    """
    known = _known(turns)
    rows = _rows(known)
    traced = _traced(rows, chunk)
    first, final = F.min("turn"), F.max("turn")
    turned = rows.groupBy("cs", "turn").agg(F.lit(1).alias("one")).groupBy("cs").agg(
        F.coalesce((final.cast("decimal(38,0)") - first + 1 - F.count("turn")), F.lit(0)).alias("gaps"))
    sums = traced.groupBy("cs").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    lines = _repaired(known, traced).select("cs", "k", "at", "j", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = ordered_digest(lines, "cs", ["k", "at", "j"], "line", "\n", "repaired_sha256")
    conv = F.when(F.col("cs") != " ", F.col("cs").try_cast("long"))
    return sums.join(turned, "cs").join(digests, "cs", "left").select(
        conv.alias("conv_id"), F.col("gaps").try_cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The contract's query: every conv_id of the undamaged table, with the repair of its damaged rows."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("cs")).distinct()
    done = repair_conversations(damage_turns(conversations), chunk)
    done = done.withColumn("cs", F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).drop("conv_id")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    here = F.col("audit").isNotNull()
    return ids.join(done, "cs", "left").select(
        "conv_id", *[F.when(here, F.col(c)).otherwise(0).alias(c) for c in longs], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
