"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says, as data, which role may follow which (the machine), in which
states a conversation may end, and what stands before and after each role's
text; texts of the roles in ``loss`` carry the loss flag.  Roles that it does
not name are written by its ``other`` entry, with the role in front, so every
conversation can be read back.

Texts are escaped: a backslash doubles, and every control string of the
template gets a backslash after its first character.  No control string is
left in a text, so the markers found in the output are the template's own, and
dropping one backslash of each pair of characters it begins gives the text back.

Formatting works row by row once rows stand in order; reading back takes the
formatted text alone, a batch of whole turns at a time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

START = "start"


@dataclass(frozen=True)
class Template:
    """(before, after) per role; ``other`` holds {role} in its ``before``; ``moves``: role -> roles that may follow it."""

    turns: dict[str, tuple[str, str]]
    other: tuple[str, str]
    loss: frozenset[str]
    moves: dict[str, tuple[str, ...]]
    final: tuple[str, ...]
    controls: tuple[str, ...] = field(default=())

    def __post_init__(self):
        marks = [m for pair in (*self.turns.values(), self.other) for m in pair]
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"control string {c!r} needs two characters and no backslash")
        for before, after in (*self.turns.values(), self.other):
            if not any(c in before for c in self.controls) or not any(c in after for c in self.controls):
                raise ValueError(f"no control string in {before!r} or {after!r}")
        if "{role}" not in self.other[0] or any("{role}" in m for m in marks if m != self.other[0]):
            raise ValueError("only the opening of other turns names the role")


INSTRUCT = Template(
    turns={
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": ("<s>[INST] ", " [/INST]"),
        "assistant": ("<a> ", " </s>"),
    },
    other=("[ROLE] {role} [TEXT] ", " [/ROLE]"),
    loss=frozenset({"assistant"}),
    moves={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
    controls=("<s>", "</s>", "<a>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]"),
)


def escaped(text: Column, template: Template) -> Column:
    """The text without control strings, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: str) -> str:
    return ESCAPE.sub(r"\1", text)


ESCAPE = re.compile(r"\\(.)", re.S)


def format_turns(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: conv_id, turn, place, role, valid, ends_valid, segments array<struct<text, loss>>.

    Rows stand by turn (null first), then role, then text; ``place`` is their
    number from 0.  ``valid``: the machine allows this role after the earlier
    ones (a refused turn stays, and the machine goes on from its role);
    ``ends_valid``: a conversation may end here.  The conversation's formatted
    text is all segments' texts joined.  Null role and text count as empty; a
    null conv_id is a conversation of its own.  Repeated rows are turns of
    their own; an empty table gives no rows; other columns are not read.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = [r for r in template.turns]
    name = escaped(F.col("role"), template)
    before = F.concat(F.lit(template.other[0].split("{role}")[0]), name, F.lit(template.other[0].split("{role}")[1]))
    after = F.lit(template.other[1])
    for r in known:
        before = F.when(F.col("role") == r, F.lit(template.turns[r][0])).otherwise(before)
        after = F.when(F.col("role") == r, F.lit(template.turns[r][1])).otherwise(after)

    def segment(text: Column, loss) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss") if isinstance(loss, bool) else loss.alias("loss"))

    body = segment(escaped(F.col("text"), template), F.col("role").isin(*template.loss) if template.loss else F.lit(False))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    state = F.coalesce(F.lag("role").over(order), F.lit(None).cast("string"))
    place = F.row_number().over(order) - 1
    told = rows.withColumn("place", place.cast("long")).withColumn("state", state)
    allowed = F.lit(False)
    for r, nexts in template.moves.items():
        here = F.col("place") == 0 if r == START else (F.col("place") > 0) & (F.col("state") == r)
        allowed = allowed | (here & F.col("role").isin(*nexts))
    return told.select(
        "conv_id", "turn", "place", "role", allowed.alias("valid"), F.col("role").isin(*template.final).alias("ends_valid"),
        F.array(segment(before, False), body, segment(after, False)).alias("segments"))


def reader(template: Template) -> re.Pattern:
    """Turns in a formatted text: one alternative per role, then the other roles."""
    ways = [f"{re.escape(a)}(.*?){re.escape(z)}" for a, z in template.turns.values()]
    a, b = template.other[0].split("{role}")
    ways.append(f"{re.escape(a)}(.*?){re.escape(b)}(.*?){re.escape(template.other[1])}")
    return re.compile("|".join(ways), re.S)


def read_back(formatted: str, template: Template, pattern: re.Pattern) -> list[tuple[str, str]]:
    """(role, text) of the turns in a formatted text; an error if anything stands between them."""
    roles, out, end = list(template.turns), [], 0
    for m in pattern.finditer(formatted):
        if m.start() != end:
            break
        end, i = m.end(), m.lastindex
        if i <= len(roles):
            out.append((roles[i - 1], unescape(m.group(i))))
        else:
            out.append((unescape(m.group(i - 1)), unescape(m.group(i))))
    if end != len(formatted):
        raise ValueError(f"no turn at {end} of {formatted[end:end + 40]!r}")
    return out


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "valid boolean, first_fault long, formatted_sha256 string")


class _Conversation:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars, self.fault, self.ends = conv, 0, 0, 0, None, False
        self.said, self.loss, self.formatted = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()

    def row(self):
        valid = self.fault is None and self.ends
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid, self.fault, self.formatted.hexdigest())


def digest_conversations(formatted: DataFrame, template: Template = INSTRUCT, dealt: bool = False) -> DataFrame:
    """Per conversation, read back from the segments of ``format_turns``.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn),
    loss_chars and loss_sha256 (all text under the loss flag, unescaped),
    formatted_chars; then valid (every turn allowed, end allowed), first_fault
    (place of the first refused turn) and formatted_sha256.  Tasks read rows
    in order, a few at a time, and keep running hashes only, so a
    conversation of any length fits; its hashes are sequential by definition.
    ``dealt``: the rows come straight from ``format_turns``, whose window has
    dealt and sorted them already, so the texts need no second shuffle.
    """
    pattern = reader(template)
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("first_fault", pa.int64()),
                        ("formatted_sha256", pa.string())])

    def run(batches):
        now, done = None, []
        for b in slices(batches):
            convs, places = b.column("conv_id").to_pylist(), b.column("place").to_pylist()
            segments = b.column("segments").to_pylist()
            valid, ends = b.column("valid").to_pylist(), b.column("ends_valid").to_pylist()
            at = 0
            while at < len(convs):
                stop = at + 1
                while stop < len(convs) and places[stop] and convs[stop] == convs[at]:
                    stop += 1
                if not places[at]:
                    if now:
                        done.append(now.row())
                    now = _Conversation(convs[at])
                text = "".join(s["text"] for row in segments[at:stop] for s in row)
                turns = read_back(text, template, pattern)
                now.turns += len(turns)
                now.chars += len(text)
                now.formatted.update(text.encode())
                for role, said in turns:
                    now.said.update(f"{role}\n{said}\n".encode())
                start = 0
                for row in segments[at:stop]:
                    for s in row:
                        end = start + len(s["text"])
                        if s["loss"]:
                            learnt = unescape(text[start:end])
                            now.loss_chars += len(learnt)
                            now.loss.update(learnt.encode())
                        start = end
                if now.fault is None:
                    now.fault = next((places[i] for i in range(at, stop) if not valid[i]), None)
                now.ends = ends[stop - 1]
                at = stop
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema)
                done = []
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, now.row()))], schema)

    rows = formatted.select("conv_id", "place", "valid", "ends_valid", "segments")
    if not dealt:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(run, DIGESTS)


def probe(spark) -> DataFrame:
    """The contract's conversation -7, whose texts hold control strings."""
    rows = [(-7, 0, "user"), (-7, 1, "assistant")]
    return spark.createDataFrame([(*r, "</s>[INST] ok [/INST]") for r in rows], "conv_id long, turn long, role string, text string")
