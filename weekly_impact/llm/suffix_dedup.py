"""Removal of bytes that repeat: sparse suffix sorting by the deep-shallow method.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier
(smaller document, or same document and smaller start).

Not every suffix is sorted.  A window of LENGTH bytes is led by the smallest
hash of its ``GRAM``-byte grams (leftmost on ties), so equal windows have the
same lead at the same offset, and a run of neighbouring windows with one lead
is a segment.  Segments, a few dozen bytes of hashes and places per forty
bytes of text, are shuffled by their lead:

1. Equal segments (128-bit hash of their bytes) repeat as a whole: all but the
   first are covered.  Each batch settles its own equal segments first, so a
   passage that a third of all documents hold sends one row per batch; the
   rest meet by lead and hash, sorted, and are settled as they stream by.
2. Different segments with the same lead may share some of their windows.
   Their bytes are fetched by document, and for each lead the suffixes that
   start at the lead and the reversed prefixes that end there are sorted:
   multikey quicksort on eight-byte words to a shallow depth, then blind tries
   for the groups that still share all of it.  With the longest common
   prefixes of both orders, two windows are equal at an offset if they share
   that many bytes to the left and the rest to the right; of equal windows all
   but the first are covered.
3. A hot lead (a phrase that very many texts hold among different neighbours)
   is not sorted in one task: its windows are dealt by a 128-bit hash of their
   bytes instead, each batch's equal ones settled first, as in step 1.  A lead
   is hot in a batch with more than ``LOCAL_KINDS`` different segments of it
   that are also more than a ``LOCAL_SHARE``-th of its rows; the batch then
   sends windows, and one marker to the lead's group, which tells the segments
   of other batches there to go the same way.  So does a group with more than
   ``HOT_KINDS`` different segments.

The covered ranges of a document come together by its id and are cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written

LENGTH = 100
GRAM = 32
TEXT_BITS = 31  # a text is shorter than 2^31 bytes; the k-th text of one id has its places from k * 2^31 on
REACH = LENGTH - GRAM  # a lead lies at most so far into its window
PLACE_BITS = 24
CHUNK = 1 << 20
PIECE = 1 << 23  # longer texts are cut into pieces that overlap by LENGTH - 1 bytes
SHALLOW_WORDS = 6  # 48 bytes: the lead's gram and two words more
LOCAL_KINDS = 16
LOCAL_SHARE = 64
HOT_KINDS = 1000
COVERED, SEGMENT_ROW, WINDOW, MARKER, HOT = range(5)  # kinds of rows
COMPARED = 1 << 16  # segments that a task sorts at a time, whole leads
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0x9E3779B97F4A7C15)
    return x ^ (x >> U(29))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position where they fit, as a number."""
    w = data.astype(U)
    for bits, step in ((8, 1), (16, 2), (32, 4)):
        w = (w[:-step] << U(bits)) | w[step:]
    return w


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8-byte words, GRAM-byte hashes) at each position where they fit."""
    w = words_at(data)
    h = mix(w)
    for step in (8, 16):
        h = mix(h[:-step] * U(0xD6E8FEB86659FD93) + (h[step:] ^ (h[step:] >> U(31))))
    return w, h


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, for hashes of ranges by differences of sums."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int):
        if len(self.up) < n:
            b = 0x2545F4914F6CDD1D
            for name, x in (("up", b), ("down", pow(b, -1, 1 << 64))):
                p = np.full(n, x, dtype=U)
                p[0] = 1
                setattr(self, name, np.cumprod(p))
        return self.up[:n], self.down[:n]


def segments(data: np.ndarray, doc: np.ndarray, ends: np.ndarray, powers: Powers):
    """(start, count, offset, lead hash, segment hash) of the segments in a buffer.

    ``doc``: the number of the piece at each byte; ``ends``: the end of each piece.
    """
    none = tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, U, U))
    if len(data) < LENGTH:
        return none
    words, h = gram_hashes(data)
    key = (h >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(h), dtype=U)
    low, width = key, 1
    while width * 2 <= REACH + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = REACH + 1 - width
    low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
    lead = (low & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    at = np.arange(len(lead))
    valid = at + LENGTH <= ends[doc[:len(lead)]]
    at, lead = at[valid], lead[valid]
    if not len(at):
        return none
    new = np.ones(len(at), dtype=bool)
    new[1:] = (lead[1:] != lead[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, lead = at[first], lead[first]
    up, down = powers.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=U)
    np.cumsum(mix(words ^ U(0xA5A5A5A5A5A5A5A5)) * up[:-1], out=sums[1:])
    stop = start + count + LENGTH - 1 - 7  # words lie wholly inside the segment
    own = (sums[stop] - sums[start]) * down[start]
    offset = lead - start
    own = mix(own ^ (count.astype(U) << U(8)) ^ offset.astype(U))
    return start, count, offset, h[lead], own


def pieces(ids, texts):
    """Buffers of at most about CHUNK bytes: (bytes, document number of each piece, base offset of each piece, ends)."""
    buf, size = [], 0
    for i, t in zip(ids, texts):
        data = (t or "").encode("utf-8", "surrogatepass")
        for base in range(0, max(1, len(data) - LENGTH + 1), PIECE):
            part = data[base:base + PIECE + LENGTH - 1]
            if i is None or len(part) < LENGTH:
                continue
            if size and size + len(part) > CHUNK:
                yield buf
                buf, size = [], 0
            buf.append((i, base, part))
            size += len(part)
    if buf:
        yield buf


SEGMENT = "lead long, own long, doc_id long, start long, span int, offset int, kind int"  # span: windows, of covered ranges too
TYPES = [pa.int64()] * 4 + [pa.int32()] * 3
NAMES = [x.split()[0] for x in SEGMENT.split(", ")]


def _rows(lead, own, doc, start, span, offset, kind):
    cols = [lead.view(np.int64), own.view(np.int64), doc, start, *(np.broadcast_to(np.asarray(x, dtype=np.int32), len(lead)) for x in (span, offset, kind))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, TYPES)], names=NAMES)


def _ranges(doc, start, stop):
    """Covered ranges as rows that any task may get."""
    spread = mix(doc.astype(U) * U(31) + start.astype(U))
    return _rows(spread, spread, doc, start, stop - start - LENGTH + 1, 0, COVERED)


def _columns(batch) -> list[np.ndarray]:
    return [batch.column(n).to_numpy() for n in NAMES]


def _stop(start, span):
    return start + span + LENGTH - 1


def merged(doc, start, stop):
    """Ranges with overlapping or touching ones of a document joined."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # ends never decrease within a document here (ranges of LENGTH or more that are ordered by start may, so take maxima)
    new = np.ones(len(doc), dtype=bool)
    group = np.cumsum(np.append(True, doc[1:] != doc[:-1])) - 1
    shift = group * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + shift)
    new[1:] = (start + shift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - shift[first]


def _find_segments(local_kinds: int):
    """Covered ranges, and segments that others may share; of leads that are hot in the batch, windows and a marker."""

    def run(batches):
        powers = Powers()
        for b in slices(batches, 4096):
            found, parts = [], []
            row_ids, row_text = b.column("doc_id").to_numpy(), b.column("k").to_numpy() << TEXT_BITS
            for buf in pieces(range(b.num_rows), b.column("text").to_pylist()):
                data = np.frombuffer(b"".join(p for _, _, p in buf), np.uint8)
                sizes = np.array([len(p) for _, _, p in buf])
                ends, doc = np.cumsum(sizes), np.repeat(np.arange(len(buf)), sizes)
                start, count, offset, lead, own = segments(data, doc, ends, powers)
                piece = doc[start] if len(start) else start
                rows = np.array([i for i, _, _ in buf], dtype=np.int64)
                ids, base = row_ids[rows], row_text[rows] + np.array([x for _, x, _ in buf], dtype=np.int64)
                inside = start - (ends - sizes)[piece]
                found.append((lead, own, ids[piece], inside + base[piece], count, offset, piece + len(parts), inside))
                parts += [p for _, _, p in buf]
            if not found:
                continue
            lead, own, doc, start, span, offset, piece, inside = (np.concatenate(x) for x in zip(*found))
            later, _ = first_of_each(lead, own, doc, start)
            yield _ranges(*merged(doc[later], start[later], _stop(start[later], span[later])))
            leads, of, kinds = np.unique(lead[~later], return_inverse=True, return_counts=True)
            hot_lead = (kinds > local_kinds) & (kinds * LOCAL_SHARE > b.num_rows)
            keep, hot = (np.flatnonzero(~later)[x] for x in (~hot_lead[of], hot_lead[of]))
            yield _rows(*(x[keep] for x in (lead, own, doc, start, span, offset)), SEGMENT_ROW)
            marks = leads[hot_lead]
            none = np.zeros(len(marks), dtype=np.int64)
            yield _rows(marks, none + np.iinfo(np.int64).min, none, none, 0, 0, MARKER)  # the least ``own``: first of its lead
            for at in range(0, len(hot), CHUNK // (2 * LENGTH)):
                some = hot[at:at + CHUNK // (2 * LENGTH)]
                data = [parts[piece[x]][inside[x]:_stop(inside[x], span[x])] for x in some]
                yield from _windows(doc[some], start[some], span[some], data, powers)

    return run


def _windows(doc, start, span, data, powers: Powers):
    """Rows (lead, own: two hashes of its bytes) for the windows of segments; equal ones settled."""
    size = np.array([len(x) for x in data])
    inside = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
    at = np.repeat(np.cumsum(size) - size, span) + inside
    doc, start = np.repeat(doc, span), np.repeat(start, span) + inside
    words = words_at(np.frombuffer(b"".join(data), np.uint8))
    up, down = powers.get(len(words) + 1)
    hashes = []
    for salt in (0xA5A5A5A5A5A5A5A5, 0x3C6EF372FE94F82B):
        sums = np.zeros(len(words) + 1, dtype=U)
        np.cumsum(mix(words ^ U(salt)) * up[:-1], out=sums[1:])
        hashes.append(mix((sums[at + LENGTH - 7] - sums[at]) * down[at]))
    later, _ = first_of_each(*hashes, doc, start)
    yield _ranges(*merged(doc[later], start[later], start[later] + LENGTH))
    yield _rows(*(x[~later] for x in (*hashes, doc, start)), 1, 0, WINDOW)


def first_of_each(lead, own, doc, start):
    """(later, order): which rows have an equal segment at an earlier place; the order that groups equal ones."""
    order = np.lexsort((start, doc, own, lead))
    l, o, d, s = lead[order], own[order], doc[order], start[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = (l[1:] != l[:-1]) | (o[1:] != o[:-1])
    at = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = np.zeros(len(order), dtype=bool)
    later[order] = (d != d[at]) | (s != s[at])
    return later, order


class Firsts:
    """Tells the first of each kind from later ones, over batches in the order (lead, own, doc, start)."""

    def __init__(self):
        self.last = None  # kind and first place of the group that the batch before ended in

    def __call__(self, lead, own, doc, start):
        """(first, later) of the rows; a row that repeats the first's place is neither."""
        head = np.ones(len(lead), dtype=bool)
        head[1:] = (lead[1:] != lead[:-1]) | (own[1:] != own[:-1])
        head[0] = self.last is None or (lead[0], own[0]) != self.last[:2]
        at = np.maximum.accumulate(np.where(head, np.arange(len(lead)), -1))
        d, s = doc[at], start[at]
        if not head[0]:
            d[at < 0], s[at < 0] = self.last[2:]
        self.last = (lead[-1], own[-1], d[-1], s[-1])
        return head, (doc != d) | (start != s)


class Leads:
    """Segments of leads that have several kinds or are hot, over batches of first kinds and markers in order."""

    def __init__(self, hot_kinds: int):
        self.hot_kinds, self.rows, self.hot = hot_kinds, [], None

    def __call__(self, rows, last: bool = False):
        rows = [np.concatenate(x) for x in zip(self.rows, rows)] if self.rows else rows
        lead, mark = rows[0], rows[6] == MARKER
        if not len(lead):
            return rows
        at = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))
        size = np.diff(np.append(at, len(lead)))
        kinds = np.add.reduceat(~mark, at, dtype=np.int64)
        hot = (kinds > self.hot_kinds) | np.logical_or.reduceat(mark, at)
        hot[0] |= lead[0] == self.hot  # the lead that the batch before ended in
        self.hot = lead[-1] if hot[-1] else None
        end = len(lead) if last or hot[-1] else at[-1]  # an undecided lead waits, with few rows
        self.rows = [x[end:] for x in rows]
        ask = (np.repeat(hot | (kinds > 1), size) & ~mark)[:end]
        return [*(x[:end][ask] for x in rows[:6]), np.where(np.repeat(hot, size)[:end][ask], HOT, SEGMENT_ROW)]


def _settle(hot_kinds: int):
    """Covered ranges, the first of each window, and the first of each kind of segment of a lead with several; sorted rows come."""

    def run(batches):
        firsts, firsts_of_windows, leads = Firsts(), Firsts(), Leads(hot_kinds)
        rows = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = _columns(b)
            kind = rows[6]
            out = [kind == COVERED]
            for one, which in ((firsts_of_windows, kind == WINDOW), (firsts, (kind == SEGMENT_ROW) | (kind == MARKER))):
                at = np.flatnonzero(which)
                first, later = np.zeros((2, len(kind)), dtype=bool)
                if len(at):
                    first[at], later[at] = one(*(x[at] for x in rows[:4]))
                out.append(later & (kind != MARKER))
                yield _rows(*([x[first] for x in rows] if one is firsts_of_windows else leads([x[first] for x in rows])))
            gone = out[0] | out[1] | out[2]
            yield _ranges(*merged(rows[2][gone], rows[3][gone], _stop(rows[3], rows[4])[gone]))
        if rows is not None:
            yield _rows(*leads([x[:0] for x in rows], last=True))

    return run


class BlindTrie:
    """Orders equally long byte strings, comparing each with one other: edges know only their branching byte."""

    def __init__(self):
        self.root = None  # leaf: list of string numbers; node: [depth, {byte: child}]

    def add(self, strings: list[bytes], n: int) -> None:
        s = strings[n]
        if self.root is None:
            self.root = [n]
            return
        at = self.root
        while isinstance(at, tuple):  # descend blindly
            kids = at[1]
            at = kids.get(s[at[0]]) or next(iter(kids.values()))
        other = strings[at[0]]
        if other == s:
            at.append(n)
            return
        differ = int.from_bytes(s) ^ int.from_bytes(other)
        common = len(s) - (differ.bit_length() + 7) // 8
        up, byte, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < common:
            up, byte, node = node, s[node[0]], node[1][s[node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][s[common]] = [n]
            return
        new = (common, {other[common]: node, s[common]: [n]})
        if up is None:
            self.root = new
        else:
            up[1][byte] = new

    def ordered(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            at = todo.pop()
            if isinstance(at, tuple):
                todo += [at[1][b] for b in sorted(at[1], reverse=True)]
            else:
                out += at
        return out


def multikey_quicksort(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The order of rows by group, then by their words.

    Ternary partitioning around a pivot word, all parts at once in each
    round: the rows of a part that are less or greater are partitioned again
    on the same word, those that are equal on the next one.
    """
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(order)))
    level = np.zeros(len(first), dtype=np.int64)
    while True:
        open_ = (size > 1) & (level < words.shape[1])
        first, size, level = first[open_], size[open_], level[open_]
        if not len(first):
            return order
        part = np.repeat(np.arange(len(first)), size)
        at = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size) + first[part]
        rows = order[at]
        w = words[rows, level[part]]
        begin = np.cumsum(size) - size
        three = np.sort(np.stack([w[begin], w[begin + size // 2], w[begin + size - 1]]), axis=0)
        pivot = three[1][part]
        side = 3 * part + np.where(w < pivot, 0, np.where(w == pivot, 1, 2))
        order[at] = rows[np.argsort(side, kind="stable")]
        counts = np.bincount(side, minlength=3 * len(first)).reshape(-1, 3)
        starts = first[:, None] + np.cumsum(counts, axis=1) - counts
        first, size = starts.ravel(), counts.ravel()
        level = (level[:, None] + np.array([0, 1, 0])).ravel()


def sorted_with_lcp(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): rows by group and bytes; lcp with the row before, 0 at a group's first."""
    n, width = strings.shape
    words = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    words[:, :width] = strings
    words = words.view(">u8").astype(U)
    depth = min(SHALLOW_WORDS, words.shape[1])
    order = multikey_quicksort(group, words[:, :depth])
    g, w = group[order], words[order, :depth]
    equal = np.zeros(n, dtype=bool)
    equal[1:] = (g[1:] == g[:-1]) & (w[1:] == w[:-1]).all(axis=1)
    starts = np.flatnonzero(~equal)
    sizes = np.diff(np.append(starts, n))
    deep = sizes > 1
    for s, size in zip(starts[deep], sizes[deep]):
        rows = order[s:s + size]
        tails = [x.tobytes() for x in strings[rows, depth * 8:]]
        trie = BlindTrie()
        for i in range(size):
            trie.add(tails, i)
        order[s:s + size] = rows[trie.ordered()]
    lcp = np.zeros(n, dtype=np.int64)
    for s in range(1, n, 1 << 16):
        e = min(n, s + (1 << 16))
        a, b = strings[order[s:e]], strings[order[s - 1:e - 1]]
        differ = a != b
        lcp[s:e] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    g = group[order]
    lcp[1:][g[1:] != g[:-1]] = -1
    lcp[:1] = -1
    return order, lcp


def _compare(batches):
    """Covered ranges among different segments of each lead, and among windows; the rows come sorted."""
    firsts, waiting, n = Firsts(), [], 0
    for b in batches:
        if not b.num_rows:
            continue
        lead, own, doc, start, span, _, kind = _columns(b)
        out, at = kind == COVERED, np.flatnonzero(kind == WINDOW)
        if len(at):
            out[at] = firsts(*(x[at] for x in (lead, own, doc, start)))[1]
        yield _range_batch(*merged(doc[out], start[out], _stop(start, span)[out]))
        whole = kind == SEGMENT_ROW
        if whole.any():
            waiting.append(pa.Table.from_batches([b]).filter(pa.array(whole)))
            n += waiting[-1].num_rows
        if n >= COMPARED:
            t = pa.concat_tables(waiting)
            leads = t.column("lead").to_numpy()
            end = int(np.searchsorted(leads, leads[-1]))  # the last lead may go on
            if end:
                yield _compare_leads(t.slice(0, end))
            waiting, n = [t.slice(end)], t.num_rows - end
    if n:
        yield _compare_leads(pa.concat_tables(waiting))


def _range_batch(doc, start, stop):
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, stop)], ["doc_id", "start", "stop"])


def _compare_leads(t: pa.Table) -> pa.RecordBatch:
    """Covered ranges among the segments of whole leads."""
    lead, doc, start, span, offset = (t.column(c).to_numpy() for c in ("lead", "doc_id", "start", "span", "offset"))
    data = t.column("data").to_pylist()
    n = len(data)
    right, left = np.zeros((n, LENGTH), dtype=np.uint8), np.zeros((n, REACH), dtype=np.uint8)
    for i, (x, o) in enumerate(zip(data, offset)):
        r = np.frombuffer(x, np.uint8)
        right[i, :min(LENGTH, len(r) - o)] = r[o:o + LENGTH]
        left[i, :o] = r[:o][::-1]
    _, group = np.unique(lead, return_inverse=True)
    rank = np.empty(n, dtype=np.int64)
    place = start + offset
    rank[np.lexsort((place, doc))] = np.arange(n)
    r_order, r_lcp = sorted_with_lcp(group, right)
    l_order, l_lcp = sorted_with_lcp(group, left)
    hit = np.zeros((n, REACH + 1), dtype=bool)
    r_class, l_class = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(REACH + 1):
        there = np.flatnonzero((offset - span < o) & (o <= offset))
        if len(there) < 2:
            continue
        r_class[r_order] = np.cumsum(r_lcp < LENGTH - o)
        l_class[l_order] = np.cumsum(l_lcp < o)
        order = there[np.lexsort((rank[there], l_class[there], r_class[there]))]
        a, b = r_class[order], l_class[order]
        again = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        head = np.maximum.accumulate(np.where(np.append(True, ~again), np.arange(len(order)), 0))
        earlier = order[head]
        hit[order, o] = (doc[earlier] != doc[order]) | (place[earlier] != place[order])
    rows, offs = np.nonzero(hit)
    return _range_batch(*merged(doc[rows], place[rows] - offs, place[rows] - offs + LENGTH))


def _pack(batches):
    packer = zstandard.ZstdCompressor(level=1)
    for b in slices(batches):
        data = [packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k"), pa.array(data, pa.binary())], ["doc_id", "k", "packed"])


FETCHED = SEGMENT + ", data binary"


def _fetch(batches):
    """The bytes of the segments that are asked for; windows of those with a hot lead."""
    opener, powers = zstandard.ZstdDecompressor(), Powers()
    kind = pa.schema([*zip(NAMES, TYPES), ("data", pa.binary())])

    def windows(hot):
        doc, start, span = (np.array(x, dtype=np.int64) for x in list(zip(*hot))[:3])
        for rows in _windows(doc, start, span, [x[3] for x in hot], powers):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(rows.num_rows, pa.binary())], schema=kind)

    for b in slices(batches):
        out, hot = [], []
        for doc, k, packed, asked in zip(*(b.column(c).to_pylist() for c in ("doc_id", "k", "packed", "asked"))):
            data, base = opener.decompress(packed), k << TEXT_BITS
            for q in asked:
                start, span = q["start"], q["span"]
                part = data[start - base:_stop(start - base, span)]
                if q["kind"] != HOT:
                    out.append((q["lead"], 0, doc, start, span, q["offset"], SEGMENT_ROW, part))
                else:
                    hot.append((doc, start, span, part))
                if len(hot) * 2 * LENGTH >= CHUNK:
                    yield from windows(hot)
                    hot = []
        if hot:
            yield from windows(hot)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kind.types)], schema=kind)


def numbered_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text): k numbers the different texts of one id from 0 (by hash); it is 0 wherever an id has one text.

    Only ids with several texts are joined, so the texts are not shuffled for
    them unless such ids outgrow a broadcast.
    """
    hashed = docs.withColumn("hash", F.md5(F.col("text").cast("binary")))
    kinds = hashed.groupBy("doc_id").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi")).where("lo <> hi").select("doc_id")
    several = hashed.select("doc_id", "hash").join(kinds, "doc_id", "left_semi").distinct()
    order = Window.partitionBy("doc_id").orderBy("hash")
    odd = written(several.withColumn("k", (F.row_number().over(order) - 1).cast("long")), "odd")
    return hashed.join(odd, ["doc_id", "hash"], "left").select("doc_id", F.coalesce("k", F.lit(0)).alias("k"), "text")


def covered_ranges(docs: DataFrame, hot_kinds: int = HOT_KINDS, local_kinds: int = LOCAL_KINDS) -> DataFrame:
    """(doc_id, start, stop) of bytes that go; ranges may overlap; ``docs`` from ``numbered_texts``."""

    def dealt(rows):  # sorted by Spark, which spills, so that tasks read one batch at a time
        return rows.repartition("lead").sortWithinPartitions("lead", "own", "doc_id", "start")

    k = F.shiftright("start", TEXT_BITS).alias("k")
    found = docs.mapInArrow(_find_segments(local_kinds), SEGMENT)
    settled = written(dealt(found).mapInArrow(_settle(hot_kinds), SEGMENT), "settled")
    asked = settled.where(F.col("kind").isin(SEGMENT_ROW, HOT)).groupBy("doc_id", k).agg(
        F.collect_list(F.struct("lead", "start", "span", "offset", "kind")).alias("asked"))
    packed = docs.mapInArrow(_pack, "doc_id long, k long, packed binary")
    bytes_of = packed.join(asked, ["doc_id", "k"]).mapInArrow(_fetch, FETCHED)
    windows = settled.where(F.col("kind") == WINDOW).withColumn("data", F.lit(None).cast("binary"))
    compared = dealt(bytes_of.unionByName(windows)).mapInArrow(_compare, "doc_id long, start long, stop long")
    stop = (F.col("start") + F.col("span") + (LENGTH - 1)).alias("stop")
    return settled.where(F.col("kind") == COVERED).select("doc_id", "start", stop).unionByName(compared)


def cut(data: bytes, ranges) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)."""
    out, at, removed, runs = [], 0, 0, 0
    for s, e in sorted(ranges):
        e = min(e, len(data))
        if s > at or not runs:
            out.append(data[at:s])
            runs += 1
            removed += e - s
            at = e
        elif e > at:
            removed += e - at
            at = e
    out.append(data[at:])
    return b"".join(out), removed, runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   hot_kinds: int = HOT_KINDS, local_kinds: int = LOCAL_KINDS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), kept being the bytes that stay; one row per input row.

    Null texts count as empty; texts under LENGTH bytes lose nothing.  Rows
    with a null id lose nothing and make nothing a repeat.  Rows of the same
    id and text are one document.  Rows of one id with different texts are
    documents of their own, in the order of their texts' MD5; each loses what
    an earlier one holds.  An empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    texts = numbered_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    ranges = covered_ranges(texts.where("doc_id is not null and text is not null"), hot_kinds, local_kinds)
    k = F.shiftright("start", TEXT_BITS).alias("k")
    per_doc = ranges.groupBy("doc_id", k).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = texts.mapInArrow(_pack, "doc_id long, k long, packed binary").join(per_doc, ["doc_id", "k"], "left")

    def run(batches):
        opener = zstandard.ZstdDecompressor()
        for b in slices(batches):
            done = []
            for k, packed, ranges_ in zip(*(b.column(c).to_pylist() for c in ("k", "packed", "ranges"))):
                data, base = opener.decompress(packed), k << TEXT_BITS
                done.append((len(data), *cut(data, [(r["start"] - base, r["stop"] - base) for r in ranges_ or ()])))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([d[0] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                pa.array([d[3] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
