"""Removal of long byte strings that a document of a smaller id holds too.

A byte goes if it lies in a string of `length` bytes that also starts in a
document with a smaller id.  Every such string ("window") holds an anchor: the
leftmost of its `lead`-byte strings with the smallest hash.  Equal windows have
equal anchors at equal offsets, so only the suffixes that start at anchors,
about one in seventeen, are sorted:

1. Sampled splitters deal the suffixes by their leading bytes (and by id, so
   that a string in very many documents spreads) into ranges.  A range is
   sorted by 8 bytes of text, a 32-bit hash of those after, and a hash of the
   surroundings, the next key only where the last one ties; neighbours count as
   equal by these hashes, no bytes are compared.  Groups at the ends of a range, which may go on in
   the next, are compared across boundaries.  A suffix whose surroundings (all
   windows that can hold its anchor) occur in a smaller id is settled: all of
   it goes.  Of equal surroundings only the smallest id's can matter further,
   and only where the group has others that may agree on one side.
2. Windows around those few suffixes are compared one by one, by 128-bit
   hashes: first inside a part of the documents, then between parts, where a
   window counts once for each part.

Results: maximal removed runs.  Null texts count as empty.  Texts shorter than
`length` lose nothing.  Rows with a null id come after all ids and remove
nothing from one another; their texts are told apart by a 63-bit hash.  Any
other id stands for one text; rows that repeat id and text share their result
and never remove each other.  Extra columns are ignored.  An empty table gives
an empty result.

Ranges of suffixes and parts of the documents hold `range_bytes` of text on
average, whatever the table's size, so what one task holds at a time is bounded;
parts are dealt by a hash of id and text, so null ids and ids of a common stride
spread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import Stages, clear_worker, give_back, partitions, small_batches
from corpusmill.llm.shingles import mix, seeds

U = np.uint64
NO_ID = (1 << 63) - 1
#: Flags of an entry: the anchor with all around it goes; windows on a side of
#: it are still open; the window that starts here goes.
SETTLED, RIGHT, LEFT, GONE = 1, 2, 4, 8
LAST = U(0xFFFFFFFFFFFFFFFF)
#: The primes of the published hash XXH64.
XXH64_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Suffixes:
    length: int = 50
    lead: int = 16           # bytes of an anchor
    side: int = 17           # windows that start less than this before their anchor count as its right side
    sample_docs: int = 8     # sampled for each range
    deal_rows: int = 300_000  # suffixes packed at once
    range_bytes: int = 64 << 20  # text of a range or part at most, on average

    @property
    def reach(self) -> int:
        """How far before its anchor a window can start."""
        return self.length - self.lead


# columns of numbers as one compressed binary

def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length; bytes of equal rank lie together."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return len(columns[0]).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:4], "little"), 0, []
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), np.uint8)
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def joined(batches: list, *kinds: str) -> list[np.ndarray]:
    """The columns packed in the bodies of `batches`, which is left empty; no column is held twice."""
    pieces = []
    while batches:
        pieces += [unpack(b.as_py(), *kinds) for b in batches.pop(0).column("body")]
    return merged(pieces)


def merged(pieces: list[list]) -> list[np.ndarray]:
    """Each column in one, of all pieces, which are left empty."""
    out = []
    for i in range(len(pieces[0])):
        out.append(np.concatenate([p[i] for p in pieces]))
        for p in pieces:
            p[i] = None
    pieces.clear()
    return out


def in_order(columns: list[np.ndarray], order: np.ndarray):
    """The columns in turn, each sorted and then dropped from the list."""
    while columns:
        yield columns.pop(0)[order]


# a row is known by its id and, where that is null, by a mark; all other marks are 0 and take no room once packed
SUFFIX = ("<u8", "<u4", "<u8", "<u2", "<u2", "<i8", "<i8", "<u4")  # lead, rest, around, left, right, doc, mark, pos
ENTRY = ("<i8", "<i8", "<u4", "<u1")                              # doc, mark, pos, flags
WINDOW = ("<u8", "<u8", "<i8", "<i8", "<u4")                      # two hashes, doc, mark, pos


def row_mark():
    """0, or for rows without an id a hash of the text."""
    return F.when(F.col("id").isNull(), F.xxhash64("body").bitwiseAND(F.lit(NO_ID)).bitwiseOR(F.lit(1))).otherwise(F.lit(0))


def part_column(parts: int):
    """`part_of` of the columns id and mark."""
    return F.pmod(F.xxhash64(F.coalesce("id", F.lit(NO_ID)).bitwiseXOR(F.col("mark"))), F.lit(parts)).cast("int")


def part_of(doc: np.ndarray, mark: np.ndarray, parts: int) -> np.ndarray:
    """The part of each row, by the hash that the column function xxhash64 gives one long."""
    turned = lambda x, by: x << U(by) | x >> U(64 - by)
    p1, p2, p3, p4, p5 = (U(p) for p in XXH64_PRIMES)
    h = (U(42) + p5 + U(8)) ^ turned((doc ^ mark).astype("<i8").view(U) * p2, 31) * p1
    h = turned(h, 27) * p1 + p4
    h = (h ^ h >> U(33)) * p2
    h = (h ^ h >> U(29)) * p3
    return np.mod((h ^ h >> U(32)).view(np.int64), parts)


# texts of a batch as one array of bytes

class Prefixes:
    """Hashes of any byte range of a batch of texts, from prefix sums."""

    def __init__(self, texts: list[bytes], seed: int = 51):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.text_of = np.repeat(np.arange(len(texts)), lengths)
        self._sums = {}

    def sums(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        if seed not in self._sums:
            base = int(seeds(1, seed)[0]) | 1
            n = len(self.data)
            up, down = (_powers(b, n + 1) for b in (base, pow(base, -1, 1 << 64)))
            values = seeds(256, seed + 1)
            self._sums[seed] = np.concatenate([np.zeros(1, U), np.cumsum(values[self.data] * up[:n], dtype=U)]), down
        return self._sums[seed]

    def hash(self, lo: np.ndarray, hi: np.ndarray, seed: int = 51) -> np.ndarray:
        sums, down = self.sums(seed)
        return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(U))


_power_cache: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_power_cache.get(base, ())) < n:
        table = np.full(max(n, 1), base, dtype=U)
        table[0] = 1
        _power_cache[base] = np.multiply.accumulate(table)
    return _power_cache[base]


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over each `width` neighbours."""
    step = 1
    while step * 2 <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(p: Prefixes, how: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all lead-byte strings, places of those that are smallest in some window)."""
    n = len(p.data)
    if n < how.length:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.arange(n - how.lead + 1)
    h = p.hash(at, at + how.lead) >> U(1)
    end = p.ends[p.text_of]
    h[at + how.lead > end[:len(at)]] = LAST
    per_window = sliding(h, how.reach + 1, np.minimum)
    inside = np.arange(len(per_window)) + how.length <= end[:len(per_window)]
    edge = np.zeros(how.reach, U)
    least = sliding(np.concatenate([edge, np.where(inside, per_window, U(0)), edge]), how.reach + 1, np.maximum)
    return h, np.flatnonzero((least == h) & (h != LAST))


def suffix_columns(p: Prefixes, docs: np.ndarray, marks: np.ndarray, how: Suffixes) -> list[np.ndarray]:
    _, at = anchors(p, how)
    text = p.text_of[at] if len(at) else at
    start, end = p.starts[text], p.ends[text]
    lead = np.zeros(len(at), U)
    for k in range(8):
        lead = lead << U(8) | p.data[at + k].astype(U)
    lo, hi = np.maximum(at - how.reach, start), np.minimum(at + how.length, end)
    around = mix(p.hash(lo, hi) ^ (at - lo).astype(U))
    # what the windows on one side of the anchor have in common; near an end of the text there are none
    right, left = np.minimum(at + how.length - how.side + 1, end), np.maximum(at - how.side, start)
    return [lead, (p.hash(at + 8, at + how.lead) >> U(32)).astype("<u4"), around,
            p.hash(left, at).astype("<u2"), p.hash(at, right).astype("<u2"), docs[text], marks[text], (at - start).astype("<u4")]


def order_key(lead: np.ndarray, rest: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The sort order as byte strings of fixed length."""
    out = np.empty((len(lead), 20), np.uint8)
    out[:, :8] = lead.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 8:12] = rest.astype(">u4").view(np.uint8).reshape(-1, 4)
    out[:, 12:] = (doc.astype("<u8") ^ U(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S20")


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Ascending by the keys in turn; a later key is looked at only where all before it tie."""
    order = np.argsort(keys[0])
    tied = group_starts(keys[0][order])
    for key in keys[1:]:
        group = np.cumsum(tied)
        size = np.bincount(group)[group]
        open_ = np.flatnonzero(size > 1)
        if not len(open_):
            break
        inner = np.lexsort((key[order[open_]], group[open_]))
        order[open_] = order[open_[inner]]
        tied = tied | group_starts(key[order])
    return order


def group_starts(sorted_: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    return np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, bool)


def _texts(batch: pa.RecordBatch, max_bytes: int = 250_000):
    """(docs, marks, texts as bytes) of bounded size out of a batch with id, mark
    and body; numpy takes some 90 bytes for each byte of text."""
    ids, all_marks, bodies = (batch.column(c).to_pylist() for c in ("id", "mark", "body"))
    docs, marks, texts, size = [], [], [], 0
    for i, m, b in zip(ids, all_marks, bodies):
        docs.append(NO_ID if i is None else i)
        marks.append(m)
        texts.append(b or b"")
        size += len(texts[-1])
        if size >= max_bytes:
            yield np.array(docs, np.int64), np.array(marks, np.int64), texts
            docs, marks, texts, size = [], [], [], 0
    if docs:
        yield np.array(docs, np.int64), np.array(marks, np.int64), texts


def _dealt(numbers: np.ndarray, columns: list[np.ndarray]):
    """(number, columns of its rows) for each number."""
    order = np.argsort(numbers, kind="stable")
    cuts = np.flatnonzero(group_starts(numbers[order]))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        yield int(numbers[order[lo]]), [c[order[lo:hi]] for c in columns]


def _by_key(batches, key: str):
    """(key, batches of rows with it) out of batches that are sorted by key."""
    at, held = None, []
    for batch in batches:
        numbers = np.array(batch.column(key))
        cuts = np.flatnonzero(group_starts(numbers))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(numbers)]):
            if numbers[lo] != at:
                if held:
                    yield at, held
                at, held = numbers[lo], []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield at, held


def splitters(df: DataFrame, how: Suffixes, ranges: int, total: int) -> np.ndarray:
    """Sort keys that deal a sample's suffixes evenly."""
    wanted = how.sample_docs * ranges
    sample = df.sample(min(1.0, (wanted + 10) / max(total, 1)), seed=7)

    def run(batches):
        for batch in batches:
            for docs, marks, texts in _texts(batch):
                columns = suffix_columns(Prefixes(texts), docs, marks, how)
                keys = order_key(columns[0], columns[1], columns[5])
                keys = keys[(columns[2] & U(7)) == 0]  # one in eight
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(keys).view("V20").tolist(), pa.binary())], names=["key"])

    keys = np.sort(np.array([bytes(r.key) for r in sample.mapInArrow(run, "key binary").collect()], dtype="S20"))
    return keys[np.linspace(0, len(keys), ranges + 1)[1:-1].astype(int)] if len(keys) else keys


def suffix_blobs(df: DataFrame, how: Suffixes, cuts: np.ndarray) -> DataFrame:
    """(range, body): packed suffixes of a batch that fall into a range."""
    shared = df.sparkSession.sparkContext.broadcast(cuts)  # a key for each range

    def run(batches):
        clear_worker()
        give_back()
        held, n = [], 0
        for batch in batches:
            for docs, marks, texts in _texts(batch):
                held.append(suffix_columns(Prefixes(texts), docs, marks, how))
                n += len(held[-1][0])
                if n >= how.deal_rows:
                    yield deal(held)
                    n = 0
        if n:
            yield deal(held)
        give_back()

    def deal(held):
        columns = merged(held)
        number = np.searchsorted(shared.value, order_key(columns[0], columns[1], columns[5]), side="right")
        rows = [(k, pack(*own)) for k, own in _dealt(number, columns)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["range", "body"])

    return df.mapInArrow(run, "range int, body binary")


FOUND = "part int, body binary, lead long, rest long, around long, doc long, mark long, pos long"


def compare_ranges(blobs: DataFrame, parts: int, ranges: int) -> DataFrame:
    """Sorts each range and compares neighbours.  Rows with a body hold the
    entries of one part of the documents; the others are suffixes of groups at
    a range's ends."""
    def run(batches):
        for _, held in _by_key(batches, "range"):
            give_back()
            columns = joined(held, *SUFFIX)
            order = multikey_order(columns[0], columns[1], columns[5])
            lead, rest, around, left, right, doc, mark, pos = in_order(columns, order)
            start = group_starts(lead) | group_starts(rest)
            group = np.cumsum(start) - 1
            first = np.flatnonzero(start)
            last = np.concatenate([first[1:], [len(doc)]]) - 1
            edge = (group == 0) | (group == group[-1])
            several = (doc[first] != doc[last])[group]
            flags, own = np.zeros(len(doc), np.uint8), np.flatnonzero(several)
            if len(own):
                flags[own] = compare_groups(group[own], around[own], left[own], right[own], doc[own])
            # at the ends only what has no smaller id here is left to compare: a surrounding counts once for each range
            edge &= flags != SETTLED
            hit = np.flatnonzero((flags > 0) & ~edge)
            rows = [(p, pack(*c), *[None] * 6) for p, c in _dealt(
                part_of(doc[hit], mark[hit], parts), [doc[hit], mark[hit], pos[hit], flags[hit]])] if len(hit) else []
            rows += [(None, None, int(lead[i].astype(np.int64)), int(rest[i]), int(around[i].astype(np.int64)), int(doc[i]),
                      int(mark[i]), int(pos[i])) for i in np.flatnonzero(edge)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), *[pa.int64()] * 6))],
                names=["part", "body", "lead", "rest", "around", "doc", "mark", "pos"])

    return (blobs.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, FOUND))


def compare_groups(group, around, left, right, doc) -> np.ndarray:
    """Flags of suffixes in groups of several documents, sorted by group and doc."""
    order = np.lexsort((doc, around, group))
    start = group_starts(group[order]) | group_starts(around[order])
    same = np.cumsum(start) - 1
    smallest = doc[order][start][same]
    flags = np.zeros(len(doc), np.uint8)
    settled = doc[order] > smallest
    flags[order[settled]] = SETTLED
    owners = order[~settled]
    # owners meet again where the group has others with another surrounding that agree on a side
    for flag, side in ((RIGHT, right), (LEFT, left)):
        key = np.lexsort((doc[owners], side[owners], group[owners]))
        own = owners[key]
        begin = group_starts(group[own]) | group_starts(side[own])
        g = np.cumsum(begin) - 1
        first = np.flatnonzero(begin)
        end = np.concatenate([first[1:], [len(own)]]) - 1
        flags[own[(doc[own[first]] != doc[own[end]])[g]]] |= flag
    return flags


def edge_entries(found: DataFrame) -> DataFrame:
    """(doc, mark, pos, flags) of the suffixes at the ends of ranges, compared across boundaries."""
    edge = found.where("body is null").select("lead", "rest", "around", "doc", "mark", "pos")
    key = ["lead", "rest", "around"]
    smallest = edge.groupBy(key).agg(F.min("doc").alias("smallest"))
    return edge.join(smallest, key).select("doc", "mark", "pos", F.when(
        F.col("doc") > F.col("smallest"), F.lit(SETTLED)).otherwise(F.lit(RIGHT | LEFT)).alias("flags"))


def _entries(rows: pa.RecordBatch) -> list[list[np.ndarray]]:
    """Entries of rows: packed ones, and single ones in the columns id, mark, pos and flags."""
    out = [unpack(b, *ENTRY) for b in rows.column("body").to_pylist() if b is not None]
    single = [(d, m, p, f) for d, m, p, f in zip(*(rows.column(c).to_pylist() for c in ("id", "mark", "pos", "flags"))) if p is not None]
    if single:
        out.append([np.array(c, k) for c, k in zip(zip(*single), ENTRY)])
    return out


class PartEntries:
    """Entries of one part, found by document."""

    def __init__(self, pieces: list[list[np.ndarray]]):
        doc, mark, pos, flags = ([np.concatenate(c) for c in zip(*pieces)] if pieces
                                 else [np.zeros(0, k) for k in ENTRY])
        order = np.lexsort((mark, doc)) if mark.any() else np.argsort(doc, kind="stable")
        self.doc, self.mark, self.pos, self.flags = doc[order], mark[order], pos[order].astype(np.int64), flags[order]

    def of(self, docs: np.ndarray, marks: np.ndarray, p: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place in the batch, flags) of the entries of a batch's documents."""
        lo, hi = np.searchsorted(self.doc, docs, "left"), np.searchsorted(self.doc, docs, "right")
        last = docs == NO_ID
        if last.any():  # here the mark decides
            base = np.searchsorted(self.doc, NO_ID, "left")
            lo[last], hi[last] = (base + np.searchsorted(self.mark[base:], marks[last], side) for side in ("left", "right"))
        n = hi - lo
        text = np.repeat(np.arange(len(docs)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return text, self.pos[at] + p.starts[text], self.flags[at]


def with_texts(texts: DataFrame, entries: DataFrame, parts: int) -> DataFrame:
    """Entries of a part, then its texts, in one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    rows = texts.select(part_column(parts).alias("part"), F.lit(1).alias("kind"), "id", "mark", "body",
                        none("long").alias("pos"), none("int").alias("flags"))
    return (entries.select("part", F.lit(0).alias("kind"), "id", "mark", "body", "pos", "flags").unionByName(rows)
            .repartition(parts, "part").sortWithinPartitions("part", "kind"))


def _part_stream(batches):
    """(part, PartEntries or None, text batch or None): entries of a part first,
    then its texts as they come; None for both at the part's end."""
    at, pieces, entries = None, [], None
    for batch in batches:
        number = np.array(batch.column("part")).astype(np.int64) * 2 + np.array(batch.column("kind"))
        cuts = np.flatnonzero(group_starts(number))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(number)]):
            part, kind = divmod(int(number[lo]), 2)
            if part != at:
                if at is not None:
                    yield at, None, None
                at, pieces, entries = part, [], None
            if kind == 0:
                pieces += _entries(batch.slice(lo, hi - lo))
            else:
                entries = entries or PartEntries(pieces)
                yield part, entries, batch.slice(lo, hi - lo)
    if at is not None:
        yield at, None, None


def open_windows(dealt: DataFrame, how: Suffixes, parts: int) -> DataFrame:
    """(part, body, range): windows around unsettled suffixes.  Inside a part a
    window keeps its smallest document; those of the others are entries at once
    (range null)."""
    def run(batches):
        held: list[list[np.ndarray]] = []
        for part, entries, batch in _part_stream(batches):
            if entries is None:
                yield from compare(part, held)
                give_back()
                continue
            for docs, marks, texts in _texts(batch):
                p = Prefixes(texts)
                text, at, flags = entries.of(docs, marks, p)
                wanted = (flags & (RIGHT | LEFT)) > 0
                if wanted.any():
                    held.append(windows(p, docs, marks, text[wanted], at[wanted], flags[wanted]))

    def windows(p, docs, marks, text, at, flags):
        h, _ = anchors(p, how)
        back = np.where(flags & RIGHT, 0, how.side)
        far = np.where(flags & LEFT, how.reach, how.side - 1)
        lo = np.maximum(at - far, p.starts[text])
        hi = np.minimum(at - back, p.ends[text] - how.length)
        n = np.maximum(hi - lo + 1, 0)
        own = np.repeat(np.arange(len(at)), n)
        s = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[own]
        # only windows whose leftmost smallest string is this anchor
        least = sliding(h, how.reach + 1, np.minimum)
        s, own = s[least[s] == h[at[own]]], own[least[s] == h[at[own]]]
        s = np.unique(s)
        t = p.text_of[s]
        return [p.hash(s, s + how.length), p.hash(s, s + how.length, 77), docs[t], marks[t], (s - p.starts[t]).astype("<u4")]

    def compare(part, held):
        if not held:
            return
        columns = merged(held)
        order = multikey_order(columns[0], columns[1], columns[2])
        a, b, doc, mark, pos = in_order(columns, order)
        start = group_starts(a) | group_starts(b)
        smallest = doc[start][np.cumsum(start) - 1]
        later = np.flatnonzero(doc > smallest)
        rows = [(part, pack(doc[later], mark[later], pos[later], np.full(len(later), GONE, np.uint8)), None)] if len(later) else []
        stay = np.flatnonzero(doc == smallest)
        number = (a[stay] >> U(32)).astype(np.int64) * parts >> 32
        rows += [(part, pack(*c), k) for k, c in _dealt(number, [x[stay] for x in (a, b, doc, mark, pos)])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.int32()))],
                                         names=["part", "body", "range"])

    return dealt.mapInArrow(run, "part int, body binary, range int")


def compare_windows(blobs: DataFrame, parts: int) -> DataFrame:
    """(part, body): entries of windows that another part holds in a smaller document."""
    def run(batches):
        for _, held in _by_key(batches, "range"):
            give_back()
            columns = joined(held, *WINDOW)
            order = multikey_order(columns[0], columns[1], columns[2])
            a, b, doc, mark, pos = in_order(columns, order)
            start = group_starts(a) | group_starts(b)
            hit = np.flatnonzero(doc > doc[start][np.cumsum(start) - 1])
            if len(hit):
                rows = list(_dealt(part_of(doc[hit], mark[hit], parts),
                                   [doc[hit], mark[hit], pos[hit], np.full(len(hit), GONE, np.uint8)]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([pack(*r[1]) for r in rows], pa.binary())],
                                                 names=["part", "body"])

    return blobs.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(run, "part int, body binary")


def remaining(dealt: DataFrame, how: Suffixes) -> DataFrame:
    """(id, n_bytes, starts and ends of the removed runs, kept binary)."""
    def run(batches):
        for _, entries, batch in _part_stream(batches):
            if entries is None:
                give_back()
                continue
            for docs, marks, texts in _texts(batch):
                p = Prefixes(texts)
                text, at, flags = entries.of(docs, marks, p)
                gone = (flags == SETTLED) | (flags == GONE)
                text, at, anchor = text[gone], at[gone], flags[gone] == SETTLED
                lo = np.where(anchor, np.maximum(at - how.reach, p.starts[text]), at)
                hi = np.minimum(at + how.length, p.ends[text])
                change = np.bincount(lo, minlength=len(p.data) + 1) - np.bincount(hi, minlength=len(p.data) + 1)
                removed = np.cumsum(change)[:-1] > 0
                out = ([], [], [], [])
                for doc, mark, lo, hi in zip(docs.tolist(), marks.tolist(), p.starts.tolist(), p.ends.tolist()):
                    mask = removed[lo:hi]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).view(np.int8)))
                    for column, x in zip(out, (None if mark else doc, hi - lo, edges.tolist(), p.data[lo:hi][~mask].tobytes())):
                        column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                    names=["id", "n_bytes", "edges", "kept"])

    return dealt.mapInArrow(run, "id long, n_bytes long, edges array<long>, kept binary")


def dedup_suffixes(df: DataFrame, stages: Stages, how: Suffixes = Suffixes(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_bytes, edges, kept): the removed runs' starts and ends in turn, and the remaining bytes."""
    spark = df.sparkSession
    small_batches(spark)
    # packed rows are far longer than texts
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    texts = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
             .withColumn("mark", row_mark()))
    total = texts.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("body")).alias("bytes")).first()
    parts = ranges = max(partitions(spark), -(-(total.bytes or 0) // how.range_bytes))
    cuts = splitters(texts, how, ranges, total.rows)
    found = stages.put("found", compare_ranges(suffix_blobs(texts, how, cuts), parts, ranges))
    none = lambda kind: F.lit(None).cast(kind)

    def packed(rows: DataFrame) -> DataFrame:
        return rows.select("part", none("long").alias("id"), none("long").alias("mark"), "body", none("long").alias("pos"), none("int").alias("flags"))

    edges = (edge_entries(found).withColumnRenamed("doc", "id")
             .select(part_column(parts).alias("part"), "id", "mark", none("binary").alias("body"), "pos", "flags"))
    entries = stages.put("entries", packed(found.where("body is not null")).unionByName(edges))
    opened = stages.put("windows", open_windows(with_texts(texts, entries, parts), how, parts))
    across = stages.put("across", compare_windows(opened.where("range is not null").select("range", "body"), parts))
    gone = opened.where("range is null").select("part", "body").unionByName(across)
    return remaining(with_texts(texts, entries.unionByName(packed(gone)), parts), how)
