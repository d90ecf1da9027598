"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE file of the tokenizers library and encodes space + text,
B a sentencepiece model that adds the space itself; neither reads special
tokens' strings inside texts as such.  A token's bytes are A's entry decoded from the byte-level
alphabet, and B's piece in UTF-8 (U+2581 is a space, <0xHH> the byte HH).
Byte offsets where tokens of both end cut them into groups.

Groups are found by diagonal run skipping over the two arrays of token ends
(`groups_of`): at the current index shift the arrays are compared in steps that
double, so a stretch of one-to-one tokens is jumped over; the first difference,
found by halving the last step, opens an irregular group, which is closed token by
token and gives the new shift.

All pairs of an A and a B token in a group are links.  `align` gives each
document's groups and its links by distinct id pair; documents are
held in blocks of bounded size, whose distinct pairs are listed once.
`link_scores` counts, over the corpus, the documents that hold a pair linked (a row for each
block and pair moves, not for each document and pair), takes the highest count of each
A id, and brings both back to the blocks' documents.

A text that is null or empty, or whose A or B tokens do not join to space +
text, has no tokens.  Every row is a document, repeated ids and texts included;
ids may be null.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from corpusmill.llm.common import Stages, partitions, per_worker, small_batches, text_batches
from corpusmill.llm.records import byte_letters

#: The character that stands for a space in sentencepiece's pieces.
BLANK = "▁"
#: Tokens compared one by one before steps begin, and the first step.
STEP = 4
#: Longer fragments are not kept from one batch to the next.
LONG = 64
#: New fragments that are encoded as one text.
TOGETHER = 256


@dataclass(frozen=True)
class Alignment:
    block_bytes: int = 8_000_000    # text of the documents whose pairs are listed together, about
    group_links: int = 4096         # links of a group that are spelled out; larger groups count distinct ids
    cached: int = 400_000           # fragments kept by each coder


def groups_of(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each group the places behind its last A and B token, from the ends of
    the tokens (ascending, the last ones equal)."""
    n = len(a)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = [*a, -1], [*b, -2]  # beyond the ends nothing is equal
    runs: list[int] = []  # a run's begin and length, and the ends of the irregular group behind it
    i = j = 0
    while i < n:
        at_a, at_b = i, j
        x, y = a[i], b[j]
        few = i + STEP
        while x == y and i < few:  # most stretches are short
            i += 1
            j += 1
            x, y = a[i], b[j]
        if x == y:
            step = STEP
            while a[i:i + step] == b[j:j + step]:
                i, j, step = i + step, j + step, 2 * step
            while step > 1:
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
            x, y = a[i], b[j]
        length = i - at_a
        if i < n:
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
        runs += (at_a, at_b, length, i, j)
    at_a, at_b, length, end_a, end_b = np.array(runs, np.int64).reshape(-1, 5).T
    groups = length + (end_a > at_a + length)
    last = np.cumsum(groups) - 1
    within = np.arange(last[-1] + 1) - np.repeat(last + 1 - groups, groups) + 1
    out_a, out_b = np.repeat(at_a, groups) + within, np.repeat(at_b, groups) + within
    out_a[last], out_b[last] = end_a, end_b
    return out_a, out_b


def bytes_of_a(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level BPE vocabulary."""
    byte_of = {c: b for b, c in byte_letters().items()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        if all(c in byte_of for c in token):
            out[i] = bytes(byte_of[c] for c in token)
    return out


def bytes_of_b(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece."""
    pieces = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:-1], 16)]) if is_byte else p.replace(BLANK, " ").encode() for p, is_byte in pieces]


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of runs of n places each."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class _Flat:
    """The ids of several texts one after another, `n` of each."""

    def __init__(self, ids: list[list[int]], table: np.ndarray, lengths: np.ndarray):
        self.n = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter(chain.from_iterable(ids), "<u4", int(self.n.sum()))
        self.table, self.lengths = table, lengths

    def spells(self, texts: list[bytes], size: np.ndarray) -> np.ndarray:
        """Whether each text's tokens join to it."""
        words = self.table[self.ids]
        total = np.concatenate([[0], np.cumsum(self.lengths[self.ids])])
        at = np.concatenate([[0], np.cumsum(self.n)])
        same = np.diff(total[at]) == size
        if not same.all() or b"".join(words.tolist()) != b"".join(texts):
            same = np.array([b"".join(words[lo:hi].tolist()) == t for lo, hi, t in zip(at[:-1].tolist(), at[1:].tolist(), texts)], bool)
        return same

    def cut(self, edges: np.ndarray) -> np.ndarray | None:
        """How many ids lie between the edges, in bytes; None if a token crosses one."""
        ends = np.cumsum(self.lengths[self.ids])
        last = np.searchsorted(ends, edges)
        return np.diff(last + 1, prepend=0) if np.array_equal(ends[last], edges) else None


class Aligner:
    """Aligns batches of texts.

    Tokens of what stands between spaces are kept in a bounded cache.  A space
    with other characters than white space around it always begins a pre-token of
    A, and no piece of B holds the blank behind another character, so a text's
    tokens are those of its fragments, each behind a space, one after another;
    fragments whose tokens do not spell them are no part of this.  New fragments
    are encoded many at a time for the same reason, joined by spaces.  Texts with any other arrangement
    of spaces, or all texts where B has such pieces, are encoded whole.

    Each fragment has a number: 0 if it is no safe cut, else its place among the kept ids."""

    def __init__(self, tokenizer_json: str, proto: bytes, how: Alignment):
        self.how = how
        self.a, self.b = Tokenizer.from_str(tokenizer_json), sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.a.encode_special_tokens = True
        tables = bytes_of_a(self.a), bytes_of_b(self.b)
        self.apart = not any(b" " in t.lstrip(b" ") for t in tables[1])
        self.bytes = [np.array([*t, None], object)[:-1] for t in tables]
        self.lengths = [np.array([len(x) for x in t], np.int64) for t in tables]
        # each id as text: inside a list, and at its end
        self.spelled = np.array([f"{i}{end}".encode() for n, ends in zip(map(len, tables), (",|", ",;"))
                                 for end in ends for i in range(n)] + [None], object)[:-1]
        self.known: dict[str, int] = {}
        self.kept = [(np.zeros(1, np.int64), np.zeros(0, "<u4")) for _ in tables]  # ids of each fragment, by number
        self.uses = np.zeros(1, np.int64)

    def _encode(self, texts: list[str], together: int = 1):
        """Texts in some order, for one at a time in the given one, and for A and B
        the number of ids of each text and the ids: A's of space + text, B's of the text;
        none where either does not spell space + text.  So many texts together
        are joined by spaces, if they are fragments; those that cannot be cut again, in ever fewer."""
        order, again, out = [], [], [([np.zeros(0, np.int64)], [np.zeros(0, "<u4")]) for _ in self.bytes]
        for at in range(0, len(texts), 2000):
            part = texts[at:at + 2000]
            groups = [part[i:i + together] for i in range(0, len(part), together)]
            lines = [" ".join(g) for g in groups]
            coded = [e.ids for e in self.a.encode_batch_fast([" " + t for t in lines], add_special_tokens=False)]
            both = [_Flat(x, *tables) for x, *tables in zip(
                (coded, self.b.encode(lines, out_type=int, num_threads=1)), self.bytes, self.lengths)]
            want = [b" " + t.encode() for t in lines]
            size = np.array([len(w) for w in want])
            same = np.logical_and(*(x.spells(want, size) for x in both)) & (size > 1)
            for x in both:
                x.ids, x.n = x.ids[np.repeat(same, x.n)], np.where(same, x.n, 0)
            n = [x.n for x in both]
            if together > 1:
                whole = list(chain.from_iterable(compress(groups, same)))
                edges = np.cumsum([len(f.encode()) + 1 for f in whole], dtype=np.int64)
                n = [x.cut(edges) for x in both]
                if n[0] is None or n[1] is None:
                    again += part
                    continue
                again += chain.from_iterable(compress(groups, ~same))
                part = whole
            order += part
            for (numbers, ids), x, k in zip(out, both, n):
                numbers.append(k)
                ids.append(x.ids)
        if again:
            rest, *more = self._encode(again, max(1, together // 16))
            order += rest
            for (numbers, ids), (k, x) in zip(out, more):
                numbers.append(k)
                ids.append(x)
        return order, *((np.concatenate(numbers), np.concatenate(ids)) for numbers, ids in out)

    def _forget(self) -> None:
        """A full cache keeps what was used more than once since the last time, if that is no more than half."""
        often = np.flatnonzero(self.uses > 1)
        if len(often) > self.how.cached // 2:
            often = often[:0]
        number = np.zeros(len(self.uses), np.int64)
        number[often] = np.arange(1, len(often) + 1)
        number = number.tolist()
        self.known = {f: number[i] for f, i in self.known.items() if number[i]}
        self.kept = [(np.concatenate([[0], n[often]]), ids[_runs((np.cumsum(n) - n)[often], n[often])]) for n, ids in self.kept]
        self.uses = np.zeros(len(often) + 1, np.int64)

    def _coded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B the number of ids of each text that both can spell, 0 for the others, and all ids."""
        if len(self.known) > self.how.cached:
            self._forget()
        known = self.known
        parts = [t.split(" ") if self.apart else [""] for t in texts]
        new = set(chain.from_iterable(parts)).difference(known)
        safe = [f for f in new if f and not f[0].isspace() and not f[-1].isspace()]
        known.update(dict.fromkeys(new, 0))
        found = [self._encode([f for f in safe if (len(f) > LONG) == long], TOGETHER) for long in (False, True)]
        at = len(self.uses)
        for order, (n, _), _ in found:
            # without ids: no safe cut
            known.update(zip(order, np.where(n > 0, np.arange(at, at + len(n)), 0).tolist()))
            at += len(n)
        count = np.array([len(p) for p in parts], np.int64)
        number = np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.int64, int(count.sum()))
        first = np.cumsum(count) - count
        whole = np.logical_or.reduceat(number == 0, first)
        # a text with a fragment that is no safe cut has one number of its own
        stays = ~np.repeat(whole, count)
        stays[first[whole]] = True
        number[first[whole]] = np.arange(at, at + int(whole.sum()))
        number, count = number[stays], np.where(whole, 1, count)
        first = np.cumsum(count) - count
        found.append(self._encode(list(compress(texts, whole))))
        for f in new:
            if len(f) > LONG:
                del known[f]
        keep = len(self.uses) + len(found[0][0])
        self.uses = np.concatenate([self.uses, np.zeros(len(found[0][0]), np.int64)]) + np.bincount(number, minlength=at)[:keep]
        out = []
        for k, kept in enumerate(self.kept):
            n, ids = (np.concatenate(x) for x in zip(kept, *(f[1 + k] for f in found)))
            begin = np.cumsum(n) - n
            self.kept[k] = n[:keep], ids[:int(n[:keep].sum())]
            own = n[number]
            out.append((np.add.reduceat(own, first), ids[_runs(begin[number], own)]))
        return out

    def tokens(self, texts: list[str]) -> list[list[np.ndarray]]:
        """A's and B's ids of each text that both can spell, empty arrays for the others."""
        return [np.split(ids, np.cumsum(n)[:-1]) for n, ids in self._coded(texts)]

    def align(self, texts: list[str]):
        """(n_a, n_b, n_groups, n_links: arrays [texts]; groups: list of bytes; and the
        links by (text, id of A, id of B, number): arrays)."""
        n, ids = zip(*self._coded(texts))
        ids = [x.astype(np.int64) for x in ids]
        ends = [np.cumsum(table[x]) for table, x in zip(self.lengths, ids)]
        cut_a, cut_b = groups_of(ends[0].tolist(), ends[1].tolist())
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        text = np.searchsorted(np.cumsum(n[0]), cut_a, side="left")
        links = size_a * size_b
        n_groups = np.bincount(text, minlength=len(texts))
        edges = np.concatenate([[0], np.cumsum(n_groups)])
        total = np.concatenate([[0], np.cumsum(links)])
        pairs = self._pairs(ids, text, cut_a - size_a, cut_b - size_b, size_a, size_b, links)
        return n[0], n[1], n_groups, total[edges[1:]] - total[edges[:-1]], self._spell(ids, n, cut_a, cut_b), pairs

    def _pairs(self, ids, text, from_a, from_b, size_a, size_b, links):
        width = [len(t) for t in self.bytes]
        key = lambda t, x, y: (t * width[0] + x) * width[1] + y
        small = np.flatnonzero(links <= self.how.group_links)
        g = np.repeat(small, links[small])
        at = np.arange(len(g)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
        found, number = np.unique(key(text[g], ids[0][from_a[g] + at // size_b[g]], ids[1][from_b[g] + at % size_b[g]]),
                                  return_counts=True)
        more = [(found, number)]
        for k in np.flatnonzero(links > self.how.group_links).tolist():
            (x, nx), (y, ny) = (np.unique(v[lo:lo + m], return_counts=True) for v, lo, m in (
                (ids[0], from_a[k], size_a[k]), (ids[1], from_b[k], size_b[k])))
            more.append((key(text[k], np.repeat(x, len(y)), np.tile(y, len(x))), np.repeat(nx, len(y)) * np.tile(ny, len(x))))
        if len(more) > 1:
            keys, counts = (np.concatenate(c) for c in zip(*more))
            found, inverse = np.unique(keys, return_inverse=True)
            number = np.zeros(len(found), np.int64)
            np.add.at(number, inverse, counts)
        rest, y = np.divmod(found, width[1])
        t, x = np.divmod(rest, width[0])
        return t, x, y, number

    def _spell(self, ids, n, cut_a, cut_b) -> list[bytes]:
        """The groups of each text as a1,a2|b1;a3|b2,b3."""
        n_a, n_b = len(self.bytes[0]), len(self.bytes[1])
        parts, order = [], []
        for own, cut, size, base in ((ids[0], cut_a, n_a, 0), (ids[1], cut_b, n_b, 2 * n_a)):
            last = np.zeros(len(own), np.int64)
            last[cut - 1] = 1
            parts.append(own + last * size + base)
            # groups one after another, A's tokens before B's
            order.append(2 * (np.cumsum(last) - last) + (base > 0))
        words = np.concatenate(parts)[np.argsort(np.concatenate(order), kind="stable")]
        spelled, out = self.spelled[words].tolist(), []
        edges = np.concatenate([[0], np.cumsum(n[0] + n[1])]).tolist()
        for lo, hi in zip(edges[:-1], edges[1:]):
            out.append(b"".join(spelled[lo:hi])[:-1])
        return out


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, each as differences or plain numbers in its narrowest type."""
    out = [len(columns[0]).to_bytes(4, "little")]
    for c in columns:
        kind = np.min_scalar_type(int(c.max(initial=0)))
        out += [bytes([kind.itemsize]), c.astype(kind).tobytes()]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    while at < len(data):
        size = data[at]
        out.append(np.frombuffer(data, f"<u{size}", n, at + 1).astype(np.int64))
        at += 1 + n * size
    return out


def align(df: DataFrame, tokenizer_path: str, model_path: str, how: Alignment = Alignment(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents: (block, id, n_a, n_b, n_groups, n_links long, groups
    string, links binary), the links packed as (place of the pair in the block's list, number).
    Rows of pairs, in which id is null and at is not: (block, at long: place in the list, a, b int, n_docs long)."""
    small_batches(df.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        content = f.read(), g.read()
    shared = df.sparkSession.sparkContext.broadcast(content)  # size of the vocabularies
    key = f"align_{zlib.crc32(repr((content, how)).encode())}"
    id_type = df.schema[id_col].dataType
    kinds = {"block": pa.int64(), "id": to_arrow_type(id_type), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
             "n_links": pa.int64(), "groups": pa.string(), "links": pa.binary(), "at": pa.int64(), "a": pa.int32(),
             "b": pa.int32(), "n_docs": pa.int64()}

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, t) if columns.get(c) is None else pa.array(columns[c], t) for c, t in kinds.items()], names=list(kinds))

    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        aligner = per_worker(key, lambda: Aligner(*shared.value, how))
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for ids, texts in text_batches(batches, "id", "text", keep=True):
            held.append((ids, *aligner.align(texts)))
            size += sum(map(len, texts))
            if size >= how.block_bytes:
                yield from emit(block, held)
                block, held, size = block + 1, [], 0
        if held:
            yield from emit(block, held)

    def emit(block, held):
        # a pair as one number; the block's list is ascending
        numbers = [x.astype(np.int64) << 32 | y for *_, (_, x, y, _) in held]
        pairs, at, n_docs = np.unique(np.concatenate(numbers), return_inverse=True, return_counts=True)
        begin = 0
        for ids, n_a, n_b, n_groups, n_links, groups, (text, _, _, number) in held:
            own = at[begin:begin + len(text)]
            begin += len(text)
            edges = np.searchsorted(text, np.arange(len(ids) + 1)).tolist()
            # texts come in order, and so do a text's pairs
            links = [_pack(np.diff(own[lo:hi], prepend=0), number[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:])]
            yield rows(len(ids), block=[block] * len(ids), id=ids, n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links,
                       groups=[g.decode() for g in groups], links=links)
        for lo in range(0, len(pairs), 50_000):
            p = pairs[lo:lo + 50_000]
            yield rows(len(p), block=[block] * len(p), at=np.arange(lo, lo + len(p)), a=p >> 32, b=p & 0xFFFFFFFF,
                       n_docs=n_docs[lo:lo + 50_000])

    schema = (f"block long, id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups string, "
              "links binary, at long, a int, b int, n_docs long")
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def link_scores(aligned: DataFrame, stages: Stages) -> DataFrame:
    """The documents of `align`'s rows, which are written first: their columns
    but groups, links, block and the pairs', plus n_best (links whose count is the highest of their A id)
    and count_sum, where a pair's count is the number of documents that hold it linked.
    Columns added to those of `align` stay."""
    spark = aligned.sparkSession
    table = stages.put("aligned", aligned.drop("groups"))
    listed = table.where("at is not null").select("block", "at", "a", "b", "n_docs")
    # one exchange by pair; a pair has a row for each block
    counted = stages.put("counted", listed.withColumn("count", F.sum("n_docs").over(Window.partitionBy("a", "b")))
                         .select("block", "at", "a", "count"))
    most = counted.groupBy(F.col("a").alias("id_of_a")).agg(F.max("count").alias("most"))
    # a row for each id of A: bounded by its vocabulary
    scored = counted.join(F.broadcast(most), F.col("a") == F.col("id_of_a")).select(
        "block", "at", "count", (F.col("count") == F.col("most")).alias("best"))
    doc_columns = [c for c in table.columns if c not in ("block", "links", "at", "a", "b", "n_docs")]
    docs = table.where("at is null").select("block", F.struct(*doc_columns).alias("doc"), "links")
    doc_type = docs.schema["doc"].dataType
    both = (scored.select("block", "at", "count", "best", F.lit(None).cast(doc_type).alias("doc"), F.lit(None).cast("binary").alias("links"))
            .unionByName(docs.select("block", F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("count"),
                                     F.lit(None).cast("boolean").alias("best"), "doc", "links"))
            # the block's list by place, then its documents
            .repartition(partitions(spark), "block").sortWithinPartitions("block", F.col("at").asc_nulls_last()))

    def run(batches):
        block, count, best = None, [], []
        for batch in batches:
            blocks = np.asarray(batch.column("block"))
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if blocks[lo] != block:
                    block, count, best = blocks[lo], [], []
                part = batch.slice(lo, hi - lo)
                pairs = part.filter(part.column("at").is_valid())
                if pairs.num_rows:
                    count.append(np.asarray(pairs.column("count")))
                    best.append(pairs.column("best").to_numpy(zero_copy_only=False))
                own = part.filter(part.column("at").is_null())
                if own.num_rows:
                    if len(count) != 1:
                        count = [np.concatenate([np.zeros(0, np.int64), *count])]
                        best = [np.concatenate([np.zeros(0, bool), *best])]
                    n_best, total = [], []
                    for raw in own.column("links").to_pylist():
                        step, number = _unpack(raw)
                        at = np.cumsum(step)
                        n_best.append(int(number[best[0][at]].sum()))
                        total.append(int((number * count[0][at]).sum()))
                    yield pa.RecordBatch.from_arrays(
                        [own.column("doc"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=["doc", "n_best", "count_sum"])

    out = both.mapInArrow(run, f"doc {doc_type.simpleString()}, n_best long, count_sum long")
    return out.select("doc.*", "n_best", "count_sum")
