"""Whole texts to id bytes through a bounded cache of pre-token encodings.

Merges never cross a pre-token, so a text's ids are its pre-tokens' ids one
after another.  The splitting pattern always starts a pre-token at a single space
between two characters that are not white space; it always makes a pre-token of
a single line feed between two such characters, and of a closing mark after an
ASCII letter or digit where a fragment ends.  Texts are cut at these places and
the fragments cached as a whole, by their bytes.  All fragments of a batch are
found and grouped at once in numpy; only distinct ones are looked up, and only
new ones meet the pattern and the tokenizer.  A text with any other white space
around a space takes the pattern over its whole length.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, filterfalse

import numpy as np
import regex

from corpusmill.llm.shingles import distinct_ranges

#: Pre-tokens that one library call takes, as its results are far larger than the ids.
CALL = 2000
#: Marks fragments that no space precedes.
HEAD = np.uint64(0xA24BAED4963EE407)
#: Longer fragments and pre-tokens (bytes, characters) are not kept from one call to the next.
LONG = 256


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


CLOSING = _bytes(*((ord(c), ord(c)) for c in ".,;:!?"))
ALNUM = _bytes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
GRAPH = _bytes((0x21, 0x7E))
#: First bytes of characters of two bytes none of which is white space, and of
#: longer ones of which none is.
LEAD_TWO = _bytes((0xC3, 0xDF))
LEAD = _bytes((0xC3, 0xE0), (0xE4, 0xF4))


def fragments_of(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bare, first) of the fragments of texts joined by spaces:
    bare ones have no space in front; `first` is where each text begins, given
    the texts' places."""
    n = len(data)
    space = data == 0x20
    feed = np.flatnonzero(data == 0x0A)
    feed = feed[(feed > 1) & (feed < n - 1)]
    before, after = data[feed - 1], data[feed + 1]
    feed = feed[(GRAPH[before] | ((before >= 0x80) & LEAD_TWO[data[feed - 2]])) & (GRAPH[after] | LEAD[after])]
    # a line feed is a fragment, and the next one begins behind it
    after_space = np.zeros(n + 2, dtype=bool)
    after_space[1:n + 1] = space
    starting = after_space[:n + 1].copy()
    starting[feed] = starting[feed + 1] = True
    starting[begin] = True
    starting[0] = True
    bare = ~after_space[:n + 1]
    bare[begin] = True
    starts = np.flatnonzero(starting)
    ends = np.append(starts[1:], n + 1)
    # a fragment ends before the space that follows it
    ends -= np.append(space, True)[np.minimum(ends - 1, n)]
    tail = np.flatnonzero((ends - starts > 1) & CLOSING[data[np.maximum(ends - 1, 0)]] & ALNUM[data[np.maximum(ends - 2, 0)]]) \
        if n else np.zeros(0, np.int64)
    more = np.ones(len(starts), dtype=np.int64)
    more[tail] = 2
    place = np.cumsum(more) - more
    flags = np.repeat(bare[starts], more)
    first = place[np.searchsorted(starts, begin)]
    starts, ends = np.repeat(starts, more), np.repeat(ends, more)
    mark = place[tail] + 1
    starts[mark] = ends[mark] - 1
    ends[mark - 1] -= 1
    flags[mark] = True
    return starts, ends, flags, first


class PretokenCoder:
    """`encode_many` maps distinct pre-tokens to their id bytes, `width` bytes
    an id; `encode_words` does so for words of letters, each behind the prefix
    it is given (a space or nothing)."""

    def __init__(self, pattern: str, encode_many: Callable[[list[str]], list[bytes]],
                 encode_words: Callable[[list[str], str], list[bytes]] | None = None, width: int = 4,
                 max_entries: int = 250_000):
        self.split = regex.compile(pattern).findall
        self.encode_many = encode_many
        self.encode_words = encode_words or (lambda words, prefix: encode_many([prefix + w for w in words]))
        self.kind = f"<u{width}"
        self.width = width
        self.max_entries = max_entries
        self.tokens: dict[str, bytes] = {}
        self.long: list[str | bytes] = []
        # with the space in front, in two generations: what was used since the last turn, and before; None: not a safe cut
        self.fragments: dict[bytes, bytes | None] = {}
        self.older: dict[bytes, bytes | None] = {}

    def _learn_tokens(self, pretokens) -> None:
        new = set(filterfalse(self.tokens.__contains__, pretokens))
        self.long += [p for p in new if len(p) > LONG]
        words = [p for p in new if p.isalpha()]
        others = list(new.difference(words))
        for part, encode in [(words[at:at + CALL], lambda p: self.encode_words(p, "")) for at in range(0, len(words), CALL)] + \
                [(others[at:at + CALL], self.encode_many) for at in range(0, len(others), CALL)]:
            self.tokens.update(zip(part, encode(part)))

    def _learn(self, new: dict[bytes, str]) -> None:
        """Encodes fragments behind a space."""
        words, other = {}, {}
        for h, f in new.items():
            if f.isalpha():
                words[h] = f
            elif not f or f[0].isspace() or f[-1].isspace():
                self.fragments[h] = None
            else:
                other[h] = self.split(" " + f)
        self._learn_tokens(chain.from_iterable(other.values()))
        for h, pre in other.items():
            self.fragments[h] = b"".join(map(self.tokens.__getitem__, pre))
        self._learn_words(words, " ")

    def _learn_words(self, words: dict[bytes, str], prefix: str) -> None:
        keys, texts = list(words), list(words.values())
        for at in range(0, len(keys), CALL):
            self.fragments.update(zip(keys[at:at + CALL], self.encode_words(texts[at:at + CALL], prefix)))

    def _learn_bare(self, new: dict[bytes, str]) -> None:
        """Encodes fragments without a space in front; whether white space at
        their ends is safe is for the caller to see."""
        words = {h: f for h, f in new.items() if f.isalpha()}
        cut = {h: self.split(f) for h, f in new.items() if h not in words}
        self._learn_tokens(chain.from_iterable(cut.values()))
        for h, pre in cut.items():
            self.fragments[h] = b"".join(map(self.tokens.__getitem__, pre))
        self._learn_words(words, "")

    def code(self, raw: list[bytes]) -> list[bytes]:
        """The id bytes of each text, given in UTF-8."""
        if not raw:
            return []
        try:
            return self._code(raw)
        finally:
            for kept in (self.tokens, self.fragments):
                for k in [k for k in self.long if k in kept]:
                    del kept[k]
            self.long = []

    def _code(self, raw: list[bytes]) -> list[bytes]:
        if len(self.tokens) > self.max_entries:
            self.tokens = {}
        if len(self.fragments) > self.max_entries:
            self.fragments, self.older = {}, self.fragments
        joined = b" ".join(raw)
        data = np.frombuffer(joined, np.uint8)
        begin = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
        starts, ends, bare, first = fragments_of(data, begin)
        where, inverse = distinct_ranges(data, starts, ends, np.where(bare, HEAD, np.uint64(0)))
        keys = [joined[lo:hi] if alone else b" " + joined[lo:hi]
                for lo, hi, alone in zip(starts[where].tolist(), ends[where].tolist(), bare[where].tolist())]
        self.long += [k for k in keys if len(k) > LONG]
        new, older = [], self.older
        for i, k in enumerate(keys):
            if k not in self.fragments:
                if k in older:
                    self.fragments[k] = older[k]
                else:
                    new.append(i)
        if new:
            fresh: tuple[dict[bytes, str], dict[bytes, str]] = ({}, {})
            at = where[new]
            for i, lo, hi, alone in zip(new, starts[at].tolist(), ends[at].tolist(), bare[at].tolist()):
                fresh[alone][keys[i]] = joined[lo:hi].decode("utf-8", "surrogatepass")
            self._learn(fresh[0])
            self._learn_bare(fresh[1])
        coded = list(map(self.fragments.__getitem__, keys))
        unsafe = np.array([c is None for c in coded], dtype=bool)[inverse]
        lengths = np.array([0 if c is None else len(c) // self.width for c in coded], dtype=np.int64)
        pool = np.frombuffer(b"".join(filter(None, coded)), self.kind)
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        n = lengths[inverse]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = pool[np.repeat(offsets[inverse] - total[:-1], n) + np.arange(total[-1])].tobytes()
        bounds = np.append(first, len(starts))
        out = [ids[lo:hi] for lo, hi in zip((total[bounds[:-1]] * self.width).tolist(), (total[bounds[1:]] * self.width).tolist())]
        # texts with a space that is no safe cut, inside or behind their first fragment
        bad = np.add.reduceat(unsafe, first)
        for i, r in enumerate(raw):
            at = r.find(b" ")
            if at >= 0 and (bad[i] or at == 0 or r[:at].decode("utf-8", "surrogatepass")[-1].isspace()):
                pre = self.split(r.decode("utf-8", "surrogatepass"))
                self._learn_tokens(pre)
                out[i] = b"".join(map(self.tokens.__getitem__, pre))
        return out
