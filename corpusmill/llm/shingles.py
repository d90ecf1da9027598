"""Word shingles as 64-bit hashes and their fast similarity sketches, for
whole batches of texts at once in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * GOLDEN + U(seed))


BYTE_VALUES = seeds(256, 11)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_powers = {"up": np.ones(1, dtype=U), "down": np.ones(1, dtype=U)}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64, kept for later calls."""
    for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
        if len(_powers[name]) < n:
            table = np.full(n, base, dtype=U)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
    """Whether n[i] bytes from a[i] on equal those from b[i] on, for every i."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    for at in range(0, 64, 8):
        if not len(n):
            return True
        shift = (64 - 8 * np.minimum(n - at, 8)).astype(U)
        if ((eight[a + at] ^ eight[b + at]) << shift).any():
            return False
        more = n > at + 8
        a, b, n = a[more], b[more], n[more]
    return all(np.array_equal(data[x:x + k], data[y:y + k]) for x, y, k in zip(a.tolist(), b.tolist(), n.tolist()))


def distinct_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray | None = None):
    """(where, inverse): a place of each distinct byte range among the given
    ones, and for each range the number of its equal.  Ranges of another `kind` differ.

    Sums of powers modulo 2^64 group them; as such sums can agree for
    different bytes, every range is compared with the one that stands for it,
    and where one differs the bytes themselves are the key."""
    n = ends - starts
    up, down = power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(BYTE_VALUES[data] * up[:len(data)], dtype=U)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + n.astype(U) * GOLDEN)
    kinds = np.zeros(len(n), U) if kind is None else kind.astype(U)
    _, where, inverse = np.unique(hashes ^ kinds, return_index=True, return_inverse=True)
    other = where[inverse]
    others = np.flatnonzero((other != np.arange(len(n))) & (n > 0))
    if np.array_equal(n, n[other]) and np.array_equal(kinds, kinds[other]) and _same_bytes(
            data, starts[others], starts[other[others]], n[others]):
        return where, inverse
    number: dict[tuple[int, bytes], int] = {}
    inverse = np.array([number.setdefault((k, data[lo:hi].tobytes()), len(number))
                        for k, lo, hi in zip(kinds.tolist(), starts.tolist(), ends.tolist())], np.int64)
    return np.unique(inverse, return_index=True)[1], inverse


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct shingles of text i, ascending, are
    hashes[offsets[i]:offsets[i + 1]].  A-Z are lower-cased; a text with fewer
    words than `width` has its whole sequence as its shingle, one without
    words has none."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    lengths = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    ends_of_texts = np.cumsum(lengths)
    word = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    where, inverse = distinct_ranges(data, starts, ends)
    all_bytes = data.tobytes()
    digests = [xxhash.xxh3_64_intdigest(all_bytes[lo:hi]) for lo, hi in zip(starts[where].tolist(), ends[where].tolist())]
    hashes = np.array(digests, U)[inverse]
    owner = np.searchsorted(ends_of_texts, starts, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n_words)])

    factors = seeds(width + 1, 23) | U(1)
    sums = np.zeros(max(len(hashes) - width + 1, 0), dtype=U)
    for k in range(width):
        # every word is mixed in anew, so that no sum of words stands for another
        sums = mix(sums + hashes[k:len(hashes) - width + 1 + k] * factors[k])
    out, sizes = [], np.zeros(len(texts) + 1, dtype=np.int64)
    for i, n in enumerate(n_words.tolist()):
        if n >= width:
            own = np.sort(sums[first[i]:first[i] + n - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = np.full(1, n, U) * factors[width]
            for k, h in enumerate(hashes[first[i]:first[i + 1]]):
                own = mix(own + h * factors[k])
        else:
            continue
        out.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, U)), np.cumsum(sizes)


def sketches(hashes: np.ndarray, offsets: np.ndarray, size: int = 128, seed: int = 42) -> np.ndarray:
    """Fast similarity sketches, [sets, size]; rows of empty sets stay at the largest value.

    Round i throws every element into a random coordinate, and from round
    `size` on all elements into coordinate i - size; a coordinate keeps the
    smallest hash of the first round that reaches it.  So each coordinate is
    filled after 2 * size rounds at the latest, mostly after a few, and the
    share of equal coordinates is as concentrated around the similarity as a
    sample without replacement."""
    n = len(offsets) - 1
    empty = U(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, size), empty)
    bits = U(64 - (size - 1).bit_length())
    owner = np.repeat(np.arange(n), np.diff(offsets))
    x = hashes
    round_seeds = seeds(2 * size, seed)
    for i in range(2 * size):
        if not len(x):
            break
        h = mix(x ^ round_seeds[i])
        column = (h >> bits).astype(np.int64) if i < size else i - size
        least = np.full(n * size, empty)
        np.minimum.at(least, owner * size + column, h)
        least = least.reshape(n, size)
        open_ = out == empty
        out[open_] = least[open_]
        wanting = (out == empty).any(axis=1)[owner]
        x, owner = x[wanting], owner[wanting]
    return out


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash for each run of `rows` coordinates, different between runs."""
    n, size = sketch.shape
    own = sketch.reshape(n, size // rows, rows)
    factors = seeds(rows, 31) | U(1)
    total = (mix(own) * factors).sum(axis=2, dtype=U)
    return mix(total + seeds(size // rows, 37))
