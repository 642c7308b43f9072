"""Suffix arrays by induced sorting, in numpy, and permuted common prefixes.

The text is a sequence of small numbers ended by a single 0.  Suffixes are
classified (S: smaller than the next suffix, L: larger); the leftmost S ones
(LMS) are sorted by their substrings, named, and the sequence of names is
sorted in turn; all other suffixes are then induced in one pass up and one
pass down the alphabet.  Each pass handles a bucket's suffixes together, so the
work is linear and loops only over the alphabet and over runs of equal symbols.

The sequence of names has a large alphabet, over which a loop in numpy would be
slow; when it exceeds ``SMALL_ALPHABET`` its suffixes are sorted by names of
doubled length, recursively, and only as deep as asked for: two names cover at
least four symbols.  Suffixes that agree beyond the depth are left in any order.
"""

from __future__ import annotations

import numpy as np

from popcorr.llm import textops as T

SMALL_ALPHABET = 512
_CODE = T.mix((np.arange(SMALL_ALPHABET, dtype=T.U64) + T.U64(77)) * T._GOLD)


def classify(text: np.ndarray) -> np.ndarray:
    """True for S suffixes (the last is S)."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    at = np.searchsorted(differs, np.arange(n - 1))
    out = np.ones(n, bool)
    known = at < len(differs)
    step = differs[np.minimum(at, max(len(differs) - 1, 0))] if len(differs) else np.zeros(n - 1, np.int64)
    out[:-1] = np.where(known, text[step] < text[np.minimum(step + 1, n - 1)], False) if len(differs) else False
    return out


def _deal(queues: list[list[np.ndarray]], symbols: np.ndarray, suffixes: np.ndarray) -> None:
    """Append suffixes to the queues of their first symbols, in order."""
    if not len(suffixes):
        return
    if len(queues) < 1 << 15:
        symbols = symbols.astype(np.int16)                     # sorted by radix
    order = np.argsort(symbols, kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for part, first in zip(np.split(suffixes, cuts), symbols[np.concatenate(([0], cuts))]):
        queues[first].append(part)


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array that sorted LMS suffixes induce (in stage one: LMS substrings in any order)."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    _deal(seeds, text[lms], lms)
    large: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    done: list[np.ndarray] = []

    def before(suffixes, want_small):
        prev = suffixes[suffixes > 0] - 1
        prev = prev[small[prev] == want_small]
        return prev, text[prev]

    for c in range(alphabet):                                  # upwards: L suffixes
        rounds, now = [], (np.concatenate(large[c]) if large[c] else _none())
        while len(now):
            rounds.append(now)
            prev, symbol = before(now, False)
            _deal(large, symbol[symbol > c], prev[symbol > c])
            now = prev[symbol == c]
        done.append(np.concatenate(rounds) if rounds else _none())
        if seeds[c]:
            prev, symbol = before(np.concatenate(seeds[c]), False)
            _deal(large, symbol, prev)
    falling: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    falling[0].append(np.array([len(text) - 1]))
    out: list[np.ndarray] = [_none()] * alphabet
    for c in range(alphabet - 1, -1, -1):                      # downwards: S suffixes, largest first
        rounds, now = [], (np.concatenate(falling[c]) if falling[c] else _none())
        while len(now):
            rounds.append(now)
            prev, symbol = before(now, True)
            _deal(falling, symbol[symbol < c], prev[symbol < c])
            now = prev[symbol == c]
        prev, symbol = before(done[c][::-1], True)
        _deal(falling, symbol, prev)
        out[c] = np.concatenate([done[c], np.concatenate(rounds)[::-1] if rounds else _none()])
    return np.concatenate(out)


def _by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of a sequence of names, right for the first ``depth`` of them."""
    order = np.argsort(names, kind="stable")
    new = np.concatenate(([True], names[order][1:] != names[order][:-1]))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.cumsum(new) - 1
    if depth <= 1 or new.all():
        return order
    # names of doubled length: a pair of ranks; beyond the end comes first
    return _pairs(rank, 1, depth)


def _pairs(rank: np.ndarray, covered: int, depth: int) -> np.ndarray:
    n = len(rank)
    after = np.zeros(n, np.int64)
    after[:n - covered] = rank[covered:] + 1
    both = rank * (n + 1) + after
    order = np.argsort(both, kind="stable")
    new = np.concatenate(([True], both[order][1:] != both[order][:-1]))
    if 2 * covered >= depth or new.all() or covered >= n:
        return order
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    return _pairs(rank, 2 * covered, depth)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (ended by a single 0) in order of their first ``depth`` symbols."""
    n, alphabet = len(text), int(text.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64)
    small = classify(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        place = np.full(n, -1, np.int64)
        place[lms] = np.arange(len(lms))
        rough = place[induce(text, small, lms, alphabet)]
        rough = rough[rough >= 0]                              # LMS suffixes by their substrings
        # a substring runs from one LMS suffix to the next, both ends included; equal ones have one name
        ends = np.append(lms[1:] + 1, n)
        sums = np.zeros(n + 1, T.U64)
        np.cumsum(_CODE[text] * T.powers(T._BASE, n), out=sums[1:])
        key = T.mix((sums[ends] - sums[lms]) * T.powers(T._BASE_INV, n)[lms] + (ends - lms).astype(T.U64))[rough]
        names = np.empty(len(lms), np.int64)
        names[rough] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        most = int(names.max())
        if most + 1 < len(lms):
            if most < SMALL_ALPHABET - 2 and len(lms) > SMALL_ALPHABET:
                order = suffix_array(np.append(names + 1, 0), depth)[1:]
            else:
                order = _by_doubling(names, -(-depth // 2) + 1)
            lms = lms[order]
        else:
            lms = lms[np.argsort(names)]
    return induce(text, small, lms, alphabet)


def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number, first byte lowest (len - 7 of them)."""
    if len(data) < 8:
        return np.zeros(0, T.U64)
    raw = np.ascontiguousarray(data)
    return np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)).astype(T.U64)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix of ``order``, at its place in text order: bytes it has in common with the one before it, up to ``most``.

    Suffixes must have ``most`` bytes.  Text order without a place in ``order`` has 0.
    """
    out = np.zeros(len(data), np.int32)
    if len(order) < 2:
        return out
    eight = words8(data)
    a, b = order[1:], order[:-1]
    live = np.arange(len(a))
    common = np.full(len(a), most, np.int32)
    for at in range(0, most, 8):
        at = min(at, most - 8)
        x = eight[a[live] + at] ^ eight[b[live] + at]
        stop = x != 0
        low = x[stop]
        low = low & (~low + T.U64(1))                          # lowest bit that differs
        common[live[stop]] = at + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
        live = live[~stop]
    out[a] = common
    return out
