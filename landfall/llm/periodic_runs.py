"""Periodic runs of words by internal pattern matching, and texts with the runs collapsed.

A map over whole texts. The words of a batch of texts stand in one array, each
text closed by a sign of its own and its words numbered apart from every other
text's, so that nothing repeats across texts. Prefix doubling names the
substrings of each power-of-two length and gives the suffix array; a wavelet
tree over it answers range successor queries: the first occurrence of a pattern
at or after a position.

A run of period q, of at least ``least`` words and three periods, holds an
aligned (dyadic) block of 2**k words that occurs again q words on, where 2**k is
the power of two at or below q (8 at least, for ``least`` of 24). So each such
block asks for its occurrences that start in the next 2 * 2**k words:

* A block whose own smallest period is above a quarter of it has less than nine
  there. Their distances are candidate periods.
* Any other block of period p occurs in arithmetic progressions of difference p,
  one in each maximal stretch of period p; those overlap by less than p. p is a
  candidate, and so are the distances between the stretches' starts and between
  their ends: a run of a greater period maps a stretch in it to the next one, and
  cannot cut both ends of one off.

A candidate is extended both ways by comparing names; of equal intervals the
smallest period stays, for a multiple of a run's period extends to the run itself.

Defined results: null and blank texts have no words and no runs; rows without an
id are judged like any other (the query plants nothing in them); repeated rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, columns_of, per_batch, ship, text_of

RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, collapsed string"
)


class WaveletTree:
    """Range successor over an array of small numbers, by bits from the highest down."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []  # zeros before each place, level by level
        for bit in range(self.bits - 1, -1, -1):
            is_zero = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(is_zero))).astype(np.int32))
            values = np.concatenate([values[is_zero], values[~is_zero]])

    def _down(self, level: int, low: np.ndarray, high: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        zeros = self.zeros[level]
        a, b = zeros[low], zeros[high]
        return np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in places low to high - 1 are less than the bound."""
        out = np.zeros(len(low), np.int64)
        over = bound >> self.bits > 0
        whole = high - low
        for level in range(self.bits):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            zeros = self.zeros[level]
            out += np.where(one, zeros[high] - zeros[low], 0)
            low, high = self._down(level, low, high, one)
        return np.where(over, whole, out)

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of this rank, from 0, in places low to high - 1; the rank is less than their number."""
        out = np.zeros(len(low), np.int64)
        for level in range(self.bits):
            zeros = self.zeros[level]
            left = zeros[high] - zeros[low]
            one = rank >= left
            rank = np.where(one, rank - left, rank)
            out = out << 1 | one
            low, high = self._down(level, low, high, one)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least value at or above the bound in places low to high - 1; -1 where there is none."""
        rank = self.below(low, high, bound)
        some = rank < high - low
        out = np.full(len(low), -1, np.int64)
        out[some] = self.smallest(low[some], high[some], rank[some])
        return out


class Matcher:
    """Names of all substrings of power-of-two length, the suffix array, and queries on them.

    Two places have one name at a level if the same 2**level signs start there;
    the name is where their suffixes begin in the suffix array.
    """

    def __init__(self, signs: np.ndarray, levels: int) -> None:
        n = len(signs)
        order = np.argsort(signs, kind="stable")
        ranked = signs[order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        name = np.empty(n, np.int64)
        name[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        self.names, self.suffixes = [name], order
        for level in range(levels):
            name = self.names[-1]
            size = np.bincount(name, minlength=n)
            # Places with a name of their own keep it; a text's last sign is its own, so others end in their text.
            shared = np.flatnonzero(size[name] > 1)
            if not len(shared):
                break
            key = name[shared] * n + name[shared + (1 << level)]
            turn = np.argsort(key, kind="stable")
            shared, key = shared[turn], key[turn]
            old = name[shared]
            at = np.arange(len(shared))
            group = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), at, 0))
            part = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), at, 0))
            new = name.copy()
            new[shared] = old + part - group
            self.suffixes[old + at - group] = shared
            self.names.append(new)
        self.n = n

    def level(self, k: int) -> np.ndarray:
        """Names of 2**k signs; beyond the last level all names are their own."""
        return self.names[min(k, len(self.names) - 1)]

    def common(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many signs agree from places a and b on (step 1), or before them (step -1); a < b, in one text."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        top = len(self.names) - 1
        for k in range(top, -1, -1):
            todo = live
            while len(todo):
                # Substrings of 2**k signs from here, or ending here.
                shift = out[todo] if step > 0 else -out[todo] - (1 << k)
                x, y = a[todo] + shift, b[todo] + shift
                inside = (x >= 0) & (y < self.n)
                same = inside.copy()
                same[inside] = self.names[k][x[inside]] == self.names[k][y[inside]]
                todo = todo[same]
                out[todo] += 1 << k
                if k < top:  # once is enough below the top
                    break
        return out


def runs(texts: list[np.ndarray], least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """Of each text of word numbers all (start, length, period) of maximal periodic stretches.

    A stretch has ``least`` words and ``times`` periods at least; ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("runs of less than three periods need not hold an aligned block and its copy")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(texts) or lengths.max() < least:
        return found
    signs, begins = _joined(texts, lengths)
    # A block is as long as its run's period, or shorter; short periods have the block that least allows.
    lowest = max(0, (max(1, least // times)).bit_length() - 1)
    highest = max(lowest, int(lengths.max() // times).bit_length() - 1)
    matcher = Matcher(signs, highest)
    tree = None
    starts, ends, periods = [], [], []
    for k in range(lowest, highest + 1):
        names, size = matcher.level(k), 1 << k
        if len(matcher.names) <= k:
            break  # no substring of this length occurs twice
        blocks = np.arange(0, len(signs) - size + 1, size)
        count = np.bincount(names, minlength=len(signs))
        blocks = blocks[count[names[blocks]] > 1]
        if not len(blocks):
            continue
        tree = tree or WaveletTree(matcher.suffixes)
        query = _Query(matcher, tree, names, count)
        for place, period in _candidates(matcher, query, blocks, k):
            left, right = matcher.common(place, place + period, -1), matcher.common(place, place + period, 1)
            start, end = place - left, place + period + right
            good = end - start >= np.maximum(least, times * period)
            starts.append(start[good])
            ends.append(end[good])
            periods.append(period[good])
    if not starts:
        return found
    start, end, period = (np.concatenate(x) for x in (starts, ends, periods))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])))[: len(start)]
    text = np.searchsorted(begins, start, side="right") - 1
    for t, s, e, q in zip(text[first].tolist(), start[first].tolist(), end[first].tolist(), period[first].tolist(), strict=True):
        found[t].append((s - int(begins[t]), e - s, q))
    return found


def _joined(texts: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One array of all texts: word numbers apart by text, and after each text a sign of its own."""
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    most = max(int(t.max(initial=0)) for t in texts) + 2
    signs = np.empty(int((lengths + 1).sum()), np.int64)
    for i, t in enumerate(texts):
        signs[begins[i] : begins[i] + len(t)] = i * most + 1 + t
        signs[begins[i] + len(t)] = i * most
    return signs, begins


class _Query:
    """Occurrences of the patterns of one length."""

    def __init__(self, matcher: Matcher, tree: WaveletTree, names: np.ndarray, count: np.ndarray) -> None:
        self.tree, self.names, self.count = tree, names, count

    def next(self, pattern: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where the pattern that stands at a place next occurs, at or after the bound; -1 where it doesn't."""
        low = self.names[pattern]
        return self.tree.successor(low, low + self.count[low], bound)


def _candidates(matcher: Matcher, query: _Query, blocks: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) pairs to try, for the aligned blocks of 2**k signs."""
    size = 1 << k
    own = _own_period(matcher, query, blocks, k)
    plain, window = blocks[own == 0], 2 * size
    at = plain
    while len(plain):
        at = query.next(plain, at + 1)
        near = (at > 0) & (at < plain + window)
        plain, at = plain[near], at[near]
        if len(plain):
            yield plain, at - plain
    block, period = blocks[own > 0], own[own > 0]
    if not len(block):
        return
    yield block, period
    stretch = lambda x, p: (x - matcher.common(x, x + p, -1), x + p + matcher.common(x, x + p, 1))
    start, end = stretch(block, period)
    last = end
    while len(block):
        at = query.next(block, last - size + 1)
        near = (at > 0) & (at < block + window)
        block, period, start, end, at = block[near], period[near], start[near], end[near], at[near]
        if not len(block):
            return
        start_2, last = stretch(at, period)
        for gap in (start_2 - start, last - end):
            real = (gap > 0) & (gap < window)
            yield block[real], gap[real]


def _own_period(matcher: Matcher, query: _Query, blocks: np.ndarray, k: int) -> np.ndarray:
    """The smallest period of each block if it is a quarter of the block at most, else 0.

    The block's first half then occurs again one period on, and not before.
    """
    out = np.zeros(len(blocks), np.int64)
    if k < 2:
        return out
    half = matcher.level(k - 1)
    query = _Query(matcher, query.tree, half, np.bincount(half, minlength=matcher.n))
    at = query.next(blocks, blocks + 1)
    near = np.flatnonzero((at > 0) & (at <= blocks + (1 << k - 2)))
    period = at[near] - blocks[near]
    whole = matcher.common(blocks[near], at[near], 1) >= (1 << k) - period
    out[near[whole]] = period[whole]
    return out


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each place, by the query's contract."""
    at = np.arange(n)
    if doc_id is None or not n:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def as_it_stands(n: int, doc_id: int | None) -> np.ndarray:
    return np.arange(n)


def _greater(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Order of runs: the greater exponent first, then the smaller start and period."""
    if a[1] * b[2] != b[1] * a[2]:
        return -1 if a[1] * b[2] > b[1] * a[2] else 1
    return -1 if (a[0], a[2]) < (b[0], b[2]) else 1


def judged(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """The columns of RUNS but the first, of one text and its runs."""
    found = sorted(found, key=lambda r: (r[0], r[2]))
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    if found:
        stays = np.cumsum(change[:-1]) == 0
        words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
    best = sorted(found, key=cmp_to_key(_greater))[:1]
    start, length, period = best[0] if best else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    text = b" ".join(words)
    return (
        len(found), start, length, period, 1000 * length // period if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), text.decode(),
    )


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3,
    arranged: Callable[[int, int | None], np.ndarray] = as_it_stands,
) -> DataFrame:
    """RUNS' columns for every row: its runs, the one of the greatest exponent, and what is left without repeats.

    ``arranged`` says which word stands at each place, given their number and the row's id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows in by_size(batch, "text", 2 << 20):
                words = [t.split() for t in rows["text"]]
                order = [arranged(len(w), i) for w, i in zip(words, rows["doc_id"], strict=True)]
                words = [[w[i] for i in o.tolist()] for w, o in zip(words, order, strict=True)]
                found = runs([numbered(w) for w in words], least, times)
                done = [judged(w, f) for w, f in zip(words, found, strict=True)]
                names = [c.split()[0] for c in RUNS.split(", ")][1:]
                yield {"doc_id": rows["doc_id"]} | dict(zip(names, zip(*done, strict=True), strict=True))

    ship(docs.sparkSession)
    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    )
    return per_batch(texts, RUNS, work)
