"""SimHash near-dedup: a self-join of the binary trie of all fingerprints.

Fingerprints are made in map tasks and folded to different ones. The trie is
cut at a depth at which an even subtrie fits a task; each pair of subtries whose
prefixes differ in no more bits than allowed is one task. Pairs that hold more
(near copies crowd under one prefix) are split further down, with the bits that
their prefixes leave of the budget, until they fit. A task descends both
subtries together, adds up differing bits and drops a pair of nodes as soon as
the budget is exceeded. What it links it reports as a spanning star for each
group, never as all pairs; the stars are then joined to components.

Defined results: null and blank texts have fingerprint zero and link like any
other; null ids never name a component that has another id; repeated rows give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import columns_of, per_batch, quoted, ship, staged, text_of
from landfall.llm.components import components

SEED = 42
_CHUNK = 1 << 17


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit majority of the shingles' XXH64; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        begins = (ends - lengths)[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1:].tolist(), strict=True)]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], dtype=np.uint64).astype(">u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("text")),
                np.uint64, batch.num_rows,
            )
            yield {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}

    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    )
    return staged(per_batch(texts, "doc_id long, fp long", work), "fingerprints")


class Trie:
    """Levels of a binary trie over sorted different fingerprints, from ``depth`` bits down."""

    def __init__(self, prints: np.ndarray, depth: int) -> None:
        self.prints = prints
        self.first: list[np.ndarray] = []  # of each node its first leaf; one more at the end
        self.child: list[tuple[np.ndarray, np.ndarray]] = []  # of each node its children at the next level, or -1
        nodes = prints >> np.uint64(64 - depth) if depth else np.zeros(len(prints), np.uint64)
        last = None
        for level in range(depth, 65):
            if level > depth:
                nodes = prints >> np.uint64(64 - level)
            starts = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1]))) if len(nodes) else np.zeros(0, np.int64)
            if last is not None:
                bit = (nodes[starts] & np.uint64(1)).astype(bool)
                parent = np.searchsorted(last, starts, side="right") - 1
                zero, one = (np.full(len(last), -1, np.int32) for _ in range(2))
                zero[parent[~bit]] = np.flatnonzero(~bit)
                one[parent[bit]] = np.flatnonzero(bit)
                self.child.append((zero, one))
            self.first.append(np.append(starts, len(prints)).astype(np.int32))
            last = starts


def linked(left: np.ndarray, right: np.ndarray, depth: int, differing: int, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of leaf pairs within the budget, chunk by chunk.

    Both sides are sorted and different, and agree within themselves in
    ``depth`` leading bits; ``differing`` of those differ between the sides.
    """
    a = Trie(left, depth)
    b = a if same else Trie(right, depth)
    narrow = max(len(left), len(right)).bit_length()  # below this most nodes have one leaf
    stack = [(0, np.zeros(1, np.int32), np.zeros(1, np.int32), np.full(1, differing, np.int8))]
    while stack:
        level, x, y, spent = stack.pop()
        if len(x) > _CHUNK:
            half = len(x) // 2
            stack += [(level, x[:half], y[:half], spent[:half]), (level, x[half:], y[half:], spent[half:])]
            continue
        if depth + level >= min(narrow + depth, 64):
            wide = np.zeros(len(x), bool)
            sizes = (a.first[level][x + 1] - a.first[level][x]).astype(np.int64) * (b.first[level][y + 1] - b.first[level][y])
            if depth + level < 64:
                wide = sizes > 64
            yield from _leaves(a, b, level, x[~wide], y[~wide], sizes[~wide], budget, same)
            x, y, spent = x[wide], y[wide], spent[wide]
            if not len(x):
                continue
        below = []
        for p, own in enumerate(a.child[level]):
            for q, other in enumerate(b.child[level]):
                u, v = own[x], other[y]
                keep = (u >= 0) & (v >= 0)
                if p != q:
                    keep &= spent < budget
                if same:
                    keep &= u <= v
                below.append((u[keep], v[keep], spent[keep] + np.int8(p != q)))
        u, v, cost = map(np.concatenate, zip(*below, strict=True))
        if len(u):
            stack.append((level + 1, u, v, cost))


def _leaves(a: Trie, b: Trie, level: int, x, y, sizes, budget: int, same: bool):
    """Compares the few leaves below each pair of nodes, in bounded pieces."""
    at = 0
    while at < len(x):
        to = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), _CHUNK, side="right")) + at)
        own = np.repeat(np.arange(at, to), sizes[at:to])
        nth = np.arange(len(own)) - np.repeat(np.cumsum(sizes[at:to]) - sizes[at:to], sizes[at:to])
        width = (b.first[level][y + 1] - b.first[level][y])[own]
        i = a.first[level][x[own]] + nth // width
        j = b.first[level][y[own]] + nth % width
        near = np.bitwise_count(a.prints[i] ^ b.prints[j]) <= budget
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        at = to


class Groups:
    """Union by smallest label over positions; keeps no links."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            p, q = label[i], label[j]
            differ = p != q
            if not differ.any():
                break
            i, j, p, q = i[differ], j[differ], p[differ], q[differ]
            np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
            while (label[label] != label).any():
                label[:] = label[label]


def _pair_task(depth: int, budget: int):
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, high = key
        prints = np.sort(rows["fp"].to_numpy().astype(np.int64).view(np.uint64))
        head = prints >> np.uint64(64 - depth)
        left, right = prints[head == low], prints[head == high]
        if low == high:
            right = left
        everything = left if low == high else np.concatenate([left, right])
        groups = Groups(len(everything))
        shift = 0 if low == high else len(left)
        if len(left) and len(right):
            for i, j in linked(left, right, depth, int(low ^ high).bit_count(), budget, low == high):
                groups.join(i.astype(np.int64), j.astype(np.int64) + shift)
        moved = np.flatnonzero(groups.label != np.arange(len(everything)))
        return pd.DataFrame({
            "u": everything[moved].view(np.int64), "v": everything[groups.label[moved]].view(np.int64),
        })

    return work


def _flips(width: int, most: int) -> list[int]:
    """All numbers of ``width`` bits with ``most`` set ones at most."""
    return [sum(1 << b for b in bits) for k in range(min(most, width) + 1) for bits in combinations(range(width), k)]


def _any_of(flips: list[int]) -> Column:
    return F.explode(F.array(*(F.lit(f).cast("long") for f in flips))).alias("flip")


def _subtrie_pairs(nodes: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """(fp, low, high): each fingerprint in all pairs of its prefix with a near one."""
    head = F.shiftrightunsigned("fp", 64 - depth)
    near = F.col("own").bitwiseXOR(F.col("flip"))
    pairs = nodes.select("fp", head.alias("own"), _any_of(_flips(depth, max_bits)))
    return pairs.select("fp", F.least("own", near).alias("low"), F.greatest("own", near).alias("high"))


def _split_pairs(pairs: DataFrame, depth: int, more: int, max_bits: int) -> DataFrame:
    """The pairs of subtries ``more`` bits further down, as far as the budget goes."""
    base = F.lit(1 << more).cast("long")
    spent = F.bit_count(F.col("low").bitwiseXOR(F.col("high")))
    tail = F.shiftrightunsigned("fp", 64 - depth - more).bitwiseAND((1 << more) - 1)
    is_low = F.shiftrightunsigned("fp", 64 - depth) == F.col("low")
    down = pairs.select("fp", "low", "high", is_low.alias("is_low"), tail.alias("tail"), spent.alias("spent"), _any_of(_flips(more, max_bits)))
    down = down.filter(F.col("spent") + F.bit_count("flip") <= max_bits)
    near = F.col("tail").bitwiseXOR(F.col("flip"))
    low = F.col("low") * base + F.when(F.col("is_low"), F.col("tail")).otherwise(near)
    high = F.col("high") * base + F.when(F.col("is_low"), near).otherwise(F.col("tail"))
    return down.select("fp", F.least(low, high).alias("low"), F.greatest(low, high).alias("high"))


def link_stars(nodes: DataFrame, max_bits: int, leaves: int = 1 << 20, least_depth: int = 4) -> DataFrame:
    """Stars (u, v) that connect what any links of the different fingerprints ``fp`` connect.

    A task takes ``4 * leaves`` fingerprints at most (64 at least).
    """
    ship(nodes.sparkSession)
    count = nodes.count()
    depth, more = least_depth, 4
    while count >> depth > leaves:
        depth += 1
    pairs = _subtrie_pairs(nodes, depth, max_bits)
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(64, 4 * leaves)  # a pair at depth 60 has 32 at most
    stars = None
    while True:
        heavy = staged(pairs.groupBy("low", "high").count().filter(F.col("count") > most).select("low", "high"), "heavy-pairs")
        last = heavy.isEmpty()
        light = pairs if last else pairs.join(heavy, ["low", "high"], "left_anti")
        # A named number of tasks: rows are few bytes and much work, so partitions are not to be merged by their size.
        dealt = light.repartition(tasks, "low", "high")
        found = dealt.groupBy("low", "high").applyInPandas(_pair_task(depth, max_bits), "u long, v long")
        stars = found if stars is None else stars.unionByName(found)
        if last:
            return stars
        crowded = pairs.join(heavy, ["low", "high"], "left_semi")
        pairs = staged(_split_pairs(crowded, depth, more, max_bits), "split-pairs")
        depth += more


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; fp as a signed long."""
    rows = fingerprints(docs, id_col, text_col, shingle)
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(link_stars(nodes.select("fp"), max_bits))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group with all its columns: that with the smallest id.

    A row without an id can't be named by a group and stays.
    """
    found = simhash_groups(docs, shingle, max_bits, id_col, text_col)
    stay = found.filter("doc_id = component_id").select(F.col("component_id").alias("kept_id")).filter("kept_id is not null").distinct()
    whole = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), F.col(quoted(id_col)).cast("long").alias("own_id"),
        F.xxhash64(text_of(text_col)).alias("own_text"),
    )
    once = Window.partitionBy("own_id", "own_text").orderBy("own_id")
    found = whole.join(stay, F.col("own_id") == F.col("kept_id"), "left_semi").withColumn("nth", F.row_number().over(once))
    return found.filter("nth = 1").select("row.*").unionByName(whole.filter("own_id is null").select("row.*"))
