"""Vector code compression: product codes by Lloyd's rounds over partition-local cover trees.

Vectors become integers and are cut into equal consecutive parts. Each task
builds, for blocks of rows, one cover tree a part over the block's different
part vectors: nodes of a level are more than its radius apart, every node lies
within its parent's. Nodes stand in depth-first order, so a subtree is a range,
and its count and component sums are a difference of cumulative sums. The trees
are written once to the shared folder; every round reads them.

A round gives a whole subtree to an entry when, by the triangle inequality, no
other entry can be as near to any point in it: the node's distance to another
entry exceeds that to the nearest by more than twice the subtree's radius. An
ambiguous node settles its own point by exact comparison, and its children go on
with the entries that are still possible. Integer squared distances are exact;
square roots only decide what may be skipped, with room for rounding.

Only codebooks, of a size set by the parameters, go through the driver. Sums
are added up in each task first: it sends one row for each entry and component.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped; so are rows of another length than the kept row with
the smallest id, or with a component beyond ``LARGEST`` after scaling, whose
squared distances would not fit a long. Rows without an id come last and repeated rows count each.
With fewer rows than entries the codebooks are shorter. An empty table gives no
rows. A length that the number of parts does not divide is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from landfall.llm.common import columns_of, per_batch, ship, staged

LARGEST = 1 << 24
_EXACT = 1 << 52
#: More labels than this are joined by shuffle; fewer fit in every task.
_FEW_LABELS = 100_000


@dataclass
class CoverTree:
    """Different points in depth-first order, with what is needed to skip subtrees."""

    points: np.ndarray  # n x d
    times: np.ndarray  # how often each point occurs
    parent: np.ndarray  # position of the parent; -1 for the root
    end: np.ndarray  # where the subtree ends
    radius: np.ndarray  # squared distance to the farthest point of the subtree

    @staticmethod
    def build(points: np.ndarray, times: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree of different points, and the position of each point in it."""
        n = len(points)
        apart = squared(points, points)
        parent, near, owner = np.full(n, -1), apart[0].copy(), np.zeros(n, np.int64)
        level = float(near.max())
        while near.any():
            level /= 4  # half of the radius
            above = owner.copy()
            while True:
                # The first point that no center of this level covers becomes one.
                open_ = near > level
                at = int(open_.argmax())
                if not open_[at]:
                    break
                parent[at] = above[at]
                closer = apart[at] < near
                near[closer] = apart[at][closer]
                owner[closer] = at
        return CoverTree._in_order(points, times, parent, apart)

    @staticmethod
    def _in_order(points: np.ndarray, times: np.ndarray, parent: np.ndarray, apart: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        n = len(points)
        children: list[list[int]] = [[] for _ in range(n)]
        for child, above in enumerate(parent.tolist()):
            if above >= 0:
                children[above].append(child)
        order, todo = [], [0]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(reversed(children[node]))
        order = np.array(order)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        above = np.where(parent[order] >= 0, place[parent[order]], -1)
        end = np.arange(1, n + 1)
        for i in range(n - 1, 0, -1):  # children stand after their parents
            end[above[i]] = max(end[above[i]], end[i])
        radius = np.zeros(n)
        for i in np.flatnonzero(end - np.arange(n) > 1).tolist():
            radius[i] = apart[order[i], order[i : end[i]]].max()
        return CoverTree(points[order], times[order], above, end, radius), place

    def pack(self) -> dict[str, bytes]:
        return {
            "points": self.points.astype(np.int32).tobytes(), "times": self.times.astype(np.int32).tobytes(),
            "parent": self.parent.astype(np.int32).tobytes(), "end": self.end.astype(np.int32).tobytes(),
            "radius": self.radius.astype(np.float64).tobytes(),
        }

    @staticmethod
    def unpack(held: dict[str, bytes], width: int) -> CoverTree:
        number = lambda k, t=np.int32: np.frombuffer(held[k], t)
        return CoverTree(
            number("points").reshape(-1, width).astype(np.int64), number("times").astype(np.int64),
            number("parent").astype(np.int64), number("end").astype(np.int64), number("radius", np.float64),
        )

    def assign(self, entries: np.ndarray) -> Assignment:
        """The nearest entry of every point, the first of equals, by whole subtrees where possible."""
        _, first = np.unique(entries, axis=0, return_index=True)
        first.sort()  # an entry equal to an earlier one is never the answer
        entries = entries[first]
        n = len(self.points)
        by_parent = np.argsort(self.parent[1:], kind="stable") + 1
        bounds = np.searchsorted(self.parent[1:][by_parent - 1], np.arange(n + 1))
        nodes, possible = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        whole, alone, compared = [], [], 0
        while len(nodes):
            compared += len(nodes)
            away = np.where(possible, squared(self.points[nodes], entries), np.inf)
            best = away.argmin(axis=1)
            roots, reach = np.sqrt(away), 2 * np.sqrt(self.radius[nodes])
            limit = roots[np.arange(len(nodes)), best] + reach
            possible = roots <= (limit * (1 + 1e-9) + 1e-6)[:, None]
            settled = (possible.sum(axis=1) == 1) | (self.end[nodes] == nodes + 1)
            whole.append((nodes[settled], best[settled]))
            alone.append((nodes[~settled], best[~settled]))
            open_ = nodes[~settled]
            count = bounds[open_ + 1] - bounds[open_]
            nodes = by_parent[_ranges(bounds[open_], count)]
            possible = np.repeat(possible[~settled], count, axis=0)
        gather = lambda found: tuple(np.concatenate(x) for x in zip(*found, strict=True))
        (nodes, best), (own, nearest) = gather(whole), gather(alone)
        return Assignment(self, nodes, first[best], own, first[nearest], compared)


@dataclass
class Assignment:
    """Subtrees that went to an entry as a whole, and single points of ambiguous nodes."""

    tree: CoverTree
    nodes: np.ndarray
    entry_of_node: np.ndarray
    alone: np.ndarray
    entry_of_point: np.ndarray
    compared: int

    def sums(self, entries: int) -> np.ndarray:
        """For each entry its count and its points' component sums, by cumulative sums."""
        tree = self.tree
        counted = np.column_stack([tree.times, tree.points * tree.times[:, None]])
        upto = np.concatenate([np.zeros((1, counted.shape[1]), np.int64), np.cumsum(counted, axis=0)])
        out = np.zeros((entries, counted.shape[1]), np.int64)
        np.add.at(out, self.entry_of_node, upto[tree.end[self.nodes]] - upto[self.nodes])
        np.add.at(out, self.entry_of_point, counted[self.alone])
        return out

    def codes(self) -> np.ndarray:
        """The entry of every point."""
        out = np.empty(len(self.tree.points), np.int64)
        count = self.tree.end[self.nodes] - self.nodes
        out[_ranges(self.nodes, count)] = np.repeat(self.entry_of_node, count)
        out[self.alone] = self.entry_of_point
        return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that start and count so, one range after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points; as floats where those are exact."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4 * most * most * a.shape[1] < _EXACT:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    out = np.zeros((len(a), len(b)), np.int64)
    for x, y in zip(a.T, b.T, strict=True):
        out += (x[:, None] - y[None, :]) ** 2
    return out


_TREE = "struct<points: binary, times: binary, parent: binary, end: binary, radius: binary, place: binary>"


def _plant(parts: int, block: int):
    """Blocks of rows: their ids, labels, and one tree a part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                piece = batch.slice(at, block)
                vectors = np.array(piece.column("vector").flatten(), np.int64).reshape(piece.num_rows, -1)
                trees = []
                for part in np.split(vectors, parts, axis=1):
                    points, owner, times = np.unique(part, axis=0, return_inverse=True, return_counts=True)
                    tree, place = CoverTree.build(points, times)
                    trees.append(tree.pack() | {"place": place[owner.ravel()].astype(np.int32).tobytes()})
                yield {"ids": [piece.column("vec_id").to_pylist()], "labels": [piece.column("label").to_pylist()], "trees": [trees]}

    return work


def _lloyd_sums(codebooks: list[np.ndarray]):
    """Counts and component sums of each entry over all blocks of a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = [np.zeros((len(c), c.shape[1] + 1), np.int64) for c in codebooks]
        for batch in batches:
            for trees in batch.column("trees"):
                for part, held in enumerate(trees.as_py()):
                    tree = CoverTree.unpack(held, codebooks[part].shape[1])
                    total[part] += tree.assign(codebooks[part]).sums(len(codebooks[part]))
        for part, sums in enumerate(total):
            used = np.flatnonzero(sums[:, 0])
            if len(used):
                entry, place = np.repeat(used, sums.shape[1]), np.tile(np.arange(sums.shape[1]), len(used))
                yield {"part": np.full(len(entry), part), "entry": entry, "place": place, "amount": sums[used].ravel()}

    return work


def _encode(codebooks: list[np.ndarray]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, error = [], np.zeros(len(row["ids"]), np.int64)
                for part, held in enumerate(row["trees"]):
                    tree = CoverTree.unpack(held, codebooks[part].shape[1])
                    code = tree.assign(codebooks[part]).codes()
                    off = ((tree.points - codebooks[part][code]) ** 2).sum(axis=1)
                    place = np.frombuffer(held["place"], np.int32)
                    codes.append(code[place])
                    error += off[place]
                text = np.column_stack(codes).astype(">u2" if max(map(len, codebooks)) > 256 else np.uint8)
                yield {"vec_id": row["ids"], "label": row["labels"], "code": [t.tobytes().hex() for t in text], "error": error}

    return work


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, vector, label) of rows with whole finite vectors; components as floors of their scaled values."""
    value = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    # NaN is greater than any number, so the bounds leave it out as well.
    fits = lambda x: F.coalesce(F.abs(x.cast("double")) * float(scale) < float(LARGEST), F.lit(False))
    rows = columns_of(vectors, vec_id=id_col, vector=vector_col, label=label_col)
    whole = F.coalesce(F.forall("vector", fits) & (F.size("vector") > 0), F.lit(False))
    return rows.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("vector", value).alias("vector"), "label")


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block: int = 1024,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row."""
    if entries > 65_536:
        raise ValueError("a code has two bytes at most")
    ship(vectors.sparkSession)
    whole = integer_vectors(vectors, id_col, vector_col, label_col, scale)
    # One length only: that of the row with the smallest id.
    head = whole.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").first()
    width = len(head["vector"]) if head else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    rows = whole.filter(F.size("vector") == width)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()  # one codebook's size
    start = np.array([r["vector"] for r in first], np.int64).reshape(len(first), width)
    codebooks = [np.ascontiguousarray(c) for c in np.split(start, parts, axis=1)]
    kind = whole.schema["label"].dataType
    blocks = StructType.fromDDL(f"ids array<bigint>, labels array<{kind.simpleString()}>, trees array<{_TREE}>")
    planted = staged(per_batch(rows, blocks, _plant(parts, block)), "cover-trees")
    for _ in range(rounds if len(first) else 0):
        sums = per_batch(planted.select("trees"), "part int, entry int, place int, amount long", _lloyd_sums(codebooks))
        # One number for each component of the codebooks.
        found = sums.groupBy("part", "entry", "place").agg(F.sum("amount").alias("amount")).toPandas()
        for part, book in enumerate(codebooks):
            mine = found[found["part"] == part]
            table = np.zeros((len(book), book.shape[1] + 1), np.int64)
            table[mine["entry"], mine["place"]] = mine["amount"]
            used = table[:, 0] > 0
            book[used] = table[used, 1:] // table[used, :1]
    schema = StructType([
        StructField("vec_id", LongType()), StructField("label", kind), *StructType.fromDDL("code string, error long")
    ])
    done = staged(per_batch(planted, schema, _encode(codebooks)), "vector-codes")
    return _with_label_error(done).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


def _with_label_error(done: DataFrame) -> DataFrame:
    """Adds the sum of errors over equal labels.

    A few labels go to every task. Of many, those with more than a share of all
    rows are few, so they go to every task too, and only the others are shuffled.
    """
    totals = staged(done.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    totals = totals.withColumnRenamed("label", "of_label")
    same = F.col("label").eqNullSafe(F.col("of_label"))
    amount = totals.agg(F.count("*").alias("labels"), F.sum("n").alias("rows")).first()
    if amount["labels"] <= _FEW_LABELS:
        return done.join(F.broadcast(totals.drop("n")), same)
    many = F.col("n") > amount["rows"] / _FEW_LABELS
    hot, cold = totals.filter(many).drop("n"), totals.filter(~many).drop("n")
    of_hot = done.join(F.broadcast(hot), same)
    rest = done.join(F.broadcast(hot), same, "left_anti")
    return of_hot.unionByName(rest.join(cold, same))
