"""Exact dedup by an extendible-hash index on shared files.

The 64-bit key of a normalised text (A-Z in lower case, null as empty) is cut
into ranges by its leading bits. Starting from one range, every range whose
texts exceed ``bucket_bytes`` is split by one more bit; the directory doubles
whenever a range needs more bits than it has. It ends at ``cell_bits`` bits,
which bounds what the driver and each task hold of it. Each range has an owner
task. Map tasks fold their own copies first, so that a text with any number of
copies reaches its owner once per batch of a map task.

An owner takes its range in key order, chains entries with equal keys, and
tells them apart by comparing bytes. It alone extends the directory below its
range: a bucket with more than ``bucket_entries`` entries is split by one more
bit, as deep as the key has bits. As keys come in order, the lower half of a
split bucket is complete when a key of the upper half comes, so an owner holds
one bucket at a time. An entry stands for one text: its bucket (first key and
depth), key, place in the chain, digest, row that stays, size of the group. A
bucket lies in its owner's file. Rows read their owner from the directory, and
their entry in its range by key and digest.

Defined results: null and empty texts are equal to each other; the largest
doc_id of a group stays, null ids come last; of rows that agree in id and text
exactly one is kept; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import columns_of, lowered, per_batch, quoted, staged, text_of
from landfall.session import local_frame

ENTRY = "owner int, key long, text binary, top_id long, top_rows long, rows long"
INDEX = "owner int, start long, depth int, key long, place int, digest string, keep_id long, keep_rows long, group_size long"
_ALL = (1 << 64) - 1
_FOLD_BYTES = 32 << 20


def directory(cells: Iterable[tuple[int, int]], cell_bits: int, bucket_bytes: int) -> tuple[int, list[int]]:
    """Global depth, and for each prefix of that many bits its range's number, counted in key order.

    ``cells`` has the bytes under each prefix of ``cell_bits`` bits. A range
    that is still overfull at that depth is split further by its owner.
    """
    size = dict(cells)

    def weight(prefix: int, depth: int) -> int:
        width = cell_bits - depth
        if depth == cell_bits:
            return size.get(prefix, 0)
        return sum(size.get(c, 0) for c in range(prefix << width, (prefix + 1) << width))

    depth_of = {0: 0}  # by first slot of the directory
    depth, slots = 0, [0]
    overfull = [(0, 0)] if weight(0, 0) > bucket_bytes else []
    names = 1
    while overfull:
        prefix, local = overfull.pop()
        if local == cell_bits:
            continue
        if local == depth:
            slots = [s for s in slots for _ in range(2)]
            depth += 1
        width = depth - local - 1
        upper = (2 * prefix + 1) << width
        for i in range(upper, upper + (1 << width)):
            slots[i] = names
        depth_of[names] = local + 1
        names += 1
        overfull += [(p, local + 1) for p in (2 * prefix, 2 * prefix + 1) if weight(p, local + 1) > bucket_bytes]
    in_order = {name: n for n, name in enumerate(dict.fromkeys(slots))}
    return depth, [in_order[s] for s in slots]


class Buckets:
    """An owner's buckets, of entries that come in key order (keys as unsigned numbers)."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.held: list[tuple] = []  # entries of the open bucket, key first
        self.start, self.depth = 0, 0

    def open(self, start: int, depth: int) -> None:
        """A new range, of the keys that share the first ``depth`` bits of ``start``."""
        self.start, self.depth = start, depth

    def _upper(self) -> int:
        """The first key of the open bucket's upper half."""
        return self.start | 1 << 63 - self.depth

    def _shut(self, n: int) -> Iterator[tuple]:
        for entry in self.held[:n]:
            yield self.start, self.depth, entry
        del self.held[:n]

    def add(self, entry: tuple) -> Iterator[tuple]:
        """Takes one entry; gives (start, depth, entry) of the buckets that this completes."""
        while (entry[0] ^ self.start) >> 64 - self.depth:
            # The bucket is complete: the next one is the upper half of the deepest split whose lower half it ends.
            yield from self._shut(len(self.held))
            while self.start >> 64 - self.depth & 1:
                self.depth -= 1
                self.start &= ~(1 << 63 - self.depth)
            self.start |= 1 << 64 - self.depth
        self.held.append(entry)
        while len(self.held) > self.most and self.depth < 64:
            upper = self._upper()
            low = sum(e[0] < upper for e in self.held)
            self.depth += 1
            if low < len(self.held):
                yield from self._shut(low)
                self.start = upper

    def close(self) -> Iterator[tuple]:
        yield from self._shut(len(self.held))


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class _Group:
    """Copies of one text: the largest id, how many rows have it, all rows."""

    __slots__ = ("top_id", "top_rows", "rows")

    def __init__(self) -> None:
        self.top_id, self.top_rows, self.rows = None, 0, 0

    def add(self, top_id: int | None, top_rows: int, rows: int) -> None:
        top = _larger(self.top_id, top_id)
        self.top_rows = (self.top_rows if self.top_id == top else 0) + (top_rows if top_id == top else 0)
        self.top_id = top
        self.rows += rows


def _fold(depth: int, slots: list[int]):
    shift = 64 - depth

    def columns(groups: dict[tuple[int, bytes], _Group]) -> dict:
        return {
            "owner": [slots[(k & _ALL) >> shift] for k, _ in groups],
            "key": [k for k, _ in groups], "text": [t for _, t in groups],
            "top_id": [g.top_id for g in groups.values()], "top_rows": [g.top_rows for g in groups.values()],
            "rows": [g.rows for g in groups.values()],
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        groups: dict[tuple[int, bytes], _Group] = {}
        held = 0
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text")), strict=True):
                group = groups.get((key, text))
                if group is None:
                    group = groups[key, text] = _Group()
                    held += len(text)
                group.add(doc_id, 1, 1)
            if held > _FOLD_BYTES:
                yield columns(groups)
                groups, held = {}, 0
        if groups:
            yield columns(groups)

    return work


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def _own(depth: int, slots: list[int], most: int):
    """One entry for each different text of each chain, in its bucket; an owner's rows come in key order."""
    first, bits = [0] * (slots[-1] + 1), [depth] * (slots[-1] + 1)
    for slot, owner in reversed(list(enumerate(slots))):
        first[owner] = slot << 64 - depth
    for owner, slot_count in Counter(slots).items():
        bits[owner] = depth - slot_count.bit_length() + 1
    names = [c.split()[0] for c in INDEX.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, chain, buckets = None, {}, Buckets(most)
        out: list[tuple] = []

        def put(complete: Iterator[tuple]) -> None:
            out.extend((at[0], _signed(start), local, _signed(key), *rest) for start, local, (key, *rest) in complete)

        def end_chain() -> None:
            for place, (text, group) in enumerate(sorted(chain.items())):
                digest = hashlib.sha256(text).hexdigest()
                put(buckets.add((at[1], place, digest, group.top_id, group.top_rows, group.rows)))

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("owner", "key", "text", "top_id", "top_rows", "rows")), strict=True)
            for owner, key, text, top_id, top_rows, n in rows:
                key &= _ALL
                if at != (owner, key):
                    if at:
                        end_chain()
                    if not at or at[0] != owner:
                        put(buckets.close())
                        buckets.open(first[owner], bits[owner])
                    at, chain = (owner, key), {}
                chain.setdefault(text, _Group()).add(top_id, top_rows, n)  # equal only byte for byte
            if len(out) > 20_000:
                yield dict(zip(names, zip(*out, strict=True), strict=True))
                out.clear()
        if at:
            end_chain()
            put(buckets.close())
        if out:
            yield dict(zip(names, zip(*out, strict=True), strict=True))

    return work


def _slot(key: Column, depth: int) -> Column:
    """The key's place in the directory: its leading ``depth`` bits."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 8 << 20, cell_bits: int = 16,
    bucket_entries: int = 4096,
) -> tuple[DataFrame, DataFrame, int]:
    """Index of all different texts, directory (slot, owner) and its depth; both tables lie in the shared folder."""
    spark = docs.sparkSession
    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), lowered(text_of("text")).alias("text")
    )
    keyed = texts.select("doc_id", F.xxhash64("text").alias("key"), F.col("text").cast("binary").alias("text"))
    cell = F.shiftrightunsigned("key", 64 - cell_bits)
    cells = keyed.groupBy(cell.alias("cell")).agg(F.sum(F.octet_length("text")).alias("size")).collect()
    depth, slots = directory([(r.cell, r.size) for r in cells], cell_bits, bucket_bytes)
    places = staged(local_frame(spark, enumerate(slots), "slot long, owner int"), "directory")
    entries = per_batch(keyed.select("key", "doc_id", "text"), ENTRY, _fold(depth, slots))
    # With the first bit turned, the order of the keys is that of unsigned numbers.
    in_order = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    owned = entries.repartitionById(slots[-1] + 1, F.col("owner")).sortWithinPartitions("owner", in_order)
    return staged(per_batch(owned, INDEX, _own(depth, slots, bucket_entries)), "buckets"), places, depth


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 8 << 20, cell_bits: int = 16,
    bucket_entries: int = 4096,
) -> DataFrame:
    """Every row's verdict: doc_id, keep_id, group_size, kept, text_sha256."""
    index, places, depth = build_index(docs, id_col, text_col, bucket_bytes, cell_bits, bucket_entries)
    rows = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), lowered(text_of("text")).alias("text")
    ).select("doc_id", F.xxhash64("text").alias("key"), F.sha2("text", 256).alias("digest"))
    # 2^cell_bits slots at most go to every task.
    addressed = rows.withColumn("slot", _slot(F.col("key"), depth)).join(F.broadcast(places), "slot")
    found = addressed.join(index.select("owner", "key", "digest", "keep_id", "group_size"), ["owner", "key", "digest"])
    same = Window.partitionBy("digest", "doc_id").orderBy("key")
    is_top = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.repartition("digest", "doc_id").select(
        "doc_id", "keep_id", "group_size", (is_top & (F.row_number().over(same) == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select("doc_id", "text_sha256")
    whole = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"),
        F.col(quoted(id_col)).cast("long").alias("own_id"),
        F.sha2(lowered(text_of(text_col)), 256).alias("own_digest"),
    )
    stay = whole.join(
        kept, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("text_sha256")), "left_semi"
    )
    # Rows that agree in id and text are one document.
    same = Window.partitionBy("own_digest", "own_id").orderBy("own_id")
    return stay.withColumn("nth", F.row_number().over(same)).filter("nth = 1").select("row.*")
