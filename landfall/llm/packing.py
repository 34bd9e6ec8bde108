"""Best-fit packing of token sequences, improved by swap-based local search.

Map tasks tokenise whole documents, end each with one more id and cut what is
longer than a sequence. Full pieces are sequences of their own. The others are
dealt by a hash to groups of a set size; each group is packed best-fit
decreasing, then its underfull bins exchange pieces: one for one, two for one,
or one moves, always so that the sum of squared fills grows, until bins empty.
A group stops as soon as its free space is less than one sequence, for then no
bin can be saved.

Defined results: a null or empty text is one piece with the end id only; rows
without an id and repeated rows are packed like any other; an empty table gives
no pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, columns_of, per_batch, ship, staged, text_of
from landfall.llm.tokens import word_tokenizer

PIECE = "piece_key long, doc_id long, piece int, start long, length long, ids binary"
PLACE = "piece_key long, sequence_id long, offset long"


def pieces_of(docs: DataFrame, tokenizer: str, most: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of all documents, each with a key of its own and its ids."""
    end = int(end_id).to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = word_tokenizer(tokenizer).encode
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for rows in by_size(batch, "text", 4 << 20):
                out: list[tuple] = []
                for doc_id, ids in zip(rows["doc_id"], encode(rows["text"]), strict=True):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * most)):
                        part = ids[at : at + 4 * most]
                        out.append((key, doc_id, n, at // 4, len(part) // 4, part))
                        key += 1
                yield _columns(PIECE, out)

    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    )
    return staged(per_batch(texts, PIECE, work), "pieces", compression="zstd")


def _columns(schema: str, rows: list[tuple]) -> dict:
    return dict(zip((c.split()[0] for c in schema.split(", ")), zip(*rows, strict=True), strict=True))


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of positions: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = most, len(bins)
            bins.append([])
        bins[chosen].append(i)
        left = room - need
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins


class LocalSearch:
    """Exchanges between underfull bins; the emptiest gives, the roomiest fuller ones take.

    A giver hands over one piece or two, against nothing, one piece or two
    (two against two is not tried). A giver that cannot be emptied is skipped.
    ``takers``: how many bins of different contents a step looks at at most;
    ``patience``: how many givers in a row may fail before the search ends;
    ``work``: how many exchanges a group may weigh in all.
    """

    def __init__(
        self, lengths: list[int], bins: list[list[int]], most: int, takers: int = 1000, patience: int = 200, work: int = 2_000_000
    ) -> None:
        self.most, self.takers, self.patience, self.work = most, takers, patience, work
        self.full = [b for b in bins if sum(lengths[i] for i in b) == most]
        self.open = [sorted((lengths[i], i) for i in b) for b in bins if sum(lengths[i] for i in b) < most]
        self.fill = [sum(n for n, _ in b) for b in self.open]

    def run(self) -> list[list[int]]:
        """One giver after another; each exchange moves fill from an emptier to a fuller bin."""
        self.by_fill = sorted((f, b) for b, f in enumerate(self.fill))
        givers = [b for _, b in self.by_fill]
        free = sum(self.most - f for f in self.fill)
        failed = 0
        for giver in givers:
            if free < self.most or failed == self.patience or self.work <= 0:
                break
            while self.open[giver] and self.work > 0 and self._improve(giver):
                pass
            if self.open[giver]:
                failed += 1
            else:
                failed, free = 0, free - self.most
        return self.full + [[i for _, i in b] for b in self.open if b]

    def _improve(self, giver: int) -> bool:
        """The change that fills a fuller bin to the brim, or else by which one gains most, if there is any."""
        best = None
        first = bisect_left(self.by_fill, (self.fill[giver], -1))
        mine, offers, met = self.open[giver], [], set()
        for i in range(len(mine) - 1, -1, -1):
            # Pieces of one length are one offer; longer pieces first.
            for pieces in ((mine[i],), *((mine[i], mine[j]) for j in range(i))):
                lengths = tuple(n for n, _ in pieces)
                if lengths not in met:
                    met.add(lengths)
                    offers.append((sum(lengths), pieces))
        seen, looked = set(), 0
        for at in range(first, len(self.by_fill)):
            fill, taker = self.by_fill[at]
            items, room = self.open[taker], self.most - fill
            contents = tuple(n for n, _ in items)
            if taker == giver or not items or not room or contents in seen:
                continue
            seen.add(contents)
            looked += 1
            for given, pieces in offers:
                self.work -= 1
                for back in self._back(items, given, room):
                    if len(back) + len(pieces) > 3:
                        continue
                    gain = given - sum(n for n, _ in back)
                    if 0 < gain <= room and (best is None or (gain == room, gain) > best[:2]):
                        best = gain == room, gain, taker, pieces, back
            if best and best[0] or looked == self.takers:
                break
        if best is None:
            return False
        _, gain, taker, pieces, back = best
        for item in pieces:
            self.open[giver].remove(item)
            insort(self.open[taker], item)
        for item in back:
            self.open[taker].remove(item)
            insort(self.open[giver], item)
        for b, change in ((giver, -gain), (taker, gain)):
            self.by_fill.pop(bisect_left(self.by_fill, (self.fill[b], b)))
            self.fill[b] += change
            insort(self.by_fill, (self.fill[b], b))
        return True

    @staticmethod
    def _back(items: list[tuple[int, int]], given: int, room: int) -> Iterator[tuple]:
        """What the taker may hand back: nothing, one piece, or two; each as small as there is room for."""
        if given <= room:
            yield ()
            return
        least = given - room
        at = bisect_left(items, (least, -1))
        if at < len(items):
            yield (items[at],)
        high = len(items) - 1
        for low in range(len(items)):
            while high > low + 1 and items[low][0] + items[high - 1][0] >= least:
                high -= 1
            if high <= low:
                break
            if items[low][0] + items[high][0] >= least:
                yield (items[low], items[high])


def pack(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of positions."""
    bins = best_fit(lengths, most)
    if len(bins) * most - sum(lengths) < most:
        return bins
    return LocalSearch(lengths, bins, most).run()


def pack_documents(
    docs: DataFrame, tokenizer: str, most: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    group_tokens: int = 1 << 24,
) -> DataFrame:
    """Each piece with its ids and its place: PIECE's columns, sequence_id, offset."""
    pieces = pieces_of(docs, tokenizer, most, end_id, id_col, text_col)
    ship(docs.sparkSession)
    lengths = pieces.select("piece_key", "length")
    rest = lengths.filter(F.col("length") < most)
    groups = max(1, -(-(rest.agg(F.sum("length")).first()[0] or 0) // group_tokens))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece_key", ignore_index=True)
        sizes = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for n, members in enumerate(pack(sizes, most)):
            at = 0
            for i in members:
                sequence[i], offset[i] = key[0] << 32 | n, at
                at += sizes[i]
        return pd.DataFrame({"piece_key": rows["piece_key"], "sequence_id": sequence, "offset": offset})

    dealt = rest.withColumn("bin_group", F.pmod(F.xxhash64("piece_key"), F.lit(groups)) + 1)
    placed = dealt.groupBy("bin_group").applyInPandas(place, PLACE)
    # A full piece is a sequence by itself; those ids are negative.
    alone = pieces.filter(F.col("length") == most).withColumns({"sequence_id": -1 - F.col("piece_key"), "offset": F.lit(0).cast("long")})
    return pieces.filter(F.col("length") < most).join(placed, "piece_key").unionByName(alone)
