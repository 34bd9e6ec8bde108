"""Substring dedup: suffix automata of reference shards, read by matching statistics.

A window is 13 consecutive words. Each window is dealt to the reference shard
that its smallest 4-word hash (its minimizer) names; consecutive windows with
the same minimizer travel as one segment, so equal windows of any documents
meet in one shard, and a fifth as many rows move as there are words. In a
shard, segments with the same words fold to their first document at once;
what remains is each different segment of that document, as often as it has it
(an earlier document may hold its windows in other surroundings). A shard that
holds a large share of all segments (a passage in a third of all documents) is
spread over many tasks by document first; each of them folds its part, and the
few that are left are folded together. Where a shard
has several, their words are fetched, a suffix automaton of the segments of
smaller documents is built, and every segment is streamed through it: at each
word the matching statistic tells the longest suffix the reference has, and a
window is marked where it reaches 13.

An automaton goes only to the task that reads its shard. All of them together
grow with the corpus, so they have no size bound under which they could be
broadcast to every task. Shards with more than ``hot_segments`` different
segments (a frequent passage in ever different surroundings) are cut once more,
by window, and folded by a grouped minimum: the exact way for those.

Words are compared by 64-bit hashes.

Defined results: null and blank texts have no words; texts under 13 words stay
whole; rows without an id stay whole and are no reference; a repeated row is
the same document and no reference for itself; ids name one text each; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import columns_of, per_batch, quoted, staged, text_of, with_row
from landfall.llm.words import mixed, spans_hash, word_hashes, word_spans

GRAM = 4
SEGMENT = "doc_id long, shard long, class long, start int, n int, spread int"
FOUND = "doc_id long, shard long, class long, start int, n int, spread int, marked boolean"
WORDS = "doc_id long, shard long, start int, n int, words binary, window binary"


def minimizers(words: np.ndarray, window: int) -> np.ndarray:
    """For each window of words the smallest hash of its 4-word grams."""
    grams = len(words) - GRAM + 1
    h = words[:grams].copy()
    for i in range(1, GRAM):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + grams]
    h = mixed(h)
    width, have = window - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        h = np.minimum(h[: len(h) - step], h[step:])
        have += step
    return h


def segments(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer: shard, class (of the words), first window, windows."""
    if len(words) < window:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    least = minimizers(words, window)
    starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    ends = np.append(starts[1:], len(least))
    return least[starts].view(np.int64), spans_hash(words, starts, ends + window - 1).view(np.int64), starts, ends - starts


def _cut(window: int, crowded: np.ndarray, tasks: int):
    """Segments of all texts; ``spread`` is the part of a crowded shard, else -1."""

    def columns(parts: list[tuple]) -> dict:
        doc, shard, kind, start, n = map(np.concatenate, zip(*parts, strict=True))
        part = (mixed(doc.view(np.uint64)) % np.uint64(tasks)).astype(np.int32)
        return _columns(SEGMENT, (doc, shard, kind, start, n, np.where(np.isin(shard, crowded), part, -1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            parts = []
            rows = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                shard, kind, start, n = segments(word_hashes(text.as_py()), window)
                parts.append((np.full(len(shard), doc_id, np.int64), shard, kind, start, n))
                rows += len(shard)
                if rows > 500_000:
                    yield columns(parts)
                    parts, rows = [], 0
            if parts:
                yield columns(parts)

    return work


def _columns(schema: str, columns) -> dict:
    return dict(zip((c.split()[0] for c in schema.split(", ")), columns, strict=True))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows come by shard, part, class, document, start: marks repeats of a class, passes on all rows of its first document.

    They are more than one where that document repeats the passage within
    itself: an earlier document may hold it in other surroundings, and each of
    them is marked then. Rows of a crowded shard's part are all passed on, as
    another part may have an earlier document. The only state is the last row,
    its class's first document, and the rows of its shard's first class (of
    one document), which wait for a second class.
    """
    fields = ("doc_id", "shard", "class", "start", "n", "spread")
    last = first_doc = None
    single, waiting = False, []
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in fields]
        doc, shard, kind, start, _, part = rows
        if not len(doc):
            continue
        new = [np.concatenate(([last is None or v[0] != last[i]], v[1:] != v[:-1])) for i, v in enumerate(rows)]
        new_shard = new[1] | new[5]
        new_class = new_shard | new[2]
        at = np.maximum.accumulate(np.where(new_class, np.arange(len(doc)), -1))
        first = np.where(at >= 0, doc[at], first_doc if first_doc is not None else 0)
        marked = doc > first
        # Rows equal in all are a document that is there twice.
        own = ~marked & (new_class | new[0] | new[3])
        later = new_class & ~new_shard
        run, classes = np.cumsum(new_shard), np.cumsum(later)  # run 0 goes on from the last batch
        base = np.concatenate(([0 if single else -1], classes[new_shard]))
        several = np.bincount(run, later, run[-1] + 1) > 0
        several[0] |= not single
        if several[0]:
            yield from waiting
        if several[0] or run[-1]:
            waiting = []
        out = marked | (part >= 0) | own & ((classes > base[run]) | several[run])
        if out.any():
            yield _columns(FOUND, (*(v[out] for v in rows), marked[out]))
        single = not several[run[-1]]
        held = own & ~out & (run == run[-1])
        if held.any():
            waiting.append(_columns(FOUND, (*(v[held] for v in rows), marked[held])))
        last, first_doc = [v[-1] for v in rows], first[-1]


def crowded_shards(known: DataFrame, window: int, sample: int, least: int) -> np.ndarray:
    """The shards that a task should not take alone: ten thousand at most, so the list may go to every task.

    Counted over every ``sample``-th document by hash. They only decide how rows
    are spread: a shard that is missed or taken in vain gives the same result,
    and one that is not on a full list has less than a ten-thousandth of the sample.
    """
    some = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    counts = per_batch(some, SEGMENT, _cut(window, np.zeros(0, np.int64), 1)).groupBy("shard").count()
    largest = counts.filter(F.col("count") >= least).orderBy(F.desc("count"), "shard").limit(10_000).collect()
    return np.array([r.shard for r in largest], np.int64)


def folded(known: DataFrame, window: int, sample: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Segments whose class starts in an earlier document, and those of each class's first document in shards with several classes."""
    tasks = max(64, int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = per_batch(known, SEGMENT, _cut(window, crowded_shards(known, window, sample, least), tasks))
    dealt = cut.repartition("shard", "spread").sortWithinPartitions("shard", "spread", "class", "doc_id", "start")
    found = staged(per_batch(dealt, FOUND, _fold), "segments")
    parts = found.filter("not marked and spread >= 0").select("doc_id", "shard", "class", "start", "n")
    first = parts.groupBy("shard", "class").agg(F.min("doc_id").alias("first_id"))
    parts = parts.join(first, ["shard", "class"])
    again = parts.filter("doc_id > first_id")
    once = parts.filter("doc_id = first_id").dropDuplicates(["shard", "class", "start"])
    place = ["doc_id", "shard", "start", "n"]
    return (
        found.filter("marked").select(place).unionByName(again.select(place)),
        found.filter("not marked and spread < 0").select(place).unionByName(once.select(place)),
    )


class SuffixAutomaton:
    """Of several word sequences; states are numbered, 0 is the empty one."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._step(last, w)

    def _step(self, last: int, w: int) -> int:
        if w in self.next[last]:
            known = self.next[last][w]
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        state = last
        while state >= 0 and w not in self.next[state]:
            self.next[state][w] = new
            state = self.link[state]
        if state >= 0:
            known = self.next[state][w]
            self.link[new] = known if self.length[known] == self.length[state] + 1 else self._split(state, w, known)
        return new

    def _split(self, state: int, w: int, known: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[known]))
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[known])
        self.link[known] = copy
        while state >= 0 and self.next[state].get(w) == known:
            self.next[state][w] = copy
            state = self.link[state]
        return copy

    def statistics(self, words: list[int]) -> Iterator[int]:
        """At each word the length of the longest suffix read so far that occurs."""
        state = matched = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                matched += 1
            yield matched


def _stream(window: int):
    """Rows come by shard, document, start; each document is matched before it joins the reference."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at = doc = None
        automaton, own = SuffixAutomaton(), {}
        out: list[tuple] = []
        for batch in batches:
            for doc_id, shard, start, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "start", "words")), strict=True):
                if shard != at:
                    at, automaton, own, doc = shard, SuffixAutomaton(), {}, doc_id
                elif doc_id != doc:
                    for again in own:
                        automaton.add(np.frombuffer(again, np.uint64).tolist())
                    own, doc = {}, doc_id
                if blob not in own:
                    words = np.frombuffer(blob, np.uint64).tolist() if len(automaton.next) > 1 else []
                    own[blob] = [i for i, matched in enumerate(automaton.statistics(words)) if matched >= window]
                out += [(doc_id, start + i - window + 1, 1) for i in own[blob]]
            if out:
                yield _columns("doc_id, start, n", zip(*out, strict=True))
                out = []

    return work


def _fetch(window: int):
    """The words of each wanted segment; of a hot shard's segments each window by itself."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc_id, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "wanted")), strict=True):
                words = word_hashes(text)
                for s in wanted:
                    start, n = s["start"], s["n"]
                    if s["hot"]:
                        out += [(doc_id, s["shard"], i, 1, None, words[i : i + window].tobytes()) for i in range(start, start + n)]
                    else:
                        out.append((doc_id, s["shard"], start, n, words[start : start + n + window - 1].tobytes(), None))
                    held += n + window
                if held > 1_000_000:
                    yield _columns(WORDS, zip(*out, strict=True))
                    out, held = [], 0
            if out:
                yield _columns(WORDS, zip(*out, strict=True))

    return work


def _remove(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            count, removed, digest, kept = [], [], [], []
            for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                begins, ends = word_spans(text)
                gone = np.zeros(len(begins) + 1, np.int64)
                for s in marks or ():
                    gone[min(s["start"], len(begins))] += 1
                    gone[min(s["start"] + s["n"] + window - 1, len(begins))] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                words = [text[a:b] for a, b in zip(begins[~gone].tolist(), ends[~gone].tolist(), strict=True)]
                count.append(len(begins))
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                kept.append(_without(text, begins, ends, gone))
            yield {"row": batch.column("row"), "n_words": count, "n_removed": removed, "kept_sha256": digest, "kept_text": kept}

    return work


def _without(text: bytes, begins: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> str:
    """The text less the removed words, each with the blanks before it."""
    if not gone.any():
        return text.decode()
    cuts = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(gone)]
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        if not gone[a]:
            out.append(text[(ends[a - 1] if a else 0) : ends[b - 1]])
    return b"".join(out).decode().lstrip(" ")


def substring_dedup(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", hot_segments: int = 2000,
    sample: int = 64, crowd: int = 32,
) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256, kept_text) for every row; ``row`` has its columns."""
    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    )
    known = texts.filter("doc_id is not null")
    earlier, single = folded(known, window, sample, crowd)
    hot = single.groupBy("shard").count().filter(F.col("count") > hot_segments).select("shard", F.lit(True).alias("hot"))
    wanted = single.join(hot, "shard", "left").groupBy("doc_id").agg(
        F.collect_list(F.struct("shard", "start", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted")
    )
    words = staged(per_batch(known.join(wanted, "doc_id"), WORDS, _fetch(window)), "words")
    read = words.filter("window is null").select("doc_id", "shard", "start", "words")
    matched = per_batch(
        read.repartition("shard").sortWithinPartitions("shard", "doc_id", "start"), "doc_id long, start int, n int", _stream(window)
    )
    alone = words.filter("window is not null").select("doc_id", "start", "n", "window")
    earliest = alone.groupBy("window").agg(F.min("doc_id").alias("first_id"))
    repeated = alone.join(earliest, "window").filter("first_id < doc_id").select("doc_id", "start", "n")
    marks = earlier.select("doc_id", "start", "n").unionByName(matched).unionByName(repeated)
    by_doc = marks.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    whole = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns if c != text_col)).alias("row"),
        F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"),
    )
    marked = whole.join(by_doc, "doc_id", "left").select("row", "text", "marks")
    schema = with_row(marked.schema["row"].dataType, "n_words long, n_removed long, kept_sha256 string, kept_text string")
    return per_batch(marked, schema, _remove(window))


def cut_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns; the text less its repeated windows, its length anew."""
    done = substring_dedup(docs, window, id_col, text_col)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text"))
    own = dict(docs.dtypes)
    return done.select(*(
        F.col("kept_text").alias(c) if c == text_col
        else F.when(text.isNotNull(), F.char_length(text).cast(own[c])).otherwise(F.col(f"row.{quoted(c)}")).alias(c) if c == length_col
        else F.col(f"row.{quoted(c)}").alias(c)
        for c in docs.columns
    ))
