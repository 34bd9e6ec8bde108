"""LM scoring: a gated recurrent model trained on the corpus, and a unigram base.

Word counts of all training texts are aggregated by Spark. The ``model_words``
most frequent ones are the recurrent model's symbols; the ``head_words`` most
frequent go to every task as a table of that size. Copies of the model are
trained side by side by truncated backpropagation, and their parameters
averaged after each of ``rounds``; every training text takes part in one round
and in one copy, by hash, and is read once. Every whole text is then scored
in one pass, its state carried from the first word to the end. A word outside
the model's symbols has the probability of "another word" times its smoothed
share of all such words; counts beyond the head come by a join on the word, as
a table of all words has no size bound.

Defined results: null and blank texts consist of the end alone; rows without an
id are held out; repeated rows get equal scores; without training texts every
count is zero; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, columns_of, per_batch, ship, staged, text_of
from landfall.llm.gru import Gru

_MOST_COUNTS = 400_000
_BLOCK = 4096
READ = "row_key long, doc_id long, held_out boolean, n_words long, head_words long, head_log double, rest_words long, rest_log double, tail array<binary>, times array<long>, symbols binary"
MODELED = "row_key long, doc_id long, held_out boolean, n_words long, head_words long, head_log double, rest_words long, rest_log double, model_log double"


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of all training texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(text.as_py().lower().split())
                if len(counts) > _MOST_COUNTS:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts = Counter()
        yield {"word": list(counts), "n": list(counts.values())}

    parts = per_batch(texts.filter("not held_out").select("text"), "word binary, n long", work)
    return staged(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def most_frequent(words: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The ``most`` most frequent words; of equally frequent ones those that come first by hash.

    Counts of words by step of frequency, those of the step that overflows by
    frequency, and the words taken come to the driver.
    """
    step = F.floor(8 * F.log2("n"))
    whole, rest, border = F.lit(False), most, None
    for r in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if r["count"] > rest:
            border = r["step"]
            break
        whole, rest = step >= r["step"], rest - r["count"]
    taken = [(bytes(r["word"]), r["n"]) for r in words.filter(whole).collect()]
    if border is not None and rest:
        inside = words.filter(step == border)
        for r in inside.groupBy("n").count().orderBy(F.desc("n")).collect():
            same = inside.filter(F.col("n") == r["n"])
            rank = F.pmod(F.xxhash64("word"), F.lit(1 << 40))
            if r["count"] > rest:  # some more than are needed, as hashes are spread evenly
                same = same.filter(rank < int((1 << 40) * min(1.0, (1.1 * rest + 1000) / r["count"])))
            ranked = sorted((x["rank"], bytes(x["word"])) for x in same.select("word", rank.alias("rank")).collect())
            taken += [(word, r["n"]) for _, word in ranked[:rest]]
            rest -= min(rest, r["count"])
            if not rest:
                break
    return sorted(taken, key=lambda w: (-w[1], w[0]))


class Vocabulary:
    """The head's words and counts, and what the whole corpus amounts to."""

    def __init__(self, head: list[tuple[bytes, int]], model_words: int, words: int, tokens: int, texts: int) -> None:
        self.model_words = min(model_words, len(head))
        self.place = {w: i for i, (w, _) in enumerate(head)}
        counts = np.array([n for _, n in head], np.float64)
        self.head_log = np.log10(counts + 0.1)
        self.texts = texts
        self.distinct = words + (texts > 0)
        self.total = tokens + texts
        self.norm = np.log10(self.total + 0.1 * (self.distinct + 1))
        in_model = int(counts[: self.model_words].sum())
        self.symbol_counts = np.concatenate([counts[: self.model_words], [tokens - in_model, texts]])
        self.kind = np.dtype("<u2" if self.model_words + 2 <= 1 << 16 else "<u4")
        self.rest_norm = np.log10(tokens - in_model + 0.1 * (words - self.model_words + 1))

    def places(self, text: bytes) -> tuple[list[bytes], np.ndarray]:
        words = text.lower().split()
        return words, np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))

    def symbols(self, places: np.ndarray) -> np.ndarray:
        """The text's symbols, the end included."""
        known = (places >= 0) & (places < self.model_words)
        return np.append(np.where(known, places, self.model_words), self.model_words + 1).astype(np.int32)


def train(read: DataFrame, vocabulary: Vocabulary, rounds: int, replica_tokens: int, most_copies: int, piece: int) -> Gru:
    """The average of copies trained on their parts of all training texts, round by round.

    A text goes to a round and a copy by hash of its id and symbols, and a copy
    reads its texts in order of id, so that the model does not depend on how
    the rows lie. Each text is read once, in pieces of ``piece`` symbols;
    rows equal in id and symbols are read as one.
    """
    counts, kind = vocabulary.symbol_counts, vocabulary.kind  # all that a task needs of the vocabulary
    model = Gru(counts)
    copies = max(1, min(most_copies, vocabulary.total // (rounds * replica_tokens)))
    mark = F.xxhash64("doc_id", "symbols")
    dealt = read.filter("not held_out").withColumns({
        "turn": F.pmod(mark, F.lit(rounds)), "copy": F.pmod(F.shiftright(mark, 20), F.lit(copies)).cast("int"),
    })
    for turn in range(rounds):
        start = model.pack()

        def work(batches: Iterator[pa.RecordBatch], start: np.ndarray = start) -> Iterator[dict]:
            copy, own, held, size, learned, last = None, None, [], 0, 0, None

            def packed() -> dict:
                flat = own.pack()
                blocks = [flat[i : i + _BLOCK].tobytes() for i in range(0, len(flat), _BLOCK)]
                return {"block": range(len(blocks)), "copy": [copy] * len(blocks), "weight": [learned] * len(blocks), "part": blocks}

            for batch in batches:
                for rows in by_size(batch, "symbols", 4 << 20):
                    for mine, row, text in zip(rows["copy"], rows["doc_id"], rows["symbols"], strict=True):
                        if mine != copy:
                            if copy is not None:
                                own.train(np.concatenate(held))
                                learned += size
                                yield packed()
                            copy, own, held, size, learned, last = mine, Gru(counts), [], 0, 0, None
                            own.unpack(start)
                        if (row, text) == last:
                            continue
                        last = row, text
                        held.append(np.frombuffer(text, kind).astype(np.int32))
                        size += len(held[-1])
                        if size >= piece:
                            own.train(np.concatenate(held))
                            held, size, learned = [np.zeros(0, np.int32)], 0, learned + size
            if copy is not None:
                own.train(np.concatenate(held))
                learned += size
                yield packed()

        def average(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("copy")
            parts = np.stack([np.frombuffer(p, np.float32) for p in rows["part"]])
            mean = np.average(parts.astype(np.float64), axis=0, weights=rows["weight"])
            return pd.DataFrame({"block": [key[0]], "part": [mean.astype(np.float32).tobytes()]})

        mine = dealt.filter(F.col("turn") == turn).repartition(copies, "copy").sortWithinPartitions("copy", "doc_id", "symbols")
        parts = per_batch(mine.select("copy", "doc_id", "symbols"), "block int, copy int, weight long, part binary", work)
        means = parts.groupBy("block").applyInPandas(average, "block int, part binary").collect()  # one model's size
        if means:
            model.unpack(np.frombuffer(b"".join(r.part for r in sorted(means, key=lambda r: r.block)), np.float32))
    return model


def _read(vocabulary: Vocabulary):
    """Of each text its model symbols, and what the unigram base needs of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for rows in by_size(batch, "text", 12 << 20):
                out = {c.split()[0]: [] for c in READ.split(", ")}
                for text in rows["text"]:
                    words, places = vocabulary.places(text)
                    head = places[places >= 0]
                    middle = head[head >= vocabulary.model_words]
                    tail = Counter(words[i] for i in np.flatnonzero(places < 0).tolist())
                    out["symbols"].append(vocabulary.symbols(places).astype(vocabulary.kind).tobytes())
                    out["row_key"].append(key)
                    key += 1
                    out["n_words"].append(len(words))
                    out["head_words"].append(len(head))
                    out["head_log"].append(float(vocabulary.head_log[head].sum()))
                    out["rest_words"].append(len(middle) + len(words) - len(head))
                    out["rest_log"].append(float(vocabulary.head_log[middle].sum()))
                    out["tail"].append(list(tail))
                    out["times"].append(list(tail.values()))
                yield out | {"doc_id": rows["doc_id"], "held_out": rows["held_out"]}

    return work


def _score(kind: np.dtype, model: Gru):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kept = [c.split()[0] for c in MODELED.split(", ")[:-1]]
        for batch in batches:
            # Many texts advance together, so that the ends of the longest cost little.
            for rows in by_size(batch, "symbols", 32 << 20):
                symbols = [np.frombuffer(s, kind).astype(np.int32) for s in rows["symbols"]]
                yield {c: rows[c] for c in kept} | {"model_log": (model.score(symbols) / np.log(10)).tolist()}

    return work


def lm_scoring(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_words: int = 4096, head_words: int = 65536,
    rounds: int = 2, replica_tokens: int = 1_000_000, most_copies: int = 2048, piece: int = 1 << 20,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``replica_tokens`` is what a copy of the model learns from in a round, until
    there are ``most_copies``; beyond that each copy learns from more.
    """
    ship(docs.sparkSession)
    texts = columns_of(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")
    ).withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True)))
    words = count_words(texts)
    amounts = words.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    n_texts = texts.filter("not held_out").count()
    vocabulary = Vocabulary(most_frequent(words, head_words), model_words, amounts.words, amounts.tokens or 0, n_texts)
    read = staged(per_batch(texts, READ, _read(vocabulary)), "lm-symbols", compression="zstd")
    model = train(read, vocabulary, rounds, replica_tokens, most_copies, piece)
    scored = per_batch(read.drop("tail", "times"), MODELED, _score(vocabulary.kind, model))
    tail = read.select("row_key", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row_key", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
    counted = tail.join(words, "word", "left").groupBy("row_key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("tail_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
    )
    n_tokens = F.col("n_words") + 1
    tail_log, tail_known = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("tail_known", F.lit(0).cast("long"))
    end_log = float(np.log10(n_texts + 0.1))
    return scored.join(counted, "row_key", "left").select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("head_words") + tail_known + (1 if n_texts else 0)).alias("n_known"),
        F.lit(int(vocabulary.total)).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log + end_log - n_tokens * float(vocabulary.norm)).alias("base_score"),
        (F.col("model_log") + F.col("rest_log") + tail_log - F.col("rest_words") * float(vocabulary.rest_norm)).alias("score"),
    )
