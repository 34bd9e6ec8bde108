"""Byte-level BPE by a tokenization automaton.

The automaton reads token labels; a state is "the last token was t". It starts
with the 256 byte labels, any of which may follow any other. Merge gadget k,
for a merge (a, b) -> c, takes the path a b out: after a the arc b is cut, and
an arc c is added wherever a b could be read. What gadgets leave after all
merges is the path of exactly one token sequence for each byte string, the one
that merging in rank order gives.

A cut is inherited: an arc t after s is gone if any gadget meets the two tokens
that face each other across their border while both are there. Token s shows
its right spine (itself, its right part, that one's right part, ...), t its
left spine; a part is there until the gadget that makes the next larger one.
On the left side of the border that gadget acts first, on the right side last,
as merges of one rank go from left to right.

A full table has billions of arcs; its entries are computed by that rule when
first read, and kept. Encoding follows arcs from left to right, the longest
label first, and steps back from a place without a way on; as one path at most
leads to each place, no place is entered twice. Decoding emits the labels of
the arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, columns_of, per_batch, text_of

_MOST_WORDS = 500_000
_MOST_ARCS = 2_000_000
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]) -> None:
        """``ids`` names the bytes' and the merged tokens' ids."""
        self.label: dict[int, bytes] = {i: t for t, i in ids.items()}
        self.gadget: dict[tuple[int, int], int] = {}
        self.spine_right: dict[int, list[tuple[int, int]]] = {}  # (part, gadget that ends it)
        self.spine_left: dict[int, list[tuple[int, int]]] = {}
        self.cut: dict[int, bool] = {}
        self.tokens: dict[bytes, int] = {}
        for b in range(256):
            i = ids[bytes([b])]
            self.tokens[bytes([b])] = i
            self.spine_right[i] = self.spine_left[i] = [(i, _NEVER)]
        for k, (left, right) in enumerate(merges):
            self._add_gadget(k, ids[left], ids[right], ids[left + right])
        # Each token by its bytes; what only begins one counts as -1.
        self.begun = {t[:n]: -1 for t in self.tokens for n in range(1, len(t))} | self.tokens

    def _add_gadget(self, k: int, a: int, b: int, c: int) -> None:
        if a not in self.spine_right or b not in self.spine_right:
            return  # a part that no merge makes
        # Spelled by two labels only if no earlier gadget has cut b after a.
        alive = not self._is_cut(a, b)
        self.gadget[a, b] = k
        if alive:
            self.spine_right[c] = [(c, _NEVER), *((p, min(end, k)) for p, end in self.spine_right[b])]
            self.spine_left[c] = [(c, _NEVER), *((p, min(end, k)) for p, end in self.spine_left[a])]
            self.tokens[self.label[c]] = c

    def _is_cut(self, s: int, t: int) -> bool:
        gadget = self.gadget
        for a, a_ends in self.spine_right[s]:
            for b, b_ends in self.spine_left[t]:
                k = gadget.get((a, b))
                if k is not None and k < a_ends and k <= b_ends:
                    return True
        return False

    def encode(self, word: bytes) -> list[int]:
        """The path that spells the word."""
        whole = self.tokens.get(word)
        if whole is not None:
            return [whole]
        n, at = len(word), 0
        path: list[int] = []
        untried = [self._from(word, 0)]  # at each place on the path the tokens that may still be read there
        seen = {0}
        while at < n:
            while untried[-1]:
                token = untried[-1].pop()
                to = at + len(self.label[token])
                # Only one path leads to a place, so a place left before is a dead end.
                if to not in seen and not (path and self._arc_cut(path[-1], token)):
                    path.append(token)
                    seen.add(to)
                    at = to
                    if at < n:
                        untried.append(self._from(word, at))
                    break
            else:
                untried.pop()
                at -= len(self.label[path.pop()])
        return path

    def _from(self, word: bytes, at: int) -> list[int]:
        """Tokens that the rest of the word begins with, the longest last."""
        begun, found = self.begun.get, []
        for to in range(at + 1, len(word) + 1):
            token = begun(word[at:to])
            if token is None:
                break
            if token >= 0:
                found.append(token)
        return found

    def _arc_cut(self, state: int, token: int) -> bool:
        arc = state << 32 | token
        gone = self.cut.get(arc)
        if gone is None:
            if len(self.cut) >= _MOST_ARCS:
                self.cut.clear()
            gone = self.cut[arc] = self._is_cut(state, token)
        return gone


class ByteBpe:
    """Encodes and decodes whole texts as the vocabulary file's library does."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = byte_letters()

        def as_bytes(token: str) -> bytes:
            return bytes(byte[c] for c in token)

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.automaton = MergeAutomaton([(as_bytes(a), as_bytes(b)) for a, b in pairs], ids)
        self.special = {t: i.to_bytes(4, "little") for t, i in special.items()}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}
        labels = self.automaton.label | {i: t.encode() for t, i in special.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in labels}
        self.labels = [labels.get(i, b"") for i in range(max(labels) + 1)]

    def _ids(self, text: str) -> bytes:
        words, memo = self.words(text), self.memo
        try:
            return b"".join(map(memo.__getitem__, words))
        except KeyError:
            if len(memo) > _MOST_WORDS:
                memo.clear()
            for w in set(words):
                if w not in memo:
                    memo[w] = b"".join(map(self.packed.__getitem__, self.automaton.encode(w.encode())))
            return b"".join(map(memo.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.cut_special is None or not any(t in text for t in self.special):
            return self._ids(text)
        return b"".join(self.special[p] if p in self.special else self._ids(p) for p in self.cut_special.split(text))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row; with ``digests`` their SHA-256 instead.

    Defined results: null and empty texts have no ids and decode to an empty
    text; rows without an id and repeated rows are encoded like any other; an
    empty table gives no rows. A special token's string in a text is that token.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else ENCODED

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for rows in by_size(batch, "text", 4 << 20):
                ids = [bpe.encode(t) for t in rows["text"]]
                texts = [bpe.decode(i) for i in ids]
                out = {"doc_id": rows["doc_id"], "n_tokens": [len(i) // 4 for i in ids]}
                if digests:
                    out["ids_sha256"] = [hashlib.sha256(i).hexdigest() for i in ids]
                    out["decoded_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                else:
                    out |= {"ids": ids, "decoded": texts}
                yield out

    texts = columns_of(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return per_batch(texts, schema, work)
