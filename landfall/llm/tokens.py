"""Token ids of whole texts by a word-level vocabulary file, with a memo of words."""

from __future__ import annotations

import os
import re
import string
from functools import cache

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

_MOST = 350_000
_MARK = b"\x01"
# ASCII letters, bytes that make a letter after 0xC3 (Latin-1's, without the signs of multiplication and division), ASCII
# signs that neither end a word nor begin one with what follows them (an apostrophe does).
_LETTER, _SECOND, _SIGN = (np.zeros(256, bool) for _ in range(3))
_LETTER[list(string.ascii_letters.encode())] = True
_SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_SIGN[[b for b in string.punctuation.encode() if b != ord("'")]] = True
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch  # small letters that Unicode's normal form leaves alone


class Memo(dict):
    """Ids of pieces met twice or more; ``once`` holds those of the pieces met once, ``missed`` what neither knows.

    A piece met once moves over when it is looked up again, so that rare
    pieces, which are most, neither crowd the table nor push the others out.
    """

    def __init__(self) -> None:
        self.once: dict[bytes, bytes] = {}
        self.missed: list[bytes] = []

    def __missing__(self, piece: bytes) -> bytes | None:
        ids = self.once.pop(piece, None)
        if ids is None:
            self.missed.append(piece)
        else:
            self[piece] = ids
        return ids

    def learn(self, ids: dict[bytes, bytes]) -> None:
        if len(self) > _MOST:  # those still in use come back one by one
            self.once = dict(self)
            self.clear()
        elif len(self.once) + len(ids) > _MOST:
            self.once = {}
        self.once.update(ids)


class WordTokenizer:
    """Ids as the library gives them for the whole text.

    For lower-casing vocabularies with word ends whose pre-tokenizer never
    joins characters across blanks: a text's ids are then those of its
    blank-separated pieces in a row. A word always ends between a letter and a
    sign, so texts are split there too. A piece's ids are looked up; the library
    encodes the pieces not met before, many in one call, and those of small
    letters, which its normalizer and patterns leave whole, by its byte alphabet
    and model alone. The memo holds a set number of pieces.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = Tokenizer(self.library.model)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        self.memo = Memo()
        words = self.library.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        mark = self._ids(self.library, [_MARK.decode()])[0]
        self.mark = int(mark[0]) if len(mark) == 1 else None

    @staticmethod
    def _ids(library: Tokenizer, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in library.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learned(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        plain, other, alone = [], [], []
        for p in pieces:
            (plain if _PLAIN(p) else alone if self.mark is None or _MARK in p else other).append(p)
        # A run of small letters is one word, and its ids end at a word end.
        for i in range(0, len(plain), 4096):
            part = plain[i : i + 4096]
            ids = self._ids(self.words, [b" ".join(part).decode()])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            self._cut(out, part, ids, [0, *cuts[:-1].tolist()], cuts.tolist())
        # Of the others nobody knows how many words they are: a mark, which none of them holds, stands after each.
        for i in range(0, len(other), 4096):
            part = other[i : i + 4096]
            ids = self._ids(self.library, [(b" " + _MARK + b" ").join([*part, b""]).decode()])[0]
            cuts = np.flatnonzero(ids == self.mark)
            self._cut(out, part, ids, [0, *(cuts[:-1] + 1).tolist()], cuts.tolist())
        for p, ids in zip(alone, self._ids(self.library, [p.decode() for p in alone]), strict=True):
            out[p] = ids.tobytes()
        return out

    @staticmethod
    def _cut(out: dict[bytes, bytes], pieces: list[bytes], ids: np.ndarray, begins: list[int], ends: list[int]) -> None:
        blob = ids.tobytes()
        for p, begin, end in zip(pieces, begins, ends, strict=True):
            out[p] = blob[4 * begin : 4 * end]

    @staticmethod
    def _apart(texts: list[bytes]) -> list[bytes]:
        """The texts with a blank wherever a letter and a sign meet."""
        letters = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        letter, sign = _LETTER[letters], _SIGN[letters]
        second = letter.copy()
        second[1:] |= _SECOND[letters[1:]] & (letters[:-1] == 0xC3)
        at = np.flatnonzero(second[:-1] & sign[1:] | sign[:-1] & letter[1:]) + 1
        ends = np.cumsum([len(t) + 1 for t in texts])
        ends += np.searchsorted(at, ends)
        spaced, out, begin = np.insert(letters, at, 32).tobytes(), [], 0
        for end in ends.tolist():
            out.append(spaced[begin:end])
            begin = end
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit integers."""
        memo = self.memo
        look_up, rows, holes = memo.__getitem__, [], []
        apart = iter(self._apart([t.lower() for t in texts if b"<|" not in t]))
        for text in texts:  # one that may hold the library's own marks stays as it is
            before = len(memo.missed)
            rows.append(list(map(look_up, (text if b"<|" in text else next(apart)).split())))
            if len(memo.missed) > before:
                holes.append((rows[-1], memo.missed[before:]))
        if holes:
            # Pieces that were not met before are learned together, then put where they are missing.
            learned = self._learned(list(dict.fromkeys(memo.missed)))
            memo.missed.clear()
            for row, pieces in holes:
                at = -1
                for p in pieces:
                    at = row.index(None, at + 1)
                    row[at] = learned[p]
            memo.learn(learned)
        return [b"".join(row) for row in rows]


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokenizer(path)
