"""A SentencePiece BPE model as data: pieces, byte fallback, pair compatibility.

Shared by the prefix dynamic programme (token_counts) and the transducer
(transducer).  Both rest on one property of BPE: a piece sequence is THE
encoding of its string exactly when every two neighbours a, b are
``compatible``, that is, when merging their joined text alone gives [a, b]
again.  (The merges inside a substring happen in the same order as in the
whole string until one crosses the substring's border.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from martlane.llm.common import Memo

SPACE = "▁"
START = -1          # "no piece yet"
UNKNOWN = -2        # a character outside the vocabulary, spelled in byte pieces


def _fields(data: bytes):
    """(number, value) of one protobuf message; nested messages stay bytes."""
    def varint(i):
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 127) << shift
            shift, i = shift + 7, i + 1
            if b < 128:
                return value, i
    i = 0
    while i < len(data):
        key, i = varint(i)
        wire = key & 7
        if wire == 0:
            value, i = varint(i)
        elif wire == 2:
            size, i = varint(i)
            value, i = data[i:i + size], i + size
        else:
            size = 8 if wire == 1 else 4
            value, i = data[i:i + size], i + size
        yield key >> 3, value


class PieceModel:
    """Vocabulary and normaliser settings read from a ``.model`` file.

    Takes BPE models with byte fallback, no character map and spaces kept
    (others raise ValueError: their normaliser is not expressed here).
    """

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        trainer = dict(_fields(next((v for k, v in model if k == 2), b"")))
        normal = dict(_fields(next((v for k, v in model if k == 3), b"")))
        self.dummy_prefix = bool(normal.get(3, 1))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("not a BPE model with byte fallback")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("the model's normaliser maps characters or drops spaces")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[int, float] = {}
        self.text: list[str] = []
        self.byte_id = [-1] * 256
        self.byte_of: dict[int, int] = {}
        self.silent: set[int] = set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.text.append(piece)
            if sp.is_byte(i):
                b = int(piece[1:-1], 16)
                self.byte_id[b], self.byte_of[i] = i, b
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.silent.add(i)
            else:
                self.ids[piece] = i
                self.score[i] = sp.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans a word border")
        # No piece holds a character followed by a space mark, so no merge
        # crosses that border and words are encoded one by one.  The same
        # holds before and after a line break if no piece contains one.
        self.breaks = not any("\n" in p for p in self.ids)
        self._words = re.compile(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if self.breaks
                                 else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        # The pieces as a trie read from their last character to the first.
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[int | None] = [None]
        for piece, i in self.ids.items():
            state = 0
            for c in reversed(piece):
                follow = self.arcs[state].get(c)
                if follow is None:
                    follow = self.arcs[state][c] = len(self.arcs)
                    self.arcs.append({})
                    self.final.append(None)
                state = follow
            self.final[state] = i
        # The same trie as sorted arrays, for many words at a time.
        arcs = sorted((state << 21 | ord(c), follow) for state, out in enumerate(self.arcs)
                      for c, follow in out.items())
        self._arc = np.array([a for a, _ in arcs], np.int64)
        self._follow = np.array([f for _, f in arcs], np.int64)
        self._piece = np.array([-1 if f is None else f for f in self.final], np.int64)
        self._pairs: dict[int, bool] = {}
        self._pair = np.empty(0, np.int64)
        self._may = np.empty(0, bool)

    def words(self, text: str | None) -> list[str]:
        """Keys of the text's words, in order; ``spelled`` gives their characters.

        A key with a space mark stands for itself, one that begins with a line
        break for itself, any other for a space mark and the key.  (Without a
        front mark in the model, a zero byte leads keys that stand bare.)
        """
        if not text:
            return []
        if self.dummy_prefix and self.breaks and SPACE not in text:
            spaced = text.replace("\n", " \n") if "\n" in text else text
            if "  " not in spaced and spaced[0] != " " and spaced[-1] != " ":
                return spaced.split(" ")
        found = self._words(self.normalise(text))
        return [w if w[0] == SPACE or w[0] == "\n" else "\0" + w for w in found] if not self.dummy_prefix else found

    def spelled(self, key: str) -> str:
        """The normalised characters of a word key."""
        if not self.dummy_prefix and key[0] == "\0":
            return key[1:]
        return key if key[0] == "\n" and self.breaks or SPACE in key else SPACE + key

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def merge(self, text: str) -> list[int]:
        """Plain BPE over known characters: best score first, leftmost on ties."""
        symbols = list(text)
        ids, score = self.ids, self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                piece = ids.get(symbols[i] + symbols[i + 1])
                if piece is not None and (best is None or score[piece] > best):
                    best, at = score[piece], i
            if at < 0:
                return [ids[s] for s in symbols]
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """May piece ``b`` follow piece ``a`` in an encoding?"""
        if b == UNKNOWN:
            return True
        key = (a + 2) * 1_000_000 + b
        known = self._pairs.get(key)
        if known is None:
            if a < 0:
                known = self.merge(self.text[b]) == [b]
            else:
                known = self.merge(self.text[a] + self.text[b]) == [a, b]
            if len(self._pairs) >= 400_000:
                self._pairs.clear()
            self._pairs[key] = known
        return known


    def compatible_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` over arrays.

        Judged pairs are looked up in a sorted copy of the memo, renewed when
        the memo has grown by a fifth; the others one by one.
        """
        key = (a + 2) * 1_000_000 + b
        if len(self._pairs) > 1.2 * len(self._pair) + 1000:
            self._pair = np.fromiter(self._pairs.keys(), np.int64, len(self._pairs))
            may = np.fromiter(self._pairs.values(), bool, len(self._pairs))
            order = np.argsort(self._pair)
            self._pair, self._may = self._pair[order], may[order]
        if not len(self._pair):
            return np.array([self.compatible(x, y) for x, y in zip(a.tolist(), b.tolist())], bool)
        at = np.searchsorted(self._pair, key)
        at[at == len(self._pair)] = 0
        out = self._may[at]
        new = np.flatnonzero(self._pair[at] != key)
        if len(new):
            out[new] = [self.compatible(x, y) for x, y in zip(a[new].tolist(), b[new].tolist())]
        return out

    def ending(self, chars: np.ndarray, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(rows, their piece, its length) for every piece that ends before
        column ``end``, shortest first.  ``chars``: one word per row, as code
        points.  Send a mask of these rows to go on with the others only."""
        rows = np.arange(len(chars))
        state = np.zeros(len(chars), np.int64)
        for begin in range(end - 1, -1, -1):
            key = state << 21 | chars[rows, begin]
            at = np.searchsorted(self._arc, key)
            at[at == len(self._arc)] = 0
            alive = self._arc[at] == key
            rows, state = rows[alive], self._follow[at[alive]]
            if not len(rows):
                return
            piece = self._piece[state]
            has = piece >= 0
            if has.any():
                done = yield rows[has], piece[has], end - begin
                if done is not None:
                    stay = np.ones(len(rows), bool)
                    stay[np.flatnonzero(has)[done]] = False
                    rows, state = rows[stay], state[stay]
                    if not len(rows):
                        return


def word_memo(model: PieceModel, compute, limit: int) -> Memo:
    """Word key -> what ``compute`` gives for its spelling."""
    def values(keys):
        spellings = {key: model.spelled(key) for key in keys}
        found = compute(spellings.values())
        return {key: found[word] for key, word in spellings.items()}
    return Memo(values, limit)


SHORT = 40  # words up to this length are taken many at a time


def matrices(parts) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Short words in groups of like length: (words, code points, UTF-8 lengths)."""
    parts = sorted((p for p in parts if len(p) <= SHORT), key=len)
    lo = 0
    while lo < len(parts):
        hi = lo
        while hi < len(parts) and hi - lo < 20_000 and len(parts[hi]) <= len(parts[lo]) + 3:
            hi += 1
        group = parts[lo:hi]
        width = len(group[-1])
        chars = np.array(group, f"U{width}").view(np.uint32).reshape(len(group), width).astype(np.int64)
        utf8 = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
        yield group, chars, utf8
        lo = hi


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """One model per Python worker and path."""
    return PieceModel(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")
