"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines over the tropical semiring (min, +):

* N, the normaliser: marks the front, maps a space to the space mark;
* V, the pieces: from its start state a trie over the piece characters, with
  an arc back that emits the piece id; byte fallback adds, for a character
  without a piece, arcs that emit its byte ids;
* C, the merge constraint: one state per last emitted piece; an arc for
  piece b leaves state a with weight 0 if b may follow a, else with infinite
  weight (is absent).  For a BPE model this leaves exactly one accepting path
  per text, so the shortest path is the library's encoding.

``shortest_path`` composes one input with N, V and C on the fly (never
building the product for the whole vocabulary) and relaxes its states, which
are numbered by input position, in topological order.  Composition does not
cross a word border (no piece does), so a text's path is the paths of its
words end to end, and words are composed once per Python worker.

Decoding runs the inverse: piece ids to text, byte ids joined to UTF-8
(invalid bytes become U+FFFD), the front mark dropped; control ids give
nothing, ids out of range raise ValueError.

Defined cases: null text encodes to no ids, null ids decode to null; empty to
empty; rows stay as they come; other columns are ignored.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame

from martlane.llm.common import BATCH_ROWS, chunks, map_rows
from martlane.llm.pieces import SHORT, SPACE, START, UNKNOWN, PieceModel, load, matrices, word_memo

class Transducer:
    """N and C on demand, V as the model's trie read from the piece's end, so
    that a state's incoming arcs are relaxed together."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.memo = word_memo(model, self.shortest_paths, 600_000)

    def weight(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Weights of C's arcs for pieces ``b`` from states ``a``."""
        return np.where(self.model.compatible_many(a, b), 0.0, np.inf)

    def shortest_paths(self, words) -> dict[str, bytes]:
        """word -> ids (little-endian unsigned 32 bits) on the least-weight
        path through its composition.

        Position by position, the arcs into all states of a position are
        relaxed for many words at once.  A position holds one state, its least
        distance, the piece that reached it and where that piece began: C
        leaves a single finite one.
        """
        out = {p: self._long_path(p) for p in words if len(p) > SHORT}
        for group, chars, _ in matrices(words):
            n, width = chars.shape
            distance = np.full((n, width + 1), np.inf)
            distance[:, 0] = 0.0
            last = np.full((n, width + 1), START, np.int64)
            begin = np.zeros((n, width + 1), np.int64)
            for end in range(1, width + 1):
                for rows, piece, size in self.model.ending(chars, end):
                    through = distance[rows, end - size] + self.weight(last[rows, end - size], piece)
                    better = through < distance[rows, end]
                    hit = rows[better]
                    distance[hit, end] = through[better]
                    last[hit, end] = piece[better]
                    begin[hit, end] = end - size
                rest = np.isinf(distance[:, end])  # byte fallback
                distance[rest, end] = distance[rest, end - 1]
                last[rest, end] = UNKNOWN
                begin[rest, end] = end - 1
            for word, pieces, begins in zip(group, last.tolist(), begin.tolist()):
                out[word] = self._trace(word, pieces, begins)
        return out

    def _trace(self, word: str, pieces: list[int], begins: list[int]) -> bytes:
        at, ids = len(word), []
        while at > 0:
            if pieces[at] == UNKNOWN:
                ids.extend([self.model.byte_id[b] for b in
                            reversed(word[begins[at]:at].encode("utf-8", "surrogatepass"))])
            else:
                ids.append(pieces[at])
            at = begins[at]
        ids.reverse()
        return array("I", ids).tobytes()

    def _long_path(self, word: str) -> bytes:
        """The same for one long word, state by state."""
        arcs, final, compatible = self.model.arcs, self.model.final, self.model.compatible
        pieces, begins = [START], [0]
        for end in range(1, len(word) + 1):
            at, state = end, 0
            reached = (UNKNOWN, end - 1)
            while at:
                state = arcs[state].get(word[at - 1])
                if state is None:
                    break
                at -= 1
                if final[state] is not None and compatible(pieces[at], final[state]):
                    reached = (final[state], at)
                    break
            pieces.append(reached[0])
            begins.append(reached[1])
        return self._trace(word, pieces, begins)

    def encode(self, texts: list[str | None]):
        """Yield each text's ids as little-endian unsigned 32-bit bytes."""
        split = [self.model.words(text) for text in texts]
        for lo, hi in chunks(split):
            self.memo.learn(chain.from_iterable(split[lo:hi]))
            held = self.memo.words.__getitem__
            for keys in split[lo:hi]:
                yield b"".join(map(held, keys))


@lru_cache(maxsize=2)
def _machine(model_path: str) -> Transducer:
    """One per Python worker, with the words it has composed: a worker runs many tasks."""
    return Transducer(load(model_path))


def piece_bytes(model: PieceModel) -> list[bytes | None]:
    """The inverse of V and N: UTF-8 of each id (None: not an id of text)."""
    out: list[bytes | None] = []
    for i, piece in enumerate(model.text):
        if i in model.byte_of:
            out.append(bytes([model.byte_of[i]]))
        elif i in model.silent:
            out.append(b"")
        else:
            out.append(piece.replace(SPACE, " ").encode())
    return out


def decode_ids(model: PieceModel, spelled: list[bytes | None], ids) -> str:
    try:
        text = b"".join([spelled[i] for i in ids])
    except IndexError:
        raise ValueError("an id is outside the vocabulary") from None
    text = text.decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids array<int>."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        machine = _machine(model_path)
        while some := list(islice(source, BATCH_ROWS)):
            for (key, _), coded in zip(some, machine.encode([text for _, text in some])):
                yield key, memoryview(coded).cast("I").tolist()

    return map_rows(docs, f"`{id_col}` {id_type}, ids array<int>", rows, id_col, text_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def rows(source):
        model = load(model_path)
        spelled = piece_bytes(model)
        for key, ids in source:
            yield key, None if ids is None else decode_ids(model, spelled, ids)

    return map_rows(encoded, f"`{id_col}` {id_type}, text string", rows, id_col, ids_col)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, ids_crc32 (unsigned, over
    little-endian unsigned 32-bit ids), decoded_sha256, whether the decoded
    text equals the input, and the ids and the decoded text themselves."""
    import hashlib
    import zlib

    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        machine = _machine(model_path)
        spelled = piece_bytes(machine.model)
        while some := list(islice(source, BATCH_ROWS)):
            for (key, text), coded in zip(some, machine.encode([text for _, text in some])):
                ids = memoryview(coded).cast("I").tolist()
                back = decode_ids(machine.model, spelled, ids)
                yield (key, len(coded) // 4, zlib.crc32(coded),
                       hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == (text or ""),
                       ids, back)

    return map_rows(docs, f"`{id_col}` {id_type}, n_tokens long, ids_crc32 long, decoded_sha256 string, "
                    "same_text boolean, ids array<int>, decoded string", rows, id_col, text_col, held_bytes=8 << 20)
