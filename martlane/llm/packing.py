"""Packing token sequences by sum of squares.

Documents become sequences of at most ``max_tokens``: longer ones are cut into
full pieces and a rest, and pieces share sequences.  The sum-of-squares rule
places a piece where the sum of the squared numbers of open sequences per
remaining gap becomes smallest: into an open sequence of some gap, or into a
new one.  It so keeps the gaps spread over all sizes, and pieces of any size
keep finding one that they close.

At scale: the rule needs only the counts per gap (at most ``max_tokens``
numbers), but is a sequential process; so pieces are dealt evenly over shards
of about ``SHARD_PIECES`` by their row number, each shard is packed by one
task, and then every sequence that a shard left unfilled is dissolved and its
pieces are packed again in fewer shards, until one shard is left or a round has
left more than half of its pieces in unfilled sequences, which then stay as
they are: another round would meet the same lengths.  A shard
holds (row number, length) pairs only, never texts or ids, and its size does
not grow with the input.  What the shards leave open is thus packed together
instead of once per shard.

Defined cases: null text counts as empty and gives one piece with the end id
alone; repeated rows and null ids are pieces of their own; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import BATCH_ROWS, Memo, chunks, map_rows, ship_package, stored

SHARD_PIECES = 25_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return Tokenizer.from_file(path)


# A character whose lower case may depend on more than itself, or a stop that
# another sign precedes (both are one word of the tokenizer then).  Signs are
# listed up to there: to the tokenizer "_" and \x1c to \x1f are signs, to
# Python's classes they are not.
_beyond = re.compile("[^\\x00-\u012f\u0131-\u024f]").search
_signs = "".join(re.escape(c) for c in map(chr, range(0x250))
                 if not c.isalnum() and (c in "\x1c\x1d\x1e\x1f" or not c.isspace()))
_odd_stop = re.compile(f"[{_signs}][.,][ \n]").search


def special_strings(tokenizer) -> tuple[str, ...]:
    """The strings that the tokenizer takes out of a text as they are, lowered."""
    return tuple(t.content.lower() for t in tokenizer.get_added_tokens_decoder().values())


def split_words(text: str | None, special: tuple[str, ...] = ("<|startoftext|>", "<|endoftext|>")) -> list[str]:
    """The text cut at spaces and line breaks, and lowered and cut before a
    single stop at a word's end where that changes no id.  A text that holds a
    string of ``special``, in any case, is not lowered: that could make one."""
    text = text or ""
    if (text.isascii() or not _beyond(text)) and not _odd_stop(text):
        lowered = text.lower()
        if not any(s in lowered for s in special):
            text = lowered.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ")
    return text.replace("\n", " ").split(" ")


def word_ids(tokenizer) -> Memo:
    """Word without white space -> its ids, as little-endian unsigned 32 bits.

    A word of letters is one word of the tokenizer's too and ends with an id
    that marks a word's end, so many of them are encoded as one text and told
    apart by that mark.  Other words are encoded one by one.
    """
    size = tokenizer.get_vocab_size()
    marks = np.array([(tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def apart(words: list[str]) -> dict[str, bytes]:
        return {w: array("I", e.ids).tobytes()
                for w, e in zip(words, tokenizer.encode_batch_fast(words, add_special_tokens=False))}

    def compute(words: set[str]) -> dict[str, bytes]:
        letters = [w for w in words if w.isalpha()]
        found = apart([w for w in words if not w.isalpha()])
        ids = np.array(tokenizer.encode(" ".join(letters), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(marks[ids]) + 1
        if len(ends) != len(letters):  # a letter that the normaliser takes apart
            found.update(apart(letters))
            return found
        data, at = ids.tobytes(), (4 * np.append(0, ends)).tolist()
        found.update((w, data[a:b]) for w, a, b in zip(letters, at, at[1:]))
        return found

    return Memo(compute, 400_000)


@lru_cache(maxsize=2)
def _words(path: str) -> Memo:
    """One word table per Python worker and tokenizer: a worker runs many tasks."""
    return word_ids(_tokenizer(path))


def document_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32: every document's ids and ``end_id``,
    cut after each ``max_tokens``.

    The tokenizer drops white space and joins nothing across it, so texts are
    split at spaces and line breaks and each distinct word is encoded once per
    Python worker, as long as its table holds it (special strings inside a word
    are handled by the tokenizer).
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        words = _words(tokenizer_path)
        special = special_strings(_tokenizer(tokenizer_path))
        end = array("I", [end_id]).tobytes()
        step = 4 * max_tokens
        while some := list(islice(source, BATCH_ROWS)):
            split = [split_words(text, special) for _, text in some]
            for lo, hi in chunks(split):
                words.learn(chain.from_iterable(split[lo:hi]))
                for (key, _), keys in zip(some[lo:hi], split[lo:hi]):
                    ids = b"".join(map(words.words.__getitem__, keys)) + end
                    for piece, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        yield key, piece, at // 4, len(part) // 4, zlib.crc32(part)

    return map_rows(docs, f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long",
                    rows, id_col, text_col)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, taken in the given order."""
    open_at = np.zeros(size + 1, np.int64)       # open sequences per gap; gap 0 stays 0
    with_gap: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for i, length in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to g - length changes the sum by
        # 2 * (open[g - length] - open[g] + 1), less by 1 where g - length is 0.
        before = open_at[length:]
        change = 2 * (open_at[:size - length + 1] - before) + 2
        change[0] -= 1
        change[before == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())              # ties: the smallest gap
        fresh = 2 * int(open_at[size - length]) + 1 if length < size else 0
        if change[best] <= fresh and before[best]:
            gap = best + length
            open_at[gap] -= 1
            s = with_gap[gap].pop()
        else:
            gap, s, n = size, n, n + 1
        sequence[i], offset[i] = s, size - gap
        if gap > length:
            open_at[gap - length] += 1
            with_gap[gap - length].append(s)
    return sequence, offset


def pack(pieces: DataFrame, max_tokens: int = 2048, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (any columns, with ``length``) and sequence_id, offset."""
    ship_package(pieces.sparkSession)
    numbered = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    rest, done, first = numbered.select("_row", "length"), [], 0
    left = rest.count()
    while True:
        shards = max(1, -(-left // shard_pieces))
        packed = stored(_pack_shards(rest, shards, first, max_tokens), "packed")
        first += shards
        if shards == 1:
            done.append(packed.select("_row", "sequence_id", "offset"))
            break
        done.append(packed.filter("filled").select("_row", "sequence_id", "offset"))
        rest = packed.filter("not filled").select("_row", "length")
        before, left = left, rest.count()
        if left > before // 2:  # nothing to gain by another round
            done[-1] = packed.select("_row", "sequence_id", "offset")
            break
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return numbered.join(placed, "_row").drop("_row")


def _pack_shards(pieces: DataFrame, shards: int, first: int, max_tokens: int) -> DataFrame:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)
        # A fixed shuffle: neighbours in the input are often alike in length.
        pdf = pdf.iloc[np.random.default_rng(1).permutation(len(pdf))]
        sequence, offset = sum_of_squares(pdf["length"].to_numpy(), max_tokens)
        if shards == 1:  # the last round also tries long pieces first
            falling = pdf.sort_values(["length", "_row"], ascending=[False, True])
            other, at = sum_of_squares(falling["length"].to_numpy(), max_tokens)
            if len(other) and other.max() < sequence.max():
                pdf, sequence, offset = falling, other, at
        fill = np.bincount(sequence, pdf["length"].to_numpy(), minlength=len(pdf)) if len(pdf) else offset
        return pd.DataFrame({"_row": pdf["_row"], "length": pdf["length"],
                             "sequence_id": ((first + int(key[0])) << 32) + sequence, "offset": offset,
                             "filled": fill[sequence] == max_tokens})

    return (pieces.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
            .groupBy("_shard").applyInPandas(
                run, "_row long, length long, sequence_id long, offset long, filled boolean"))
