"""Token counts by prefix dynamic programming.

``prefix_counts(model, text)[i]`` is the exact number of tokens of
``text[:i]``, for every i, without encoding any prefix anew: each prefix has
one last token t, the only vocabulary entry that ends there, is compatible
with the last token before it and so extends an encoding; its count is the
count before t plus one.  Truncation ("the longest prefix of at most n
tokens") and budget questions read the table.

Words share their tables: no merge crosses a word border, so the table of a
text is the word tables laid end to end, shifted by the tokens before.

Defined cases: null text counts as empty (0 tokens, 0 bytes); characters
outside the vocabulary cost one token per UTF-8 byte; rows are kept as they
come (null ids and repeated rows too); other input columns are ignored.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import chain, islice
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame

from martlane.llm.common import BATCH_ROWS, Memo, chunks, map_rows
from martlane.llm.pieces import SHORT, START, UNKNOWN, PieceModel, load, matrices, word_memo


def word_counts(model: PieceModel, words) -> dict:
    """Counts at prefixes 1..n of each normalised word (bytes while below 256,
    else array)."""
    tables = {w: _long_table(model, w) for w in words if len(w) > SHORT}
    for group, chars, utf8 in matrices(words):
        n, width = chars.shape
        last = np.full((n, width + 1), START, np.int64)
        count = np.zeros((n, width + 1), np.int64)
        for end in range(1, width + 1):
            last[:, end] = UNKNOWN
            count[:, end] = count[:, end - 1] + utf8[:, end - 1]
            found = model.ending(chars, end)
            step = next(found, None)
            while step is not None:
                rows, piece, size = step
                fits = model.compatible_many(last[rows, end - size], piece)
                hit = rows[fits]
                last[hit, end] = piece[fits]
                count[hit, end] = count[hit, end - size] + 1
                try:
                    step = found.send(fits)
                except StopIteration:
                    step = None
        for word, row in zip(group, count[:, 1:].astype(np.uint8)):
            tables[word] = row[:len(word)].tobytes()
    return tables


def _long_table(model: PieceModel, word: str) -> bytes | array:
    """The same for one long word."""
    arcs, final, compatible = model.arcs, model.final, model.compatible
    last, count = [START], [0]
    for end in range(1, len(word) + 1):
        begin, state, found = end, 0, False
        while begin and not found:
            state = arcs[state].get(word[begin - 1])
            if state is None:
                break
            begin -= 1
            piece = final[state]
            found = piece is not None and compatible(last[begin], piece)
        if found:
            last.append(piece)
            count.append(count[begin] + 1)
        else:  # a character outside the vocabulary
            last.append(UNKNOWN)
            count.append(count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass")))
    return bytes(count[1:]) if max(count) < 256 else array("I", count[1:])


def memo(model: PieceModel) -> Memo:
    return word_memo(model, lambda words: word_counts(model, words), 400_000)


@lru_cache(maxsize=2)
def _memos(model_path: str) -> tuple[PieceModel, Memo]:
    """Model and tables of words, kept per Python worker: a worker runs many tasks."""
    model = load(model_path)
    return model, memo(model)


def prefix_counts(model: PieceModel, text: str | None, tables: Memo | None = None) -> list[int]:
    """Token counts of text[:0], text[:1], ... text[:len(text)]."""
    tables = memo(model) if tables is None else tables
    keys = model.words(text)
    tables.learn(keys)
    return _laid(model, map(tables.words.__getitem__, keys))


def _laid(model: PieceModel, tables) -> list[int]:
    """The table of a text: its words' tables laid end to end."""
    counts, before = [], 0
    for t in tables:
        counts.extend([before + c for c in t])
        before += t[-1]
    if not counts:
        return [0]
    if model.dummy_prefix:
        counts[0] = 0  # the mark put in front is no character of the text
        return counts
    return [0, *counts]


def truncate(model: PieceModel, text: str | None, budget: int) -> str:
    """The longest prefix of at most ``budget`` tokens."""
    counts = prefix_counts(model, text)
    return (text or "")[:max(i for i, c in enumerate(counts) if c <= budget)]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit, and chars_in_limit: the length of the
    longest prefix of at most ``limit`` tokens."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        model, tables = _memos(model_path)
        while some := list(islice(source, BATCH_ROWS)):
            split = [model.words(text) for _, text in some]
            for lo, hi in chunks(split):
                tables.learn(chain.from_iterable(split[lo:hi]))
                held = tables.words.__getitem__
                for (key, text), keys in zip(some[lo:hi], split[lo:hi]):
                    text = text or ""
                    n = sum(map(itemgetter(-1), map(held, keys)))
                    fits = len(text)
                    if n > limit:
                        counts = _laid(model, map(held, keys))
                        fits = max(i for i, c in enumerate(counts) if c <= limit)
                    yield key, len(text.encode("utf-8", "surrogatepass")), n, n > limit, fits

    return map_rows(docs, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean, "
                    "chars_in_limit long", rows, id_col, text_col)
