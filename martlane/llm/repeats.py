"""Exact repeated-substring removal by merged Burrows-Wheeler transforms.

Every byte covered by a ``SPAN``-byte string that also starts anywhere else in
the corpus is removed.  The work is cut down, without losing a repeat, before
the transforms are built:

0. Equal texts are one text with a number of copies.  All windows of a text
   with copies are repeated; other texts meet its windows once.
1. Every window of SPAN bytes picks an anchor (windows.py).  A string at an
   anchor that occurs once cannot belong to a repeated window.  Where all
   occurrences of an anchor's string stand in the same surroundings (all
   windows that pick it are equal), all these windows are repeated.
2. For the other anchors, each distinct surrounding is cut into cells of
   ``CELL`` neighbouring windows.  All windows of a cell hold the same
   SPAN - CELL + 1 bytes, its core; cells meet by their core, which becomes a
   single symbol, as in prefix-free parsing: left bytes, core, right bytes.  A
   window of a cell is then a run of CELL symbols around the core.
3. Shards of these strings get their transforms, which are merged by
   interleave refinement (bwt.py); the intervals with a common prefix of CELL
   symbols and two or more members are the repeated windows.

Surroundings of an anchor string with more than ``HOT`` different ones do not
meet in one task: their cells are split into single windows, keyed by the
whole window.

Texts are identified by their hash, and the hash of a string is compared only
among strings with the same anchor.  The distinct texts are kept compressed in
the shared folder; only those that hold cells cross the network again.

Defined cases: null text counts as empty; matches never cross rows; strings
are judged on the input, overlaps count; rows that repeat are copies of each
other and lose all windows; texts under SPAN bytes stay; null ids and an
empty table are fine; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from martlane.llm.bwt import repeated
from martlane.llm.common import discard, join_small, map_rows, stored
from martlane.llm.windows import Hashes, anchors, mix

SPAN = 200
CELL = 16
HOT = 4096
ROWS = 500_000  # anchors that a task reads
FREQUENT = 1000  # surroundings with so great a part of the rows are picked by name
BUCKET = 2048  # strings whose transforms are merged together


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _with_key(docs: DataFrame, *columns: str) -> DataFrame:
    """text, tid, size (the text's hash, and its length modulo 2^16)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*columns, text.alias("text"), F.xxhash64(text).alias("tid"),
                       F.pmod(F.octet_length(text), F.lit(1 << 16)).alias("size"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """tid, size, packed (the text compressed), n_bytes, copies: every text once."""
    def rows(source):
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for tid, size, text in source:
            raw = _bytes(text)
            yield tid, size, pack(raw), len(raw)

    packed = map_rows(_with_key(docs), "tid long, size int, packed binary, n_bytes long", rows, "tid", "size", "text",
                      held_bytes=1 << 24)
    return packed.groupBy("tid", "size").agg(F.first("packed").alias("packed"), F.first("n_bytes").alias("n_bytes"),
                                             F.count("*").alias("copies"))


def _surroundings(data: np.ndarray):
    """(hashes, anchor, gram, surroundings' hash, first, last window start)."""
    hashes, at, grams, first, last = anchors(data, SPAN)
    around = mix(hashes.of(first, last + SPAN) + ((at - first) << 9 | (last - first)).astype(np.uint64))
    return hashes, at, grams, around, first, last


def occurrences(texts: DataFrame) -> DataFrame:
    """One row per anchor of each text: gram, around, tid, place (packed: size
    modulo 2^16, anchor, distance back to the first window, number of windows - 1)."""
    def rows(source):
        unpack = zstandard.ZstdDecompressor().decompress
        for tid, size, packed in source:
            data = np.frombuffer(unpack(packed), np.uint8)
            _, at, grams, around, first, last = _surroundings(data)
            place = np.uint64(size << 48) | ((at << 16) | ((at - first) << 8) | (last - first)).astype(np.uint64)
            yield from zip(grams.view(np.int64).tolist(), around.view(np.int64).tolist(), [tid] * len(at),
                           place.view(np.int64).tolist())

    return map_rows(texts.filter(F.col("n_bytes") >= SPAN), "gram long, around long, tid long, place long", rows,
                    "tid", "size", "packed")


_SIZE = "cast(shiftrightunsigned(place, 48) as int)"
_AT = "(shiftright(place, 16) & 4294967295)"
_BACK = "(shiftright(place, 8) & 255)"
_WIDE = "(place & 255)"


def _runs(rows: DataFrame) -> DataFrame:
    """Rows whose windows are all repeated -> tid, size, from, to (bytes)."""
    return rows.selectExpr("tid", f"{_SIZE} as size", f"{_AT} - {_BACK} as from",
                           f"{_AT} - {_BACK} + {_WIDE} + {SPAN} as to")


def cells(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """Strings of the surroundings in ``asked`` (gram, tid, place, n, hot): key
    (of the core, or of a single window), left, right (null for a single
    window), tid, place (null for surroundings that occur ``n`` > 1 times, which
    are only met), cell, low, high: the windows that pick the anchor take from
    ``low`` to ``high`` bytes from the left of the core."""
    wanted = (asked.withColumn("size", F.expr(_SIZE)).groupBy("tid", "size")
              .agg(F.collect_list(F.struct("gram", "place", "n", "hot")).alias("asked")))

    def rows(source):
        unpack = zstandard.ZstdDecompressor().decompress
        for tid, packed, asks in source:
            raw = unpack(packed)
            data = np.frombuffer(raw, np.uint8)
            hashes, n = Hashes(data), len(raw)
            # Windows start at - l, for l of cell c in c * CELL .. c * CELL + CELL - 1.
            todo = []
            for ask in asks:
                place = ask["place"] & (1 << 64) - 1
                at, back, wide = place >> 16 & 0xFFFFFFFF, place >> 8 & 0xFF, place & 0xFF
                for cell in range((back - wide) // CELL, back // CELL + 1):
                    low, high = max(0, back - wide - cell * CELL), min(CELL - 1, back - cell * CELL)
                    todo.append((ask, cell, at - cell * CELL, low, high))
            begins = np.array([t[2] for t in todo])
            cores = hashes.of(begins, begins + SPAN - CELL + 1).tolist()
            for (ask, cell, begin, low, high), core in zip(todo, cores):
                end = begin + SPAN - CELL + 1
                key = (core ^ (ask["gram"] * 0x9E3779B97F4A7C15 + cell * 0xD6E8FEB86659FD93)) & (1 << 64) - 1
                left, right = raw[max(0, begin - CELL + 1):begin], raw[end:end + CELL - 1]
                where = ask["place"] if ask["n"] == 1 else None
                if not ask["hot"]:
                    yield _signed(key), left, right, tid, where, cell, low, high
                    continue
                for t in range(low, high + 1):  # a window takes t bytes from the left
                    own = hashlib.blake2b(left[len(left) - t:] + bytes([t]) + right[:CELL - 1 - t],
                                          digest_size=8, key=key.to_bytes(8, "little")).digest()
                    yield int.from_bytes(own, "little", signed=True), None, None, tid, where, cell, t, t

    joined = texts.select("tid", "size", "packed").join(wanted, ["tid", "size"])
    return map_rows(joined, "key long, left binary, right binary, tid long, place long, cell int, low int, high int",
                    rows, "tid", "packed", "asked")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def repeated_windows(strings: DataFrame) -> DataFrame:
    """tid, place, cell, low, high: the least and the most bytes from the left of
    the core that a repeated window at the place takes.  Both are repeated, and
    cover all bytes between them, being longer than a cell."""
    def rows(source):
        bucket: list[tuple[list, dict]] = []
        held = 0
        for key, group in groupby(source, key=lambda r: r[0]):
            first, members = None, {}
            for _, left, right, *who in group:
                if left is not None:
                    members.setdefault((left, right), []).append(tuple(who))
                elif first is None:  # single windows: two members are a repeat
                    first = tuple(who)
                else:
                    if first:
                        yield first
                    first = ()
                    yield tuple(who)
            if len(members) == 1:
                whole, = members.values()
                if len(whole) > 1:
                    yield from whole
            elif members:
                bucket.append(members)
                held += len(members)
                if held >= BUCKET:
                    yield from _merged(bucket)
                    bucket, held = [], 0
        yield from _merged(bucket)

    ordered = strings.repartition("key").sortWithinPartitions("key")
    return map_rows(ordered, "tid long, place long, cell int, low int, high int", rows,
                    "key", "left", "right", "tid", "place", "cell", "low", "high").filter("place is not null")


def _merged(groups: list[dict]) -> Iterator[tuple]:
    strings, weights, members = [], [], []
    for number, group in enumerate(groups):
        for (left, right), who in group.items():
            s = np.empty(len(left) + 1 + len(right), np.int64)
            s[:len(left)] = np.frombuffer(left, np.uint8)
            s[len(left) + 1:] = np.frombuffer(right, np.uint8)
            s += 1
            s[len(left)] = 300 + number
            strings.append(s)
            weights.append(len(who))
            members.append((len(left), who))
    for (size, who), found in zip(members, repeated(strings, np.array(weights), CELL)):
        taken = size - np.flatnonzero(found)
        for *w, low, high in who:
            own = taken[(taken >= low) & (taken <= high)]
            if len(own):
                yield (*w, int(own.min()), int(own.max()))


def _met_again(mixed: DataFrame, kinds: DataFrame) -> DataFrame:
    """The rows of ``mixed`` whose surroundings ``kinds`` counts more than once:
    these are repeated wherever they stand.

    Surroundings with a ``FREQUENT``-th of these rows or more number at most
    ``FREQUENT``: a filter picks them by name, so that their rows are neither
    shuffled nor gather in one task.  The others meet by a join."""
    again = kinds.filter("n > 1").select("gram", "around", "n")
    total = again.agg(F.sum("n")).first()[0] or 0
    name = F.concat_ws(":", "gram", "around")
    frequent = name.isin([r[0] for r in again.filter(F.col("n") * FREQUENT >= total).select(name).collect()])
    rare = mixed.filter(~frequent).join(again.filter(~frequent).drop("n"), ["gram", "around"], "left_semi")
    return mixed.filter(frequent).unionByName(rare)


def removal_runs(texts: DataFrame) -> DataFrame:
    """tid, size, runs (from, to; bytes to remove, runs may overlap) of the
    texts that have any, stored."""
    every = occurrences(texts)
    grams = (every.groupBy("gram").agg(F.count("*").alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
             .filter("n > 1").select("gram", (F.col("a") != F.col("b")).alias("mixed")))
    grams = stored(grams, "grams", ROWS)
    shared = stored(every.join(grams, "gram"), "shared", ROWS)
    discard(grams)
    alike = _runs(shared.filter("not mixed"))

    mixed = shared.filter("mixed").select("gram", "around", "tid", "place")
    kinds = stored(mixed.groupBy("gram", "around")
                   .agg(F.count("*").alias("n"), F.min(F.struct("tid", "place")).alias("r")), "kinds", ROWS)
    several = _runs(_met_again(mixed, kinds))
    # Others stand in one place each, which goes with their strings.
    hot = kinds.groupBy("gram").agg((F.count("*") > HOT).alias("hot"))
    asked = kinds.join(hot, "gram").select("gram", "r.tid", "r.place", "n", "hot")
    core = f"{_AT} - cell * {CELL}"
    one = repeated_windows(cells(asked, texts)).selectExpr(
        "tid", f"{_SIZE} as size", f"{core} - high as from", f"{core} - low + {SPAN} as to")
    whole = (texts.filter((F.col("copies") > 1) & (F.col("n_bytes") >= SPAN))
             .selectExpr("tid", "size", "cast(0 as long) as from", "n_bytes as to"))
    every_run = alike.unionByName(several).unionByName(one).unionByName(whole)
    runs = stored(every_run.groupBy("tid", "size").agg(F.collect_set(F.struct("from", "to")).alias("runs")), "runs")
    discard(shared, kinds)
    return runs


def _cut(raw: bytes, runs) -> tuple[bytes, int, int]:
    """(bytes that remain, bytes removed, maximal removed runs)."""
    kept, removed, spans, at, covered = [], 0, 0, 0, -1
    for a, b in sorted((r["from"], r["to"]) for r in runs or ()):
        if a > covered:
            spans += 1
            kept.append(raw[at:a])
            removed += b - a
        elif b > covered:
            removed += b - covered
        covered = at = max(covered, b)
    kept.append(raw[at:])
    return b"".join(kept), removed, spans


def _processed(docs: DataFrame, schema: str, one) -> DataFrame:
    """tid, size, copies, n_bytes, and ``one(bytes, runs)``'s columns, of every
    distinct text, stored."""
    texts = stored(distinct_texts(docs), "texts")
    runs = removal_runs(texts)

    def rows(source):
        unpack = zstandard.ZstdDecompressor().decompress
        for tid, size, copies, n, packed, found in source:
            yield (tid, size, copies, n, *one(unpack(packed), found))

    out = stored(map_rows(texts.join(runs, ["tid", "size"], "left"),
                          f"tid long, size int, copies long, n_bytes long, {schema}", rows,
                          "tid", "size", "copies", "n_bytes", "packed", "runs", held_bytes=1 << 24), "processed")
    discard(texts, runs)
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    def one(raw, runs):
        rest, removed, spans = _cut(raw, runs)
        return removed, spans, hashlib.sha256(rest).hexdigest()

    texts = _processed(docs, "n_removed long, n_spans long, kept_sha256 string", one)
    rows = _with_key(docs, "doc_id").drop("text")
    return join_small(rows, texts, ["tid", "size"], "copies").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


SMALL_TEXT = 1 << 15   # bytes of a frequent text that may be broadcast


def cut_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) with repeats cut from their texts
    (bytes of a character that a cut leaves incomplete go too) and ``n_chars``,
    if there is one, set to the new length.  Null texts stay null."""
    def one(raw, runs):
        if not runs:
            return False, raw.decode("utf-8")
        return True, _cut(raw, runs)[0].decode("utf-8", "ignore")

    texts = _processed(docs, "cut boolean, kept string", one)
    fixed = [c for c in docs.columns if c != "text"]
    inner = [f"_{i}" for i in range(len(fixed))]  # own names: the columns' may clash with ours
    rows = _with_key(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(fixed, inner)), "text",
                                 F.col("text").isNull().alias("_null")), *inner, "_null").drop("text")
    both = join_small(rows, texts, ["tid", "size"], "copies", small=F.col("n_bytes") <= SMALL_TEXT)
    text = F.when(~F.col("_null"), F.col("kept"))
    out = {c: F.col(n) for c, n in zip(fixed, inner)} | {"text": text}
    if "n_chars" in fixed:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("cut"), F.length("kept").cast(kind)).otherwise(out["n_chars"])
    return both.select(*(out[c].alias(c) for c in docs.columns))
