"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it.  Fingerprints link at ``DISTANCE`` = 2 or fewer
differing bits.

The fingerprint is cut into three segments of 22, 21 and 21 bits, each a word
of the perfect binary Golay code of length 23.  Every such word is within 3
bits of exactly one codeword; a word at distance 3 has five more codewords at
distance 4.  These one or six codewords, as 12-bit indices, are the segment's
fuzzy keys, and segments that differ in two bits or fewer share one: the word
between them has a codeword within 3, which is within 4 of both.

Two differing bits lie in three segments so that some segment has none and
the one after it (cyclically) at most one.  So each fingerprint gets, for each
of the three segments, the segment's bits with every fuzzy key of the next
one: 3 to 18 keys of 33 or 34 bits.  Linked fingerprints share a key.

1. Equal fingerprints are one row from here on, so copies never multiply.
2. Keys that 2 to ``BUCKET`` fingerprints share are compared bit by bit; a
   bucket of n gives at most n - 1 links.
3. The fingerprints of larger buckets are not compared: two fingerprints are
   within 2 bits exactly if they have a common word within 1 bit, so each gives
   its 65 such words, and those that share a word are linked.  A word has at
   most 65 such fingerprints, whatever the data, so this is linear and exact.
4. Confirmed links give components (graph.py).

Defined cases: null and empty texts and texts without words have fingerprint
zero and are linked like any other; a text of fewer than three words is one
shingle; repeated rows are linked; rows with a null id take part, and a
component takes the smallest non-null id (none: null); an empty table gives
an empty result; other columns are ignored; a text of any length is hashed in
pieces of ``PIECE`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import discard, join_small, map_rows, ship_package, stored, together
from martlane.llm.graph import components

WORDS = 3
SEED = 42
DISTANCE = 2
BUCKET = 64        # fingerprints of one key that are compared with each other
PIECE = 1 << 16    # shingles hashed at a time
ROWS = 500_000     # rows of fingerprints or keys that a task reads
SEGMENTS = ((0, 22), (22, 21), (43, 21))   # first bit and length
GENERATOR = 0b110001110101                 # of the Golay code, degree 11


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash of the text's shingles: XXH64 with seed 42, repeats included."""
    import xxhash
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    width = min(words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = len(parts) - width + 1
    count = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for lo in range(0, n, PIECE):
        hi = min(n, lo + PIECE)
        spans = zip(starts[lo:hi].tolist(), ends[lo + width - 1:hi + width - 1].tolist())
        h = np.array([hashed(joined[a:b], SEED) for a, b in spans], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(source):
        for doc, text in source:
            fp = fingerprint(text, words)
            yield doc, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(docs, f"doc_id {id_type}, fp long", rows, "doc_id", "text")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: 23-bit words, as polynomials, modulo the generator."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= (words >> bit & 1) * (GENERATOR << bit - 11)
    return words


class Golay:
    """Tables by syndrome: the error of up to 3 bits, whether it has 3, and
    the five errors of 4 bits of those that have."""

    def __init__(self):
        at = 1 << np.arange(23, dtype=np.int64)
        errors = [np.zeros(1, np.int64)] + [
            np.array([sum(c) for c in combinations(at.tolist(), k)], np.int64) for k in (1, 2, 3, 4)]
        few = np.concatenate(errors[:4])
        self.error = np.empty(1 << 11, np.int64)
        self.error[_remainder(few)] = few
        self.far = np.zeros(1 << 11, bool)
        self.far[_remainder(errors[3])] = True
        syndrome = _remainder(errors[4])
        order = np.argsort(syndrome, kind="stable")
        self.more = np.zeros((1 << 11, 5), np.int64)
        self.more[np.unique(syndrome)] = errors[4][order].reshape(-1, 5)

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the word, 12-bit index of a codeword within 4 bits): the
        nearest codeword, and the five at distance 4 if that is at distance 3."""
        syndrome = _remainder(words)
        nearest = (words ^ self.error[syndrome]) >> 11
        far = np.flatnonzero(self.far[syndrome])
        more = (words[far, None] ^ self.more[syndrome[far]]) >> 11
        return (np.concatenate([np.arange(len(words)), np.repeat(far, 5)]),
                np.concatenate([nearest, more.ravel()]))


def fuzzy_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position, key): table number, one segment's bits, a fuzzy key of the next."""
    parts = [(fps >> np.uint64(lo) & np.uint64((1 << size) - 1)).astype(np.int64) for lo, size in SEGMENTS]
    who, keys = [], []
    for t, part in enumerate(parts):
        at, index = code.keys(parts[(t + 1) % len(parts)])
        who.append(at)
        keys.append((t << 22 | part[at]) << 12 | index)
    return np.concatenate(who), np.concatenate(keys)


def keyed(distinct: DataFrame) -> DataFrame:
    """key, fp: every key of every fingerprint."""
    ship_package(distinct.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            who, keys = fuzzy_keys(fps.view(np.uint64), code)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[who])], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def bucket_links(members: DataFrame, small: bool = False, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between the fingerprints of each key (key, fp; at most
    ``BUCKET`` a key), those that join what the ones before have not joined."""
    def rows(source: Iterable[tuple]) -> Iterator[tuple]:
        for _, group in groupby(source, key=lambda r: r[0]):
            fps = np.array([r[1] for r in group], np.int64).view(np.uint64)
            part = np.arange(len(fps))
            for i in range(1, len(fps)):
                near = np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= distance)
                for j in near.tolist():
                    if part[i] != part[j]:
                        part[part == part[j]] = part[i]
                        yield tuple(fps[[j, i]].view(np.int64).tolist())

    ordered = together(members, small, "key", "fp")
    return map_rows(ordered, "a long, b long", rows, "key", "fp").distinct()


def word_links(crowded: DataFrame) -> DataFrame:
    """(a, b): links between the fingerprints (fp) within 2 bits of each other,
    by the words within 1 bit of both."""
    flips = [0] + [1 << i for i in range(63)] + [-(1 << 63)]
    words = crowded.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(x)) for x in flips))).alias("word"))
    sharing = words.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    pairs = sharing.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return pairs.filter("a != b").distinct()


def near_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id, n_copies (rows
    with this fingerprint) of every row."""
    every = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(every.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies")),
                      "distinct", ROWS)
    keys = stored(keyed(distinct), "keys", ROWS)
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(keys.join(shared, "key"), "shared", ROWS)
    links = bucket_links(shared.filter(F.col("size") <= BUCKET).select("key", "fp"), shared.small)
    crowded = shared.filter(F.col("size") > BUCKET).select("fp").distinct()
    links = stored(links.unionByName(word_links(crowded)), "links")
    discard(keys, shared)
    found = components(links).withColumnRenamed("node", "fp")
    discard(links)

    # Only fingerprints that are linked with another need their component's id.
    linked = distinct.join(found, "fp")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "component").select("fp", "component_id")
    named = (distinct.join(linked, "fp", "left")
             .select("fp", "n_copies", F.coalesce("component_id", "least").alias("component_id")))
    out = join_small(every, named, "fp", "n_copies")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id", "n_copies")
