"""Ranked lexical search by the Best Position Algorithm.

A document's score for an item is a sum, over the item's terms, of the term's
weight times a part that grows with the term's count and shrinks with the
document's length (whole numbers throughout; see ``WEIGHT`` and ``PART``).

Documents are dealt into blocks of about ``BLOCK`` by row number.  In a block
every term has an impact list: its documents by falling part.  For an item,

* sorted access reads the next positions of each of its lists that no access
  has touched yet;
* each document met so is scored at once by direct accesses to all the other
  lists, and the positions that these accesses touch count as seen, too;
* the best position of a list is the end of its run of seen positions.  A
  document not yet seen stands behind it in every list, so the sum of the
  impacts behind the best positions bounds its score.  These bounds are
  tighter than those of the last positions read, as direct accesses move the
  best positions on;
* reading stops once the bound is strictly below the k-th best score: at equal
  scores the smaller id wins, so a tie may not be left unread.

Each block's answer is exact, and the k best of all blocks' at most k hits an
item are the answer.  Items meet blocks in blocks of ``ITEMS``.

Terms that no item has are dropped where documents are read: the join with the
items' terms is broadcast by Spark only while these are small, and is a
shuffle join beyond.  The number of documents and their total length travel
with the postings, as those of a term of their own.

Defined cases: null texts and texts without terms have no postings, do not
count in the statistics and are never found; repeated rows are documents of
their own; rows without an id take part, behind ids at equal scores; items
without a term that a document has give no rows; a repeated item id is ranked
row by row; empty tables give an empty result; texts of any length are read
whole, their terms handed on in pieces; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from martlane.llm.common import map_rows, ship_package, stored

BLOCK = 8192       # documents of one index
ITEMS = 1024       # items that a task asks it
PIECE = 1000       # terms handed on in one row
STEP = 16          # positions first read of each list; doubled every round

# The scoring rule: a term's weight, the length's part of the divisor, and a
# term's part of a document (of n_docs documents with n_terms terms).
WEIGHT = "cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint)"
LENGTH = "(100 - 90 + ((90 * n * n_docs) div n_terms))"
PART = f"((1000000000 * tf) div (1000 * tf + 8 * {LENGTH}))"

# Bytes that are no part of a term become spaces; A-Z are lowered.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other than ASCII characters, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_row, item_id, term: each item's terms once."""
    numbered = items.select(F.monotonically_increasing_id().alias("item_row"), F.col(id_col).alias("item_id"),
                            F.col(text_col).alias("text"))
    kind = items.schema[id_col].dataType.simpleString()

    def rows(source):
        for row, item, text in source:
            found = sorted(set(terms(text)))
            yield from ((row, item, term) for term in found)

    return map_rows(numbered, f"item_row long, item_id {kind}, term binary", rows, "item_row", "item_id", "text")


def postings(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, doc_key, no_id, n, tid, tf: the terms of ``vocabulary`` (term, tid) that each
    document has, and one row of tid -1 for every document with any term."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                           F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        for row, doc, text in source:
            found = terms(text)
            if not found:
                continue
            count = Counter(found)
            names, times = [b"", *count], [1, *count.values()]
            for lo in range(0, len(names), PIECE):
                yield row, doc, len(found), names[lo:lo + PIECE], times[lo:lo + PIECE]

    read = map_rows(numbered, f"row long, doc_id {kind}, n long, terms array<binary>, tfs array<long>", rows,
                    "row", "doc_id", "text", held_bytes=1 << 22)
    each = read.select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    each = each.select("row", "doc_id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    key = F.coalesce("doc_id", F.lit(0).cast(kind)).alias("doc_key")   # without nulls: exact in numpy
    return each.join(vocabulary, "term").select("row", key, F.col("doc_id").isNull().alias("no_id"), "n", "tid", "tf")


class Index:
    """Impact lists of one block: per term its documents by falling part, and
    by number for direct access."""

    def __init__(self, row: np.ndarray, tid: np.ndarray, part: np.ndarray):
        self.rows, doc = np.unique(row, return_inverse=True)
        self.tids, t = np.unique(tid, return_inverse=True)
        order = np.lexsort((doc, -part, t))
        self.doc, self.part, t = doc[order].astype(np.int32), part[order], t[order]
        self.starts = np.searchsorted(t, np.arange(len(self.tids) + 1))
        by_doc = np.lexsort((self.doc, t))
        self.place = by_doc.astype(np.int32)     # position in the impact order, by (term, document)
        self.sorted_doc = self.doc[by_doc]

    def lists(self, tids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``tids`` the block has, their numbers in it)."""
        at = np.searchsorted(self.tids, tids)
        at[at == len(self.tids)] = 0
        has = np.flatnonzero(self.tids[at] == tids) if len(self.tids) else np.empty(0, np.int64)
        return has, at[has]


def best_positions(index: Index, tids: np.ndarray, weights: np.ndarray, ids: np.ndarray,
                   k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, documents scored) of the block's k best with a score
    above 0; ``ids`` orders documents at equal scores."""
    has, at = index.lists(tids)
    weights = weights[has]
    begin, end = index.starts[at], index.starts[at + 1]
    seen = [np.zeros(b - a, bool) for a, b in zip(begin, end)]
    best = np.zeros(len(at), np.int64)
    met = np.zeros(len(index.rows), bool)
    top_d = top_s = np.empty(0, np.int64)
    scored, step = 0, STEP
    while True:
        # Sorted access: untouched positions at and after each best position.
        read = []
        for i, (a, b) in enumerate(zip(begin, end)):
            lo = int(best[i])
            new = np.flatnonzero(~seen[i][lo:lo + step])
            read.append(index.doc[a + lo + new])
        new = np.unique(np.concatenate(read)) if read else np.empty(0, np.int64)
        new = new[~met[new]]
        met[new] = True
        scored += len(new)
        # Direct access to every list; what it touches is seen.
        score = np.zeros(len(new), np.int64)
        for i, (a, b) in enumerate(zip(begin, end)):
            place = np.searchsorted(index.sorted_doc[a:b], new)
            place[place == b - a] = 0
            hit = index.sorted_doc[a + place] == new
            where = index.place[a + place[hit]]
            score[hit] += weights[i] * index.part[where]
            seen[i][where - a] = True
        new, score = new[score > 0], score[score > 0]
        top_d, top_s = np.concatenate([top_d, new]), np.concatenate([top_s, score])
        keep = np.lexsort((ids[top_d], -top_s))[:k]
        top_d, top_s = top_d[keep], top_s[keep]
        # Best positions, and what a document behind all of them can score.
        bound, done = 0, True
        for i, (a, b) in enumerate(zip(begin, end)):
            rest = seen[i][best[i]:]
            ahead = int(np.argmin(rest)) if len(rest) else 0
            best[i] += len(rest) if len(rest) and rest[ahead] else ahead
            if best[i] < b - a:
                done = False
                bound += int(weights[i]) * int(index.part[a + best[i]])
        if done or len(top_s) == k and bound < top_s[-1]:
            return top_d, top_s, scored
        step *= 2


def search_block(members: pd.DataFrame, asked: pd.DataFrame, k: int) -> tuple[pd.DataFrame, int]:
    """(item_row, row, doc_key, no_id, score of each item's k best of a block;
    documents scored for all items)."""
    out = {"item_row": [], "row": [], "doc_key": [], "no_id": [], "score": []}
    scored = 0
    if len(members) and len(asked):
        index = Index(members["row"].to_numpy(), members["tid"].to_numpy(), members["part"].to_numpy())
        named = members.drop_duplicates("row").sort_values("row", ignore_index=True)
        order = np.empty(len(named), np.int64)   # of documents at equal scores
        order[named.sort_values(["no_id", "doc_key", "row"]).index] = np.arange(len(named))
        for row, wanted in asked.groupby("item_row", sort=False):
            found, score, n = best_positions(index, wanted["tid"].to_numpy(), wanted["weight"].to_numpy(), order, k)
            scored += n
            out["item_row"] += [row] * len(found)
            for c in ("row", "doc_key", "no_id"):
                out[c] += named[c].to_numpy()[found].tolist()
            out["score"] += score.tolist()
    return pd.DataFrame(out), scored


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
                  item_block: int = ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0
    for every row of ``items``."""
    ship_package(docs.sparkSession)
    asked = stored(item_terms(items, item_col, item_text_col), "items")
    vocabulary = stored(asked.select("term").distinct().select("term", F.monotonically_increasing_id().alias("tid")),
                        "vocabulary")
    # a range has a known size, as the written table has: Spark may broadcast their union
    length = docs.sparkSession.range(1).select(F.unhex(F.lit("")).alias("term"), F.lit(-1).cast("long").alias("tid"))
    every = stored(postings(docs, vocabulary.unionByName(length), id_col, text_col), "postings")
    whole = every.filter("tid = -1").agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    n_blocks = max(1, -(-whole["N"] // block))
    n_items = items.count()
    n_asked = max(1, -(-n_items // item_block))
    number = lambda name, value: F.lit(value).cast("long").alias(name)

    df = every.filter("tid >= 0").groupBy("tid").agg(F.count("*").alias("df"))
    weights = df.select("tid", "df", number("n_docs", whole["N"])).selectExpr("tid", f"{WEIGHT} as weight")
    dealt = F.pmod(F.xxhash64("item_row"), F.lit(n_asked)).cast("int").alias("qblock")
    asks = stored(asked.join(vocabulary, "term").join(weights, "tid")
                  .select("item_row", "tid", "weight", dealt), "asks")
    lists = (every.filter("tid >= 0").select("*", number("n_docs", whole["N"]), number("n_terms", max(whole["L"], 1)))
             .selectExpr("row", "doc_key", "no_id", "tid", f"{PART} as part")
             .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")))
    lists = (lists.withColumn("qblock", F.lit(0)) if n_asked == 1
             else lists.join(asks.select("tid", "qblock").distinct().toDF("tid", "qblock"), "tid"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def run(members: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        return search_block(members, wanted, k)[0]

    kind = docs.schema[id_col].dataType.simpleString()
    hits = (lists.groupBy("block", "qblock").cogroup(asks.groupBy("block", "qblock"))
            .applyInPandas(run, f"item_row long, row long, doc_key {kind}, no_id boolean, score long"))
    w = Window.partitionBy("item_row").orderBy(F.col("score").desc(), "no_id", "doc_key", "row")
    best = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    names = asked.select("item_row", "item_id").distinct()
    return best.join(names, "item_row").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("no_id"), F.col("doc_key")).alias("doc_id"), "score")
