"""Exact top-k by an impact-ordered index, score at a time.

Vectors are integer impacts.  Per component the index holds the rows ordered
by impact, so that the rows of one impact are a posting segment.  A query
turns the impacts of a component into contributions (query value times
impact, less the component's smallest, so none is negative) and takes the
segments of all components in falling order of contribution, a band of
contributions at a time, adding to one accumulator per row; a component of
which a band takes a large part is taken whole, as a column.  An accumulator
is a lower bound of its row's score; what its unseen components can still add
is bounded by the largest contribution not yet taken.

Processing stops only on proof: rows whose upper bound is below the k-th
largest lower bound, or below the k-th best score of the first block (which
every later block is given), cannot be members; once the possible members are
few, they, and only they, are scored again exactly from the vectors.  Where the
bounds never separate, all segments are taken and the result is exact too.
Where contributions could add up to 2^36 or more, too large for an accumulator
that also counts components exactly in double precision, all rows are scored from the vectors instead.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without an id (zero vectors do take
part); vectors meet only vectors with as many components; ties go to the
smaller id; a repeated row is a candidate of its own (only the query's own
row is left out); fewer candidates than k give all; an empty table gives an
empty result.  Impacts and scores must fit 64-bit integers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from martlane.llm.vectors import NO_FLOOR, best, search

# Lower edges of the contribution bands, as parts of the largest contribution.
BANDS = (0.085, 0.04, 0.0)
FIRST = 1024  # rows of the first block that are scored at once for a first floor
MOST = 0.3  # a component of which a band takes so large a part is taken whole
FEW = 0.3  # possible members are scored again once they are so small a part


def search_block(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
                 rows: np.ndarray, k: int, floors: np.ndarray):
    """(query position, vector position, score) of each query's k best."""
    queries, vectors = queries.astype(np.int64), vectors.astype(np.int64)
    n, dims = vectors.shape
    order = np.argsort(vectors, axis=0, kind="stable").T.copy()          # rows by impact, per component
    impact = np.take_along_axis(vectors.T, order, axis=1)
    packed = impact * 65536.0
    columns = (vectors.T - impact[:, :1]).astype(np.float64)             # above the component's least impact
    own = {int(r): i for i, r in enumerate(rows)}
    few = max(4 * k, int(FEW * n))
    room = np.empty(n * dims, np.intp), np.empty(n * dims)
    # products of these are whole numbers below 2^53: exact in double precision, and faster
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * dims
    exact = vectors.astype(np.float64) if largest < 2.0**53 else vectors
    out_q, out_v, out_s = [], [], []
    for i, query in enumerate(queries):
        mine = own.get(int(query_rows[i]), -1)
        floor = int(floors[i])
        if floor == NO_FLOOR and k < FIRST < n:     # the k-th best of some rows is a floor for all
            some = (exact[:FIRST] @ query.astype(exact.dtype)).astype(np.int64)
            if 0 <= mine < FIRST:
                some = np.delete(some, mine)
            floor = int(np.partition(some, len(some) - k)[len(some) - k])
        possible = _possible(query, order, impact, packed, columns, mine, k, few, floor, room)
        scores = (exact[possible] @ query.astype(exact.dtype)).astype(np.int64)
        enough = scores >= floor
        possible, scores = possible[enough], scores[enough]
        pick = best(np.zeros(len(possible), np.int64), possible, scores, ids, k)
        out_q.append(np.full(len(pick), i))
        out_v.append(possible[pick])
        out_s.append(scores[pick])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _possible(query: np.ndarray, order: np.ndarray, impact: np.ndarray, packed: np.ndarray, columns: np.ndarray,
              mine: int, k: int, few: int, floor: int, room: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows that may be among the k best of the others than ``mine`` and score
    ``floor`` or more."""
    dims, n = order.shape
    others = n - (mine >= 0)
    everyone = np.arange(n)
    if others <= max(k, few):
        return everyone[everyone != mine]
    ends = np.stack([query * impact[:, 0], query * impact[:, -1]])
    least, most = ends.min(axis=0), ends.max(axis=0)
    live = np.flatnonzero(most > least)              # other components add the same to all
    reach = most - least
    if float(np.abs(reach.astype(float)).sum()) >= 2.0**36 or dims >= 1 << 16:
        return everyone[everyone != mine]            # too large for the packed accumulators
    # Contribution sum in the upper bits, number of components seen in the lower 16.
    floor -= int(least.sum())                        # as a sum of contributions
    acc = np.zeros(n, np.int64)
    segment_rows, segment_adds = room                # a band's postings
    taken = np.zeros(dims, np.int64)                 # postings taken so far, per component
    largest = int(reach.max(initial=0))
    # The contribution that a part of MOST of a component's postings reaches.
    last = int((1 - MOST) * n)
    usual = np.where(query > 0, query * impact[:, last], query * impact[:, n - 1 - last]) - least
    for band in BANDS:
        edge = int(band * largest)
        size = 0
        following = bound = 0                        # largest contribution left; sum over components
        whole = (most > least) & (taken == 0) & (usual >= edge)
        if whole.any():
            # sums below 2^36: exact in double precision
            adds = np.where(whole, query, 0).astype(np.float64) @ columns
            acc += (adds.astype(np.int64) + int(reach[whole & (query < 0)].sum())) * 65536 + int(whole.sum())
            taken[whole] = n
        for d in np.flatnonzero((most > least) & (taken < n)):
            w = int(query[d])
            # contribution w * x - least >= edge, as a run of the impact order
            if w > 0:
                first = int(np.searchsorted(impact[d], -(-(edge + int(least[d])) // w), side="left"))
                run = slice(first, n - int(taken[d]))
                taken[d] = max(taken[d], n - first)
                rest = w * int(impact[d, first - 1]) - int(least[d]) if first else 0
            else:
                after = int(np.searchsorted(impact[d], (edge + int(least[d])) // w, side="right"))
                run = slice(int(taken[d]), after)
                taken[d] = max(taken[d], after)
                rest = w * int(impact[d, after]) - int(least[d]) if after < n else 0
            if run.stop > run.start:
                upto = size + run.stop - run.start
                segment_rows[size:upto] = order[d, run]
                np.multiply(packed[d, run], w, out=segment_adds[size:upto])
                segment_adds[size:upto] += 1 - (int(least[d]) << 16)
                size = upto
            following = max(following, rest)
            bound += rest
        acc += np.bincount(segment_rows[:size], segment_adds[:size], n).astype(np.int64)
        lower = acc >> 16
        if mine >= 0:
            lower[mine] = -1
        kth = max(int(np.partition(lower, n - k)[n - k]), floor)
        upper = lower + np.minimum((len(live) - (acc & 0xFFFF)) * following, bound)
        may = upper >= kth
        if mine >= 0:
            may[mine] = False
        if may.sum() <= few or band == 0.0:
            return np.flatnonzero(may)
    return everyone[everyone != mine]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the exact k best by inner product of
    floor(scale * component), for each row that ``is_query`` (a condition on
    ``id``) picks, against all rows."""
    impacts = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    return search(vectors, k, is_query, id_col, vector_col, True, impacts, search_block, "long")
