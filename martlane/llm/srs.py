"""Approximate nearest neighbours by low-dimensional stable projections.

A Gaussian (2-stable) projection to m dimensions turns a distance d into
d * sqrt(chi-square with m degrees of freedom).  The projected points of a
block are indexed by a kd-tree.  A query opens the leaves whose box is near
enough, meets the points in them in growing order of projected distance and
verifies them with the original vectors, some at a time.  It stops when the
chi-square test holds: with r the projected distance of the next point and d_k
the k-th best verified distance, a vector nearer than d_k would have been met
already with probability chi2_m(r^2 / d_k^2) >= ``confidence``.  The k-th best
score of the first block is a floor for all others, so these start with a test.

Largest inner product becomes nearest distance by one more component: with M
the largest norm of the block, x gets sqrt(M^2 - |x|^2) and a query gets 0;
then |q'-x'|^2 = |q|^2 + M^2 - 2 q.x.  Reported scores are inner products of
the original vectors in double precision.

Every row is indexed; blocks are of bounded size and searched independently,
so each block's test holds by itself.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id; vectors meet only vectors
with as many components; ties go to the smaller id; a repeated row is a
candidate of its own (only the query's own row is left out); fewer candidates
than k give all; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from martlane.llm.vectors import NO_FLOOR, best, search

PROJECTED = 24
LEAF = 64
CONFIDENCE = 0.85
WAVE = 256   # points verified before the first test; doubled each time
CHUNK = 64   # queries whose projected distances are held at a time


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square with m degrees of freedom <= x) = p, by bisection."""
    def below(x):  # regularised lower incomplete gamma, by its series
        a, x = m / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a))

    lo, hi = 1e-9, 10.0 * m + 100
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def kd_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(order of the points, leaves as slices of it): median splits along the
    widest dimension until a leaf holds at most ``leaf`` points."""
    order = np.arange(len(points))
    leaves, todo = [], [(0, len(points))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            leaves.append((lo, hi))
            continue
        part = points[order[lo:hi]]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        mid = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(part[:, axis], mid)]
        todo += [(lo, lo + mid), (lo + mid, hi)]
    return order, leaves


def search_block(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
                 rows: np.ndarray, k: int, floors: np.ndarray, m: int = PROJECTED, confidence: float = CONFIDENCE,
                 met: list | None = None):
    """(query position, vector position, inner product) of the k found per
    query; ``met`` takes the number of vectors verified for each."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    top = norms.max()
    lifted = np.sqrt(np.maximum(top - norms, 0))
    axes = np.random.default_rng(7).standard_normal((vectors.shape[1] + 1, m))
    points = vectors @ axes[:-1] + lifted[:, None] * axes[-1]
    order, leaves = kd_tree(points, LEAF)
    points, sorted_vectors = points[order], vectors[order]
    low = np.stack([points[a:b].min(axis=0) for a, b in leaves])
    high = np.stack([points[a:b].max(axis=0) for a, b in leaves])
    leaf_of = np.empty(len(points), np.int32)
    for i, (a, b) in enumerate(leaves):
        leaf_of[a:b] = i
    point_square = np.einsum("ij,ij->i", points, points)
    own = {int(r): i for i, r in enumerate(rows)}
    own_at = np.array([own.get(int(r), -1) for r in query_rows])
    square = np.einsum("ij,ij->i", queries, queries)
    stop = chi_square_quantile(confidence, m)
    reach = lambda i, score: stop * max(square[i] + top - 2 * score, 1e-300)
    out_q, out_v, out_s = [], [], []
    for lo in range(0, len(queries), CHUNK):
        asked = queries[lo:lo + CHUNK] @ axes[:-1]
        box = np.square(np.maximum(np.maximum(low - asked[:, None], asked[:, None] - high), 0)).sum(axis=2)
        away = np.maximum(np.square(asked).sum(axis=1)[:, None] + point_square - 2 * (asked @ points.T), 0)
        for i in range(lo, min(lo + CHUNK, len(queries))):
            # leaves, then points, within the distance that the floor allows
            radius = reach(i, floors[i]) if floors[i] > NO_FLOOR else np.inf
            near = np.flatnonzero((box[i - lo] <= radius)[leaf_of] & (away[i - lo] < radius))
            near = near[np.argsort(away[i - lo, near], kind="stable")]
            far = away[i - lo, near]
            kept, scores, at, wave = np.empty(0, np.int64), np.empty(0), 0, max(WAVE, k + 1)
            while at < len(near):
                if len(kept) == k and far[at] >= reach(i, scores.min()):
                    break
                new = near[at:at + wave]
                at, wave = at + wave, 2 * wave
                score = sorted_vectors[new] @ queries[i]
                least = max(scores.min() if len(kept) == k else -np.inf, floors[i])
                # slack for rounding: what may tie or win is scored again below
                new = order[new[score >= least - 1e-9 * (1 + abs(least))]] if np.isfinite(least) else order[new]
                new = new[new != own_at[i]]
                both = np.concatenate([kept, new])
                score = np.concatenate([scores, np.einsum("ij,j->i", vectors[new], queries[i])])
                pick = best(np.zeros(len(both), np.int64), both, score, ids, k)
                kept, scores = both[pick], score[pick]
            if met is not None:
                met.append(min(at, len(near)))
            out_q.append(np.full(len(kept), i))
            out_v.append(kept)
            out_s.append(scores)
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row that
    ``is_query`` (a condition on ``id``) picks, against all rows."""
    return search(vectors, k, is_query, id_col, vector_col, False, F.col("v"), search_block, "double")
