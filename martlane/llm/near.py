"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its distinct shingles of ``width`` words, two for the
op4 query and five for the pipeline's stage (words: runs of other characters
than ASCII white space, A-Z lowered).  Documents with the same set form a
class; the rest works on classes, so copies never multiply.

The forest has ``TREES`` sorted signature orders of ``DEPTH`` hashes each.
Classes that share the first ``LEAST`` hashes of an order form a region.  The
depth adapts per region: one of more than ``REGION`` classes is split by the
next hash, and so on, so a class meets the neighbours with the longest common
prefix, in groups of bounded size however frequent a text is.

1. Every class is paired with its best neighbour per group (by sketch) and
   with the leader of every region above its group.  Pairs whose sketches agree
   in ``AGREE`` of all hashes or more are confirmed on the full sets, and
   confirmed links give components.  At 0.8 similarity, less agreement has a
   chance of about 1 in 100,000, as has sharing no region in any tree.
2. In groups where sketches of different components agree so far, the classes
   concerned are compared on the full sets.
3. Where a region was split, every class outside the region's largest
   component is compared with the whole region, in blocks of ``BLOCK``: by
   sketch, and those that agree on the full sets.  So splitting loses no link
   between components.

A sketch is the lowest byte of every hash of a signature: equal hashes have
equal bytes, so sketches agree at least as far as signatures do.  Full sets are
made, and shipped, only for classes with a pair whose sketches agree.

Links between members of one component do not change the result and are not
all confirmed; ``n_links`` counts the confirmed ones of a document's class.

Defined cases: null and empty texts and texts without words have the empty
set and are linked with nothing; a text of fewer than ``width`` words is one
shingle; repeated rows
and equal sets are linked; rows with a null id take part, and a component
takes the smallest non-null id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import WordCache, discard, join_small, map_rows, stored, together
from martlane.llm.graph import components

WIDTH = 2       # words per shingle of the op4 query
TREES = 14
DEPTH = 6
LEAST = 2
REGION = 64
AGREE = 0.60
BLOCK = 1024
CLASSES = 20_000   # classes, and ...
ROWS = 160_000     # ... rows of trees, groups or pairs, and ...
SETS = 8_000       # ... full sets that a task reads

_rng = np.random.default_rng(11)
_ODD = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (fixed multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_cache() -> WordCache:
    import xxhash
    return WordCache(xxhash.xxh64_intdigest)


def shingles(text: str | None, cache: WordCache, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words; a
    shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    w = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(width, len(w))
    n = len(w) - width + 1
    out = _mix(w[:n])
    for at in range(1, width):
        out = _mix(out + w[at:at + n] * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(out)


def signature(members: np.ndarray) -> np.ndarray:
    """The least of each hash over a set, as 32 bits."""
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(members), 1024):
        least = np.minimum(least, (members[lo:lo + 1024, None] * _ODD + _ADD).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _fingerprint(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _text_key(docs: DataFrame):
    """The text's digest: with the id it tells rows of one id, or of none, apart."""
    return F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))


def document_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id (fingerprint of the set), signature, sketch."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rows(source):
        cache = word_cache()
        for doc, key, text in source:
            members = shingles(text, cache, width)
            least = signature(members)
            yield doc, key, len(members), _fingerprint(members), least.tobytes(), least.astype(np.uint8).tobytes()

    return map_rows(docs.select("doc_id", _text_key(docs).alias("text_key"), "text"),
                    f"doc_id {id_type}, text_key binary, n_shingles long, set_id binary, signature binary, sketch binary",
                    rows, "doc_id", "text_key", "text")


def _tree_rows(classes: DataFrame) -> DataFrame:
    """set_id, and per tree the keys of its first LEAST, LEAST + 1, ... hashes."""
    rows = classes.select("set_id", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    part = lambda d: F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * d})")
    return rows.select("set_id", *(F.xxhash64("tree", part(d)).alias(f"k{d}") for d in range(LEAST, DEPTH + 1)))


def forest(classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """(groups: set_id, grp; leaders: a, b; regions: set_id, region, size; the
    stored tables that regions, the first, and leaders, all, still read).

    ``regions`` holds the members of the regions that were split.
    """
    rows = _tree_rows(classes)
    sizes = rows.groupBy(f"k{LEAST}").agg(F.count("*").alias("size"), F.min("set_id").alias("leader"))
    rows = stored(rows.join(sizes.filter("size > 1"), f"k{LEAST}"), "regions", ROWS)
    whole = rows.filter(F.col("size") > REGION).select("set_id", F.col(f"k{LEAST}").alias("region"), "size")
    groups, leaders, scratch = [], [], [rows]
    for d in range(LEAST, DEPTH + 1):
        if d > LEAST:
            sizes = rows.groupBy(f"k{d}").agg(F.count("*").alias("size"), F.min("set_id").alias("leader"))
            rows = rows.drop("size", "leader").join(sizes, f"k{d}")
        small, large = rows.filter(F.col("size") <= REGION), rows.filter(F.col("size") > REGION)
        groups.append(small.filter("size > 1").select("set_id", F.col(f"k{d}").alias("grp")))
        leaders.append(large.filter("set_id != leader").select(F.col("set_id").alias("a"), F.col("leader").alias("b")))
        if d == DEPTH:  # equal in all hashes of this tree: dealt evenly
            pieces = F.ceil(F.col("size") / F.lit(REGION // 2))
            groups.append(large.select("set_id", F.xxhash64(f"k{d}", F.pmod(F.xxhash64("set_id"), pieces)).alias("grp")))
        rows = stored(large, "regions", ROWS) if d < DEPTH else large
        if d < DEPTH:
            scratch.append(rows)
            if rows.isEmpty():
                break
    return stored(_union(groups), "groups", ROWS), _union(leaders).distinct(), whole, scratch


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _stacked(group: list[tuple], at: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[at] for r in group), np.uint8).reshape(len(group), -1)


def _fits(size: np.ndarray, i: int) -> np.ndarray:
    """Sizes that allow a similarity of 0.8 with row i's."""
    return (5 * size >= 4 * size[i]) & (5 * size[i] >= 4 * size)


def best_pairs(members: DataFrame, small: bool) -> DataFrame:
    """(a, b): every class with the neighbour of its group whose sketch agrees
    most, if far enough; at most one pair per row of ``members``."""
    def rows(source):
        for _, group in groupby(source, key=lambda r: r[0]):
            group = list(group)
            sig, size = _stacked(group, 3), np.array([r[2] for r in group])
            for i in range(len(group)):
                agree = (sig == sig[i]).mean(axis=1) * _fits(size, i)
                agree[i] = 0
                if agree.max() >= AGREE:
                    yield tuple(sorted((bytes(group[i][1]), bytes(group[int(agree.argmax())][1]))))

    return map_rows(together(members, small, "grp"), "a binary, b binary", rows,
                    "grp", "set_id", "n_shingles", "sketch").distinct()


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree far enough and whose sizes allow a link."""
    of = lambda name, s, n: classes.select(F.col("set_id").alias(name), F.col("sketch").alias(s),
                                           F.col("n_shingles").alias(n))
    both = pairs.join(of("a", "s", "n"), "a").join(of("b", "t", "m"), "b").filter("5 * n >= 4 * m and 5 * m >= 4 * n")

    def rows(source):
        for a, b, s, t in source:
            if (np.frombuffer(s, np.uint8) == np.frombuffer(t, np.uint8)).mean() >= AGREE:
                yield a, b

    return map_rows(both, "a binary, b binary", rows, "a", "b", "s", "t")


def undecided(members: DataFrame, small: bool) -> DataFrame:
    """Rows of ``members`` (grp, side, set_id, n_shingles, sketch, component)
    whose sketch agrees enough with one of another component in their group,
    where one of the two is of side 0."""
    def rows(source):
        for _, group in groupby(source, key=lambda r: r[0]):
            group = list(group)
            comp = _numbers([r[5] or r[2] for r in group])
            if comp.max() == 0:
                continue
            sig, size = _stacked(group, 4), np.array([r[3] for r in group])
            found = np.zeros(len(group), bool)
            for i, r in enumerate(group):
                if r[1] == 0:
                    may = np.flatnonzero((comp != comp[i]) & _fits(size, i))
                    near = may[(sig[may] == sig[i]).mean(axis=1) >= AGREE] if len(may) else may
                    found[near] = True
                    found[i] |= len(near) > 0
            for i in np.flatnonzero(found).tolist():
                grp, side, set_id, _, _, component = group[i]
                yield grp, side, set_id, bytes(component or set_id)

    return map_rows(together(members, small, "grp"), "grp long, side int, set_id binary, component binary", rows,
                    "grp", "side", "set_id", "n_shingles", "sketch", "component")


def _numbers(keys: list) -> np.ndarray:
    seen: dict = {}
    return np.array([seen.setdefault(k, len(seen)) for k in keys])


def exact_links(rows_: DataFrame, sets: DataFrame, small: bool) -> DataFrame:
    """(a, b): links between different components of each group (grp, side,
    set_id, component), on the full sets.  Members of side 0 meet the whole
    group.  Of the links of a group those are returned that join what the ones
    before have not joined, so a group of n classes gives at most n - 1."""
    def rows(source):
        for _, group in groupby(source, key=lambda r: r[0]):
            group = list(group)
            parent = list(range(len(group)))

            def root(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            first: dict = {}
            for i, r in enumerate(group):
                parent[i] = first.setdefault(bytes(r[3]), i)
            members = [np.frombuffer(r[4], np.uint64) for r in group]
            size = np.array([len(m) for m in members])
            item, owner = np.concatenate(members), np.repeat(np.arange(len(group)), size)
            order = np.argsort(item, kind="stable")
            item, owner = item[order], owner[order]
            for i, r in enumerate(group):
                if r[1] != 0:
                    continue
                lo, hi = np.searchsorted(item, members[i], "left"), np.searchsorted(item, members[i], "right")
                count = hi - lo
                at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
                common = np.bincount(owner[at], minlength=len(group))
                for j in np.flatnonzero(100 * common >= 80 * (size + size[i] - common)).tolist():
                    x, y = root(i), root(j)
                    if x != y:
                        parent[x] = y
                        yield tuple(sorted((bytes(r[2]), bytes(group[j][2]))))

    ordered = together(rows_.join(sets, "set_id"), small, "grp", "side", "set_id")
    return map_rows(ordered, "a binary, b binary", rows, "grp", "side", "set_id", "component", "members").distinct()


def full_sets(needed: DataFrame, docs: DataFrame, classes: DataFrame, width: int = WIDTH) -> DataFrame:
    """set_id, members (sorted 64-bit hashes as bytes), made anew from one
    text of each class."""
    needed = (needed.select("set_id").distinct().join(classes.select("set_id", "rep"), "set_id")
              .select("set_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")))
    texts = docs.select("doc_id", _text_key(docs).alias("text_key"), "text")
    texts = needed.join(texts, needed["rep_id"].eqNullSafe(texts["doc_id"])
                        & (needed["rep_key"] == texts["text_key"])).select("set_id", "text")

    def rows(source):
        cache = word_cache()
        for set_id, text in source:
            members = shingles(text, cache, width)
            if _fingerprint(members) == bytes(set_id):
                yield set_id, members.tobytes()

    made = stored(map_rows(texts, "set_id binary, members binary", rows, "set_id", "text"), "full-sets", SETS)
    # Only rows that repeat their representative's id and text make a set again;
    # without any, the sets need no shuffle.
    n = made.agg(F.count("*"), F.countDistinct("set_id")).first()
    if n[0] == n[1]:
        return made
    sets = stored(made.dropDuplicates(["set_id"]), "full-sets", SETS)
    discard(made)
    return sets


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets have 100 * common >= 80 * union."""
    both = (pairs.join(sets.select(F.col("set_id").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("members").alias("y")), "b"))

    def rows(source):
        for a, b, x, y in source:
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int((y[at] == x).sum())
            if 100 * common >= 80 * (len(x) + len(y) - common):
                yield a, b

    return map_rows(both, "a binary, b binary", rows, "a", "b", "x", "y")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_id, n_links."""
    return _decided(docs, width).drop("text_key", "component")


def _decided(docs: DataFrame, width: int) -> DataFrame:
    """The same with every row's text_key and component (the set_id that names it)."""
    every = stored(document_sets(docs, width), "sets", CLASSES)
    classes = stored(every.filter("n_shingles > 0").groupBy("set_id")
                     .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("rep"),
                          F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
                          F.first("sketch").alias("sketch"), F.count("*").alias("n_rows")), "classes", CLASSES)
    groups, leaders, split, scratch = forest(classes)
    sketches = classes.select("set_id", "n_shingles", "sketch")
    members = stored(groups.join(sketches, "set_id"), "members", ROWS)
    discard(groups)
    above = leaders.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(best_pairs(members, members.small).unionByName(agreeing(above, classes)).distinct(), "pairs", ROWS)
    discard(*scratch[1:])
    ends = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select("b"))
    sets = full_sets(ends, docs, classes, width)
    links = stored(confirmed(pairs, sets), "links", ROWS)
    found = components(links)
    named = lambda: found.select(F.col("node").alias("set_id"), "component")

    # What still connects different components: in the groups, then in split
    # regions.  Whatever agrees with another class in its group has a pair, so
    # its full set is there; in split regions it may not be.
    rows = stored(undecided(members.withColumn("side", F.lit(0)).join(named(), "set_id", "left"), members.small),
                  "undecided", SETS)
    discard(members, pairs)
    if not rows.isEmpty():
        links, found = _with_more(links, found, exact_links(rows, sets, rows.small))
    discard(rows)
    if not split.isEmpty():
        blocks = stored(_blocks(split, named()).join(sketches, "set_id"), "blocks", ROWS)
        rows = stored(undecided(blocks, blocks.small), "undecided", SETS)
        discard(blocks)
        if not rows.isEmpty():
            rest = full_sets(rows.join(sets, "set_id", "left_anti"), docs, classes, width)
            links, found = _with_more(links, found, exact_links(rows, sets.unionByName(rest), rows.small))
            discard(rest)
        discard(rows)
    discard(sets, scratch[0])
    return _labelled(every, classes, links, found)


def _with_more(links: DataFrame, found: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``links`` and ``more``, and their components in place of ``found``."""
    both = stored(links.unionByName(more), "links", ROWS)
    discard(links, found)
    return both, components(both)


def _blocks(split: DataFrame, comp: DataFrame) -> DataFrame:
    """Split regions in blocks: members outside the region's largest component
    (side 0) beside every part of the region (side 1)."""
    rows = stored(split.join(comp, "set_id", "left")
                  .withColumn("component", F.coalesce("component", "set_id")), "split", ROWS)
    counts = rows.groupBy("region", "component").agg(F.count("*").alias("n"))
    main = (counts.groupBy("region").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
            .select("region", F.col("top.component").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("rest")))
    rows = rows.drop("size").join(main.filter("rest > 0"), "region")
    parts, asks = F.ceil(F.col("all") / BLOCK).cast("int"), F.ceil(F.col("rest") / BLOCK).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    mine = lambda n: F.pmod(F.xxhash64("set_id"), n).cast("int")
    whole = rows.select("set_id", "component", "region", mine(parts).alias("p"), spread(asks).alias("q"),
                        F.lit(1).alias("side"))
    asked = rows.filter("component != main").select("set_id", "component", "region", spread(parts).alias("p"),
                                                    mine(asks).alias("q"), F.lit(0).alias("side"))
    return (whole.unionByName(asked).withColumn("grp", F.xxhash64("region", "p", "q"))
            .select("grp", "side", "set_id", "component"))


def _labelled(every: DataFrame, classes: DataFrame, links: DataFrame, found: DataFrame) -> DataFrame:
    """Classes get their component's id, rows that of their class: neither a
    large component nor a frequent text gathers in one task."""
    degree = (links.select(F.col("a").alias("set_id")).unionAll(links.select("b"))
              .groupBy("set_id").agg(F.count("*").alias("n_links")))
    ids = classes.select("set_id", F.col("rep.doc_id").alias("own"), "n_rows")
    linked = stored(found.withColumnRenamed("node", "set_id").join(ids.select("set_id", "own"), "set_id"),
                    "linked", ROWS)
    least = stored(linked.groupBy("component").agg(F.min("own").alias("least"), F.count("*").alias("size")),
                   "least", ROWS)
    linked = join_small(linked, least, "component", "size").select("set_id", "component", "least")
    named = stored(ids.join(linked, "set_id", "left").join(degree, "set_id", "left").select(
        "set_id", "n_rows", F.coalesce("component", "set_id").alias("component"),
        F.when(F.col("component").isNotNull(), F.col("least")).otherwise(F.col("own")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links")), "named", ROWS)
    rows = every.select("doc_id", "text_key", "set_id", "n_shingles")
    some = join_small(rows.filter("n_shingles > 0"), named, "set_id", "n_rows")
    none = rows.filter("n_shingles = 0").select("*", F.lit(0).cast("long").alias("n_rows"), F.col("set_id").alias("component"),
                                                F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"),
        F.hex("set_id").alias("set_id"), "n_links", "text_key", "component")


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` (all columns) whose id is the smallest of their own
    component, one per component: where several texts of it have this id, the
    one with the smallest set and text digest.  So different texts with one id
    are judged apart.  Rows without words are linked with nothing and stay, one
    per id.  Rows without an id stay."""
    kept = (_decided(docs, width).filter("kept").groupBy("component", "doc_id")
            .agg(F.min(F.struct("set_id", "text_key")).alias("first"))
            .select(F.col("doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")))
    key = "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    named = docs.join(kept, (docs["doc_id"] == kept["kept_id"]) & (_text_key(docs) == kept["kept_key"]), "left_semi")
    named = named.withColumn(key, _text_key(named)).dropDuplicates(["doc_id", key]).drop(key)
    return named.unionByName(docs.filter("doc_id is null"))
