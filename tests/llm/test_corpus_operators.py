"""Near copies, repeated substrings, searches, classifiers, pipeline: brute force on small inputs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from martlane.llm import bwt, impact, near, repeats, srs

rnd = random.Random(3)
WORDS = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(2, 9))) for _ in range(400)]


def prose(n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def edited(text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rnd.randrange(len(w))] = "zz%d" % rnd.randint(0, 99)
    return " ".join(w)


def corpus():
    passages, base = [prose(60) for _ in range(4)], prose(150)
    texts = [prose(rnd.randint(1, 150)) for _ in range(40)]
    for _ in range(80):
        p = rnd.choice(passages)[rnd.randint(0, 60):][:rnd.randint(150, 260)]
        texts.append(prose(rnd.randint(0, 40)) + p + prose(rnd.randint(0, 20)))
    texts += [edited(base, rnd.randint(0, 25)) for _ in range(160)]
    texts += [base, base, "a" * 900, "ab" * 150, "", None, "one", "ONE", " \t\n", "x y", "X  y", "é" * 130]
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "k", 7) for i, t in enumerate(texts)],
                                 "doc_id long, text string, size string, tid int").repartition(5)


@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = corpus()
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    got = {r.doc_id: r for r in repeats.remove_repeats(frame(spark, texts)).collect()}
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw) + 1, int)
        for at in range(len(raw) - 199):
            if count[raw[at:at + 200]] > 1:
                gone[at:at + 200] = 1
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int(((gone[1:] == 0) & (gone[:-1] == 1)).sum())
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(raw), int(gone.sum()), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_merged_transforms_give_the_order_of_all_suffixes():
    strings = [np.array([rnd.randint(1, 3) for _ in range(rnd.randint(1, 12))]) for _ in range(60)]
    shards = [bwt.shard(strings[lo:lo + 16], 6) for lo in range(0, 60, 16)]
    interleave, common = bwt.merge([s[0] for s in shards], 6)
    at, seen = [0] * len(shards), []
    for s in interleave:
        _, number, position = shards[s]
        string = [*strings[16 * s + number[at[s]]].tolist(), 0]
        p = position[at[s]]
        seen.append(([*string[p:], *string[:p]] * 7)[:6])
        at[s] += 1
    assert seen == sorted(seen)
    for a, b, lcp in zip(seen, seen[1:], common[1:]):
        assert lcp == next((i for i in range(6) if a[i] != b[i]), 6)


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else []))
    comp = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    return sets, comp


@pytest.mark.parametrize("region", [64, 6])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(near, "REGION", region)
    texts = corpus()
    sets, comp = brute_components(texts)
    for r in near.near_duplicates(frame(spark, texts)).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), comp[r.doc_id]), texts[r.doc_id]
        assert r.kept == (r.doc_id == comp[r.doc_id])
    kept = near.keep_one(frame(spark, texts))
    assert {r.doc_id for r in kept.collect()} == set(comp) and kept.columns == ["doc_id", "text", "size", "tid"]


def five_word_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    return comp


def test_near_stage_takes_five_words(spark):
    import corpus_pipeline
    base = prose(150)
    texts = corpus() + [edited(base, n) for n in range(8) for _ in range(3)] + ["a b c d", "A b  c d", "a b c", "a b c d e"]
    comp = five_word_components(texts)
    assert set(comp) != set(brute_components(texts)[1])
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, texts), "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(comp))


def test_near_rows_that_share_or_lack_an_id(spark, monkeypatch):
    base, one, two, bare = prose(120), prose(100), prose(100), prose(100)
    rows = [(1, base), (2, one), (2, two), (2, edited(base, 1)), (3, bare), (3, edited(bare, 1)), (4, one + " x"),
            (5, ""), (5, None), (6, " "), (7, two), (7, two.encode().upper().decode()), (8, prose(90)), (8, None)]
    rows += [(None, edited(base, 1)) for _ in range(30)] + [(None, None), (None, "x")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, text_key string").repartition(3)
    joined, map_rows = [], near.map_rows

    def counted(df, schema, *args, **more):
        if schema == "set_id binary, members binary":
            joined.append((df.count(), df.select("set_id").distinct().count()))
        return map_rows(df, schema, *args, **more)

    monkeypatch.setattr(near, "map_rows", counted)
    got = near.keep_one(docs)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    assert Counter(got)[(3, bare)] + Counter(got)[rows[5]] == 1
    named = Counter((i, t or "") for i, t in got if i is not None and i != 3)
    assert named == Counter([(1, base), (2, one), (2, two), (5, ""), (6, " "), (8, rows[12][1]), (8, "")])
    assert sum(i is None for i, _ in got) == 32
    # equal rows may meet their class more than once; different texts never do
    assert joined and all(n - classes <= len(rows) - len(set(rows)) for n, classes in joined)


def test_empty_tables(spark):
    none = frame(spark, ["a"]).filter("false")
    assert near.near_duplicates(none).count() == 0 and repeats.remove_repeats(none).count() == 0


def vectors(spark, n=300):
    g = np.random.default_rng(1)
    v = g.normal(size=(n, 16))
    v[50:90] = v[50]                                    # one very common vector
    rows = [(i, x.tolist(), "r") for i, x in enumerate(v)]
    rows += [(900, None, "r"), (901, [0.0] * 16, "r"), (902, [float("nan")] * 16, "r"), (903, [None] * 16, "r"),
             (905, [], "r"), (None, [1.0] * 16, "r"), (906, [1.0, 2.0], "r"), (40, v[40].tolist(), "again")]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string")


@pytest.mark.parametrize("block", [8192, 64])
def test_searches_against_brute_force(spark, monkeypatch, block):
    from pyspark.sql import functions as F
    rows, df = vectors(spark)
    found = {}
    monkeypatch.setattr(srs, "search", lambda *a: _search(*a, block=block, query_block=7))
    monkeypatch.setattr(impact, "search", lambda *a: _search(*a, block=block, query_block=7))
    for name, out, change, zero in (("srs", srs.nearest(df, F.col("id") % 20 == 0), lambda x: x, False),
                                    ("impact", impact.top_k(df, F.col("id") % 20 == 0), lambda x: np.floor(64 * x), True)):
        usable = [(k, i, change(np.array(v, float))) for k, (i, v, _) in enumerate(rows)
                  if i is not None and v and None not in v and np.isfinite(v).all() and (zero or np.any(v))]
        want = Counter()
        for k, i, v in usable:
            if i % 20 == 0:
                others = sorted((-float(v @ w), j) for m, j, w in usable if m != k and len(w) == len(v))[:20]
                want.update((i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(others))
        got = Counter((r.query_id, r.rank, r.vec_id, round(float(r.score), 9)) for r in out.collect())
        hit = sum((got & want).values())
        found[name] = hit / sum(want.values())
        assert sum(got.values()) == sum(want.values())
    assert found["impact"] == 1.0 and found["srs"] >= 0.9


def _search(*args, **sizes):
    from martlane.llm.vectors import search
    return search(*args, **sizes)


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_on_held_out_rows(spark, name):
    from martlane.llm import quality, toxicity
    from martlane.llm.common import table
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    out = (quality if name == "quality" else toxicity).classify(docs, labels)
    got = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 30 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r[name] for r in got]) >= 0.9
    # null and empty texts, other columns, no labels at all
    odd = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "x " * 30000, "c")], "doc_id long, text string, score string")
    few = (quality if name == "quality" else toxicity).classify(odd, labels.filter("false")).collect()
    assert len(few) == 3 and all(0 <= r.score <= 1 for r in few)


def test_learnt_terms_count_every_text_that_is_no_near_copy(spark):
    from martlane.llm import toxicity
    # Every text shares the words "alongword" and "anotherlongword"; copies of one toxic text are one text.
    shared = "alongword anotherlongword "
    toxic = [(i, shared + f"blargh {prose(8)}", 1) for i in range(12)]
    copied = [(100 + i, shared + "copycat " + WORDS[0] + " " + " ".join(WORDS[20:60]), 1) for i in range(30)]
    clean = [(200 + i, shared + prose(9), 0) for i in range(120)]
    rows = toxic + copied + clean
    terms = []
    for seed in (1, 2):
        some = rows[:]
        random.Random(seed).shuffle(some)
        df = spark.createDataFrame(some, "doc_id long, text string, label int").repartition(seed + 2)
        terms.append(toxicity.learnt_terms(df))
    assert terms[0] == terms[1]
    assert "blargh" in terms[0] and "copycat" not in terms[0]


def test_pipeline_stages(spark):
    import corpus_pipeline
    from martlane.llm.common import stored, table
    docs = table(spark, SF_SMALL, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF_SMALL), "stage")
        assert out.columns == docs.columns
        docs = out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] // 2
    ids = {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).select("doc_id").collect()}
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_decisions_equal_plain_versions(spark):
    import zlib
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer
    from pyspark.sql import functions as F
    from martlane.llm import quality, toxicity
    from martlane.llm.common import stored, table
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    base = prose(150)
    texts = corpus() + [edited(base, n) for n in range(8) for _ in range(3)]
    more = frame(spark, texts).select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text")
    more = docs.limit(1).drop("doc_id", "text").crossJoin(more).withColumn("n_chars", F.length("text"))
    docs = stored(docs.unionByName(more.select(*(F.col(c).cast(docs.schema[c].dataType) for c in docs.columns))), "docs")
    stages = dict(corpus_pipeline.STAGES)

    def read(df):
        got = {r.doc_id: r.text for r in df.collect()}
        assert len(got) == df.count()
        return dict(sorted(got.items()))

    for name, model in (("toxicity", toxicity), ("quality classifier", quality)):
        bad = 1 if name == "toxicity" else 0
        out = {r.doc_id for r in model.classify(docs, labels).collect() if r.predicted == bad}
        kept = stored(stages[name](spark, docs, SF_MID), "kept")
        assert out and read(kept) == {i: t for i, t in read(docs).items() if i not in out}
        docs = kept

    docs = stored(docs.filter("doc_id % 8 = 0 or doc_id >= 10000000"), "some")  # brute force from here on
    before = read(docs)
    comp = five_word_components(list(before.values()))
    docs = stored(stages["MinHash near-dedup"](spark, docs, SF_MID), "kept")
    after = read(docs)
    assert after == {i: t for k, (i, t) in enumerate(before.items()) if comp[k] == k} and len(after) < len(before)

    raws = {i: (t or "").encode() for i, t in after.items()}
    count = Counter(r[k:k + 200] for r in raws.values() for k in range(len(r) - 199))
    want = {}
    for i, raw in raws.items():
        gone = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if count[raw[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        rest = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        want[i] = after[i] if after[i] is None else rest
    docs = stored(stages["suffix-array dedup"](spark, docs, SF_MID), "kept")
    assert read(docs) == want != after

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, places = Counter(), {}
    for i, text in want.items():
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], np.uint32)
        pieces.update((i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes()))
                      for k in range(0, len(ids), 2048))
    rows = stages["best-fit packing"](spark, docs, SF_MID).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(members)])]
        assert [o for o, _ in sorted(members)] == ends[:-1] and ends[-1] <= 2048
