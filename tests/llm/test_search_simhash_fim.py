"""Best positions, Golay SimHash and fill-in-middle: against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")

from martlane.llm import bpa, fim, golay

DOCS = "doc_id long, text string, n long, form string, fp long, row long, term string, score long"


def frame(spark, texts, extra=()):
    """Clashing extra columns; ``extra``: further (id, text) rows."""
    rows = [*enumerate(texts), *extra]
    return spark.createDataFrame([(i, t, 9, "x", 8, 7, "y", 6) for i, t in rows], DOCS).repartition(3)


# ---------------------------------------------------------------- fill-in-middle

FIM_TEXTS = ["", None, "one line", "a\nb\nc", "a\nb\nc\n", "\n\n\n", "x\r\ny z\n", "has <M> in it\nb", "<P", "S>\n<",
             "日本\n🙂 é\nlast", "$1\\1 $\n\\", "w " * 500 + "\n", "line\n" * 200_000, "z" * 1_000_000, "a\nb\nc"]


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_plain_version(spark):
    texts = FIM_TEXTS * 4   # other ids: other cuts and forms
    got = fim.fill_in_middle(frame(spark, texts, [(None, "no\nid"), (3, "a\nb\nc")])).collect()
    assert len(got) == len(texts) + 2
    forms = set()
    for r in got:
        text = "no\nid" if r.doc_id is None else texts[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, text)
        assert r.restored == (text or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}
    assert fim.digests(fim.fill_in_middle(frame(spark, texts).filter("false"))).count() == 0


def test_fill_in_middle_rates(spark):
    some = frame(spark, ["a\nb"] * 400)
    forms = Counter(r.form for r in fim.fill_in_middle(some, rate=30, spm=0).collect())
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160


# ------------------------------------------------------------------ Golay SimHash

def test_golay_code_is_perfect_and_keys_meet():
    code = golay.Golay()
    words = np.arange(1 << 23, dtype=np.int64)
    assert (np.bitwise_count(code.error[golay._remainder(words)]) <= 3).all()
    rnd = np.random.default_rng(3)
    for word in rnd.integers(0, 1 << 23, 300):
        near = word ^ np.array([0, 1 << rnd.integers(23), (1 << rnd.integers(23)) ^ (1 << rnd.integers(23))])
        who, index = code.keys(np.append(word, near).astype(np.int64))
        sets = [set(index[who == i].tolist()) for i in range(4)]
        assert all(len(s) in (1, 6) for s in sets)
        assert all(sets[0] & s for s in sets[1:])


def test_linked_fingerprints_share_a_key():
    rnd = np.random.default_rng(4)
    a = rnd.integers(0, 1 << 64, 3000, dtype=np.uint64)
    flip = lambda: np.uint64(1) << rnd.integers(0, 64, 3000).astype(np.uint64)
    keys = []
    for fps in (a, a ^ flip() ^ flip()):
        who, key = golay.fuzzy_keys(fps, golay.Golay())
        keys.append([set(key[who == i].tolist()) for i in range(len(fps))])
    assert all(x & y for x, y in zip(*keys))


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    part = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and part[i] != part[j]:
                part = [part[j] if p == part[i] else p for p in part]
    return part


@pytest.mark.parametrize("bucket", [golay.BUCKET, 2])
def test_simhash_equals_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(golay, "BUCKET", bucket)
    rnd = random.Random(8)
    texts = [None, "", " \t\n", "One", "one", "Two words", "ÀÉ À x b", "a" * 200_000 + " b c"]
    for _ in range(12):
        words = [rnd.choice("abcdefghijklmnop") * rnd.randint(1, 3) for _ in range(rnd.randint(3, 400))]
        texts += [" ".join(words)] * 2
        for _ in range(6):   # variants: one to three words changed
            other = list(words)
            for _ in range(rnd.randint(1, 3)):
                other[rnd.randrange(len(other))] = "new"
            texts.append(" ".join(other))
    texts.append("long " * 150_000)
    extra = [(None, "One"), (None, "none other"), (3, texts[20])]
    got = golay.near_fingerprints(frame(spark, texts, extra)).collect()
    rows = [*enumerate(texts), *extra]
    fps = [plain_fingerprint(t) if len(t or "") < 500_000 else golay.fingerprint(t) for _, t in rows]
    part = plain_components(fps)
    least = {p: min((i for (i, _), q in zip(rows, part) if q == p and i is not None), default=None) for p in set(part)}
    expected = Counter((i, f"{fp:016x}", least[p]) for (i, _), fp, p in zip(rows, fps, part))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected
    assert len({r.component_id for r in got}) < len(set(texts))
    assert golay.near_fingerprints(frame(spark, texts).filter("false")).count() == 0


def test_crowded_keys_give_all_links(spark):
    """Fingerprints around one word: by words within one bit, in a group of any size."""
    rnd = random.Random(9)
    base = rnd.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(400)})
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    part = plain_components(fps)
    found = {x: x for x in signed}
    pairs = [(r.a, r.b) for r in golay.word_links(df).collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in pairs)
    for _ in range(len(signed)):
        before = dict(found)
        for a, b in pairs:
            found[a] = found[b] = min(found[a], found[b])
        if found == before:
            break
    groups = {}
    for x, p in zip(signed, part):
        groups.setdefault(p, set()).add(found[x])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(found.values()))


# ------------------------------------------------------------------ best positions

WORDS = "ab cd E1 F gh ij zz ünï 日本 q r s".split()


def plain_search(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                               re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = [(i, cut(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    N, L = len(texts), sum(len(t) for _, t in texts)
    df = Counter(x for _, t in texts for x in set(t))
    out = []
    for item, text in items:
        scored = []
        for i, t in texts:
            m, tf = 100 - 90 + (90 * len(t) * N) // L, Counter(t)
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m))
                    for x in set(cut(text)) if tf[x])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return Counter(out)


@pytest.mark.parametrize("block, item_block", [(bpa.BLOCK, bpa.ITEMS), (7, 3)])
def test_search_equals_brute_force(spark, block, item_block):
    rnd = random.Random(6)
    docs = [(i, " ".join(rnd.choice(WORDS[:rnd.randint(2, 12)]) for _ in range(rnd.randint(1, 40))) + "!")
            for i in range(60)]
    docs += [(60, None), (61, ""), (62, "--- \n"), (63, "AB-cd_e1\x00f gh"), (5, "repeated id ab"), (None, "no id zz ab"),
             (64, docs[3][1]), (65, docs[3][1]), (66, "ab " * 100_000), (67, " ".join(f"t{i}" for i in range(30_000)))]
    items = [(i, " ".join(rnd.sample(WORDS, rnd.randint(1, 8)))) for i in range(10)]
    items += [(10, None), (11, "unheard of"), (12, "ab ab AB"), (3, "zz q"), (None, "cd")]
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    d = spark.createDataFrame([(i, t, 9, "x", 8, 7, "y", 6) for i, t in docs], DOCS).repartition(3)
    got = bpa.ranked_search(d, asked, 4, block=block, item_block=item_block).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == plain_search(docs, items, 4)


def test_search_of_empty_tables(spark):
    docs = frame(spark, ["ab cd", "ab"])
    asked = spark.createDataFrame([(1, "ab")], "item_id long, text string")
    assert bpa.ranked_search(docs.filter("false"), asked).count() == 0
    assert bpa.ranked_search(docs, asked.filter("false")).count() == 0


def test_reading_stops_early_and_never_at_a_tie():
    rnd = np.random.default_rng(2)
    n = 20_000
    rows = np.concatenate([rnd.permutation(n)[:n // 2] for _ in range(4)])
    tids = np.repeat(np.arange(4), n // 2)
    parts = np.floor(1e6 * rnd.random(len(rows)) ** 8).astype(np.int64)
    index = bpa.Index(rows, tids, parts)
    ids = np.arange(len(index.rows))
    weight = np.array([3, 5, 1, 2])
    total = np.zeros(n, np.int64)
    np.add.at(total, rows, weight[tids] * parts)
    found, score, scored = bpa.best_positions(index, np.arange(4), weight, ids, 10)
    assert index.rows[found].tolist() == np.lexsort((np.arange(n), -total))[:10].tolist()
    assert scored < n // 4
    # equal impacts everywhere: the smallest ids win, so all must be read
    index = bpa.Index(np.arange(500), np.zeros(500, int), np.full(500, 7))
    found, _, scored = bpa.best_positions(index, np.zeros(1, int), np.ones(1, int), np.arange(500)[::-1], 3)
    assert found.tolist() == [499, 498, 497] and scored == 500
