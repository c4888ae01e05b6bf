"""Empty tables, very long texts, null and repeated ids through repeats, near copies, chat and the pipeline."""

import hashlib
import random
from collections import Counter

import pytest

from conftest import SF_SMALL
from martlane.llm import chat, near, repeats

rnd = random.Random(12)
WORDS = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def test_pipeline_of_an_empty_table(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    docs = frame(spark, [(1, "x")]).filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns


def test_repeats_in_very_long_texts_and_with_null_and_repeated_ids(spark):
    passage = prose(80)
    assert 200 < len(passage) < 1000
    long = prose(150_000)
    rows = [(1, long), (2, prose(50) + " | " + passage + " | " + prose(50)), (None, passage + " # " + prose(30)),
            (None, prose(90)), (3, prose(90)), (3, "\1" + long[500_000:500_400] + "\2"), (4, None), (4, "")]
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    per = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in got)
    assert per[1, len(long), 400, 1] == 1
    assert per[2, len(rows[1][1]), len(passage), 1] == 1 or per[2, len(rows[1][1]), len(passage) + 1, 1] == 1
    assert per[3, 402, 400, 1] == 1 and per[4, 0, 0, 0] == 2
    kept = {r.kept_sha256 for r in got if r.n_bytes == len(long)}
    assert kept == {hashlib.sha256((long[:500_000] + long[500_400:]).encode()).hexdigest()}
    cut = repeats.cut_texts(frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in cut) == Counter(i for i, _ in rows)
    by_length = {r.n_chars: r.text for r in cut if r.text}
    assert all(n == len(t) for n, t in by_length.items())
    assert sum(r.text is None for r in cut) == 1


def test_copies_of_a_text_lose_all_windows_and_others_meet_them_once(spark):
    text, other = prose(100), prose(100)
    rows = [(i, text) for i in range(40)] + [(100, "begin\1" + text[:300] + "\2end"), (101, other), (102, "short"), (103, "short")]
    got = {r.doc_id: r for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert all(got[i].n_removed == got[i].n_bytes and got[i].n_spans == 1 for i in range(40))
    assert got[100].n_removed == 300 and got[101].n_removed == 0
    assert got[102].n_removed == got[103].n_removed == 0          # copies, but shorter than a window


def test_near_copies_of_a_very_long_text(spark):
    words = prose(120_000).split(" ")
    other = list(words)
    for at in range(0, len(other), 40):
        other[at] = "changed"
    rows = [(5, " ".join(words)), (9, " ".join(other)), (7, prose(120)), (8, None)]
    got = {r.doc_id: r for r in near.near_duplicates(frame(spark, rows)).collect()}
    assert (got[9].component_id, got[5].component_id, got[7].component_id, got[8].component_id) == (5, 5, 7, 8)
    assert got[8].n_shingles == 0 and got[5].n_shingles > 100_000


def test_chat_with_a_very_long_turn_and_repeated_rows(spark):
    long = "[INST] \\ </s>" * 50_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", long), (2, 0, "user", None), (2, 1, "assistant", "a"),
            (2, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(2)
    got = {r.conv_id: r for r in chat.formatted_digests(df).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[2].loss_chars) == (2, len(long), 3, 2)
    assert got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[2].loss_sha256 == hashlib.sha256(b"aa").hexdigest()
