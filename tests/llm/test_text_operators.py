"""Packing, token counts, transducer, chat: against the libraries and round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from martlane.llm import chat, packing, pieces, token_counts, transducer

ODD = ["", " ", "  a  b ", "▁x ▁▁", "日本語 テスト\n\n\t<s> </s> <0x0A> é́ 🙂", "a" * 300, "\n\n  \n x", None, "x\x00y",
       "\0a b", "(foo)\"bar\" don't l'été naïve—dash", "a \n b\n\nc", "İstanbul ΣΑΣ. I'm", "<|endoftext|>. x, y",
       "x...? ?!", "a. b.. c, d,, e.\nf !. g", "word " * 3000, "z" * 5000,
       "foo_. bar", "call __init__, next", "a\x1c. b", "a\x1f, b\x1d.\nc", "<|ENDOFTEXT|> x", "<|endoftext|> <|EndOfText|>, y"]


@pytest.fixture(scope="module")
def model():
    path = pieces.default_path()
    return pieces.load(path), sentencepiece.SentencePieceProcessor(model_file=path)


def frame(spark, texts):
    """Repeated ids, a null id and clashing extra columns."""
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(0, texts[0], 2, "y"), (None, "null id", 3, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, packed string").repartition(3)


def test_prefix_counts_equal_the_library(model):
    m, sp = model
    rnd = random.Random(5)
    for text in ODD:
        counts = token_counts.prefix_counts(m, text)
        text = text or ""
        assert len(counts) == len(text) + 1 and counts[-1] == len(sp.encode(text))
        for i in rnd.sample(range(len(text) + 1), min(25, len(text) + 1)):
            assert counts[i] == len(sp.encode(text[:i]))
        if len(text) > 10:
            assert len(sp.encode(token_counts.truncate(m, text, 7))) <= 7


def test_token_count_query(spark, model):
    _, sp = model
    got = token_counts.count_tokens(frame(spark, ODD), pieces.default_path(), limit=50).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        n = len(sp.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 50)
    empty = frame(spark, ODD).filter("false")
    assert token_counts.count_tokens(empty, pieces.default_path()).count() == 0


def test_count_query_reads_prefix_tables(spark, model):
    m, sp = model
    _, tables = token_counts._memos(pieces.default_path())
    keys = m.words("unbelievable words")
    tables.learn(keys)
    assert all(len(tables.words[k]) == len(m.spelled(k)) for k in keys)
    for r in token_counts.count_tokens(frame(spark, ODD), pieces.default_path(), limit=50).collect():
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        counts = token_counts.prefix_counts(m, text)
        assert r.chars_in_limit == max(i for i, c in enumerate(counts) if c <= 50)


def test_transducer_encodes_and_decodes_like_the_library(spark, model):
    _, sp = model
    docs = frame(spark, ODD)
    coded = transducer.encode(docs, pieces.default_path())
    for r in coded.collect():
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.ids == sp.encode(text)
    for r in transducer.decode(coded, pieces.default_path()).collect():
        text = "null id" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.text == sp.decode(sp.encode(text))
    for r in transducer.round_trip(docs, pieces.default_path()).collect():
        ids = sp.encode("null id" if r.doc_id is None else ODD[r.doc_id] or "")
        assert r.ids_crc32 == zlib.crc32(np.array(ids, np.uint32).tobytes()) and r.n_tokens == len(ids)
        assert r.ids == ids and r.decoded == sp.decode(ids)


def check_packing(rows, size):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for members in places.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_document_pieces_and_packing(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    cut = packing.document_pieces(frame(spark, ODD), path, 64)
    got = packing.pack(cut, 64, shard_pieces=20).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for i, text in enumerate(ODD):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], np.uint32)
        want = [(k, 64 * k, len(ids[64 * k:64 * k + 64]), zlib.crc32(ids[64 * k:64 * k + 64].tobytes()))
                for k in range(-(-len(ids) // 64))]
        rows = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i])
        assert rows == sorted(want * (2 if i == 0 else 1))
    total = sum(r.length for r in got)
    assert check_packing(got, 64) <= -(-total // 64) + 3
    assert packing.pack(cut.filter("false"), 64).count() == 0


def test_sum_of_squares_places_as_the_rule_says():
    rnd = np.random.default_rng(2)
    lengths, size = rnd.integers(1, 21, 300), 20
    sequence, offset = packing.sum_of_squares(lengths, size)
    gaps = {}
    for length, s, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        def total(after):
            n = np.zeros(size + 1, int)
            for g in after.values():
                n[g] += g > 0
            return int((n * n).sum())
        options = [total({**gaps, k: g - length}) for k, g in gaps.items() if g >= length]
        options.append(total({**gaps, "new": size - length}))
        assert at == size - gaps.get(s, size)
        gaps[s] = gaps.get(s, size) - length
        assert total(gaps) == min(options)


def test_chat_expansion_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\[turn:x]\\\\", "[/turn]", "", None, "a<b]c\\", "é🙂\n"]
    rnd = random.Random(4)
    rows = []
    for conv in [*range(25), None]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", None, "odd]role\\"]), rnd.choice(nasty), 0))
    rows.append((3, 0, "assistant", "again", 1))  # a turn number twice
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, target_turn int").repartition(4)
    convs = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        convs[conv].append((turn, role is not None, role or "", text is not None, text or ""))
    got = {r.conv_id: r for r in chat.formatted_digests(df).collect()}
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        turns.sort()
        all_text = "".join(f"{role}\n{text}\n" for _, _, role, _, text in turns)
        loss = "".join(text for _, _, role, _, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(all_text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.format_conversations(df).collect()
    assert sum(len(e.text) for e in examples) == sum(r.formatted_chars for r in got.values())
    for e in examples:
        parsed = chat.parse(e.text)
        if e.target_turn is not None:
            assert parsed[-1] == ("assistant", chat.unescape(e.text[e.loss_start:e.loss_end]))
    assert chat.formatted_digests(df.filter("false")).count() == 0
