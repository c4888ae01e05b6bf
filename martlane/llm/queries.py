"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlane.llm import (bpa, chat, fim, golay, impact, near, packing, pieces, quality, repeats, srs, token_counts,
                          toxicity, transducer)
from martlane.llm.common import table


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers
    cut = packing.document_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut)


def op2_factorisation_machine_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 200-byte strings that occur twice."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op4_lsh_forest_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = near.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted by prefix-target expansion and read back."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = {f.name: f.dataType for f in conversations.schema}
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                 "conv_id long, turn long, role string, text string")
    more = more.select(*(F.col(c).cast(kind[c]).alias(c) for c in conversations.columns))
    return chat.formatted_digests(conversations.unionByName(more)).drop("n_examples")


def op6_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_stable_projection_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest (largest inner product) of each vector whose id divides by 20."""
    return srs.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_impact_ordered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 20 best by quantised inner product, same queries."""
    return impact.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts, and the longest prefix within 4096 tokens."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces.default_path())


def op10_transducer_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the transducer: ids, text and digests."""
    return transducer.round_trip(table(spark, sf_dir, "documents"), pieces.default_path())


def op11_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return bpa.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_golay_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    found = golay.near_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id", "n_copies")


def op13_counted_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed for fill-in-middle, and restored."""
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sum_of_squares_packing, op2_factorisation_machine_quality, op3_bwt_merge_dedup,
        op4_lsh_forest_near_dedup, op5_prefix_target_chat, op6_weak_supervision_toxicity,
        op7_stable_projection_ann, op8_impact_ordered_topk, op9_prefix_token_counts,
        op10_transducer_sentencepiece, op11_best_position_search, op12_golay_simhash_dedup,
        op13_counted_fill_in_middle, pipeline)}

SQL: dict[str, str] = {
    "op4_lsh_forest_near_dedup": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents),
        sets as (
            select doc_id, list_distinct(case when len(w) = 1 then w else
                list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
            from words),
        items as (select doc_id, len(s) as n, unnest(s) as x from sets),
        links as (
            select a.doc_id as a, b.doc_id as b
            from items a join items b on a.x = b.x and a.doc_id <> b.doc_id and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach as (
            select doc_id, doc_id as root from sets
            union
            select l.b as doc_id, r.root from reach r join links l on l.a = r.doc_id)
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.root as component_id, s.doc_id = r.root as kept
        from sets s join (select doc_id, min(root) as root from reach group by doc_id) r using (doc_id)
        """,
    "op5_prefix_target_chat": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        sized as (
            select *, 14 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g')) as n,
                   row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as is_last
            from turns),
        summed as (
            select *, 7 + sum(n) over (partition by conv_id order by turn, role, text rows unbounded preceding) as prefix
            from sized)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               cast(sum(prefix) filter (role = 'assistant' or is_last) as bigint) as formatted_chars
        from summed group by conv_id
        """,
    "op8_impact_ordered_topk": """
        with v as (
            select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
            from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.r as query_row, q.vec_id as query_id, c.r, c.vec_id,
                   cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on q.vec_id % 20 = 0 and q.r <> c.r),
        ranked as (
            select *, cast(row_number() over (partition by query_row order by score desc, vec_id, r) as integer) as rank
            from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 20
        """,
    "op11_best_position_search": r"""
        with words as (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
            from documents),
        docs as (select row_number() over () as doc_row, doc_id, t, len(t) as n from words where len(t) > 0),
        whole as (select count(*) as nd, cast(sum(n) as bigint) as l from docs),
        tfs as (select doc_row, doc_id, n, term, count(*) as tf from (select *, unnest(t) as term from docs) u
                group by doc_row, doc_id, n, term),
        weights as (
            select term, cast(floor(1000 * ln((2 * any_value(nd) + 2)::double / (2 * count(*) + 1))) as bigint) as w
            from tfs, whole group by term),
        items as (select row_number() over () as item_row, * from benchmark),
        asked as (
            select distinct item_row, item_id,
                   unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from items),
        scored as (
            select a.item_row, a.item_id, t.doc_row, t.doc_id,
                   cast(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + ((90 * t.n * nd) // l))))) as bigint) as score
            from asked a join tfs t using (term) join weights w using (term), whole
            group by a.item_row, a.item_id, t.doc_row, t.doc_id),
        ranked as (
            select *, cast(row_number() over (partition by item_row order by score desc, doc_id nulls last, doc_row) as integer) as rank
            from scored where score > 0)
        select item_id, rank, doc_id, score from ranked where rank <= 10
        """,
    "op13_counted_fill_in_middle": r"""
        with texts as (
            select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
        cut as (
            select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u, len(regexp_extract_all(t, '[^\n]*\n|[^\n]+')) as n,
                   cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
                   cast('0x' || substr(h, 25, 8) as bigint) as h4
            from texts),
        placed as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                   case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
                        when h4 % 100 < 50 then 'spm' else 'psm' end as form
            from cut),
        parts as (
            select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
                   array_to_string(u[b + 1:], '') as s
            from placed)
        select doc_id, cast(n as bigint) as n, form,
               case when form <> 'plain' then length(p) end as prefix_chars,
               case when form <> 'plain' then length(m) end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                      else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
               sha256(t) as restored_sha256
        from parts
        """,
}
