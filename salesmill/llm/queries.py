"""Registered queries of the subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.session import scratch

from . import chat, digests, embeddings, near, packing, periods, pieces, pii, quality, repeats, sharding, tries, warc

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLASH = "</s>[INST] ok [/INST]"


@query(
    f"""
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select * from (values (-7, 0, 'user', '{CLASH}'), (-7, 1, 'assistant', '{CLASH}'))
    ), shown as (
        select *, 22 + length(regexp_replace(regexp_replace(role, '<(\\\\*/?s>)', '<#\\1', 'g'), '\\[(\\\\*/?INST\\])', '[#\\1', 'g'))
            + length(regexp_replace(regexp_replace(text, '<(\\\\*/?s>)', '<#\\1', 'g'), '\\[(\\\\*/?INST\\])', '[#\\1', 'g')) as n
        from rows
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        cast(sum(n) as bigint) as formatted_chars
    from shown group by conv_id
    """
)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as strings that read back; digests of what is read."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(
        spark.createDataFrame([(-7, 0, "user", CLASH), (-7, 1, "assistant", CLASH)], rows.schema)
    )
    out = chat.trained(chat.formatted(rows))
    said = "array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), '')"
    return out.select(
        "conv_id",
        F.expr("cast(size(turns) as bigint)").alias("n_turns"),
        F.expr(f"sha2({said}, 256)").alias("turns_sha256"),
        F.expr("cast(length(loss) as bigint)").alias("loss_chars"),
        F.expr("sha2(loss, 256)").alias("loss_sha256"),
        F.expr("cast(length(formatted) as bigint)").alias("formatted_chars"),
    )


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    out = repeats.cleaned(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    """
    with p as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
        from pages
    ), m as (
        select payload_digest, max(page_id) as main from p where payload_bytes >= 1000 group by payload_digest
    )
    select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
        case when main is null or main = page_id then 'response' else 'revisit' end as record_type,
        case when main <> page_id then main end as refers_to
    from p left join m using (payload_digest)
    """
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records, read back from the archives."""
    path = scratch(spark, "warc")
    warc.written(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.url_decode(F.regexp_extract(c, "^<urn:page:(.*)>$", 1)).try_cast("bigint")
    whole = F.when(F.col("type") == "response", F.col("payload_bytes")).otherwise(F.col("http_bytes"))
    digest = F.when(F.col("type") == "response", F.col("payload_digest")).otherwise(F.col("declared_digest"))
    intact = (digest == F.col("declared_digest")) & (whole == F.col("http_bytes"))
    return warc.records(spark, path).select(
        number("record_id").alias("page_id"),
        whole.alias("payload_bytes"),
        F.when(intact, digest).otherwise(F.raise_error(F.concat(F.lit("a payload is damaged: "), F.col("record_id")))).alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048)
    return packing.packed(pieces, size=2048)


@query(
    """
    with recursive v as (
        select vec_id, cast(embedding as double[]) as e from embeddings
        where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as (
        select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
        where list_cosine_similarity(a.e, b.e) >= 0.95
    ), reached as (
        select vec_id as x, vec_id as y from embeddings
        union select r.x, l.y from reached r join links l on r.y = l.x
    ), n as (select x, count(*) as n_links from links group by x), c as (select x, min(y) as component_id from reached group by x)
    select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
    from embeddings join c on c.x = vec_id left join n on n.x = vec_id
    """
)
def op5_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors by cosine."""
    out = embeddings.linked(table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


QUALITY_SQL = """
    with t as (
        select doc_id, lang, source, coalesce(text, '') as t,
            list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
        from documents
    ), windows as (
        select doc_id, i, list_slice(ws, i, i + 4) as g from (select doc_id, ws, unnest(generate_series(1, len(ws) - 4)) as i from t)
    ), twice as (
        select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows) where n > 1
    ), covered as (
        select doc_id, sum(least(5, coalesce(next - i, 5))) as n
        from (select doc_id, i, lead(i) over (partition by doc_id order by i) as next from twice) group by doc_id
    ), counts as (
        select doc_id, lang, source, len(ws) as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(ls) as n_lines,
            len(ls) - len(list_distinct(ls)) as n_dup_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words
        from t left join covered using (doc_id)
    ), base as (
        select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
            [10 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1),
             1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] as vs
        from counts
    ), m as (
        select doc_id, lang, source, base_failed, unnest([0, 1, 2, 3]) as k, unnest(vs) as v, unnest([{edge}]) as edge,
            unnest([{middle}]) as middle, unnest([{reach}]) as reach, unnest([{step}]) as step, unnest([{least}]) as least
        from base
    ), b as (
        select *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) as low from m
    ), fine as (
        select lang, source, k, edge, middle, reach, step, least, count(*) as n,
            list_sort(list(low))[(max(edge) * count(*) + 99) // 100] as qe, list_sort(list(low))[(max(middle) * count(*) + 99) // 100] as qm
        from b where not base_failed group by all
    ), wide as (
        select lang, k, edge, middle, count(*) as n,
            list_sort(list(low))[(max(edge) * count(*) + 99) // 100] as qe, list_sort(list(low))[(max(middle) * count(*) + 99) // 100] as qm
        from b where not base_failed group by all
    ), whole as (
        select k, edge, middle,
            list_sort(list(low))[(max(edge) * count(*) + 99) // 100] as qe, list_sort(list(low))[(max(middle) * count(*) + 99) // 100] as qm
        from b where not base_failed group by all
    ), chosen as (
        select f.lang, f.source, f.k, f.reach, f.step,
            case when f.n >= f.least then f.qe when w.n >= f.least then w.qe else a.qe end as qe,
            case when f.n >= f.least then f.qm when w.n >= f.least then w.qm else a.qm end as qm
        from fine f join wide w on f.lang is not distinct from w.lang and f.k = w.k join whole a on f.k = a.k
    ), limits as (
        select *, reach * greatest(qe - qm, step, 1 + (qe >> 5)) // 10 as far from chosen
    ), kept as (
        select doc_id, bool_and(coalesce(low <= qe + far and (b.k > 0 or v >= qm - far), true)) as fits
        from b left join limits c
            on b.lang is not distinct from c.lang and b.source is not distinct from c.source and b.k = c.k
        group by doc_id
    )
    select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
        cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines, n_repeat_words, base_failed,
        not base_failed and fits as kept
    from base join kept using (doc_id)
"""


@query(
    QUALITY_SQL.format(
        **{f: ", ".join(str(getattr(m, f)) for m in quality.MEASURES) for f in ("edge", "middle", "reach", "step", "least")}
    )
)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents"))


@query()
def op7_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal row counts, each with the mixture of sources of the whole."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.interleave(docs, 40, key="doc_id", stratum="source").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near-duplicates of every document."""
    return near.classes(table(spark, sf_dir, "documents"))


@query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    out = pii.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    base = "filter(spans, x -> x.kind in ('email', 'ip', 'card', 'phone'))"
    return out.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k, _, _ in pii.BASE],
        F.expr(f"sha2({joined.format(base)}, 256)").alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
        F.expr("array_join(transform(spans, x -> cast(x.score as string)), ',')").alias("scores"),
    )


@query()
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text read back from them, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.encoded(table(spark, sf_dir, "documents"), path)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    """
    with t as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as text_sha256 from documents
    )
    select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = min(doc_id) over g as kept, text_sha256
    from t window g as (partition by text_sha256)
    """
)
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and which one stays."""
    return digests.classes(table(spark, sf_dir, "documents"))


@query()
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations with sums over their subtrees."""
    return tries.trie(table(spark, sf_dir, "conversations"))


def cycled(doc_id: int, n: int) -> np.ndarray | None:
    """Word order of the documents that are read as repetitions, from a place on; None for the others."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, the longest one, and the text without their repetitions."""
    out = periods.found(table(spark, sf_dir, "documents"), reorder=cycled)
    best = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return out.withColumn("best", F.expr(best)).select(
        "doc_id",
        F.expr("cast(size(runs) as bigint)").alias("n_runs"),
        F.expr("-best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.expr("-best.period").alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.expr(f"sha2({lines}, 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
