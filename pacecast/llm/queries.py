"""The registered queries of this subpackage: production settings, whole tables, contract columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacecast.llm import (
    decontam, importance, jaccard, langid, lengths, pii, quality, sharding, simhash, sptok, tokenbin, toxicity, variants,
)
from pacecast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
END_ID = 2


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def remainder(of: int) -> F.Column:
    """crc32 of the doc_id as text, modulo; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(of))


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.train(docs, remainder(4) != 2)
    return langid.predict(docs, trees).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), pii.train())
    kinds = F.split("base", ",")
    count = lambda kind: F.size(F.filter(kinds, lambda s: s.startswith(f"{kind}:"))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sptok.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


TOXIC_FROM = 0.7


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder(3) != 1)
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query("op7_token_lengths")
def op7_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lengths.histogram(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), "lang")
    return lengths.limits(counts).withColumnRenamed("group", "lang")


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.per_row(hits).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# The words of a text, as in decontam.words.
_SQL_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
ORACLES["op8_decontamination"] = f"""
with items as (select cast(item_id as varchar) as item_id, {_SQL_WORDS} as w from benchmark),
windows as (
    select distinct item_id, len(w[s:s + 9]) as n, array_to_string(w[s:s + 9], ' ') as words
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from items where len(w) > 0)),
docs as (select row_number() over () as rid, doc_id, {_SQL_WORDS} as w from documents),
places as (select rid, w, unnest(range(1, len(w) + 1)) as i from docs),
found as (
    select distinct p.rid, p.i, l.n, windows.item_id
    from places p join (select distinct n from windows) l on p.i + l.n - 1 <= len(p.w)
    join windows on windows.n = l.n and windows.words = array_to_string(p.w[p.i:p.i + l.n - 1], ' ')),
hit as (
    select rid, count(distinct j) as n_hit from (select rid, unnest(range(i, i + n)) as j from found) group by rid),
named as (
    select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct rid, item_id from found) group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (rid) left join named using (rid)
"""


@query("op9_interleaved_shards")
def op9_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source", "fraction",
    )


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenbin.token_files(docs, public_tokenizers.path(BYTE_BPE), END_ID)


@query("op11_jaccard_join")
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


# Sets of shingles as text; classes of equal sets, links between classes, and what these reach.
ORACLES["op11_jaccard_join"] = r"""
with recursive docs as (
    select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents),
sets as (
    select rid, doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(list_zip(w, w[2:], w[3:])[:len(w) - 2], lambda x: concat(x[1], ' ', x[2], ' ', x[3]))
        end)) as s from docs),
classes as materialized (select s, len(s) as n, row_number() over () as c from (select distinct s from sets where len(s) > 0)),
members as (select c, n, unnest(s) as m from classes),
links as (
    select a.c as a, b.c as b from members a join members b on a.m = b.m and a.c < b.c
        and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    group by a.c, b.c, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges as (select a, b from links union all select b, a from links),
reach as (select c as a, c as b from classes union select r.a, e.b from reach r join edges e on r.b = e.a),
named_sets as (select s, min(doc_id) as least_id, count(*) as copies from sets group by s),
named as (select r.a as c, min(least_id) as component_id from reach r join classes on classes.c = r.b
    join named_sets using (s) group by r.a)
select doc_id, len(s) as n_shingles, case when len(s) = 0 then doc_id else component_id end as component_id,
    case when len(s) = 0 then 1 else copies end as n_copies
from sets left join classes using (s) left join named using (c) left join named_sets using (s)
"""


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_importance_resampling")
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
