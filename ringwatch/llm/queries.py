"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm import (
    alignment, decontamination, licenses, lm, packing, prefix_counts, sharding, simhash, substrings, topk, toxicity, urls, whitening)
from ringwatch.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.drop("ids")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm.score(table(spark, sf_dir, "documents"), good)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("matched")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shuffled(table(spark, sf_dir, "documents")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A deviation that a long cannot hold is null here; the operator has all its digits.
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_top_k": op3_top_k,
    "op4_packing": op4_packing,
    "op5_licenses": op5_licenses,
    "op6_substrings": op6_substrings,
    "op7_lm_scores": op7_lm_scores,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_sharding": op11_sharding,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

ORACLE = {
    "op3_top_k": """
        with v as (
          select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
          where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
          select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint score
          from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int rank from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op10_url_filter": r"""
        with u as (select page_id, url, strpos(url, '://') pos from pages),
        p as (
          select page_id, case when pos > 0 then substr(url, pos + 3) else '' end rest from u),
        h as (
          select page_id,
                 translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                 regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) path from p),
        d as (
          select *, '.' || host dotted from h),
        r as (
          select page_id, host, path, dotted,
                 case when dotted like '%.example.net' and path like '/en/%' then 'example.net/en/'
                      when dotted like '%.example.com' and path like '/de/%' then 'example.com/de/'
                      when dotted like '%.org' and path like '/fr/%' then 'org/fr/'
                      when dotted like '%.net' and path like '/%' then 'net/' end rule from d)
        select page_id, host, path, rule,
               case when rule in ('example.net/en/', 'org/fr/') then 'allow'
                    when rule is not null then 'block'
                    when regexp_matches(dotted, '\.(cheap-pills|casino-win|spam-farm|free-prizes)\.') then 'block'
                    else 'allow' end verdict
        from r""",
}
