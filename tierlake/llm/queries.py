"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import ann, bagminhash, bpe, conversations, lines, mixing, phrases, pii, quality, suffix_dedup, token_files, topk, toxicity
from tierlake.llm.common import table
from tierlake.session import run_dir


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, folder)


def op2_quality_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "source", "lang", *quality.OUT)


def op3_ann_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op6_topk_exhaustive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.scaled(table(spark, sf_dir, "embeddings"), 1024), F.col("vec_id") % 100 == 0, k=10)


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op8_mixing_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    exact = {c: F.round(c, 9) for c in ("factor", "prob", "weight")}
    return mixed.withColumns(exact).select("doc_id", "source", "lang", "topic", "n_tokens", "factor", "prob", "weight", "sampled")


def op9_toxicity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(phrases.collocations(phrases.mine(table(spark, sf_dir, "documents"))))


def op12_lightest_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.Repair(conversations.damaged(table(spark, sf_dir, "conversations"))).summary()


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


_TOPK_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as w
           from embeddings
           where embedding is not null
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
     s as (select q.vec_id as query_id, c.vec_id as vec_id,
                  cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) as bigint) as score
           from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
     r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_quality_sites": op2_quality_sites,
        "op3_ann_collision": op3_ann_collision,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_pii_weak": op5_pii_weak,
        "op6_topk_exhaustive": op6_topk_exhaustive,
        "op7_bagminhash": op7_bagminhash,
        "op8_mixing_raking": op8_mixing_raking,
        "op9_toxicity_channel": op9_toxicity_channel,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_phrase_stripes": op11_phrase_stripes,
        "op12_lightest_repair": op12_lightest_repair,
        "op13_line_runs": op13_line_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_topk_exhaustive": _TOPK_SQL, "op8_mixing_raking": mixing.mix_sql(), "op11_phrase_stripes": phrases.SQL, "op13_line_runs": lines.SQL}
