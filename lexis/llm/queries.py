"""One registered query for each operator of this subpackage.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexis.llm import common

QueryFn = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.token_counts import token_counts
    return token_counts(common.table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.quality_llr import quality, trusted_ids
    return quality(common.table(spark, sf_dir, "documents"), trusted_ids(common.table(spark, sf_dir, "labels")))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.source_mix import mix_counts
    return mix_counts(common.table(spark, sf_dir, "documents"))


def op4_secret_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.secret_guess import secret_spans
    return secret_spans(common.table(spark, sf_dir, "documents"))


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.line_windows import line_digests
    return line_digests(common.table(spark, sf_dir, "documents"))


def op6_cover_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.cover_topk import top_k
    return top_k(common.table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, 5)


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.shingle_join import jaccard_groups
    return jaccard_groups(common.table(spark, sf_dir, "documents"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.piece_codec import encode_documents
    return encode_documents(common.table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.hashed_maxent import lm_scores
    return lm_scores(common.table(spark, sf_dir, "documents"))


def op10_window_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.window_doubling import remove_repeats
    return remove_repeats(common.table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.fill_middle import fill_digests
    return fill_digests(common.table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.filter_audit import filter_audit
    return filter_audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexis.llm.chat_format import chat_digests, with_control_case
    return chat_digests(with_control_case(common.table(spark, sf_dir, "conversations")))


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_token_counts, op2_quality_llr, op3_source_mix, op4_secret_guess, op5_line_windows,
                                    op6_cover_topk, op7_shingle_join, op8_piece_codec,
                                    op9_hashed_maxent, op10_window_doubling,
                                    op11_fill_middle, op12_filter_audit, op13_chat_format)}


def oracles() -> dict[str, str]:
    from lexis.llm.line_windows import ORACLE as lines
    from lexis.llm.cover_topk import ORACLE as top
    from lexis.llm.chat_format import ORACLE as chats
    from lexis.llm.fill_middle import ORACLE as fills
    from lexis.llm.filter_audit import ORACLE as audits
    return {"op5_line_windows": lines, "op6_cover_topk": top, "op11_fill_middle": fills, "op12_filter_audit": audits,
            "op13_chat_format": chats}
