"""The thin queries of this subpackage, each over the whole of its table, and their DuckDB twins."""

from __future__ import annotations

from pyrelith.llm import bpe, chat_format, exact_dedup, fingerprints, html_extraction, language_id, mixing, near_dedup, resampling, sessions, token_store, topk_search, toxicity


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark, sf_dir):
    return html_extraction.extract_main_text(_read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_toxicity(spark, sf_dir):
    return toxicity.detect(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_token_output(spark, sf_dir):
    import public_tokenizers

    return token_store.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op5_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.encode_decode(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_mixing(spark, sf_dir):
    return mixing.mix_plan(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_minhash_dedup(spark, sf_dir):
    return near_dedup.near_components(_read(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    return language_id.identify(_read(spark, sf_dir, "documents"))


def op9_chat_preference(spark, sf_dir):
    return chat_format.neighbouring_pairs(_read(spark, sf_dir, "conversations"))


def op10_exact_topk(spark, sf_dir):
    vectors = _read(spark, sf_dir, "embeddings")
    return topk_search.exact_topk(vectors, vectors.where("vec_id % 100 = 0"))


def op11_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


def op12_sessions(spark, sf_dir):
    return sessions.sessions(_read(spark, sf_dir, "clicks"))


def op13_resampling(spark, sf_dir):
    return resampling.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_toxicity, op3_token_output, op4_exact_dedup, op5_bpe, op6_mixing, op7_minhash_dedup, op8_language_id,
        op9_chat_preference, op10_exact_topk, op11_fingerprints, op12_sessions, op13_resampling,
    )
}
ORACLE_SQL = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_minhash_dedup": near_dedup.ORACLE,
    "op9_chat_preference": chat_format.ORACLE,
    "op10_exact_topk": topk_search.ORACLE,
    "op11_fingerprints": fingerprints.ORACLE,
    "op12_sessions": sessions.ORACLE,
    "op13_resampling": resampling.ORACLE,
}
