"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import audit, bpe, chat, contamination, embeddings, language_id, language_model, lines, minhash, quality_rules, sql, suffixes, token_counts, trie
from .registry import QUERIES, query, table  # noqa: F401

COUNTING = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op2_token_counts")
def op2_token_counts(spark, d):
    """Tokens of every document; null texts have none."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path(COUNTING))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"))


@query("op4_decontaminate", sql.DECONTAMINATE)
def op4_decontaminate(spark, d):
    """Benchmark windows in every document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = contamination.find_items(docs, table(spark, d, "benchmark"))
    n_hit = contamination.hit_words()
    return found.select(
        "doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.starts") > 0).alias("contaminated"))


@query("op6_bpe")
def op6_bpe(spark, d):
    """Ids of every document, and the bytes that they decode to."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.transcode(docs, *where).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_minhash", sql.MINHASH)
def op5_minhash(spark, d):
    """Groups of documents that are 85 % alike."""
    return minhash.near_duplicates(table(spark, d, "documents"), percent=85)


@query("op10_embedding_dedup", sql.EMBEDDINGS)
def op10_embedding_dedup(spark, d):
    """Groups of near-duplicate vectors with equal labels."""
    return embeddings.vector_links(table(spark, d, "embeddings"))


@query("op7_lm_score")
def op7_lm_score(spark, d):
    """Scores of every document under the base and the interpolated model."""
    return language_model.scores(table(spark, d, "documents"))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark, d):
    """Passages of 50 words or more that stand in several places."""
    return suffixes.repeated_passages(table(spark, d, "documents"))


@query("op1_line_dedup", sql.LINE_DEDUP)
def op1_line_dedup(spark, d):
    """Lines of documents that repeat an earlier line, or nearly."""
    return lines.repeated_lines(table(spark, d, "documents")).select("doc_id", "line_no", "n_words", "exact")


@query("op3_chat_format")
def op3_chat_format(spark, d):
    """Messages of every conversation without quotes, in reply order."""
    return chat.reply_order(table(spark, d, "conversations"))


@query("op9_language_id")
def op9_language_id(spark, d):
    """Language of every page and every document; the other id is null."""
    docs = table(spark, d, "documents")
    model = language_id.fit(docs)
    pages = language_id.identify_pages(table(spark, d, "pages"), model)
    texts = language_id.identify_documents(docs, model)
    none = F.lit(None).cast("long")
    return pages.withColumns({"doc_id": none, "page_id": F.col("id")}).unionByName(
        texts.withColumns({"doc_id": F.col("id"), "page_id": none})).drop("id")


@query("op12_filter_audit", sql.FILTER_AUDIT)
def op12_filter_audit(spark, d):
    """What five filters remove in all their orders, for each source."""
    return audit.audited(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op13_quality_rules", sql.QUALITY_RULES)
def op13_quality_rules(spark, d):
    """Documents that pass fixed base rules and the bounds of their language and source."""
    judged = quality_rules.judged(table(spark, d, "documents"))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


@query("op11_prefix_trie", sql.PREFIX_TRIE)
def op11_prefix_trie(spark, d):
    """Every node of the trie of rebuilt conversations, with totals over its subtree."""
    return trie.prefix_trie(table(spark, d, "conversations"))
