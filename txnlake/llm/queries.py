"""The operators as named queries over the test tables, with the contracts' digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    license_scan,
    lines,
    sharding,
    simhash,
    substrings,
    url_rules,
    whitening,
)
from txnlake.llm.common import RID, numbered, table

TOKENIZER = "byte_bpe_50k.tiktoken"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontaminate.decontaminate(docs, items)
    ids = numbered(docs, "doc_id")
    return ids.join(found, RID).select(
        "doc_id",
        "n_words",
        decontaminate.words_hit(F.col("hits")).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).drop(RID)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.predict(docs, language.fit(docs))
    held_out = F.coalesce(language.remainder(F.col("doc_id")) == 2, F.lit(False))
    return told.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (table(spark, sf_dir, name) for name in ("pages", "labels"))
    labels = url_rules.labels_of_documents(labels)
    return url_rules.judge(url_rules.with_document(pages), labels, key="doc_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    kept = F.array_join(F.col("kept").cast("array<string>"), ",")
    return found.select("doc_id", "n_lines", "n_kept", kept.alias("kept_lines"))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Ids and decoded bytes of all texts by the public vocabulary."""
    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(encoded(spark, table(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop(RID)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("phrases", lambda p: p["start"])
    base = F.array_distinct(F.transform("phrases", lambda p: p["label"]))
    own = F.transform("spans", lambda s: s["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        "score",
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation begins with up to eight turns of the one whose id ends in 0 or 5 before it."""
    conv = F.col("conv")
    return conversation_trie.prefix_trie(
        table(spark, sf_dir, "conversations"),
        donor=conv - conv % 5,
        taken=F.crc32(conv.cast("string").cast("binary")) % 9,
    ).drop("n_nodes")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_decontamination, op2_substring_dedup, op3_language, op4_url_rules, op5_line_dedup,
        op6_bpe, op7_simhash, op8_exact_dedup, op9_sharding, op10_html_text,
        op11_whitening, op12_license_scan, op13_conversation_trie,
    )
    return {query.__name__: query for query in found}
