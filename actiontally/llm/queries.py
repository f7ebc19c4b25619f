"""The training-data queries: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.llm.common import id_mod, table
from actiontally.llm.decontaminate import CONTAMINATION_SQL
from actiontally.llm.fill_middle import FILL_MIDDLE_SQL
from actiontally.llm.jaccard import NEAR_DUPLICATES_SQL
from actiontally.llm.prefix_trie import PREFIX_TRIE_SQL
from actiontally.llm.secret_scan import base_scan_sql
from actiontally.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a version of its path, scanned through a new ledger."""
    from actiontally.llm.secret_scan import Ledger, scan_report, scan_versions

    ledger = Ledger(spark, scratch_path(spark, "secret-ledger"))
    return scan_report(scan_versions(table(spark, sf_dir, "documents"), ledger, "doc_id", "text"), ledger)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    from actiontally.llm.decontaminate import contamination, contamination_digest

    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination_digest(contamination(docs, bench, keep=["doc_id"]))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to shard files and read back through their index."""
    from actiontally.llm import token_output as t

    manifest = t.write_shards(table(spark, sf_dir, "documents"), t.shard_folder(spark), word_vocabulary())
    return t.read_shards(manifest)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that aren't held out."""
    from actiontally.llm.language_id import fit, identify

    docs = table(spark, sf_dir, "documents")
    held = id_mod("doc_id", 3) == 1
    return identify(docs, fit(docs, ~held), keep=["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the log-likelihood-ratio verdict on every document."""
    from actiontally.llm.quality_rules import fit, rate

    docs = table(spark, sf_dir, "documents")
    return rate(docs, fit(docs, trusted_ids(spark, sf_dir)), keep=["doc_id"])


def op6_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact histogram of encoded lengths with its suffix sums."""
    from actiontally.llm.token_lengths import length_histogram, suffix_sums

    return suffix_sums(length_histogram(table(spark, sf_dir, "documents"), word_vocabulary()))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one id stream, cut into sequences of 4096."""
    from actiontally.llm.packing import pack, piece_digest

    return piece_digest(pack(table(spark, sf_dir, "documents"), word_vocabulary()))


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by positive-unlabelled learning."""
    from actiontally.llm.quality_pu import SCORE_CUT, fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"]).select(
        "doc_id", (id_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= SCORE_CUT).cast("int").alias("predicted"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    from actiontally.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the pattern grammar."""
    from actiontally.llm.toxicity import SCORE_CUT, fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"]).select(
        "doc_id", (id_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= SCORE_CUT).cast("int").alias("predicted"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150% of their words, sources weighted 3, 1, 2, repeating."""
    from actiontally.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations' prefixes, rolled up."""
    from actiontally.llm.prefix_trie import prefix_trie, rebuilt

    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three and put together for filling in the middle."""
    from actiontally.llm.fill_middle import fill_in_middle, middle_digest

    return middle_digest(fill_in_middle(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_token_output": op3_token_output,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_lengths": op6_token_lengths,
    "op7_packing": op7_packing,
    "op8_quality_pu": op8_quality_pu,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fill_middle": op13_fill_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": base_scan_sql(),
    "op2_decontamination": CONTAMINATION_SQL,
    "op9_ngram_jaccard": NEAR_DUPLICATES_SQL,
    "op12_prefix_trie": PREFIX_TRIE_SQL,
    "op13_fill_middle": FILL_MIDDLE_SQL,
}
