"""Corpus preparation: quality rules, near duplicates, decontamination, secrets, packing.

Each stage reads what the one before it wrote and returns the columns of its input, in order, but
for the last, which returns the packed pieces. Stages work on columns by position, so other
columns of any name pass through. Rows with null ids or texts pass like any others: a text without
words fails the quality rules. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.llm import decontaminate, jaccard, packing, quality_rules, secret_scan
from actiontally.llm.common import small_side, stored, table
from actiontally.session import scratch_path

ID, TEXT, CHARS = "doc_id", "text", "n_chars"
#: Near duplicates here: sets of five-word shingles, similarity 0.8 or more.
SHINGLE, PERCENT = 5, 80


def numbered(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents with columns col0, col1, ... and what the id and the text are called then."""
    at = {c: f"col{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*at.values()), at[ID], at[TEXT]


def named(rows: DataFrame, docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Back to the columns of ``docs``; where ``changed`` holds, the text's length is counted anew."""
    out = []
    for i, f in enumerate(docs.schema.fields):
        c = F.col(f"col{i}")
        if changed is not None and f.name == CHARS:
            c = F.when(changed, F.length(f"col{docs.columns.index(TEXT)}")).otherwise(c).cast(f.dataType)
        out.append(c.alias(f.name))
    return rows.select(*out)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. The raw multinomial is that of this input."""
    rows, key, text = numbered(docs)
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select(ID)
    return named(quality_rules.rate(rows, quality_rules.fit(rows, trusted, key, text), text).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays (of rows that share
    it, one text by its hash, once). Texts without words belong to no group and stay."""
    rows, key, text = numbered(docs)
    mark = F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("hash"))
    found = stored(jaccard.near_duplicates(rows.select(mark.alias("id"), F.col(text).alias("text")), "id", "text", SHINGLE, PERCENT), "groups")
    gone = found.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select("id").distinct()
    rows = rows.join(small_side(gone), mark.eqNullSafe(F.col("id")), "left_anti")
    again = found.filter("n_shingles > 0").groupBy("id").count().filter("count > 1").select("id")
    if again.limit(1).count():  # rows repeated with id and text
        rows = rows.join(again, mark.eqNullSafe(F.col("id")), "left_anti").union(
            rows.join(again, mark.eqNullSafe(F.col("id")), "left_semi").dropDuplicates([key, text]))
    return named(rows, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a document of nothing else goes."""
    rows, _, text = numbered(docs)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), text, clean=True)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end_word"] - s["first_word"])
    return named(found.filter((hit == 0) | (hit < F.col("n_words"))), docs, F.size("spans") > 0)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets found through a new ledger are replaced by their kind in brackets."""
    rows, key, text = numbered(docs)
    ledger = secret_scan.Ledger(spark, scratch_path(spark, "pipeline-ledger"))
    secret_scan.scan_versions(rows, ledger, key, text)
    return named(secret_scan.redact(rows, ledger, text), docs, F.lit(True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, cut into sequences of 4096."""
    rows, key, text = numbered(docs)
    return packing.piece_digest(packing.pack(rows, public_tokenizers.path("word_bpe_49k.json"), key, text, keep_memo=False), ID)


STAGES = [("quality_rules", quality), ("ngram_jaccard", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secrets), ("packing", pack)]

#: SQL can't tokenise; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
