"""The corpus pipeline: five stages from raw documents to token ids.

1. quality rules: documents that the rules' posterior rejects go
2. line dedup: repeated lines go, documents stay
3. SimHash near-dedup: one document of each group stays
4. benchmark decontamination: documents with a benchmark passage go
5. BPE: (doc_id, n_tokens, ids, decoded_sha256) of what is left, the last of
   the text that the ids decode to

Each stage works on all that its predecessor kept, written as Parquet and
read again.  Stages 1 to 4 return the columns of ``documents``.  Columns may
hold nulls and further columns pass through; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm import bpe, decontaminate, linededup, quality, simhash
from portrait.llm.common import sha256_text, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.drop_repeated_lines(docs, min_chars=20, min_docs=3)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else out


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_matches(docs, table(spark, sf_dir, "benchmark"), window=10)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode_decode(docs, path)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", sha256_text(F.col("decoded")).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("bpe encoding", bpe_encoding),
]

#: Expectation-maximisation, link components and BPE are not expressed in SQL;
#: the tests compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
