"""From raw documents to packed training sequences, in five stages.

Every stage works on all rows that the one before it kept; its result is
written as Parquet in the shared folder and read again as the next one's
documents, so a lost executor or a failed stage costs that stage only.

1. quality classifier: documents scored under 0.3 go;
2. exact dedup: of equal texts, the one with the most code points, then the smallest id, stays;
3. n-gram Jaccard join: of each group of near copies (5-word n-grams, similarity
   0.8 or more), the document with the smallest id stays;
4. mixing: a document is repeated as often as the mix of the sources takes it;
5. packing: the documents' pieces in sequences of at most 2048 tokens.

All but the last return the columns of ``documents``. NULLs, empty texts and
repeated rows are handled as the operators' notes say; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finlake.llm import op2_exact_dedup, op4_packing, op5_ngram_join, op7_mixing, op8_quality_classifier
from finlake.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_ngram_join.drop_near_copies(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_mixing.mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: Compression, shingling, random rounding and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
