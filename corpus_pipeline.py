"""From raw documents to packed token ids, in five stages.

Each stage takes what its predecessor kept, is written as Parquet to the shared
scratch folder and read again as the next one's documents.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histdim.llm.frames import stored, table
from histdim.llm.mixing import mixture
from histdim.llm.packing import PackParams, pack_documents
from histdim.llm.quality import keep_good
from histdim.llm.simhash import one_of_each
from histdim.llm.tiling import without_leaks

#: Token shares of the mixture.  Clean documents stay whole and are written once: the total is what leaves
#: their expected tokens a little above what they are, so that their rates reach one.
TARGETS = {"clean": 0.99, "toxic": 0.01}
HEADROOM = 0.02
#: The toxic share is a ceiling: of their expected tokens no more than this share stays, however rare they are.
MOST = {"toxic": 0.25}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs, shingle=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaked go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken, at most once, at the rates that meet the target shares."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    labels = table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))
    return mixture(docs, labels, TARGETS, whole=("clean",), headroom=HEADROOM, most=MOST, once=True)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in packed rows."""
    return pack_documents(docs, params=PackParams())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]

#: Fingerprint components, tiles, fitted rates and token ids have no SQL; tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
