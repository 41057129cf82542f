"""A corpus from raw documents to packed sequences.

Five stages, each a function of ``(spark, docs, sf_dir)``. ``run`` writes
every stage's result as Parquet in the folder that the cluster shares and
reads it back as the next one's input, so a lost executor never costs more
than the stage it was lost in. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.llm.mixing import taken_documents
from revmart.llm.neardup import distinct_documents
from revmart.llm.packing import pack_documents
from revmart.llm.quality import fit_quality, judge_quality
from revmart.llm.substrings import remove_repeats
from revmart.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep.

    Short documents are not rejected for being short: the labels call most of
    them good, so the forests, calibrated on those labels, decide on them.
    Documents without a word, or that mostly repeat themselves, go.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), min_words=1)
    return judge_quality(docs, model).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity of 0.8 or more): the one with the smallest id.

    Every row goes by the verdict on its own text; of rows that share id and
    shingles one stays. Rows without an id: one of each set of shingles stays.
    """
    return distinct_documents(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 20-word passages that occur earlier in the corpus.

    A document that loses nothing keeps its text as it is, blanks included.
    """
    cut = F.col("n_removed") > 0
    cleaned = remove_repeats(docs)
    return cleaned.withColumns({
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them (0 to 3 times)."""
    return taken_documents(docs).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return pack_documents(docs.select("doc_id", "text")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: The forest's verdict, the shuffle of the mix and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
