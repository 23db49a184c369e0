"""From raw documents to token ids in five stages, each a written table for the next.

Every stage function takes (spark, docs, sf_dir), works on all its predecessor kept and
returns the columns of ``docs``; the last returns a row of ids per document. A stage that
decides about rows tells rows of one id apart by their text, so a repeated id never
takes another row with it. Rows that repeat both count as one document from exact dedup on.
"""

from __future__ import annotations

from itertools import count, islice

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmetrics.llm.bpe import bpe_columns
from dockmetrics.llm.common import discard, materialize, read, row_hash, ship_package
from dockmetrics.llm.decontamination import decontaminate
from dockmetrics.llm.exact_dedup import exact_dedup
from dockmetrics.llm.language_id import UNKNOWN, fit_language_model, language_column, with_floors
from dockmetrics.llm.simhash_dedup import simhash_dedup

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _unused(docs: DataFrame, number: int) -> list[str]:
    """Names that no column of the documents has."""
    names = (f"row_key_{i}" for i in count(1))
    return list(islice((name for name in names if name not in docs.columns), number))


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The documents with a key of their id and text, in two columns of unused names. It is
    never null, so a join on it and dropping repeated rows by it share one shuffle."""
    names = _unused(docs, 2)
    row = [F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit(""))]
    keys = {name: F.xxhash64(F.lit(seed), *row) for seed, name in enumerate(names)}
    return docs.withColumns(keys), names


def _kept_rows(keyed: DataFrame, kept: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """One row of ``keyed`` for each key in ``kept``."""
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select(*columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; those without a letter go, and those less like
    every language than labelled texts of their length are.
    Learns from the labels of the documents themselves; without any label, only texts
    without a letter go."""
    ship_package(spark)
    model = with_floors(fit_language_model(docs), docs)
    [name] = _unused(docs, 1)
    judged = docs.withColumn(name, language_column(model))
    found = F.col(name)
    if model.floors:
        keep = (found["lang_pred"] != UNKNOWN) & found["typical"]
    else:
        keep = F.col("text").rlike("\\p{L}")
    return judged.filter(keep).drop(name)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    ship_package(spark)
    keyed, names = _keyed(docs)
    decided = exact_dedup(keyed, carry=names)
    return _kept_rows(keyed, decided.filter("kept").select(*names), names, docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that fingerprints within two bits (three-word
    shingles) connect, that of the smallest id. A group without any id keeps one of its texts."""
    ship_package(spark)
    keyed, names = _keyed(docs)
    decided = materialize(simhash_dedup(keyed, shingle=3, radius=2, carry=names), "near-groups")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *names)).alias("best")
    kept = decided.groupBy("group").agg(best).select(*[F.col(f"best.{name}").alias(name) for name in names])
    return _kept_rows(keyed, kept, names, docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("leaked_id"), F.col("row_hash").alias("leaked_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(leaked["leaked_id"]) & (row_hash("text") == leaked["leaked_hash"])
    return docs.join(leaked, same, "left_anti").select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text and decodes it again: ids and digests per document."""
    ship_package(spark)
    rows = docs.select("doc_id", bpe_columns("text", VOCABULARY, keep_ids=True).alias("encoded"))
    return rows.select("doc_id", "encoded.*")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: Fingerprints, trained models and BPE have no SQL form; the tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return docs
