"""From raw documents to packed training sequences: STAGES in order, each over all its predecessor kept.

Every stage but the last returns the columns of documents, and those it is given besides, whatever their names. A stage takes
the written result of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chosen_path, mixing, packing, pii, quality
from tidemark.llm.common import release, stage, table, unused

#: A document is rejected if its probability of label 1 is below this.
LEAST_QUALITY = 0.5


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from the labels outside the held-out fold: documents that it rejects go."""
    score = unused(docs, "score")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, out=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group one document stays. Decisions are keyed by id and text; rows equal in both
    are told apart last, by partial aggregation."""
    key, mark, kept, copies, row = (unused(docs, c) for c in ("key", "mark", "is_kept", "copies", "row"))
    hashed = F.xxhash64("text")
    found = chosen_path.join(docs.withColumn(mark, hashed), carry=[mark])
    each = found.groupBy(F.col("doc_id").alias(key), mark).agg(F.max("kept").alias(kept), F.count("*").alias(copies))
    each = stage(each.where(f"NOT `{kept}` OR (`{copies}` > 1 AND `{key}` IS NOT NULL)"), "decisions")
    same = (F.col("doc_id").eqNullSafe(F.col(key))) & (hashed == F.col(mark))
    single = docs.join(each, same, "left_anti")
    several = docs.join(each.where(F.col(kept)), same).groupBy(key, mark).agg(F.first(F.struct(*docs.columns)).alias(row))
    return single.unionByName(several.select(f"{row}.*"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    return _sized(pii.redact(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights: documents are repeated, left out or taken in part."""
    return mixing.materialise(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048: a row per piece, with its ids' place, length and checksum."""
    return packing.pack(docs, with_ids=False)


STAGES = [("quality", classified), ("jaccard", deduplicated), ("pii", redacted), ("mixing", mixed), ("packing", packed)]
#: SQL can express neither the classifier nor the draws of the mix: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What one stage returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    before: list[DataFrame] = []
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        release(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
