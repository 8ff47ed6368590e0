"""A training corpus from documents: five stages, each written as Parquet and read by the next.

toxicity         documents that are probably toxic go (score of 0.3 or more)
quality          documents that are probably bad go (score below 0.5)
near_duplicates  of each group of near-duplicate documents, the one of smallest id stays
mixing           documents are repeated or left out, so that sources meet their target weights
packing          the texts' ids, in sequences of 4096

All stages but the last return the columns of documents. Both classifiers learn from the
documents that the stage is given, where `labels` has them and the id's check sum allows.

Defined results, in every stage: other columns of documents pass untouched, whatever their names and values; a null or empty
text is a document like others (no words, no links, size 0: the mix leaves it out); a text of any length is one row and is never cut but by
packing; an empty table gives no rows. Repeated rows are judged each by itself by the classifiers and mixed and packed each
by itself; of rows of one id, and of equal texts without an id, one passes the near_duplicates stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.llm import mixing, ngram_join, packing, quality, toxicity
from texelframe.llm.common import stored, table
from texelframe.llm.queries import WORD_BPE, quality_model, toxicity_model

ROW = "pipeline_row"


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """docs with the columns that a stage uses, and all others within one, so that no name clashes with the stage's own."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("none"), *[docs[c] for c in rest]).alias(ROW))


def _unpacked(packed: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of docs, in their order."""
    return packed.select(*[F.col(c) if c in used else F.col(ROW)[c].alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return _unpacked(toxicity.score(_packed(docs, "text"), model).filter("predicted = 0"), docs, "text")


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return _unpacked(quality.score(_packed(docs, "text"), model).filter("predicted = 1"), docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_duplicates(docs)
    kept = docs.join(groups.filter("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    # few ids stand in several rows, if any: only these rows are compared with each other
    repeated = stored(docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(ROW)))
    same = kept["doc_id"].eqNullSafe(repeated[ROW])
    single = kept.join(repeated, same, "left_anti")
    several = kept.join(repeated, same, "left_semi").withColumn(ROW, F.when(F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))))
    return single.unionByName(several.dropDuplicates(["doc_id", ROW]).drop(ROW))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    used = ("doc_id", "source", "text")
    mixed = mixing.mix(_packed(docs, *used)).filter("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return _unpacked(mixed.withColumn("copy", copies), docs, *used)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_BPE, end_id=2, window=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Classifiers, shingle groups, hashed rounding and token ids: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
