"""A training corpus from ``documents``, in five stages.

quality      documents that the pairwise-ranked classifier rejects go
simhash      one document of each near-duplicate group stays: the smallest id
decontaminate  documents that contain benchmark text go
secrets      every secret found is masked in the text; all documents stay
mix          each source is repeated or thinned to its target share

A stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``, whatever they are; the last returns the mix: one row per
document that is taken, with its number of copies.

Repeated rows are near-duplicates of each other, so one stays. A null text is
an empty one: it is scored, grouped with other empty texts, never contaminated,
holds no secret and is never taken by the mix. Null ids come last in a group.
Empty tables give an empty mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, mixing, quality_rank, secret_scan, simhash
from lodestone.llm.common import discarding, materialize, read_table, shared_folder

MASK = "[SECRET]"
QUALITY_CUT = 0.3
#: The stages cannot be expressed in SQL: classifier, fingerprints, tokenizer, rounding.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rank.train(docs, read_table(spark, sf_dir, "labels"), cut=QUALITY_CUT)
    return quality_rank.annotate(docs, model).filter(F.col("score") >= QUALITY_CUT).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = materialize(simhash.annotate(docs, shingle_words=4)
                         .withColumn("nth", F.monotonically_increasing_id()), "stage-simhash")
    # the key of a row: ids in order, nulls last; the place in the written table tells repeated rows apart
    key = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "nth")
    first = simhash.classes(marked.select("fp", key.alias("doc_id")), radius=4) \
        .select(F.col("component_id.nth").alias("nth")).distinct()
    return marked.join(first, "nth", "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.annotate(docs, read_table(spark, sf_dir, "benchmark"), window_words=13)
    return found.filter(~F.col("contaminated")).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.annotate(docs, mask=MASK)
    clean = F.col("found.clean")
    changed = {"text": F.coalesce(clean, F.col("row.text")),
               "n_chars": F.when(clean.isNotNull(), F.char_length(clean)).otherwise(F.col("row")["n_chars"])
               if "n_chars" in docs.columns else None}
    return found.select(*[changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed
                          else F.col("row")[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).filter(F.col("copies") > 0)


STAGES = [
    ("quality", keep_quality),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    root = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for at, (name, stage) in enumerate(STAGES):
        path = f"{root}/{at}-{name}"
        with discarding():
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
