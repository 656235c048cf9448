"""A training-text pipeline: toxicity, near copies, repeated passages, test items, token round trip.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. The first four return the
columns of the documents (extra columns pass through); the last returns one row of token digests each.

* toxicity: rows scored 0.5 or more go.
* jaccard: of each group of near copies the row with the smallest doc_id stays (null first), of equal ids
  the one whose text hashes lowest; of equal rows one stays.
* substrings: passages that stand elsewhere are cut out of the text; n_chars, where present, follows.
* decontaminate: rows with a hit go.
* encode: ids and decoded text as digests.

Null and empty texts pass the first four stages; an empty table stays empty.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import decontaminate, jaccard, substrings, toxicity
from reelspark.llm.common import checkpointed
from reelspark.llm.queries import token_digests

#: No SQL says what a trained model rejects; tests/llm compare the stages with brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    return toxicity.select_clean(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def row_key(rows: DataFrame):
        return F.struct(rows["doc_id"].alias("doc_id"), F.xxhash64(rows["text"]).alias("h"))
    found = jaccard.join(docs.select(row_key(docs).alias("row"), "text"), key="row")
    kept = checkpointed(found.filter("row <=> component_id").groupBy("row").count())
    rows = docs.join(kept, row_key(docs).eqNullSafe(kept["row"]), "left_semi")
    # Equal rows have equal keys: only where there are some, one of each is chosen.
    return rows.dropDuplicates(["doc_id", "text"]) if kept.filter("count > 1").limit(1).count() else rows


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.rewrite(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.select_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("jaccard", keep_one_of_each_group), ("substrings", cut_repeats),
          ("decontaminate", drop_contaminated), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
