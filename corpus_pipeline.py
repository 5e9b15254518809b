"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet in the shared folder and reads again as the next stage's documents. All but the
last return the columns of ``documents``; each judges its own input, all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common, decontaminate, line_dedup, packing, prob_minhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic. Null and empty texts stay (they have no word that
    tells), repeated rows are judged alike; without usable labels all documents stay."""
    common.ship(spark)
    chain = toxicity.fit(docs, toxicity.categories(docs, common.table(spark, sf_dir, "labels")))
    return toxicity.classify(docs, chain).where(~F.col("toxic")).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs; n_chars follows the text. A
    document may be left empty; a null text stays null."""
    common.ship(spark)
    kept = line_dedup.dedup(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("row.n_chars"))}
    kinds = dict(docs.dtypes)
    return kept.select(*(changed.get(c, F.col(f"row.`{c}`")).cast(kinds[c]).alias(c) for c in docs.columns))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of the least doc_id (null ids first); of repeated
    rows one. Null and empty texts are one class."""
    common.ship(spark)
    return prob_minhash.keep_one(prob_minhash.near_duplicates(docs)).select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found. Null and empty texts stay; without items all stay."""
    common.ship(spark)
    found = decontaminate.find_leaks(docs, common.table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences. A null or empty text is its end id alone,
    repeated rows are packed each; no documents give no rows."""
    common.ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: Trained and hashed stages have no SQL. Tests hold each operator against brute force or held-out labels, and the
#: stages against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
