"""From raw documents to a training mix, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that the stage before kept. All but
the last return the columns of documents; the last one returns the manifest of the mix: one row
for each copy of a document that is taken, in the order of training, without the texts (which the
table before holds under the same doc_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import curriculum, decontaminate, line_dedup, ngram_join, quality
from cartwright.llm.common import WORD
from cartwright.llm.queries import GOOD_FROM, quality_model, table
from cartwright.sources.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs.select(*COLUMNS), model, "_score").filter(F.col("_score") >= GOOD_FROM).drop("_score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first one only; a document of which nothing
    is left, as an exact copy, goes.
    """
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(WORD)
    return kept.filter(~emptied).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles are alike by 0.8 or more, the one with the smallest id."""
    alike = ngram_join.similar_documents(docs)
    stay = alike.filter(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    return docs.select(*COLUMNS).join(stay, F.col("doc_id").eqNullSafe(F.col("_stay")), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    matched = decontaminate.with_matches(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return matched.filter(~F.col("contaminated")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the mix, one row a copy, in the order of training."""
    return curriculum.in_training_order(docs.select(*COLUMNS)).select(
        "doc_id", "lang", "source", "n_chars", "size", "source_size", "target", "taken", "copies", "copy", "copy_taken", "position"
    )


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

#: The first stage's compressor is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.stage(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
