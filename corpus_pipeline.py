"""From raw documents to a training mixture, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.llm import contamination, language, line_dedup, mixing, near_dedup
from hearthmill.sources.shared import settle

# Below this mean the words of a text, each taken by itself, belong to no language.
LEAST_CERTAINTY = 0.4
# Whoever reads a text five words at a time sees the same passage.
WORDS_PER_SHINGLE = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters go, and texts whose words, one by one, fit no language.

    Texts that mix languages stay: their words are certain one by one. If no
    row has a language there is nothing to judge by, and only texts without
    letters go. Null and empty texts have no letters. Repeated rows share
    their fate; texts of any length are judged whole; an empty table stays
    empty. Columns stay as they are, whatever they are named.
    """
    field = language.fit(language.training_rows(docs))
    if not field.labels:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    labelled = docs.withColumn("__language", language.language_column(docs, field))
    accepted = (F.col("__language.lang_pred") != language.UNDETERMINED) & (F.col("__language.certainty") >= LEAST_CERTAINTY)
    return labelled.filter(accepted).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents stay in one of them, that of the largest doc_id.

    No row goes, not even one that loses all its lines; a null text stays null.
    Of rows that repeat, each keeps the line if it has that doc_id.
    """
    return line_dedup.drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest doc_id.

    Shingles are of five words. Texts without words stay; of rows that repeat
    one stays, also where ids are null. Texts of any length are compared whole.
    """
    return near_dedup.drop_near_duplicates(docs, gram=WORDS_PER_SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more quotes the benchmark go.

    Texts without words stay, and all do if the benchmark is empty. Repeated
    rows share their fate.
    """
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in flatter proportions; every document is used, small sources are repeated.

    Null sources are one source. Texts without words carry no weight and go;
    repeated rows count one by one. Adds mix_copy and mix_position.
    """
    return mixing.mixed_rows(docs, mixing.Target(cover=True))


STAGES = [
    ("language ID", language_id),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

# The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
