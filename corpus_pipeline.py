"""A corpus in five stages: language, near-duplicates, benchmark spans, source mixture, token records.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the last
return the columns of ``documents``; texts from which benchmark spans were cut get a new ``n_chars``.

Defined results
    * A null text, an empty one and one without a letter have no language, and go with the first stage.
    * A null id is larger than any other; rows that repeat id and text are copies, of which one stays.
    * Ties of places in the mixture are taken or left together; a document that is taken twice is two rows.
    * Long texts are taken whole. No documents, or none that stay, give no records; no benchmark cuts nothing.
    * Further columns are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleloom.llm.common import stored, table, working_path
from titleloom.llm.decontamination import decontaminate
from titleloom.llm.language_id import keep_identified
from titleloom.llm.mixing import mix
from titleloom.llm.queries import tokenizer_path
from titleloom.llm.simhash_dedup import keep_representatives
from titleloom.llm.token_records import read_records, write_records


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close copies, whose fingerprints link at the values of op7_simhash_dedup.

    Of near copies at a shingle similarity of 0.8 few are linked; README has the measured shares.
    """
    return keep_representatives(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without spans of benchmark items; those that are mostly such spans go."""
    cleaned = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return cleaned
    size = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars").cast("bigint"))
    return cleaned.withColumn("n_chars", size).select(*docs.columns)


def blend(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: rows as often as their source's target takes them."""
    return mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records on disk, and what reading them back gives."""
    path = working_path(spark, "corpus-records")
    write_records(docs, path, tokenizer_path())
    return read_records(spark, path, with_ids=False)


STAGES = [
    ("language_id", identify),
    ("simhash_dedup", deduplicate),
    ("decontamination", clean),
    ("source_mixture", blend),
    ("token_records", tokenise),
]

#: No SQL for the first two stages and the last; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
