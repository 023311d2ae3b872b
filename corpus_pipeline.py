"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents left by the one before and the folder of the
tables, and gives a table that is written before the next one reads it, in the shared folder
named by ``spark.checkpoint.dir``; so a lost executor costs a task of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavebook.llm import decontaminate, line_dedup, minhash, packing, toxicity
from wavebook.llm.common import fresh, table
from wavebook.llm.language import held_out
from wavebook.llm.queries import tokenizer_path
from wavebook.session import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; learned from labelled documents that are not held out.

    Null and empty texts have no terms and stay.
    """
    machine = toxicity.fit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0)
    )
    score = fresh("score")
    return toxicity.score(docs, machine, score).where(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line once, in the first document that has it or a line two edits away at most.

    Lines under 20 characters stay wherever they stand: taken out of running text, a repeated
    verse, heading or answer leaves a gap.
    """
    return line_dedup.drop_repeated_lines(docs, least_equal=line_dedup.LEAST_CHARACTERS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return minhash.keep_one(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, by sequence and offset, with their ids."""
    pieces = packing.pack_texts(docs, "doc_id", "text", tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        F.col("total_tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained model and a tokenizer take part, which SQL has none of.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
