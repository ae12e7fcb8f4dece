"""Clean a corpus and write it as token files: ``run`` applies the stages to the documents.

Each stage works on all that the one before it kept. The last returns what the token files hold.

Cases: null and empty texts are not toxic unless the model's base score says so, form one group of
which one document stays, hold no benchmark span, and become the end id alone; a null key never
stands for its group while another document does; rows repeated in key and text are one group; a null
source is a source of its own; extra columns are carried up to the token files; an empty table gives an
empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attrition.llm.common import read, written
from attrition.llm.decontaminate import clean_documents
from attrition.llm.mixing import mix_sources
from attrition.llm.simhash import RADIUS, SHINGLE, one_of_each_group
from attrition.llm.token_files import token_files, token_report
from attrition.llm.toxicity import not_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return not_toxic(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return one_of_each_group(docs, radius=RADIUS, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a span with the benchmark go."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned towards the square root of their size."""
    return mix_sources(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, and what they hold of each document."""
    return token_report(token_files(docs.select("doc_id", "text"), ascending=False))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]
#: A trained model and tokenization are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
