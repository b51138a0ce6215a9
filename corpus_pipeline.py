"""From raw documents to a training mix: the stages in order, each an operator of permaway.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
Null and empty texts stay in all stages but the last, which copies them like others; repeated
rows are treated alike, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permaway.llm.decontaminate import remove_contamination
from permaway.llm.fuzzylines import dedup_lines_fuzzy
from permaway.llm.mixing import mix
from permaway.llm.ngramjoin import keep_first
from permaway.llm.toxicity import reject_toxic
from permaway.operators.scratch import cut


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; labels of the training fold teach the scorer."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less lines that resemble an earlier one (five-character shingles, 0.8). A document
    of which nothing but blanks is left goes; n_chars follows the text."""
    out = dedup_lines_fuzzy(docs).where("n_removed = 0 or trim(translate(text, '\t\r\n', '   ')) <> ''")
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out.select(*[chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by five-word shingles at 0.8."""
    return keep_first(docs, k=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages: spans are cut out, and documents that are mostly passages go."""
    return remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says; copy counts from 1."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs


#: Classifiers, components and draws by learned scores have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
