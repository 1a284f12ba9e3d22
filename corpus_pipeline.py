"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage takes what its predecessor kept and, but for the last, gives rows with the columns of ``documents``. Null and empty texts
pass through all stages, and rows without an id or with a repeated one are judged like any other unless a stage says
otherwise. An empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm._frames import written
from sluice.llm.decontamination import decontaminate
from sluice.llm.line_dedup import line_dedup
from sluice.llm.near_dedup import drop_near_copies
from sluice.llm.packing import pack
from sluice.llm.queries import tokenizer_path
from sluice.llm.toxicity import drop_toxic, learn


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more; the lexicon is learnt from the labels that are not held out.

    A null text stays; equal texts stay or go together.
    """
    return drop_toxic(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five or more documents stay in the last of these only; all documents stay.

    Rows of one id count as one document, and so do rows without an id; a null text stays null.
    """
    found = line_dedup(docs)
    changed = F.col("n_dropped") > 0
    values = {name: F.col("row")[name] for name in docs.columns}
    values["text"] = F.when(changed, F.col("kept_text")).otherwise(values["text"])
    if "n_chars" in values:
        length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(changed, length).otherwise(values["n_chars"])
    return found.select(*[value.alias(name) for name, value in values.items()])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, with the least id (null before all others), among rows of that id by a hash of the text.

    Of rows equal in both any one stays. Texts without words are no copies of each other and all stay.
    """
    return drop_near_copies(docs, one_row=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which benchmark passages are a twentieth or more.

    A null text has no words and stays. Benchmark items without an id count as well; null ones have no words.
    """
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnamed=True)
    return found.where(~F.col("contaminated")).select(*[F.col("row")[name].alias(name) for name in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids.

    A null or empty text is its closing id alone; repeated rows are packed as often as they come.
    """
    return pack(docs, tokenizer_path(), added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Scores learnt from labels and a tokenizer's ids are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents`` in ``sf_dir``; what each stage gives is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs)
    return docs
