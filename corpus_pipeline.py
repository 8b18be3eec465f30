"""Corpus pipeline: stages of training-data operators, each a Parquet table to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlab.llm import common, jaccard, langid, packing, quality, queries, substrings


def _packed(docs: DataFrame) -> DataFrame:
    """docs with all its columns once more in `_doc`, which no operator's column can clash with."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or look unlike the trusted target, go.

    Each row is judged by its own text: repeated rows share a fate, an id may have several.
    Null, empty and wordless texts fail; very long ones are read whole; a score at the
    threshold stays. An empty table gives an empty table; columns of any name come through.
    """
    found = quality.quality_rules(_packed(docs), common.table(spark, sf_dir, "labels"), carry=("_doc",))
    return found.where("kept").select("_doc.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or whose two best languages are close, go.

    Without labels nothing can be told and all go. Null texts and those without a letter go;
    so do ties of two languages. Repeated rows share a fate; very long texts are scored whole.
    An empty table gives an empty table; columns of any name come through.
    """
    found = langid.identify(_packed(docs), langid.fit(docs), carry=("_doc",))
    return found.where(f"lang_pred <> '{langid.UNKNOWN}' and not ambiguous").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the least id.

    Rows, not ids, stay or go: an id may have several texts. A row without an id goes
    if its class has one with an id. Of repeated rows one stays; rows without words are
    like nothing and all stay. An empty table gives an empty table; columns of any name
    come through as they are.
    """
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all documents but the first that has them; what is emptied by that goes.

    Documents are in order of their ids (null ids last, texts of one id by a hash). Rows alike
    in id and text get the same result. Null, empty and wordless texts stay as they are; very
    long ones are cut whole. `n_chars`, where there is one, is the new length of a text that
    was cut. An empty table gives an empty table; columns of any name come through.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_rest")
    found = substrings.dedup_substrings(docs.select("doc_id", "text", rest), carry=("_rest",))
    found = found.where("removed_bytes = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    columns = []
    for c in docs.columns:
        old = F.col(f"_rest.`{c}`") if c != "text" else F.col("text")
        if c == "n_chars":
            old = F.when(F.col("removed_bytes") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(old)
        columns.append(old.alias(c))
    return found.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences.

    Null and empty texts are the closing id alone; repeated rows are packed as often as they
    come; very long texts are cut. Which documents of one length meet depends on the order
    of the rows. An empty table gives no pieces; columns but doc_id and text are left out.
    """
    return packing.pack_documents(docs, queries.WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

#: The stages hash and train models, which SQL can't express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
