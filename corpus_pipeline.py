"""A corpus pipeline of the operators: documents in, packed pieces out.

Every stage but the last returns the columns of documents, as they were; columns
beside doc_id, text and source pass through whatever their names. A null text counts as
empty; rows with a null id are treated like others. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from navrecon.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from navrecon.llm.common import staged, table
from navrecon.llm.queries import WORDS


#: Words whose ids a worker keeps in packing. Fewer than in op1, as its executors still hold memory of the stages before.
CACHED = 150_000


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic score of one half or more go.

    The field is fitted to the labelled documents of this stage's input; a document without
    a label is scored like others, and without any label no document goes. Null and empty
    texts are scored as texts without tokens. Equal texts have equal scores, so all
    copies go or stay. Very long texts are scored whole.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).where("toxic_score < 0.5").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays: the longest original, then the smallest id.

    Texts are equal without their white space. All null and empty texts are one text,
    of which one row stays; of repeated rows one stays.
    """
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the smallest id.

    Similar are texts of which four fifths of the shingles of five words align. Null and empty
    texts are one class; a text of fewer than five words is similar to equal words only.
    """
    return near_dedup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, documents of small sources twice at most.

    A second copy is a row like the first: this stage returns the columns of documents
    only, and packing places each copy by itself, so the order of the mixture (mix_at) ends
    here. A null source is a source of its own; an empty text counts one token.
    """
    return mixing.mix_sources(docs, target_entropy=0.95, max_passes=2.0).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their sequence and offset; a null or empty text is one piece of one id.

    Copies of a document have the same doc_id and start, and places of their own.
    """
    return packing.pack(docs, WORDS, 2048, cached=CACHED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", harmless), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("packing", packed)]

#: Sequence tagging, sketches and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
