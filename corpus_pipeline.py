"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; each is written to the shared folder and
read back as the input of the next, so a lost executor never reaches behind the last stage."""

from pyspark.sql import DataFrame, SparkSession

from cartpulse.llm import contamination, lines, neighbours, packing, simhash
from cartpulse.llm.common import table
from cartpulse.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote accepts; the vote is learnt from the labelled ones among them."""
    model = neighbours.learnt(docs, table(spark, sf_dir, "labels"))
    return neighbours.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines."""
    return lines.without_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.query(docs)


STAGES = [
    ("quality", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences: doc_id, copy, piece, start, n_tokens, sequence, offset, source, cluster.

    Nulls, empty and repeated rows fare as the stages' operators say: null and empty texts have no words and give a row
    without a sequence, of repeated rows one stays. An empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
