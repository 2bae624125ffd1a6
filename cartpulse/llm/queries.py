"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartpulse.llm import (
    chat,
    contamination,
    contexttree,
    firstfit,
    language,
    lines,
    negatives,
    neighbours,
    packing,
    phrases,
    rules,
    simhash,
    warc,
)
from cartpulse.llm.common import table


def _over(operator, *names: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(*(table(spark, sf_dir, name) for name in names))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": _over(chat.query, "conversations"),
        "op2_neighbour_quality": _over(neighbours.query, "documents", "labels"),
        "op3_simhash_dedup": _over(simhash.query, "documents"),
        "op4_line_dedup": _over(lines.query, "documents"),
        "op5_warc": _over(warc.query, "pages"),
        "op6_best_fit_packing": _over(packing.query, "documents"),
        "op7_decontamination": _over(contamination.query, "documents", "benchmark"),
        "op8_language": _over(language.query, "documents"),
        "op9_context_tree": _over(contexttree.query, "documents"),
        "op10_quality_rules": _over(rules.query, "documents"),
        "op11_hard_negatives": _over(negatives.query, "embeddings"),
        "op12_first_fit_packing": _over(firstfit.query, "documents"),
        "op13_collocations": _over(phrases.query, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat.SQL,
        "op4_line_dedup": lines.SQL,
        "op5_warc": warc.SQL,
        "op11_hard_negatives": negatives.SQL,
        "op13_collocations": phrases.SQL,
    }
