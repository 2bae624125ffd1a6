"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and everything but letters and digits becomes one space. An item matches a
document that holds a passage within ``budget`` edits (insert, delete, replace) of it, for
items of n characters ``ERROR_RATE`` x n edits, rounded down. An item is cut into budget + 1
pieces; k edits leave at least one piece untouched, so an automaton over all pieces finds every
possible passage by exact hits. Around each hit, Myers' bit-parallel distance (1999)
decides on the passage. Items too short for any edit match whole words only.

Items are broadcast in blocks of at most ``BLOCK_CHARS`` characters; a larger benchmark takes
another pass over the documents for each block, so no block grows with the data.
"""

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import common

ERROR_RATE = 0.08
BLOCK_CHARS = 4_000_000
_APART = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    return _APART.sub(" ", text.lower()).strip()


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item of ``length`` characters; short items must match exactly."""
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece): ``errors`` + 1 consecutive pieces of nearly equal length."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """Bit i of a character's mask is set where the item holds it at i."""
    found: dict[str, int] = {}
    for i, char in enumerate(item):
        found[char] = found.get(char, 0) | 1 << i
    return found


def best_passage(mask: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(edits, end) of the passage of ``text`` nearest to the item; the first end among equals."""
    every, top = (1 << length) - 1, 1 << (length - 1)
    up, down, edits = every, 0, length
    best, end = length, 0
    for at, char in enumerate(text):
        equal = mask.get(char, 0)
        vertical = equal | down
        level = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (every & ~(level | up)), up & level
        if rise & top:
            edits += 1
        elif fall & top:
            edits -= 1
            if edits < best:
                best, end = edits, at + 1
        rise, fall = (rise << 1) & every, (fall << 1) & every
        up, down = fall | (every & ~(vertical | rise)), rise & vertical
    return best, end


def _whole_words(text: str, begin: int, end: int) -> bool:
    return text[begin - 1 : begin] in ("", " ") and text[end : end + 1] in ("", " ")


class Matcher:
    """Automaton over the pieces of one block of (item_id, normalised text)."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items = []
        owners = defaultdict(list)
        for item_id, text in items:
            errors = budget(len(text), rate)
            at = len(self.items)
            self.items.append((item_id, len(text), errors, masks(text)))
            for start, piece in pieces(text, errors):
                owners[piece].append((at, start))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, begin, end) of the nearest passage for each item within its budget;
        begin supposes a passage as long as the item."""
        windows = defaultdict(list)
        for last, (length, where) in self.automaton.iter(text) if len(self.automaton) else ():
            for at, start in where:
                _, size, errors, _ = self.items[at]
                begin = last + 1 - length - start
                if not errors and not _whole_words(text, begin, begin + size):
                    continue
                low, high = max(0, begin - errors), min(len(text), begin + size + errors)
                spans = windows[at]
                if spans and low <= spans[-1][1] and high >= spans[-1][0]:
                    spans[-1] = (min(low, spans[-1][0]), max(high, spans[-1][1]))
                else:
                    spans.append((low, high))
        found = []
        for at, spans in windows.items():
            item_id, size, errors, mask = self.items[at]
            nearest = min(
                (edits, low + end)
                for low, high in spans
                for edits, end in [best_passage(mask, size, text[low:high])]
            )
            if nearest[0] <= errors:
                edits, end = nearest
                found.append((item_id, edits, max(0, end - size), end))
        return found


def _blocks(benchmark: DataFrame):
    """Distinct items in blocks of bounded size, one block in the driver at a time. Items without
    letters or digits are left out; texts that several items share keep each item."""
    block, size = [], 0
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text")
    for item_id, text in items.distinct().toLocalIterator():
        plain = normalised(text or "")
        if not plain:
            continue
        block.append((item_id, plain))
        size += len(plain)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
     ("first_word", pa.int64()), ("last_word", pa.int64())]
)
_SPARK = "doc_id long, item_id long, edits int, first_word long, last_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, edits of the nearest passage and
    the words (of the normalised text) at which it begins, about, and ends.

    Documents without a match have no row. Null and empty texts match nothing; null
    items and items without letters or digits neither. Repeated documents repeat their
    rows; repeated items count once. Of passages equally near the one that ends first counts within its
    stretch of the text. Other columns are ignored. Empty tables give an empty result."""
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    result = spark.createDataFrame([], _SPARK)
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def matched(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                out = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    plain = normalised(text)
                    for item_id, edits, begin, end in matcher.find(plain):
                        out.append(
                            (doc_id, item_id, edits, plain.count(" ", 0, begin), plain.count(" ", 0, end))
                        )
                if out:
                    yield common.batch(_FOUND, [list(c) for c in zip(*out, strict=True)])

        result = result.unionByName(rows.mapInArrow(matched, _SPARK))
    return result


def _free_of(shared, rate: float):
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, rate)
        for texts in batches:
            yield pd.Series([not matcher.find(normalised(t)) for t in texts], dtype=bool)

    return F.pandas_udf(free, "boolean")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept whatever their names.

    Null and empty texts stay. Repeated rows stay or go together; empty tables change nothing."""
    spark = docs.sparkSession
    common.small_batches(spark)
    for block in _blocks(benchmark):
        free = _free_of(spark.sparkContext.broadcast(block), rate)
        docs = docs.where(free(F.coalesce("text", F.lit(""))))
    return docs


query = contaminated
