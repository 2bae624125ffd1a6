"""Quality rules with adaptive thresholds.

Per document: counts and rates of symbols, repeated lines and repeated 5-word windows, and the mean
word length. Per language and source, mergeable KLL sketches of each rate are merged
further to languages and to all documents.

The upper threshold of a rate is its quantile ``UPPER`` plus a multiple (``RATES``) of the distance from the median to there. Where that
distance is below the unit of the rate in the group, the unit stands for it: one symbol, one repeated line, one repeated window
or one word of double length in a text of median length there. Mean word length has a lower threshold too, by the quantile
1 - ``UPPER``. The thresholds of a group are averaged with those of its language, and these with those of all documents,
weighted by documents against ``WEIGHT``, so small groups lean on what is around them. Documents join
their thresholds and are kept when within them. Nothing is fixed but these parameters.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.session import stored

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WEIGHT = 200
SKETCH_K = 4096  # rank error below 0.1 %
UPPER = 0.8
RATES = {"symbol_rate": 6.0, "line_rate": 2.0, "repeat_rate": 8.0, "word_length": 10.0}
_SKETCHED = (*RATES, "n_words", "n_lines")
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts: dict = {}
    for window in windows:
        counts[window] = counts.get(window, 0) + 1
    covered = reach = 0  # ``reach``: first word not covered yet
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + WINDOW - max(at, reach)
            reach = at + WINDOW
    return covered


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one UTF-8 text."""
    words = common.words_of(text)
    joined = text.translate(None, _SPACE)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURED = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), ("n_lines", pa.int64())]
    + [(c, pa.int64()) for c in _COUNTS]
)


def _measured(batches):
    for rows in batches:
        texts = rows.column(3).to_pylist()
        counts = [measure(t) for t in texts]
        columns = [list(c) for c in zip(*counts, strict=True)] if counts else [[]] * len(_COUNTS)
        lines = [t.count(b"\n") + 1 for t in texts]
        yield common.batch(_MEASURED, [*(rows.column(i) for i in range(3)), lines, *columns])


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every row of ``docs`` (doc_id, lang, source, text) and the rates the rules use."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        common.utf8(F.col("text")).alias("text"),
    )
    schema = "doc_id long, lang string, source string, n_lines long, " + ", ".join(f"{c} long" for c in _COUNTS)
    counted = rows.mapInArrow(_measured, schema)
    words = F.greatest(F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counted.select(
        "*",
        failed.alias("base_failed"),
        (F.col("n_symbols") / words).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.col("n_lines")).alias("line_rate"),
        (F.col("n_repeat_words") / words).alias("repeat_rate"),
        (F.col("word_chars") / words).alias("word_length"),
    )


def _bounds(groups: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, bounds): per rate the own thresholds of each group, and whether the unit decided the upper one."""
    at = lambda c, q: F.kll_sketch_get_quantile_double(F.col(c), F.lit(q))
    words = F.greatest(at("n_words", 0.5), F.lit(1.0))
    units = {
        "symbol_rate": 1 / words,
        "line_rate": 1 / F.greatest(at("n_lines", 0.5), F.lit(1.0)),
        "repeat_rate": WINDOW / words,
        "word_length": at("word_length", 0.5) / words,
    }
    columns = []
    for rate, times in RATES.items():
        low, middle, high = at(rate, 1 - UPPER), at(rate, 0.5), at(rate, UPPER)
        columns += [
            (high + times * F.greatest(high - middle, units[rate])).alias(f"{rate}_max"),
            (low - times * F.greatest(middle - low, units[rate])).alias(f"{rate}_min"),
            (high - middle < units[rate]).alias(f"{rate}_by_unit"),
        ]
    return groups.select(*keys, "n", F.struct(*columns).alias("bounds"))


def _mixed(n: Column, own: Column, around: Column, weight: float) -> Column:
    """Own thresholds averaged with those around, by ``n`` documents against ``weight``."""
    fields = [f"{rate}_{end}" for rate in RATES for end in ("max", "min")]
    return F.struct(
        *[((n * own[f] + weight * around[f]) / (n + weight)).alias(f) for f in fields],
        *[own[f"{rate}_by_unit"].alias(f"{rate}_by_unit") for rate in RATES],
    )


def thresholds(rates: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """(lang, source, n, bounds) for every group among ``rates``; nulls are values like any other."""
    sketches = stored(
        rates.groupBy("lang", "source").agg(
            F.count("*").alias("n"),
            *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_K)).alias(c) for c in _SKETCHED],
        ),
        "sketches",
    )
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(c, F.lit(SKETCH_K)).alias(c) for c in _SKETCHED]]
    total = _bounds(sketches.agg(*merged).where("n > 0")).select(F.col("bounds").alias("all_bounds"))
    # One row at most: thresholds of all documents.
    languages = _bounds(sketches.groupBy("lang").agg(*merged), "lang").join(F.broadcast(total)).select(
        F.col("lang").alias("of"), _mixed(F.col("n"), F.col("bounds"), F.col("all_bounds"), weight).alias("around")
    )
    fine = _bounds(sketches, "lang", "source")
    wide = fine.join(languages, fine["lang"].eqNullSafe(languages["of"]))
    return wide.select("lang", "source", "n", _mixed(F.col("n"), F.col("bounds"), F.col("around"), weight).alias("bounds"))


def judge(docs: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """One row per row of ``docs``: its counts, base_failed and kept.

    Null and empty texts have no words and fail the base rule. Documents that fail it do not
    shape the thresholds. Repeated rows count and appear as often as they occur; other
    columns are ignored. An empty table gives an empty result. Sketches of more than ``SKETCH_K`` values draw
    random bits, so in larger groups a document within 0.1 % of rank of a threshold may be judged otherwise in another run."""
    rates = stored(measured(docs), "rates")
    bounds = thresholds(rates.where("NOT base_failed"), weight).select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "bounds"
    )
    match = rates["lang"].eqNullSafe(bounds["of_lang"]) & rates["source"].eqNullSafe(bounds["of_source"])
    within = F.col("word_length") >= F.col("bounds.word_length_min")
    for rate in RATES:
        within &= F.col(rate) <= F.col(f"bounds.{rate}_max")
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    return rates.join(bounds, match, "left").select("doc_id", *_COUNTS, "base_failed", kept.alias("kept"))


def query(docs: DataFrame) -> DataFrame:
    return judge(docs)
