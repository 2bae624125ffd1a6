"""Phrase collocations from FM-indexes over word ids.

The words of a language are indexed in shards of about ``SHARD`` words. A shard is a sequence of word ids with a
separator between pieces; its index is the Burrows-Wheeler transform of the sequence and of its
reverse. Suffixes are sorted to a depth of at least the longest phrase, which keeps every
interval up to that length exact.

A phrase is a pair of intervals, one in each transform. Extending it by a word to the left is a
backward step in the first, to the right one in the second; the other interval follows from the number of
smaller words among the extensions. All intervals of a length are extended at once: even
lengths come from extensions to the left, odd ones to the right.

Counts are summed over shards in Spark, length by length. A phrase can only be frequent if
its parts are, so a shard extends what passes a bitmap of the frequent phrases one word
shorter. The bitmap has a fixed size; a phrase let through by chance is counted like any
other and found rare, so the counts are exact whatever the bitmap holds.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.session import stored

WORDS = 3
LEAST = 10
SHARD = 1 << 17
TOP = 2000
KEEP_PERCENT = 50
SCALE = 1_000_000
BITS = 1 << 26
_PAGE = 1 << 15  # bits of one row of the bitmap
_SLICE = 1 << 20  # bytes of a text tokenized at a time
_BREAK = b"\xff"  # in no UTF-8 text
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_SEED = 42


def words_of(text: bytes):
    """Lists of words of a text in order, ``_BREAK`` at the end of a piece; slices of a long text come one by one."""
    at = 0
    while at < len(text):
        end = at + _SLICE
        if end < len(text):
            # Cut at a space or tab; a word longer than a slice stays whole.
            found = [i for i in (text.find(b" ", end), text.find(b"\t", end)) if i >= 0]
            end = min(found, default=len(text))
        part = text[at:end].lower().translate(_BREAKS)
        yield part.replace(_BREAK, b" " + _BREAK + b" ").split()
        at = end
    yield [_BREAK]


def sorted_places(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the sequence in order of the ``depth`` ids (or more) from there on, in a circle; equal ones in
    order of place. Ranks of doubled length come from pairs of ranks."""
    rank, size = ids.astype(np.int64), 1
    while size < depth:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -size)
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size *= 2
    return np.argsort(rank, kind="stable")


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The id before each place, in order of the places."""
    return ids[sorted_places(ids, depth) - 1].astype("<i4")


class Index:
    """The two transforms of one shard; id 0 separates pieces."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, n_ids: int):
        counts = np.bincount(forward, minlength=n_ids)
        self.n_ids = n_ids
        self.counts = counts
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.texts = (forward, backward)
        self.steps = tuple(self._step(t) for t in self.texts)

    @staticmethod
    def _step(text: np.ndarray) -> np.ndarray:
        """Where each place goes when its id is put in front."""
        step = np.empty(len(text), np.int64)
        step[np.argsort(text, kind="stable")] = np.arange(len(text))
        return step

    def word_intervals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start in the first, start in the second, size) of single words."""
        return self.first[ids], self.first[ids], self.counts[ids]

    def extend(self, intervals, left: bool):
        """(owner, id, intervals) of all extensions of the intervals by one word to the left or right."""
        starts, size = intervals[:2], intervals[2]
        here, there = (0, 1) if left else (1, 0)
        owner = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        place = starts[here][owner] + within
        key, at, count = np.unique(owner * self.n_ids + self.texts[here][place], return_index=True, return_counts=True)
        owner, word = key // self.n_ids, key % self.n_ids
        before = np.cumsum(count) - count
        before -= before[np.searchsorted(owner, owner)]  # smaller ids in the same interval
        new = [None, None]
        new[here] = self.steps[here][place[at]]
        new[there] = starts[there][owner] + before
        real = word > 0
        return owner[real], word[real], (new[0][real], new[1][real], count[real])


_SHARD = pa.schema(
    [("lang", pa.string()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())),
     ("forward", pa.binary()), ("backward", pa.binary())]
)
_SHARD_SPARK = "lang string, words array<binary>, counts array<long>, forward binary, backward binary"


def build(lang: str, tokens: list[list[bytes]], depth: int) -> pa.RecordBatch:
    """The index of the words of one shard as a row; the lists follow one another."""
    flat = pa.array([_BREAK, *(w for part in tokens for w in part)], pa.binary()).dictionary_encode()
    ids = flat.indices.to_numpy()  # the separator comes first, so it is 0
    forward, backward = transform(ids, depth), transform(ids[::-1], depth)
    names = flat.dictionary.to_pylist()[1:]
    counts = np.bincount(ids, minlength=len(names) + 1)[1:]
    return common.batch(_SHARD, [[lang], [names], [counts], [forward.tobytes()], [backward.tobytes()]])


def shards(docs: DataFrame, depth: int = WORDS, size: int = SHARD) -> DataFrame:
    """(lang, words, counts, forward, backward): the indexes of all texts of ``docs`` (lang, text)."""
    common.small_batches(docs.sparkSession)

    def indexed(batches):
        waiting: dict[str, list] = {}
        held: dict[str, int] = {}

        def put(lang, part):
            waiting.setdefault(lang, []).append(part)
            held[lang] = held.get(lang, 0) + len(part)

        def taken(lang):
            del held[lang]
            return build(lang, waiting.pop(lang), depth)

        for rows in batches:
            for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                for part in words_of(text):
                    put(lang, part)
                    if sum(held.values()) >= size:
                        fullest = max(held, key=held.get)
                        open_end = fullest == lang and part[-1:] != [_BREAK]
                        # What the next shard repeats of a piece still open is taken off its counts there.
                        tail = _tail(waiting[fullest], depth - 1) if open_end else []
                        yield taken(fullest)
                        if tail:
                            yield _correction(lang, tail)
                            put(lang, tail)
        for lang in list(held):
            yield taken(lang)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), common.utf8(F.col("text")).alias("text"))
    return rows.mapInArrow(indexed, _SHARD_SPARK)


def _tail(parts: list[list[bytes]], n: int) -> list[bytes]:
    """The last ``n`` words of the piece that is still open."""
    found: list[bytes] = []
    for part in reversed(parts):
        for word in reversed(part):
            if word == _BREAK or len(found) == n:
                return found[::-1]
            found.append(word)
    return found[::-1]


def _correction(lang: str, tail: list[bytes]) -> pa.RecordBatch:
    """A shard without transforms: words to count once less, with all phrases inside."""
    return common.batch(_SHARD, [[lang], [tail], [[-1] * len(tail)], [None], [None]])


def _turn(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (h << np.uint64(5) | h >> np.uint64(59)) ^ word


def _phrase_hash(lang: Column, phrase: Column) -> Column:
    """The same as ``_turn`` over the words of a phrase, starting with the language."""
    def turn(h, word):
        return F.shiftleft(h, 5).bitwiseOR(F.shiftrightunsigned(h, 59)).bitwiseXOR(F.xxhash64(word))

    return F.aggregate(F.split(phrase, " "), F.xxhash64(lang), turn)


def bitmap(frequent: DataFrame) -> np.ndarray:
    """``BITS`` bits as bytes: one is set for each phrase (lang, phrase). At most ``BITS`` / 8 bytes reach the driver."""
    place = _phrase_hash(F.col("lang"), F.col("phrase")).bitwiseAND(F.lit(BITS - 1))
    pages = (
        frequent.select(place.alias("place"))
        .groupBy(F.shiftright("place", 15).alias("page"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(_PAGE - 1)).alias("bits"))
    )
    found = np.zeros((BITS // _PAGE, _PAGE // 8), np.uint8)
    for page, bits in pages.collect():
        found[page] = np.frombuffer(bytes(bits), np.uint8)
    return found.ravel()


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h & np.uint64(BITS - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), _SEED))


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])


def enumerate_phrases(lang: str, index: Index, words: pa.Array, length: int, maps: list[np.ndarray]):
    """(phrases, counts) of the phrases of ``length`` words in one shard whose shorter parts pass the bitmaps."""
    hashes = np.array([0, *(xxhash.xxh64_intdigest(w, _SEED) for w in words.to_pylist())], np.uint64)
    start = _lang_hash(lang)
    alone = _turn(np.full(len(hashes), start), hashes)
    usable = _passes(maps[0], alone)
    usable[0] = False
    column = np.flatnonzero(usable)[:, None]  # the ids of each phrase, a row each
    intervals = index.word_intervals(column[:, 0])
    for size in range(2, length + 1):
        left = size % 2 == 0
        owner, word, intervals = index.extend(intervals, left)
        old = column[owner]
        column = np.column_stack([word, old] if left else [old, word])
        # The part that is new: all but the word at the far end.
        h = np.full(len(word), start)
        for i in range(size - 1):
            h = _turn(h, hashes[column[:, i if left else i + 1]])
        keep = usable[word] & _passes(maps[size - 2], h)
        column, intervals = column[keep], tuple(x[keep] for x in intervals)
        if size < length:
            h = np.full(len(column), start)
            for i in range(size):
                h = _turn(h, hashes[column[:, i]])
            keep = _passes(maps[size - 1], h)
            column, intervals = column[keep], tuple(x[keep] for x in intervals)
    named = [words.take(pa.array(column[:, i] - 1)) for i in range(length)]
    return pc.binary_join_element_wise(*named, pa.scalar(b" ", pa.binary())), intervals[2]


def _longer(index_rows: DataFrame, length: int, maps: list[np.ndarray]) -> DataFrame:
    shared = index_rows.sparkSession.sparkContext.broadcast(maps)

    def extended(batches):
        for rows in batches:
            for i, lang in enumerate(rows.column(0).to_pylist()):
                words, forward, backward = (rows.column(c)[i] for c in (1, 2, 3))
                words = words.values
                if not forward.is_valid:  # a correction
                    tail = words.to_pylist()
                    phrases = [b" ".join(tail[i : i + length]) for i in range(len(tail) - length + 1)]
                    counts = [-1] * len(phrases)
                else:
                    texts = (np.frombuffer(t.as_buffer(), "<i4") for t in (forward, backward))
                    phrases, counts = enumerate_phrases(lang, Index(*texts, len(words) + 1), words, length, shared.value)
                if len(phrases):
                    yield common.batch(_COUNTED, [[lang] * len(phrases), phrases, counts])

    rows = index_rows.select("lang", "words", "forward", "backward")
    return rows.mapInArrow(extended, "lang string, phrase binary, n long")


def frequent_phrases(docs: DataFrame, longest: int = WORDS, least: int = LEAST, size: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f), (lang, n)): phrases of up to ``longest`` words found ``least`` times or more, and
    all word occurrences, by language."""
    index = stored(shards(docs, longest, size), "fm-index")
    single = index.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    summed = single.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f"))
    totals = index.groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    levels, maps = [], []
    for length in range(1, longest + 1):
        if length > 1:
            counted = _longer(index, length, list(maps))
            summed = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        level = summed.where(F.col("f") >= least).select("lang", F.col("phrase").cast("string"), F.lit(length).alias("words"), "f")
        levels.append(stored(level, f"phrases-{length}"))
        if length < longest:
            maps.append(bitmap(levels[-1]))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found, totals


def _inside(phrase: Column, words: int) -> Column:
    """All shorter phrases of two words or more inside a phrase of ``words`` words."""
    parts = F.split(phrase, " ")
    return F.array(*[
        F.array_join(F.slice(parts, at + 1, size), " ")
        for size in range(2, words)
        for at in range(words - size + 1)
    ])


def collocations(
    docs: DataFrame, longest: int = WORDS, least: int = LEAST, top: int = TOP, keep_percent: int = KEEP_PERCENT,
    size: int = SHARD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase of two to ``longest`` words with a >= ``least`` occurrences is scored at its worst cut, where the
    parts occur l and r times: floor(1000000 a a / (l r)), the leftmost of equal cuts. Phrases inside a longer
    one with at least ``keep_percent`` percent of their occurrences are dropped. Ties in score fall to the larger a, then to the
    smaller phrase by bytes. A null lang is ``und``; null and empty texts hold no word. Repeated rows
    count as often as they occur. Other columns are ignored. An empty table gives an empty result. Arithmetic is
    exact for counts below 10^15."""
    found, totals = frequent_phrases(docs, longest, least, size)
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = []
    for words in range(2, longest + 1):
        parts = F.split("phrase", " ")
        of = found.where(F.col("words") == words).select("lang", "phrase", F.col("f").alias("a"))
        for k in range(1, words):
            head, tail = F.array_join(F.slice(parts, 1, k), " "), F.array_join(F.slice(parts, k + 1, words - k), " ")
            left = found.where(F.col("words") == k).select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
            right = found.where(F.col("words") == words - k).select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
            cut = of.withColumns({"head": head, "tail": tail}).join(left, ["lang", "head"]).join(right, ["lang", "tail"])
            score = F.call_function(
                "div", exact("a") * exact("a") * F.lit(SCALE).cast("decimal(7,0)"), (exact("l") * exact("r"))
            )
            cuts.append(cut.select("lang", "phrase", "a", F.struct(score.alias("score"), F.lit(k).alias("k"), "l", "r").alias("cut")))
    every = cuts[0]
    for cut in cuts[1:]:
        every = every.unionByName(cut)
    scored = every.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    covered = None
    for words in range(3, longest + 1):
        part = found.where(F.col("words") == words).select(
            "lang", F.explode(_inside(F.col("phrase"), words)).alias("phrase"), F.col("f").alias("longer")
        )
        covered = part if covered is None else covered.unionByName(part)
    if covered is not None:
        most = covered.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(most, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < keep_percent * F.col("a"))
        )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT row_number() OVER () AS id, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM pieces),
placed AS (SELECT id, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM split),
followed AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3
  FROM placed WINDOW piece AS (PARTITION BY id ORDER BY i)),
found AS MATERIALIZED (
  SELECT lang, 1 AS words, w1 AS phrase, count(*) AS f FROM followed GROUP BY ALL
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, count(*) FROM followed WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM followed WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM found WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, string_split(phrase, ' ') AS w, f AS a FROM found WHERE words > 1 AND f >= 10),
parts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : words], ' ') AS tail
  FROM candidates, (VALUES (1), (2)) AS ks(k) WHERE k < words),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
    (1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM parts c JOIN found l ON l.lang = c.lang AND l.phrase = c.head JOIN found r ON r.lang = c.lang AND r.phrase = c.tail),
worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE words = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE words = 3) GROUP BY ALL),
ranked AS (
  SELECT lang, phrase, a, l, r, CAST(score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst LEFT JOIN covered USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
