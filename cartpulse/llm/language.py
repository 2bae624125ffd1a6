"""Language identification by compression.

Each language has a zstandard raw-content dictionary: whole texts of a few training documents,
chosen by hash. A text is lower-cased and cut into blocks and every block is compressed with each dictionary; the
language with the fewest bytes over the whole text wins. When the runner-up needs
hardly more bytes, the margin is narrow and the row is marked as rejected.

A language contributes at most ``DOCUMENTS`` documents and ``DICTIONARY`` bytes; with many
languages the dictionaries share ``TOTAL`` bytes, which bounds what is broadcast.
"""

from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.session import stored

DOCUMENTS = 256
DICTIONARY = 256 * 1024
TOTAL = 32 * 1024 * 1024
BLOCK = 2048  # bytes compressed at a time, small against a dictionary
LEVEL = 6
MARGIN = 0.01  # of the runner-up's bytes
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


def learn(docs: DataFrame, train) -> dict[str, bytes]:
    """Dictionary content by language, from rows that satisfy ``train`` and have text and lang.

    A language has ``DOCUMENTS`` slots; each takes the document with the smallest hash among those short enough, at most
    1/32 of the room of a dictionary. Their whole texts are taken by hash while they fit. A language without
    short documents takes the beginning of its shortest. So at most 8 x ``TOTAL`` bytes reach the driver."""
    rows = docs.where(train).where("lang IS NOT NULL AND trim(text) <> ''")
    keyed = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("hash"))
    room = min(DICTIONARY, TOTAL // max(1, rows.select("lang").distinct().count()))
    size = F.octet_length("text")
    short = size <= room // 32
    slots = (
        keyed.where(short)
        .groupBy("lang", F.pmod("hash", F.lit(DOCUMENTS)).alias("slot"))
        .agg(F.min("hash").alias("hash"), F.min_by("text", "hash").alias("text"))
    )
    texts = stored(slots.select("lang", "hash", "text"), "slots")
    long = (
        keyed.where(~short)
        .join(texts.select("lang").distinct(), "lang", "left_anti")
        .groupBy("lang")
        .agg(F.min("hash").alias("hash"), F.min_by(F.substring("text", 1, room), F.struct(size, "hash")).alias("text"))
    )
    found: dict[str, list[bytes]] = {}
    for lang, _, text in texts.unionByName(long).orderBy("lang", "hash").toLocalIterator():
        held = found.setdefault(lang, [])
        raw = text.lower().encode()
        if not held:
            held.append(raw[:room])
        elif sum(map(len, held)) + len(raw) < room:
            held.append(raw)
    return {lang: b"\n".join(held) for lang, held in found.items()}


@dataclass(frozen=True)
class Classifier:
    """Compressors by language, in the order of the languages' names."""

    languages: list
    compressors: list

    @classmethod
    def of(cls, dictionaries: dict[str, bytes]) -> "Classifier":
        languages = sorted(dictionaries)
        compressors = []
        for lang in languages:
            content = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            compressors.append(
                zstandard.ZstdCompressor(
                    dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )
        return cls(languages, compressors)

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected): the score is the share of the runner-up's bytes saved."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        raw = text.lower().encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.languages[i]))
        best = order[0]
        if len(order) == 1:
            return self.languages[best], 1.0, False
        second = sizes[order[1]]
        score = (second - sizes[best]) / second
        return self.languages[best], score, score < MARGIN


_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
     ("score", pa.float64()), ("rejected", pa.bool_())]
)


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of ``docs``.

    Whole texts are compressed. Null texts and texts without a letter are ``und`` with score 0; so is
    everything when nothing was learnt. Ties go to the first language by name. Rejected
    rows keep their nearest language. Repeated rows give repeated results; other columns are
    ignored. An empty table gives an empty result."""
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(dictionaries)

    def predicted(batches):
        classifier = Classifier.of(shared.value)
        for rows in batches:
            found = [classifier.classify(t) for t in rows.column(2).to_pylist()]
            columns = [list(c) for c in zip(*found, strict=True)] if found else [[], [], []]
            yield common.batch(_PREDICTED, [rows.column(0), rows.column(1), *columns])

    rows = docs.select(
        F.col("doc_id").cast("long"),
        (common.fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(
        predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def query(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs, common.fold(F.col("doc_id"), FOLDS) != HELD_OUT))
