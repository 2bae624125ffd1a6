"""First-fit decreasing packing of tokenized documents, in randomised groups.

A document is its token ids and one end id. It is cut into full pieces of the capacity, each a sequence
of its own, and a rest. Rests are dealt at random into groups of about ``GROUP`` documents, and every
group is packed by itself: longest first, each into the first sequence with enough room. A
tournament tree over the sequences holds the most room below every node, so the first one that
fits is found by one walk from the root, and a placement repairs one path.

First fit leaves small holes. The emptiest sequences, which come last, are then taken apart to fill
them, cutting where a piece is longer than a hole, and the one sequence that may stay partly
full is dealt into sequences whose lengths are powers of two, which need no padding. So no sequence is padded.

Token ids are looked up by segment. The pattern of a byte-level tokenizer never joins certain neighbouring
characters (a letter and a following space, for one), so the text is cut there and every distinct
segment is tokenized once per worker; about ``KNOWN`` segments are remembered.
"""

import functools
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.session import stored

CAPACITY = 2048
GROUP = 4096
END = 1
KNOWN = 1_000_000
_OTHER, _LETTER, _DIGIT, _PUNCT, _SPACE, _LINE, _QUOTE = range(7)


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for byte in range(128):
        char = chr(byte)
        if char.isalpha():
            table[byte] = _LETTER
        elif char.isdigit():
            table[byte] = _DIGIT
        elif char.isprintable() and char != " ":
            table[byte] = _QUOTE if char == "'" else _PUNCT
    table[ord(" ")], table[ord("\n")] = _SPACE, _LINE
    return table


def _apart() -> np.ndarray:
    """Pairs of neighbouring classes that no token spans."""
    table = np.zeros((7, 7), bool)
    for left in (_LETTER, _DIGIT, _PUNCT, _QUOTE):
        table[left, [_SPACE, _LINE]] = True  # a white-space character starts anew after any other
    for left, right in ((_LETTER, _DIGIT), (_DIGIT, _LETTER), (_PUNCT, _LETTER), (_PUNCT, _DIGIT)):
        table[left, right] = True
    for left in (_LETTER, _DIGIT):
        table[left, [_PUNCT, _QUOTE]] = True
    return table.ravel()


_CLASS, _APART = _classes(), _apart()
_SOLID = np.isin(np.arange(7), (_LETTER, _DIGIT, _PUNCT, _QUOTE))
_SOLID_BYTES = frozenset(np.flatnonzero(_SOLID[_CLASS]).tolist())


def segments(text: bytes) -> list[bytes]:
    """The text cut between characters that no token spans."""
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF: letters but for two signs
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    apart = _APART[kind[:-1] * 7 + kind[1:]]
    # After a line end too, where no other white space is next to it.
    apart[1:] |= (kind[1:-1] == _LINE) & _SOLID[kind[:-2]] & _SOLID[kind[2:]]
    cuts = (np.flatnonzero(apart) + 1).tolist()
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


class Encoder:
    """Token ids of whole texts as bytes of the narrowest unsigned type."""

    def __init__(self, path: str | None, known: int = KNOWN):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.model.encode_special_tokens = True  # their strings are ordinary text
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.sizes = np.zeros(self.model.get_vocab_size(), np.int64)  # a character of a token stands for a byte
        for token, at in self.model.get_vocab().items():
            self.sizes[at] = len(token)
        self.most, self.ids = known, {}

    def _ids(self, text: bytes) -> np.ndarray:
        found = self.model.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype)

    def _learn(self, new: list[bytes]) -> None:
        """Tokenizes new segments: those from a space to a solid character as one text, which no token spans
        between two of them, and then told apart by the bytes of the tokens."""
        pooled, alone = [], []
        for segment in new:
            whole = segment[0] == 32 and segment[-1] in _SOLID_BYTES
            (pooled if whole else alone).append(segment)
        ids = self._ids(b"".join(pooled))
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(s) for s in pooled])) + 1
        data, width, begin = ids.tobytes(), self.dtype.itemsize, 0
        for segment, end in zip(pooled, ends.tolist(), strict=True):
            self.ids[segment] = data[begin * width : end * width]
            begin = end
        for segment in alone:
            self.ids[segment] = self._ids(segment).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.ids) > self.most:
            self.ids.clear()
        parts = [segments(t) for t in texts]
        held = [list(map(self.ids.get, p)) for p in parts]
        lacking = []
        for i, ids in enumerate(held):
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                lacking.append((i, at))
        self._learn(list({parts[i][at] for i, at in lacking}))
        for i, at in lacking:
            held[i][at] = self.ids[parts[i][at]]
        return [b"".join(ids) for ids in held]


@functools.cache
def encoder(path: str | None) -> Encoder:
    return Encoder(path)


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length, in the order given: the first that has room."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins = []
    for length in lengths:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < length:
                at += 1
        bins.append(at - leaves)
        room[at] -= length
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins


def _dealt(pieces: list[tuple[int, int, int]], sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """The pieces in order, cut into runs of these sizes."""
    runs, waiting = [], pieces[::-1]
    for size in sizes:
        run = []
        while size:
            item, start, length = waiting.pop()
            taken = min(size, length)
            run.append((item, start, taken))
            size -= taken
            if taken < length:
                waiting.append((item, start + taken, length - taken))
        runs.append(run)
    return runs


def pack_group(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) that hold every item of a group, none padded: full ones, and at most
    one a power of two below the capacity."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    sequences: list[list[tuple[int, int, int]]] = []
    used: list[int] = []
    for item, at in zip(order, first_fit([lengths[i] for i in order], capacity), strict=True):
        if at == len(sequences):
            sequences.append([])
            used.append(0)
        sequences[at].append((item, 0, lengths[item]))
        used[at] += lengths[item]
    first = 0
    while first < len(sequences) - 1:
        hole = capacity - used[first]
        if not hole:
            first += 1
            continue
        item, start, length = sequences[-1].pop()
        taken = min(hole, length)
        sequences[first].append((item, start, taken))
        used[first] += taken
        used[-1] -= taken
        if taken < length:
            sequences[-1].append((item, start + taken, length - taken))
        if not used[-1]:
            sequences.pop()
            used.pop()
    if sequences and used[-1] < capacity:
        powers = [1 << bit for bit in range(used[-1].bit_length()) if used[-1] >> bit & 1]
        sequences += _dealt(sequences.pop(), powers[::-1])
    return sequences


_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("deal", pa.int64()), ("doc_tokens", pa.int64()),
     ("full", pa.list_(pa.int64())), ("rest", pa.binary())]
)
_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_PIECES_SPARK = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(docs: DataFrame, capacity: int, path: str | None) -> DataFrame:
    """Every row of ``docs`` tokenized once: its count, the checksums of its full pieces, the ids of its
    rest, and a random number for the deal."""
    common.small_batches(docs.sparkSession)

    def run(batches):
        known, nth = encoder(path), 0
        end = np.array([END], known.dtype).tobytes()
        for rows in batches:
            out = []
            for doc_id, mark, data in zip(
                rows.column(0).to_pylist(), rows.column(1).to_pylist(), known.encode(rows.column(2).to_pylist()), strict=True
            ):
                ids = np.frombuffer(data + end, known.dtype)
                whole = len(ids) // capacity
                full = [_crc(ids[i * capacity : (i + 1) * capacity]) for i in range(whole)]
                # Repeated rows differ in their place in the task, so that they spread too.
                deal = xxhash.xxh64_intdigest(b"%d %d" % (mark, nth), 42) >> 1
                out.append((doc_id, deal, len(ids), full, ids[whole * capacity :].tobytes()))
                nth += 1
            if out:
                yield common.batch(_TOKENS, [list(c) for c in zip(*out, strict=True)])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("doc_id", text).alias("mark"), text.cast("binary").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, deal long, doc_tokens long, full array<long>, rest binary")


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. ``path`` names a tokenizer file; the default is the public byte-level one.

    Null texts are empty and have one token, the end. Repeated rows, and rows without id, are packed each
    by itself. Equal lengths keep the order of the deal. Very long texts give full pieces without
    passing through a group. Other columns are ignored. An empty table gives an empty result. Sequence ids
    are unique, not consecutive."""
    rows = stored(tokenized(docs, capacity, path), "tokenized")
    rests = rows.where("length(rest) > 0")
    groups = max(1, -(-rests.count() // group))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        dtype = encoder(path).dtype
        table = table.sort_by([("deal", "ascending"), ("doc_id", "ascending")])
        doc_id, tokens = table.column("doc_id").to_pylist(), table.column("doc_tokens").to_pylist()
        ids = [np.frombuffer(b, dtype) for b in table.column("rest").to_pylist()]
        out = []
        for nth, sequence in enumerate(pack_group([len(i) for i in ids], capacity)):
            offset = 0
            for item, start, length in sequence:
                before = tokens[item] - len(ids[item])
                crc = _crc(ids[item][start : start + length])
                out.append((doc_id[item], before + start, length, crc, tokens[item], key[0].as_py() << 24 | nth, offset))
                offset += length
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)

    dealt = rests.select("doc_id", "deal", "doc_tokens", "rest", F.pmod("deal", F.lit(groups)).alias("grp"))
    tails = dealt.groupBy("grp").applyInArrow(packed, _PIECES_SPARK)
    whole = rows.select("doc_id", "doc_tokens", F.posexplode("full").alias("nth", "ids_crc32")).select(
        "doc_id",
        (F.col("nth").cast("long") * capacity).alias("start"),
        F.lit(capacity).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return tails.unionByName(whole)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)
