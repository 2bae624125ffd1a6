"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set where more than half of the XXH64 hashes of its 3-word shingles
have it. Fingerprints link at ``RADIUS`` or fewer differing bits, and linked documents form
components.

Pairs are found among distinct fingerprints only:

* Every fingerprint has a row of Hamming distances to ``PIVOTS`` reference fingerprints,
  computed once. Two fingerprints within ``RADIUS`` bits differ by at most ``RADIUS`` in
  every coordinate, so a pair with a larger difference anywhere is discarded; what
  survives is verified on the fingerprints themselves.
* Pairs come from buckets: of four 16-bit blocks, two are equal in any pair within two bits,
  so each fingerprint is filed under the six pairs of blocks.
* A bucket of more than ``CROWD`` fingerprints would give pairs by the square of its size.
  Its members are linked exactly in another way: each is filed under all fingerprints within
  one bit of it. Two are within two bits if and only if they meet in such a place, and all
  that meet there are linked, so a link to the smallest one is enough. The work is 65
  rows for each member, whatever the bucket holds.

A text that differs from another in some words mostly has a fingerprint more than two bits away.
``tables`` > 1 takes more fingerprints of the same shingles, from hashes mixed again. Documents
that any of them links within two bits are linked, whatever the buckets hold. On top of that, texts
are compared that share a MinHash key of the same shingles (``candidates``), on all their fingerprints
together, whose share of differing bits measures the similarity of the texts.

* Each of ``BANDS`` keys is made of ``ROWS`` minima. A pair of Jaccard similarity s shares a key with
  probability 1 - (1 - s^5)^24: 0.9999 at 0.8.
* All pairs of a bucket of up to ``MEMBERS`` texts are compared. In a larger one every text is compared
  with the smallest, and all are filed again under two keys, and where these are crowded too
  under three. Of pairs at 0.8 that meet in crowded buckets only, 0.986 share two such keys
  and 0.76 three. This work is linear in the number of texts, whatever the buckets hold.
* What these pairs leave apart in a crowded bucket is compared in full (``apart``): every pair of its texts that is
  not yet in one component, in tiles of ``TILE`` texts a side. So any two texts that share a key and pass
  the verification end in one component. Texts of the bucket's largest component are not compared with each other, so a group
  of near copies costs its size times the texts outside it.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.llm import common
from cartpulse.llm.components import connected
from cartpulse.session import stored

SHINGLE = 3
SEED = 42
RADIUS = 2
SIMILARITY = 0.8
PIVOTS = 32
CROWD = 8
BANDS, ROWS = 24, 5
MEMBERS = 16
TILE = 1024
_LANES = np.uint64(0x0101010101010101)
_FLIPS, _FACTORS = np.random.default_rng(SEED).integers(1 << 63, size=(2, BANDS * ROWS, 1), dtype="<u8") * 2 + 1


def _mixed(hashes: np.ndarray, tables: int) -> np.ndarray:
    """One row a table: the hashes themselves, then mixed by the finalizer of SplitMix64 with an offset."""
    offsets = np.array([0x9E3779B97F4A7C15 * t % (1 << 64) for t in range(tables)], "<u8")
    h = hashes + offsets[:, None]
    if tables > 1:
        h[1:] = (h[1:] ^ (h[1:] >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h[1:] = (h[1:] ^ (h[1:] >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h[1:] ^= h[1:] >> np.uint64(31)
    return h


def _majorities(hashes: np.ndarray, tables: int) -> list[int]:
    """One fingerprint a table: a bit is one if more than half of the hashes have it."""
    counts = np.zeros((tables, 8, 8), np.int64)  # by byte and bit
    for at in range(0, len(hashes), 255):  # a byte counts no further
        mixed = _mixed(hashes[at : at + 255], tables)
        for bit in range(8):
            lanes = (mixed >> np.uint64(bit) & _LANES).sum(axis=1, dtype="<u8")
            counts[:, :, bit] += lanes.view(np.uint8).reshape(tables, 8)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return np.packbits(bits.reshape(tables, 64), axis=1, bitorder="little").view("<u8").ravel().tolist()


def _hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of the shingles of one text, repeated ones as often as they occur; none without words."""
    words = common.words_of(text.lower())
    if not words:
        return np.zeros(0, "<u8")
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], dtype="<u8")


def fingerprint(text: bytes, shingle: int = SHINGLE, tables: int = 1) -> list[int]:
    """64-bit fingerprints of one text, unsigned; all 0 without words."""
    hashes = _hashes(text, shingle)
    return _majorities(hashes, tables) if len(hashes) else [0] * tables


def _bands(hashes: np.ndarray) -> list[int]:
    """``BANDS`` MinHash keys of the shingles; none without shingles."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo("<u8").max, "<u8")
    for at in range(0, len(hashes), 255):
        np.minimum(least, ((hashes[at : at + 255] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(rows)]


def _key(docs: DataFrame) -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark")]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, tables: int = 1) -> DataFrame:
    """(doc_id, mark, fp, fp1, ...) for every row of ``docs``: a hash of the text and its fingerprints
    as signed longs; with several ``tables`` also its MinHash keys (bands)."""
    common.small_batches(docs.sparkSession)
    names = ["doc_id", "mark", "fp", *(f"fp{t}" for t in range(1, tables))]
    fields = [(name, pa.int64()) for name in names]
    ddl = ", ".join(f"{name} long" for name in names)
    if tables > 1:
        fields.append(("bands", pa.list_(pa.int64())))
        ddl += ", bands array<long>"
    schema = pa.schema(fields)

    def fingerprinted(batches):
        for rows in batches:
            prints, bands = [], []
            for text in rows.column(2).to_pylist():
                hashes = _hashes(text, shingle)
                prints.append(_majorities(hashes, tables) if len(hashes) else [0] * tables)
                bands.append(_bands(hashes) if tables > 1 else None)
            columns = [*np.array(prints, np.uint64).reshape(-1, tables).T.copy().view(np.int64)]
            if tables > 1:
                columns.append(bands)
            yield common.batch(schema, [rows.column(0), rows.column(1), *columns])

    rows = docs.select(*_key(docs), common.utf8(F.col("text")).alias("text"))
    return rows.mapInArrow(fingerprinted, ddl)


def pivots() -> list[int]:
    """Reference fingerprints, by rule: hashes of the numbers from 0."""
    return [xxhash.xxh64_intdigest(str(i), SEED) - (1 << 63) for i in range(PIVOTS)]


def _distances(fp: Column) -> Column:
    """The row of the pivot table: one distance a byte."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()])


def _buckets() -> Column:
    """Six keys: table, which two blocks, their bits."""
    block = [f"(shiftrightunsigned(fp, {16 * i}) & 65535L)" for i in range(4)]
    keys = [
        f"shiftleft(tab, 40) | shiftleft({4 * i + j}L, 32) | shiftleft({block[i]}, 16) | {block[j]}"
        for i in range(4)
        for j in range(i + 1, 4)
    ]
    return F.expr(f"array({', '.join(keys)})")


def links(prints: DataFrame) -> DataFrame:
    """(tab, a, b): enough links between distinct fingerprints (tab, fp) to connect all of the same
    table that are within ``RADIUS`` bits of each other, and no others."""
    prints = prints.select(F.col("tab").cast("long"), "fp")
    filed = prints.select("fp", F.explode(_buckets()).alias("bucket"))
    sizes = stored(filed.groupBy("bucket").count().where("count > 1"), "buckets")
    shared = filed.join(sizes, "bucket")
    tab = F.shiftrightunsigned("bucket", 40).alias("tab")

    few = shared.where(F.col("count") <= CROWD).select("bucket", "fp", _distances(F.col("fp")).alias("row"))
    left, right = (few.select("bucket", F.col("fp").alias(n), F.col("row").alias(f"row_{n}")) for n in "ab")
    apart = F.zip_with("row_a", "row_b", lambda x, y: F.abs(x - y) > RADIUS)
    survivors = left.join(right, "bucket").where((F.col("a") < F.col("b")) & ~F.exists(apart, lambda x: x))
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    verified = survivors.where(bits <= RADIUS).select(tab, "a", "b")

    crowded = shared.where(F.col("count") > CROWD).select(tab, "fp").distinct()
    around = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    places = crowded.select("tab", "fp", F.explode(around).alias("place"))
    met = places.groupBy("tab", "place").agg(F.min("fp").alias("first"), F.count("*").alias("n"))
    starred = (
        places.join(met.where("n > 1"), ["tab", "place"])
        .where("fp <> first")
        .select("tab", F.col("fp").alias("a"), F.col("first").alias("b"))
    )
    return verified.unionByName(starred).distinct()


def _met(filed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, crowded) of rows (sign, key, ...): the pairs (a, b), a < b, to compare in every bucket, and
    the rows of buckets of more than ``MEMBERS``, which give only the pairs with the smallest sign."""
    sizes = filed.groupBy("key").agg(F.count("*").alias("n"), F.min("sign").alias("least"))
    shared = filed.join(stored(sizes.where("n > 1"), name), "key")
    few = shared.where(F.col("n") <= MEMBERS).select("key", "sign")
    left, right = (few.select("key", F.col("sign").alias(side)) for side in "ab")
    pairs = left.join(right, "key").where("a < b").select("a", "b")
    crowded = shared.where(F.col("n") > MEMBERS)
    starred = crowded.where("least < sign").select(F.col("least").alias("a"), F.col("sign").alias("b"))
    return pairs.unionByName(starred).distinct(), crowded.drop("key", "n", "least")


def candidates(texts: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct texts (sign, bands) to compare: those that share a MinHash key, by
    two and three keys where one is crowded. A text has at most ``BANDS`` + 6 x ``BANDS`` rows."""
    band = F.posexplode("bands").alias("band", "key")
    pairs, crowded = _met(texts.select("sign", band), "bands")
    # Of two keys at most three places apart, both crowded; the third is ten to sixteen places on.
    at = lambda i: f"bands[({i}) % {BANDS}]"
    couples = F.expr(
        f"flatten(transform(sequence(0, {BANDS - 1}), i -> transform(sequence(1, 3), o -> struct("
        f"i AS i, (i + o) % {BANDS} AS j, xxhash64({at('i')}, {at('i + o')}, i, o) AS key, "
        f"xxhash64({at('i')}, {at('i + o')}, {at('i + 3 * o + 7')}, i, o) AS third))))"
    )
    hot = stored(crowded.groupBy("sign").agg(F.collect_set("band").alias("hot")), "crowded")
    both = lambda c: F.array_contains("hot", c["i"]) & F.array_contains("hot", c["j"])
    # Filtered inside the array: a text gives a row only for two crowded keys.
    filed = hot.join(texts, "sign").select("sign", F.explode(F.filter(couples, both)).alias("c"))
    more, crowded = _met(filed.select("sign", "c.key", "c.third"), "couples")
    last, _ = _met(crowded.withColumnRenamed("third", "key"), "triples")
    return pairs.unionByName(more).unionByName(last).distinct()


def most_bits(tables: int, similarity: float) -> float:
    """Bits in which the fingerprints of texts of this similarity differ, and one standard deviation.

    Sets of shingles of Jaccard similarity s and like size have the cosine 2s / (1 + s); the
    share of differing bits is the angle over pi."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = 64 * tables
    return bits * share + math.sqrt(bits * share * (1 - share))


def _alike(pairs: DataFrame, texts: DataFrame, tables: int, similarity: float) -> DataFrame:
    """Edges (a, b) of first fingerprints for the pairs (a, b) of texts (sign, fp, prints) whose
    fingerprints differ in no more than ``most_bits``."""
    a, b = (texts.select(F.col("sign").alias(x), F.col("fp").alias(f"fp_{x}"), F.col("prints").alias(f"of_{x}")) for x in "ab")
    differing = F.aggregate(
        F.zip_with("of_a", "of_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, d: n + d
    )
    near = pairs.join(a, "a").join(b, "b").where((F.col("fp_a") != F.col("fp_b")) & (differing <= most_bits(tables, similarity)))
    return near.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))


def apart(texts: DataFrame, roots: DataFrame, tables: int, similarity: float) -> DataFrame:
    """Edges (a, b) of the components (fp, root) so far: enough to connect all texts (sign, fp, prints, bands)
    that share a MinHash key in a bucket of more than ``MEMBERS`` and differ in at most ``most_bits``.

    The texts of a bucket outside its largest component are compared with all of it that are in other components."""
    of_texts = stored(texts.join(roots, "fp").select("sign", "root", "prints", "bands"), "rooted-texts")
    filed = of_texts.select("sign", "root", F.explode("bands").alias("key"))
    kinds = filed.groupBy("key", "root").agg(F.count("*").alias("n"))
    buckets = kinds.groupBy("key").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("kinds")
    )
    mixed = buckets.where((F.col("n") > MEMBERS) & (F.col("kinds") > 1)).select(
        "key",
        F.col("main.root").alias("main"),
        F.ceil(F.col("n") / TILE).cast("int").alias("wide"),
        F.ceil((F.col("n") - F.col("main.n")) / TILE).cast("int").alias("high"),
    )
    met = stored(filed.join(stored(mixed, "mixed"), "key"), "met").join(of_texts.select("sign", "prints"), "sign")
    part = lambda n: F.pmod(F.xxhash64("sign"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = met.where("root <> main").select(
        "key", "main", part("high").alias("i"), every("wide").alias("j"), *(F.col(c).alias(f"{c}_a") for c in ("sign", "root", "prints"))
    )
    b = met.select(
        "key", every("high").alias("i"), part("wide").alias("j"), *(F.col(c).alias(f"{c}_b") for c in ("sign", "root", "prints"))
    )
    bits = [F.bit_count(F.get("prints_a", F.lit(t)).bitwiseXOR(F.get("prints_b", F.lit(t)))) for t in range(tables)]
    once = (F.col("root_b") == F.col("main")) | (F.col("sign_a") < F.col("sign_b"))
    near = (F.col("root_a") != F.col("root_b")) & once & (sum(bits[1:], bits[0]) <= most_bits(tables, similarity))
    return a.join(b, ["key", "i", "j"]).where(near).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, tables: int = 1, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, mark, fp, root, component_id.

    ``component_id`` is the smallest doc_id reachable through links, itself included; ``root``
    is the smallest fingerprint. Null and empty texts have fingerprint zero and link like
    any other. Repeated rows give repeated results. A null doc_id is never smallest; a
    component without any id has a null one. Other columns of ``docs`` are ignored. An empty
    table gives an empty result."""
    rows = stored(fingerprints(docs, shingle, tables), "fingerprints")
    of_text = F.array("fp", *(f"fp{t}" for t in range(1, tables)))
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    # Every fingerprint of every table stands for the smallest first fingerprint it occurs with.
    every = F.posexplode(of_text).alias("tab", "print")
    occurs = rows.select("fp", every).distinct()
    prints = stored(
        occurs.groupBy("tab", F.col("print").alias("fp")).agg(F.min("fp").alias("stands")), "prints"
    )
    a = prints.select("tab", F.col("fp").alias("a"), F.col("stands").alias("of_a"))
    b = prints.select("tab", F.col("fp").alias("b"), F.col("stands").alias("of_b"))
    near = links(prints).join(a, ["tab", "a"]).join(b, ["tab", "b"])
    edges = near.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    if tables > 1:
        same = occurs.join(a.withColumnRenamed("a", "print"), ["tab", "print"]).where("fp <> of_a")
        # Texts that agree in all fingerprints and keys are one.
        signed = rows.select("fp", of_text.alias("prints"), "bands", F.xxhash64(of_text, "bands").alias("sign"))
        texts = signed.groupBy("sign").agg(*[F.first(c).alias(c) for c in ("fp", "prints", "bands")])
        texts = stored(texts, "texts")
        pairs = candidates(texts.select("sign", "bands"))
        edges = edges.unionByName(_alike(pairs, texts, tables, similarity)).unionByName(
            same.select(F.col("fp").alias("a"), F.col("of_a").alias("b"))
        )
    rooted = classes.join(connected(edges).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    if tables > 1:
        rooted = stored(rooted, "rooted")
        more = connected(apart(texts, rooted.select("fp", "root"), tables, similarity)).select(
            F.col("node").alias("root"), F.col("root").alias("next")
        )
        rooted = rooted.join(more, "root", "left").select("fp", "first", F.coalesce("next", "root").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    components = rooted.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(components, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def query(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 5, tables: int = 16) -> DataFrame:
    """One row of ``docs`` for each component: that with its smallest doc_id.

    Among rows with this id (or without id, where none has one) that with the smallest text
    hash stays; of repeated rows one stays. All columns are kept, whatever their names."""
    found = near_duplicates(docs, shingle, tables).where("doc_id <=> component_id")
    chosen = found.groupBy("root").agg(F.first("doc_id").alias("id"), F.min("mark").alias("hash"))
    rows = docs.select(*_key(docs), F.struct("*").alias("doc"))
    match = rows["doc_id"].eqNullSafe(chosen["id"]) & (rows["mark"] == chosen["hash"])
    once = Window.partitionBy("doc_id", "mark").orderBy("mark")
    whole = rows.join(chosen, match).withColumn("nth", F.row_number().over(once))
    return whole.where("nth = 1").select("doc.*")
