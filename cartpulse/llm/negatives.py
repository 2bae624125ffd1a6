"""Hard-negative mining with rotated one-bit codes.

Vectors hold whole numbers; the score of two is their inner product. The index has for every vector, after one
fixed random rotation, the signs of its components (the code), its length, and its alignment:
the cosine between the vector and its code taken as a unit vector.

An anchor is rotated too and rounded to ``PLANES`` bits a component, so that its product with a code is a weighted
sum of popcounts. With alignment c and product t of code and anchor, the cosine lies within

    c t -+ sqrt(1 - c^2) sqrt(1 - t^2)

by Cauchy-Schwarz on the parts orthogonal to the code, and t within the length of the
anchor's rounding error of its estimate. The interval always holds, so a row whose interval misses what is
asked for is dropped without loss; the others are scored exactly, in whole numbers.

Anchors are taken in blocks of a bounded size, each broadcast to one pass over the rows. Every task keeps the best few
rows for each anchor and passes those on; tasks' lists meet in one shuffle by anchor.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.session import stored

SEED = 42
PLANES = 6
BLOCK_BYTES = 1 << 23  # of the vectors of one block of anchors
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
_ROWS, _ANCHORS = 4096, 256  # of one block of products
_NONE = -(1 << 62)


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every call."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits (..., dims) packed into 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (bits.ndim - 1) + [(0, short)])).view("<u8")


def _units(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rotated unit vectors, lengths); a zero vector stays zero."""
    wide = vectors.astype(np.float64)
    length = np.sqrt((wide * wide).sum(axis=1))
    return wide @ turn / np.where(length > 0, length, 1.0)[:, None], length


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, lengths, alignments) of the rows of ``vectors``."""
    units, length = _units(vectors, turn)
    return _words(units >= 0), length, np.abs(units).sum(axis=1) / np.sqrt(max(1, vectors.shape[1]))


class Anchors:
    """A block of anchors, ready for estimates against codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, turn: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        units, self.length = _units(vectors, turn)
        self.dims = max(1, vectors.shape[1])
        self.low = units.min(axis=1, initial=0.0)
        top = (1 << PLANES) - 1
        self.step = np.maximum(units.max(axis=1, initial=0.0) - self.low, 1e-300) / top
        level = np.clip(np.rint((units - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.uint8)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.error = np.sqrt(((units - rounded) ** 2).sum(axis=1))
        self.sum = rounded.sum(axis=1)
        self.planes = np.stack([_words(level >> j & 1) for j in range(PLANES)], axis=1)

    def products(self, at: slice, codes: np.ndarray) -> np.ndarray:
        """Estimated product of the anchors ``at`` with the codes as unit vectors, by popcounts."""
        ones = np.zeros((len(self.low[at]), len(codes)), np.float32)
        weighted = np.zeros_like(ones)
        for w in range(codes.shape[1]):
            word = codes[None, :, w]
            ones += np.bitwise_count(word)
            for j in range(PLANES):
                weighted += np.float32(1 << j) * np.bitwise_count(word & self.planes[at, j, w][:, None])
        under = self.low[at, None] * ones + self.step[at, None] * weighted
        return (2 * under - self.sum[at, None]) / np.sqrt(self.dims)

    def interval(self, at: slice, codes: np.ndarray, length: np.ndarray, alignment: np.ndarray):
        """Bounds (low, high) of the scores of the anchors ``at`` with the rows."""
        t, error = self.products(at, codes), self.error[at, None] + 1e-9
        across = np.sqrt(np.maximum(0.0, 1 - np.maximum(0.0, np.abs(t) - error) ** 2))
        reach = alignment * error + np.sqrt(np.maximum(0.0, 1 - alignment**2) + 1e-12) * across
        both = self.length[at, None] * length
        slack = 1e-9 * both + 1e-6
        return both * (alignment * t - reach) - slack, both * (alignment * t + reach) + slack


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact: in floating point where it holds all of them, else
    in 64 bits. Beyond these the job fails."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 62:
        raise OverflowError("inner products exceed 62 bits")
    return a @ b.T


class Best:
    """The first ``keep`` rows of every slot: highest score first, ties by smaller id."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, _NONE)  # a row below this is not among the first

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot = np.concatenate([self.slot, slot])
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = place < self.keep
        full = place == self.keep - 1
        self.floor[slot[full]] = score[full]
        self.slot, self.score, self.ids = slot[kept], score[kept], ids[kept]


_INDEX = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int64())), ("code", pa.binary()),
     ("length", pa.float64()), ("alignment", pa.float64())]
)
_INDEX_SPARK = "vec_id long, label long, vector array<long>, code binary, length double, alignment double"
_FOUND = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")])
_FOUND_SPARK = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def indexed(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(index, dims) of the rows (vec_id, label, vector). Vectors shorter than the longest are filled with zeros."""
    known = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<long>")
    )
    # An id that occurs more than once counts once. Only such rows are shuffled whole.
    often = known.groupBy("vec_id").count().where("count > 1").select("vec_id")
    one = known.join(often, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    single = known.join(often, "vec_id", "left_anti").unionByName(one.select("vec_id", "row.label", "row.vector"))
    rows = stored(single, "vectors")
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    turn = rotation(dims)

    def coded(batches):
        for batch in batches:
            matrix = _matrix(batch.column(2), dims)
            codes, length, alignment = encode(matrix, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(alignment)],
                schema=_INDEX,
            )

    filled = F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("vector")))
    ready = rows.select("vec_id", "label", filled.alias("vector"))
    return stored(ready.mapInArrow(coded, _INDEX_SPARK), "codes"), dims


def _gathered(batches):
    """Batches joined to at least ``_ROWS`` rows, but for the last."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= _ROWS:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting)


def _scan(index: DataFrame, dims: int, anchors: Anchors, slots: np.ndarray, bands: np.ndarray | None, keep: int) -> DataFrame:
    """One pass over the index for a block of anchors: candidates for the first ``keep`` rows of every slot.

    Without ``bands`` a slot is an anchor and takes the others of its label. With ``bands`` (anchors x slots of
    an anchor x lowest and highest score) it takes rows of other labels inside its band. ``slots`` is
    (slots, 3): anchor, positive and its score, as they are passed on."""
    shared = index.sparkSession.sparkContext.broadcast((anchors, slots, bands))

    def scanned(batches):
        anchors, slots, bands = shared.value
        each = 1 if bands is None else bands.shape[1]
        parts = [slice(i, i + _ANCHORS) for i in range(0, len(anchors.ids), _ANCHORS)]
        best = [Best(len(anchors.ids[p]) * each, keep) for p in parts]
        for table in _gathered(batches):
            ids, label = (table.column(c).to_numpy() for c in ("vec_id", "label"))
            vectors = _matrix(table.column("vector"), dims)
            codes = np.frombuffer(b"".join(table.column("code").to_pylist()), "<u8").reshape(len(ids), -1)
            length, alignment = (table.column(c).to_numpy() for c in ("length", "alignment"))
            for part, top in zip(parts, best, strict=True):
                floor = top.floor.reshape(-1, each)
                same = anchors.labels[part, None] == label
                low, high = anchors.interval(part, codes, length, alignment)
                if bands is None:
                    near = same & (anchors.ids[part, None] != ids) & (high >= floor)
                else:
                    least = np.maximum(bands[part, :, 0], floor).min(axis=1)[:, None]
                    near = ~same & (high >= least) & (low <= bands[part, :, 1].max(axis=1)[:, None])
                use = np.flatnonzero(near.any(axis=0))
                exact = scores(anchors.vectors[part], vectors[use])
                for j in range(each):
                    good = near[:, use] & (exact >= floor[:, j, None])
                    if bands is not None:
                        good &= (exact >= bands[part, j, 0][:, None]) & (exact <= bands[part, j, 1][:, None])
                    at, col = np.nonzero(good)
                    top.add(at * each + j, exact[at, col], ids[use[col]])
        for part, top in zip(parts, best, strict=True):
            of = slots[part.start * each + top.slot]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (of[:, 0], of[:, 1], of[:, 2], top.ids, top.score)], schema=_FOUND)

    return index.mapInArrow(scanned, _FOUND_SPARK)


def _first(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that satisfies
    ``anchor`` (a condition on vec_id and label) and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's.

    ``vectors`` has vec_id, label and vector (array of whole numbers); rows with a null in any of them take no part.
    Higher scores come first, ties by smaller vec_id. A vec_id that occurs more than once counts
    once, with its smallest label and vector. Shorter vectors are filled with zeros; a zero vector scores 0 with
    everything. Other columns are ignored. An empty table, or no anchor, gives an empty result."""
    spark = vectors.sparkSession
    index, dims = indexed(vectors)
    chosen = index.where(anchor).select("vec_id", "label", "vector")
    blocks = -(-chosen.count() * 8 * max(1, dims) // block_bytes)
    turn = rotation(dims)
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)))

    def block(i: int) -> Anchors:
        table = chosen.where(mine == i).toArrow().sort_by("vec_id")
        ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        return Anchors(ids, labels, _matrix(table.column("vector"), dims), turn)

    passes = []
    for i in range(blocks):
        anchors = block(i)
        slots = np.column_stack([anchors.ids, anchors.ids, np.zeros_like(anchors.ids)])
        passes.append(_scan(index, dims, anchors, slots, None, positives))
    empty = spark.createDataFrame([], _FOUND_SPARK)
    nearest = stored(_first(_union(passes, empty), positives).select("anchor_id", "vec_id", "score", "rank"), "positives")

    passes = []
    for i in range(blocks):
        anchors = block(i)
        near = nearest.where(F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)) == i).toArrow()
        at = np.searchsorted(anchors.ids, near.column("anchor_id").to_numpy())
        place = near.column("rank").to_numpy() - 1
        score, ids = near.column("score").to_numpy(), near.column("vec_id").to_numpy()
        bands = np.zeros((len(anchors.ids), positives, 2), np.int64)
        bands[:, :, 0], bands[:, :, 1] = -_NONE, _NONE  # where positives are fewer: holds nothing
        bands[at, place, 0] = -(-low * score // 100)
        bands[at, place, 1] = high * score // 100
        slots = np.zeros((len(anchors.ids) * positives, 3), np.int64)
        slots[at * positives + place] = np.column_stack([anchors.ids[at], ids, score])
        passes.append(_scan(index, dims, anchors, slots, bands, negatives))
    return _first(_union(passes, empty), negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    found = frames[0] if frames else empty
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def query(embeddings: DataFrame) -> DataFrame:
    """Anchors are the ids divisible by 100; one id in seven carries the next label."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label").cast("long")
    rows = embeddings.where(finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole.alias("vector")
    )
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""
