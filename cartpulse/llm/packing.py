"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

Lengths are word counts plus one separator. Text longer than the capacity is cut into pieces;
full pieces are sequences of their own, the rest of each document is packed. A sequence holds
at most one piece of each source and one of each duplicate cluster.

Rests are dealt into groups of about ``GROUP`` rows by hash, after repeated rows were
counted, so no key decides the size of a group; only ids and numbers are shuffled, never texts.
Inside a group, pieces go longest first into the open sequence with the least room that is
enough and without conflict. Open sequences are ordered by room: a bit per room value that occurs
gives the successor of a length, and the search goes on to the next larger room until a
compatible sequence is found. Each sequence carries bitmaps of its sources and clusters;
clusters get a bit where the group holds them at least twice.
"""

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.session import stored

CAPACITY = 2048
GROUP = 4096


def best_fit(lengths, sources, clusters, capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece, in the order given; None in ``clusters`` means no cluster."""
    source_bit: dict = {}
    seen = Counter(c for c in clusters if c is not None)
    cluster_bit = {key: i for i, key in enumerate(k for k, n in seen.items() if n > 1)}
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some open sequence has room r
    held_sources: list[int] = []
    held_clusters: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 1 << source_bit.setdefault(source, len(source_bit))
        c = 1 << cluster_bit[cluster] if cluster in cluster_bit else 0
        found, above = None, rooms >> length << length
        while above and found is None:
            room = (above & -above).bit_length() - 1
            above &= above - 1
            for at, b in enumerate(by_room[room]):
                if not (held_sources[b] & s or held_clusters[b] & c):
                    found = b
                    by_room[room].pop(at)
                    if not by_room[room]:
                        rooms &= ~(1 << room)
                    break
        if found is None:
            found, room = len(held_sources), capacity
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[found] |= s
        held_clusters[found] |= c
        by_room[room - length].append(found)
        rooms |= 1 << (room - length)
        placed.append((found, capacity - room))
    return placed


def n_words(text: Column) -> Column:
    """Runs of bytes other than space and 0x09-0x0D."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def cluster_of(text: Column) -> Column:
    """Equal for texts that differ only in case and white space; null without words."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    folded = F.trim(F.lower(spaced))
    return F.when(folded != "", F.xxhash64(folded))


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("copy", pa.int32()), ("piece", pa.int32()), ("start", pa.int64()),
     ("n_tokens", pa.int32()), ("sequence", pa.string()), ("offset", pa.int32()),
     ("source", pa.string()), ("cluster", pa.int64())]
)
_SPARK = (
    "doc_id long, copy int, piece int, start long, n_tokens int, sequence string, offset int, "
    "source string, cluster long"
)


def pack(lengths: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(doc_id, length, source, cluster) rows to one row per piece: doc_id, copy (which of several
    equal rows), piece, start and n_tokens in the document, sequence, offset in it.

    Documents of no tokens give one row without a sequence. A null source is a source like any
    other; a null cluster conflicts with nothing. Equal lengths are placed by doc_id, cluster and copy. An empty table
    gives an empty result."""
    rows = stored(
        lengths.select(
            F.col("doc_id").cast("long"), F.col("length").cast("long"), "source", F.col("cluster").cast("long")
        )
        .groupBy("doc_id", "length", "source", "cluster")
        .count()
        .withColumn("copy", F.explode(F.expr("sequence(0, int(count) - 1)")))
        .select(
            "doc_id", "copy", "source", "cluster",
            F.floor(F.col("length") / capacity).cast("int").alias("full"),
            (F.col("length") % capacity).cast("int").alias("rest"),
        ),
        "rests",
    )
    groups = max(1, -(-rows.where("rest > 0").count() // group))
    key = F.xxhash64("doc_id", "copy", "source", "cluster", "full", "rest")

    def packed(table: pa.Table) -> pa.Table:
        low = -(1 << 63)
        pieces = sorted(
            table.to_pylist(),
            key=lambda r: (-r["rest"], *(low if r[k] is None else r[k] for k in ("doc_id", "cluster", "copy"))),
        )
        column = {k: [r[k] for r in pieces] for k in table.column_names}
        placed = best_fit(column["rest"], column["source"], column["cluster"], capacity)
        names = [f"{r['grp']}-{b}" for r, (b, _) in zip(pieces, placed, strict=True)]
        out = [
            column["doc_id"], column["copy"], column["full"], [f * capacity for f in column["full"]],
            column["rest"], names, [at for _, at in placed], column["source"], column["cluster"],
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(out, _ARROW, strict=True)], schema=_ARROW)

    rests = rows.where("rest > 0").withColumn("grp", F.pmod(key, F.lit(groups)))
    tails = rests.groupBy("grp").applyInArrow(packed, _SPARK)
    owner = F.concat_ws("-", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(key))
    full = (
        rows.where("full > 0")
        .select("*", owner.alias("owner"), F.explode(F.expr("sequence(0, full - 1)")).alias("piece"))
        .select(
            "doc_id", "copy", "piece", (F.col("piece").cast("long") * capacity).alias("start"),
            F.lit(capacity).alias("n_tokens"), F.concat_ws("-", "owner", "piece").alias("sequence"),
            F.lit(0).alias("offset"), "source", "cluster",
        )
    )
    empty = rows.where("full = 0 AND rest = 0").select(
        "doc_id", "copy", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).alias("n_tokens"), F.lit(None).cast("string").alias("sequence"),
        F.lit(None).cast("int").alias("offset"), "source", "cluster",
    )
    return tails.unionByName(full).unionByName(empty)


def query(docs: DataFrame) -> DataFrame:
    """Pack documents (doc_id, text, source); equal texts up to case and white space are a cluster."""
    words = n_words(F.col("text"))
    lengths = docs.select(
        "doc_id",
        F.when(words > 0, words + 1).otherwise(0).alias("length"),
        F.col("source").cast("string"),
        cluster_of(F.col("text")).alias("cluster"),
    )
    return pack(lengths)
