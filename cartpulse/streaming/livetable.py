"""A live table that keeps itself small: a log of segments, merged by level, behind a manifest.

A micro-batch writes the rows it touched, with their absolute totals, as one segment of level 0, laid out by date. When
a level has ``FANOUT`` segments they are merged into one of the next level: the newest row of each key
stays, and expired rows go. So a row is rewritten once a level, and a reader opens at most ``FANOUT`` segments a level,
whatever the age of the table.

What a reader sees is a manifest: one small file that lists segments, written under the number of its
micro-batch after the segments are complete. Segments are never changed; a repeated micro-batch writes new ones and
replaces its own manifest. A reader pinned to a version keeps reading its segments while later micro-batches merge,
until ``KEEP`` newer versions exist; then the files that no kept manifest lists are removed.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cartpulse.session import exists, remove
from cartpulse.streaming.outputs import start

FANOUT = 8
KEEP = 20
SPREAD = 8  # most files of a date in a segment
_MANIFEST = "segment string, level int"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests there are, ascending."""
    if not exists(spark, f"{path}/manifest"):
        return []
    found = spark.read.schema(f"{_MANIFEST}, version bigint").parquet(f"{path}/manifest")
    return sorted(r.version for r in found.select("version").distinct().collect())


def _manifest(spark: SparkSession, path: str, version: int) -> list[tuple[str, int]]:
    """Segments of a version, oldest first, with their levels."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/version={version}").filter("segment <> ''")
    return sorted((r.segment, r.level) for r in rows.collect())


def _segments(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    found = None
    for name in names:
        rows = spark.read.parquet(f"{path}/data/{name}")
        found = rows if found is None else found.unionByName(rows)
    return found


def _newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    values = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("row"))
    return newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in values])


def _write(rows: DataFrame, path: str, batch_id: int, keys: tuple[str, ...]) -> str:
    name = f"{batch_id:012d}-{uuid.uuid4().hex}"
    # Without this every task writes a file of every date it has rows of.
    dealt = rows.repartition("event_date", F.pmod(F.xxhash64(*keys), F.lit(SPREAD)))
    dealt.write.partitionBy("event_date").parquet(f"{path}/data/{name}")
    return name


def append(batch: DataFrame, path: str, batch_id: int, keys: tuple[str, ...], fanout: int = FANOUT, keep: int = KEEP) -> None:
    """Adds the rows of one micro-batch, merges full levels and swaps the manifest. ``keys`` begin with the time
    of the row; rows carry ``expires_at`` in seconds, and expire by the newest ``updated_at`` of a merge."""
    spark = batch.sparkSession
    before = [v for v in versions(spark, path) if v < batch_id]
    segments = _manifest(spark, path, before[-1]) if before else []
    name = _write(
        batch.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "event_date": F.to_date(keys[0])}), path, batch_id, keys
    )
    table = T.StructType([*batch.schema.fields]).add("batch_id", "long").add("event_date", "date")
    if not spark.read.schema(table).parquet(f"{path}/data/{name}").isEmpty():
        segments.append((name, 0))
    level = 0
    while sum(of == level for _, of in segments) >= fanout:
        full = [s for s, of in segments if of == level]
        rows = _segments(spark, path, full)
        clock = rows.agg(F.unix_seconds(F.max("updated_at"))).scalar()
        merged = _write(_newest(rows, keys).filter(F.col("expires_at") > clock), path, batch_id, keys)
        segments = [(s, of) for s, of in segments if of != level]
        if not spark.read.schema(table).parquet(f"{path}/data/{merged}").isEmpty():
            segments.append((merged, level + 1))
        level += 1
    listed = spark.createDataFrame(sorted(segments) or [("", 0)], _MANIFEST)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={batch_id}")
    _forget(spark, path, [*before, batch_id], keep)


def _forget(spark: SparkSession, path: str, known: list[int], keep: int) -> None:
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return
    used = {s for v in kept for s, _ in _manifest(spark, path, v)}
    for version in old:
        for segment, _ in _manifest(spark, path, version):
            if segment not in used:
                remove(spark, f"{path}/data/{segment}")
        remove(spark, f"{path}/manifest/version={version}")


def live_table(
    counters: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...], every: str | None = None,
    fanout: int = FANOUT, keep: int = KEEP,
) -> StreamingQuery:
    """Keeps counters in update mode as a live table."""

    def store(batch: DataFrame, batch_id: int) -> None:
        append(batch, path, batch_id, keys, fanout, keep)

    return start(counters.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)


def read_live(
    spark: SparkSession, path: str, keys: tuple[str, ...], version: int | None = None,
    since: Column | None = None, clock: Column | None = None,
) -> DataFrame:
    """Current rows of a version (default: the newest): the newest row of each key. ``since`` reads only the
    dates from that moment on; rows expired by ``clock`` (default: the newest ``updated_at``) are left out."""
    names = [s for s, _ in _manifest(spark, path, versions(spark, path)[-1] if version is None else version)]
    rows = _segments(spark, path, names)
    if clock is None:
        clock = rows.agg(F.max("updated_at")).scalar()
    if since is not None:
        rows = rows.filter((F.col("event_date") >= F.to_date(since)) & (F.col(keys[0]) >= since))
    current = _newest(rows, keys).filter(F.col("expires_at") > F.unix_seconds(clock))
    return current.drop("batch_id", "event_date")
