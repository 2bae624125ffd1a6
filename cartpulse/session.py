"""Session settings and the shared folder used for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. UTC keeps window grids on the UTC
# epoch; the rest lets AQE size reducers, split skewed join partitions and pick
# broadcast joins from measured sizes.
# The code size limit is the one above which the JVM refuses to compile a method:
# beyond it a fused stage would run interpreted.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit writes what changed instead of a snapshot, and a put need not look whether its key is new.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A new session; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, one for each application; on a
    cluster a missing setting is an error, because driver-local paths are not shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="cartpulse-")
    return _local_folders[context.applicationId]


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or folder wherever Spark can reach it; what is not there counts as removed."""
    files, place = _place(spark, path)
    files.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Removes all intermediate tables below the shared folder. Call it when no DataFrame made from
    them is in use any more, such as at the end of a job."""
    remove(spark, f"{shared_folder(spark)}/cartpulse")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one intermediate table."""
    return f"{shared_folder(spark)}/cartpulse/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: what follows neither
    repeats the work behind them nor loses it with an executor, and later filters can
    skip row groups."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)
