"""Session helpers: tuning values, the shared folder, written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Largest lookup table (in rows, counted after it was written) that may be broadcast.
MAX_BROADCAST_ROWS = ("shelfcast.broadcast.maxRows", 1_000_000)
# A group with more rows than this is processed in several pieces.
HOT_ROWS = ("shelfcast.skew.hotRows", 5_000_000)
# Rows from which exact quantiles narrow brackets of the wanted ranks instead of counting every value.
NARROW_ROWS = ("shelfcast.quantiles.narrowRows", 20_000_000)
# By pigeonhole at most this many groups can be hot, so a list of them is small.
MAX_HOT_GROUPS = 10_000

_own_dirs: dict[str, str] = {}


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; a cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # Join by hash instead of sorting when every partition measured at run time is small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Fits of a parameter search run at the same time and share the cores.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tuning(spark: SparkSession, setting: tuple[str, int]) -> int:
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session may fall back to a temp folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="shelfcast-")
    return _own_dirs[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, gives Spark the true size. ``codec`` is the files'
    compression if it shall not be the session's."""
    path = new_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a settled table that nothing reads any more."""
    spark = df.sparkSession
    own = shared_dir(spark).rsplit("/", 1)[-1]
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if f"/{own}/" in folder:  # only what ``settle`` wrote
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``settle`` plus the number of rows, counted by the same write job."""
    seen = Observation()
    table = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return table, int(seen.get.get("rows") or 0)
