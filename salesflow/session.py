"""Session defaults and the shared scratch location."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Scratch folders by application, oldest first.
_OWNED: dict[str, list[str]] = {}


def build_session(app: str = "salesflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; keyword names use ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which driver and executors
    share as well; on a cluster only if it is not a path of one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
        own = warehouse.startswith(("file:", "/")) or ":" not in warehouse
        if own and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{warehouse}/_scratch"
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing else writes there.

    The session owns it: ``release`` removes it, and so does the end of the
    application. Call ``release`` once the results that read it are written.
    """
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _OWNED.setdefault(spark.sparkContext.applicationId, []).append(path)
    target, files = _hadoop(spark, path)
    files.deleteOnExit(target)
    return path


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is not there is no error."""
    target, files = _hadoop(spark, path)
    files.delete(target, True)


def publish_folder(spark: SparkSession, written: str, path: str) -> None:
    """Give a written folder its final name in one step; if another job was first, its folder stays."""
    target, files = _hadoop(spark, path)
    source, _ = _hadoop(spark, written)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(source, target):
        files.delete(source, True)
        if not files.exists(target):
            raise OSError(f"could not publish {path}")


def first_lines(spark: SparkSession, path: str, suffix: str = ".csv") -> dict[str, str]:
    """The first line of every file with that suffix in and below a folder, packed or not; names that begin with ``_`` or ``.`` are no data.

    One short read a file, many at a time; the driver holds one line a file.
    """
    target, files = _hadoop(spark, path)
    found, codecs = [], spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    listed = files.listFiles(target, True)
    while listed.hasNext():
        each = listed.next().getPath()
        below = each.toString().removeprefix(files.makeQualified(target).toString())
        if suffix in each.getName() and not any(part[:1] in ("_", ".") for part in below.split("/")):
            found.append(each)

    def line(each) -> str:
        codec, opened = codecs.getCodec(each), files.open(each)
        try:
            stream = codec.createInputStream(opened) if codec else opened
            return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
        finally:
            opened.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip((p.toString() for p in found), pool.map(line, found)))


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _hadoop(spark, path)
    return files.exists(target)


def application_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared one that the whole application uses; it goes with the application."""
    path = f"{scratch_root(spark)}/{name}-{spark.sparkContext.applicationId}"
    target, files = _hadoop(spark, path)
    files.deleteOnExit(target)
    return path


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    target, files = _hadoop(spark, path)
    return files.getContentSummary(target).getLength()


def folders(spark: SparkSession, path: str, holding: str) -> list[str]:
    """Names of the folders in ``path`` that hold a file of that name."""
    target, files = _hadoop(spark, path)
    found = files.listStatus(target) if files.exists(target) else []
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return [name for name in names if files.exists(_hadoop(spark, f"{path}/{name}/{holding}")[0])]


def release(spark: SparkSession, keep: int = 0) -> None:
    """Remove the scratch folders the application made after its first ``keep``."""
    owned = _OWNED.get(spark.sparkContext.applicationId, [])
    for path in owned[keep:]:
        remove(spark, path)
    del owned[keep:]


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving whatever was staged inside; write results before that."""
    before = len(_OWNED.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, before)


def streaming_session(spark: SparkSession, partitions: int = 8, tasks_per_core: int = 3) -> SparkSession:
    """A session of the same application whose stateful queries use few shuffle partitions.

    Each shuffle partition of a running aggregate is a state store that every
    micro-batch opens and commits. Groups are few and rows are combined
    before the shuffle, so the count need not follow the data; it is also
    fixed for the life of a checkpoint. A micro-batch of files is read by
    several tasks a core: one a core, give or take a few, leaves most cores
    waiting for the few that come last.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.files.minPartitionNum", str(tasks_per_core * spark.sparkContext.defaultParallelism))
    return session


@contextlib.contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB, so that it need not fit the executors' heap.

    A micro-batch uploads its own changes; whole snapshots follow in the background.
    """
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextlib.contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept while the block lasts, for what reads it several times at once.

    Not packed: choosing a packing for every column costs as much as parsing
    the messages did, and the rows are needed for a few reads only.
    """
    key, conf = "spark.sql.inMemoryColumnarStorage.compressed", df.sparkSession.conf
    before = conf.get(key)
    conf.set(key, "false")
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
        conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and return the written table.

    Cuts the lineage durably: a lost executor re-reads files instead of
    recomputing (and possibly re-ordering) what came before.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
