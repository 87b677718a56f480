"""Tables written in the shared checkpoint folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from typing import Any

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

BATCH = "4m"
_WRITTEN: list[str] = []
_SENT: list[Broadcast] = []
#: Folders of local sessions that name none.
_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where that is unset, a local session gets one of its own, and any other is refused: its executors share no local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="pagewright-")
    return _LOCAL[app]


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and returns a scan of it."""
    spark = df.sparkSession
    path = f"{folder(spark)}/pagewright/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch_path = path
    return found


def broadcast(spark: SparkSession, value: Any) -> Broadcast:
    """Sends a value of bounded size to the tasks; ``settle`` takes it back from the executors."""
    sent = spark.sparkContext.broadcast(value)
    _SENT.append(sent)
    return sent


def settle() -> None:
    """Frees the executors' copies of what was broadcast before. A frame that still needs one fetches it again."""
    for sent in _SENT:
        sent.unpersist()


def written() -> int:
    """A mark for ``clear``."""
    return len(_WRITTEN)


def drop(*frames: DataFrame) -> None:
    """Deletes tables that ``table`` returned and that nothing will read again."""
    for frame in frames:
        _delete(frame.sparkSession, frame.scratch_path)
        _WRITTEN.remove(frame.scratch_path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession, since: int = 0, but: DataFrame | None = None) -> None:
    """Deletes the tables that this process has written since a mark, but for one. Frames that still scan them become unreadable."""
    kept = getattr(but, "scratch_path", None)
    for path in _WRITTEN[since:]:
        if path != kept:
            _delete(spark, path)
    _WRITTEN[since:] = [p for p in _WRITTEN[since:] if p == kept]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def modest(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH`` bytes where the session has not chosen a size below Spark's default: workers hold several copies of one.

    The setting stays, as frames are evaluated after the operator has returned.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, "67108864b") in ("67108864b", "64m", "67108864"):
        spark.conf.set(name, BATCH)
