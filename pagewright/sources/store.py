"""Sinks: versioned tables of buckets, of which a write touches only those that change, JSON lines, and JSON documents."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import catalog


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one that all machines share (``spark.checkpoint.dir``); a local session may have none, and gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else "file://" + tempfile.mkdtemp(prefix="pagewright-")


def _put(spark: SparkSession, name: str, text: str, overwrite: bool) -> None:
    """Writes a small file beside its place and moves it there, so that readers see the old text or the new one; without ``overwrite`` it fails where there is one."""
    fs, path = _fs(spark, name)
    new = path(f"{name}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.hsync()
    stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(context.Options.Rename, 1)
    options[0] = context.Options.Rename.OVERWRITE if overwrite else context.Options.Rename.NONE
    try:
        context.FileContext.getFileContext(fs.getUri()).rename(new, path(name), options)
    except Exception:
        fs.delete(new, False)
        raise


def write_json(spark: SparkSession, path: str, payload: dict) -> None:
    """Writes a JSON document, with its fields in alphabetical order, all at once."""
    _put(spark, path, json.dumps(payload, sort_keys=True, ensure_ascii=False, default=str, indent=2) + "\n", overwrite=True)


class Conflict(RuntimeError):
    """Another writer has changed the same buckets."""


#: One step from a form of a table to the next: expressions for columns that were not there, or a function of the frame.
Upgrade = dict[str, str] | Callable[[DataFrame], DataFrame]


class Table:
    """A table in a folder: Parquet files by bucket, and a manifest for each version that tells which folder holds which bucket.

    Rows are dealt into ``buckets`` by a hash of ``key``, so rows of one key are in one bucket. ``replace`` reads and writes only the buckets whose scopes change, and takes over all others by their names.
    A version is there when its manifest is, which is put in its place in one move, and only if no other has its number: readers see the old rows or the new ones, and of two writers of one bucket the
    second begins anew. Older versions can be read until ``expire`` removes them. ``upgrades`` lead from the forms that earlier versions of this library wrote to the present one; every folder knows its
    form, and what is not rewritten is upgraded as it is read. Without a ``key`` all rows are one bucket. The number of buckets stays what it was when the table was first written.
    """

    def __init__(self, spark: SparkSession, path: str, schema, key: Sequence[str] = (), buckets: int = 64, upgrades: Sequence[Upgrade] = ()):
        self.spark, self.path, self.schema, self.key, self.upgrades = spark, path.rstrip("/"), schema, list(key), list(upgrades)
        self.buckets = buckets if self.key else 1

    def versions(self) -> list[int]:
        fs, path = _fs(self.spark, self.path)
        folder = path(f"{self.path}/_versions")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if version is None and not known:
            return self._former()
        if version is not None and version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return json.loads(self._text(f"_versions/{known[-1] if version is None else version}.json"))

    def _text(self, name: str) -> str:
        fs, path = _fs(self.spark, self.path)
        stream = fs.open(path(f"{self.path}/{name}"))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _former(self) -> dict:
        """What stands in place of a manifest where there is none: nothing, or the folder that a table of the first form points to."""
        fs, path = _fs(self.spark, self.path)
        files = []
        if fs.exists(path(f"{self.path}/CURRENT")):
            files = [{"bucket": None, "folder": self._text("CURRENT").strip(), "form": 0}]
        return {"version": 0, "buckets": self.buckets, "files": files}

    def _frame(self, files: list[dict]) -> DataFrame:
        frames = []
        for form in sorted({f["form"] for f in files}):
            frame = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f['folder']}" for f in files if f["form"] == form])
            columns = frame.columns
            for step in self.upgrades[form:]:
                frame = step(frame) if callable(step) else frame.withColumns({c: F.coalesce(F.col(c), F.expr(e)) for c, e in step.items()})
            frames.append(frame.select(*columns))
        out = frames[0] if frames else self.spark.createDataFrame([], self.schema)
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one unless it is named."""
        return self._frame(self._manifest(version)["files"])

    def scoped(self, owners: DataFrame, scope: list[str]) -> DataFrame:
        """The rows that lie in the scopes of ``owners``, from their buckets only."""
        held = self._manifest()
        touched = self._touched(held, [owners])
        return self._frame([f for f in held["files"] if f["bucket"] is None or f["bucket"] in touched]).join(owners.select(*scope).distinct(), scope, "left_semi")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.key]), F.lit(buckets)).cast("int") if self.key else F.lit(0)

    def _touched(self, held: dict, frames: Iterable[DataFrame]) -> set[int]:
        """The buckets of some rows: at most as many numbers as there are buckets."""
        if not self.key:
            return {0}
        return {r[0] for frame in frames for r in frame.select(self._bucket(held["buckets"]).alias("bucket")).distinct().collect()}

    def _files(self, rows: DataFrame, buckets: int, sort: list[str] | None) -> list[dict]:
        """Writes rows by bucket below a folder of their own. A bucket that is large is written by several tasks."""
        folder, form = f"d-{uuid.uuid4().hex}", len(self.upgrades)
        if not self.key:
            (rows.sortWithinPartitions(*sort) if sort else rows).write.parquet(f"{self.path}/{folder}")
            return [{"bucket": 0, "folder": folder, "form": form}]
        dealt = rows.withColumn("_bucket", self._bucket(buckets)).hint("rebalance", "_bucket")
        dealt.sortWithinPartitions("_bucket", *(sort or [])).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        fs, path = _fs(self.spark, self.path)
        names = [f.getPath().getName() for f in fs.listStatus(path(f"{self.path}/{folder}"))]
        return [{"bucket": int(n.split("=")[1]), "folder": f"{folder}/{n}", "form": form} for n in sorted(names) if n.startswith("_bucket=")]

    def _commit(self, held: dict, files: list[dict], touched: set[int] | None) -> int:
        """A new version with these files in place of those of the buckets ``touched`` (None: of all). What others have done to other buckets since then is kept."""
        while True:
            now = self._manifest()
            own = lambda m: sorted(f["folder"] for f in m["files"] if f["bucket"] is None or f["bucket"] in touched)
            if touched is not None and now["version"] != held["version"] and own(now) != own(held):
                raise Conflict(f"{self.path}: version {now['version']} has changed the same buckets")
            kept = [] if touched is None else [f for f in now["files"] if f["bucket"] is not None and f["bucket"] not in touched]
            version = now["version"] + 1
            text = json.dumps({"version": version, "buckets": held["buckets"], "files": [*kept, *files]}, sort_keys=True)
            try:
                _put(self.spark, f"{self.path}/_versions/{version}.json", text, overwrite=False)
            except Exception:
                if version not in self.versions():
                    raise
                continue  # another writer was first
            return version

    def write(self, rows: DataFrame, sort: list[str] | None = None) -> int:
        """Replaces the whole table and returns the new version. Sorting within files makes their statistics narrow, which takes the place of an index."""
        held = self._manifest()
        return self._commit(held, self._files(rows, held["buckets"], sort), None)

    def replace(self, rows: DataFrame, scope: list[str], owners: DataFrame | None = None, sort: list[str] | None = None) -> int:
        """What lies in the scopes that ``owners`` (or the rows) name goes, and the rows come; see ``catalog.replace_scope``. Owners have the columns of the scope, which hold those of the key.

        Only owners are asked for their buckets. Rows that turn out to be in others are found when they have been written, and then their buckets are taken in.
        """
        if not set(self.key) <= set(scope):
            raise ValueError(f"a scope of {self.path} has to hold {self.key}")
        rows = rows.select(*self.spark.createDataFrame([], self.schema).columns)
        more: set[int] = set()
        while True:
            held = self._manifest()
            touched = self._touched(held, [rows if owners is None else owners]) | more
            if not touched and rows.isEmpty():
                return held["version"]
            if any(f["bucket"] is None for f in held["files"]):
                touched |= set(range(held["buckets"]))  # a table of the first form becomes one of buckets
            old = self._frame([f for f in held["files"] if f["bucket"] is None or f["bucket"] in touched])
            files = self._files(catalog.replace_scope(old, rows, scope, owners), held["buckets"], sort)
            if more := {f["bucket"] for f in files} - touched:
                fs, path = _fs(self.spark, self.path)
                fs.delete(path(f"{self.path}/{files[0]['folder'].split('/')[0]}"), True)
                continue
            try:
                return self._commit(held, files, touched)
            except Conflict:
                continue

    def expire(self, keep: int = 1) -> int:
        """Removes all versions but the last ``keep`` and the files that no other version needs; how many folders went. Who still reads an older version loses it."""
        known = self.versions()
        gone, stay = (known[:-keep], known[-keep:]) if keep > 0 else ([], known)
        needed = {f["folder"] for v in stay for f in self._manifest(v)["files"]}
        dropped = {f["folder"] for v in gone for f in self._manifest(v)["files"]} - needed
        fs, path = _fs(self.spark, self.path)
        for v in gone:
            fs.delete(path(f"{self.path}/_versions/{v}.json"), False)
        for folder in dropped:
            fs.delete(path(f"{self.path}/{folder}"), True)
        return len(dropped)


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Appends rows as JSON lines; null fields are left out."""
    rows.write.mode("append").json(path)


def append_events(rows: DataFrame, path: str) -> None:
    """Appends events as JSON lines with their fields in alphabetical order."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(path)


def try_append(rows: DataFrame, path: str, code: str) -> list[str]:
    """Appends rows as JSON lines beside their table. That this fails is an issue, not the end of a run: the table has the rows."""
    try:
        append_jsonl(rows, path)
    except Exception as e:  # noqa: BLE001
        return [f"{code}: {type(e).__name__}"]
    return []


def overwrite_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def export_jsonl(rows: DataFrame, path: str, key: str) -> None:
    """One sorted export; range partitions keep the order over files without gathering the rows in one task."""
    rows.orderBy(key).write.mode("overwrite").json(path)


def lines(rows: DataFrame) -> DataFrame:
    """Rows as JSON text, nulls included."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("line"))
