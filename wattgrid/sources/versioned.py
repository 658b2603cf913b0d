"""Versioned Parquet tables (S6 S7 S8 on stored data): readers pin a version, writers commit whole ones.

A table is a folder of Parquet files that Spark wrote, manifests, and one small commit file a version:

    data/<id>/part-...parquet   files of one write, never changed
    manifests/<id>/             Parquet: file, rows, lo, hi (range of the table's range column)
    commits/0000000007.json     names version 7's manifest and what made it

A writer adds files, writes the manifest of the version it wants, and renames its commit file to
the next number; the rename fails if that number is taken. Then the writer looks at the version that won and
does its work again on that, so two concurrent inserts keep first-wins. A writer that dies before the
rename leaves files no version names: readers never see them. Commits need a store whose
rename fails on an existing file in one step (HDFS does; plain object stores do not).
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import insert_or_ignore
from ..schemas import conform

RETRIES = 20


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class VersionedTable:
    """A table at ``path`` with rows of ``schema``. Files carry the range of ``range_col`` (any ordered column)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, range_col: str):
        self.spark, self.path, self.schema, self.range_col = spark, path.rstrip("/"), schema, range_col
        self._manifest = T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
                                       T.StructField("lo", schema[range_col].dataType), T.StructField("hi", schema[range_col].dataType)])
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------ commits

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._at("commits").getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Numbers of the committed versions, rising; empty for a table that was never written."""
        fs, folder = self._fs(), self._at("commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.versions(), default=0)

    def commit_of(self, version: int) -> dict:
        """What the commit file of a version says: its manifest and the writer's notes."""
        with_ = self._fs().open(self._at("commits", f"{version:010d}.json"))
        try:
            return json.loads(bytes(with_.readAllBytes()).decode())
        finally:
            with_.close()

    def _publish(self, version: int, commit: dict) -> None:
        """Make ``version`` visible by one rename; ``Conflict`` if it exists."""
        fs, temp = self._fs(), self._at("commits", f".{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        try:
            out.write(bytearray(json.dumps(commit).encode()))
        finally:
            out.close()
        fc = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            fc.rename(temp, self._at("commits", f"{version:010d}.json"), none)
        except Exception as e:  # py4j wraps the store's error
            fs.delete(temp, False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"version {version} of {self.path} is taken") from e
            raise

    def _commit(self, version: int, manifest: DataFrame, notes: dict) -> int:
        name = uuid.uuid4().hex
        manifest.select([F.col(f.name).cast(f.dataType) for f in self._manifest]).write.parquet(f"{self.path}/manifests/{name}")
        self._publish(version, {"manifest": name, **notes})
        return version

    def _retried(self, attempt: Callable[[int], int]) -> int:
        """Run ``attempt`` on the newest version until its commit is not overtaken."""
        for _ in range(RETRIES):
            try:
                return attempt(self.latest())
            except Conflict:
                continue
        raise Conflict(f"{RETRIES} commits to {self.path} were overtaken")

    # ------------------------------------------------------------ files

    def manifest(self, version: int | None = None) -> DataFrame:
        """``file``, ``rows``, ``lo``, ``hi`` of every file of a version."""
        version = self.latest() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self._manifest)
        return self.spark.read.schema(self._manifest).parquet(f"{self.path}/manifests/{self.commit_of(version)['manifest']}")

    @staticmethod
    def _meets(ranges: list[tuple], lo: str, hi: str) -> Column:
        """Does the column pair ``lo``, ``hi`` meet any of ``ranges`` (None: open end)? NULLs lie in no range."""
        some = F.lit(False)
        for a, b in ranges:
            one = F.lit(True) if a is None else F.col(hi) >= F.lit(a)
            some = some | (one if b is None else one & (F.col(lo) <= F.lit(b)))
        return some

    def _within(self, manifest: DataFrame, ranges: list[tuple] | None) -> DataFrame:
        """Files that may hold range values in ``ranges``; all files without any."""
        return manifest if ranges is None else manifest.filter(self._meets(ranges, "lo", "hi"))

    def _files(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in files])

    def _list(self, manifest: DataFrame) -> list[str]:
        """File names for a scan, which Spark's own file index lists on the driver as well."""
        return [r["file"] for r in manifest.select("file").orderBy("file").collect()]

    def _write(self, df: DataFrame, cluster: bool) -> DataFrame:
        """Write rows to new files; their manifest. ``cluster``: files hold ranges of the range column; rows that
        share one value of it (a landing file's) are parted by the other columns, so none fills a task."""
        df = conform(df, self.schema)
        if cluster:
            others = [f.name for f in self.schema if f.name != self.range_col and isinstance(f.dataType, T.AtomicType)]
            df = df.repartitionByRange(self.range_col, *others).sortWithinPartitions(self.range_col)
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(folder + "/"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)).alias("file")
        try:
            stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        except PySparkException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # no rows, no files
                raise
            return self.spark.createDataFrame([], self._manifest)
        c = F.col(self.range_col)
        return stored.groupBy(name).agg(F.count(F.lit(1)).alias("rows"), F.min(c).alias("lo"), F.max(c).alias("hi"))

    # ------------------------------------------------------------ reading and writing

    def read(self, version: int | None = None, lo=None, hi=None, ranges: list[tuple] | None = None) -> DataFrame:
        """The rows of a version (default: the newest now), whatever is committed later. With ``lo`` or ``hi``, or
        several ``ranges``, only files that can match are listed, and the ranges are a filter that reaches the scan."""
        ranges = _ranges(lo, hi, ranges)
        out = self._files(self._list(self._within(self.manifest(version), ranges)))
        return out if ranges is None else out.filter(self._meets(ranges, self.range_col, self.range_col))

    def added(self, since: int, version: int | None = None) -> DataFrame:
        """The rows of files that ``version`` (default: the newest) has and version ``since`` did not have."""
        return self._files(self._list(self.manifest(version).join(self.manifest(since), "file", "left_anti")))

    def bounds(self, version: int | None = None) -> tuple:
        """Smallest and largest range value, from the manifest alone; Nones for a table without any."""
        return tuple(self.manifest(version).agg(F.min("lo"), F.max("hi")).first())

    def overwrite(self, df: DataFrame, notes: dict | None = None, cluster: bool = True) -> int:
        """A version that holds ``df`` alone."""
        added = self._write(df, cluster)
        return self._retried(lambda v: self._commit(v + 1, added, {"operation": "overwrite", **(notes or {})}))

    def append(self, df: DataFrame, notes: dict | None = None, cluster: bool = True) -> int:
        """The newest version and ``df``."""
        added = self._write(df, cluster)
        return self._retried(lambda v: self._commit(v + 1, self.manifest(v).unionByName(added), {"operation": "append", **(notes or {})}))

    def append_ignore(self, incoming: DataFrame, keys: list[str], order_cols: list[str], notes: dict | None = None) -> int:
        """Rows of ``incoming`` whose key no version holds yet; the first by ``order_cols`` of each key.

        The batch is written once before it is looked at, so all steps and repeats see the same rows. Stored
        rows are read only in the batch's range. A commit that another overtakes is checked
        against that one's rows anew, so whichever commits first wins.
        """
        cols = [c for c in dict.fromkeys([*self.schema.names, *order_cols]) if c in incoming.columns]
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        batch = incoming.select(*cols)
        batch.write.parquet(staged)
        batch = self.spark.read.schema(batch.schema).parquet(staged)
        b = batch.agg(F.min(self.range_col).alias("lo"), F.max(self.range_col).alias("hi"), F.count_if(F.col(self.range_col).isNull()).alias("open")).first()

        def attempt(v: int) -> int:
            # keys with a NULL range value are looked for in all files
            stored = self.read(v) if b["open"] or self.range_col not in keys else self.read(v, b["lo"], b["hi"])
            added = self._write(insert_or_ignore(batch, stored, keys, order_cols), True)
            return self._commit(v + 1, self.manifest(v).unionByName(added), {"operation": "append_ignore", **(notes or {})})
        return self._retried(attempt)

    def delete_where(self, predicate: Column, lo=None, hi=None, notes: dict | None = None) -> int:
        """S7, in place: rows for which ``predicate`` is true go (and lie between ``lo`` and ``hi``, if given);
        where it is NULL they stay, as in SQL. See ``replace_where``."""
        return self.replace_where(predicate, None, lo, hi, {"operation": "delete", **(notes or {})})

    def replace_where(self, predicate: Column | None, df: DataFrame | list[DataFrame] | None, lo=None, hi=None, notes: dict | None = None,
                      always: bool = False, ranges: list[tuple] | None = None) -> int:
        """Delete what ``predicate`` (None: nothing) matches and add ``df`` (of several, each in files of its own), in one version.

        Only files whose range can match are searched, and only those of them that hold matching rows are
        written again; all others are in the new version as they are. Without a match and without new rows no version is made,
        unless ``always`` asks for one that carries ``notes``.
        """
        added = None
        for one in [df] if isinstance(df, DataFrame) else df or []:
            more = self._write(one, True)
            added = more if added is None else added.unionByName(more)
        hit = F.lit(False) if predicate is None else predicate
        ranges = _ranges(lo, hi, ranges)
        if ranges is not None:
            hit = hit & self._meets(ranges, self.range_col, self.range_col)

        def attempt(v: int) -> int:
            manifest = self.manifest(v)
            searched = [] if predicate is None else self._list(self._within(manifest, ranges))
            touched: list[str] = []
            if searched:
                path = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[^/]+)$", 1)
                touched = sorted(r[0] for r in self._files(searched).filter(hit).select(path).distinct().collect())
            if not touched and added is None and not always:
                return v
            after = manifest
            if touched:
                kept = self._write(self._files(touched).filter(~hit.eqNullSafe(F.lit(True))), True)
                gone = self.spark.createDataFrame([(t,) for t in touched], "file string")
                after = manifest.join(gone, "file", "left_anti").unionByName(kept)
            if added is not None:
                after = after.unionByName(added)
            return self._commit(v + 1, after, {"operation": "replace", "rewritten": len(touched), **(notes or {})})
        return self._retried(attempt)


def _ranges(lo, hi, ranges: list[tuple] | None) -> list[tuple] | None:
    if ranges is None and (lo is not None or hi is not None):
        return [(lo, hi)]
    return ranges
