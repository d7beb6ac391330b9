"""Tables in buckets by key, of which a load rewrites only those that its rows fall into.

A table is a folder: ``data/version=V/bucket=B`` holds Parquet files, ``manifest/version=V`` says which
version's files make up each bucket. A load writes new files for the buckets it touches and then a new
manifest; readers see the table of the last whole manifest, all other files stay untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources import writers

BUCKET = "_bucket"
_MANIFEST = "bucket int, data_version int, n_buckets int, key array<string>, fields string, note long"


class BucketTable:
    """A table at ``path``, with its rows dealt to buckets by a hash of the key columns.

    Keys may hold nulls (null columns hash like any value). Loads follow one another; two at the same
    time are not coordinated.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    # What the manifest says

    def _manifest(self) -> tuple[int, list]:
        """Number and rows of the last whole manifest; -1 and none before the first load. A row per bucket and part."""
        numbers = (int(name.rpartition("=")[2]) for name in self._list(f"{self.path}/manifest") if name.startswith("version="))
        for number in sorted(numbers, reverse=True):
            folder = f"{self.path}/manifest/version={number}"
            # a load that broke off has not come to its end mark
            if "_SUCCESS" in self._list(folder):
                return number, self.spark.read.schema(_MANIFEST).parquet(folder).collect()
        return -1, []

    @property
    def version(self) -> int:
        return self._manifest()[0]

    @property
    def key(self) -> list[str]:
        return self._manifest()[1][0]["key"]

    @property
    def note(self) -> int:
        """A number that the last load left with the table, 0 at first."""
        return self._manifest()[1][0]["note"]

    @property
    def n_buckets(self) -> int:
        return self._manifest()[1][0]["n_buckets"]

    def exists(self) -> bool:
        return self.version >= 0

    def _in_buckets(self, df: DataFrame, key: list[str], n: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(n)).cast("int"))

    def _files(self, manifest: list, buckets: set[int] | None = None) -> list[str]:
        return sorted({f"{self.path}/data/version={r['data_version']}/{BUCKET}={r['bucket']}" for r in manifest if buckets is None or r["bucket"] in buckets})

    def _rows(self, manifest: list, buckets: set[int] | None = None) -> DataFrame:
        fields = manifest[0]["fields"]
        files = self._files([r for r in manifest if r["data_version"] >= 0], buckets)
        # explicit paths, so folders of other buckets and versions are not even listed
        return self.spark.read.schema(fields).parquet(*files) if files else self.spark.createDataFrame([], fields)

    # Reading

    def read(self) -> DataFrame:
        """The whole table as of now; later loads do not change what this frame reads."""
        _, manifest = self._manifest()
        if not manifest:
            raise ValueError(f"no table at {self.path}")
        return self._rows(manifest)

    def buckets_of(self, df: DataFrame) -> set[int]:
        """Buckets that the keys of ``df`` fall into: at most as many numbers as the table has buckets."""
        return set(self._dealt(df, self._manifest()[1]))

    def _dealt(self, df: DataFrame, manifest: list) -> dict[int, int]:
        """How many rows of ``df`` fall into each bucket that any does."""
        dealt = self._in_buckets(df.select(*manifest[0]["key"]), manifest[0]["key"], manifest[0]["n_buckets"])
        return dict(dealt.groupBy(BUCKET).count().collect())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the table with the keys in ``keys``; files of other buckets are not read."""
        _, manifest = self._manifest()
        own, dealt = manifest[0]["key"], self._dealt(keys, manifest)
        return self._rows(manifest, set(dealt)).join(writers.by_rows(keys.select(*own), sum(dealt.values())), own, "left_semi")

    # Loading

    def create(self, df: DataFrame, key: list[str], buckets: int, note: int = 0) -> None:
        """The table anew from ``df``; what was there before stays readable for frames that read it."""
        version, _ = self._manifest()
        head = {"n_buckets": buckets, "key": key, "fields": ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in df.schema.fields), "note": note}
        self._load(df, version, [], head, set(range(buckets)), keep=False)

    def rewrite(self, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> set[int]:
        """Put ``combine(old rows, delta)`` in place of the buckets that ``delta`` touches; returns these.

        ``combine`` must keep rows in their bucket, that is not change keys. The delta is evaluated twice
        unless it is a stored table: for its buckets and for the load.
        """
        version, manifest = self._manifest()
        touched = set(self._dealt(delta, manifest))
        if touched:
            old = self._rows(manifest, touched)
            self._load(combine(old, delta).select(old.columns), version, manifest, manifest[0].asDict(), touched, keep=False)
        return touched

    def append(self, df: DataFrame, note: int | None = None) -> set[int]:
        """Add rows beside those that are there, without reading any; returns the buckets they fall into."""
        version, manifest = self._manifest()
        touched = set(self._dealt(df, manifest))
        if touched:
            head = manifest[0].asDict()
            self._load(df, version, manifest, head | {"note": head["note"] if note is None else note}, touched, keep=True)
        return touched

    def upsert(self, new: DataFrame, order: str | None = None) -> set[int]:
        """Put the rows of ``new`` in by key, all columns; of several with one key the last by ``order``."""
        from cadastra.operators import keys

        own = self.key
        return self.rewrite(new, lambda old, fresh: keys.upsert(old, fresh, own, order))

    def merge(self, new: DataFrame, policy: dict[str, str]) -> set[int]:
        """Upsert with a rule per column (new, old, coalesce)."""
        from cadastra.operators import keys

        own = self.key
        return self.rewrite(new, lambda old, fresh: keys.merge(old, fresh, own, policy))

    def _load(self, rows: DataFrame, version: int, manifest: list, head: dict, touched: set[int], keep: bool) -> None:
        number = version + 1
        dealt = self._in_buckets(rows, head["key"], head["n_buckets"])
        # a bucket's rows come together; adaptive execution splits a bucket that is too large for a task
        dealt.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/version={number}")
        filled = self._filled(number)
        left = [(r["bucket"], r["data_version"]) for r in manifest if keep or r["bucket"] not in touched]
        # an empty bucket has no folder; a table without any row keeps one line that names no files
        parts = [p for p in left if p[1] >= 0] + [(b, number) for b in sorted(touched & filled)] or [(0, -1)]
        lines = [(b, v, head["n_buckets"], head["key"], head["fields"], head["note"]) for b, v in parts]
        self.spark.createDataFrame(lines, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={number}")

    def _filled(self, number: int) -> set[int]:
        found = self._list(f"{self.path}/data/version={number}")
        return {int(name.rpartition("=")[2]) for name in found if name.startswith(f"{BUCKET}=")}

    def _list(self, folder: str) -> list[str]:
        path, system = self._system(folder)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _system(self, folder: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def files(self) -> dict[str, int]:
        """The table's files and when each was written (milliseconds)."""
        found = {}
        for folder in self._files([r for r in self._manifest()[1] if r["data_version"] >= 0]):
            path, system = self._system(folder)
            found |= {s.getPath().toString(): s.getModificationTime() for s in system.listStatus(path) if s.getPath().getName().startswith("part-")}
        return found

    def vacuum(self) -> None:
        """Delete files that the last manifest does not name; frames over earlier versions stop working."""
        version, manifest = self._manifest()
        used = {(r["data_version"], r["bucket"]) for r in manifest}
        for folder in self._list(f"{self.path}/data"):
            number = int(folder.rpartition("=")[2])
            for part in self._list(f"{self.path}/data/{folder}"):
                if part.startswith(f"{BUCKET}=") and (number, int(part.rpartition("=")[2])) not in used:
                    path, system = self._system(f"{self.path}/data/{folder}/{part}")
                    system.delete(path, True)
        for folder in self._list(f"{self.path}/manifest"):
            if folder.startswith("version=") and int(folder.rpartition("=")[2]) < version:
                path, system = self._system(f"{self.path}/manifest/{folder}")
                system.delete(path, True)

