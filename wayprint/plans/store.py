"""Keeps state and documents in a folder, version by version.

A write of the state goes to a version folder of its own, and Spark's committer marks it
when it is complete. Documents lie in buckets by key, and a version of them is a
manifest: a small file that names the folder of each bucket. A merge writes the buckets
that it changes to a new folder and commits a manifest that points to these and, for the
rest, to where they are. Readers take the newest complete version, so an interrupted
write leaves the one before in place, and no run reads what it writes. Old versions stay
until they are discarded.
"""

from __future__ import annotations

import datetime as dt
import json
import tempfile
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayprint.operators import merge_into
from wayprint.plans.facts import Window
from wayprint.plans.profiles import add_states, build_state
from wayprint.sources import Registry


class Versions:
    """Tables in version folders under a root that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self, name: str) -> str | None:
        """Folder of the newest complete version."""
        found = [v for v in self._numbers(name) if self._exists(f"{self._path(name, v)}/_SUCCESS")]
        return self._path(name, max(found)) if found else None

    def read(self, name: str) -> DataFrame:
        path = self.current(name)
        if path is None:
            raise FileNotFoundError(f"no complete version of {name} in {self.root}")
        return self.spark.read.parquet(path)

    def write(self, df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> str:
        """A new version, after all others, complete or not."""
        path = self._path(name, max(self._numbers(name), default=0) + 1)
        df.write.partitionBy(*partition_by).parquet(path)
        return path

    def discard_old(self, name: str) -> None:
        """Delete versions before the current one, and incomplete ones before it."""
        path = self.current(name)
        for number in self._numbers(name):
            if path and number < int(path.rpartition("=")[2]):
                self._files().delete(self._file(self._path(name, number)), True)

    def _path(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/version={number}"

    def _numbers(self, name: str) -> list[int]:
        folder = self._file(f"{self.root}/{name}")
        if not self._files().exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files().listStatus(folder)]
        return [int(n.partition("=")[2]) for n in names if n.startswith("version=")]

    def _exists(self, path: str) -> bool:
        return self._files().exists(self._file(path))

    def _files(self):
        return self._file(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _file(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where all run on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found.rstrip("/") if found else tempfile.mkdtemp(prefix="wayprint-")


def scratch_root(spark: SparkSession) -> str:
    """A new folder under the shared one, which goes when the session's file system closes."""
    root = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return root


class Conflict(Exception):
    """Another writer committed first, and again at every attempt."""


class DocumentStore:
    """Documents of one collection in buckets by key, with optimistic commits.

    Two writers may merge at the same time: the first commit wins, and the second writer
    takes its manifest and does again only the buckets that both changed.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, root: str, keys: Iterable[str], buckets: int = 64):
        """``buckets`` counts only for a new store; aim at some hundred megabytes each."""
        self.spark, self.root, self.keys, self._new_buckets = spark, root.rstrip("/"), list(keys), buckets

    def manifest(self) -> dict:
        """The newest version: its number, bucket count, schema and the folder of each bucket."""
        numbers = self._numbers()
        if not numbers:
            return {"version": 0, "buckets": self._new_buckets, "keys": self.keys, "schema": None, "folders": {}}
        found = json.loads(self._text(self._manifest(max(numbers))))
        if found["keys"] != self.keys:
            raise ValueError(f"the store has the keys {found['keys']}")
        return found

    def read(self) -> DataFrame:
        """All documents of the newest version."""
        found = self.manifest()
        if not found["version"]:
            raise FileNotFoundError(f"no documents in {self.root}")
        return self._read(found, found["folders"])

    def merge(self, changes: DataFrame, attempts: int = 10, before_commit: Callable[[], None] = lambda: None) -> int:
        """Documents with the fields of ``changes`` merged in by key; the new version's number.

        ``changes`` has a row per key. They are computed once and written by bucket; only
        the buckets that they fall into are read and written again. ``before_commit`` is
        called before each attempt to commit.
        """
        base = self.manifest()
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(base["buckets"])).cast("int")
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        self._write(changes.withColumn(self.BUCKET, bucket).repartition(self.BUCKET), staged)
        try:
            folders = self._folders(staged)
            written, todo = {}, list(folders)
            for _ in range(attempts):
                if todo:
                    written |= self._merged(base, staged, changes.schema, todo)
                schema = self._schema(base, changes.schema)
                new = {**base, "version": base["version"] + 1, "schema": json.loads(schema.json()), "folders": {**base["folders"], **written}}
                before_commit()
                if self._commit(new):
                    return new["version"]
                latest = self.manifest()
                todo = [b for b in folders if latest["folders"].get(b) != base["folders"].get(b)]
                base = latest
            raise Conflict(f"{attempts} attempts to commit to {self.root}")
        finally:
            self._files().delete(self._file(staged), True)

    def discard_old(self) -> None:
        """Deletes older manifests, and data that the newest does not name.

        Not while another writer is at work: what it has written is not named yet.
        """
        current = self.manifest()
        for number in self._numbers():
            if number < current["version"]:
                self._files().delete(self._file(self._manifest(number)), False)
        named = set(current["folders"].values())
        for write in self._names(f"{self.root}/data"):
            for folder in self._names(f"{self.root}/data/{write}"):
                if folder.startswith("_part=") and f"data/{write}/{folder}" not in named:
                    self._files().delete(self._file(f"{self.root}/data/{write}/{folder}"), True)

    def _merged(self, base: dict, staged: str, schema: T.StructType, buckets: list[str]) -> dict[str, str]:
        """Folders of the given buckets of a version with the staged changes merged in."""
        keys = [self.BUCKET, *self.keys]
        with_bucket = T.StructType([*schema.fields, T.StructField(self.BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(with_bucket).parquet(staged).filter(F.col(self.BUCKET).isin([int(b) for b in buckets]))
        old = {b: base["folders"][b] for b in buckets if b in base["folders"]}
        if old:
            rows = merge_into(self._read(base, old, True), rows, keys, within=[self.BUCKET])
        write = f"data/{uuid.uuid4().hex}"
        self._write(rows if old else rows.repartition(self.BUCKET), f"{self.root}/{write}")
        return {b: f"{write}/{folder}" for b, folder in self._folders(f"{self.root}/{write}").items()}

    def _read(self, version: dict, folders: dict[str, str], bucket: bool = False) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        if bucket:
            schema = T.StructType([*schema.fields, T.StructField(self.BUCKET, T.IntegerType())])
        reader = self.spark.read.schema(schema)
        paths = [f"{self.root}/{path}" for path in folders.values()]
        # Folders of several writes have no common base, so their bucket is read from the file, not from the path.
        return reader.option("recursiveFileLookup", "true").parquet(*paths)

    def _write(self, df: DataFrame, path: str) -> None:
        df.withColumn("_part", F.col(self.BUCKET)).write.partitionBy("_part").parquet(path)

    def _folders(self, path: str) -> dict[str, str]:
        return {name.partition("=")[2]: name for name in self._names(path) if name.startswith("_part=")}

    def _schema(self, base: dict, changes: T.StructType) -> T.StructType:
        known = T.StructType.fromJson(base["schema"]).fields if base["schema"] else []
        names = {f.name for f in known}
        return T.StructType([*known, *[f for f in changes.fields if f.name not in names]])

    def _commit(self, manifest: dict) -> bool:
        """Publishes a version unless another writer has: a rename that fails where its target exists."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        target = self._file(self._manifest(manifest["version"]))
        draft = self._file(f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        out = self._files().create(draft)
        out.write(json.dumps(manifest).encode())
        out.close()
        context = hadoop.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 0)
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            self._files().delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:08}.json"

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(f"{self.root}/manifests") if n.endswith(".json")]

    def _names(self, path: str) -> list[str]:
        place = self._file(path)
        return [s.getPath().getName() for s in self._files().listStatus(place)] if self._files().exists(place) else []

    def _text(self, path: str) -> str:
        return "\n".join(r.value for r in self.spark.read.text(path).collect())

    def _files(self):
        return self._file(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _file(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)


class StateStore:
    """The state: a base, and one table per later day. Days may arrive in any order, and again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.tables = spark, Versions(spark, root)

    def write_base(self, registry: Registry, before: dt.date, zone: str | None = None) -> None:
        """State of everything before a day, from the sources."""
        window = Window(end=before) if zone is None else Window(end=before, zone=zone)
        self.tables.write(build_state(registry, window), self._base(before))

    def write_day(self, registry: Registry, as_of: dt.date, zone: str | None = None) -> None:
        """State of the day before ``as_of``."""
        window = Window.day_before(as_of) if zone is None else Window.day_before(as_of, zone)
        self.tables.write(build_state(registry, window), self._day(window.start))

    def read(self, base: dt.date, as_of: dt.date | None = None) -> DataFrame:
        """Base plus the days from ``base`` up to, not including, ``as_of``."""
        stored = self.tables.read(self._base(base))
        if as_of is None or as_of <= base:
            return stored
        return add_states(stored, *[self.tables.read(self._day(base + dt.timedelta(days=i))) for i in range((as_of - base).days)])

    def compact(self, base: dt.date, as_of: dt.date) -> None:
        """A new base from an older one and the days after it."""
        if as_of <= base:
            raise ValueError(f"nothing to add to the base of {base} before {as_of}")
        self.tables.write(self.read(base, as_of), self._base(as_of))

    def write_documents(self, documents: DataFrame, name: str) -> str:
        """All documents of a name anew, split by collection where there is one."""
        return self.tables.write(documents, f"documents/{name}", ["collection"] if "collection" in documents.columns else [])

    def merge_documents(self, changes: DataFrame, name: str, keys: Iterable[str], buckets: int = 64) -> int:
        """A new version of stored documents, with the fields of ``changes`` merged in by key."""
        return DocumentStore(self.spark, f"{self.tables.root}/merged/{name}", keys, buckets).merge(changes)

    def read_merged(self, name: str, keys: Iterable[str]) -> DataFrame:
        return DocumentStore(self.spark, f"{self.tables.root}/merged/{name}", keys).read()

    def read_documents(self, name: str) -> DataFrame:
        return self.tables.read(f"documents/{name}")

    def _base(self, before: dt.date) -> str:
        return f"base/before={before}"

    def _day(self, day: dt.date) -> str:
        return f"days/day={day}"
