"""Versioned Parquet table in buckets: a commit names the folders that make up a version.

Rows are dealt to buckets by a hash of one key. Every write puts its rows into a new part,
one folder per bucket; a commit lists, for each bucket, the parts that hold its rows, with
their row counts and the least and greatest value of every time column. An update writes the
buckets it touches anew, an insert only adds a part to its buckets; all other buckets keep
their files. A bucket of many parts is written anew when it next gets rows. Folders that are
being read are never written.

**Commits.** A commit is one small file. It is written aside and published under its
version's name only if that name is free, in one step of the file system; nothing published
is ever replaced or removed by a writer. A writer that finds the name taken has lost the
race: it takes the newer state, does its work again on it and tries the next version, so
that the writes of several writers follow one another and none is lost.

**Properties.** Key, number of buckets and indexed columns stand in every commit. Opening a
table takes them from its newest commit; asking for another key is an error.

**Skipping.** ``read_between`` opens only the parts whose times can match, ``read_for`` only
the buckets that can hold keys of a batch: by a hash for the table's key, by an index for other
columns. The index of a part is a list of (value, bucket), dealt by a hash of the value.

A version asked for by number belongs to its writer (a stream that replays a batch): the same
writer finds it done, that of another writer is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType, TimestampNTZType, TimestampType

from ..schema import CODE

BUCKETS = 64
MOST_PARTS = 8
ATTEMPTS = 50
NEWEST = -1
_BUCKET, _SLOT = "_bucket", "_slot"
_TIMES = (TimestampType, TimestampNTZType, DateType)

# Least and greatest value of each time column, as text; a column without values is missing.
Bounds = dict[str, list[str]]


@dataclass(frozen=True)
class Part:
    """The rows of one bucket that one write made."""

    bucket: int
    part: str
    rows: int
    bounds: Bounds

    def may_hold(self, column: str, least: str | None, greatest: str | None) -> bool:
        """Whether a value between the bounds can be in here."""
        if column not in self.bounds:
            return False
        low, high = self.bounds[column]
        return (least is None or high >= least) and (greatest is None or low <= greatest)


Manifest = dict[int, list[Part]]


def _moment(value: datetime | str | None) -> str | None:
    """A time in the form of the bounds, which sorts as text."""
    if value is None:
        return None
    moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f")


class VersionTaken(Exception):
    """Another writer has published the version first."""


class SnapshotTable:
    """A table whose versions share the files of buckets that did not change."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str | None = None,
        buckets: int = BUCKETS,
        writer: str | None = None,
        index: list[str] | None = None,
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.writer = writer or uuid.uuid4().hex
        self.key, self.buckets, self.index = key or CODE, buckets, list(index or [])
        newest = self.version()
        if newest is not None:
            stored = self._commit(newest)
            if key is not None and stored["key"] != key:
                raise ValueError(f"{self.root} is dealt by {stored['key']}, not by {key}")
            self.key, self.buckets, self.index = stored["key"], stored["buckets"], stored["index"]
        self.times = [f.name for f in schema if isinstance(f.dataType, _TIMES)]

    # --- versions -------------------------------------------------------------
    def versions(self) -> list[int]:
        """Committed versions, ascending; none where the table does not exist yet.

        Only a missing folder means that there is no table. Any other failure is an error.
        """
        names = self._list(f"{self.root}/commits")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def version(self, below: int | None = None) -> int | None:
        """Current version, or the newest one below a number."""
        found = [v for v in self.versions() if below is None or v < below]
        return found[-1] if found else None

    def manifest(self, version: int | None) -> Manifest:
        """Parts of every bucket, at most ``MOST_PARTS`` for each."""
        parts: Manifest = {}
        if version is not None:
            for entry in self._commit(version)["parts"]:
                parts.setdefault(entry["bucket"], []).append(Part(**entry))
        return parts

    # --- reading --------------------------------------------------------------
    def read(self) -> DataFrame:
        """The current version; empty before the first write."""
        return self.read_version(self.version())

    def read_version(self, version: int | None) -> DataFrame:
        """One version; None stands for the state before the first write."""
        return self._rows(self.manifest(version))

    def read_between(
        self,
        column: str,
        least: datetime | str | None = None,
        greatest: datetime | str | None = None,
        version: int | None = NEWEST,
    ) -> DataFrame:
        """Rows with a time column within bounds, from the parts that can hold any."""
        version = self.version() if version == NEWEST else version
        rows = self._rows(self._between(self.manifest(version), column, least, greatest))
        kind = self.schema[column].dataType
        for bound, holds in ((least, F.col(column).__ge__), (greatest, F.col(column).__le__)):
            if bound is not None:
                rows = rows.filter(holds(F.lit(_moment(bound)).cast(kind)))
        return rows

    def read_for(
        self, batch: DataFrame, columns: list[str] | None = None, version: int | None = NEWEST
    ) -> DataFrame:
        """The buckets that can hold a row that shares a value with a batch.

        Values of ``columns`` are looked for, by default of the key and the indexed columns; one
        that is neither needs all buckets. Rows of the batch without a value match nothing. What comes out are whole buckets, so
        whoever looks up keys of the batch finds all rows that the whole table would give.
        At most ``buckets`` numbers come to the driver.
        """
        version = self.version() if version == NEWEST else version
        manifest = self.manifest(version)
        columns = [self.key, *self.index] if columns is None else columns
        if not set(columns) <= {self.key, *self.index}:
            return self._rows(manifest)
        wanted: set[int] = set()
        if self.key in columns:
            wanted = self._numbers(batch.filter(F.col(self.key).isNotNull()), self._bucket())
        for column in self.index:
            if column in columns and not manifest.keys() <= wanted:
                wanted |= self._indexed(batch, column, manifest)
        return self._rows({b: parts for b, parts in manifest.items() if b in wanted})

    # --- writing --------------------------------------------------------------
    def write(self, frame: DataFrame, version: int | None = None) -> int:
        """Replace the whole table. Of several writers the last to commit wins."""
        if self._done(version):
            return version
        part = f"{self.writer}-{uuid.uuid4().hex}"
        parts = self._write_part(frame, part)
        return self._publish(lambda before: parts, version)

    def merge(
        self,
        changed: DataFrame,
        update: Callable[[DataFrame], DataFrame],
        inserts: DataFrame,
        version: int | None = None,
    ) -> int:
        """Update the buckets in which keys of ``changed`` fall, and add ``inserts``.

        ``update`` gives the next state of the rows it gets; it must not move rows to
        other keys. Where another writer was faster, the buckets are updated again from
        the state that writer left; the inserted rows are written once.
        """
        if self._done(version):
            return version
        touched = self._numbers(changed, self._bucket())
        part = f"{self.writer}-{uuid.uuid4().hex}"
        added = self._write_part(inserts, part)

        def state(before: Manifest) -> list[Part]:
            full = {p.bucket for p in added if len(before.get(p.bucket, [])) >= MOST_PARTS}
            anew = {b: parts for b, parts in before.items() if b in touched | full}
            after = [p for b, parts in before.items() if b not in anew for p in parts]
            if anew:
                after += self._write_part(update(self._rows(anew)), f"{self.writer}-{uuid.uuid4().hex}")
            return after + added

        return self._publish(state, version)

    def update_where(
        self,
        predicate: Column,
        values: dict[str, Column],
        column: str | None = None,
        least: datetime | str | None = None,
        greatest: datetime | str | None = None,
    ) -> int:
        """Set columns in the rows that meet a predicate; other parts keep their files.

        With ``column`` only rows whose time lies between the bounds are meant, and only
        parts that can hold such rows are opened. Of these, the ones with a row to change
        are written anew.
        """
        from ..operators.updates import update_where

        meant = predicate
        if column is not None:
            kind = self.schema[column].dataType
            for bound, holds in ((least, F.col(column).__ge__), (greatest, F.col(column).__le__)):
                if bound is not None:
                    meant = meant & holds(F.lit(_moment(bound)).cast(kind))

        def state(before: Manifest) -> list[Part]:
            everything = [p for parts in before.values() for p in parts]
            open_parts = before if column is None else self._between(before, column, least, greatest)
            place = F.regexp_extract(F.col("_metadata.file_path"), f"part=([^/]+)/{_BUCKET}=", 1)
            if not open_parts:
                return everything
            rows = self._rows(open_parts)
            hit = {tuple(r) for r in rows.filter(meant).select(self._bucket(), place).distinct().collect()}
            stale = [p for p in everything if (p.bucket, p.part) in hit]
            if not stale:
                return everything
            rows = self._rows({b: [p for p in stale if p.bucket == b] for b in {p.bucket for p in stale}})
            fresh = self._write_part(update_where(rows, meant, values), f"{self.writer}-{uuid.uuid4().hex}")
            return [p for p in everything if p not in stale] + fresh

        return self._publish(state, None)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove old commits, the parts only they name, and what is left aside.

        The newest ``keep`` versions stay readable. Not to be run while others write: a part
        that is not committed yet is named by no version.
        """
        versions = self.versions()
        kept = versions[-keep:]
        named = {p.part for v in kept for parts in self.manifest(v).values() for p in parts}
        gone = [f"commits/{self._name(v)}" for v in versions[:-keep]]
        for name in self._list(self.root):
            if name.startswith("part=") and name.removeprefix("part=") not in named or name.startswith("aside-"):
                gone.append(name)
        for name in gone:
            system, path = self._system(f"{self.root}/{name}")
            system.delete(path, True)
        return gone

    # --- commits --------------------------------------------------------------
    def _publish(self, state: Callable[[Manifest], list[Part]], version: int | None) -> int:
        """Commit the next state of the newest one, again as long as others are faster."""
        for _ in range(ATTEMPTS):
            if self._done(version):
                return version
            newest = self.version(below=version)
            self._check_properties(newest)
            wanted = version if version is not None else (newest or 0) + 1
            try:
                self._put(wanted, state(self.manifest(newest)))
                return wanted
            except VersionTaken:
                continue
        raise OSError(f"{self.root}: lost to other writers {ATTEMPTS} times")

    def _done(self, version: int | None) -> bool:
        """Whether this writer has committed a version; one of another writer is refused."""
        if version is None or version not in self.versions():
            return False
        owner = self._commit(version)["writer"]
        if owner != self.writer:
            raise ValueError(f"version {version} belongs to another writer: {owner}")
        return True

    def _check_properties(self, version: int | None) -> None:
        """Rows dealt otherwise than the table's must not get into it."""
        if version is not None:
            stored = self._commit(version)
            if [stored[p] for p in ("key", "buckets", "index")] != [self.key, self.buckets, self.index]:
                raise ValueError(f"{self.root} was made with other properties since it was opened; open it again")

    def _name(self, version: int) -> str:
        return f"v{version:012d}.json"

    def _commit(self, version: int) -> dict:
        system, path = self._system(f"{self.root}/commits/{self._name(version)}")
        stream = system.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, version: int, parts: list[Part]) -> None:
        """Write a commit aside, then give it its name unless that is taken."""
        commit = {
            "version": version,
            "writer": self.writer,
            "key": self.key,
            "buckets": self.buckets,
            "index": self.index,
            "parts": [asdict(p) for p in sorted(parts, key=lambda p: (p.bucket, p.part))],
        }
        jvm = self.spark._jvm
        system, aside = self._system(f"{self.root}/aside-{uuid.uuid4().hex}")
        stream = system.create(aside)
        stream.write(bytearray(json.dumps(commit).encode()))
        stream.close()
        _, path = self._system(f"{self.root}/commits/{self._name(version)}")
        system.mkdirs(path.getParent())
        try:
            if system.getUri().getScheme() == "file":
                # A rename would replace a file here; a second link to it does not.
                there, own = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (path, aside))
                jvm.java.nio.file.Files.createLink(there, own)
            else:
                rename = jvm.org.apache.hadoop.fs.Options.Rename
                options = self.spark.sparkContext._gateway.new_array(rename, 1)
                options[0] = rename.NONE
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    path.toUri(), self.spark._jsc.hadoopConfiguration()
                )
                context.rename(aside, path, options)
        except Py4JJavaError as error:
            taken = ("java.nio.file.FileAlreadyExistsException", "org.apache.hadoop.fs.FileAlreadyExistsException")
            if any(is_instance_of(self.spark.sparkContext._gateway, error.java_exception, t) for t in taken):
                raise VersionTaken(version) from None
            raise
        finally:
            system.delete(aside, False)

    # --- files ----------------------------------------------------------------
    def _bucket(self) -> Column:
        return self._hashed(self.key)

    def _hashed(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(self.buckets)).cast("int")

    def _numbers(self, frame: DataFrame, number: Column) -> set[int]:
        return {r[0] for r in frame.select(number.alias("b")).distinct().collect()}

    def _rows(self, manifest: Manifest) -> DataFrame:
        paths = [f"{self.root}/part={p.part}/{_BUCKET}={b}" for b, parts in manifest.items() for p in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _between(self, manifest: Manifest, column: str, least, greatest) -> Manifest:
        low, high = _moment(least), _moment(greatest)
        fit = {b: [p for p in parts if p.may_hold(column, low, high)] for b, parts in manifest.items()}
        return {b: parts for b, parts in fit.items() if parts}

    def _indexed(self, batch: DataFrame, column: str, manifest: Manifest) -> set[int]:
        """Buckets that hold a value of the batch, by the index of the parts in use."""
        values = batch.select(F.col(column).cast("string").alias("value")).dropna().distinct()
        slots = self._numbers(values.withColumnRenamed("value", column), self._hashed(column))
        live = {}
        for bucket, parts in manifest.items():
            for p in parts:
                live.setdefault(p.part, []).append(bucket)
        found: set[int] = set()
        for part, buckets in live.items():
            folder = f"{self.root}/index={column}/part={part}"
            there = {n.removeprefix(f"{_SLOT}=") for n in self._list(folder)}
            paths = [f"{folder}/{_SLOT}={s}" for s in slots if str(s) in there]
            if paths:
                entries = self.spark.read.schema("value string, bucket int").parquet(*paths)
                hits = entries.filter(F.col("bucket").isin(buckets)).join(values, "value", "left_semi")
                found |= self._numbers(hits, F.col("bucket"))
        return found

    def _write_part(self, frame: DataFrame, part: str) -> list[Part]:
        """Write rows by bucket, and their index; what the buckets got, from the files.

        Large buckets are split by Spark.
        """
        rows = frame.select(*self.schema.names, self._bucket().alias(_BUCKET))
        folder = f"{self.root}/part={part}"
        rows.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        if not any(n.startswith(_BUCKET) for n in self._list(folder)):
            return []
        schema = StructType([*self.schema, StructField(_BUCKET, IntegerType())])
        back = self.spark.read.schema(schema).parquet(folder)
        for column in self.index:
            entries = back.select(F.col(column).cast("string").alias("value"), F.col(_BUCKET).alias("bucket")).dropna()
            slots = entries.distinct().withColumn(_SLOT, F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int"))
            target = f"{self.root}/index={column}/part={part}"
            slots.hint("rebalance", _SLOT).write.partitionBy(_SLOT).parquet(target)
        ends = [
            F.date_format(end(c).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f"{name}_{i}")
            for i, c in enumerate(self.times)
            for name, end in (("low", F.min), ("high", F.max))
        ]
        sizes = back.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), *ends).collect()
        return [
            Part(
                r[_BUCKET],
                part,
                r.n,
                {c: [r[f"low_{i}"], r[f"high_{i}"]] for i, c in enumerate(self.times) if r[f"low_{i}"] is not None},
            )
            for r in sizes
        ]

    def _system(self, folder: str):
        jvm, context = self.spark._jvm, self.spark._jsc
        path = jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(context.hadoopConfiguration())
        return system, system.makeQualified(path)

    def _list(self, folder: str) -> list[str]:
        system, path = self._system(folder)
        if not system.exists(path):
            return []
        return [status.getPath().getName() for status in system.listStatus(path)]
