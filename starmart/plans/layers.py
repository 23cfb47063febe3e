"""Where staged tables and marts live, and how readers find them.

Every build writes a fresh folder per layer and then adds one numbered entry to a
publication log, which names the current version of every layer. A reader resolves
the newest entry once, so it sees either the old build or the new one in full, over
all layers, and no plan overwrites a path it reads.

An entry is created only if its number is still free, and only if the layers it
replaces are those its build began from. Of two builds at once, one is published and
the other gets a ``PublicationConflict``; neither is lost unnoticed or mixed.
"""

from __future__ import annotations

import json
import os
import re
import threading
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STAGING = "staging"
MARTS = "marts"
# ``tables`` holds each table's schema as JSON, so that reading infers nothing.
LOG_SCHEMA = (
    "number bigint, layers map<string, struct<version: string, tables: map<string, string>>>, "
    "published_at timestamp_ntz"
)
ENTRY = "{:012d}.json"
VERSION_TIME = "%Y%m%dT%H%M%S%f"
# Half of snappy's bytes where text holds hashes, at about the same speed.
COMPRESSION = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Points at which the values of a clustered column are known.
SKETCHED = 1024
# An unpublished folder younger than this may belong to a build that still runs.
RUNNING = timedelta(days=1)


@dataclass(frozen=True)
class Build:
    """One version of a layer: the schema of each of its tables, as JSON."""

    version: str
    tables: Mapping[str, str]


@dataclass(frozen=True)
class Publication:
    """An entry of the log: its number, from 1, and the current build of every layer."""

    number: int
    layers: Mapping[str, Build]

    def version(self, layer: str) -> str | None:
        return self.layers[layer].version if layer in self.layers else None


@dataclass(frozen=True)
class Ranges:
    """Ranges of a column that hold about as many rows each: upper bounds of all but the last.

    A value that fills several ranges is their common bound, and its rows are spread over them.
    Where a sketch cannot tell so many ranges apart, each is dealt to several ``parts``.
    """

    column: str
    bounds: tuple = ()
    parts: int = 1

    @staticmethod
    def of(table: DataFrame, column: str, value: Column, rows: int) -> Ranges:
        """Bounds from one pass over the values in ``table``, about ``rows`` to a range or part."""
        wanted = -(-table.count() // rows)
        if wanted <= 1:
            return Ranges(column)
        count = min(SKETCHED, wanted)
        points = [(i + 1) / count for i in range(count - 1)]
        bounds = table.agg(F.percentile_approx(value, points, 10 * SKETCHED)).first()[0] or []
        return Ranges(column, tuple(bounds), -(-wanted // count))

    def deal(self, table: DataFrame) -> DataFrame:
        """The table by ranges, NULL in the first, each sorted."""
        if self.bounds:
            bounds, own = F.array(*map(F.lit, self.bounds)), F.col(self.column)
            below = F.size(F.filter(bounds, lambda b: b < own))
            equal = F.size(F.filter(bounds, lambda b: b == own))
            spread = F.xxhash64(*table.columns)
            place = F.coalesce(below + F.pmod(spread, equal + 1), F.lit(0)) * self.parts
            part = F.pmod(F.shiftright(spread, 32), F.lit(self.parts))
            table = table.repartitionById(
                (len(self.bounds) + 1) * self.parts, (place + part).cast("int")
            )
        return table.sortWithinPartitions(self.column)


@dataclass(frozen=True)
class Places:
    """Ranges of a column of few values, such as days, whose rows per value are known.

    Rows are lined up by value, NULL first, and cut every ``rows`` rows, so that a value takes as
    many ranges as it fills, alone or beside its neighbours. ``values`` holds each value, the rows
    before it and its own. Rows of one value are sorted by ``within``: what repeats along that
    column compresses well.
    """

    column: str
    values: tuple = ()
    rows: int = 1
    count: int = 1
    within: tuple[str, ...] = ()

    @staticmethod
    def of(weights: DataFrame, column: str, rows: int, within: tuple[str, ...] = ()) -> Places:
        """Ranges of about ``rows`` rows; ``weights``: values of the column and their rows."""
        values, before = [], 0
        # One row per value.
        known = weights.toDF("value", "n").groupBy("value").agg(F.sum("n").alias("n"))
        for value, own in known.where("n > 0").orderBy(F.asc_nulls_first("value")).collect():
            values.append((value, before, own))
            before += own
        return Places(column, tuple(values), rows, max(1, -(-before // rows)), within)

    def deal(self, table: DataFrame) -> DataFrame:
        """The table by ranges, each sorted; values that are not known go to the first."""
        if self.count > 1:
            own, first, n = (f"_{part}_{uuid.uuid4().hex}" for part in ("own", "first", "n"))
            kind = table.schema[self.column].dataType.simpleString()
            known = table.sparkSession.createDataFrame(
                self.values, f"`{own}` {kind}, `{first}` bigint, `{n}` bigint"
            )
            at = F.col(first) + F.pmod(F.xxhash64(*table.columns), F.col(n))
            place = F.coalesce(F.floor(at / self.rows), F.lit(0)).cast("int")
            columns = table.columns
            table = table.join(F.broadcast(known), F.col(self.column).eqNullSafe(F.col(own)), "left")
            table = table.repartitionById(self.count, place).select(*columns)
        return table.sortWithinPartitions(self.column, *self.within)


_writing = threading.Lock()
_writers: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Files of a shuffle go with the query that made them.

    Otherwise they stay until the driver happens to collect its garbage, those of one table
    beside those of the next. The session gets its setting back when the last of its users ends.
    """
    with _writing:
        users, before = _writers.get(spark) or (0, spark.conf.get(CLEANUP, None))
        _writers[spark] = users + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _writing:
            users, before = _writers.pop(spark)
            if users > 1:
                _writers[spark] = users - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


class PublicationConflict(RuntimeError):
    """What a build started from was replaced while it ran; nothing was published."""


class Snapshot:
    """The layers as one publication left them, whatever is published later."""

    def __init__(self, warehouse: Warehouse, layers: Mapping[str, Build]) -> None:
        self.warehouse = warehouse
        self.layers = layers

    def build(self, layer: str) -> Build:
        if layer not in self.layers:
            raise LookupError(f"nothing published for layer {layer!r}")
        return self.layers[layer]

    def path(self, layer: str, name: str) -> str:
        return self.warehouse.path(layer, self.build(layer).version, name)

    def read(self, layer: str, name: str) -> DataFrame:
        tables = self.build(layer).tables
        if name not in tables:
            raise KeyError(f"{layer} has no table {name!r}; it has: {', '.join(tables)}")
        fields = StructType.fromJson(json.loads(tables[name]))
        return self.warehouse.spark.read.schema(fields).parquet(self.path(layer, name))

    def read_layer(self, layer: str) -> dict[str, DataFrame]:
        return {name: self.read(layer, name) for name in self.build(layer).tables}


class Warehouse:
    """Staging and mart layers as Parquet under one root folder.

    Builds may run at once, in this or other processes. The file system must refuse to rename
    onto an existing name in one step, as HDFS does; on a local one a hard link does the same.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "main_") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._attaching = threading.Lock()
        self._attached: set[str] = set()

    def write(
        self,
        layer: str,
        tables: Mapping[str, DataFrame | Sequence[DataFrame]],
        clustered: Mapping[str, Ranges | Places] | None = None,
        writers: int = 4,
        build: Build | None = None,
    ) -> Build:
        """Write a layer in full, or add tables to a ``build`` of it, without publishing it.

        The tables are independent jobs, so a few are written at a time. A table may be given
        in parts, which are written one after another, so that the shuffle files of one are gone
        before the next begins. Those named in ``clustered`` are dealt out by ranges of a column
        and sorted by it, so that a filter on it reads few row groups.
        """
        fresh = f"{datetime.now(UTC):{VERSION_TIME}}-{uuid.uuid4().hex[:8]}"
        version, earlier = (build.version, build.tables) if build else (fresh, {})
        parts = {n: [t] if isinstance(t, DataFrame) else list(t) for n, t in tables.items()}
        for name, ranges in (clustered or {}).items():
            parts[name] = [ranges.deal(part) for part in parts[name]]

        def write(name: str) -> None:
            for number, part in enumerate(parts[name]):
                writer = part.write.option("compression", COMPRESSION)
                writer.mode("append" if number else "error").parquet(
                    self.path(layer, version, name)
                )

        with shuffles_end_with_queries(self.spark), ThreadPoolExecutor(writers) as pool:
            list(pool.map(write, parts))
        return Build(version, {**earlier, **{n: p[0].schema.json() for n, p in parts.items()}})

    def publish(
        self,
        layers: Mapping[str, Build],
        parent: Publication | None = None,
        reads: Iterable[str] = (),
    ) -> Publication:
        """Make the given layers current, all at once; others stay as they are.

        ``parent`` is what ``newest()`` gave when the build began. If the given layers, or those
        it ``reads``, are no longer the parent's, ``PublicationConflict`` is raised. Without a
        parent only a publication at the same instant is guarded against.
        """
        while True:
            newest = self.newest()
            for name in {*layers, *reads} if parent else ():
                if newest.version(name) != parent.version(name):
                    raise PublicationConflict(
                        f"{name}: publication {newest.number} replaced "
                        f"{parent.version(name)} by {newest.version(name)}"
                    )
            entry = Publication(newest.number + 1, {**newest.layers, **layers})
            if self._add(entry):
                return entry

    def refresh(self, layer: str, tables: Mapping[str, DataFrame]) -> str:
        """Rebuild and publish one layer; nothing is published unless every table succeeds."""
        parent = self.newest()
        build = self.write(layer, tables)
        self.publish({layer: build}, parent)
        return build.version

    def snapshot(self) -> Snapshot:
        """What is published now; read several tables through one snapshot."""
        newest = self.newest()
        if not newest.layers:
            raise LookupError(f"nothing published under {self.root}")
        return Snapshot(self, newest.layers)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.snapshot().read(layer, name)

    def read_layer(self, layer: str) -> dict[str, DataFrame]:
        return self.snapshot().read_layer(layer)

    def mount(self, layer: str, snapshot: Snapshot | None = None) -> str:
        """Point ``<prefix><layer>.<table>`` in the session's catalog at one publication."""
        snapshot = snapshot or self.snapshot()
        database = f"{self.prefix}{layer}"
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{layer}'"
        )
        for name in snapshot.build(layer).tables:
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS "
                f"SELECT * FROM parquet.`{snapshot.path(layer, name)}`"
            )
        return database

    def attach(
        self, snapshot: Snapshot, views: Mapping[str, Mapping[str, str]] | None = None
    ) -> dict[str, str]:
        """A database of its own for each layer's build; returns their names by layer.

        Such a database never changes, so whoever knows its name sees one build. ``views`` holds
        further views of a layer as SQL, in which other layers stand in braces.
        """
        names = {layer: self._database(layer, b.version) for layer, b in snapshot.layers.items()}
        with self._attaching:
            for layer, name in names.items():
                if name in self._attached:
                    continue
                build = snapshot.build(layer)
                place = f"{self.root}/{layer}/{build.version}"
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
                found = {
                    t: f"SELECT * FROM parquet.`{snapshot.path(layer, t)}`" for t in build.tables
                }
                quoted = {other: f"`{n}`" for other, n in names.items()}
                for view, text in (views or {}).get(layer, {}).items():
                    found[view] = text.format(**quoted)
                for view, text in found.items():
                    self.spark.sql(f"CREATE OR REPLACE VIEW `{name}`.`{view}` AS {text}")
                self._attached.add(name)
        return names

    def sql(
        self, query: str, views: Mapping[str, Mapping[str, str]] | None = None
    ) -> DataFrame:
        """Run SQL in which layers stand in braces, as in ``{marts}.fact_orders``.

        The newest publication is looked up once for the whole query, so that it sees one build
        of all layers, whatever is published meanwhile.
        """
        names = self.attach(self.snapshot(), views)
        return self.spark.sql(query.format(**{layer: f"`{n}`" for layer, n in names.items()}))

    def _database(self, layer: str, version: str) -> str:
        return f"{self.prefix}{layer}_{version}".replace("-", "_").lower()

    def prune(self, layer: str, keep: int = 2, running: timedelta = RUNNING) -> list[str]:
        """Delete old builds, keeping the newest ``keep`` for readers still on them.

        Folders that were never published go once they are older than ``running``:
        a younger one may still be written. Returns the deleted versions.
        """
        if keep < 1:
            raise ValueError("the current build must be kept")
        if not self._entries():
            return []
        log = self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/publications/*.json")
        newest = log.orderBy(F.desc("number")).select(
            F.col("layers")[layer]["version"].alias("version")
        )
        published = list(dict.fromkeys(
            row["version"] for row in newest.collect() if row["version"]
        ))
        if not published:
            return []
        kept = set(published[:keep])
        limit = f"{datetime.now(UTC) - running:{VERSION_TIME}}"
        files, folder = self._files(layer)
        deleted = []
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            # Versions begin with their time, so names sort by age.
            if name not in kept and (name in published or name < limit):
                database = self._database(layer, name)
                self.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
                with self._attaching:
                    self._attached.discard(database)
                files.delete(status.getPath(), True)
                deleted.append(name)
        return sorted(deleted)

    def path(self, layer: str, version: str, name: str) -> str:
        return f"{self.root}/{layer}/{version}/{name}"

    def newest(self) -> Publication:
        """The newest entry of the log; number 0, without layers, where there is none yet."""
        entries = self._entries()
        if not entries:
            return Publication(0, {})
        files, folder = self._files("publications")
        stream = files.open(self._hadoop.Path(folder, max(entries)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        return Publication(entry["number"], {
            name: Build(build["version"], build["tables"])
            for name, build in entry["layers"].items()
        })

    @property
    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _files(self, folder: str):
        """The file system of a folder under the root, and the folder."""
        path = self._hadoop.Path(f"{self.root}/{folder}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _entries(self) -> list[str]:
        files, folder = self._files("publications")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return [name for name in names if re.fullmatch(r"\d{12}\.json", name)]

    def _add(self, entry: Publication) -> bool:
        """Put an entry under its number, whole and at once; False if the number is taken."""
        files, folder = self._files("publications")
        files.mkdirs(folder)
        draft = self._hadoop.Path(folder, f"_{uuid.uuid4().hex}")
        final = self._hadoop.Path(folder, ENTRY.format(entry.number))
        content = {
            "number": entry.number,
            "layers": {
                name: {"version": b.version, "tables": dict(b.tables)}
                for name, b in entry.layers.items()
            },
            "published_at": f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%S.%f}",
        }
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        try:
            return self._rename(files, draft, final)
        finally:
            files.delete(draft, False)

    def _rename(self, files, draft, final) -> bool:
        if files.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = self._hadoop.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = getattr(self._hadoop, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(options, 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(final), none)
        except Py4JJavaError:
            if files.exists(final):
                return False
            raise
        return True


def create_views(tables: Mapping[str, DataFrame]) -> None:
    """Session views over unevaluated tables; reading one evaluates it."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
