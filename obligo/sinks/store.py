"""A store of dated tables that changes as a whole.

The rows of a table and date are one folder, written by one job and never changed. What the store
holds is said by commits: ``_commits/N.json`` names the folder of every table and date after
change N. A change writes new folders beside the old ones and is published by one rename of its
commit, which fails where another change was published first. So a change that stops anywhere
leaves the state before it readable and whole, and running it again gives what it would have given.

Parts say what else they were derived from (``basis``), so that a part kept from an earlier change
is only used where that still holds. Replacing a date replaces all its tables: none of an earlier
run of that date is left. Folders that neither the newest commit nor the ``keep`` before it name
are removed after a commit. One change runs at a time; readers may come at any time.

A folder with dated tables but without commits, as ``write_snapshot`` leaves it, is read as the
state before the first commit.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.sinks.tables import write_evenly

COMMITS = "_commits"
DATE = "snapshot_date"


@dataclass(frozen=True)
class Part:
    """Rows of one table and date."""

    folder: str  # below the root of the store
    files: int
    n_bytes: int
    basis: str = ""
    buckets: int = 0


@dataclass(frozen=True)
class State:
    """What one commit says: the parts of every table by date."""

    version: int = 0
    tables: dict[str, dict[str, Part]] = field(default_factory=dict)

    def dates(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))


class ConcurrentChange(RuntimeError):
    """Another change was published between the start and the commit of this one."""


class Store:
    def __init__(self, spark: SparkSession, root: str, keep: int = 1):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._named: set[str] = set()

    # -- files ----------------------------------------------------------------------------

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        files = path.getFileSystem(self._conf)
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def _size(self, folder: str) -> tuple[int, int]:
        path = self._path(folder)
        found = path.getFileSystem(self._conf).getContentSummary(path)
        return found.getFileCount(), found.getLength()

    def _remove(self, name: str) -> None:
        path = self._path(name)
        path.getFileSystem(self._conf).delete(path, True)

    # -- reading --------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(COMMITS) if n.endswith(".json"))

    def state(self, version: int | None = None) -> State:
        """What the newest commit says, or that of a version."""
        if version is None:
            versions = self.versions()
            if not versions:
                return self._uncommitted()
            version = versions[-1]
        path = self._path(f"{COMMITS}/{version}.json")
        stream = path.getFileSystem(self._conf).open(path)
        said = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        return State(version, {
            t: {d: Part(**p) for d, p in parts.items()} for t, parts in said.items()})

    def _uncommitted(self) -> State:
        tables: dict[str, dict[str, Part]] = {}
        for name in self._names():
            prefix = f"{DATE}="
            dates = [n[len(prefix):] for n in self._names(name) if n.startswith(prefix)]
            # A first change that stopped has left folders of runs: they are nobody's.
            found = {d: f"{name}/{prefix}{d}" for d in dates}
            found = {d: f for d, f in found.items()
                     if any(n.endswith(".parquet") for n in self._names(f))}
            if found:
                tables[name] = {d: Part(f, *self._size(f)) for d, f in found.items()}
        return State(0, tables)

    def rows(self, table: str, dates: list[str] | None = None,
             state: State | None = None) -> DataFrame | None:
        """Rows of a table with their date, of all dates or some; nothing where it has none."""
        parts = (state or self.state()).tables.get(table, {})
        folders = [p.folder for d, p in sorted(parts.items()) if dates is None or d in dates]
        if not folders:
            return None
        return (
            self.spark.read.option("basePath", f"{self.root}/{table}")
            .parquet(*[f"{self.root}/{f}" for f in folders])
            .withColumn(DATE, F.col(DATE).cast("string"))
        )

    def latest(self, table: str) -> DataFrame:
        """Rows of the most recent date; only its folder is opened."""
        state = self.state()
        return self.rows(table, state.dates(table)[-1:], state)

    def bucketed(self, part: Part, schema: str, key: str) -> DataFrame:
        """A part that was written in buckets, known to Spark as such until the next change ends.

        Spark knows buckets of tables only, so the folder gets a name in the catalogue.
        """
        name = f"obligo_{part.folder.rpartition('run-')[2]}"
        self._named.add(name)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) "
            f"SORTED BY ({key}) INTO {part.buckets} BUCKETS LOCATION '{self.root}/{part.folder}'")
        return self.spark.table(name)

    def damaged(self) -> list[str]:
        """Folders the newest commit names that do not hold what was written to them."""
        return [p.folder for parts in self.state().tables.values() for p in parts.values()
                if not self._names(p.folder) or self._size(p.folder) != (p.files, p.n_bytes)]

    # -- changing -------------------------------------------------------------------------

    @contextmanager
    def change(self, date: str) -> Iterator[Change]:
        """Collects the parts of a date and publishes them together, unless an error comes first."""
        change = Change(self, date)
        try:
            yield change
            self._publish(change)
        finally:
            for name in self._named:  # the files stay
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._named.clear()

    def _publish(self, change: Change) -> None:
        said = json.dumps({t: {d: asdict(p) for d, p in sorted(parts.items())}
                           for t, parts in sorted(change.state().tables.items()) if parts},
                          indent=1)
        version = change.before.version + 1
        staged = self._path(f"{COMMITS}/.{uuid4().hex}")
        out = staged.getFileSystem(self._conf).create(staged)
        out.write(bytearray(said.encode()))
        out.close()
        target = self._path(f"{COMMITS}/{version}.json")
        # A rename that never replaces: the second of two changes fails here.
        options = self.spark.sparkContext._gateway.new_array(
            getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            staged.getFileSystem(self._conf).getUri(), self._conf)
        try:
            context.rename(staged, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            staged.getFileSystem(self._conf).delete(staged, False)
            raise ConcurrentChange(f"version {version} is there already") from error
        self.clean()

    def clean(self) -> None:
        """Removes commits before the kept ones, and folders that no kept commit names.

        These are what older commits named and what changes that stopped have left.
        """
        def named(versions: list[int]) -> set[str]:
            return {p.folder for v in versions for parts in self.state(v).tables.values()
                    for p in parts.values()}

        versions = self.versions()
        kept, old = versions[-1 - self.keep:], versions[:-1 - self.keep]
        left = {
            f"{table}/{dated}/{run}"
            for table in self._names() if not table.startswith("_")
            for dated in self._names(table) if dated.startswith(f"{DATE}=")
            for run in self._names(f"{table}/{dated}") if run.startswith("run-")
        }
        for folder in (named(old) | left) - named(kept):
            if "/run-" in folder:
                self._remove(folder)
            else:  # a folder from before the first commit: runs may lie in it
                for name in self._names(folder):
                    if not name.startswith("run-"):
                        self._remove(f"{folder}/{name}")
        for version in old:
            self._remove(f"{COMMITS}/{version}.json")


class Change:
    """The parts that a change has written, none of them published yet."""

    def __init__(self, store: Store, date: str):
        self.store, self.date, self.before = store, date, store.state()
        self.parts: dict[tuple[str, str], Part] = {}

    def write(self, table: str, df: DataFrame, date: str | None = None, basis: str = "",
              key: str | None = None, buckets: int = 0, as_dealt: bool = False) -> Part:
        """Writes the rows of a table and date, by default the change's own, to a new folder.

        With ``buckets`` they are stored by the hash of ``key``, else rebalanced into files of
        even size: the job before may have left a hot key in one partition and little in others.
        ``as_dealt`` is for large rows: those of buckets come from a shuffle by the key to a number
        of partitions that divides ``buckets``, others are rebalanced only where their files came
        out uneven, so neither is exchanged once more.
        """
        date, run = date or self.date, uuid4().hex
        folder = f"{table}/{DATE}={date}/run-{run}"
        path = f"{self.store.root}/{folder}"
        if buckets:
            name = f"obligo_{run}"
            self.store._named.add(name)
            (df if as_dealt else df.repartition(buckets, key)).write.option("path", path).option(
                "compression", "zstd").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        elif as_dealt:
            if not write_evenly(df, path):
                kept = self.store.spark.read.schema(df.schema).parquet(path)
                return self.write(table, kept, date, basis)
        else:
            df.hint("rebalance").write.parquet(path)
        part = Part(folder, *self.store._size(folder), basis, buckets)
        self.parts[table, date] = part
        return part

    def state(self) -> State:
        """What the commit will say: the change's parts, and what other dates had before."""
        tables = {t: {d: p for d, p in parts.items() if d != self.date}
                  for t, parts in self.before.tables.items()}
        for (table, date), part in self.parts.items():
            tables.setdefault(table, {})[date] = part
        return State(self.before.version + 1, tables)

    def rows(self, table: str, dates: list[str] | None = None) -> DataFrame | None:
        """Rows of a table as the commit will have them."""
        return self.store.rows(table, dates, self.state())
