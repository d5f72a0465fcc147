"""A replica of several tables as Parquet files, with one visible version of all of them.

Layout: ``<path>/<table>/_commit=<version>-<random>/`` holds the rows one version added to a
table (one row per key, each newer than every earlier commit's row of that key), and
``<path>/_versions/<version>.json`` names, per table, its schema, key and commits. Writing that file
is what makes a version visible, for all tables at once. A job that dies before leaves directories no
version names, which ``vacuum`` deletes.

A commit costs what its batch costs, not what the table holds: nothing is rewritten. To read, the later
commits are reduced to the newest row per key and override the first. ``rewrite`` makes one commit of all, when
there are many; it is run apart from the batches.

Rows of a large commit lie in directories by a hash of their key (``_bucket``), a partition column like any other. A file
beside them tells each bucket's newest position, so a late event opens only buckets of its own keys that reach
its position. Numbers of buckets are powers of two, so that a bucket of one commit is some of another's.

Schema texts of messages are files named by their hash; a version names the hashes only.

One writer per replica at a time. A second one fails when it publishes the same version, and harms
nothing, as data, statistics and the draft of its version have names of its own.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import astuple, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.columns import POSITION, cols, position, quoted
from tidemark.operators.decode import SchemaText
from tidemark.operators.merge import BROADCAST_BYTES, drop_stale, key_bytes, live_view
from tidemark.operators.reduce import newest_per_key
from tidemark.operators.schema import with_meta

Position = tuple[int, int, int]

# Rows of a bucket at least, and buckets of a commit at most: smaller commits have fewer, or none.
BUCKET_ROWS = 250_000
BUCKETS = 1024

# Column by which a large commit's rows are laid out, and the file that tells the newest position in each of its directories.
BUCKET = "_bucket"
_NEWEST = "_newest.json"

# Of messages that are written to be read again, a task holds so many bytes before it compresses and writes them.
_HELD_BYTES = 32 << 20

# Tells tables apart that are written together.
_NUMBER = T.StructField("_version", T.LongType())

# Where a search for the latest version starts.
_HINT = "_latest"


class ConcurrentWrite(RuntimeError):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Commit:
    name: str  # of its directory
    rows: int
    newest: Position
    buckets: int = 1  # 1: plain files
    key_bytes: int = 0


@dataclass(frozen=True)
class TableState:
    schema: T.StructType  # the source's columns
    keys: tuple[str, ...]
    commits: tuple[Commit, ...] = ()

    def plus(self, commit: Commit | None) -> TableState:
        return replace(self, commits=(*self.commits, commit)) if commit else self


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, TableState] = field(default_factory=dict)
    # Schema texts by message version, so that known ones need no look at the messages. Kept in files of their own.
    schemas: Mapping[int, SchemaText] = field(default_factory=dict)
    # Directories of statistics that belong to this version.
    stats: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps(
            {
                "tables": {
                    name: {
                        "schema": t.schema.jsonValue(),
                        "keys": list(t.keys),
                        "commits": [astuple(c) for c in t.commits],
                    }
                    for name, t in self.tables.items()
                },
                "schemas": sorted(self.schemas),
                "stats": list(self.stats),
            }
        )

    @staticmethod
    def from_json(number: int, text: str, texts: Callable[[int], SchemaText]) -> Version:
        stored = json.loads(text)
        tables = {
            table: TableState(
                T.StructType.fromJson(t["schema"]),
                tuple(t["keys"]),
                tuple(Commit(name, n, tuple(p), *more) for name, n, p, *more in t["commits"]),
            )
            for table, t in stored["tables"].items()
        }
        return Version(number, tables, SchemaTexts(stored["schemas"], texts), tuple(stored["stats"]))


class SchemaTexts(Mapping[int, SchemaText]):
    """Texts that are read when they are asked for."""

    def __init__(self, ids: Iterable[int], read: Callable[[int], SchemaText]) -> None:
        self._ids = frozenset(ids)
        self._read = read

    def __getitem__(self, i: int) -> SchemaText:
        if i not in self._ids:
            raise KeyError(i)
        return self._read(i)

    def __contains__(self, i: object) -> bool:
        return i in self._ids

    def __iter__(self) -> Iterator[int]:
        return iter(self._ids)

    def __len__(self) -> int:
        return len(self._ids)


class Replica:
    """Handle on a replica. Holds no state of its own; every call reads the published version."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = BUCKETS if buckets is None else buckets
        fs, of = self._file_system()
        self.path = fs.makeQualified(of(self.path)).toString()
        self._versions = f"{self.path}/_versions"
        self._texts: dict[int, SchemaText] = {}

    # ---- versions

    def _file_system(self):  # type: ignore[no-untyped-def]
        """The Hadoop file system the replica is on, and the constructor of its paths."""
        jvm = self.spark.sparkContext._jvm
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(hadoop), path

    def latest(self) -> int:
        """Number of the visible version; 0 before the first. Versions have no gaps beyond the hint, so those that follow it
        are tried one by one; the directory isn't listed."""
        try:
            number = int(self._get(f"{self._versions}/{_HINT}") or 0)
        except ValueError:
            number = 0
        fs, path = self._file_system()
        if not number or not fs.exists(path(self._version_file(number))):
            if not fs.exists(path(self._versions)):
                return 0
            number = max((n for n, _ in self._published(fs, path)), default=0)
        while fs.exists(path(self._version_file(number + 1))):
            number += 1
        return number

    def _version_file(self, number: int) -> str:
        return f"{self._versions}/{number:020d}.json"

    def _published(self, fs, path):  # type: ignore[no-untyped-def]
        """Numbers and paths of the version files."""
        for entry in fs.listStatus(path(self._versions)):
            stem, _, suffix = entry.getPath().getName().partition(".")
            if suffix == "json" and stem.isdigit():
                yield int(stem), entry.getPath()

    def _get(self, name: str) -> str | None:
        """Text of a file; None if there is none."""
        fs, path = self._file_system()
        if not fs.exists(path(name)):
            return None
        opened = fs.open(path(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def _put(self, name: str, text: str, replace: bool = False) -> None:
        fs, path = self._file_system()
        out = fs.create(path(name), replace)
        out.write(bytearray(text.encode()))
        out.close()

    def version(self, number: int | None = None) -> Version:
        number = self.latest() if number is None else number
        if number == 0:
            return Version()
        text = self._get(self._version_file(number))
        if text is None:
            raise FileNotFoundError(self._version_file(number))
        return Version.from_json(number, text, self._schema_text)

    def _schema_file(self, i: int) -> str:
        return f"{self.path}/_schemas/{i}.json"

    def _schema_text(self, i: int) -> SchemaText:
        if i not in self._texts:
            table, value, key = json.loads(self._get(self._schema_file(i)) or "null")
            self._texts[i] = (table, value, key)
        return self._texts[i]

    def schemas_with(self, known: Mapping[int, SchemaText], texts: Mapping[int, SchemaText]) -> SchemaTexts:
        """The known texts and others, which are written if they are new. A file is named by its content, so it never matters
        who wrote it."""
        fs, path = self._file_system()
        for i, text in texts.items():
            if i in known:
                continue
            draft = f"{self.path}/_schemas/_{i}.{uuid.uuid4().hex}"
            self._put(draft, json.dumps(text))
            if not fs.rename(path(draft), path(self._schema_file(i))):
                fs.delete(path(draft), False)
        return SchemaTexts({*known, *texts}, self._schema_text)

    def publish(self, version: Version) -> None:
        """Makes ``version`` the visible one, in a single step that fails if it exists. The draft is
        this attempt's own, so what becomes visible is what this caller wrote."""
        fs, path = self._file_system()
        final = path(self._version_file(version.number))
        draft = f"{self._versions}/_{version.number:020d}.{uuid.uuid4().hex}"
        fs.mkdirs(path(self._versions))
        self._put(draft, version.to_json())
        try:
            if not self._moved(fs, path(draft), final):
                raise ConcurrentWrite(f"version {version.number} of {self.path} exists")
        finally:
            fs.delete(path(draft), False)
        # Any number that was published serves, so it doesn't matter whose stays, or if none does.
        self._put(f"{self._versions}/{_HINT}", str(version.number), True)

    def _moved(self, fs, draft, final) -> bool:  # type: ignore[no-untyped-def]
        """Whether the draft got its final name. A rename of HDFS never replaces a file; a local one does,
        so there the name is given by a link."""
        if fs.getScheme() != "file":
            return not fs.exists(final) and fs.rename(draft, final)
        try:
            os.link(draft.toUri().getPath(), final.toUri().getPath())
        except FileExistsError:
            return False
        return True

    # ---- reading

    def tables(self) -> list[str]:
        return sorted(self.version().tables)

    def schema(self, table: str) -> T.StructType:
        return with_meta(self.version().tables[table].schema)

    def keys(self, table: str) -> tuple[str, ...]:
        return self.version().tables[table].keys

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """All rows of a table, deleted ones included, as of a version."""
        return self._read(table, self.version(version).tables[table])

    def live(self, table: str, version: int | None = None) -> DataFrame:
        """The rows a user of the source would see, without the replica's own columns."""
        state = self.version(version).tables[table]
        return live_view(self._read(table, state), state.schema.names)

    def catalog(self) -> DataFrame:
        """Columns of all tables: (table, position, column, type, is_key). The replica's own are
        left out."""
        rows = [
            (table, n, f.name, f.dataType.simpleString(), f.name in state.keys)
            for table, state in sorted(self.version().tables.items())
            for n, f in enumerate(state.schema.fields)
        ]
        names = "table string, position int, column string, type string, is_key boolean"
        return self.spark.createDataFrame(rows, names)

    def create_views(self, prefix: str = "") -> list[str]:
        """The live rows of every table as a temporary view, all of the same version."""
        current = self.version()
        for table, state in current.tables.items():
            live = live_view(self._read(table, state), state.schema.names)
            live.createOrReplaceTempView(prefix + table)
        return [prefix + t for t in sorted(current.tables)]

    def _read(self, table: str, state: TableState) -> DataFrame:
        commits = state.commits
        if not commits:
            return self.spark.createDataFrame([], with_meta(state.schema))
        first = self._files(table, state, commits[:1])
        if len(commits) == 1:
            return first
        later = self._files(table, state, commits[1:])
        if len(commits) > 2:
            later = newest_per_key(later, state.keys)
        # A later commit's row is newer than the first's: the guard saw to that. Their keys are broadcast if the commits
        # say that they are few, so that the first one, the bulk of the table, isn't shuffled.
        overridden = later.select(*cols(state.keys))
        if sum(c.key_bytes for c in commits[1:]) <= BROADCAST_BYTES:
            overridden = F.broadcast(overridden)
        kept = first.join(overridden, list(state.keys), "left_anti")
        return kept.select(*cols(first.columns)).unionByName(later)

    def _files(
        self, table: str, state: TableState, commits: Iterable[Commit], buckets: Mapping[str, Sequence[int]] | None = None
    ) -> DataFrame:
        """Rows of commits; only some ``buckets`` of those that are named there."""
        # The schema is given, so files from before a column was added or widened read as today's.
        schema = with_meta(state.schema)
        plain = [self._commit_path(table, c.name) for c in commits if c.buckets == 1]
        frames = [self.spark.read.schema(schema).parquet(*plain)] if plain else []
        for c in commits:
            if c.buckets > 1:
                rows = self.spark.read.schema(schema).parquet(self._commit_path(table, c.name))
                if buckets and c.name in buckets:
                    rows = rows.where(F.col(BUCKET).isin(*buckets[c.name]))
                frames.append(rows.select(*cols(schema.names)))
        return reduce(DataFrame.unionByName, frames)

    def stored(
        self,
        table: str,
        state: TableState,
        commits: Sequence[Commit],
        since: Position,
        buckets: Mapping[str, Sequence[int]] | None = None,
    ) -> DataFrame | None:
        """Rows that an event at ``since`` or later could lose against: those stored at that position
        or after. ``commits`` are those that reach it, ``buckets`` the directories of them that do (see ``reached``); None if
        there are none, which is the normal case of an ordered log. The condition on the position reaches the Parquet files."""
        if not commits:
            return None
        return self._files(table, state, commits, buckets).where(_reaches(since))

    def stored_alike(
        self, state: TableState, commits: Mapping[str, tuple[str, int]], since: Position
    ) -> DataFrame:
        """Keys and positions that several tables of one schema hold at ``since`` or later, as one read. ``commits`` are plain
        ones: per name the table and the number that ``_version`` is to have in its rows."""
        paths = [self._commit_path(table, name) for name, (table, _) in commits.items()]
        of = F.regexp_extract("_metadata.file_path", "/_commit=([^/]+)/", 1)
        rows = self.spark.read.schema(with_meta(state.schema)).parquet(*paths).where(_reaches(since))
        rows = rows.select(*cols(state.keys), *POSITION, of.alias("_op"))  # a name that no column of a source has
        names = self.spark.createDataFrame([(n, i) for n, (_, i) in commits.items()], "_op string, _version long")
        return rows.join(F.broadcast(names), "_op").drop("_op")

    def reached(
        self, table: str, commits: Sequence[Commit], oldest: Mapping[int, tuple[int, int]]
    ) -> tuple[list[Commit], dict[str, list[int]]]:
        """Commits, and buckets of those that have some, that hold rows at a batch's oldest position or later. ``oldest`` tells
        it (log file, offset) per bucket of the batch, which has no fewer of them than any commit."""
        reaching, buckets = [], {}
        for c in commits:
            own: dict[int, tuple[int, int]] = {}
            for b, p in oldest.items():
                own[b % c.buckets] = min(p, own.get(b % c.buckets, p))
            newest = self._newest(table, c) if c.buckets > 1 else {0: c.newest}
            some = sorted(b for b, p in own.items() if b in newest and newest[b] >= (*p, 0))
            if some:
                reaching.append(c)
                if c.buckets > 1:
                    buckets[c.name] = some
        return reaching, buckets

    def _newest(self, table: str, commit: Commit) -> dict[int, Position]:
        text = self._get(f"{self._commit_path(table, commit.name)}/{_NEWEST}")
        return {int(b): tuple(p) for b, p in json.loads(text or "{}").items()}  # type: ignore[misc]

    # ---- writing

    def _commit_path(self, table: str, name: str) -> str:
        return f"{self.path}/{table}/_commit={name}"

    def write_commit(
        self,
        table: str,
        state: TableState,
        rows: DataFrame,
        version: int,
        rows_at_most: int,
        stored: DataFrame | None = None,
    ) -> tuple[int, Commit | None]:
        """Writes ``rows``, without those that ``stored`` makes stale, as a commit nobody sees yet.
        Returns how many rows came in, and the commit, or None if no row was left.

        The counts come from the write itself. ``rows`` arrive partitioned by key, so both are
        observed in its last stage, where a retried task reports once. If rows are dealt out by bucket before they are
        written, no stage before that is looked at: with nothing left to write, Spark doesn't finish its plan.
        """
        came, wrote = Observation(), Observation()
        name = f"{version}-{uuid.uuid4().hex}"
        path = self._commit_path(table, name)
        buckets = self._buckets_for(rows_at_most)
        by = bucket_of(state, buckets)
        # A multiple of each other: then the shuffle by key has put a bucket's rows into few tasks already.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # type: ignore[arg-type]
        dealt = bool(tasks % buckets and buckets % tasks)
        n_came = None
        if stored is not None:
            if dealt:
                n_came = rows.select(*cols(state.keys)).count()
            else:
                rows = rows.observe(came, F.count(F.lit(1)).alias("n"))
            rows = drop_stale(rows, stored, state.keys)
        if dealt:
            rows = rows.repartition(buckets, by)
        size = F.sum(key_bytes(rows, state.keys)).alias("key_bytes")
        rows = rows.observe(
            wrote, F.count(F.lit(1)).alias("n"), F.max(position()).alias("newest"), size
        )
        if buckets == 1:
            rows.write.parquet(path)
        else:
            rows.withColumn(BUCKET, by).write.partitionBy(BUCKET).parquet(path)
        n, newest, bytes_ = (wrote.get[c] for c in ("n", "newest", "key_bytes"))
        if stored is None:
            n_came = n
        elif n_came is None:
            n_came = came.get["n"]
        commit = Commit(name, n, tuple(newest), buckets, bytes_) if n else None
        if commit and buckets > 1:
            # Only what is needed, before it is grouped: frames with a TIME can't be grouped in a thread of a pool.
            places = self.spark.read.schema(with_meta(state.schema)).parquet(path).select(BUCKET, *POSITION)
            found = places.groupBy(BUCKET).agg(F.max(position()).alias("newest"))
            self._put(f"{path}/{_NEWEST}", json.dumps({r[BUCKET]: list(r["newest"]) for r in found.collect()}))
        return n_came, commit

    def write_alike(
        self, tables: Mapping[int, tuple[str, TableState]], rows: DataFrame, version: int
    ) -> dict[str, Commit]:
        """Writes rows of small tables of one schema in one job. ``tables`` are by their number in ``_version``, which ``rows``
        have beside the table's columns. Returns the commits, which nobody sees yet, of the tables that got rows.

        A table's files become one directory, which then moves to its place. The counts come from what was written."""
        schema = with_meta(next(iter(tables.values()))[1].schema)
        keys = next(iter(tables.values()))[1].keys
        fs, path = self._file_system()
        commits = {}
        with self.scratch() as draft:
            rows.write.partitionBy("_version").parquet(draft)
            wrote = self.spark.read.schema(T.StructType([*schema.fields, _NUMBER])).parquet(draft)
            sizes = wrote.select("_version", *POSITION, key_bytes(wrote, keys).alias("key_bytes"))
            found = sizes.groupBy("_version").agg(
                F.count(F.lit(1)).alias("n"), F.max(position()).alias("newest"), F.sum("key_bytes").alias("key_bytes")
            )
            for r in found.collect():  # one per table
                table, _ = tables[r["_version"]]
                name = f"{version}-{uuid.uuid4().hex}"
                final = path(self._commit_path(table, name))
                fs.mkdirs(final.getParent())
                if not fs.rename(path(f"{draft}/_version={r['_version']}"), final):
                    raise OSError(f"{final} could not be put in place")
                commits[table] = Commit(name, r["n"], tuple(r["newest"]), 1, r["key_bytes"])
        return commits

    @contextmanager
    def shuffles_by_bucket(self, rows: int) -> Iterator[None]:
        """While the block runs, shuffles have a power of two of partitions, not fewer than the session says, if so many rows
        of a table lie in buckets. The shuffle by key, which ranks the events, then fits the buckets, so that rows aren't
        shuffled once more to be written. No result depends on it."""
        name = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(name)
        if self._buckets_for(rows) > 1:
            self.spark.conf.set(name, 1 << (int(before) - 1).bit_length())  # type: ignore[arg-type]
        try:
            yield
        finally:
            self.spark.conf.set(name, before)  # type: ignore[arg-type]

    def _buckets_for(self, rows: int) -> int:
        """The power of two up to ``buckets`` that leaves each at least ``BUCKET_ROWS`` rows."""
        return 1 << max(0, min(self.buckets, rows // BUCKET_ROWS).bit_length() - 1)

    def rewrite(self, tables: Iterable[str] | None = None) -> list[str]:
        """One commit in place of all, for tables (by default all) that have several. Reading is then a plain scan. Reads and
        writes whole tables, so it is for quiet times: a batch that is published meanwhile makes it fail, and the other way
        round. Returns the tables it rewrote."""
        current = self.version()
        number, states = current.number + 1, dict(current.tables)
        done = []
        for name in sorted(current.tables if tables is None else tables):
            state = states[name]
            if len(state.commits) < 2:
                continue
            rows = self._read(name, state).repartition(*cols(state.keys))
            _, commit = self.write_commit(name, state, rows, number, sum(c.rows for c in state.commits))
            assert commit is not None
            states[name] = replace(state, commits=(commit,))
            done.append(name)
        if done:
            self.publish(replace(current, number=number, tables=states))
        return done

    def vacuum(self, keep_versions: int = 10) -> list[str]:
        """Deletes all but the last versions, and the commits and statistics none of them names. Returns
        the directories of these."""
        latest = self.latest()
        if latest:
            self._put(f"{self._versions}/{_HINT}", str(latest), True)
        oldest = max(1, latest - keep_versions + 1)
        kept = [self.version(n) for n in range(oldest, latest + 1)]
        named = {(t, c.name) for v in kept for t, s in v.tables.items() for c in s.commits}
        fs, path = self._file_system()
        for number, file in list(self._published(fs, path)) if kept else ():
            if number < oldest:
                fs.delete(file, False)
        gone = []
        for table in kept[-1].tables if kept else ():
            for entry in fs.listStatus(path(f"{self.path}/{table}")):
                name = entry.getPath().getName().removeprefix("_commit=")
                # Those of a later version are being written.
                if int(name.partition("-")[0]) <= latest and (table, name) not in named:
                    fs.delete(entry.getPath(), True)
                    gone.append(f"{table}/{name}")
        named = {(name, "") for v in kept for name in v.stats}
        at = path(self.stats_path())
        for entry in fs.listStatus(at) if kept and fs.exists(at) else ():
            name = entry.getPath().getName()
            if int(name.partition("-")[0]) <= latest and (name, "") not in named:
                fs.delete(entry.getPath(), True)
                gone.append(f"_stats/{name}")
        return gone

    @contextmanager
    def scratch(self) -> Iterator[str]:
        """A directory beside the tables for as long as the block runs."""
        fs, path = self._file_system()
        name = f"{self.path}/_scratch/{uuid.uuid4().hex}"
        try:
            yield name
        finally:
            fs.delete(path(name), True)

    def written(self, rows: DataFrame, path: str) -> DataFrame:
        """``rows`` as they are read back from files at ``path``, a scratch directory."""
        rows.write.options(compression="zstd", **{"parquet.block.size": _HELD_BYTES}).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stats_path(self, name: str = "") -> str:
        return f"{self.path}/_stats/{name}".rstrip("/")


def _reaches(since: Position) -> Column:
    file_number, offset, _ = (F.lit(n) for n in since)
    return (F.col("_src_file") > file_number) | (
        (F.col("_src_file") == file_number) & (F.col("_src_pos") >= offset)
    )


def bucket_of(state: TableState, buckets: int) -> Column:
    """The bucket of a row: by the hash that a shuffle by key takes as well. Decimals of one value have one bucket, however
    wide they are, as they may widen."""
    keys = []
    for k in state.keys:
        kind = state.schema[k].dataType
        if isinstance(kind, T.DecimalType):
            keys.append(F.col(quoted(k)).cast("double"))
        else:
            keys.append(F.col(quoted(k)))
    return F.pmod(F.hash(*keys), F.lit(buckets))
