"""Tables as numbered versions: whole or not at all, however a write ends.

A table is a folder. Data files lie in folders of their own below ``_data``, written once and never changed. A version is
a small manifest below ``_versions`` that names the folders it consists of, with their rows, the schema and the *marks* of
its writer (such as the bookmark of an incremental load). A manifest appears under its number in one step, and only
if that number is free; so of two writers that started from the same version one is refused, a reader sees one whole
version during and after any write, and rows and marks succeed or fail together. No folder is ever renamed.

Keyed tables grow by a hash directory. A part holds the rows whose key hash starts with the bits of the part; a merge reads
and rewrites only the parts that keys of the batch fall in, at most one for each key, and cuts a part that might pass
``part_rows`` into halves, quarters and so on. Parts thus stay bounded at any size of the table, and the directory has
about two entries for each ``part_rows`` rows. Parts are not files: a merge puts neighbouring small parts into files of about
``FILE_ROWS`` rows, so files grow with the rows and not with the parts. Rows carry their part and their write; a part that is
rewritten stays behind in its old file, where nobody names it, and readers leave those rows out.

The manifest takes its number by a rename that must not replace a file, which HDFS and local disks do in one step. A store
that cannot needs one writer at a time. A plain folder of Parquet files counts as a table with one part; the first write
makes it version 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
import datetime as dt
from decimal import Decimal
from functools import reduce
import json
import math
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orderloom.operators.dedup import latest_per_key
from orderloom.operators.merge import upsert
from orderloom.session import cut_lineage

VERSIONS, DATA, PART, FILE, WRITE = "_versions", "_data", "_part", "_file", "_write"

# A part of a keyed table may hold so many rows before it is cut; seconds for which replaced versions stay readable.
PART_ROWS, KEPT_SECONDS = 2_000_000, 86_400
# Parts of a keyed table share files of about so many rows; a larger part has a file of its own.
FILE_ROWS = 50_000


class ConcurrentWrite(RuntimeError):
    """Another writer took the version that this one was about to make."""


@dataclass(frozen=True)
class Part:
    """Folders below the table that hold a part's rows. ``id`` is 1 for the root of the directory and 2 i, 2 i + 1 for the halves
    of i; parts of tables without keys have whatever numbers their writer gives them. ``_file=../_part=..``
    are a part's rows in the folder ``_file=..``, which may hold other parts, too. ``digest`` is the writer's."""

    id: int
    rows: int
    folders: tuple[str, ...]
    digest: str | None = None


@dataclass(frozen=True)
class Version:
    number: int
    schema: dict
    parts: tuple[Part, ...]
    keys: tuple[str, ...] = ()
    marks: Mapping[str, object] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    def to_json(self) -> str:
        parts = [[p.id, p.rows, list(p.folders), p.digest] for p in self.parts]
        marks = {k: _packed(v) for k, v in self.marks.items()}
        return json.dumps({"number": self.number, "schema": self.schema, "keys": list(self.keys), "marks": marks, "parts": parts})

    @staticmethod
    def from_json(text: str) -> "Version":
        d = json.loads(text)
        parts = tuple(Part(i, n, tuple(f), digest) for i, n, f, digest in d["parts"])
        return Version(d["number"], d["schema"], parts, tuple(d["keys"]), {k: _unpacked(v) for k, v in d["marks"].items()})


def _packed(value: object) -> list:
    if isinstance(value, dt.datetime):
        return ["datetime", value.isoformat()]
    if isinstance(value, dt.date):
        return ["date", value.isoformat()]
    if isinstance(value, Decimal):
        return ["decimal", str(value)]
    return ["plain", value]


def _unpacked(pair: list):
    kind, value = pair
    make = {"datetime": dt.datetime.fromisoformat, "date": dt.date.fromisoformat, "decimal": Decimal, "plain": lambda v: v}
    return make[kind](value)


class VersionedTable:
    """The table below ``path``. Writing methods return the new version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._path("/".join((self.path, *names)))

    # Reading

    def numbers(self) -> list[int]:
        """Numbers of the versions that are there."""
        folder = self._at(VERSIONS)
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int) -> Version:
        stream = self._fs.open(self._at(VERSIONS, f"{number:020d}.json"))
        try:
            return Version.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> Version | None:
        """The newest version; a plain folder of files is version 0; None where there is nothing."""
        numbers = self.numbers()
        if numbers:
            return self.version(numbers[-1])
        if not self._fs.exists(self._at()):
            return None
        try:
            plain = self.spark.read.parquet(self.path)
        except AnalysisException:  # no file there that a schema could be read from
            return None
        return Version(0, plain.schema.jsonValue(), (Part(0, plain.count(), ("",)),))

    def exists(self) -> bool:
        return self.latest() is not None

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest. The frame keeps to it whatever is written meanwhile."""
        version = self.latest() if number is None else self.version(number)
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.rows_of(version, version.parts)

    def age(self) -> float:
        """Seconds since the newest version was written."""
        numbers = self.numbers()
        place = self._at(VERSIONS, f"{numbers[-1]:020d}.json") if numbers else self._at()
        return time.time() - self._fs.getFileStatus(place).getModificationTime() / 1000

    def rows_of(self, version: Version, parts: Sequence[Part]) -> DataFrame:
        schema = StructType.fromJson(version.schema)
        named = [f for p in parts for f in p.folders]
        shared, own = [f.split(f"/{PART}=") for f in named if f"/{FILE}=" in f], [f for f in named if f"/{FILE}=" not in f]
        frames = [self.spark.read.schema(schema).parquet(*self._paths(own))] if own else []
        if shared:
            rows = self.spark.read.schema(_dealt(schema)).parquet(*self._paths(f for f, _ in shared))
            live = self.spark.createDataFrame([(int(i), _write_of(f)) for f, i in shared], f"{PART} long, {WRITE} long")
            # The directory, which this process holds already.
            frames.append(rows.join(F.broadcast(live), [PART, WRITE], "left_semi").select(*map(_quoted, schema.names)))
        return reduce(DataFrame.union, frames) if frames else self.spark.createDataFrame([], schema)

    def _paths(self, folders: Iterable[str]) -> list[str]:
        return [f"{self.path}/{f}".rstrip("/") for f in dict.fromkeys(folders)]

    def mark(self, name: str):
        """The mark that the newest version carries; None if there is none."""
        version = self.latest()
        return version.marks.get(name) if version else None

    # Writing

    def replace(self, df: DataFrame, marks: Mapping[str, object] | None = None) -> Version:
        """All rows anew; ``df`` may read from this table."""
        base = self.latest()
        folder = self._write(df)
        part = Part(0, self._count(df, folder), (folder,))
        return self._commit(lambda now: Version(0, df.schema.jsonValue(), (part,), (), self._marks(now, marks)), base)

    def append(self, df: DataFrame, marks: Mapping[str, object] | None = None, max_records: int = 0) -> Version:
        """More rows, by the columns' names; columns that the rows lack are null. Appends never refuse each other."""
        base = self.latest()
        if base is not None:
            schema = StructType.fromJson(base.schema)
            unknown = set(df.columns) - set(schema.names)
            if unknown:
                raise ValueError(f"columns the table does not have: {sorted(unknown)}")
            df = df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
        folder = self._write(df, max_records=max_records)
        part = Part(0, self._count(df, folder), (folder,))

        def build(now: Version | None) -> Version:
            # Rows that were not dealt by their keys end the directory; the next merge lays it out again.
            return Version(0, (now.schema if now else df.schema.jsonValue()), (*(now.parts if now else ()), part), (), self._marks(now, marks))

        return self._commit(build, base, again=True)

    def replace_parts(self, df: DataFrame, part: Column, digests: Mapping[int, str], gone: Sequence[int] = (),
                      marks: Mapping[str, object] | None = None) -> Version | None:
        """Rows of some parts anew, each under its whole-numbered ``part``; the other parts keep their files.

        ``digests`` names the parts that ``df`` holds rows of (or none, if all went), ``gone`` those to be dropped.
        """
        base = self.latest()
        if base is not None and base.keys:
            raise ValueError("the parts of a keyed table follow from its keys")
        if not digests and not gone and base is not None:
            return base
        written = self._write_parts(df, part)
        changed = {i: replace(written.get(i, Part(i, 0, ())), digest=digest) for i, digest in digests.items()}
        if unnamed := written.keys() - digests.keys():
            raise ValueError(f"rows of parts that were not named: {sorted(unnamed)[:5]}")
        old = tuple(p for p in (base.parts if base else ()) if p.id not in changed and p.id not in set(gone))
        return self._commit(lambda now: Version(0, df.schema.jsonValue(), (*old, *changed.values()), (), self._marks(now, marks)), base)

    def merge(
        self,
        batch: DataFrame,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        *,
        newer: str | None = None,
        preserve: Sequence[str] = ("created_at",),
        marks: Mapping[str, object] | None = None,
        part_rows: int = PART_ROWS,
    ) -> Version:
        """Upsert by keys (see ``tables.upsert``); with ``newer`` a row of a smaller value of that column replaces none.

        The batch is reduced to one row per key and stored once; after that it and the parts it touches are read once.
        """
        base = self.latest()
        schema = StructType.fromJson(base.schema) if base else batch.schema
        missing = [k for k in keys if k not in batch.columns or k not in schema.names]
        if missing or not keys:
            raise ValueError(f"upsert keys not in both frames: {missing or 'none given'}")
        # One type on both sides, or equal keys would have different hashes.
        batch = batch.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in batch.columns))
        if base is None:
            directory = {1: Part(1, 0, ())}
        elif base.keys == tuple(keys):
            directory = {p.id: p for p in base.parts}
        else:
            directory = {1: Part(1, base.rows, tuple(f for p in base.parts for f in p.folders))}
        fresh = cut_lineage(latest_per_key(batch, keys, order_by))
        leaf = self._leaves(fresh, keys, {i: i.bit_length() - 1 for i in directory}).groupBy(PART)
        counts = {r[0]: r[1] for r in leaf.count().collect()}  # as many as the directory has entries at most
        if base is not None and not counts:
            return self._commit(lambda now: replace(base, marks=self._marks(now, marks)), base) if marks else base
        touched = [directory[i] for i in counts]
        # The batch may bring new keys only; so many halvings keep the parts within bounds then.
        depths = {p.id: p.id.bit_length() - 1 + max(0, math.ceil(math.log2(max(p.rows + counts[p.id], 1) / part_rows))) for p in touched}
        current = self.rows_of(replace(base, schema=schema.jsonValue()), touched) if base else None
        merged = fresh if current is None else upsert(current, fresh, keys, reduced=True, newer=newer, preserve=preserve)
        rows = sum(p.rows + counts[p.id] for p in touched)
        dealt = self._leaves(merged, keys, depths or {1: 0}, max(0, math.ceil(math.log2(max(rows, 1) / FILE_ROWS))))
        written = self._write_parts(dealt, F.col(PART), F.col(FILE))
        new = dict(directory)
        for id_, depth in depths.items():
            del new[id_]
            first = id_ << (depth - id_.bit_length() + 1)
            new.update({i: written.get(i, Part(i, 0, ())) for i in range(first, first + (1 << (depth - id_.bit_length() + 1)))})
        parts = tuple(new[i] for i in sorted(new))
        return self._commit(lambda now: Version(0, schema.jsonValue(), parts, tuple(keys), self._marks(now, marks)), base)

    def expire(self, older_than: float = KEPT_SECONDS) -> list[int]:
        """Deletes versions that were replaced more than so many seconds ago, with the folders that no other version names;
        and folders of that age that no version names, as writes that were cut short leave them."""
        numbers = self.numbers()
        if not numbers:
            return []
        limit = (time.time() - older_than) * 1000
        written = {n: self._fs.getFileStatus(self._at(VERSIONS, f"{n:020d}.json")).getModificationTime() for n in numbers}
        old = [n for n, following in zip(numbers, numbers[1:]) if written[following] < limit]
        kept = {f for n in numbers if n not in old for p in self.version(n).parts for f in p.folders}
        named = {f.split("/")[1] for f in kept if f}
        for n in old:
            self._fs.delete(self._at(VERSIONS, f"{n:020d}.json"), False)
        if self._fs.exists(self._at(DATA)):
            for status in self._fs.listStatus(self._at(DATA)):
                if status.getPath().getName() not in named and status.getModificationTime() < limit:
                    self._fs.delete(status.getPath(), True)
        if "" not in kept and old and self._fs.exists(self._at()):  # files of a plain folder that no version names any more
            for status in self._fs.listStatus(self._at()):
                if status.isFile() and status.getModificationTime() < limit:
                    self._fs.delete(status.getPath(), False)
        return old

    # Steps of a write

    def _marks(self, base: Version | None, marks: Mapping[str, object] | None) -> dict[str, object]:
        return {**(base.marks if base else {}), **(marks or {})}

    def _write(self, df: DataFrame, max_records: int = 0) -> str:
        folder = f"{DATA}/{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", max_records).parquet(f"{self.path}/{folder}")
        return folder

    def _count(self, df: DataFrame, folder: str) -> int:
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()

    def _write_parts(self, df: DataFrame, part: Column, file: Column | None = None) -> dict[int, Part]:
        """Writes rows with their part's number, one task to a part, and counts each part's rows. With ``file`` parts share files:
        a task writes all parts of a file, in their order."""
        folder, by = f"{DATA}/{uuid.uuid4().hex}", PART if file is None else FILE
        dealt = df.withColumn(PART, part.cast("long"))
        if file is not None:
            dealt = dealt.withColumns({WRITE: F.lit(_write_of(folder)).cast("long"), FILE: file.cast("long")})
        placed = dealt.repartition(by)
        (placed if file is None else placed.sortWithinPartitions(FILE, PART)).write.partitionBy(by).parquet(f"{self.path}/{folder}")
        counts = self.spark.read.schema(dealt.schema).parquet(f"{self.path}/{folder}").groupBy(*dict.fromkeys((PART, by))).count().collect()
        within = "" if file is None else f"/{FILE}={{}}"
        return {r[0]: Part(r[0], r["count"], (f"{folder}{within.format(r[by])}/{PART}={r[0]}",)) for r in counts}

    def _leaves(self, df: DataFrame, keys: Sequence[str], depths: Mapping[int, int], shared: int = 0) -> DataFrame:
        """Adds each row's part: that of its directory entry, cut to the depth wanted for it; and its file: the part's ancestor of
        the depth ``shared``, or the part if that is not as deep.

        ``depths`` maps the directory's numbers (one of which every row's hash starts with) to the depths.
        """
        columns = df.columns
        own = sorted({i.bit_length() - 1 for i in depths})
        hashed = df.withColumn("_hash", F.xxhash64(*keys))

        def node(depth: str) -> Column:  # in two steps, as a shift by 64 would do nothing
            return F.expr(f"shiftleft(1L, {depth}) | shiftrightunsigned(shiftrightunsigned(_hash, 1), 63 - {depth})")

        if len(set(depths.values())) == len(own) == 1 and len(depths) == 1 << own[0]:  # a full directory of one depth
            depth = next(iter(depths.values()))
            return hashed.select(*columns, node(str(depth)).alias(PART), node(str(min(depth, shared))).alias(FILE))
        entries = self.spark.createDataFrame(list(depths.items()), "_entry long, _depth int")
        nodes = hashed.withColumn("_entry", F.explode(F.array(*(node(str(d)) for d in own))))
        return nodes.join(entries, "_entry").select(*columns, node("_depth").alias(PART), node(f"least(_depth, {shared})").alias(FILE))

    def _commit(self, build: Callable[[Version | None], Version], base: Version | None, again: bool = False) -> Version:
        """Publishes what ``build`` makes of the newest version, if that is still ``base`` (None: no table); if another came
        meanwhile the write is refused, or made ``again`` on top of that one."""
        while True:
            now = self.latest()
            if (now and now.number) == (base and base.number):
                version = replace(build(now), number=(now.number if now else 0) + 1)
                if publish(self, version):
                    self.expire()
                    return version
            if not again:
                raise ConcurrentWrite(f"another writer changed {self.path} meanwhile")
            base = self.latest()


def _write_of(folder: str) -> int:
    """The number of a write, as its rows carry it, from a folder that it made."""
    return int(folder.split("/")[1][:15], 16)


def _dealt(schema: StructType) -> StructType:
    """The columns of files that parts share."""
    return StructType([*schema.fields, StructField(PART, LongType()), StructField(WRITE, LongType())])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def publish(table: VersionedTable, version: Version) -> bool:
    """Puts the manifest under its number, whole; False if that number is taken."""
    jvm, gateway = table.spark._jvm, table.spark.sparkContext._gateway
    staged, place = table._at(VERSIONS, f".{uuid.uuid4().hex}"), table._at(VERSIONS, f"{version.number:020d}.json")
    stream = table._fs.create(staged, False)
    try:
        stream.write(bytearray(version.to_json().encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(table._fs.getUri(), table.spark._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(staged, place, options)
    except Py4JJavaError as error:
        table._fs.delete(staged, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise OSError(f"could not publish version {version.number} of {table.path}: {error.java_exception}") from error
    return True
