"""Tables that change together: folders that are never written twice, and snapshots naming them.

A load writes new folders beside the old ones. Only the snapshot that comes last, a small file
that appears by one rename, says which folders count. So whoever reads sees all tables as one
load left them; a load that dies leaves folders that nothing names, and the next one starts
from where the last snapshot is. Two loads at once: the second rename fails, nothing is mixed.

The rename must be atomic, and fail where the name is taken, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

LOG = "_log"
LOAD = "load"
#: A partition's name where the value is null.
NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """A folder with rows of one partition. Parts of a level are merged to one of the next."""

    folder: str
    level: int = 0

    @property
    def load(self) -> str:
        return self.folder.split("/")[1].removeprefix(f"{LOAD}=")


Parts = dict[str, list[Part]]  # by the partition's name


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    tables: dict[str, Parts] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)

    def parts(self, table: str) -> Parts:
        return self.tables.get(table, {})

    def following(self, tables: dict[str, Parts], schemas: dict[str, str], facts: dict) -> Snapshot:
        """The next snapshot: these tables as given, without partitions that have no part."""
        kept = {
            name: {value: parts for value, parts in table.items() if parts}
            for name, table in {**self.tables, **tables}.items()
        }
        return replace(
            self,
            version=self.version + 1,
            tables=kept,
            schemas={**self.schemas, **schemas},
            facts={**self.facts, **facts},
        )


def new_load() -> str:
    return f"l{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, files = _path(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def is_kept(spark: SparkSession, root: str) -> bool:
    """Whether snapshots say what is in a folder."""
    place, files = _path(spark, f"{root}/{LOG}")
    return files.exists(place)


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The last snapshot; one without tables if there is none yet."""
    names = [name for name in _names(spark, f"{root}/{LOG}") if name.endswith(".json")]
    if not names:
        return Snapshot()
    text = "".join(row[0] for row in spark.read.text(f"{root}/{LOG}/{names[-1]}").collect())
    said = json.loads(text)
    tables = {
        name: {value: [Part(*part) for part in parts] for value, parts in table.items()}
        for name, table in said["tables"].items()
    }
    return Snapshot(said["version"], tables, said["schemas"], said["facts"])


def publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Make a snapshot the last one, at once; fails if another of its number came first."""
    text = json.dumps(
        {
            "version": snapshot.version,
            "tables": {
                name: {v: [[p.folder, p.level] for p in parts] for v, parts in table.items()}
                for name, table in snapshot.tables.items()
            },
            "schemas": snapshot.schemas,
            "facts": snapshot.facts,
        }
    )
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft, files = _path(spark, f"{root}/{LOG}/.{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    final = hadoop.Path(f"{root}/{LOG}/{snapshot.version:012d}.json")
    qualified = files.makeQualified(draft)
    context = hadoop.FileContext.getFileContext(
        qualified.toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(qualified, files.makeQualified(final), options)
    except Exception as error:
        files.delete(draft, False)
        raise RuntimeError(f"snapshot {snapshot.version} of {root} is there already") from error


def write(df: DataFrame, root: str, table: str, load: str, column: str, level: int = 0) -> Parts:
    """Write rows to a load's own folder, a part for each value of ``column``."""
    folder = f"{table}/{LOAD}={load}"
    df.write.mode("errorifexists").partitionBy(column).parquet(f"{root}/{folder}")
    found = {}
    for name in _names(df.sparkSession, f"{root}/{folder}"):
        if name.startswith(f"{column}="):
            found[name.removeprefix(f"{column}=")] = [Part(f"{folder}/{name}", level)]
    return found


def schema_of(df: DataFrame) -> str:
    return df.schema.json()


def read(
    spark: SparkSession, root: str, snapshot: Snapshot, table: str, parts: Parts | None = None
) -> DataFrame:
    """A table of a snapshot, or some of its parts. Other folders are not looked at."""
    schema = StructType.fromJson(json.loads(snapshot.schemas[table]))
    chosen = snapshot.parts(table) if parts is None else parts
    folders = [f"{root}/{part.folder}" for some in chosen.values() for part in some]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(LOAD, StringType())])
    rows = spark.read.schema(stored).option("basePath", f"{root}/{table}").parquet(*folders)
    return rows.select(*schema.names)


def vacuum(spark: SparkSession, root: str, keep: int = 10, older_than_hours: float = 72) -> int:
    """Delete folders that none of the last ``keep`` snapshots names, and snapshots before them.

    Folders that were touched within ``older_than_hours`` stay: a load may be writing them.
    Returns how many folders went.
    """
    names = [name for name in _names(spark, f"{root}/{LOG}") if name.endswith(".json")]
    named, tables = set(), set()
    for name in names[-keep:]:
        text = "".join(row[0] for row in spark.read.text(f"{root}/{LOG}/{name}").collect())
        for table, parts in json.loads(text)["tables"].items():
            tables.add(table)
            named |= {part[0].split("/")[1] for some in parts.values() for part in some}
    deadline = spark._jvm.System.currentTimeMillis() - older_than_hours * 3_600_000
    gone = 0
    for table in sorted(tables):
        for name in _names(spark, f"{root}/{table}"):
            place, files = _path(spark, f"{root}/{table}/{name}")
            if name not in named and files.getFileStatus(place).getModificationTime() <= deadline:
                gone += bool(files.delete(place, True))
    for name in names[:-keep]:
        place, files = _path(spark, f"{root}/{LOG}/{name}")
        files.delete(place, False)
    return gone
