"""Published tables, laid out so that Spark reads and writes only what a change touches.

A keyed table is a catalog table, partitioned by ``SLICE``, a hash of its key, and bucketed by
the key inside. A change reads the slices its keys fall into, as pruned partitions. As the
buckets are those of a shuffle by the key, a merge exchanges the batch and not the table. The
new rows replace these slices by a dynamic partition overwrite, so its cost follows the batch.

One job writes a table at a time. Tables lie under ``root`` as Parquet folders; a session that
has another catalog finds them again by ``create``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
_KEY, _SLICES, _BUCKETS = "mirror.key", "mirror.slices", "mirror.buckets"
# A task that writes holds a group of rows, and a dictionary for each column until it is given up as too large;
# with a hundred columns of unlike texts the defaults (128 MB and 1 MB) are most of an executor's heap.
_FILES = {"parquet.block.size": 32 << 20, "parquet.dictionary.page.size": 128 << 10}


@dataclass(frozen=True)
class Layout:
    """``slices`` are what a change reads and writes, ``buckets`` the files of each and the tasks of a merge."""

    slices: int = 4
    buckets: int = 8


@dataclass
class Warehouse:
    """Tables of ``database`` under ``root``; new ones get ``layout``, or that of ``sizes`` by name."""

    spark: SparkSession
    root: str
    database: str = "mirror"
    layout: Layout = Layout()
    sizes: dict[str, Layout] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")

    def name(self, table: str) -> str:
        """The table's name in SQL texts."""
        return f"`{self.database}`.`{table}`"

    # -- definitions ------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self, table: str, schema: T.StructType, key: str | None = None) -> None:
        """The table, if it is missing, or the columns that it lacks; older rows have nulls there. No row is written."""
        if self.exists(table):
            added = [f for f in schema if f.name not in self.spark.table(self.name(table)).columns]
            if added:
                self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({_ddl(added)})")
            return
        size = self.sizes.get(table, self.layout)
        # Rows of a slice replace the slice whatever the session's setting, which by default empties the table.
        options = ", ".join(f"'{k}' '{v}'" for k, v in {"partitionOverwriteMode": "dynamic", **_FILES}.items())
        place = f"USING parquet OPTIONS ({options})"
        if key is None:
            self.spark.sql(f"CREATE TABLE {self.name(table)} ({_ddl(schema)}) {place} LOCATION '{self.root}/{table}'")
            return
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({_ddl(schema)}, {SLICE} INT) {place} PARTITIONED BY ({SLICE})"
            f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {size.buckets} BUCKETS LOCATION '{self.root}/{table}'"
            f" TBLPROPERTIES ('{_KEY}' = '{key}', '{_SLICES}' = '{size.slices}', '{_BUCKETS}' = '{size.buckets}')"
        )
        try:
            # What a session with another catalog wrote there.
            self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        except Py4JJavaError as error:
            # A new table has no folder yet.
            if "FileNotFoundException" not in str(error.java_exception):
                raise

    def marks(self, table: str) -> dict[str, str]:
        """The table's properties."""
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def mark(self, table: str, **values: str | int) -> None:
        told = ", ".join(f"'{k}' = '{v}'" for k, v in values.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ({told})")

    # -- reading ----------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table)).drop(SLICE)

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def part(self, table: str, slices: set[int]) -> DataFrame:
        """The rows of some slices; the others' files are not listed for the scan."""
        return self.spark.table(self.name(table)).where(F.col(SLICE).isin(sorted(slices))).drop(SLICE)

    # -- writing ----------------------------------------------------------

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write rows once to a fresh folder; everything after reads the written rows."""
        path = f"{self.root}/_staging/{name}-{uuid4().hex}"
        df.write.options(**_FILES).parquet(path)
        return self.spark.read.parquet(path)

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows to a table without key, which only grows."""
        self.create(table, df.schema)
        self.columns(df, table).write.insertInto(self.name(table))

    def replace(self, df: DataFrame, table: str, key: str) -> DataFrame:
        """Let the table hold exactly these rows, by key."""
        self.create(table, df.schema, key)
        marks = self.marks(table)
        now = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        touched = {int(r[0].split("=")[1]) for r in now}
        Pending(self, table, df.repartition(int(marks[_BUCKETS]), key), touched | {-1}, marks).commit()
        return self.read(table)

    def change(self, table: str, batch: DataFrame, make: Callable[[DataFrame, DataFrame], DataFrame]) -> Pending:
        """The rewriting of the slices that the batch's keys fall into.

        ``batch`` has the table's key. ``make`` gets those slices' rows and the batch, and
        returns their new rows, which are written by ``commit``. Only the numbers of the
        touched slices reach the driver.
        """
        marks = self.marks(table)
        kind = self.spark.table(self.name(table)).schema[marks[_KEY]].dataType
        at = slice_of(F.col(marks[_KEY]).cast(kind), int(marks[_SLICES]))
        touched = {r[0] for r in batch.select(at).distinct().collect()}
        return Pending(self, table, make(self.part(table, touched), batch), touched, marks)

    def spread(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows dealt out as the table's buckets are, so that those added to it fill few files."""
        marks = self.marks(table)
        return rows.repartition(int(marks[_BUCKETS]), marks[_KEY])

    def columns(self, rows: DataFrame, table: str, *more: str) -> DataFrame:
        """Rows with the table's columns in its order, and ``more`` as SQL texts after them."""
        have = set(rows.columns)
        fields = [f for f in self.spark.table(self.name(table)).schema if f.name != SLICE]
        # One text per column: wide tables plan quickly.
        told = [f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields]
        return rows.selectExpr(*told, *more)


@dataclass
class Pending:
    """New rows of the ``touched`` slices, which ``commit`` writes and publishes."""

    house: Warehouse
    table: str
    rows: DataFrame
    touched: set[int]
    marks: dict[str, str]

    def commit(self) -> None:
        if not self.touched:
            return
        written, name = Observation(), self.house.name(self.table)
        place = f"CAST(pmod(xxhash64(`{self.marks[_KEY]}`), {self.marks[_SLICES]}) AS INT) AS {SLICE}"
        placed = self.house.columns(self.rows, self.table, place)
        # Numbers of slices, of which there are a fixed number.
        placed.observe(written, F.collect_set(SLICE).alias("slices")).write.insertInto(name, overwrite=True)
        # A slice that lost its last row has no new files to replace its old ones.
        for emptied in sorted(self.touched - set(written.get["slices"])):
            self.house.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({SLICE} = {emptied})")


def slice_of(key: str | Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def _ddl(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
