"""SQLite files as a Spark source and sink, on the standard library's driver."""

from __future__ import annotations

import sqlite3
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructType

_KINDS = {"INT": LongType(), "REA": DoubleType(), "FLO": DoubleType(), "DOU": DoubleType(), "BLO": BinaryType()}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class Span(InputPartition):
    low: int
    high: int


#: Comparisons that SQLite makes as Spark does; texts are compared by their bytes in both.
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def condition(f: Filter) -> tuple[str, list] | None:
    """A filter on one column as SQL with its values, or None where SQLite would not say the same."""
    if len(f.attribute) != 1:
        return None
    column = _quoted(f.attribute[0])
    if isinstance(f, (IsNull, IsNotNull)):
        return f"{column} is {'not ' * isinstance(f, IsNotNull)}null", []
    values = list(f.value) if isinstance(f, In) else [getattr(f, "value", None)]
    if any(type(v) not in (int, float, str) for v in values) or len({type(v) is str for v in values}) > 1:
        return None
    if isinstance(f, In):
        return f"{column} in ({', '.join('?' * len(values))})", values
    sign = _SIGNS.get(type(f))
    return (f"{column} {sign} ?", values) if sign else None


class SqliteReader(DataSourceReader):
    """Splits a table by ranges of rowid; filters that SQLite can make are made there."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table, self.parts = schema, options["path"], options["dbtable"], int(options.get("numpartitions", 4))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters):
        for f in filters:
            found = condition(f)
            if found is None:
                yield f
            else:
                self.where.append(found)

    def partitions(self):
        with sqlite3.connect(self.path) as db:
            low, high = db.execute(f"select min(rowid), max(rowid) from {_quoted(self.table)}").fetchone()
        if low is None:
            return [Span(0, -1)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [Span(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition):
        columns = ", ".join(_quoted(f.name) for f in self.schema.fields)
        with sqlite3.connect(self.path) as db:
            more = "".join(f" and {sql}" for sql, _ in self.where)
            yield from db.execute(f"select {columns} from {_quoted(self.table)} where rowid between ? and ?{more} order by rowid", (partition.low, partition.high, *(v for _, values in self.where for v in values)))


class SqliteWriter(DataSourceWriter):
    """Appends rows of each partition in one transaction; meant for exports of bounded tables to one file."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.schema, self.path, self.table = schema, options["path"], options["dbtable"]
        names = {LongType: "INTEGER", DoubleType: "REAL", BinaryType: "BLOB"}
        with sqlite3.connect(self.path) as db:
            if overwrite:
                db.execute(f"drop table if exists {_quoted(self.table)}")
            db.execute(f"create table if not exists {_quoted(self.table)} ({', '.join(f'{_quoted(f.name)} {names.get(type(f.dataType), 'TEXT')}' for f in schema.fields)})")

    def write(self, iterator):
        marks = ", ".join("?" * len(self.schema.fields))
        with sqlite3.connect(self.path, timeout=60) as db:
            db.executemany(f"insert into {_quoted(self.table)} values ({marks})", (tuple(row) for row in iterator))
        return WriterCommitMessage()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        out, wanted = StructType(), self.options.get("columns")
        with sqlite3.connect(self.options["path"]) as db:
            for _, column, kind, *_ in db.execute(f"pragma table_info({_quoted(self.options['dbtable'])})"):
                if wanted is None or column in wanted.split(","):
                    out = out.add(column, _KINDS.get(kind.upper()[:3], StringType()))
        return out

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(schema, dict(self.options), overwrite)


def read(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A table, or only some of its columns: the others are not read. Filters on it go to SQLite."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("sqlite").option("path", path).option("dbtable", table)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load()


def write(df: DataFrame, path: str, table: str, mode: str = "append") -> None:
    df.sparkSession.dataSource.register(SqliteSource)
    df.coalesce(1).write.format("sqlite").option("path", path).option("dbtable", table).mode(mode).save()
