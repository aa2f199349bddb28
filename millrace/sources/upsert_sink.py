"""Write a DataFrame back into a relational table by keyed upserts, all or nothing.

A Python data source that speaks to any DB-API module. Tasks insert their rows, in chunks, into a
staging table beside the target, each in one transaction and under a mark of its own. When all have
ended, the driver merges the rows of the marks it was told into the target by one statement and drops
the staging table. A failed task leaves nothing; a task that was run twice counts once; a failed
job drops the staging table and the target is as it was.

    register_upsert(spark)
    df.write.format("keyed_upsert").option("module", "psycopg").option("connect", json.dumps({...})) \\
        .option("table", "orders").option("keys", "order_id").mode("append").save()
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

CHUNK_ROWS = 1000
MARK = "upsert_mark"

# How the dialects mark a parameter and quote a name.
_PARAMETERS = {"qmark": "?", "format": "%s", "pyformat": "%s"}
DIALECTS = ("on_conflict", "on_duplicate_key")


def _quoted(name: str, dialect: str) -> str:
    mark = "`" if dialect == "on_duplicate_key" else '"'
    return mark + name.replace(mark, mark + mark) + mark


def merge_statement(table: str, stage: str, columns: Sequence[str], keys: Sequence[str], marks: int, dialect: str, parameter: str = "?") -> str:
    """The upsert from the staging table; the rows' marks are its parameters."""
    names = [_quoted(c, dialect) for c in columns]
    others = [n for c, n in zip(columns, names, strict=True) if c not in keys]
    chosen = ", ".join([parameter] * marks)
    head = f"INSERT INTO {table} ({', '.join(names)}) SELECT {', '.join(names)} FROM {stage} WHERE {MARK} IN ({chosen})"
    if dialect == "on_duplicate_key":
        sets = ", ".join(f"{n} = VALUES({n})" for n in others or names[:1])
        return f"{head} ON DUPLICATE KEY UPDATE {sets}"
    target = ", ".join(_quoted(k, dialect) for k in keys)
    if not others:
        return f"{head} ON CONFLICT ({target}) DO NOTHING"
    return f"{head} ON CONFLICT ({target}) DO UPDATE SET {', '.join(f'{n} = EXCLUDED.{n}' for n in others)}"


@dataclass
class Written(WriterCommitMessage):
    mark: str
    rows: int


class UpsertWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.module = options["module"]
        self.arguments = json.loads(options.get("connect", "{}"))
        self.table = options["table"]
        self.keys = [k.strip() for k in options["keys"].split(",")]
        self.dialect = options.get("dialect", DIALECTS[0])
        self.chunk = int(options.get("chunk", CHUNK_ROWS))
        self.columns = schema.fieldNames()
        self.stage = f"{self.table}_stage_{uuid.uuid4().hex[:12]}"
        if self.dialect not in DIALECTS:
            raise ValueError(f"unknown dialect: {self.dialect}")
        if missing := [k for k in self.keys if k not in self.columns]:
            raise ValueError(f"keys that are no columns: {missing}")
        names = ", ".join(_quoted(c, self.dialect) for c in self.columns)
        # An empty table of the target's own types; here, so that it is there before any task.
        self._run(
            (f"CREATE TABLE {self.stage} AS SELECT {names}, CAST('' AS CHAR(32)) AS {MARK} FROM {self.table} WHERE 1 = 0", ())
        )

    def _connection(self):
        return importlib.import_module(self.module).connect(**self.arguments)

    def _parameter(self) -> str:
        return _PARAMETERS[getattr(importlib.import_module(self.module), "paramstyle", "qmark")]

    def _run(self, *statements: tuple[str, Sequence]) -> None:
        """In one transaction."""
        connection = self._connection()
        try:
            cursor = connection.cursor()
            for sql, values in statements:
                cursor.execute(sql, list(values))
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def write(self, iterator: Iterator) -> Written:
        mark, rows = uuid.uuid4().hex, 0
        connection, parameter = self._connection(), self._parameter()
        names = ", ".join([*(_quoted(c, self.dialect) for c in self.columns), MARK])
        places = "(" + ", ".join([parameter] * (len(self.columns) + 1)) + ")"
        try:
            cursor = connection.cursor()
            for batch in iterator:
                for at in range(0, batch.num_rows, self.chunk):
                    values = [[*row.values(), mark] for row in batch.slice(at, self.chunk).to_pylist()]
                    sql = f"INSERT INTO {self.stage} ({names}) VALUES {', '.join([places] * len(values))}"
                    cursor.execute(sql, [v for row in values for v in row])
                    rows += len(values)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()
        return Written(mark, rows)

    def commit(self, messages: list[Written | None]) -> None:
        marks = [m.mark for m in messages if m is not None and m.rows]
        parameter = self._parameter()
        statements = [(f"DROP TABLE {self.stage}", ())]
        if marks:
            merge = merge_statement(self.table, self.stage, self.columns, self.keys, len(marks), self.dialect, parameter)
            statements.insert(0, (merge, marks))
        self._run(*statements)

    def abort(self, messages: list[Written | None]) -> None:
        self._run((f"DROP TABLE {self.stage}", ()))


class KeyedUpsert(DataSource):
    """Options: module, connect (JSON of the arguments), table, keys, dialect, chunk."""

    @classmethod
    def name(cls) -> str:
        return "keyed_upsert"

    def writer(self, schema: StructType, overwrite: bool) -> UpsertWriter:
        if overwrite:
            raise ValueError("keyed_upsert adds to a table or replaces its rows; use mode append")
        return UpsertWriter(schema, dict(self.options))


def register_upsert(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedUpsert)
