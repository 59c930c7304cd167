"""Databases over a Python DB-API module: bound parameters, exact batches, any statement.

Reading: every partition runs the query (with its own parameters) on its own connection
and yields Arrow batches of exactly ``batch_rows`` rows, fetched one ahead by a thread if
``prefetch`` is set. The rows of a batch may follow from limits on rows and bytes and the
columns' descriptions. Of several result sets one is read. Writing: every task turns its
Arrow batches into rows and sends them with ``executemany`` in chunks of ``row_capacity``, which
span batches, and commits at its end; a task that is repeated sends its rows again.
Placeholders are those of the module's ``paramstyle``; named ones are columns.
"""

from __future__ import annotations

import importlib
import json
import queue
import sys
import threading
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from lodestone.errors import BindParameters, ExecuteStatement, PreparingStatement, writer_errors
from lodestone.functions.inference import ColumnDescriptor, infer_logical
from lodestone.functions.sqlgen import insert_statement, placeholders
from lodestone.operators.convert import read_projection, write_projection
from lodestone.operators.limits import ReaderOptions
from lodestone.types import Logical, check_readable

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def connect(options: dict):
    return importlib.import_module(options["module"]).connect(**json.loads(options["connect"]))


class Part(InputPartition):
    def __init__(self, params: list):
        self.params = params


class DbApiReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, dict(options)

    def partitions(self) -> list[Part]:
        return [Part(p) for p in json.loads(self.options.get("partitions", "[[]]"))]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        batches = self.batches(partition.params)
        yield from prefetched(batches) if self.options.get("prefetch") == "true" else batches

    def batches(self, params: list) -> Iterator[pa.RecordBatch]:
        arrow, number = to_arrow_schema(self.schema), self.options.get("batch_column") or None
        connection = connect(self.options)
        try:
            cursor = connection.cursor()
            cursor.execute(self.options["query"], params)
            for _ in range(int(self.options.get("result_set", 0))):
                if not cursor.nextset():
                    return
            batch = 0
            while rows := cursor.fetchmany(int(self.options.get("batch_rows", 65_535))):
                columns = [*zip(*rows, strict=True)] + ([[batch] * len(rows)] if number else [])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                batch += 1
        finally:
            connection.close()


def prefetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fetches one batch ahead in a thread; errors come out where the batch would have."""
    ahead: queue.Queue = queue.Queue(maxsize=1)
    stop = threading.Event()

    def put(item) -> None:
        while not stop.is_set():
            try:
                return ahead.put(item, timeout=0.1)
            except queue.Full:
                continue

    def fetch() -> None:
        try:
            for batch in batches:
                put((batch, None))
                if stop.is_set():
                    return
            put((None, None))
        except Exception as e:  # noqa: BLE001  goes on to the reader
            put((None, e))

    thread = threading.Thread(target=fetch, daemon=True)
    thread.start()
    try:
        while True:
            batch, error = ahead.get()
            if error is not None:
                raise error
            if batch is None:
                return
            yield batch
    finally:
        stop.set()
        thread.join()


class Sent(WriterCommitMessage):
    def __init__(self, chunks: list[int]):
        self.chunks = chunks


class DbApiWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        capacity, chunks, named = int(self.options.get("row_capacity", 10_000)), [], paramstyle(self.options["module"]) in ("named", "pyformat")
        connection = connect(self.options)
        try:
            cursor, held = connection.cursor(), []

            def flush() -> None:
                try:
                    cursor.executemany(self.options["statement"], held)
                except Exception as e:
                    raise ExecuteStatement(f"ExecuteStatement: {e}") from e
                chunks.append(len(held))
                held.clear()

            for batch in iterator:
                rows = batch.to_pylist() if named else zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for row in rows:
                    held.append(row)
                    if len(held) == capacity:
                        flush()
            if held:
                flush()
            connection.commit()
        finally:
            connection.close()
        return Sent(chunks)

    def commit(self, messages: list) -> None:
        """Tasks have committed their own rows."""

    def abort(self, messages: list) -> None:
        """Chunks that other tasks have committed stay."""


class DbApiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dbapi"

    def schema(self) -> str:
        raise ValueError("dbapi needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return DbApiReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return DbApiWriter(self.options)


def paramstyle(module: str) -> str:
    return importlib.import_module(module).paramstyle


def scan(
    spark: SparkSession, module: str, connect_args: dict, query: str, schema: str | StructType | None = None, params: list[list] | None = None, batch_rows: int = 65_535,
    prefetch: bool = False, columns: list[ColumnDescriptor] | None = None, options: ReaderOptions | None = None, result_set: int = 0, batch_column: str | None = None,
) -> DataFrame:
    """Rows of a query.

    params: one list of parameters per partition. Either ``schema`` says what comes, or ``columns``
    describe it: then types are inferred and values converted as in any scan, and the limits of
    ``options`` on rows and bytes give the rows of a batch. result_set: which of several, from 0.
    batch_column: adds the number of a row's batch in its partition.
    """
    reading = schema
    if columns is not None:
        reader_options = options or ReaderOptions()
        typed = reader_options.schema or [(c.name, infer_logical(c, k, reader_options.dbms_name)) for k, c in enumerate(columns)]
        check_readable(typed)
        batch_rows = reader_options.max_rows_per_batch(columns, [t for _, t in typed])
        reading = StructType([StructField(c.name, delivered(t)) for c, (_, t) in zip(columns, typed, strict=True)])
    if batch_column:
        whole = StructType.fromDDL(reading) if isinstance(reading, str) else reading
        reading = StructType([*whole.fields, StructField(batch_column, LongType())])
    spark.dataSource.register(DbApiSource)
    given = {
        "module": module, "connect": json.dumps(connect_args), "query": query, "partitions": json.dumps(params or [[]]), "batch_rows": batch_rows,
        "prefetch": str(prefetch).lower(), "result_set": result_set, "batch_column": batch_column or "",
    }
    rows = spark.read.format("dbapi").schema(reading).options(**given).load()
    if columns is None:
        return rows
    extra = [(batch_column, Logical("int64"))] if batch_column else []
    described = columns + [ColumnDescriptor(n, "bigint") for n, _ in extra]
    return read_projection(rows, typed + extra, reader_options, described)


def delivered(logical: Logical) -> DataType:
    """What a driver gives for a type: dates, times, decimals and timestamps as text."""
    if logical.kind in ("decimal", "time", "timestamp", "date"):
        return StringType()
    return LongType() if logical.kind == "bool" else logical.spark_type()


def result_sets(spark: SparkSession, module: str, connect_args: dict, query: str, schemas: list[str | None]) -> list[DataFrame]:
    """A frame for each result of a query that gives several; None: a result without columns."""
    empty = StructType([])
    return [spark.createDataFrame([], empty) if s is None else scan(spark, module, connect_args, query, s, result_set=k) for k, s in enumerate(schemas)]


def execute_many(df: DataFrame, module: str, connect_args: dict, statement: str, row_capacity: int = 10_000, probe: str | None = None) -> None:
    """Runs any statement with one placeholder per column for all rows.

    probe: a form such as "EXPLAIN {}" that has the database check the statement before any row is
    sent. Databases differ in it, so only sqlite has one by itself; without one a bad statement
    fails with the first chunk.
    """
    style = paramstyle(module)
    marks = placeholders(statement, style)
    if len(marks) != len(df.columns):
        raise BindParameters(f"{len(marks)} placeholders for {len(df.columns)} columns")
    if style in ("named", "pyformat"):
        names = {m[1:] if style == "named" else m[2:-2] for m in marks}
        if names != set(df.columns):
            raise BindParameters(f"placeholders {sorted(names)} for columns {sorted(df.columns)}")
    probe = probe or ("EXPLAIN {}" if module == "sqlite3" else None)
    if probe:
        connection = connect({"module": module, "connect": json.dumps(connect_args)})
        try:
            connection.cursor().execute(probe.format(statement), dict.fromkeys(df.columns) if style in ("named", "pyformat") else [None] * len(marks))
        except Exception as e:
            raise PreparingStatement(statement, e) from e
        finally:
            connection.close()
    df.sparkSession.dataSource.register(DbApiSource)
    options = {"module": module, "connect": json.dumps(connect_args), "statement": statement, "row_capacity": row_capacity}
    with writer_errors():
        write_projection(df).write.format("dbapi").options(**options).mode("append").save()


def insert(df: DataFrame, module: str, connect_args: dict, table: str, row_capacity: int = 10_000) -> None:
    execute_many(df, module, connect_args, insert_statement(table, df.schema, paramstyle(module)), row_capacity)
