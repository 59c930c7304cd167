"""Databases over JDBC: description without rows, scans with pushdown, appends.

An embedded database belongs to the one JVM that has opened it. So the driver's JVM writes it, a
partition at a time, and executors read it from an archive (`published`) that each opens for itself.
"""

from __future__ import annotations

import os
import shutil
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodestone.errors import FailedToDescribeColumn, MetadataUnavailable, TooLarge, writer_errors
from lodestone.functions.inference import ColumnDescriptor, infer_logical, jdbc_descriptor
from lodestone.operators.convert import read_projection, write_projection
from lodestone.operators.limits import ReaderOptions

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
#: Rows that the driver gets at a time on their way into an embedded database.
PORTION = 25_000


def _connect(spark: SparkSession, url: str, driver: str | None):
    jvm = spark._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    return jvm.java.sql.DriverManager.getConnection(url)


def describe(spark: SparkSession, url: str, sql: str, driver: str | None = None) -> tuple[list[ColumnDescriptor], str]:
    """Columns of a statement and the database's name. The statement is prepared, not run."""
    connection = _connect(spark, url, driver)
    try:
        name = connection.getMetaData().getDatabaseProductName()
        meta = connection.prepareStatement(sql).getMetaData()
        if meta is None:
            return [], name
        try:
            columns = [
                jdbc_descriptor(meta.getColumnLabel(k), meta.getColumnType(k), meta.getPrecision(k), meta.getScale(k), meta.getColumnDisplaySize(k), meta.isNullable(k) != 0, meta.isSigned(k))
                for k in range(1, meta.getColumnCount() + 1)
            ]
        except Exception as e:
            raise FailedToDescribeColumn(str(e)) from e
        return columns, name
    except FailedToDescribeColumn:
        raise
    except Exception as e:
        raise MetadataUnavailable(str(e)) from e
    finally:
        connection.close()


def execute(spark: SparkSession, url: str, *statements: str, driver: str | None = None) -> None:
    """Runs statements without results on one connection of the driver."""
    connection = _connect(spark, url, driver)
    try:
        for sql in statements:
            connection.createStatement().execute(sql)
    finally:
        connection.close()


def scan(spark: SparkSession, url: str, sql: str, options: ReaderOptions | None = None, driver: str | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """Rows of a statement in inferred or given types.

    partition: (column, lower, upper, count) for parallel reading. Columns of later steps are
    pushed into the statement, and filters on columns that need no conversion.
    """
    options = options or ReaderOptions()
    columns, name = describe(spark, url, sql, driver)
    schema = options.schema or [(c.name, infer_logical(c, k, options.dbms_name or name)) for k, c in enumerate(columns)]
    rows = options.max_rows_per_batch(columns, [t for _, t in schema]) if columns else 1
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", rows)
    if driver:
        reader = reader.option("driver", driver)
    if partition:
        column, low, high, count = partition
        reader = reader.option("dbtable", f"({sql}) q").option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", count)
    else:
        reader = reader.option("query", sql)
    return read_projection(reader.load(), schema, options, columns if len(columns) == len(schema) else None)


def insert(df: DataFrame, url: str, table: str, row_capacity: int = 10_000, driver: str | None = None) -> None:
    """Appends rows in chunks. Each partition is a transaction where the database has them."""
    if embedded(url):
        with writer_errors():
            return _insert_here(write_projection(df), url, table, row_capacity, driver)
    writer = write_projection(df).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", row_capacity)
    with writer_errors():
        (writer.option("driver", driver) if driver else writer).mode("append").save()


def result_sets(spark: SparkSession, url: str, sql: str, driver: str | None = None, most: int = 100_000) -> list[DataFrame]:
    """All results of a statement that gives several, in order; one without rows, such as an
    update count, has no columns. They come through the driver: more than ``most`` rows of a
    result are refused, as a scan is the way to these.
    """
    connection = _connect(spark, url, driver)
    try:
        statement = connection.createStatement()
        results, rows = [], statement.execute(sql)
        while rows or statement.getUpdateCount() != -1:
            if rows:
                cursor = statement.getResultSet()
                meta = cursor.getMetaData()
                names = [meta.getColumnLabel(k) for k in range(1, meta.getColumnCount() + 1)]
                values = []
                while cursor.next():
                    values.append(tuple(cursor.getString(k) for k in range(1, len(names) + 1)))
                    if len(values) > most:
                        raise TooLarge(len(values), len(names))
                descriptors = [jdbc_descriptor(n, meta.getColumnType(k), meta.getPrecision(k), meta.getScale(k), meta.getColumnDisplaySize(k), True, meta.isSigned(k)) for k, n in enumerate(names, 1)]
                texts = spark.createDataFrame(values, T.StructType([T.StructField(n, T.StringType()) for n in names]))
                results.append(read_projection(texts, [(c.name, infer_logical(c, k)) for k, c in enumerate(descriptors)]))
            else:
                results.append(spark.createDataFrame([], T.StructType([])))
            rows = statement.getMoreResults()
        return results
    finally:
        connection.close()


def embedded(url: str) -> bool:
    """Whether a database lives in the JVM that connects to it."""
    return url.startswith("jdbc:derby:") and not url.startswith("jdbc:derby://")


def _insert_here(df: DataFrame, url: str, table: str, row_capacity: int, driver: str | None) -> None:
    """Appends rows from the driver's JVM, which holds `PORTION` of them or so at a time."""
    spark, jvm = df.sparkSession, df.sparkSession._jvm
    jdbc = jvm.org.apache.spark.sql.execution.datasources.jdbc
    given = {"url": url, "dbtable": table, "batchsize": str(row_capacity)} | ({"driver": driver} if driver else {})
    options = jdbc.JdbcOptionsInWrite(url, table, jvm.PythonUtils.toScalaMap(given))
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    connection = _connect(spark, url, driver)
    try:
        columns = jdbc.JdbcUtils.getSchemaOption(connection, options)
    finally:
        connection.close()
    schema = df._jdf.schema()
    statement = jdbc.JdbcUtils.getInsertStatement(table, schema, columns, spark.conf.get("spark.sql.caseSensitive") == "true", dialect)
    contexts = getattr(getattr(jvm.org.apache.spark, "TaskContext$"), "MODULE$")
    context = contexts.empty()  # Spark's writer counts its rows in a task's
    java8 = "spark.sql.datetime.java8API.enabled"
    context.getLocalProperties().setProperty(java8, spark.conf.get(java8))
    count = max(1, -(-df.count() // PORTION))
    portions, which = df.repartition(count)._jdf.toJavaRDD(), spark.sparkContext._gateway.new_array(jvm.int, 1)
    for k in range(count):
        which[0] = k
        found = portions.collectPartitions(which)
        listed = found[0]
        listing = listed.iterator()
        rows = jvm.scala.jdk.javaapi.CollectionConverters.asScala(listing)
        contexts.setTaskContext(context)
        try:
            jdbc.JdbcUtils.savePartition(table, rows, schema, statement, row_capacity, dialect, options.isolationLevel(), options)
        finally:
            contexts.unset()
            for held in (rows, listing, listed, found):  # else the JVM keeps them until Python collects its garbage
                spark.sparkContext._gateway.detach(held)


def published(spark: SparkSession, folder: str, name: str, driver: str = DERBY_DRIVER) -> str:
    """The URL of a read-only archive of the Derby database ``folder``/``name``, which is closed for good.

    Any number of JVMs that see the folder can open it at a time; nothing is compressed, so that
    pages are read where they lie.
    """
    path = os.path.join(folder, name)
    try:
        _connect(spark, f"jdbc:derby:{path};shutdown=true", driver)
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # says that it has been closed
            raise
    archive = f"{path}.jar"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for top, _, files in os.walk(path):
            for file in sorted(files):
                if not file.endswith(".lck"):
                    at = os.path.join(top, file)
                    z.write(at, os.path.join(name, os.path.relpath(at, path)))
    shutil.rmtree(path)
    return f"jdbc:derby:jar:({archive}){name}"
