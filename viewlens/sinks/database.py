"""Micro-batches to a database over JDBC, each exactly once.

A batch is written to a staging table of its own, in parallel. One transaction then
moves it: into a table with keys by replacing the rows of its keys, into a table of
events unless a ledger names the batch already; it notes the batch in the ledger
and drops the staging table. A batch delivered again changes nothing, whether the first
delivery failed before, in or after the transaction.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .batches import BatchWriter, kept

LEDGER = "loaded_batches"
Execute = Callable[[SparkSession, dict[str, str], Sequence[str]], None]


def quoted(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def staging_table(table: str, batch_id: int) -> str:
    return f"{table}_batch_{batch_id}"


def ledger_statement(ledger: str = LEDGER) -> str:
    return (
        f"CREATE TABLE IF NOT EXISTS {quoted(ledger)} "
        "(table_name VARCHAR(200), batch_id BIGINT, PRIMARY KEY (table_name, batch_id))"
    )


def merge_statements(
    table: str, columns: Sequence[str], batch_id: int, keys: Sequence[str] = (), ledger: str = LEDGER
) -> list[str]:
    """The statements of one transaction that move a batch from its staging table.

    Keys that are NULL are equal to each other. Standard SQL, so any database that
    knows IS NOT DISTINCT FROM takes them.
    """
    target, stage = quoted(table), quoted(staging_table(table, batch_id))
    names = ", ".join(map(quoted, columns))
    insert = f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage}"
    note = f"table_name = {_text(table)} AND batch_id = {batch_id}"
    known = f"SELECT 1 FROM {quoted(ledger)} WHERE {note}"
    statements = []
    if keys:
        same = " AND ".join(f"{target}.{quoted(k)} IS NOT DISTINCT FROM s.{quoted(k)}" for k in keys)
        statements.append(f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})")
        statements.append(insert)
    else:
        statements.append(f"{insert} WHERE NOT EXISTS ({known})")
    statements.append(
        f"INSERT INTO {quoted(ledger)} SELECT {_text(table)}, {batch_id} WHERE NOT EXISTS ({known})"
    )
    statements.append(f"DROP TABLE {stage}")
    return statements


def run_transaction(spark: SparkSession, connection: dict[str, str], statements: Sequence[str]) -> None:
    """Runs statements in one transaction through the JDBC driver of the session."""
    jvm = spark.sparkContext._jvm
    if "driver" in connection:
        jvm.java.lang.Class.forName(connection["driver"])
    properties = jvm.java.util.Properties()
    for key, value in connection.items():
        if key not in ("url", "dbtable", "driver"):
            properties.setProperty(key, value)
    opened = jvm.java.sql.DriverManager.getConnection(connection["url"], properties)
    try:
        opened.setAutoCommit(False)
        for statement in statements:
            opened.createStatement().execute(statement)
        opened.commit()
    except Exception:
        opened.rollback()
        raise
    finally:
        opened.close()


def database_writer(
    connection: dict[str, str],
    table: str,
    *,
    keys: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_connections: int = 16,
    rows_per_connection: int = 100_000,
    execute: Execute = run_transaction,
    store: Callable[[DataFrame, dict[str, str]], None] | None = None,
) -> BatchWriter:
    """A foreachBatch writer to an existing table; with ``keys`` its rows are replaced by them.

    A batch must then hold each key once. An empty batch touches nothing.
    """
    if not re.fullmatch(r"[\w.]+", table):
        raise ValueError(f"not a table name: {table}")

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            n = rows.count()
            if not n:
                return
            rows = transform(rows) if transform else rows
            tasks = min(max_connections, math.ceil(n / rows_per_connection))
            stage = connection | {"dbtable": quoted(staging_table(table, batch_id))}
            (store or _store)(rows.repartition(tasks), stage)
            spark, columns = rows.sparkSession, rows.columns
            moves = merge_statements(table, columns, batch_id, keys)
            execute(spark, connection, [ledger_statement(), *moves])

    return write


def _store(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("overwrite").save()
