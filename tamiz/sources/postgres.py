"""PostgreSQL as store: reading by JDBC, upserts by the database's own statement. Needs its JDBC driver and psycopg2."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def create_statement(table: str, columns: Mapping[str, str], key: str) -> str:
    """The table's declaration, its types word for word."""
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'{n} {t}' for n, t in columns.items())}, PRIMARY KEY ({key}))"


def upsert_statement(table: str, columns: Sequence[str], key: str) -> str:
    """Insert or overwrite by key, every other column given, NULLs too; columns not given keep their value or default."""
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES %s ON CONFLICT ({key}) DO " + (f"UPDATE SET {sets}" if sets else "NOTHING")


def read_table(spark: SparkSession, url: str, table: str, columns: Sequence[str], **options: str) -> DataFrame:
    """Columns of a table; filters put on the result are pushed down to the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def upsert_rows(batch: DataFrame, dsn: str, table: str, key: str, page: int = 1000) -> None:
    """Upserts a batch, one transaction for each partition. Repeating it changes nothing; ``key`` must not repeat in it."""
    columns = batch.columns
    statement = upsert_statement(table, columns, key)

    def write(rows) -> None:
        import psycopg2
        from psycopg2.extras import execute_values

        with psycopg2.connect(dsn) as connection, connection.cursor() as cursor:
            execute_values(cursor, statement, [tuple(r[c] for c in columns) for r in rows], page_size=page)

    batch.foreachPartition(write)
