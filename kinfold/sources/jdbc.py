"""JDBC and keyed scans.

A keyed scan returns the rows of a table whose key column is in an id set
held as a DataFrame.  It is a left-semi join, so the id set never passes
through the driver and there is no chunking into IN lists; for JDBC sources
the read itself is split into parallel range or predicate partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.model import GraphError
from kinfold.operators.frontier import key_ranges, pruned

# fixed value: rows per JDBC round trip used by the export reads
FETCH_SIZE = 10000


def keyed_scan(table: DataFrame, ids: DataFrame | Sequence[str], id_column: str,
               ids_column: str = "id", ranges: int = 0) -> DataFrame:
    """Rows of ``table`` whose ``id_column`` is in the id set.

    ``ids`` as a DataFrame: a left-semi join; the id set is cast to the key's
    type (not the other way round) so a filter on the key can still reach
    the scan, and Spark picks broadcast or shuffle from measured sizes.
    ``ids`` as a literal list the caller already holds (bounded, e.g. a
    request): an ``IN`` filter pushed into the source (Parquet row groups,
    a JDBC ``WHERE``).  ``ranges``: also push the id set's key ranges, at most
    so many, into the source (``operators.frontier``; one small job at once).  Empty input gives an empty frame, no special case.
    """
    key_type = table.schema[id_column].dataType
    if not isinstance(ids, DataFrame):
        values = list(ids)
        if any(v is None for v in values):
            raise GraphError("null id in the id list")
        return table.where(F.col(id_column).isin(
            [F.lit(v).cast(key_type) for v in values]) if values else F.lit(False))
    keys = ids.select(F.col(ids_column).cast(key_type).alias(id_column))
    if ranges:
        table = pruned(table, id_column, key_ranges(keys, id_column, ranges))
    return table.join(keys, id_column, "left_semi")


def jdbc_reader(spark: SparkSession, url: str, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                fetchsize: int = FETCH_SIZE, **options: str):
    """A configured ``DataFrameReader`` for JDBC."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    for k, v in options.items():
        r = r.option(k, str(v))
    return r


def read_table(spark: SparkSession, url: str, table: str, *,
               predicates: Sequence[str] | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               properties: dict[str, str] | None = None) -> DataFrame:
    """Read a whole table by name, split for parallel reads.

    ``dbtable`` (not a ``query``) is used so that column pruning and simple
    filters are pushed into the database.  Pass either ``predicates`` (one
    partition each, e.g. hash buckets of a string id) or a numeric
    ``partition_column`` with bounds.
    """
    props = {"fetchsize": str(FETCH_SIZE), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def hash_predicates(column: str, buckets: int, hash_sql: str = "ABS(MOD({h}, {n}))",
                    hash_expr: str | None = None) -> list[str]:
    """WHERE clauses splitting a table into ``buckets`` disjoint reads.

    ``hash_expr`` is the database's integer hash of the column (defaults to
    the column itself, for numeric keys).
    """
    h = hash_expr or column
    return [f"{hash_sql.format(h=h, n=buckets)} = {i}" for i in range(buckets)]


def postgres_properties(user: str, password: str) -> dict[str, str]:
    """Write options that let JSON text land in JSON columns (K3)."""
    return {"user": user, "password": password, "driver": "org.postgresql.Driver",
            "stringtype": "unspecified"}


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                 partitions: int | None = None, batch_size: int | None = None,
                 column_types: str | None = None) -> None:
    """Append rows to a table (K1/K2): at most ``partitions`` connections, batched inserts."""
    w = df.write.mode("append")
    if partitions:
        w = w.option("numPartitions", partitions)
    if batch_size:
        w = w.option("batchsize", batch_size)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.jdbc(url, table, properties=properties)
