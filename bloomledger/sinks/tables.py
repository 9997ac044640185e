"""Price tables, the mapping table and CSV snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv

_CSV = {"header": True, "escape": '"', "emptyValue": "", "nullValue": ""}


def export_columns(products: DataFrame, table: str) -> DataFrame:
    """The columns a price table takes, in its order; absent ones are skipped.

    The stem length is made a whole number here; text that is not one is null.
    """
    allowed = fv.EXPORT_COLUMNS.get(table.lower())
    if allowed is None:
        raise ValueError(f"no export columns are defined for table {table!r}")
    present = [c for c in allowed if c in products.columns]
    return products.select(
        *[F.col(c).try_cast("bigint").alias(c) if c == "stem_length" else F.col(c) for c in present]
    )


def replace_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Write rows by partition; partitions that they name are replaced, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_prices(products: DataFrame, table: str, root: str, day: str | None = None) -> bool:
    """Add a day to `root/<table>` (Parquet by `created_at`); False if there is no row.

    A day that the table already has is replaced, so a run can be repeated; with `day`
    given, a run without rows empties that day.
    """
    chosen = export_columns(products, table)
    path = f"{root.rstrip('/')}/{table.lower()}"
    if chosen.isEmpty():
        if day is not None:
            _drop_partition(products.sparkSession, f"{path}/created_at={day}")
        return False
    replace_partitions(chosen, path, ["created_at"])
    return True


def _drop_partition(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_mapping(mapping: DataFrame, path: str) -> None:
    """Make this the mapping table.

    The rows go into a version folder of their own, and a one-row pointer table names it
    afterwards: a job that fails leaves the old mapping in place.  `read_mapping` follows
    the pointer, so `mapping` may be derived from the table it replaces.
    """
    version = f"{path.rstrip('/')}/version={uuid.uuid4().hex}"
    mapping.select("competitor_product_id", "variety_key").write.parquet(version)
    spark = mapping.sparkSession
    named = spark.range(1).select(F.current_timestamp().alias("since"), F.lit(version).alias("version"))
    named.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/current")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The mapping that was put in place last."""
    named = spark.read.parquet(f"{path.rstrip('/')}/current")
    return spark.read.parquet(named.orderBy(F.desc("since")).first()["version"])


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV directory with headers, quotes doubled, nulls and '' left empty."""
    rows.write.mode("overwrite").options(**_CSV).csv(path)


def filled_columns(products: DataFrame) -> DataFrame:
    """One row: for each column, 1 when any row holds a value, else 0.

    Null, the empty text and empty collections are no values.
    """

    def filled(name: str, kind: str):
        value = F.col(name)
        if kind == "string":
            test = value != ""
        elif kind.startswith(("array", "map")):
            test = F.size(value) > 0
        else:
            test = value.isNotNull()
        return F.max(F.coalesce(test, F.lit(False)).cast("int"))

    return products.agg(
        *[F.coalesce(filled(n, t), F.lit(0)).alias(n) for n, t in products.dtypes]
    )


def prune_empty_columns(products: DataFrame) -> DataFrame:
    """Drop columns without any value (one aggregate pass over the rows)."""
    row = filled_columns(products).first().asDict()
    return products.select(*[c for c in products.columns if row[c]])


def snapshot_path(root: str, source: str, eta_date: str) -> str:
    return f"{root.rstrip('/')}/{source}/{source}_inventory_{eta_date}.csv"


def save_snapshot(products: DataFrame, path: str) -> bool:
    """Write a source's run as CSV without its empty columns; False if no rows.

    Schema fields come in schema order, other columns are left out.
    """
    known = [n for n, _ in fv.PRODUCT_FIELDS if n in products.columns]
    kept = prune_empty_columns(products.select(*known))
    if not kept.columns:
        return False
    write_csv(kept, path)
    return True
