"""Harvest of a relational source's system views into catalog frames.

Every function takes the system views as DataFrames, from ``read_system_view`` (one
JDBC read per view) or from parquet copies of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.text import blank
from catalith.functions.values import type_text
from catalith.plans.nesting import attach, nest
from catalith.plans.sizing import dealt

# Fixed values.
CATALOG_VERSION = 3
CONTRACT_VERSION = "1.1.0"
DEFAULT_ENGINE = "postgres"
BASE_TABLE = "BASE TABLE"
TABLE = ("table_schema", "table_name")
COLUMN_FIELDS = (
    "data_type",
    "udt_name",
    "character_maximum_length",
    "numeric_precision",
    "numeric_scale",
    "is_nullable",
    "column_default",
)
FK_FIELDS = ("constraint_name", "position", "from_schema", "from_table", "from_column", "to_schema", "to_table", "to_column")


def read_system_view(spark: SparkSession, url: str, view: str, **options: str) -> DataFrame:
    """One system view over JDBC; partitioning options pass through."""
    return spark.read.format("jdbc").options(url=url, dbtable=view, **options).load()


def harvest_columns(columns: DataFrame, comments: DataFrame | None = None, tasks: int = 0) -> DataFrame:
    """Columns with their comment and readable type.

    ``columns(table_schema, table_name, column_name, ordinal_position, ..)`` and
    ``comments(table_schema, table_name, column_name, col_comment)``; with ``tasks``
    both are dealt by the table into so many.
    """
    dtype = type_text("data_type", "udt_name", "character_maximum_length", "numeric_precision", "numeric_scale")
    rows = columns.withColumn("dtype", dtype)
    if comments is None:
        return rows.withColumn("col_comment", F.lit(None).cast("string"))
    if tasks:
        rows, comments = dealt(rows, TABLE, tasks), dealt(comments, TABLE, tasks)
    return rows.join(comments, [*TABLE, "column_name"], "left")


def harvest_fks(constraints: DataFrame, attributes: DataFrame) -> DataFrame:
    """FK column pairs from parallel key arrays.

    ``constraints(constraint_name, table_id, ref_table_id, conkey, confkey)`` and
    ``attributes(table_id, attnum, table_schema, table_name, column_name)``; the
    ordinal is the place in the key arrays.
    """
    pairs = constraints.select(
        "constraint_name", "table_id", "ref_table_id", F.posexplode(F.arrays_zip("conkey", "confkey")).alias("pos", "k")
    ).select(
        "constraint_name",
        F.col("table_id").alias("from_table_id"),
        F.col("ref_table_id").alias("to_table_id"),
        (F.col("pos") + 1).alias("ordinal"),
        F.col("k.conkey").alias("from_attnum"),
        F.col("k.confkey").alias("to_attnum"),
    )

    def side(prefix: str) -> DataFrame:
        # all columns renamed on both sides, so that one shuffle of the attributes serves both
        return attributes.select(
            F.col("table_id").alias(f"{prefix}_table_id"),
            F.col("attnum").alias(f"{prefix}_attnum"),
            F.col("table_schema").alias(f"{prefix}_schema"),
            F.col("table_name").alias(f"{prefix}_table"),
            F.col("column_name").alias(f"{prefix}_column"),
        )

    rows = pairs.join(side("from"), ["from_table_id", "from_attnum"]).join(side("to"), ["to_table_id", "to_attnum"])
    return rows.select(
        "constraint_name", "from_schema", "from_table", "from_column", "to_schema", "to_table", "to_column", "ordinal"
    )


def harvest_flags(columns: DataFrame, constraints: DataFrame, usage: DataFrame, tasks: int = 0) -> DataFrame:
    """Columns with primary-key and unique flags, from one reading of the key usage.

    With ``tasks`` the columns are dealt by the table already, and the key usage is dealt alike.
    """
    keys = [*TABLE, "column_name"]
    kinds = constraints.where(F.col("constraint_type").isin("PRIMARY KEY", "UNIQUE")).select("constraint_name", "table_schema", "constraint_type")
    kind = F.col("constraint_type")
    held = usage.join(kinds, ["constraint_name", "table_schema"])
    flags = (
        (dealt(held, TABLE, tasks) if tasks else held)
        .groupBy(*keys)
        .agg(F.max(kind == "PRIMARY KEY").alias("is_primary_key"), F.max(kind == "UNIQUE").alias("is_unique"))
    )
    rows = columns.join(flags, keys, "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_primary_key", "is_unique")})


def fk_positions(fks: DataFrame, order: str = "ordinal") -> DataFrame:
    """Running number of every FK column within its schema, constraint and table.

    A key has at most as many columns as a table, so the groups are small.
    """
    from pyspark.sql import Window

    window = Window.partitionBy("from_schema", "constraint_name", "from_table").orderBy(order, "from_column", "to_table", "to_column")
    return fks.withColumn("position", F.row_number().over(window))


def assemble(
    tables: DataFrame, columns: DataFrame, foreign_keys: DataFrame | None = None, engine: str = DEFAULT_ENGINE, tasks: int = 0
) -> DataFrame:
    """One row per table of the snapshot, its columns nested in ordinal order.

    ``tables(meta_db_label, schema, name, comment)``; ``columns(meta_db_label,
    schema, name, ordinal_position, column_name, ..)``.  Columns that carry
    ``is_primary_key`` give the sorted names ``primary_keys``; ``foreign_keys(meta_db_label,
    schema, name, ..)`` of ``fk_positions`` are nested by constraint and position.  With
    ``tasks`` columns and keys are dealt by schema and name, and the tables are dealt alike;
    no table has more columns than ``nesting.MAX_FEW`` or more keys than one part holds then.
    """
    keys = ["meta_db_label", "schema", "name"]
    fields = ["ordinal_position", "column_name", *[c for c in columns.columns if c not in (*keys, "ordinal_position", "column_name")]]
    rows = nest(columns, keys, fields, "columns", few=bool(tasks))
    parents = dealt(tables, ("schema", "name"), tasks) if tasks else tables
    if foreign_keys is None:
        rows = parents.join(rows, keys)
    elif tasks:
        own = nest(foreign_keys, keys, FK_FIELDS, "foreign_keys", few=True)
        rows = parents.join(rows.join(own, [*keys, "part"], "left"), keys)
        rows = rows.withColumn("foreign_keys", F.coalesce("foreign_keys", F.array().cast(own.schema["foreign_keys"].dataType)))
    else:
        own = nest(foreign_keys.join(columns.select(*keys).distinct(), keys, "left_semi"), keys, FK_FIELDS, "foreign_keys")
        rows = attach(parents, {"columns": rows, "foreign_keys": own}, keys, "inner")
    shown = {"columns": F.col("columns")}
    if "is_primary_key" in fields:
        held = F.filter("columns", lambda c: c["is_primary_key"])
        shown["columns"] = F.transform("columns", lambda c: c.dropFields("is_primary_key"))
        shown["primary_keys"] = F.array_sort(F.transform(held, lambda c: c["column_name"]))
    return rows.select(
        *keys,
        F.lit(CATALOG_VERSION).alias("version"),
        F.lit(CONTRACT_VERSION).alias("contract_version"),
        F.lit(engine).alias("source_engine"),
        blank("comment").alias("comment"),
        F.lit(BASE_TABLE).alias("table_type"),
        "part",
        *[c.alias(n) for n, c in shown.items()],
        *([] if foreign_keys is None else ["foreign_keys"]),
    )
