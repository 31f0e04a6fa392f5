"""Appends to typed tables from objects whose keys are the column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType


def promote_columns(df: DataFrame, target: StructType, envelope: str = "envelope") -> DataFrame:
    """Rows of the target table from an object column.

    Every value passes through text and is cast to its column; an absent key is null. Column names
    match without regard to case, as the catalog does. A key the target does not have, or that is
    there twice, is an error.
    """
    names = F.array(*[F.lit(f.name.lower()) for f in target.fields])
    values = F.transform_keys(
        F.transform_values(F.col(envelope), lambda k, v: v.cast("string")), lambda k, v: F.lower(k)
    )
    checked = df.select(values.alias("_v")).withColumn(
        "_unknown", F.array_except(F.map_keys("_v"), names)
    )
    problem = F.concat(F.lit("columns not in the target table: "), F.array_join("_unknown", ","))
    ok = F.when(F.size("_unknown") > 0, F.raise_error(problem).cast("map<string,string>"))
    checked = checked.select(ok.otherwise(F.col("_v")).alias("_v"))

    def value(name: str, dtype) -> Column:
        return F.col("_v").getItem(name.lower()).cast(dtype).alias(name)

    return checked.select(*[value(f.name, f.dataType) for f in target.fields])


def append_dynamic(df: DataFrame, table: str, envelope: str = "envelope") -> None:
    """Append object rows to a catalog table, whatever subset of its columns they carry.

    Updates and deletes are appended as rows too.
    """
    target = df.sparkSession.table(table).schema
    promote_columns(df, target, envelope).write.insertInto(table)


# Fixed rules: the types a column may be widened to, which readers of its older files understand.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}
INTEGERS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
# Keys of all objects of a batch; more is an error, since a table has a column for each.
MAX_KEYS = 5000


def key_types(df: DataFrame, envelope: str = "envelope") -> dict[str, str]:
    """The type that holds all values of each key, names in lower case; keys with only nulls are left out.

    Whole numbers are ``int`` or ``bigint`` by their range, other numbers ``double``; texts, objects,
    arrays and mixtures of types are ``string``. One pass, combined before the shuffle.
    """
    values = df.select(F.explode(envelope).alias("k", "v")).select(F.lower("k").alias("k"), "v")
    most = F.max(F.abs(F.try_variant_get("v", "$", "decimal(38,0)")))
    found = values.groupBy("k").agg(F.schema_of_variant_agg("v").alias("kind"), most.alias("most"))
    rows = found.limit(MAX_KEYS + 1).collect()
    if len(rows) > MAX_KEYS:
        raise ValueError(f"objects have more than {MAX_KEYS} keys")
    out = {}
    for key, kind, largest in rows:
        kind = kind.lower()
        if kind == "void":
            continue
        if kind == "bigint":
            out[key] = "int" if largest < 1 << 31 else "bigint"
        elif kind in ("double", "float") or kind.startswith("decimal"):
            out[key] = "double"
        else:
            out[key] = kind if kind in ("boolean", "date", "timestamp") else "string"
    return out


def evolved(target: StructType, seen: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """``(new columns, widened columns)`` that a table needs for keys of the types seen; a conflict is an error.

    A text column takes every value, and a text is written to any column it can be cast to. A new column
    of whole numbers is ``bigint``.
    """
    have = {f.name.lower(): f.dataType.simpleString() for f in target.fields}
    added, widened, conflicts = {}, {}, []
    for key, kind in sorted(seen.items()):
        old = have.get(key)
        if old is None:
            added[key] = "bigint" if kind == "int" else kind
        elif old == kind or "string" in (old, kind) or INTEGERS.get(kind, 64) <= INTEGERS.get(old, 0):
            continue
        elif kind in WIDER.get(old, ()):
            widened[key] = kind
        elif not (old.startswith("decimal") and kind in ("int", "bigint", "double") or old == "double" and kind == "int"):
            conflicts.append(f"{key} is {old}, got {kind}")
    if conflicts:
        raise ValueError("values do not fit their columns: " + "; ".join(conflicts))
    return added, widened


def append_evolving(df: DataFrame, table: str, envelope: str = "envelope") -> tuple[dict[str, str], dict[str, str]]:
    """Append object rows to a catalog table whose columns follow the keys; what was added and widened.

    New keys become new columns, null in older rows. A column too narrow for its values is widened by
    ``WIDER``: the table, which must be external, is declared anew over the same files, and readers
    widen what older files hold. Nothing is changed when some key conflicts.
    """
    spark = df.sparkSession
    added, widened = evolved(spark.table(table).schema, key_types(df, envelope))
    if widened:
        _redeclare(spark, table, widened)
    if added:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in added.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    append_dynamic(df, table, envelope)
    return added, widened


def _redeclare(spark: SparkSession, table: str, widened: dict[str, str]) -> None:
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if facts.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} is no external table: columns to widen: {', '.join(sorted(widened))}")
    fields = spark.table(table).schema.fields
    columns = ", ".join(f"`{f.name}` {widened.get(f.name.lower(), f.dataType.simpleString())}" for f in fields)
    location = facts["Location"].replace("'", "\\'")
    spark.sql(f"DROP TABLE {table}")  # an external table's files stay
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {facts['Provider']} LOCATION '{location}'")


def dynamic_stream(
    df: DataFrame, target: StructType, path: str, envelope: str = "envelope"
) -> DataStreamWriter:
    """The same as a stream into the folder of a parquet table; exactly once by its log."""
    rows = promote_columns(df, target, envelope)
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")
