"""Dimension tables: read, load, declared-integrity check, enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIM_KEYS, DIM_SCHEMAS
from .joins import left_join_nonnull

# Dimension file names of the original data folder.
DIM_FILES = {"brand": "brands", "menu": "menus", "category": "categories", "item": "items"}


def read_dims(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read the four dimension parquet files from ``path``."""
    return {t: spark.read.parquet(f"{path.rstrip('/')}/{f}.parquet") for t, f in DIM_FILES.items()}


def conform(name: str, df: DataFrame) -> DataFrame:
    """Select and cast a dimension frame to its declared schema."""
    cols = []
    for f in DIM_SCHEMAS[name].fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _ddl_type(t) -> str:
    return t.simpleString().upper()


def create_dim_tables(spark: SparkSession, database: str, location: str | None = None) -> dict[str, str]:
    """CREATE TABLE IF NOT EXISTS for the four dimensions, NOT NULL as declared.

    Key constraints are not accepted by the session catalog and NOT NULL
    is not enforced on parquet tables; ``check_integrity`` checks both.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    names = {}
    for name, schema in DIM_SCHEMAS.items():
        cols = ", ".join(f"{f.name} {_ddl_type(f.dataType)}{'' if f.nullable else ' NOT NULL'}"
                         for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")
        names[name] = f"{database}.{name}"
    return names


def load_dims(spark: SparkSession, dims: dict[str, DataFrame], database: str,
              location: str | None = None) -> dict[str, str]:
    """Create the dimension tables (if needed) and overwrite their rows."""
    names = create_dim_tables(spark, database, location)
    loaded = {}
    for name, table in names.items():
        if name in dims:
            conform(name, dims[name]).write.insertInto(table, overwrite=True)
            loaded[name] = table
    return loaded


def check_integrity(dims: dict[str, DataFrame]) -> DataFrame:
    """Declared constraints as a check job: one row per (table, rule, column).

    Every row of a table gives one fact for its primary key, one for each
    foreign key it has, and one for each required column that is NULL, in
    one pass over the table.  Facts about keys meet in the key's own
    space, (parent table, key): one aggregation there (partial first, so a
    hot key costs a row per task) tells repeated keys and orphans, and a
    second, global one sums them.  Two exchanges, however many rules.
    """
    facts, rules = [], []
    present = [n for n in DIM_SCHEMAS if n in dims]

    def fact(space: str, key, rule: int):
        return F.struct(F.lit(space).alias("space"), key.cast("bigint").alias("key"), F.lit(rule).alias("rule"))

    def rule(table: str, kind: str, column: str) -> int:
        rules.append((table, kind, column))
        return len(rules) - 1

    for name in present:
        df, pk = dims[name], DIM_KEYS[name]["pk"]
        none = F.lit(None)
        own = [F.when(F.col(f.name).isNull(), fact("", none, rule(name, "not_null", f.name)))
               for f in DIM_SCHEMAS[name].fields if not f.nullable and f.name in df.columns]
        own.append(fact(name, F.col(pk), rule(name, "primary_key", pk)))
        own += [F.when(F.col(fk).isNotNull(), fact(parent, F.col(fk), rule(name, "foreign_key", f"{fk}->{parent}")))
                for fk, parent in DIM_KEYS[name]["fk"].items() if parent in dims]
        facts.append(df.select(F.explode(F.filter(F.array(*own), lambda x: x.isNotNull())).alias("f")).select("f.*"))
    per_key = reduce(DataFrame.unionByName, facts).groupBy("space", "key").agg(
        *[F.count(F.when(F.col("rule") == k, 1)).alias(f"r{k}") for k in range(len(rules))])
    is_key = {n: reduce(lambda a, b: a | b, [F.col(f"r{k}") > 0 for k, r in enumerate(rules)
                                             if r[1] == "primary_key" and r[0] == n]) for n in present}
    totals = []
    for k, (name, kind, column) in enumerate(rules):
        n = F.col(f"r{k}")
        if kind == "primary_key":
            bad = F.count(F.when(n > 1, 1))
        elif kind == "foreign_key":
            bad = F.sum(F.when(~is_key[column.split("->")[1]], n).otherwise(0))
        else:
            bad = F.sum(n)
        totals.append(F.coalesce(bad, F.lit(0)).cast("bigint").alias(f"v{k}"))
    rows = [F.struct(F.lit(t).alias("table"), F.lit(kind).alias("rule"), F.lit(c).alias("column"),
                     F.col(f"v{k}").alias("violations")) for k, (t, kind, c) in enumerate(rules)]
    return per_key.agg(*totals).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enrich(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add brand / menu / category / item names along the declared keys.

    Left joins, so rows with unknown keys are kept (names NULL).  Each
    dimension is broadcast only if its estimated size is small; rows with
    a NULL key bypass the join (no hot NULL partition).
    """
    out = df
    for key, dim, col in (("brand_id", "brand", "brand_name"), ("menu_id", "menu", "menu_name"),
                          ("category_id", "category", "category_name"),
                          ("item_id", "item", "item_name")):
        if key in out.columns and dim in dims and col not in out.columns:
            d = dims[dim].select(F.col("id").cast("bigint").alias("_k"), F.col("name").alias(col))
            out = (left_join_nonnull(out.withColumn("_fk", F.col(key).cast("bigint")), d, "_fk", "_k")
                   .drop("_k", "_fk"))
    return out
