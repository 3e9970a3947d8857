"""Block and envelope sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from chainfold import schema as S


def read_blocks(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Nested blocks with the declared schema."""
    reader = spark.read.schema(S.BLOCK)
    return reader.option("mode", "FAILFAST").json(path) if form == "json" else reader.format(form).load(path)


def read_envelopes(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Envelopes of an inclusive block range; retried and deleted rows are resolved.

    The range filter comes first, so it reaches the scan. Rows come unordered: order is a property
    of the writer's files and of the reader's own request.
    """
    rows = spark.read.parquet(path)
    if start is not None:
        rows = rows.where(F.col("number") >= start)
    if end is not None:
        rows = rows.where(F.col("number") <= end)
    return resolve_retries(rows) if "_version_" in rows.columns else rows


def newest_versions(rows: DataFrame, keys: tuple[str, ...] = ("number", "hash"), version: str = "_version_",
                    deleted: str = "_deleted_") -> DataFrame:
    """Rows of a replacing table: newest version per key, deleted keys left out.

    The reduction combines on the map side, so many retries of one block stay cheap.
    """
    rest = [c for c in rows.columns if c not in (*keys, version)]
    best = F.max(F.struct(version, *rest)).alias("_best")
    newest = rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])
    return newest.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def resolve_retries(rows: DataFrame, keys: tuple[str, ...] = ("number", "hash"), version: str = "_version_",
                    deleted: str = "_deleted_") -> DataFrame:
    """The same result for wide rows with few retries.

    Only keys and versions are grouped. Keys that need a decision are few, AQE then broadcasts them,
    and the wide rows of all other blocks pass without a shuffle.
    """
    gone = F.coalesce(F.col(deleted), F.lit(False))
    contested = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(gone).alias("_gone")).where("_n > 1 OR _gone")
    clean = rows.join(contested.select(*keys), list(keys), "left_anti").drop(version, deleted)
    settled = newest_versions(rows.join(contested.select(*keys), list(keys), "left_semi"), keys, version, deleted)
    return clean.unionByName(settled)


# ---------------------------------------------------------------- nested arrays

def flat_names(group: str) -> list[str]:
    return [f"{group}.{field.name}" for field in S.GROUPS[group].fields]


def parallel_arrays(envelopes: DataFrame) -> DataFrame:
    """The wire form of an envelope: one array column per nested field."""
    head = [c for c in envelopes.columns if c not in S.GROUPS]
    flat = [F.col(f"`{group}`.`{field.name}`").alias(f"{group}.{field.name}")
            for group in S.GROUPS if group in envelopes.columns for field in S.GROUPS[group].fields]
    return envelopes.select(*head, *flat)


def zip_arrays(rows: DataFrame) -> DataFrame:
    """Parallel arrays back to arrays of structs. Unequal lengths are an error."""
    groups = [g for g in S.GROUPS if all(n in rows.columns for n in flat_names(g))]
    flat = {n for g in groups for n in flat_names(g)}

    def zipped(group: str) -> Column:
        fields = S.GROUPS[group].fields
        columns = [F.col(f"`{n}`") for n in flat_names(group)]
        equal = F.lit(True)
        for column in columns[1:]:
            equal = equal & (F.size(column) == F.size(columns[0]))
        names = [f.name for f in fields]
        plain = F.transform(F.arrays_zip(*[c.alias(n) for c, n in zip(columns, names)]), lambda z: F.struct(
            *[z[n].alias(n) for n in names]))
        typed = plain.cast(ArrayType(StructType([StructField(f.name, f.dataType) for f in fields])))
        return F.when(equal, typed).otherwise(F.raise_error(F.lit(f"malformed nested arrays: {group}"))).alias(group)

    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in flat], *[zipped(g) for g in groups])


def unnest(envelopes: DataFrame, group: str, keep: list[str] = ("number",)) -> DataFrame:
    """One row per array element. Only the named columns are read."""
    return envelopes.select(*keep, F.inline(group))
