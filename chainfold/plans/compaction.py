"""Fold history into a private generation and drop what it covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.functions import scalars as X
from chainfold.operators import continuity as N, digest as D, quality as Q, retention as R
from chainfold.plans import reduction, store
from chainfold.plans.reduction import Source
from chainfold.sources import folders


def load_source(spark: SparkSession, name: str, folder: str, envelopes: DataFrame, accounts: list[str],
                start_block: int) -> Source:
    """A source together with its newest private generation, if any."""
    prefix = store.current_generation(spark, folder)
    source = Source(name, envelopes, accounts, start_block)
    if prefix is not None:
        if prefix["accounts"] != accounts:
            raise ValueError("folded prefix belongs to another source")
        source.prefix = {"start_block": prefix["start_block"], **prefix["header"]}
        source.prefix_storage = store.generation_storage(spark, folder, prefix["generation"])
        source.prefix_fields = store.generation_fields(spark, folder, prefix["generation"])
    return source


def measure(storage: DataFrame, fields: DataFrame, accounts: DataFrame) -> dict:
    """Digest and count of a prefix. Foreign accounts, doubled keys, bad words and zeros fail."""
    N.require_none(Q.duplicate_keys(storage, ["address", "slot"]), "doubled keys")
    words = {"slot": X.is_fixed_hex("slot", 32), "value": X.is_fixed_hex("value", 32) & (F.col("value") != X.ZERO_WORD)}
    N.require_none(Q.violations(storage, ["address", "slot"], words), "noncanonical slots")
    inside = storage.select("address").unionByName(fields.select("address")).distinct()
    N.require_none(inside.join(accounts, "address", "left_anti"), "state outside the account filter")
    state, known = D.state_digest(storage).first(), D.account_digest(fields).first()
    return {"state_sha256": state["state_sha256"], "nonzero_slots": state["nonzero_slots"],
            "fields_sha256": known["accounts_sha256"]}


def account_table(spark: SparkSession, accounts: list[str]) -> DataFrame:
    return spark.createDataFrame([(a,) for a in accounts], "address string")


def compact(spark: SparkSession, folder: str, envelopes: DataFrame, accounts: list[str], start_block: int,
            end_block: int | None = None, generation: str | None = None, published: DataFrame | None = None) -> dict:
    """Fold all blocks up to ``end_block`` (default: the newest) into a new generation.

    Candidate data is written and measured as stored, then the manifest follows, then older generations
    go. A repeated call for the same block changes nothing.
    """
    chosen = account_table(spark, accounts)
    if published is not None:
        N.require_none(R.already_published(chosen, published), "accounts already have a checkpoint")
    end = end_block if end_block is not None else envelopes.agg(F.max("number")).first()[0]
    if end is None or end < start_block:
        raise ValueError("compaction end must lie within the stored blocks")
    source = load_source(spark, "compaction", folder, envelopes, accounts, start_block)
    if source.prefix and source.prefix["number"] == end:
        return {**store.current_generation(spark, folder), "already_compacted": True}
    if source.prefix and source.prefix["number"] > end:
        raise ValueError("compaction end lies behind the folded prefix")
    last = envelopes.where(F.col("number") == end).select(
        "number", "hash", "parent_hash", "state_root", "timestamp").limit(2).collect()
    if len(last) != 1:
        raise ValueError(f"block {end} is missing or conflicting")
    header = last[0].asDict()
    reduction.check_interval(source, header)
    name = generation or store.new_id()
    storage_path = store.part(folder, store.PREFIX_STORAGE, "generation", name)
    fields_path = store.part(folder, store.PREFIX_FIELDS, "generation", name)
    for leftover in (storage_path, fields_path):      # of an attempt that never got its manifest
        folders.delete(spark, leftover)
    store.write_sorted(reduction.reduced_storage([source], end), storage_path)
    (reduction.observed_fields([source], end).repartitionByRange("address").sortWithinPartitions("address")
     .write.mode("errorifexists").parquet(fields_path))
    measured = measure(store.generation_storage(spark, folder, name), store.generation_fields(spark, folder, name), chosen)
    record = {"format_version": 1, "status": "unverified-prefix", "generation": name, "start_block": start_block,
              "header": header, "accounts": accounts, **measured}
    store.write_row(spark, store.part(folder, store.GENERATIONS, "generation", name),
                    (name, end, store.canonical(record)), store.GENERATION)
    drop_old_generations(spark, folder)
    return record


def audit_prefix(spark: SparkSession, folder: str) -> dict | None:
    """Measure the newest generation again and compare with its manifest."""
    record = store.current_generation(spark, folder)
    if record is None:
        return None
    if record["status"] != "unverified-prefix" or record["header"]["number"] < record["start_block"]:
        raise ValueError("folded prefix is corrupt")
    measured = measure(store.generation_storage(spark, folder, record["generation"]),
                       store.generation_fields(spark, folder, record["generation"]),
                       account_table(spark, record["accounts"]))
    for key, value in measured.items():
        if record[key] != value:
            raise ValueError(f"folded prefix differs from its manifest: {key}")
    return record


def drop_old_generations(spark: SparkSession, folder: str) -> list[str]:
    """Remove every generation but the newest, manifest first."""
    current = store.current_generation(spark, folder)
    keep = current["generation"] if current else None
    tables = (store.GENERATIONS, store.PREFIX_FIELDS, store.PREFIX_STORAGE)
    old = sorted({v for t in tables for v in folders.partition_values(spark, f"{folder}/{t}", "generation")} - {keep})
    for name in old:
        for table in tables:
            folders.delete(spark, store.part(folder, table, "generation", name))
    return old


def growth_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, files and bytes of the stored generations, the newest marked active."""
    from chainfold.operators.telemetry import size_report
    current = store.current_generation(spark, folder)
    files = (spark.read.option("basePath", f"{folder}/{store.PREFIX_STORAGE}")
             .schema("address string, generation string").parquet(f"{folder}/{store.PREFIX_STORAGE}"))
    return size_report(files, ["generation"]).withColumn(
        "active", F.col("generation") == F.lit(current["generation"] if current else None))


def isolated_copy(spark: SparkSession, folder: str, target: str, envelopes: DataFrame | None = None,
                  end: int | None = None) -> dict:
    """Copy the newest generation elsewhere, with the blocks behind it up to ``end``, and measure the copy."""
    record = store.current_generation(spark, folder)
    if record is None:
        raise LookupError("nothing to copy")
    name = record["generation"]
    store.write_sorted(store.generation_storage(spark, folder, name),
                       store.part(target, store.PREFIX_STORAGE, "generation", name))
    store.generation_fields(spark, folder, name).write.parquet(
        store.part(target, store.PREFIX_FIELDS, "generation", name))
    measured = measure(store.generation_storage(spark, target, name), store.generation_fields(spark, target, name),
                       account_table(spark, record["accounts"]))
    if any(record[k] != v for k, v in measured.items()):
        raise ValueError("copy differs from its source")
    store.write_row(spark, store.part(target, store.GENERATIONS, "generation", name),
                    (name, record["header"]["number"], store.canonical(record)), store.GENERATION)
    if envelopes is not None:
        behind = envelopes.where(F.col("number") > record["header"]["number"])
        (behind if end is None else behind.where(F.col("number") <= end)).write.parquet(f"{target}/blocks")
    return measured
