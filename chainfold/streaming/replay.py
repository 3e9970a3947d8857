"""Chunked replay: every micro-batch is folded into the state reached so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from chainfold.operators import continuity as N, latest as L
from chainfold.plans import compaction
from chainfold.sources import folders
from chainfold.streaming import follow as W, tiers


def _rivals(spark: SparkSession, stored: DataFrame, history: str, upto: int) -> DataFrame:
    """Stored blocks up to the folded one whose hash is not the hash that was folded."""
    folded = spark.read.parquet(f"{history}/folded/*").select("number", F.col("hash").alias("folded_hash"))
    return stored.where(F.col("number") <= upto).select("number", "hash").join(folded, "number").where("hash <> folded_hash")


def fold_stored(spark: SparkSession, history: str, prefix: str, accounts: list[str], start: int, drop_history: bool) -> None:
    """Fold what the history shows, up to its first gap, then drop the chunks that are folded whole.

    A block behind a gap waits for the missing one. A block that comes again must be the one that was folded. The
    hashes of a fold are written before it, and all folders are named by its end, so every step may be repeated.
    """
    from chainfold.plans import store
    stored = W.read_envelope_table(spark, history)
    done = store.current_generation(spark, prefix)
    low = start
    if done:
        low = done["header"]["number"] + 1
        N.require_none(_rivals(spark, stored, history, low - 1), "a folded block came again with another hash")
    end = stored.agg(F.max("number")).first()[0]
    if end is None or end < low:
        return
    gap = N.interval_defects(stored, low, end).where("reason = 'missing block'").agg(F.min("number")).first()[0]
    end = end if gap is None else gap - 1
    if end < low:
        return
    name = f"to-{end:020d}"
    stored.where(F.col("number").between(low, end)).select("number", "hash").write.mode("overwrite").parquet(f"{history}/folded/{name}")
    compaction.compact(spark, prefix, stored, accounts, start, end, generation=name)
    if not drop_history:
        return
    tops = (spark.read.option("basePath", history).parquet(f"{history}/batch=*").groupBy(F.col("batch").cast("bigint").alias("batch"))
            .agg(F.max("number").alias("top")).orderBy("batch").collect())          # one row per chunk that is still there
    for chunk in tops[:-1]:                      # the newest chunk stays for the next link
        if chunk["top"] <= end:
            folders.delete(spark, f"{history}/batch={chunk['batch']}")


def replay(spark: SparkSession, blocks: DataFrame, history: str, prefix: str, checkpoint: str, accounts: list[str],
           start: int, stop: int | None = None, drop_history: bool = True) -> StreamingQuery:
    """Replay a stream in chunks (one per micro-batch) and keep only the folded prefix and what is not yet folded.

    Every block that arrives is stored. Those not final yet, or at or beyond ``stop``, are folded by a later chunk
    or by a later call that asks for more, also on the same checkpoint.
    """
    W.ask(spark, history, start, stop)
    rest = (spark, history, prefix, accounts, start, drop_history)
    if folders.partition_values(spark, history, "batch"):
        fold_stored(*rest)

    def fold(batch: DataFrame, batch_id: int) -> None:
        W.append_envelopes(batch, history, batch_id)
        fold_stored(*rest)
    return (blocks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fold)
            .trigger(availableNow=True).start())


def _merge(tables: tiers.Tables) -> tiers.Tables:
    newest = L.latest_resets(tables["resets"]).select("reset.number", "reset.ordinal", "address")
    return {"slots": L.latest_slots(tables["slots"]), "resets": newest}


def fold_changes(spark: SparkSession, changes: DataFrame, resets_of: str, path: str, checkpoint: str,
                 merge_every: int = tiers.MERGE_EVERY) -> DataFrame:
    """Fold a flat change stream(number, ordinal, address, slot, value, kind) and return its state.

    Positions stay in the rows, so a change that arrives late cannot win.
    """
    def fold(batch: DataFrame, batch_id: int) -> None:
        cuts = batch.where(F.col("kind") == resets_of).select("number", "ordinal", "address")
        rows = batch.where(F.col("kind") != resets_of).select("number", "ordinal", "address", "slot", "value")
        tiers.append(spark, path, batch_id, _merge({"slots": rows, "resets": cuts}), _merge, merge_every)

    (changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fold)
     .trigger(availableNow=True).start().awaitTermination())
    found = tiers.state(spark, path, ["slots", "resets"], _merge)
    if found is None:
        raise LookupError("the stream held no changes")
    return L.nonzero(L.after_resets(found["slots"], found["resets"]))
