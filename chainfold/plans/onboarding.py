"""New accounts join published ones at one common block."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.functions import scalars as X
from chainfold.operators import continuity as N
from chainfold.plans import checkpoint, store
from chainfold.plans.reduction import Source


def require_empty_storage(proofs: DataFrame, accounts: list[str], state_root: str) -> None:
    """Accounts on a short recent interval are complete only if their storage is proven empty."""
    proven = checkpoint.proven_accounts(proofs.where(F.lower("address").isin(accounts)), state_root)
    N.require_none(proven.where(F.col("storage_root") != X.EMPTY_ROOT).select("address"),
                   "new account has storage and needs its whole history")


def join_cohorts(spark: SparkSession, root: str, bundle: dict, proofs: DataFrame, base_id: str, old: list[Source],
                 new: list[Source], recent: bool = True) -> dict:
    """Publish the base's accounts and the new ones together.

    ``old`` continues the base; each source of ``new`` brought its own accounts up to the bundle's
    block. ``recent`` sources start late and must be proven empty; others carry their whole history.
    Readers of the base are not touched.
    """
    base_accounts = store.snapshot_accounts(spark, root, base_id).select("address")
    joining = [a for source in new for a in source.accounts]
    rows = spark.createDataFrame([(a,) for a in joining], "address string")
    N.require_none(rows.join(base_accounts, "address", "left_semi"), "new cohort overlaps the published base")
    if recent:
        require_empty_storage(proofs, joining, bundle["header"]["state_root"])
    return checkpoint.build_checkpoint(spark, root, bundle, proofs, old + new, base_id)
