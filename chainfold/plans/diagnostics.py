"""Verdicts on current-state tables and comparisons of two computations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold.operators import continuity as N, digest as D, latest as L, proofs as V, quality as Q, trie
from chainfold.plans import checkpoint
from chainfold.plans.reduction import Source, check_interval, observed_fields, reduced_storage


def read_current(spark: SparkSession, folder: str) -> tuple[dict, DataFrame, DataFrame]:
    """Head, accounts and storage of one stored batch."""
    from chainfold.streaming.current import read_current as read
    tables = read(spark, folder)
    return tables["head"].first().asDict(), tables["accounts"], tables["storage"]


def verify_current_state(spark: SparkSession, head: dict, accounts: DataFrame, storage: DataFrame, proofs: DataFrame,
                         complete: bool, reference: DataFrame | None = None) -> dict:
    """Complete: every root is rebuilt. Otherwise only the given slots are compared with a second source."""
    N.require_none(Q.snapshot_violations(head, accounts, storage), "current state is not usable")
    N.require_none(N.coverage_defects(proofs.select(F.lower("address").alias("address")), accounts.select("address")),
                   "account coverage differs from proofs")
    proven = checkpoint.proven_accounts(proofs, head["state_root"])
    N.require_none(V.metadata_mismatches(accounts, proven), "account metadata differs")
    if complete:
        nonzero = L.nonzero(storage)
        roots = trie.account_roots(accounts, nonzero).withColumnRenamed("storage_root", "computed")
        wrong = roots.join(proven.select("address", "storage_root"), "address").where("computed <> storage_root")
        N.require_none(wrong.select("address"), "storage root mismatch")
        return {"status": "roots match", "storage_slots_checked": nonzero.count(), "published_checkpoint": False}
    if reference is None:
        raise ValueError("sampled verification needs a second source")
    verdict = Q.sample_verdict(storage, reference).first()
    if verdict["mismatches"]:
        raise ValueError("sampled slots differ")
    return {"status": verdict["status"], "storage_slots_checked": verdict["slots_checked"], "published_checkpoint": False}


def compare_states(left: DataFrame, right: DataFrame) -> dict:
    """Digest and count of two computations of the same state."""
    same = D.same_rows(left, right, ["address", "slot", "value"]).first()
    a, b = D.state_digest(left).first(), D.state_digest(right).first()
    return {"equal": same["equal"] and a == b, "left": a.asDict(), "right": b.asDict()}


def update_parity(source: Source, header: dict, expected_fields: DataFrame, expected_storage: DataFrame) -> dict:
    """Observed fields and slots of an interval against a second source of the same block."""
    check_interval(source, header)
    observed = observed_fields([source], header["number"])
    N.require_none(Q.field_differences(observed, expected_fields, ["balance", "nonce", "code_hash", "code"]),
                   "observed fields differ")
    state = reduced_storage([source], header["number"])
    N.require_none(Q.state_differences(state, expected_storage), "storage differs")
    return {"accounts": observed.count(), **D.state_digest(state).first().asDict()}
