"""Build, verify and publish immutable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold import schema as S
from chainfold.functions import scalars as X
from chainfold.functions.keccak import keccak256
from chainfold.operators import continuity as N, digest as D, latest as L, proofs as V, trie
from chainfold.plans import reduction, store
from chainfold.plans.reduction import Source
from chainfold.session import cut

TRUST = ("provider-finalized-header", "operator-pinned-hash")


def check_header(spark: SparkSession, bundle: dict) -> None:
    """Identity of the target block: chain, trust source, and the encoded header when given."""
    header = bundle["header"]
    if bundle.get("format_version") != 1:
        raise ValueError("unknown proof bundle format")
    if bundle.get("header_trust") not in TRUST:
        raise ValueError("unknown header_trust")
    if not bundle.get("header_rlp"):
        if bundle["header_trust"] == "operator-pinned-hash":
            raise ValueError("operator-pinned headers need header_rlp")
        return
    row = spark.createDataFrame(
        [(header["number"], header["hash"], header["parent_hash"], header["state_root"], header["timestamp"],
          bundle["header_rlp"])],
        "number bigint, hash string, parent_hash string, state_root string, timestamp bigint, header_rlp string")
    N.require_none(V.audit_headers(row).where("error IS NOT NULL"), "header is invalid")


def proven_accounts(proofs: DataFrame, state_root: str) -> DataFrame:
    """Accounts whose proof holds; any failing proof stops the build. Proofs are walked once."""
    audited = cut(V.audit_proofs(proofs.select(
        "address", "proof_address", "nonce", "balance", "storageHash", "codeHash", "accountProof"), state_root))
    N.require_none(audited.where("error IS NOT NULL"), "account proof fails")
    return audited.drop("error")


def check_cohorts(spark: SparkSession, sources: list[Source], proofs: DataFrame, base: dict | None,
                  base_accounts: DataFrame | None, header: dict) -> None:
    rows = [(s.name, a, s.start_block) for s in sources for a in s.accounts]
    cohorts = spark.createDataFrame(rows, "cohort string, address string, start_block bigint")
    N.require_none(N.cohort_overlap(cohorts), "an account has two sources")
    selected = proofs.select(F.lower("address").alias("address"))
    N.require_none(N.coverage_defects(selected, cohorts), "sources and proofs name different accounts")
    if base is None:
        return
    if header["number"] <= base["header"]["number"]:
        raise ValueError("the base is not older than the header")
    N.require_none(base_accounts.select("address").join(selected, "address", "left_anti"),
                   "accounts of the base have no proof")
    known = {r["cohort"] for r in cohorts.join(base_accounts.select("address"), "address", "left_semi")
             .select("cohort").distinct().collect()}          # one row per cohort
    for source in sources:
        if source.name in known:
            if source.start_block != base["header"]["number"] + 1:
                raise ValueError("a source of known accounts starts elsewhere than behind the base")
            source.parent_hash = base["header"]["hash"]


def build_checkpoint(spark: SparkSession, root: str, bundle: dict, proofs: DataFrame, sources: list[Source],
                     base_id: str | None = None, after_accounts=None) -> dict:
    """Reduce all sources to the bundle's block, prove every account, then publish.

    ``proofs`` has one row per account: address, proof_address, nonce, balance, storageHash, codeHash,
    accountProof, code. Nothing is visible before the manifest row; ``after_accounts`` runs just
    before it is written.
    """
    header = bundle["header"]
    end = header["number"]
    check_header(spark, bundle)
    base = store.manifest(spark, root, base_id) if base_id else None
    base_accounts = store.snapshot_accounts(spark, root, base_id) if base_id else None
    check_cohorts(spark, sources, proofs, base, base_accounts, header)
    for source in sources:
        reduction.check_interval(source, header)
    snapshot_id = store.new_id()
    folded = (store.snapshot_storage(spark, root, base_id), base["header"]["number"]) if base_id else None
    store.write_sorted(reduction.reduced_storage(sources, end, folded),
                       store.part(root, store.STORAGE, "snapshot_id", snapshot_id))
    storage = store.snapshot_storage(spark, root, snapshot_id)

    proven = proven_accounts(proofs, header["state_root"])
    observed = cut(reduction.observed_fields(sources, end, base_accounts))
    N.require_none(observed.select("address").join(proven.select("address"), "address", "left_anti"),
                   "fields of accounts outside the filter")
    evidence = proofs.select(F.lower("address").alias("address"), "code")
    claimed = proven.join(evidence, "address")
    filled = L.fill_from_proof(observed, claimed)
    N.require_none(filled.where(F.size("mismatched") > 0).select("address", "mismatched"),
                   "observed fields differ from proven fields")
    account_path = store.part(root, store.ACCOUNTS, "snapshot_id", snapshot_id)
    rows = (claimed.select("address", "exists", "storage_root").join(filled.drop("mismatched"), "address")
            .join(trie.account_roots(proven, storage).withColumnRenamed("storage_root", "computed_root"), "address"))
    (rows.select(*[f.name for f in S.CHECKPOINT_ACCOUNT.fields], "computed_root")
     .repartitionByRange("address").sortWithinPartitions("address").write.mode("errorifexists").parquet(account_path))
    stored = spark.read.parquet(account_path)
    verify_rows(stored, storage)
    if after_accounts:
        after_accounts()
    totals = D.state_digest(storage).first()
    accounts = store.snapshot_accounts(spark, root, snapshot_id)
    known = D.account_digest(accounts).first()
    record = {"format_version": 1, "snapshot_id": snapshot_id, "status": "ready", "header": header,
              "chain_id": bundle.get("chain_id"), "header_trust": bundle["header_trust"],
              "header_rlp": bundle.get("header_rlp"), "base_snapshot": base_id,
              "sources": [{"name": s.name, "start_block": s.start_block, "accounts": len(s.accounts)} for s in sources],
              "state_sha256": totals["state_sha256"], "nonzero_slots": totals["nonzero_slots"],
              "accounts_sha256": known["accounts_sha256"], "account_count": known["rows"], "created_at": store.now_ns()}
    store.write_index(spark, root, snapshot_id)
    publish(spark, root, record)
    return record


def publish(spark: SparkSession, root: str, record: dict) -> None:
    """The manifest row is the readiness signal, so it comes last."""
    store.write_row(spark, store.part(root, store.MANIFESTS, "snapshot_id", record["snapshot_id"]),
                    (record["snapshot_id"], record["header"]["number"], record["header"]["hash"], record["created_at"],
                     store.canonical(record)), store.MANIFEST)


def verify_rows(accounts: DataFrame, storage: DataFrame) -> None:
    """Roots, code and coverage of stored rows; accounts carry the root computed from storage."""
    code_hash = X.hex_text(keccak256(X.to_bytes("code")))
    wrong = accounts.select("address", F.array_compact(F.array(
        F.when(~F.col("computed_root").eqNullSafe(F.col("storage_root")), F.lit("storage root mismatch")),
        F.when(~code_hash.eqNullSafe(F.col("code_hash")), F.lit("bytecode does not match code hash")),
        F.when(~X.is_exact_decimal("balance"), F.lit("balance is not exact")),
        F.when(F.col("nonce").isNull(), F.lit("nonce is missing")))).alias("problems"))
    N.require_none(wrong.where(F.size("problems") > 0), "account does not verify")
    N.require_none(storage.select("address").distinct().join(accounts.select("address"), "address", "left_anti"),
                   "storage of accounts without a proof")
    total, counted = storage.count(), accounts.agg(F.coalesce(F.sum("nonzero_slots"), F.lit(0))).first()[0]
    if total != counted:
        raise ValueError("checkpoint slot total differs from its verified accounts")


def verify_stored(spark: SparkSession, root: str, snapshot_id: str, record: dict, proofs: DataFrame) -> None:
    """Prove stored rows again from nothing but the record and the proofs."""
    storage = store.snapshot_storage(spark, root, snapshot_id)
    accounts = store.snapshot_accounts(spark, root, snapshot_id)
    verify_state(storage, accounts, record, proofs)


def verify_state(storage: DataFrame, accounts: DataFrame, record: dict, proofs: DataFrame) -> None:
    N.require_none(N.coverage_defects(proofs.select(F.lower("address").alias("address")), accounts.select("address")),
                   "account coverage differs from proofs")
    N.require_none(accounts.groupBy("address").count().where("count > 1"), "doubled account")
    proven = proven_accounts(proofs, record["header"]["state_root"])
    names = ["exists", "nonce", "balance", "storage_root", "code_hash"]
    a, p = accounts.alias("a"), proven.alias("p")
    wrong = a.join(p, "address").select("address", F.array_compact(F.array(*[
        F.when(~F.col(f"a.{n}").eqNullSafe(F.col(f"p.{n}")), F.lit(n)) for n in names])).alias("fields"))
    N.require_none(wrong.where(F.size("fields") > 0), "stored account differs from its proof")
    roots = trie.account_roots(accounts, storage).select("address", F.col("storage_root").alias("computed_root"),
                                                         F.col("nonzero_slots").alias("counted"))
    checked = cut(accounts.join(roots, "address"))
    N.require_none(checked.where("counted <> nonzero_slots").select("address", "counted", "nonzero_slots"),
                   "account slot count differs")
    verify_rows(checked, storage)
    totals, known = D.state_digest(storage).first(), D.account_digest(accounts).first()
    if (totals["state_sha256"], totals["nonzero_slots"], known["accounts_sha256"], known["rows"]) != (
            record["state_sha256"], record["nonzero_slots"], record["accounts_sha256"], record["account_count"]):
        raise ValueError("rows read back are not the rows verified")
