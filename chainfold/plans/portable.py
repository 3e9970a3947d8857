"""Portable export of a checkpoint, its audit, and restore.

An export is a folder: ``pages`` (gzip JSON lines; a page holds slots of one account and lies in one file, a file
holds up to PAGES_PER_FILE pages in order), ``accounts``, ``proofs``, ``page_facts``, ``files`` and, last, ``manifest``.
The number of folders does not depend on the number of pages.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from chainfold import schema as S
from chainfold.functions import scalars as X
from chainfold.operators import continuity as N, paging as G, quality as Q
from chainfold.operators.ordered import running_total
from chainfold.plans import checkpoint, store
from chainfold.sources import files, folders

FORMAT = "chainfold-checkpoint-v2"
PAGES_PER_FILE = 1_000
ACCOUNT_LINE = ("address string, exists boolean, nonce string, balance string, code_hash string, code string, "
                "storage_root string, nonzero_slots bigint")
FACT_LINE = "page bigint, address string, account_page bigint, rows bigint, first_slot string, last_slot string"
FILE_LINE = "file string, bytes bigint, sha256 string, first_page bigint, last_page bigint"
PROOF_LINE = ("address string, proof_address string, nonce string, balance string, storageHash string, "
              "codeHash string, accountProof array<string>, code string")


def account_lines(accounts: DataFrame) -> DataFrame:
    """Exactly the eight exported fields; the nonce is exact decimal text."""
    return accounts.select(*[F.col(n).cast("string").alias(n) if n == "nonce" else F.col(n)
                             for n in S.EXPORT_ACCOUNT_FIELDS])


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _borders(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))


def global_pages(storage: DataFrame, page_size: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a page number over all accounts, and the page facts, of files stored in (account, slot) order."""
    pages = G.stored_pages(storage, page_size)        # by position in the checkpoint's own sorted files
    facts = G.page_facts(pages).withColumnRenamed("page", "account_page")
    # One row per account decides where its pages start.
    sizes = facts.groupBy("address").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    first = running_total(sizes, ["all"], ["address"], "n", "upto").select(
        "address", (F.col("upto") - F.col("n")).alias("first_page"))
    numbered = facts.join(first, "address").withColumn("page", F.col("first_page") + F.col("account_page")).drop("first_page")
    rows = (pages.withColumnRenamed("page", "account_page").join(first, "address")
            .select((F.col("first_page") + F.col("account_page")).alias("page"), "address", "slot", "value"))
    return rows, numbered


def export_checkpoint(spark: SparkSession, root: str, snapshot_id: str, path: str, proofs: DataFrame,
                      page_size: int = 10_000) -> dict:
    """Write the export, check it as a stranger would, then write its manifest."""
    record = store.manifest(spark, root, snapshot_id)
    if not record.get("header_rlp"):
        raise ValueError("cannot export a checkpoint without header_rlp")
    if folders.exists(spark, path):
        raise FileExistsError(path)
    rows, facts = global_pages(store.snapshot_storage(spark, root, snapshot_id), page_size)
    facts.select(*_names(FACT_LINE)).write.json(f"{path}/page_facts")
    pages = files.json_rows(spark, f"{path}/page_facts", FACT_LINE).count()
    # Each file's pages meet in one task; no sampling pass, and a task that runs again writes the same file.
    (rows.repartitionById(max(1, -(-pages // PAGES_PER_FILE)), F.floor(F.col("page") / PAGES_PER_FILE).cast("int"))
     .sortWithinPartitions("page", "slot").select("page", "address", "slot", "value").write
     .option("compression", "gzip").json(f"{path}/pages"))
    account_lines(store.snapshot_accounts(spark, root, snapshot_id)).write.json(f"{path}/accounts")
    proofs.select(*_names(PROOF_LINE)).write.json(f"{path}/proofs")
    files.file_facts(spark, f"{path}/pages").join(_borders(page_table(spark, path)), "file", "left").select(
        *_names(FILE_LINE)).write.json(f"{path}/files")
    layout = {"format": FORMAT, "status": "ready", "page_size": page_size, "checkpoint": record}
    result = verify_layout(spark, path, layout)
    spark.createDataFrame([(store.canonical(layout),)], "manifest string").coalesce(1).write.text(f"{path}/manifest")
    return result


def read_layout(spark: SparkSession, path: str) -> dict:
    if not folders.written(spark, f"{path}/manifest"):
        raise ValueError("no manifest: the export was not finished")
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])


def page_table(spark: SparkSession, path: str) -> DataFrame:
    return files.page_lines(spark, f"{path}/pages")


def layout_violations(spark: SparkSession, path: str) -> DataFrame:
    """Everything wrong with the files themselves: (page, reason)."""
    lines = page_table(spark, path)
    facts = files.json_rows(spark, f"{path}/page_facts", FACT_LINE)
    bad_rows = lines.select("page", files.page_problem().alias("reason")).where("reason IS NOT NULL").distinct()
    rows = files.page_rows(lines)
    found = rows.groupBy("page").agg(
        F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"),
        F.min("address").alias("a"), F.max("address").alias("b"), F.min("file").alias("in"), F.max("file").alias("also_in"))
    declared = facts.alias("f").join(found.alias("g"), "page", "full")
    checks = [
        ("unlisted page", F.col("f.rows").isNull()), ("missing page", F.col("g.n").isNull()),
        ("row count", F.col("f.rows") != F.col("g.n")),
        ("page border", (F.col("f.first_slot") != F.col("g.low")) | (F.col("f.last_slot") != F.col("g.high"))),
        ("page in several files", F.col("g.in") != F.col("g.also_in")),
        ("mixed or foreign account", (F.col("g.a") != F.col("g.b")) | (F.col("f.address") != F.col("g.a")))]
    wrong = declared.select("page", F.array_compact(F.array(*[F.when(c, F.lit(t)) for t, c in checks])).alias("r")).select(
        "page", F.explode("r").alias("reason"))
    twice = Q.duplicate_keys(rows, ["page", "address", "slot"]).select("page", F.lit("doubled slot").alias("reason"))
    # A page lies in one file, so position in the file is order within the page.
    inside = rows.withColumn("place", F.monotonically_increasing_id())
    unordered = Q.order_violations(inside, ["page"], ["place"], "slot").select(
        "page", F.lit("unordered slots").alias("reason")).distinct()
    f = files.json_rows(spark, f"{path}/files", FILE_LINE).alias("f")
    k = files.file_facts(spark, f"{path}/pages").join(_borders(lines), "file", "left").alias("k")
    altered = f.join(k, "file", "full").select(
        F.coalesce("f.first_page", "k.first_page").alias("page"), F.explode(F.array_compact(F.array(
            F.when(F.expr("NOT (f.bytes <=> k.bytes AND f.sha256 <=> k.sha256)"), F.lit("file size or checksum")),
            F.when(F.expr("NOT (f.first_page <=> k.first_page AND f.last_page <=> k.last_page)"), F.lit("pages of a file"))))).alias("reason"))
    gaps = N.interval_defects(
        facts.select(F.col("page").alias("number"), F.lit("").alias("hash"), F.lit("").alias("parent_hash")), 0,
        max((facts.agg(F.max("page")).first()[0] or 0), 0)).select(
        F.col("number").alias("page"), F.lit("page sequence").alias("reason"))
    if facts.isEmpty():
        gaps = gaps.limit(0)
    return bad_rows.unionByName(wrong).unionByName(twice).unionByName(unordered).unionByName(altered).unionByName(gaps)


def account_violations(spark: SparkSession, path: str) -> DataFrame:
    """Account lines must hold exactly the eight fields, an exact nonce and a boolean."""
    raw = spark.read.text(f"{path}/accounts")
    keys = F.json_object_keys("value")
    wrong = F.when(keys.isNull() | (F.array_sort(keys) != F.array(*[F.lit(n) for n in sorted(S.EXPORT_ACCOUNT_FIELDS)])),
                   "unexpected fields").when(
        ~X.is_exact_uint64(F.get_json_object("value", "$.nonce")), "nonce is not exact").when(
        ~F.get_json_object("value", "$.exists").isin("true", "false"), "exists is not boolean")
    return raw.select(F.get_json_object("value", "$.address").alias("address"), wrong.alias("reason")).where(
        "reason IS NOT NULL")


def exported_accounts(spark: SparkSession, path: str) -> DataFrame:
    return files.json_rows(spark, f"{path}/accounts", ACCOUNT_LINE).withColumn("nonce", F.col("nonce").cast(S.UINT64))


def exported_proofs(spark: SparkSession, path: str) -> DataFrame:
    return files.json_rows(spark, f"{path}/proofs", PROOF_LINE)


def exported_storage(spark: SparkSession, path: str) -> DataFrame:
    return files.page_rows(page_table(spark, path)).select("address", "slot", "value")


def verify_layout(spark: SparkSession, path: str, layout: dict, expected_hash: str | None = None) -> dict:
    if layout.get("format") != FORMAT or layout.get("status") != "ready":
        raise ValueError("unknown export format or status")
    record = layout["checkpoint"]
    if record.get("status") != "ready" or record.get("format_version") != 1:
        raise ValueError("unknown record in the export")
    if expected_hash is not None and record["header"]["hash"] != expected_hash:
        raise ValueError("export is of another block")
    checkpoint.check_header(spark, record)
    N.require_none(layout_violations(spark, path), "export layout")
    N.require_none(account_violations(spark, path), "exported accounts")
    facts = files.json_rows(spark, f"{path}/page_facts", FACT_LINE)
    accounts = exported_accounts(spark, path)
    N.require_none(G.coverage_defects(
        facts.select("address", F.col("account_page").alias("page"), "rows", "first_slot", "last_slot"),
        accounts, layout["page_size"]), "export pages do not cover the accounts")
    checkpoint.verify_state(exported_storage(spark, path), accounts, record, exported_proofs(spark, path))
    return {"snapshot_id": record["snapshot_id"], "header": record["header"], "nonzero_slots": record["nonzero_slots"],
            "state_sha256": record["state_sha256"], "pages": facts.count()}


def verify_export(spark: SparkSession, path: str, expected_hash: str | None = None) -> dict:
    return verify_layout(spark, path, read_layout(spark, path), expected_hash)


def import_checkpoint(spark: SparkSession, root: str, path: str, expected_hash: str | None = None) -> dict:
    """Restore under a new id: verify the export, write, prove the stored rows, then publish."""
    layout = read_layout(spark, path)
    verify_layout(spark, path, layout, expected_hash)
    source = layout["checkpoint"]
    snapshot_id = store.new_id()
    store.write_sorted(exported_storage(spark, path), store.part(root, store.STORAGE, "snapshot_id", snapshot_id))
    (exported_accounts(spark, path).repartitionByRange("address").sortWithinPartitions("address")
     .write.mode("errorifexists").parquet(store.part(root, store.ACCOUNTS, "snapshot_id", snapshot_id)))
    record = {**source, "snapshot_id": snapshot_id, "restored_from": source["snapshot_id"], "created_at": store.now_ns()}
    checkpoint.verify_stored(spark, root, snapshot_id, record, exported_proofs(spark, path))
    store.write_index(spark, root, snapshot_id)
    checkpoint.publish(spark, root, record)
    return record
