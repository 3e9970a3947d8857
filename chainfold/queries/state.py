"""Reconstruction, overlays, digests and comparisons over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.operators import as_of as A, block_end as E, current_state as C, digest as D, latest as L, quality as Q
from chainfold.queries.base import (EV, LATEST, ZERO, changes, events, query, resets, sql_address,
                                    sql_word, table)

STATE = f"WITH {EV}, {LATEST}"
NONZERO = f"{STATE}, nz AS (SELECT * FROM st WHERE value <> '{ZERO}')"


def state(spark, d):
    return L.reduce_state(changes(spark, d), resets(spark, d)).select("address", "slot", "value")


@query("latest_nonzero_state", f"WITH {EV} SELECT address, slot, arg_max(value, (number, ordinal)) AS value FROM ch "
       f"GROUP BY address, slot HAVING arg_max(value, (number, ordinal)) <> '{ZERO}'")
def latest_nonzero_state(spark, d):
    return L.reduce_state(changes(spark, d), None).select("address", "slot", "value")


@query("state_after_resets", f"{STATE} SELECT * FROM st WHERE value <> '{ZERO}'")
def state_after_resets(spark, d):
    return state(spark, d)


@query("reset_positions", f"WITH {EV} SELECT address, max((number, ordinal))[1] AS number, "
       "max((number, ordinal))[2] AS ordinal, count(*) AS reset_count FROM rs GROUP BY address")
def reset_positions(spark, d):
    return L.latest_resets(resets(spark, d)).select("address", "reset.number", "reset.ordinal", "reset_count")


def block_at(spark, d, day: str) -> int:
    """Last block at a moment: one number from one small aggregate."""
    return events(spark, d).where(F.col("ts") < F.lit(day).cast("timestamp_ntz")).agg(F.max("number")).first()[0]


AT = "(SELECT max(number) FROM ev WHERE ts < TIMESTAMP '2024-01-21')"


@query("state_as_of_block", f"""WITH {EV.replace(
    "WHERE event_type <> 'signup'", "WHERE event_type <> 'signup' AND number <= " + AT).replace(
    "WHERE event_type = 'signup'", "WHERE event_type = 'signup' AND number <= " + AT)}, {LATEST}
    SELECT * FROM st WHERE value <> '{ZERO}'""")
def state_as_of_block(spark, d):
    end = block_at(spark, d, "2024-01-21")
    return L.state_as_of(changes(spark, d, end), resets(spark, d, end), end).select("address", "slot", "value")


DAYS = ["2024-01-11", "2024-01-21", "2024-01-31"]


@query("state_as_of_blocks", f"""WITH {EV},
t AS (SELECT max(number) AS target FROM ev WHERE ts < TIMESTAMP '{DAYS[0]}' UNION ALL
      SELECT max(number) FROM ev WHERE ts < TIMESTAMP '{DAYS[1]}' UNION ALL
      SELECT max(number) FROM ev WHERE ts < TIMESTAMP '{DAYS[2]}'),
la AS (SELECT target, address, slot, max((number, ordinal)) AS p, arg_max(value, (number, ordinal)) AS value
  FROM ch JOIN t ON number <= target GROUP BY ALL),
rc AS (SELECT target, address, max((number, ordinal)) AS r FROM rs JOIN t ON number <= target GROUP BY ALL),
ks AS (SELECT DISTINCT target, address, slot FROM ch, t)
SELECT ks.target, ks.address, ks.slot,
  CASE WHEN la.p IS NULL OR (rc.r IS NOT NULL AND la.p <= rc.r) THEN '{ZERO}' ELSE la.value END AS value
FROM ks LEFT JOIN la USING (target, address, slot) LEFT JOIN rc ON rc.target = ks.target AND rc.address = ks.address""")
def state_as_of_blocks(spark, d):
    return L.state_as_of_each(changes(spark, d), resets(spark, d), [block_at(spark, d, day) for day in DAYS])


@query("asked_slot_values", f"""{NONZERO}, w AS (SELECT DISTINCT address, {sql_word('k + 50')} AS slot FROM ev)
SELECT w.address, w.slot, coalesce(nz.value, '{ZERO}') AS value FROM w LEFT JOIN nz USING (address, slot)""")
def asked_slot_values(spark, d):
    wanted = events(spark, d).select("address", X.number_word(F.col("k") + 50).alias("slot")).distinct()
    return L.slot_values(state(spark, d), wanted)


# what the requests ask: every event's slot at some block before or after it, slots nobody wrote among them
ASKED = f"""q AS (SELECT ordinal AS event_id, address, {sql_word('k + user_id % 2 * 50')} AS slot, number + ordinal % 41 - 20 AS block FROM ev)"""


@query("requested_slot_values", f"""WITH {EV}, {ASKED},
la AS (SELECT event_id, max((number, ordinal)) AS p, arg_max(value, (number, ordinal)) AS value FROM q JOIN ch
  ON ch.address = q.address AND ch.slot = q.slot AND ch.number <= q.block GROUP BY event_id),
rc AS (SELECT event_id, max((number, ordinal)) AS r FROM q JOIN rs ON rs.address = q.address AND rs.number <= q.block GROUP BY event_id)
SELECT event_id, q.address, q.slot, q.block,
  CASE WHEN la.p IS NULL OR (rc.r IS NOT NULL AND la.p <= rc.r) THEN '{ZERO}' ELSE la.value END AS value
FROM q LEFT JOIN la USING (event_id) LEFT JOIN rc USING (event_id)""")
def requested_slot_values(spark, d):
    """One request per event, each at a block of its own."""
    asked = events(spark, d).select(
        "ordinal", "address", X.number_word(F.col("k") + F.col("user_id") % 2 * 50).alias("slot"),
        (F.col("number") + F.col("ordinal") % 41 - 20).alias("block"))
    return A.values_as_of(changes(spark, d), resets(spark, d), asked).withColumnRenamed("ordinal", "event_id")


@query("requested_fields", f"""WITH {EV}, q AS (SELECT ordinal AS event_id, address, number + ordinal % 41 - 20 AS block FROM ev)
SELECT q.event_id, q.address, q.block,
  arg_max(CAST(cents AS VARCHAR), ordinal) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), ordinal) FILTER (WHERE event_type = 'click') AS nonce
FROM q LEFT JOIN ev ON ev.address = q.address AND ev.number <= q.block GROUP BY ALL""")
def requested_fields(spark, d):
    """Balance and nonce of each event's account at the end of another block."""
    ev = events(spark, d)
    rows = ev.select("number", "ordinal", "address", F.when(F.col("event_type") == "purchase", F.col("cents").cast("string")).alias("balance"),
                     F.when(F.col("event_type") == "click", F.col("ordinal").cast("string")).alias("nonce"))
    asked = ev.select(F.col("ordinal").alias("event_id"), "address", (F.col("number") + F.col("ordinal") % 41 - 20).alias("block"))
    return A.fields_as_of(rows, asked, ["balance", "nonce"])


@query("slot_counts", f"{NONZERO} SELECT address, count(*) AS nonzero_slots FROM nz GROUP BY address")
def slot_counts(spark, d):
    return L.slot_counts(state(spark, d))


# ---------------------------------------------------------------- account fields

def kinds(spark, d):
    ev = events(spark, d)
    at = ["number", "ordinal", "address"]
    return (ev.where("event_type = 'purchase'").select(*at, F.col("cents").cast("string").alias("value")),
            ev.where("event_type = 'click'").select(*at, F.col("ordinal").cast("decimal(20,0)").alias("value")),
            ev.where("event_type = 'view'").select(*at, F.sha2("props", 256).alias("hash"),
                                                   X.hex_text(F.encode("props", "utf-8")).alias("code")))


FIELDS_SQL = f"""WITH {EV} SELECT address,
  arg_max(CAST(cents AS VARCHAR), (number, ordinal)) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), (number, ordinal)) FILTER (WHERE event_type = 'click') AS nonce,
  arg_max(sha256(props), (number, ordinal)) FILTER (WHERE event_type = 'view') AS code_hash,
  arg_max('0x' || lower(hex(props)), (number, ordinal)) FILTER (WHERE event_type = 'view') AS code"""
FIELDS_FROM = " FROM ev WHERE event_type IN ('purchase', 'click', 'view') GROUP BY address"


@query("account_fields_latest", f"""{FIELDS_SQL}, max(number) AS last_block{FIELDS_FROM}""")
def account_fields_latest(spark, d):
    return L.latest_fields(L.field_rows(*kinds(spark, d)), keep_blocks=True).select(
        "address", "balance", F.col("nonce").cast("string").alias("nonce"), "code_hash", "code", "last_block")


@query("account_fields_overlay", FIELDS_SQL + FIELDS_FROM)
def account_fields_overlay(spark, d):
    """Base up to day 10, prefix up to day 20, the rest as deltas: same answer as one pass."""
    first, second = block_at(spark, d, DAYS[0]), block_at(spark, d, DAYS[1])
    rows = L.field_rows(*kinds(spark, d))
    base = L.latest_fields(rows.where(F.col("number") <= first))
    prefix = L.latest_fields(rows.where((F.col("number") > first) & (F.col("number") <= second)))
    merged = L.overlay_fields(base, [prefix], rows.where(F.col("number") > second))
    return merged.select("address", "balance", F.col("nonce").cast("string").alias("nonce"), "code_hash", "code")


@query("filled_fields", f"""WITH {EV}, f AS (
SELECT address, arg_max(CAST(cents AS VARCHAR), (number, ordinal)) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), (number, ordinal)) FILTER (WHERE event_type = 'click') AS nonce
  FROM ev WHERE event_type IN ('purchase', 'click', 'view') GROUP BY address),
p AS (SELECT {sql_address('c_custkey')} AS address,
  CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS balance, CAST(c_nationkey AS VARCHAR) AS nonce FROM customer)
SELECT p.address, coalesce(f.balance, p.balance) AS balance, coalesce(f.nonce, p.nonce) AS nonce,
  CASE WHEN f.balance IS NOT NULL AND f.balance <> p.balance THEN 1 ELSE 0 END
  + CASE WHEN f.nonce IS NOT NULL AND f.nonce <> p.nonce THEN 1 ELSE 0 END AS mismatches
FROM p LEFT JOIN f USING (address)""")
def filled_fields(spark, d):
    observed = L.latest_fields(L.field_rows(*kinds(spark, d))).select("address", "balance", "nonce")
    proven = table(spark, d, "customer").select(
        X.number_word("c_custkey", 40).alias("address"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string").alias("balance"),
        F.col("c_nationkey").cast("decimal(20,0)").alias("nonce"))
    return L.fill_from_proof(observed, proven).select(
        "address", "balance", F.col("nonce").cast("string").alias("nonce"),
        F.size("mismatched").cast("bigint").alias("mismatches"))


# ---------------------------------------------------------------- blocks

def dense(spark, d):
    """Few accounts and slots, so that blocks rewrite their own keys."""
    ev = events(spark, d)
    return ev.select("number", "ordinal", "event_type", "cents", "value", "ts",
                     X.number_word(F.col("user_id") % 10, 40).alias("address"),
                     X.number_word(F.col("k") % 5).alias("slot"))


DENSE = EV + f""", de AS (SELECT number, ordinal, event_type, cents, value, ts,
  '0x' || lpad(lower(to_hex(user_id % 10)), 40, '0') AS address, {sql_word('k % 5')} AS slot FROM ev)"""


@query("block_end_storage", f"""WITH {DENSE} SELECT number, address, slot, arg_max(value, ordinal) AS value,
  max(ordinal) AS ordinal FROM de WHERE event_type <> 'signup' GROUP BY number, address, slot""")
def block_end_storage(spark, d):
    return E.last_per_block(dense(spark, d).where("event_type <> 'signup'"), ["address", "slot"], ["value"])


@query("block_end_fields", f"""WITH {DENSE}, n AS (SELECT number, address, ordinal, cents AS v,
  lag(cents) OVER (PARTITION BY address ORDER BY ordinal) AS old FROM de WHERE event_type = 'click')
SELECT number, address, 'balance' AS kind, CAST(arg_max(cents, ordinal) AS VARCHAR) AS value, max(ordinal) AS ordinal
  FROM de WHERE event_type = 'purchase' GROUP BY number, address
UNION ALL SELECT number, address, 'code', CASE WHEN arg_max(cents, ordinal) % 7 = 0 THEN '0x' ELSE '0x' || to_hex(arg_max(cents, ordinal)) END, max(ordinal)
  FROM de WHERE event_type = 'view' GROUP BY number, address
UNION ALL SELECT number, address, 'code_cleared', '', ordinal FROM de WHERE event_type = 'view' AND cents % 7 = 0
UNION ALL SELECT number, address, 'nonce_reset', '', ordinal FROM n WHERE v < old""")
def block_end_fields(spark, d):
    from chainfold.operators.ordered import previous_row
    rows = dense(spark, d)
    at = ["number", "ordinal", "address"]
    balances = E.last_per_block(rows.where("event_type = 'purchase'").withColumn(
        "v", F.col("cents").cast("string")), ["address"], ["v"]).select(
        "number", "address", F.lit("balance").alias("kind"), F.col("v").alias("value"), "ordinal")
    code = F.when(F.col("cents") % 7 == 0, F.lit(b"")).otherwise(F.encode(F.hex("cents"), "utf-8"))
    codes = rows.where("event_type = 'view'").select(*at, code.alias("new_code"))
    last_codes = E.last_per_block(codes.withColumn("v", F.concat(F.lit("0x"), F.decode("new_code", "utf-8"))),
                                  ["address"], ["v"]).select(
        "number", "address", F.lit("code").alias("kind"), F.col("v").alias("value"), "ordinal")
    nonces = previous_row(rows.where("event_type = 'click'").select(*at, "cents"), ["address"], ["ordinal"], ["cents"])
    marks = E.code_clears(codes).unionByName(E.nonce_resets(
        nonces.withColumn("old_value", F.col("previous.cents")).withColumnRenamed("cents", "new_value")))
    return balances.unionByName(last_codes).unionByName(
        marks.select("number", "address", "kind", F.lit("").alias("value"), "ordinal"))


def envelopes(spark, d):
    rows = dense(spark, d)
    blocks = rows.groupBy("number").agg(F.min("ts").alias("ts")).select(
        "number", F.sha2(F.concat(F.lit("b"), F.col("number").cast("string")), 256).alias("hash"),
        F.sha2(F.concat(F.lit("b"), (F.col("number") - 1).cast("string")), 256).alias("parent_hash"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))
    at = ["number", "ordinal", "address"]
    storage = E.last_per_block(rows.where("event_type <> 'signup'"), ["address", "slot"], ["value"])
    balances = E.last_per_block(rows.where("event_type = 'purchase'").select(
        *at, F.col("cents").cast("string").alias("value")), ["address"], ["value"])
    nonces = E.last_per_block(rows.where("event_type = 'click'").select(
        *at, F.col("cents").cast("decimal(20,0)").alias("value")), ["address"], ["value"])
    codes = E.last_per_block(rows.where("event_type = 'view'").select(
        *at, F.sha2(F.col("cents").cast("string"), 256).alias("hash"), F.lit("0x").alias("code")),
        ["address"], ["hash", "code"])
    effects = rows.where("event_type = 'signup'").select("number", "address", F.lit("storage_reset").alias("kind"), "ordinal")
    return E.assemble(blocks, storage, balances, nonces, codes, effects)


@query("envelope_roundtrip", f"""WITH {DENSE},
b AS (SELECT number, sha256('b' || number) AS hash, sha256('b' || (number - 1)) AS parent_hash FROM de GROUP BY number),
r AS (SELECT number, 'storage' AS kind, address, slot, arg_max(value, ordinal) AS value, max(ordinal) AS ordinal
  FROM de WHERE event_type <> 'signup' GROUP BY number, address, slot
  UNION ALL SELECT number, 'balances', address, '', CAST(arg_max(cents, ordinal) AS VARCHAR), max(ordinal)
  FROM de WHERE event_type = 'purchase' GROUP BY number, address
  UNION ALL SELECT number, 'lifecycle', address, '', 'storage_reset', ordinal FROM de WHERE event_type = 'signup')
SELECT r.*, b.hash, b.parent_hash FROM r JOIN b USING (number)""")
def envelope_roundtrip(spark, d):
    """Assemble one row per block, read it back as parallel arrays, and un-nest all groups in one pass."""
    from chainfold.sources.blocks import parallel_arrays, zip_arrays
    env = zip_arrays(parallel_arrays(envelopes(spark, d).select("number", "hash", "parent_hash", "storage", "balances", "lifecycle")))

    def listed(group, slot, value):
        return F.transform(group, lambda c: F.struct(
            F.lit(group).alias("kind"), c["address"].alias("address"), slot(c).alias("slot"), value(c).alias("value"),
            c["ordinal"].alias("ordinal")))
    none = lambda c: F.lit("")
    rows = F.concat(listed("storage", lambda c: c["slot"], lambda c: c["value"]),
                    listed("balances", none, lambda c: c["value"]), listed("lifecycle", none, lambda c: c["kind"]))
    return env.select("number", "hash", "parent_hash", rows.alias("rows")).select(
        "number", "hash", "parent_hash", F.inline("rows"))


@query("wide_state", """SELECT l_suppkey AS address, l_partkey AS slot, max({'number': l_orderkey, 'ordinal': l_linenumber,
  'value': CAST(round(l_extendedprice * 100) AS BIGINT)}).value AS value FROM lineitem GROUP BY 1, 2""")
def wide_state(spark, d):
    """Newest value per key over the largest table: line items as changes."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("address"), F.col("l_partkey").alias("slot"), F.col("l_orderkey").alias("number"),
        F.col("l_linenumber").alias("ordinal"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("value"))
    return L.latest_slots(rows).select("address", "slot", "value")


@query("patch_sizes", f"""WITH {DENSE}, s AS (SELECT DISTINCT number, address, slot FROM de WHERE event_type <> 'signup')
SELECT count(*) AS patches FROM s""")
def patch_sizes(spark, d):
    return L.patch_count(envelopes(spark, d))


FORK = "2024-01-16"


def destroying(spark, d):
    return dense(spark, d).where("event_type = 'signup'").select(
        "number", "address", F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("ordinal").alias("call_end"), (F.col("ordinal") + 3).alias("tx_end"),
        (F.col("cents") % 2 == 0).alias("created_here"))


FORK_SECONDS = 1705363200          # 2024-01-16 00:00 UTC
DELETED = DENSE + f""", de2 AS (SELECT number, address, max(ordinal + 3) AS gone FROM de WHERE event_type = 'signup'
  AND (ts < TIMESTAMP '{FORK}' OR cents % 2 = 0) GROUP BY number, address)"""


@query("deletions_by_fork_time", f"""WITH {DELETED},
s AS (SELECT number, address, slot, arg_max(value, ordinal) AS value, max(ordinal) AS ordinal FROM de
  WHERE event_type <> 'signup' GROUP BY number, address, slot)
SELECT s.* FROM s LEFT JOIN de2 USING (number, address) WHERE gone IS NULL OR ordinal > gone""")
def deletions_by_fork_time(spark, d):
    removed = E.deletions(destroying(spark, d), FORK_SECONDS)
    storage = E.last_per_block(dense(spark, d).where("event_type <> 'signup'"), ["address", "slot"], ["value"])
    return E.surviving_storage(storage, removed)


@query("deletion_defaults", f"""WITH {DELETED},
v AS (SELECT number, address, CAST(arg_max(cents, ordinal) AS VARCHAR) AS value, max(ordinal) AS ordinal FROM de
  WHERE event_type = 'purchase' GROUP BY number, address)
SELECT coalesce(v.number, g.number) AS number, coalesce(v.address, g.address) AS address,
  CASE WHEN g.gone IS NULL OR v.ordinal >= g.gone THEN v.value ELSE '0' END AS value,
  CASE WHEN g.gone IS NULL OR v.ordinal >= g.gone THEN v.ordinal ELSE g.gone END AS ordinal
FROM v FULL JOIN de2 g ON v.number = g.number AND v.address = g.address""")
def deletion_defaults(spark, d):
    removed = E.deletions(destroying(spark, d), FORK_SECONDS)
    balances = E.last_per_block(dense(spark, d).where("event_type = 'purchase'").withColumn(
        "value", F.col("cents").cast("string")), ["address"], ["value"])
    return E.with_deletion_defaults(balances, removed, value=F.lit("0"))


@query("lifecycle_markers", f"""WITH {DELETED}
SELECT number, address, 'selfdestruct' AS kind, ordinal FROM de WHERE event_type = 'signup'
UNION ALL SELECT number, address, 'storage_reset', gone FROM de2""")
def lifecycle_markers(spark, d):
    calls = destroying(spark, d)
    return E.selfdestructs(calls).unionByName(E.deletions(calls, FORK_SECONDS).select(
        "number", "address", F.lit("storage_reset").alias("kind"), "ordinal"))


# ---------------------------------------------------------------- digests and comparisons

@query("state_digest", f"""{NONZERO},
h AS (SELECT substr(sha256(address || slot), 1, 6) AS leaf, sha256(address || slot || value) AS h FROM nz),
l AS (SELECT leaf, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS h FROM h GROUP BY leaf),
b AS (SELECT substr(leaf, 1, 3) AS branch, sum(n) AS n, sha256(string_agg(leaf || h, '' ORDER BY leaf)) AS h FROM l GROUP BY 1)
SELECT sha256(string_agg(branch || h, '' ORDER BY branch)) AS state_sha256, CAST(sum(n) AS BIGINT) AS nonzero_slots FROM b""")
def state_digest(spark, d):
    return D.state_digest(state(spark, d))


@query("state_fingerprint", f"""{NONZERO}, h AS (SELECT address, sha256(address || slot || value) AS h FROM nz)
SELECT address, count(*) AS rows, CAST(sum(CAST(('0x' || substr(h, 1, 15)) AS BIGINT)) AS VARCHAR) AS sum0,
  CAST(sum(CAST(('0x' || substr(h, 16, 15)) AS BIGINT)) AS VARCHAR) AS sum1,
  CAST(sum(CAST(('0x' || substr(h, 31, 15)) AS BIGINT)) AS VARCHAR) AS sum2,
  CAST(sum(CAST(('0x' || substr(h, 46, 15)) AS BIGINT)) AS VARCHAR) AS sum3 FROM h GROUP BY address""")
def state_fingerprint(spark, d):
    return D.fingerprint(state(spark, d), ["address", "slot", "value"], ["address"])


@query("states_equal", f"{NONZERO} SELECT count(*) AS left_rows, count(*) AS right_rows, true AS equal FROM nz")
def states_equal(spark, d):
    """Folding half of the history first gives the same state as one pass."""
    half = block_at(spark, d, DAYS[1])
    ch, rs = changes(spark, d), resets(spark, d)
    prefix = L.state_as_of(ch, rs, half)
    later = F.col("number") > half
    folded = L.reduce_state(L.union_changes([ch.where(later)], [(prefix, half)]), rs.where(later))
    return D.same_rows(folded, state(spark, d), ["address", "slot", "value"])


@query("state_differences", f"""{NONZERO},
o AS (SELECT address, slot, arg_max(value, (number, ordinal)) AS value FROM ch GROUP BY address, slot
  HAVING arg_max(value, (number, ordinal)) <> '{ZERO}')
SELECT coalesce(a.address, o.address) AS address, coalesce(a.slot, o.slot) AS slot, a.value AS left_value,
  o.value AS right_value, CASE WHEN o.value IS NULL THEN 'only_left' WHEN a.value IS NULL THEN 'only_right'
  ELSE 'different' END AS difference
FROM nz a FULL JOIN o ON a.address = o.address AND a.slot = o.slot WHERE a.value IS DISTINCT FROM o.value""")
def state_differences(spark, d):
    ignoring_resets = L.reduce_state(changes(spark, d), None)
    return Q.state_differences(state(spark, d), ignoring_resets)


@query("expected_changes", f"""WITH {DENSE},
o AS (SELECT number, address, event_type AS kind FROM de),
x AS (SELECT number, address, CASE WHEN cents % 11 = 0 THEN 'view' ELSE event_type END AS kind FROM de)
SELECT number, address, kind, CAST(sum(n) AS BIGINT) AS surplus FROM (
  SELECT *, 1 AS n FROM o UNION ALL SELECT *, -1 FROM x) GROUP BY number, address, kind HAVING sum(n) <> 0""")
def expected_changes(spark, d):
    rows = dense(spark, d)
    observed = rows.select("number", "address", F.col("event_type").alias("kind"))
    expected = rows.select("number", "address", F.when(F.col("cents") % 11 == 0, "view").otherwise(
        F.col("event_type")).alias("kind"))
    return Q.multiset_differences(observed, expected, ["number", "address", "kind"])


@query("unexpected_changes", f"""WITH {DENSE}
SELECT DISTINCT number, 'storage' AS "group", address FROM de WHERE event_type <> 'signup'
  AND address IN ('0x0000000000000000000000000000000000000003', '0x0000000000000000000000000000000000000007')
UNION ALL SELECT DISTINCT number, 'balances', address FROM de WHERE event_type = 'purchase'
  AND address IN ('0x0000000000000000000000000000000000000003', '0x0000000000000000000000000000000000000007')""")
def unexpected_changes(spark, d):
    quiet = spark.createDataFrame([("0x" + "0" * 39 + n,) for n in "37"], "address string")
    return Q.unexpected_changes(envelopes(spark, d), quiet, ["storage", "balances"])


@query("field_differences", f"""WITH {EV}, o AS (SELECT address,
  arg_max(CAST(cents AS VARCHAR), ordinal) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), ordinal) FILTER (WHERE event_type = 'click') AS nonce
  FROM ev WHERE event_type IN ('purchase', 'click', 'view') GROUP BY address),
x AS (SELECT address, arg_max(CAST(cents AS VARCHAR), ordinal) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), ordinal) FILTER (WHERE event_type = 'click') AS nonce FROM ev
  WHERE number <= {AT} AND event_type IN ('purchase', 'click', 'view') GROUP BY address),
j AS (SELECT o.address, 'balance' AS field, o.balance AS observed, x.balance AS expected FROM o LEFT JOIN x USING (address)
  UNION ALL SELECT o.address, 'nonce', o.nonce, x.nonce FROM o LEFT JOIN x USING (address))
SELECT * FROM j WHERE observed IS NOT NULL AND observed IS DISTINCT FROM expected""")
def field_differences(spark, d):
    rows = L.field_rows(*kinds(spark, d))
    before = L.latest_fields(rows.where(F.col("number") <= block_at(spark, d, "2024-01-21")))
    return Q.field_differences(L.latest_fields(rows), before, ["balance", "nonce"])


@query("storage_roots")
def storage_roots(spark, d):
    from chainfold.operators.trie import storage_roots as roots
    return roots(state(spark, d))


@query("storage_root_splits", f"""{NONZERO} SELECT address, count(*) AS nonzero_slots, true AS same, true AS well_formed,
  false AS same_without_first FROM nz GROUP BY address""")
def storage_root_splits(spark, d):
    """An account's root does not depend on how its slots are split, and changes when one slot goes."""
    from chainfold.operators.trie import account_roots, storage_roots as roots
    slots = state(spark, d)
    one, two = roots(slots), roots(slots, 3).select("address", F.col("storage_root").alias("other"))
    first = slots.groupBy("address").agg(F.min("slot").alias("slot"))
    less = account_roots(first, slots.join(first, ["address", "slot"], "left_anti")).select("address", F.col("storage_root").alias("less"))
    return one.join(two, "address").join(less, "address").select(
        "address", "nonzero_slots", (F.col("storage_root") == F.col("other")).alias("same"),
        X.is_fixed_hex("storage_root", 32).alias("well_formed"), (F.col("storage_root") == F.col("less")).alias("same_without_first"))


# ---------------------------------------------------------------- current state

@query("current_storage", f"""WITH {EV} SELECT address, slot, arg_max(value, (number, ordinal)) AS value,
  max((number, ordinal))[1] AS block_num, max((number, ordinal))[2] AS ordinal FROM ch GROUP BY address, slot""")
def current_storage(spark, d):
    """Two batches merged in the wrong order of arrival still give the newest values."""
    half = block_at(spark, d, DAYS[1])
    ch = changes(spark, d)
    late = C.current_storage(ch.where(F.col("number") > half))
    return C.merge_storage(late, C.current_storage(ch.where(F.col("number") <= half)))


@query("current_accounts", f"""WITH {EV}, f AS (SELECT address,
  arg_max(CAST(cents AS VARCHAR), ordinal) FILTER (WHERE event_type = 'purchase') AS balance,
  arg_max(CAST(ordinal AS VARCHAR), ordinal) FILTER (WHERE event_type = 'click') AS nonce,
  arg_max(sha256(props), ordinal) FILTER (WHERE event_type = 'view') AS code_hash,
  max(number) AS block_num, max(number) FILTER (WHERE event_type = 'purchase') AS balance_block_num,
  max(number) FILTER (WHERE event_type = 'click') AS nonce_block_num,
  max(number) FILTER (WHERE event_type = 'view') AS code_block_num
  FROM ev WHERE event_type IN ('purchase', 'click', 'view') GROUP BY address) SELECT * FROM f""")
def current_accounts(spark, d):
    half = block_at(spark, d, DAYS[1])

    def part(condition):
        balances, nonces, codes = [k.where(condition) for k in kinds(spark, d)]
        return C.current_accounts(balances.withColumnRenamed("value", "new_value"),
                                  nonces.withColumnRenamed("value", "new_value"),
                                  codes.withColumnRenamed("hash", "new_hash"))
    merged = C.merge_accounts(part(F.col("number") > half), part(F.col("number") <= half))
    return merged.withColumn("nonce", F.col("nonce").cast("string"))


@query("nonzero_view", f"""WITH {EV}, c AS (SELECT address, slot, arg_max(value, (number, ordinal)) AS value,
  max(number) AS block_num, max(ordinal) AS ordinal FROM ch GROUP BY address, slot)
SELECT * FROM c WHERE value <> '{ZERO}'""")
def nonzero_view(spark, d):
    return C.storage_nonzero(C.current_storage(changes(spark, d)))


@query("head", f"""WITH {EV} SELECT number AS block_num, min(ts)::VARCHAR AS stamp FROM ev GROUP BY number
ORDER BY number DESC LIMIT 1""")
def head(spark, d):
    blocks = events(spark, d).groupBy(F.col("number").alias("block_num")).agg(F.min("ts").cast("string").alias("stamp"))
    return C.head(blocks)


@query("last_touch", f"""WITH {EV} SELECT address, max(number) AS last_block FROM ev
WHERE event_type IN ('purchase', 'click', 'view') GROUP BY address""")
def last_touch(spark, d):
    balances, nonces, codes = kinds(spark, d)
    accounts = C.current_accounts(balances.withColumnRenamed("value", "new_value"),
                                  nonces.withColumnRenamed("value", "new_value"),
                                  codes.withColumnRenamed("hash", "new_hash"))
    return C.last_touch(accounts.drop("block_num")).select("address", "last_block")


@query("code_dedup", """WITH c AS (SELECT sha256(text) AS code_hash, min(doc_id) AS first_block_num,
  min(octet_length(encode(text))) AS size FROM documents WHERE text <> '' GROUP BY 1)
SELECT doc_id, c.code_hash, CAST(c.size AS BIGINT) AS code_size, c.first_block_num FROM documents JOIN c ON sha256(text) = c.code_hash""")
def code_dedup(spark, d):
    documents = table(spark, d, "documents").withColumn("code_hash", F.sha2("text", 256))
    codes = documents.select(F.col("doc_id").alias("number"), F.col("code_hash").alias("new_hash"),
                             F.encode("text", "utf-8").alias("new_code"))
    code = C.distinct_code(codes)
    accounts = documents.where("text <> ''").select("doc_id", "code_hash")
    joined = C.account_state(accounts, code.drop("first_block_num")).join(
        code.select("code_hash", "first_block_num"), "code_hash")
    return joined.select("doc_id", "code_hash", F.col("code_size").cast("bigint").alias("code_size"), "first_block_num")


@query("snapshot_json", f"""{NONZERO},
a AS (SELECT address, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY address),
b AS (SELECT 1 AS part, address AS key, '{{"address":"' || address || '","n":' || n || '}}' AS body FROM a
  UNION ALL SELECT 3, address || '/' || slot, '{{"address":"' || address || '","slot":"' || slot || '","value":"' || value || '"}}' FROM nz),
p AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY key) AS place, body FROM b)
SELECT part, place, CASE WHEN place > 1 THEN ',' ELSE '' END || body AS text FROM p
UNION ALL SELECT 0, 1, '{{"header":{{"number":' || max(number) || '}},"accounts":[' FROM ev
UNION ALL SELECT 2, 1, '],"storage":[' UNION ALL SELECT 4, 1, ']}}'""")
def snapshot_json(spark, d):
    ev = events(spark, d)
    return Q.snapshot_json(ev.agg(F.max("number").alias("number")), ev.groupBy("address").agg(F.count("*").alias("n")),
                           state(spark, d))


@query("canonical_documents", f"""WITH {EV} SELECT event_id, '{{"a":' || event_id || ',"b":{{"list":[{{"x":null,"y":true}},"é"],"props":' ||
  '{{"k":' || k || '}}}},"name":"' || event_type || '"}}' AS document, user_id AS owner, true AS same FROM (SELECT ordinal AS event_id, * FROM ev)""")
def canonical_documents(spark, d):
    """The same document written in two orders of its keys, nested ones too, around each event's own JSON."""
    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    n, kind, props, user = (F.col(c) for c in ("event_id", "event_type", "props", "user_id"))
    rows = table(spark, d, "events").select("event_id", user.alias("owner_id"), *[doc.alias(name) for name, doc in {
        "one": text('{"name":"', kind, '", "b":{"props":', props, ',"list":[{"y":true,"x":null},"é"]},"a":', n, "}"),
        "two": text('{ "b" : {"list":[ {"x":null,"y":true},"é"], "props":', props, '}, "a":', n, ',"name":"', kind, '"}'),
        "owned": text('{"owner":{"id":', user, '},"tags":[]}')}.items()])
    return rows.select("event_id", X.canonical_document("one").alias("document"), X.document_value("owned", "$.owner.id", "bigint").alias("owner"),
                       (X.canonical_document("one") == X.canonical_document("two")).alias("same"))
