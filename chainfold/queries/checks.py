"""Continuity, cohorts, retention, pages and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.operators import (continuity as N, digest as D, latest as L, paging as G, quality as Q,
                                 retention as R)
from chainfold.plans import growth as W, store
from chainfold.session import cut, shared_folder
from chainfold.sources import page_source as P
from chainfold.queries.base import EV, LATEST, changes, events, query, resets, sql_address, table

NONZERO = f"WITH {EV}, {LATEST}, nz AS (SELECT * FROM st WHERE value <> '{X.ZERO_WORD}')"


def state(spark, d):
    return L.reduce_state(changes(spark, d), resets(spark, d)).select("address", "slot", "value")


# ---------------------------------------------------------------- continuity

def chain(spark, d):
    """One block per event except errors (gaps); sign-ups come twice (conflicts); views name a wrong parent."""
    ev = table(spark, d, "events").where("event_type <> 'error'")
    block = lambda mark, n: F.sha2(F.concat(F.lit(mark), n.cast("string")), 256)
    n = F.col("event_id")
    own = ev.select(n.alias("number"), block("b", n).alias("hash"),
                    F.when(F.col("event_type") == "view", block("x", n)).otherwise(block("b", n - 1)).alias("parent_hash"))
    twice = ev.where("event_type = 'signup'").select(n.alias("number"), block("d", n).alias("hash"),
                                                     block("b", n - 1).alias("parent_hash"))
    return own.unionByName(twice)


CHAIN = """bl AS (SELECT event_id AS number, sha256('b' || event_id) AS hash,
  CASE WHEN event_type = 'view' THEN sha256('x' || event_id) ELSE sha256('b' || (event_id - 1)) END AS parent_hash
  FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, sha256('d' || event_id), sha256('b' || (event_id - 1)) FROM events WHERE event_type = 'signup'),
e AS (SELECT max(event_id) AS top FROM events)"""


@query("interval_defects", f"""WITH {CHAIN}
SELECT number, number AS last, 'conflicting block' AS reason FROM bl GROUP BY number HAVING count(*) > 1
UNION ALL SELECT before + 1, number - 1, 'missing block' FROM (SELECT number, lag(number, 1, -1) OVER (ORDER BY number) AS before
  FROM (SELECT number FROM bl UNION SELECT top + 1 FROM e)) WHERE number > before + 1
UNION ALL SELECT number, number, 'broken parent' FROM (SELECT a.number FROM bl a JOIN bl b ON a.number = b.number + 1
  WHERE a.parent_hash <> b.hash GROUP BY a.number)""")
def interval_defects(spark, d):
    top = table(spark, d, "events").agg(F.max("event_id")).first()[0]
    return N.interval_defects(chain(spark, d), 0, top)


@query("turn_gaps", """WITH t AS (SELECT conv_id, max(turn) AS top, count(*) AS n, count(DISTINCT turn) AS k FROM conversations
  WHERE conv_id % 3 <> 0 OR turn <> 1 GROUP BY conv_id) SELECT conv_id FROM t WHERE top + 1 <> k OR n <> k""")
def turn_gaps(spark, d):
    """Sequences with a hole, found by counting instead of ordering."""
    rows = table(spark, d, "conversations").where("conv_id % 3 <> 0 OR turn <> 1")
    per = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id").agg(
        F.max("turn").alias("top"), F.sum("n").alias("n"), F.count("*").alias("k"))
    return per.where("top + 1 <> k OR n <> k").select("conv_id")


@query("metadata_defects", """WITH b AS (SELECT event_id AS number, event_type FROM events)
SELECT number, 'account filter changed' AS reason FROM b WHERE event_type = 'click'
UNION ALL SELECT number, 'schema version changed' FROM b WHERE event_type = 'view'
UNION ALL SELECT number, 'other producer version' FROM b WHERE number % 7 NOT BETWEEN 3 AND 5
UNION ALL SELECT number, 'invalid parent hash' FROM b WHERE event_type = 'error'""")
def metadata_defects(spark, d):
    n, kind = F.col("event_id"), F.col("event_type")
    word = F.concat(F.lit("0x"), F.sha2(n.cast("string"), 256))
    blocks = table(spark, d, "events").select(
        n.alias("number"), word.alias("hash"), F.when(kind == "error", F.lit("0x12")).otherwise(word).alias("parent_hash"),
        F.when(kind == "click", "0xaa").otherwise("0xbb").alias("accounts"),
        F.when(kind == "view", 2).otherwise(1).alias("schema_version"),
        (n % 7).cast("int").alias("producer_version"))
    return N.metadata_defects(blocks, "0xbb")


@query("progress_match", """WITH p AS (SELECT event_id AS number, CASE WHEN value < 5 THEN sha256('w' || event_id) ELSE sha256('b' || event_id) END AS hash FROM events WHERE event_type IN ('click', 'error')),
m AS (SELECT event_id AS number FROM events WHERE event_type <> 'error' OR value > 30)
SELECT CAST(p.number % 4 AS VARCHAR) AS run_id, p.number, 1 AS data_rows, CASE WHEN m.number IS NULL THEN 0 ELSE 1 END AS marker_rows,
  m.number IS NOT NULL AND p.hash = sha256('b' || p.number) AS matches FROM p LEFT JOIN m ON p.number = m.number""")
def progress_match(spark, d):
    ev = table(spark, d, "events")
    n = F.col("event_id")
    good = F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("b"), n.cast("string")), 256))
    wrong = F.concat(F.lit("0x"), F.sha2(F.concat(F.lit("w"), n.cast("string")), 256))
    progress = ev.where("event_type IN ('click', 'error')").select(
        (n % 4).cast("string").alias("run_id"), n.alias("number"),
        F.when(F.col("value") < 5, wrong).otherwise(good).alias("hash"))
    markers = ev.where("event_type <> 'error' OR value > 30").select(n.alias("number"), F.substring(good, 3, 64).alias("hash"))
    return N.progress_match(progress, ev.select(n.alias("number"), good.alias("hash")), markers)


@query("progress_regressions", """WITH p AS (SELECT CAST(user_id % 5 AS VARCHAR) AS run_id, event_id AS entry,
  event_id - CASE WHEN event_type = 'error' THEN k ELSE 0 END AS number FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
q AS (SELECT *, lag(number) OVER (PARTITION BY run_id ORDER BY entry) AS before FROM p) SELECT run_id, entry, number FROM q WHERE number < before""")
def progress_regressions(spark, d):
    ev = events(spark, d)
    back = F.when(F.col("event_type") == "error", F.col("k")).otherwise(0)
    return N.progress_regressions(ev.select((F.col("user_id") % 5).cast("string").alias("run_id"),
                                            F.col("ordinal").alias("entry"), (F.col("ordinal") - back).alias("number")))


# ---------------------------------------------------------------- cohorts

def cohorts(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderpriority").alias("cohort"), F.col("o_custkey").alias("address"))


@query("cohort_overlap", """SELECT o_custkey AS address, min(o_orderpriority) AS first_cohort, max(o_orderpriority) AS last_cohort
FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""")
def cohort_overlap(spark, d):
    return N.cohort_overlap(cohorts(spark, d))


@query("cohort_coverage", """SELECT coalesce(c_custkey, k) AS address, CASE WHEN k IS NULL THEN 'not covered' ELSE 'not selected' END AS reason
FROM (SELECT c_custkey FROM customer WHERE c_nationkey > 1) FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') ON k = c_custkey
WHERE k IS NULL OR c_custkey IS NULL""")
def cohort_coverage(spark, d):
    selected = table(spark, d, "customer").where("c_nationkey > 1").select(F.col("c_custkey").alias("address"))
    covered = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("address"))
    return N.coverage_defects(selected, covered)


@query("coverage_gate", """SELECT DISTINCT o_custkey AS address FROM orders WHERE o_custkey NOT IN
(SELECT c_custkey FROM customer WHERE c_nationkey > 1)""")
def coverage_gate(spark, d):
    """State of accounts outside the verified set must be empty before publication."""
    verified = table(spark, d, "customer").where("c_nationkey > 1").select(F.col("c_custkey").alias("address"))
    stored = table(spark, d, "orders").select(F.col("o_custkey").alias("address")).distinct()
    return stored.join(verified, "address", "left_anti")


@query("cohort_continuation", """WITH s AS (SELECT o_orderpriority AS cohort, o_custkey AS address FROM orders),
b AS (SELECT DISTINCT c_custkey AS address FROM customer WHERE c_nationkey = 3)
SELECT cohort, CASE WHEN cohort < '3' THEN 'does not start behind the base' ELSE 'parent is not the base block' END AS reason
FROM (SELECT DISTINCT cohort FROM s WHERE address IN (SELECT address FROM b)) WHERE cohort < '3' OR cohort > '4'""")
def cohort_continuation(spark, d):
    sources = cohorts(spark, d).withColumn("start_block", F.when(F.col("cohort") < "3", 5).otherwise(8)).withColumn(
        "parent_hash", F.when(F.col("cohort") > "4", F.lit("0xbad")).otherwise(F.lit("0xbase")))
    base = table(spark, d, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("address"))
    return N.continuation_defects(sources, base, {"number": 7, "hash": "0xbase"})


@query("cohort_join", f"""{NONZERO} SELECT address, count(*) AS nonzero_slots FROM nz GROUP BY address""")
def cohort_join(spark, d):
    """A cohort folded apart joins the others at one common block: the result is the plain state."""
    ch, rs = changes(spark, d), resets(spark, d)
    late = F.substring("address", -1, 1) < "8"
    at = ch.agg(F.max("number")).first()[0]
    apart = L.state_as_of(ch.where(late), rs.where(late), at)
    joined = L.nonzero(L.latest_slots(L.union_changes(
        [L.reduce_state(ch.where(~late), rs.where(~late))], [(apart, at)])))
    return L.slot_counts(joined)


@query("prefix_choice", """WITH s AS (SELECT c_custkey, c_nationkey AS start_block, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_nationkey - c_nationkey % 2 END AS prefix_start,
  CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE 15 END AS prefix_number FROM customer)
SELECT c_custkey, prefix_number IS NOT NULL AND start_block <= prefix_number AND start_block = prefix_start AS use_prefix,
  CASE WHEN prefix_number IS NULL OR start_block > prefix_number THEN start_block WHEN start_block = prefix_start THEN prefix_number + 1 END AS delta_start,
  prefix_number IS NOT NULL AND start_block <= prefix_number AND start_block <> prefix_start AS inside_prefix FROM s""")
def prefix_choice(spark, d):
    n = F.col("c_nationkey")
    sources = table(spark, d, "customer").select(
        "c_custkey", n.alias("start_block"), F.when(n % 3 != 0, n - n % 2).alias("prefix_start"),
        F.when(n % 3 != 0, 15).alias("prefix_number"))
    chosen = L.prefix_choices(sources)
    return chosen.select("c_custkey", F.coalesce("use_prefix", F.lit(False)).alias("use_prefix"), "delta_start",
                         F.coalesce("inside_prefix", F.lit(False)).alias("inside_prefix"))


# ---------------------------------------------------------------- retention

def members(spark, d):
    """A snapshot per order day; its accounts are that day's customers."""
    day = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("bigint")
    return table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("snapshot_id"), day.alias("block_number"),
        (day * 10).alias("created_at"), F.col("o_custkey").alias("address"))


MEMBERS = """m AS (SELECT strftime(o_orderdate, '%Y%m%d') AS snapshot_id, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block_number,
  o_custkey AS address FROM orders),
newest AS (SELECT address, arg_max(snapshot_id, block_number) AS snapshot_id FROM m GROUP BY address)"""


@query("newest_per_account", f"WITH {MEMBERS} SELECT * FROM newest")
def newest_per_account(spark, d):
    return R.newest_per_account(members(spark, d))


@query("latest_snapshots", f"WITH {MEMBERS} SELECT DISTINCT snapshot_id, block_number FROM m ORDER BY block_number DESC LIMIT 7")
def latest_snapshots(spark, d):
    ready = members(spark, d).select("snapshot_id", "block_number", "created_at").distinct()
    return R.latest_snapshots(ready, 7).join(ready.select("snapshot_id", "block_number"), "snapshot_id")


@query("retention_plan", f"""WITH {MEMBERS}, ready AS (SELECT DISTINCT snapshot_id, block_number FROM m WHERE block_number % 11 <> 0),
keepers AS (SELECT snapshot_id FROM ready ORDER BY block_number DESC LIMIT 7),
nw AS (SELECT DISTINCT arg_max(snapshot_id, block_number) OVER (PARTITION BY address) AS s FROM m WHERE block_number % 11 <> 0),
nw2 AS (SELECT DISTINCT arg_max(snapshot_id, block_number) AS s FROM m WHERE block_number % 11 <> 0 GROUP BY address),
pins AS (SELECT DISTINCT snapshot_id FROM m WHERE block_number % 400 IN (3, 22)), stored AS (SELECT DISTINCT snapshot_id FROM m)
SELECT s.snapshot_id, CASE WHEN s.snapshot_id IN (FROM pins) AND s.snapshot_id NOT IN (SELECT snapshot_id FROM ready) THEN 'stop'
  WHEN s.snapshot_id IN (FROM pins) OR s.snapshot_id IN (FROM keepers) OR s.snapshot_id IN (FROM nw2) THEN 'keep' ELSE 'remove' END AS action,
  s.snapshot_id IN (FROM keepers) AS latest, s.snapshot_id IN (FROM nw2) AS newest_for_account, s.snapshot_id IN (FROM pins) AS pinned,
  s.snapshot_id NOT IN (SELECT snapshot_id FROM ready) AS unpublished FROM stored s""")
def retention_plan(spark, d):
    stored = members(spark, d)
    published = stored.where("block_number % 11 <> 0")
    pins = stored.where("block_number % 400 IN (3, 22)").select("snapshot_id")
    ready = published.select("snapshot_id", "block_number", "created_at").distinct()
    return R.retention_plan(ready, published, stored.select("snapshot_id"), pins, 7)


@query("history_floor", f"""WITH {MEMBERS} SELECT min(block_number) AS floor, count(DISTINCT snapshot_id) AS protected FROM m
WHERE address IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def history_floor(spark, d):
    selected = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("address"))
    return R.history_floor(members(spark, d), selected)


@query("history_plan", f"""WITH {EV}, b AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(number) AS first, max(number) AS last FROM ev GROUP BY 1),
x AS (SELECT max(number) AS tip, (SELECT max(number) FROM ev WHERE ts < TIMESTAMP '2024-01-16') AS floor FROM ev)
SELECT b.* FROM b, x WHERE last < least(floor + 1, greatest(tip - 29, 0))""")
def history_plan(spark, d):
    """Whole days that end below the bound set by the oldest kept checkpoint and the newest blocks."""
    blocks = events(spark, d).select("number", F.to_date("ts").cast("string").alias("day"), "ts")
    tip, floor = blocks.agg(F.max("number"), F.max(F.when(
        F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.col("number")))).first()
    return R.partitions_before(blocks, "day", R.remove_before(floor, tip, 30))


@query("generations_to_drop", f"WITH {MEMBERS} SELECT DISTINCT snapshot_id AS generation FROM m WHERE snapshot_id NOT IN (SELECT snapshot_id FROM newest)")
def generations_to_drop(spark, d):
    rows = members(spark, d)
    current = R.newest_per_account(rows).select(F.col("snapshot_id").alias("generation")).distinct()
    return R.generations_to_drop(rows.select(F.col("snapshot_id").alias("generation")), current)


@query("already_published", "SELECT DISTINCT c_custkey AS address FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def already_published(spark, d):
    published = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("address"))
    return R.already_published(table(spark, d, "customer").select(F.col("c_custkey").alias("address")), published)


@query("pins_report", f"""WITH {MEMBERS} SELECT CAST(o_orderkey AS VARCHAR) AS pin_id, strftime(o_orderdate, '%Y%m%d') AS snapshot_id,
  CAST(o_orderkey * 3 AS BIGINT) AS created_at, strftime(o_orderdate, '%Y%m%d') IN (SELECT snapshot_id FROM newest) AS newest FROM orders
WHERE o_orderpriority = '1-URGENT'""")
def pins_report(spark, d):
    """Pins by time, each with the standing of the snapshot it protects."""
    pins = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").cast("string").alias("pin_id"), F.date_format("o_orderdate", "yyyyMMdd").alias("snapshot_id"),
        (F.col("o_orderkey") * 3).alias("created_at"))
    newest = R.newest_per_account(members(spark, d)).select("snapshot_id").distinct().withColumn("newest", F.lit(True))
    return R.pins_report(pins.join(newest, "snapshot_id", "left").withColumn("newest", F.coalesce("newest", F.lit(False))))


# ---------------------------------------------------------------- pages

ONE = "0x" + "0" * 39 + "1"


@query("keyset_page", f"""WITH {EV}, w AS (SELECT DISTINCT address, slot FROM ch WHERE address = '{ONE}' AND slot > '0x{"0" * 62}20' ORDER BY slot LIMIT 11)
SELECT slot, replace(replace(to_base64(encode('{{"address":"{ONE}","after_slot":"' || slot || '","snapshot_id":"s","version":1}}')), '+', '-'), '/', '_') AS token FROM w""")
def keyset_page(spark, d):
    written = changes(spark, d).select("address", "slot", F.lit("").alias("value")).distinct()
    page = G.keyset_rows(written, ONE, "0x" + "0" * 62 + "20", 10)
    return page.select("slot", G.token_column(F.lit("s"), F.lit(ONE), F.col("slot")).alias("token"))


@query("account_lookup", f"{NONZERO} SELECT address, count(*) AS nonzero_slots FROM nz WHERE address = (SELECT min(address) FROM nz) GROUP BY address")
def account_lookup(spark, d):
    """The first account that holds anything, looked up by its address."""
    held = L.slot_counts(state(spark, d))
    return G.account_row(held, held.agg(F.min("address")).first()[0])


@query("sample_slots", f"{NONZERO} SELECT address, slot, value FROM nz ORDER BY address, slot LIMIT 50")
def sample_slots(spark, d):
    return G.sample_slots(state(spark, d), 50)


PAGES = f"""WITH {EV}, s AS (SELECT DISTINCT address, slot FROM ch),
n AS (SELECT address, slot, (row_number() OVER (PARTITION BY address ORDER BY slot) - 1) // 7 AS page FROM s),
pg AS (SELECT address, page, count(*) AS rows, min(slot) AS first_slot, max(slot) AS last_slot FROM n GROUP BY address, page)"""


def pages(spark, d):
    """All slots ever written, stored in key order as a checkpoint stores them, in pages of 7."""
    at = f"{shared_folder(spark)}/slots-{uuid.uuid4().hex}"
    store.write_sorted(changes(spark, d).select("address", "slot").distinct().withColumn("value", F.lit("")), at)
    return G.page_facts(G.stored_pages(spark.read.parquet(at), 7))


@query("page_chunks", f"{PAGES} SELECT * FROM pg")
def page_chunks(spark, d):
    return pages(spark, d)


@query("page_source", f"""{PAGES} SELECT address, slot, page FROM n WHERE page BETWEEN 1 AND 2""")
def page_source(spark, d):
    """Pages written by the page source in two commits, then some of them read back through pushed filters."""
    at = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    store.write_sorted(changes(spark, d).select("address", "slot").distinct().withColumn("value", F.lit("")), f"{at}/slots")
    numbered = G.stored_pages(spark.read.parquet(f"{at}/slots"), 7).select("page", "address", "slot", "value")
    P.register(spark)
    for part in (F.col("page") < 2, F.col("page") >= 2):
        numbered.where(part).repartitionByRange("page", "address").write.format(P.NAME).mode("append").save(f"{at}/pages")
    return spark.read.format(P.NAME).load(f"{at}/pages").where("page >= 1 AND page <= 2").select("address", "slot", "page")


@query("page_coverage", f"""{PAGES}, k AS (SELECT * FROM pg WHERE NOT (address LIKE '%3' AND page = 1)),
t AS (SELECT address, count(*) AS n, max(page) AS top, sum(rows) AS slots FROM k GROUP BY address),
a AS (SELECT address, count(*) AS declared FROM s WHERE address NOT LIKE '%5' GROUP BY address)
SELECT coalesce(t.address, a.address) AS address, 'unknown account' AS reason FROM t FULL JOIN a USING (address) WHERE declared IS NULL
UNION ALL SELECT address, 'page sequence' FROM t WHERE top + 1 <> n
UNION ALL SELECT address, 'slot count' FROM t FULL JOIN a USING (address) WHERE declared IS NOT NULL AND coalesce(slots, 0) <> declared""")
def page_coverage(spark, d):
    """Pages with a missing one per some accounts, against an account list without some others."""
    kept = pages(spark, d).where("NOT (address LIKE '%3' AND page = 1)")
    accounts = changes(spark, d).select("address", "slot").distinct().where("address NOT LIKE '%5'").groupBy(
        "address").agg(F.count("*").alias("nonzero_slots"))
    return G.coverage_defects(kept, accounts, 7)


# ---------------------------------------------------------------- quality

@query("quality_violations", f"""WITH r AS (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS nonce,
  CASE WHEN event_type = 'view' THEN '0' || event_id ELSE CAST(event_id AS VARCHAR) END AS exact,
  CASE WHEN event_type = 'click' THEN '0x12' ELSE '0x' || sha256(props) END AS code_hash FROM events)
SELECT event_id, 'required' AS rule FROM r WHERE nonce IS NULL
UNION ALL SELECT event_id, 'exact nonce' FROM r WHERE NOT regexp_matches(exact, '^(0|[1-9][0-9]*)$')
UNION ALL SELECT event_id, 'code hash' FROM r WHERE NOT regexp_matches(code_hash, '^0x[0-9a-f]{{64}}$')""")
def quality_violations(spark, d):
    kind, n = F.col("event_type"), F.col("event_id").cast("string")
    rows = table(spark, d, "events").select(
        "event_id", F.when(kind != "error", n).alias("nonce"),
        F.when(kind == "view", F.concat(F.lit("0"), n)).otherwise(n).alias("exact"),
        F.when(kind == "click", F.lit("0x12")).otherwise(F.concat(F.lit("0x"), F.sha2("props", 256))).alias("code_hash"))
    return Q.violations(rows, ["event_id"], {"required": F.col("nonce").isNotNull(), "exact nonce": X.is_exact_uint64("exact"),
                                             "code hash": X.is_fixed_hex("code_hash", 32)})


@query("snapshot_violations", f"""WITH {EV}, a AS (SELECT address, max(number) AS last_block, count(*) AS n FROM ev GROUP BY address)
SELECT 'account' AS kind, address, NULL AS slot, 'provenance' AS rule FROM a WHERE last_block > {"(SELECT max(number) FROM ev) - 1"}
UNION ALL SELECT 'account', address, NULL, 'required fields' FROM a WHERE address LIKE '%a'
UNION ALL SELECT 'storage', address, NULL, 'unknown account' FROM (SELECT DISTINCT address || 'ff' AS address FROM ev WHERE address LIKE '%1')
UNION ALL SELECT 'storage', address, slot, 'duplicate' FROM (SELECT address, slot FROM ch WHERE address NOT LIKE '%1' GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'storage', address, slot, 'duplicate' FROM (SELECT address || 'ff' AS address, slot FROM ch WHERE address LIKE '%1' GROUP BY ALL HAVING count(*) > 1)""")
def snapshot_violations(spark, d):
    """A snapshot with stale head, missing fields, orphaned and repeated slots."""
    ev = events(spark, d)
    head = ev.agg(F.max("number")).first()[0] - 1
    accounts = ev.groupBy("address").agg(F.max("number").alias("last_block"), F.count("*").cast("string").alias("nonce")).select(
        "address", "last_block", "nonce", F.when(~F.col("address").endswith("a"), F.lit("7")).alias("balance"),
        F.lit(X.EMPTY_CODE_HASH).alias("code_hash"), F.lit("0x").alias("code"))
    owner = F.when(F.col("address").endswith("1"), F.concat("address", F.lit("ff"))).otherwise(F.col("address"))
    every = ev.select(owner.alias("address"), F.lit(0).alias("n")).distinct()
    storage = changes(spark, d).select(owner.alias("address"), "slot", "value", F.lit(0).alias("last_block"))
    filler = every.select("address", F.lit(X.ZERO_WORD.replace("0x0", "0xf")).alias("slot"), F.lit(X.ZERO_WORD).alias("value"),
                          F.lit(0).alias("last_block"))
    return Q.snapshot_violations({"number": head}, accounts, storage.unionByName(filler))


@query("key_order_violations", """WITH o AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
  lag(l_linenumber) OVER (PARTITION BY l_suppkey ORDER BY l_partkey, l_orderkey, l_extendedprice, l_linenumber) AS p FROM lineitem)
SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM o WHERE l_linenumber <= p""")
def key_order_violations(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_extendedprice", "l_linenumber")
    return Q.order_violations(rows, ["l_suppkey"], ["l_partkey", "l_orderkey", "l_extendedprice", "l_linenumber"],
                              "l_linenumber").drop("l_extendedprice")


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return Q.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def proven(spark, d):
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    return orders.select(F.col("o_custkey").alias("address"), F.col("n").cast("decimal(20,0)").alias("nonce"),
                         F.col("cents").cast("string").alias("balance"))


@query("metadata_mismatch", """WITH p AS (SELECT o_custkey AS address, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1),
a AS (SELECT c_custkey AS address, n + CASE WHEN c_nationkey = 4 THEN 1 ELSE 0 END AS nonce,
  CASE WHEN c_nationkey = 5 THEN '0' || cents ELSE CAST(cents AS VARCHAR) END AS balance, c_nationkey FROM customer JOIN p ON c_custkey = address)
SELECT address, 'nonce' AS field FROM a WHERE c_nationkey = 4
UNION ALL SELECT address, 'balance' FROM a WHERE c_nationkey = 5
UNION ALL SELECT address, 'code' FROM a WHERE c_nationkey = 6
UNION ALL SELECT address, 'code_hash' FROM a WHERE c_nationkey = 7""")
def metadata_mismatch(spark, d):
    """Account rows against a second derivation, with four kinds of planted mistakes."""
    from chainfold.operators.proofs import metadata_mismatches
    want = proven(spark, d).withColumn("code_hash", F.lit(X.EMPTY_CODE_HASH))
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("address"), "c_nationkey")
    have = want.join(nation, "address").select(
        "address", (F.col("nonce") + F.when(F.col("c_nationkey") == 4, 1).otherwise(0)).cast("decimal(20,0)").alias("nonce"),
        F.when(F.col("c_nationkey") == 5, F.concat(F.lit("0"), "balance")).otherwise(F.col("balance")).alias("balance"),
        F.when(F.col("c_nationkey") == 7, F.lit(X.ZERO_WORD)).otherwise(F.col("code_hash")).alias("code_hash"),
        F.when(F.col("c_nationkey") == 6, F.lit("0x00")).otherwise(F.lit("0x")).alias("code"))
    return metadata_mismatches(have, want)


@query("sample_parity", f"""{NONZERO}, sm AS (SELECT * FROM nz ORDER BY address, slot LIMIT 200),
o AS (SELECT address, slot, arg_max(value, (number, ordinal)) AS value FROM ch GROUP BY address, slot)
SELECT CASE WHEN count(*) FILTER (WHERE sm.value <> o.value) = 0 THEN 'sample matches' ELSE 'sample differs' END AS status,
  count(*) AS slots_checked, count(*) FILTER (WHERE sm.value <> o.value) AS mismatches FROM sm JOIN o USING (address, slot)""")
def sample_parity(spark, d):
    return Q.sample_verdict(G.sample_slots(state(spark, d), 200), L.latest_slots(changes(spark, d)))


@query("account_digest", """WITH a AS (SELECT o_custkey AS address, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1),
h AS (SELECT substr(sha256(CAST(address AS VARCHAR)), 1, 6) AS leaf, sha256(address || '|=' || cents || '|=' || n) AS h FROM a),
l AS (SELECT leaf, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS h FROM h GROUP BY leaf),
b AS (SELECT substr(leaf, 1, 3) AS branch, sum(n) AS n, sha256(string_agg(leaf || h, '' ORDER BY leaf)) AS h FROM l GROUP BY 1)
SELECT sha256(string_agg(branch || h, '' ORDER BY branch)) AS accounts_sha256, CAST(sum(n) AS BIGINT) AS rows FROM b""")
def account_digest(spark, d):
    return D.account_digest(proven(spark, d).select(F.col("address").cast("string").alias("address"), "balance", "nonce"))


# ---------------------------------------------------------------- growth

@query("growth_record", """WITH g AS (SELECT event_id, user_id % 2 AS cohort, event_id // 40 AS generation, event_type = 'signup' AS phase,
  event_type <> 'error' AND user_id > 3 AND event_id % 120 - 20 BETWEEN 0 AND 60 AS counts FROM events),
c AS (SELECT *, lag(generation) OVER w AS pg, lag(phase) OVER w AS pp FROM g WHERE counts WINDOW w AS (PARTITION BY cohort ORDER BY event_id))
SELECT event_id, cohort, generation, phase FROM c WHERE pg IS NULL OR generation <> pg OR phase <> pp""")
def growth_record(spark, d):
    """A third of the samples is recorded, then all of them twice: the record is that of one run."""
    at, n = f"{shared_folder(spark)}/growth-{uuid.uuid4().hex}", F.col("event_id")
    samples = table(spark, d, "events").select(
        (F.col("user_id") % 2).alias("cohort"), n.alias("sample_finished_ns"), (F.col("event_type") == "signup").alias("phase"),
        F.expr("event_id div 40").alias("generation"), (F.col("event_type") != "error").alias("admitted"),
        F.when(F.col("user_id") > 3, F.col("user_id")).alias("accounted_allocated_bytes"))
    now = F.col("sample_finished_ns") + (F.col("sample_finished_ns") % 120 - 20) * 1_000_000_000
    third = samples.agg(F.max("sample_finished_ns")).first()[0] // 3
    for part in (samples.where(F.col("sample_finished_ns") <= third), samples, samples):
        W.record_growth(spark, at, part, now)
    schema = "cohort bigint, sample_finished_ns bigint, phase boolean, generation bigint"
    return W.recorded(spark, at, schema).select(F.col("sample_finished_ns").alias("event_id"), "cohort", "generation", "phase")
