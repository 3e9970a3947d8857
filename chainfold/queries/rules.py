"""Persistence rules over orders and line items.

An order is a transaction (O succeeded, F failed, P reverted), a line item is one of its changes. The
lowest line is the root call, an ``R`` line sits in a reverted call, line status F means a gas reason.
Per-transaction facts are map-side combined minima joined back, so an order with most of the lines
is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chainfold.functions import scalars as X
from chainfold.functions.uint256 import bytes_to_decimal
from chainfold.operators import block_end as E, current_state as C, persistence as P
from chainfold.queries.base import query, sql_address, sql_word, table
from chainfold.sources.blocks import newest_versions

TX_SQL = """tx AS (SELECT o_orderkey, o_orderkey // 50 AS number, o_custkey,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS status, o_orderpriority = '1-URGENT' AS set_code FROM orders),
roots AS (SELECT l_orderkey, min(l_linenumber) AS root_line FROM lineitem GROUP BY l_orderkey),
li AS (SELECT tx.*, l.l_linenumber, l_partkey, l_suppkey, l_linenumber = root_line AS is_root, l_returnflag = 'R' AS reverted,
  CASE l_linestatus WHEN 'F' THEN 7 ELSE 5 END AS reason, CAST(round(l_discount * 100) AS BIGINT) AS old_cents,
  CAST(round(l_tax * 100) AS BIGINT) AS new_cents, l_linenumber AS ordinal
  FROM lineitem l JOIN tx ON l.l_orderkey = o_orderkey JOIN roots USING (l_orderkey))"""


def transactions(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return table(spark, d, "orders").select(
        "o_orderkey", F.expr("o_orderkey div 50").alias("number"), "o_custkey", status.alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("set_code"))


def lines(spark, d):
    item = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_returnflag") == "R").alias("reverted"),
        F.when(F.col("l_linestatus") == "F", 7).otherwise(5).alias("reason"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("old_cents"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("new_cents"))
    roots = item.groupBy("o_orderkey").agg(F.min("l_linenumber").alias("root_line"))
    return (item.join(transactions(spark, d), "o_orderkey").join(roots, "o_orderkey")
            .withColumn("is_root", F.col("l_linenumber") == F.col("root_line"))
            .withColumn("ordinal", F.col("l_linenumber").cast("bigint")).drop("root_line"))


def bytes_of(column: str):
    return F.unhex(F.lpad(F.hex(F.col(column)), 16, "0"))


SCOPE_SQL = "CASE scope WHEN 1 THEN 'tx' WHEN 2 THEN 'tx_failed_persistent' WHEN 3 THEN 'tx_7702' WHEN 4 THEN 'system_call' ELSE 'block' END"


@query("persisted_changes", f"""WITH {TX_SQL}, s AS (
  SELECT *, CASE WHEN status = 1 AND NOT reverted THEN 1 WHEN status <> 1 AND is_root AND reason = 7 THEN 2 END AS scope
  FROM li WHERE old_cents <> new_cents)
SELECT number, o_orderkey, ordinal, l_partkey, l_suppkey, {SCOPE_SQL} AS scope, status AS tx_status FROM s WHERE scope IS NOT NULL""")
def persisted_changes(spark, d):
    scope = P.balance_scope(F.col("status"), F.col("is_root"), F.col("reverted"), F.col("reason"))
    kept = lines(spark, d).where(P.number_changed(bytes_of("old_cents"), bytes_of("new_cents")))
    return kept.withColumn("code", scope).where("code IS NOT NULL").select(
        "number", "o_orderkey", "ordinal", "l_partkey", "l_suppkey", X.scope_name("code").alias("scope"),
        F.col("status").alias("tx_status"))


NESTED_SQL = f"""o AS (SELECT o_orderkey, o_orderkey // 50 AS number, o_custkey % 5 AS sender,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS status, o_orderpriority = '1-URGENT' AS set_code,
  CASE o_custkey % 10 WHEN 0 THEN 'system' WHEN 1 THEN 'block' ELSE 'tx' END AS part_of FROM orders),
c AS (SELECT o.*, l_linenumber AS line, l_returnflag = 'R' AS reverted, l_suppkey AS supp, l_partkey % 8 AS ordinal,
  l_partkey AS part, CASE l_linestatus WHEN 'F' THEN 7 ELSE 5 END AS reason, CAST(round(l_discount * 100) AS BIGINT) AS old,
  CAST(round(l_tax * 100) AS BIGINT) AS new,
  dense_rank() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_returnflag = 'R') - 1 AS call_index
  FROM lineitem JOIN o ON l_orderkey = o_orderkey),
a AS (SELECT DISTINCT o_orderkey, supp % 5 AS authority FROM c WHERE set_code AND line = 2 AND NOT reverted),
m AS (SELECT c.*, part_of = 'tx' AND status <> 1 AND call_index = 0 AS failed_root,
  part_of = 'tx' AND status <> 1 AND call_index = 0 AND authority IS NOT NULL AND ordinal BETWEEN 1 AND 3 AS early,
  CASE WHEN part_of = 'system' AND NOT reverted THEN 4 WHEN part_of = 'tx' AND status = 1 AND NOT reverted THEN 1 END AS live
  FROM c LEFT JOIN a ON c.o_orderkey = a.o_orderkey AND supp % 5 = authority),
n AS (SELECT *, CASE WHEN failed_root AND ordinal > 0 AND supp % 5 = sender AND old % 2 = 0 AND new % 3 = 1 THEN row_number() OVER (
  PARTITION BY o_orderkey, failed_root AND ordinal > 0 AND supp % 5 = sender AND old % 2 = 0 AND new % 3 = 1 ORDER BY ordinal) END AS step FROM m),
r AS (SELECT *, 'storage' AS kind, {sql_address('supp')} AS address, {sql_word('new')} AS value, live AS scope FROM n WHERE old <> new
  UNION ALL SELECT *, 'balances', {sql_address('supp')}, CAST(new AS VARCHAR), CASE WHEN part_of = 'block' THEN 5
    WHEN failed_root AND reason = 7 THEN 2 ELSE live END FROM n WHERE old <> new
  UNION ALL SELECT *, 'codes', {sql_address('supp % 5')}, {sql_word('new')}, CASE WHEN part_of = 'block' THEN 5
    WHEN early THEN 3 ELSE live END FROM n WHERE old <> new
  UNION ALL SELECT *, 'nonces', {sql_address('supp % 5')}, CAST(new % 3 AS VARCHAR), CASE WHEN step = 1 THEN 2
    WHEN early THEN 3 ELSE live END FROM n WHERE old % 2 <> new % 3)"""


def nested_blocks(spark, d):
    """Blocks of 50 orders: most orders are transactions, some are system calls, some block-level changes.

    The lines of one number and flag are a call with one change of each kind per line; line 2 also authorizes. A
    block is one row by its format, so its orders and lines are collected. Orders and lines meet in the order's block by one
    exchange of bare values; both groupings and the padded words of the format are made behind it.
    """
    from chainfold import schema as S
    sized = lambda c, digits: F.unhex(F.lpad(F.hex(c), digits, "0"))
    line = F.struct(F.col("l_linenumber").alias("line"), (F.col("l_returnflag") == "R").alias("reverted"),
                    F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
                    F.when(F.col("l_linestatus") == "F", 7).otherwise(5).alias("reason"),
                    F.round(F.col("l_discount") * 100).cast("bigint").alias("old"),
                    F.round(F.col("l_tax") * 100).cast("bigint").alias("new"))
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    order = F.struct("o_custkey", status.alias("status"), (F.col("o_orderpriority") == "1-URGENT").alias("set_code"))
    place = F.expr("o_orderkey div 50").alias("number")
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), line.alias("line"))
    both = items.select(place, "o_orderkey", "line").unionByName(
        table(spark, d, "orders").select(place, "o_orderkey", order.alias("order")), allowMissingColumns=True)
    orders = (both.repartition("number").groupBy("number", "o_orderkey").agg(
        F.sort_array(F.collect_list("line")).alias("lines"), F.collect_list("order").alias("orders"))
        .where((F.size("lines") > 0) & F.col("o_orderkey").isNotNull()).select("number", "o_orderkey", "lines", F.explode("orders").alias("order"))
        .select("number", "o_orderkey", "lines", "order.*"))
    blocks = orders.groupBy("number").agg(F.collect_list(F.struct("o_orderkey", "o_custkey", "status", "set_code", "lines")).alias("orders"))
    ordinal = lambda x: x["part"] % 8
    small = lambda x: sized(x["supp"] % 5, 40)
    balance = lambda x: F.struct(sized(x["supp"], 40), sized(x["old"], 16), sized(x["new"], 16), x["reason"], ordinal(x))
    code = lambda x: F.struct(small(x), sized(x["old"], 64), sized(x["new"], 64), sized(x["new"], 2), ordinal(x))
    storage = lambda x: F.struct(sized(x["supp"], 40), sized(x["part"], 64), sized(x["old"], 64), sized(x["new"], 64), ordinal(x))
    nonce = lambda x: F.struct(small(x), x["old"] % 2, x["new"] % 3, ordinal(x))

    def calls(o):
        def call(key, place):
            own = F.filter(o["lines"], lambda x: (x["line"] == key["line"]) & (x["reverted"] == key["reverted"]))
            return F.struct(place, F.lit(0), F.lit(1), F.lit(b""), key["reverted"], F.lit(False), F.lit(4), F.lit(1000),
                            *[F.transform(own, make) for make in (storage, balance, nonce, code)])
        return F.transform(F.array_distinct(F.transform(o["lines"], lambda x: F.struct(
            x["line"].alias("line"), x["reverted"].alias("reverted")))), call)

    def tx(o):
        grants = F.transform(F.filter(o["lines"], lambda x: x["line"] == 2),
                             lambda x: F.struct(small(x), sized(x["part"], 40), F.lit(0), x["reverted"]))
        return F.struct(sized(o["o_orderkey"], 64), o["o_orderkey"], F.when(o["set_code"], 4).otherwise(0),
                        o["status"], sized(o["o_custkey"] % 5, 40), F.lit(0), F.lit(1000), grants, calls(o))
    of = lambda test: F.filter("orders", lambda o: test(o["o_custkey"] % 10))
    outside = F.flatten(F.transform(of(lambda kind: kind == 1), lambda o: o["lines"]))
    parts = {"transaction_traces": F.transform(of(lambda kind: kind > 1), tx),
             "system_calls": F.flatten(F.transform(of(lambda kind: kind == 0), calls)),
             "balance_changes": F.transform(outside, balance), "code_changes": F.transform(outside, code)}
    word = sized(F.col("number"), 64)
    other = {"ver": F.lit(5), "detail_level": F.lit(0), "hash": word,
             "header": F.struct("number", word, word, word, F.struct(F.lit(1), F.lit(0))), **parts}
    return blocks.select(*[other.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.BLOCK.fields])


@query("nested_changes", f"""WITH {NESTED_SQL}
SELECT kind, number, CASE part_of WHEN 'tx' THEN o_orderkey ELSE 0 END AS tx_index, CASE part_of WHEN 'block' THEN 0 ELSE call_index END AS call_index,
  address, ordinal, value, {SCOPE_SQL} AS scope FROM r WHERE scope IS NOT NULL""")
def nested_changes(spark, d):
    """Every kind of change that survives, from whole nested blocks."""
    rows = P.tagged_changes(nested_blocks(spark, d))
    amount = bytes_to_decimal(F.when(F.col("kind") == "balances", F.col("new_bytes")))
    value = F.when(F.col("kind") == "balances", amount.cast("string")).when(
        F.col("kind") == "nonces", F.col("new_nonce").cast("string")).otherwise(X.hex_text("new_bytes"))
    return rows.select("kind", "number", "tx_index", "call_index", X.hex_text("address").alias("address"), "ordinal",
                       value.alias("value"), X.scope_name("scope").alias("scope"))


LIFE_SQL = f"""k AS (SELECT DISTINCT number, o_orderkey, call_index, o_orderkey % 40 + call_index % 2 AS a, (o_orderkey + call_index) % 3 = 0 AS made,
  (o_orderkey + call_index) % 4 = 0 AS destroys FROM c WHERE part_of = 'tx' AND status = 1 AND NOT reverted),
del AS (SELECT DISTINCT number, {sql_address('a')} AS address FROM k d WHERE destroys AND (number % 2 = 0 OR EXISTS (
  SELECT 1 FROM k x WHERE x.o_orderkey = d.o_orderkey AND x.made AND x.a = d.a))),
cl AS (SELECT DISTINCT number, {sql_address('o_orderkey % 40')} AS address, CASE WHEN set_code THEN 'deleted' WHEN o_orderkey % 2 = 0 THEN 'equal'
  ELSE 'different' END AS must FROM o),
bal AS (SELECT o_orderkey // 50 AS number, o_orderkey AS ordinal, {sql_address('o_custkey % 60')} AS address, CAST(CAST(round(o_totalprice) AS BIGINT) % 5 AS VARCHAR) AS balance FROM orders),
sd AS (SELECT cl.number, cl.address, cl.must, arg_max(balance, (bal.number, ordinal)) FILTER (WHERE bal.number < cl.number) AS before,
  arg_max(balance, (bal.number, ordinal)) AS after FROM cl LEFT JOIN bal ON bal.address = cl.address AND bal.number <= cl.number
  WHERE must <> 'deleted' GROUP BY ALL)"""


@query("lifecycle_audit", f"""WITH {NESTED_SQL}, {LIFE_SQL}
SELECT number, address, 'deleted but not declared' AS reason FROM del ANTI JOIN (SELECT * FROM cl WHERE must = 'deleted') q USING (number, address)
UNION ALL SELECT number, address, 'declared but not deleted' FROM cl ANTI JOIN del USING (number, address) WHERE must = 'deleted'
UNION ALL SELECT number, address, 'balance is not ' || must FROM sd WHERE (must = 'equal') = (before IS DISTINCT FROM after)""")
def lifecycle_audit(spark, d):
    """Nested blocks with creations and destroying calls on both sides of the fork, balances before and after, claims from the orders."""
    from chainfold.operators import lifecycle_audit as A
    key = lambda c: F.unhex(F.lpad(F.hex(c), 40, "0"))

    def call(tx, c):
        sum_ = tx["index"] + c["index"]
        return c.withField("suicide", sum_ % 4 == 0).withField("call_type", F.when(sum_ % 3 == 0, P.CREATE).otherwise(1)).withField(
            "address", key(tx["index"] % 40 + c["index"] % 2)).withField("end_ordinal", F.lit(900).cast("bigint"))
    blocks = nested_blocks(spark, d).withColumn("transaction_traces", F.transform("transaction_traces", lambda tx: tx.withField(
        "calls", F.transform(tx["calls"], lambda c: call(tx, c))))).withColumn("header", F.col("header").withField(
            "timestamp.seconds", F.lit(E.DELETION_FORK_TIME - 1) + F.col("number") % 2))
    place = F.expr("o_orderkey div 50").alias("number")
    claims = table(spark, d, "orders").select(
        place, X.number_word(F.col("o_orderkey") % 40, 40).alias("address"), F.lit("balance").alias("field"),
        F.when(F.col("o_orderpriority") == "1-URGENT", A.DELETED).when(F.col("o_orderkey") % 2 == 0, A.EQUAL).otherwise(A.DIFFERENT).alias("must"))
    rows = table(spark, d, "orders").select(
        place, F.col("o_orderkey").alias("ordinal"), X.number_word(F.col("o_custkey") % 60, 40).alias("address"),
        (F.round("o_totalprice").cast("bigint") % 5).cast("string").alias("balance"))
    return A.lifecycle_audit(blocks, rows, claims, ["balance"])


@query("sender_effects", f"""WITH {TX_SQL}, c AS (SELECT o_orderkey, min(ordinal) AS ordinal FROM li
  WHERE status <> 1 AND ordinal > 0 AND l_suppkey % 3 = o_custkey % 3 GROUP BY o_orderkey)
SELECT o_orderkey, ordinal, 'tx_failed_persistent' AS scope FROM c""")
def sender_effects(spark, d):
    """First nonce record of each failed transaction that matches its sender and nonce."""
    nonce = F.lit(0).cast("decimal(20,0)")
    step = P.is_sender_step(F.col("ordinal"), F.col("l_suppkey") % 3, nonce, nonce + 1, F.col("o_custkey") % 3, nonce)
    own = (lines(spark, d).where((F.col("status") != P.SUCCEEDED) & step)
           .groupBy("o_orderkey").agg(F.min("ordinal").alias("ordinal")))
    return own.select("o_orderkey", "ordinal", X.scope_name(F.lit(P.TX_FAILED)).alias("scope"))


@query("pre_execution_effects", f"""WITH {TX_SQL}, a AS (SELECT DISTINCT o_orderkey, l_suppkey % 5 AS authority FROM li
  WHERE set_code AND ordinal = 2 AND NOT reverted)
SELECT li.o_orderkey, li.ordinal, li.l_partkey, li.l_suppkey, 'tx_7702' AS scope FROM li JOIN a
  ON li.o_orderkey = a.o_orderkey AND li.l_suppkey % 5 = a.authority
WHERE status <> 1 AND ordinal > 0 AND ordinal < 4 AND old_cents <> new_cents""")
def pre_execution_effects(spark, d):
    """Applied authorities of failed SET_CODE transactions keep what precedes line 4."""
    rows = lines(spark, d).withColumn("authority", F.col("l_suppkey") % 5)
    granted = rows.where(F.col("set_code") & (F.col("ordinal") == 2) & ~F.col("reverted")).select(
        "o_orderkey", "authority").distinct().withColumn("granted", F.lit(True))
    marked = rows.join(granted, ["o_orderkey", "authority"], "left")
    scope = P.code_scope(F.col("status"), F.lit(True), F.lit(True), F.coalesce("granted", F.lit(False)),
                         F.col("ordinal"), F.lit(4))
    changed = P.value_changed(F.col("old_cents"), F.col("new_cents"))
    return marked.withColumn("code", scope).where(F.col("code").isNotNull() & changed).select(
        "o_orderkey", "ordinal", "l_partkey", "l_suppkey", X.scope_name("code").alias("scope"))


@query("system_and_block_effects", f"""WITH {TX_SQL}
SELECT o_orderkey, ordinal, l_partkey, l_suppkey, CASE WHEN c_nationkey = 0 THEN 'system_call' ELSE 'block' END AS scope
FROM li JOIN customer ON o_custkey = c_custkey
WHERE old_cents <> new_cents AND ((c_nationkey = 0 AND NOT reverted) OR c_nationkey = 1)""")
def system_and_block_effects(spark, d):
    """Customers of nation 0 act as system calls, those of nation 1 as block-level changes."""
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    changed = P.number_changed(bytes_of("old_cents"), bytes_of("new_cents"))
    rows = lines(spark, d).where(changed).join(nation, "o_custkey")
    scope = F.when((F.col("c_nationkey") == 0) & ~F.col("reverted"), P.SYSTEM).when(F.col("c_nationkey") == 1, P.BLOCK)
    return rows.withColumn("code", scope).where("code IS NOT NULL").select(
        "o_orderkey", "ordinal", "l_partkey", "l_suppkey", X.scope_name("code").alias("scope"))


@query("granular_order", f"""WITH {TX_SQL}
SELECT number, 'storage' AS kind, count(*) AS changes, min(ordinal) AS first, max(ordinal) AS last FROM li
  WHERE status = 1 AND NOT reverted AND old_cents <> new_cents GROUP BY number
UNION ALL SELECT number, 'code', count(*), min(ordinal), max(ordinal) FROM li
  WHERE status = 1 AND NOT reverted AND l_partkey % 2 = 0 GROUP BY number""")
def granular_order(spark, d):
    """Per block and kind: how many changes the granular stream holds and its ordinal range."""
    rows = lines(spark, d).withColumn("code", P.storage_scope(F.col("status"), F.col("reverted"))).where("code IS NOT NULL")
    kinds = F.array_compact(F.array(F.when(F.col("old_cents") != F.col("new_cents"), F.lit("storage")),
                                    F.when(F.col("l_partkey") % 2 == 0, F.lit("code"))))
    return rows.select("number", "ordinal", F.explode(kinds).alias("kind")).groupBy("number", "kind").agg(
        F.count("*").alias("changes"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))


@query("admission_violations", """SELECT o_orderkey AS number, reason FROM (
  SELECT o_orderkey, 'detail' AS reason FROM orders WHERE o_custkey % 7 = 0
  UNION ALL SELECT o_orderkey, 'producer' FROM orders WHERE o_orderkey % 5 NOT BETWEEN 1 AND 3
  UNION ALL SELECT o_orderkey, 'number' FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'status' FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey, 'timestamp' FROM orders WHERE o_totalprice < 20000)""")
def admission_violations(spark, d):
    """Orders as block headers; every broken admission rule is named."""
    from chainfold import schema as S
    key = F.col("o_orderkey")
    hash32 = F.unhex(F.sha2(key.cast("string"), 256))
    status = F.when(F.col("o_orderstatus") == "P", 9).otherwise(1)
    call = F.lit(None).cast(S.CALL)
    tx = F.struct(*[{"status": status, "calls": F.array(call)}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in S.TRANSACTION.fields])
    seconds = F.when(F.col("o_totalprice") < 20000, -1).otherwise(1)
    header = F.struct(F.when(F.col("o_orderpriority") == "1-URGENT", key + 1).otherwise(key).alias("number"),
                      hash32.alias("parent_hash"), hash32.alias("state_root"), hash32.alias("coinbase"),
                      F.struct(seconds.cast("bigint").alias("seconds"), F.lit(0).alias("nanos")).alias("timestamp"))
    blocks = table(spark, d, "orders").select(
        (key % 5 + 2).cast("int").alias("ver"), F.when(F.col("o_custkey") % 7 == 0, 2).otherwise(0).alias("detail_level"),
        key.alias("number"), hash32.alias("hash"), header.alias("header"), F.array(tx).alias("transaction_traces"))
    return P.admission_violations(blocks)


@query("block_summary_counts", """SELECT o_orderkey AS number, o_custkey, count(l_orderkey) FILTER (WHERE l_returnflag = 'N') AS storage_changes,
  count(l_orderkey) FILTER (WHERE l_returnflag = 'A') AS balance_changes, count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS nonce_changes
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey""")
def block_summary_counts(spark, d):
    kind = F.when(F.col("l_returnflag") == "N", "storage").when(F.col("l_returnflag") == "A", "balance").otherwise("nonce")
    changed = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("number"), kind.alias("kind"))
    blocks = table(spark, d, "orders").select(F.col("o_orderkey").alias("number"), "o_custkey")
    return C.summarize_blocks(blocks, changed, ["storage", "balance", "nonce"])


def building(spark, d):
    """Account lists as written by people: mixed case, optional prefix, several per line."""
    customer = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    text = F.concat(F.lit(" 0X"), F.upper(F.lpad(F.hex("c_custkey"), 40, "0")), F.lit(",\n"),
                    F.lower(F.lpad(F.hex(F.col("c_nationkey") + 1000000), 40, "0")))
    return P.account_rows(customer.select(text.alias("accounts")))


ACCOUNTS_SQL = f"""acc AS (SELECT DISTINCT address FROM (SELECT {sql_address('c_custkey')} AS address FROM customer
  WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT {sql_address('c_nationkey + 1000000')} FROM customer
  WHERE c_mktsegment = 'BUILDING'))"""


@query("parsed_accounts", f"WITH {ACCOUNTS_SQL} SELECT * FROM acc")
def parsed_accounts(spark, d):
    return building(spark, d)


@query("account_filter", f"""WITH {ACCOUNTS_SQL} SELECT o_orderkey, {sql_address('o_custkey')} AS address FROM orders
WHERE {sql_address('o_custkey')} IN (SELECT address FROM acc)""")
def account_filter(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", X.number_word("o_custkey", 40).alias("address"))
    return P.of_accounts(rows, building(spark, d))


GRANTS_SQL = f"""g AS (SELECT number, o_orderkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY reverted, part, supp, reason, old, new) - 1 AS auth_index,
  {sql_address('supp % 5')} AS authority, {sql_address('part')} AS delegate, reverted AS discarded FROM c WHERE set_code AND part_of = 'tx' AND line = 2)"""


@query("authorization_rows", f"""WITH {NESTED_SQL}, {GRANTS_SQL}, {ACCOUNTS_SQL}
SELECT * FROM g WHERE authority IN (SELECT address FROM acc) OR delegate IN (SELECT address FROM acc)""")
def authorization_rows(spark, d):
    """SET_CODE entries of nested blocks, kept when the authority or the delegate is in a table of accounts."""
    rows = P.authorizations_of(nested_blocks(spark, d), building(spark, d))
    return rows.select("number", F.col("tx_index").alias("o_orderkey"), "auth_index", X.hex_text("authority").alias("authority"),
                       X.hex_text("delegate").alias("delegate"), "discarded")


@query("account_table_changes", f"""WITH {NESTED_SQL}, {ACCOUNTS_SQL}
SELECT kind, number, CASE part_of WHEN 'tx' THEN o_orderkey ELSE 0 END AS tx_index, address, ordinal, {SCOPE_SQL} AS scope
FROM r WHERE scope IS NOT NULL AND address IN (SELECT address FROM acc)""")
def account_table_changes(spark, d):
    """What persisted of the accounts of a table, from whole nested blocks: a bitmap in the row, then the exact join."""
    rows = P.tagged_changes(nested_blocks(spark, d), building(spark, d))
    return rows.select("kind", "number", "tx_index", X.hex_text("address").alias("address"), "ordinal", X.scope_name("scope").alias("scope"))


@query("event_log_buckets", """SELECT event_id - event_id % 1000 AS block_bucket, CAST(strftime(ts, '%Y%m') AS INTEGER) AS month,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM events GROUP BY 1, 2, 3""")
def event_log_buckets(spark, d):
    """Retried rows collapse on (block, ordinal) and land in their range partition."""
    ev = table(spark, d, "events").select(F.col("event_id").alias("number"), F.lit(0).alias("ordinal"), "ts", "user_id")
    log = C.deduplicated_log(ev.unionByName(ev), ["number", "ordinal"])
    stamp = F.unix_seconds(F.col("ts").cast("timestamp"))
    return log.groupBy(C.block_bucket(1000).alias("block_bucket"), X.month_partition("ts").alias("month"),
                       X.day_partition(stamp).cast("string").alias("day")).agg(F.count("*").alias("rows"))


@query("partition_plan", """WITH b AS (SELECT range AS lo FROM range(0, (SELECT max(event_id) + 1 FROM events), 1000))
SELECT l.log, lo AS from_block, lo + 1000 AS to_block, l.log || '_p' || lo AS partition FROM b,
(VALUES ('storage_changes'), ('balance_changes'), ('nonce_changes'), ('code_changes'), ('set_code_authorizations')) l(log)""")
def partition_plan(spark, d):
    ev = table(spark, d, "events")
    return C.partition_plan(ev, 1000, 0, ev.agg(F.max("event_id") + 1).first()[0])


@query("missing_partitions", """SELECT DISTINCT event_id - event_id % 1000 AS from_block FROM events
WHERE (event_id - event_id % 1000) // 1000 % 3 = 0""")
def missing_partitions(spark, d):
    ev = table(spark, d, "events").select(F.col("event_id").alias("number"))
    existing = ev.select(C.block_bucket(1000).alias("from_block")).where("from_block div 1000 % 3 <> 0").distinct()
    return C.missing_partitions(ev, existing, 1000)


@query("execution_context", """WITH c AS (SELECT conv_id, turn, role = 'assistant' OR turn % 4 = 2 AS delegated FROM conversations)
SELECT conv_id AS tx, turn AS "index", last_value(CASE WHEN NOT delegated THEN turn END IGNORE NULLS)
  OVER (PARTITION BY conv_id ORDER BY turn) AS account FROM c""")
def execution_context(spark, d):
    calls = table(spark, d, "conversations").select(
        F.col("conv_id").alias("tx"), F.col("turn").alias("index"),
        F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent_index"),
        ((F.col("role") == "assistant") | (F.col("turn") % 4 == 2)).alias("delegated"), F.col("turn").alias("address"))
    return E.execution_accounts(calls)


@query("retry_dedup", """SELECT l_orderkey, l_linenumber, arg_max(v, v).l_partkey AS l_partkey, max(v).l_suppkey AS l_suppkey, max(v).cents AS cents
FROM (SELECT l_orderkey, l_linenumber, {'cents': CAST(round(l_extendedprice * 100) AS BIGINT), 'l_partkey': l_partkey,
  'l_suppkey': l_suppkey, 'l_returnflag': l_returnflag} AS v FROM lineitem) GROUP BY l_orderkey, l_linenumber
HAVING max(v).l_returnflag <> 'R'""")
def retry_dedup(spark, d):
    """Line items repeat their key: the newest version wins and deleted keys vanish."""
    version = F.struct(F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"), "l_partkey", "l_suppkey",
                       "l_returnflag")
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", version.alias("_version_"), version.alias("v"),
        (F.col("l_returnflag") == "R").alias("_deleted_"))
    newest = newest_versions(rows, ("l_orderkey", "l_linenumber"))
    return newest.select("l_orderkey", "l_linenumber", "v.l_partkey", "v.l_suppkey", "v.cents")


@query("deduplicated_log", """SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL""")
def deduplicated_log(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return C.deduplicated_log(rows, ["l_orderkey", "l_linenumber"])
