"""Stays that are orders: the customer is the subject, line items are the children.

Return flags stand for the sections; a line appears on its ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions import text
from chronoweave.functions.tokens import PatternTokenizer
from chronoweave.operators.aggregates import nest_children, pivot_first, spread_attributes, symmetric_difference
from chronoweave.operators.columns import (
    drop_unset, first_set, not_denied, null_second_if_both, recode, trimmed, whole_days,
)
from chronoweave.operators.joins import enrich, first_seen, full_merge, keep_if_listed, look_up, not_in, restrict
from chronoweave.operators.ordered import first_by
from chronoweave.plans.cohort import clean_and_bad, missing_children
from chronoweave.plans.records import stay_records
from chronoweave.plans.snapshots import stay_cuts
from chronoweave.plans.targets import answer_texts, change_groups, change_rows, next_changes
from chronoweave.plans.timeline import event_rows, section_rows, snapshot_times, union_rows
from chronoweave.session import stage
from chronoweave.sources.paging import batches, keyset_page, offset_page, page_count
from chronoweave.sources.relational import spread
from chronoweave.spec import Section, Wording
from workload.base import query, table

TOKENIZER = PatternTokenizer()
WORDING = Wording()
LINES = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
FLAGS = {"A": "accepted lines", "N": "new lines", "R": "returned lines"}


LINE_SECTION = Section(
    "lines", "records", ("item", "brand", "quantity", "shipped"), time="shipped",
    tie=("line", "part", "supplier", "cents"), spine=True, target=True, hidden=("shipped",),
)


def rows_of(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows and line rows; the dictionary is the part table."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("stay_id"), F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("event_t"),
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("part"), F.col("p_name").alias("item"), F.col("p_brand").alias("brand")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("stay_id"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_shipdate").alias("shipped"),
        (F.col("l_extendedprice") * 100).cast("bigint").alias("cents"), "l_returnflag",
    )
    lines = enrich(look_up(spread(lines), orders, ["stay_id"]), parts, ["part"])
    flags = list(FLAGS)
    name = recode("l_returnflag", FLAGS)
    order = F.array_position(F.array(*[F.lit(f) for f in flags]), F.col("l_returnflag")).cast("int") - 1
    heads = event_rows(orders, TOKENIZER, event_type="Order", rank=0, spine=True)
    return union_rows([heads, section_rows(lines, LINE_SECTION, order, TOKENIZER, rank=0, name=name)])


NEXT_SQL = """
WITH sec AS (
  SELECT l_orderkey AS stay_id, l_shipdate AS t,
    CASE l_returnflag WHEN 'A' THEN 'accepted lines' WHEN 'N' THEN 'new lines' ELSE 'returned lines' END AS section,
    p_name AS item, p_brand AS brand, CAST(l_quantity AS INTEGER) AS quantity,
    row(l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_extendedprice * 100) AS BIGINT)) AS tie
  FROM lineitem JOIN part ON p_partkey = l_partkey),
spine AS (
  SELECT o_orderkey AS stay_id, o_orderdate AS t FROM orders
  UNION SELECT stay_id, t FROM sec JOIN orders ON o_orderkey = stay_id AND t >= o_orderdate),
plain AS (SELECT stay_id, section, t, item, brand, quantity, min(tie) AS tie FROM sec GROUP BY ALL),
listed AS (
  SELECT *, row_number() OVER (PARTITION BY stay_id, section, t ORDER BY tie) AS i,
    count(*) OVER (PARTITION BY stay_id, section, t) AS n FROM plain),
printed AS (
  SELECT *, '   - item: ' || item || chr(10) || '   - brand: ' || brand || chr(10) || '   - quantity: ' || quantity || chr(10) AS line
  FROM listed),
answers AS (
  SELECT stay_id, section, t AS next_t, any_value(n) AS n_rows,
    'Potential ' || section || ':' || chr(10) || string_agg(' - ' || i || ' of ' || n || chr(10) || line, '' ORDER BY i) AS answer
  FROM printed GROUP BY stay_id, section, t),
nexts AS (
  SELECT p.stay_id, p.t, g.section, min(g.t) AS next_t
  FROM spine p JOIN sec g ON g.stay_id = p.stay_id AND g.t > p.t GROUP BY p.stay_id, p.t, g.section)
SELECT n.stay_id, n.t, n.section, n.next_t, a.n_rows, a.answer FROM nexts n JOIN answers a USING (stay_id, section, next_t)
"""


@query("next_event_targets", NEXT_SQL)
def next_event_targets(spark, sf):
    rows = stage(rows_of(spark, sf).select(
        "stay_id", "event_t", "section", "kind", "t", "t_eff", "t_end", "tie", "line_full", "answer", "answer_size", "spine", "target"
    ))
    changes = change_rows(rows)
    found = stage(next_changes(snapshot_times(rows), change_groups(changes), list(FLAGS.values()), stay_cuts(rows)))
    texts = answer_texts(changes, found, WORDING)
    return found.join(texts, ["stay_id", "section", "next_t"], "left").select(
        "stay_id", "t", "section", "next_t", "n_rows", "answer"
    )


# --- records ---------------------------------------------------------------------------------

RECORDS = {
    "A": Section("accepted", "records", ("l_linenumber", "l_partkey"), time="l_shipdate", tie=("l_linenumber",)),
    "N": Section("open", "records", ("l_partkey", "l_quantity"), time="l_shipdate", tie=("l_partkey",)),
    "R": Section("returned", "records", ("l_suppkey", "l_partkey", "l_linenumber"), tie=("l_suppkey",)),
}


@query(
    "stay_record",
    """WITH line AS (
  SELECT l_orderkey AS o_orderkey, 'accepted' AS section, l_linenumber || ':' || l_partkey AS record,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) - 1 AS n FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT l_orderkey, 'open', l_partkey || ':' || CAST(l_quantity AS INTEGER),
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_quantity) - 1 FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL SELECT l_orderkey, 'returned', l_suppkey || ':' || l_partkey || ':' || l_linenumber,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_partkey, l_linenumber) - 1 FROM lineitem WHERE l_returnflag = 'R'),
lists AS (SELECT o_orderkey, n // 2 AS part, section, string_agg(record, ' ' ORDER BY n) AS body FROM line GROUP BY 1, 2, 3),
parts AS (
  SELECT o_orderkey, part, max(body) FILTER (WHERE section = 'accepted') AS accepted, max(body) FILTER (WHERE section = 'open') AS open,
    max(body) FILTER (WHERE section = 'returned') AS returned FROM lists GROUP BY 1, 2)
SELECT o.o_orderkey, o.o_custkey, coalesce(part, 0) AS part, coalesce(accepted, '') AS accepted, coalesce(open, '') AS open,
  coalesce(returned, '') AS returned FROM orders o LEFT JOIN parts USING (o_orderkey)""",
)
def stay_record(spark, sf):
    """Orders with three child lists of different fields, two records to a part."""
    lines = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("int")).withColumnRenamed("l_orderkey", "o_orderkey")
    children = [(section, lines.where(F.col("l_returnflag") == flag)) for flag, section in RECORDS.items()]
    nested = stay_records(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), children, "o_orderkey", part_rows=2)

    def body(section: Section):
        shown = F.transform(section.name, lambda r: F.concat_ws(":", *[r[f].cast("string") for f in section.fields]))
        return F.array_join(shown, " ").alias(section.name)

    return nested.select("o_orderkey", "o_custkey", "part", *[body(s) for s in RECORDS.values()])


# --- predicates ------------------------------------------------------------------------------


@query(
    "length_of_stay",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(datediff('day', o_orderdate, l_shipdate) AS BIGINT) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 7 DAY""",
)
def length_of_stay(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = look_up(table(spark, sf, "lineitem"), orders, ["l_orderkey"])
    days = whole_days("o_orderdate", "l_shipdate").cast("bigint")
    return joined.where((F.col("l_shipdate") >= F.col("o_orderdate")) & (days < 7)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", days.alias("days")
    )


@query(
    "deny_filter",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, trim('  ' || o_orderstatus || ' ') AS status FROM orders
WHERE coalesce(nullif(o_orderpriority, '5-LOW') NOT IN ('1-URGENT', '2-HIGH'), true)""",
)
def deny_filter(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("status"),
    )
    kept = orders.where(not_denied("priority", ["1-URGENT", "2-HIGH"]))
    return kept.withColumn("status", trimmed("status"))


# --- joins -----------------------------------------------------------------------------------


@query(
    "dictionary_enrich",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p_name, p_brand, s_name FROM lineitem
LEFT JOIN part ON p_partkey = l_partkey AND p_size < 25 LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
def dictionary_enrich(spark, sf):
    parts = table(spark, sf, "part").where("p_size < 25").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = enrich(enrich(lines, parts, ["l_partkey"]), suppliers, ["l_suppkey"])
    return named.select("l_orderkey", "l_linenumber", "l_suppkey", "p_name", "p_brand", "s_name")


@query(
    "ordered_codes",
    """WITH first AS (
  SELECT l_orderkey, l_partkey, min(l_linenumber) AS seq FROM lineitem GROUP BY l_orderkey, l_partkey),
named AS (SELECT f.*, p_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY seq, l_partkey) AS rn
  FROM first f JOIN part ON p_partkey = l_partkey AND p_size < 40)
SELECT l_orderkey, (rn - 1) // 4 AS part, string_agg(p_name, ', ' ORDER BY rn) AS names, count(*) AS n_rows
FROM named GROUP BY l_orderkey, (rn - 1) // 4""",
)
def ordered_codes(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("seq"))
    codes = first_by(lines, ["l_orderkey", "l_partkey"], ["seq"])
    titles = table(spark, sf, "part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    named = look_up(codes, titles, ["l_partkey"])
    lists = nest_children(
        named, ["l_orderkey"], ["seq", "l_partkey"], ["p_name"], part_rows=4,
    )
    return lists.select(
        "l_orderkey", "part", F.array_join(F.transform("rows", lambda r: r["p_name"]), ", ").alias("names"), "n_rows"
    )


MERGE_SQL = """WITH rx AS (
  SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS order_id, l_partkey AS drug,
    CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS start_t FROM lineitem),
poe AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS kind,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS order_t FROM orders
  WHERE o_orderpriority <> '1-URGENT' OR o_orderkey IN (SELECT order_id FROM rx WHERE order_id IS NOT NULL)),
merged AS (
  SELECT order_id, drug, kind, start_t, CASE WHEN start_t IS NULL THEN order_t END AS order_t
  FROM (SELECT * FROM rx WHERE order_id IS NOT NULL) FULL JOIN poe USING (order_id))
SELECT *, coalesce(start_t, order_t) AS sort_t FROM merged WHERE start_t IS NOT NULL OR order_t IS NOT NULL"""


@query("orders_merge", MERGE_SQL)
def orders_merge(spark, sf):
    rx = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("order_id"),
        F.col("l_partkey").alias("drug"),
        F.when(F.col("l_returnflag") != "A", F.col("l_shipdate")).alias("start_t"),
    )
    poe = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("kind"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("order_t"),
    )
    poe = keep_if_listed(poe, F.col("kind") == "1-URGENT", rx, "order_id")
    merged = full_merge(rx.where("order_id IS NOT NULL"), poe, ["order_id"])
    merged = merged.withColumn("order_t", null_second_if_both("start_t", "order_t"))
    merged = drop_unset(merged, ["start_t", "order_t"], how="all")
    return merged.withColumn("sort_t", first_set("start_t", "order_t"))


@query(
    "attribute_spread",
    """WITH d AS (SELECT l_orderkey, CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS f, CAST(l_quantity AS INTEGER) AS v FROM lineitem)
SELECT o_orderkey, CASE WHEN f = 'A' THEN v END AS a, CASE WHEN f = 'N' THEN v END AS n, CASE WHEN f = 'R' THEN v END AS r
FROM orders LEFT JOIN d ON l_orderkey = o_orderkey""",
)
def attribute_spread(spark, sf):
    details = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_linestatus") == "O", F.lower("l_returnflag")).alias("field_name"),
        F.col("l_quantity").cast("int").alias("field_value"),
    )
    attached = enrich(table(spark, sf, "orders").select("o_orderkey"), details, ["o_orderkey"])
    return spread_attributes(attached, "field_name", "field_value", ["a", "n", "r"])


@query(
    "pivot_first",
    """WITH p AS (
  SELECT l_orderkey, l_suppkey,
    min_by(CAST(l_quantity AS INTEGER), (l_linenumber, l_partkey, l_extendedprice)) FILTER (l_returnflag = 'A') AS first_a,
    min_by(CAST(l_quantity AS INTEGER), (l_linenumber, l_partkey, l_extendedprice)) FILTER (l_returnflag = 'N') AS first_n
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_partkey, CASE l_linestatus WHEN 'O' THEN 'open' END AS status,
  p.first_a, p.first_n FROM lineitem l LEFT JOIN p ON p.l_orderkey = l.l_orderkey AND p.l_suppkey = l.l_suppkey""",
)
def pivot_first_query(spark, sf):
    lines = table(spark, sf, "lineitem")
    details = lines.where("l_returnflag <> 'R'").withColumns(
        {"name": F.concat(F.lit("first_"), F.lower("l_returnflag")), "q": F.col("l_quantity").cast("int")}
    )
    wide = pivot_first(
        details, ["l_orderkey", "l_suppkey"], "name", "q", ["first_a", "first_n"],
        ["l_linenumber", "l_partkey", "l_extendedprice"],
    )
    joined = enrich(lines, wide, ["l_orderkey", "l_suppkey"])
    return joined.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", recode("l_linestatus", {"O": "open"}).alias("status"),
        "first_a", "first_n",
    )


@query(
    "first_seen_items",
    """WITH items AS (
  SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN l_partkey % 10 <> 0 THEN l_partkey % 50 END AS item, l_linenumber, l_partkey, l_suppkey
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
ranked AS (SELECT *, min((o_orderdate, o_orderkey)) OVER (PARTITION BY o_custkey, item) AS first_event FROM items)
SELECT o_custkey, o_orderkey, item, l_linenumber, l_partkey, l_suppkey FROM ranked WHERE first_event = (o_orderdate, o_orderkey)""",
)
def first_seen_items(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey") % 50).alias("item"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.struct("o_orderdate", "o_orderkey").alias("event")
    )
    kept = first_seen(look_up(lines, orders, ["o_orderkey"]), ["o_custkey"], "item", "event")
    return kept.select("o_custkey", "o_orderkey", "item", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "dedupe_keep_first",
    """SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dedupe_keep_first(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", *LINES, F.col("l_quantity").cast("int").alias("quantity"))
    return first_by(lines, ["l_orderkey", "l_returnflag"], list(LINES)).drop("l_extendedprice")


@query(
    "nested_children",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem),
g AS (SELECT l_orderkey, (rn - 1) // 5 AS part, count(*) AS n_rows, string_agg(l_linenumber || ':' || l_partkey, ' ' ORDER BY rn) AS body
  FROM r GROUP BY 1, 2)
SELECT o_orderkey, o_custkey, part, n_rows, body FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""",
)
def nested_children(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", *LINES)
    nested = nest_children(
        lines, ["o_orderkey"], ["l_shipdate", *LINES], ["l_linenumber", "l_partkey"], part_rows=5,
    )
    stays = enrich(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), nested, ["o_orderkey"])
    body = F.transform("rows", lambda r: F.concat_ws(":", r["l_linenumber"].cast("string"), r["l_partkey"].cast("string")))
    return stays.select("o_orderkey", "o_custkey", "part", "n_rows", F.array_join(body, " ").alias("body"))


@query(
    "symmetric_diff",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-01-01'),
b AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-07-01')
SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
GROUP BY l_orderkey, l_partkey, l_quantity HAVING count(*) = 1""",
)
def symmetric_diff(spark, sf):
    lines = table(spark, sf, "lineitem")
    known = lambda day: lines.where(F.col("l_shipdate") <= F.lit(day).cast("timestamp_ntz")).select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("quantity")
    )
    return symmetric_difference(known("1998-01-01"), known("1998-07-01"))


# --- incremental work, quarantine, paging ------------------------------------------------------


@query(
    "incremental_todo",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def incremental_todo(spark, sf):
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return not_in(table(spark, sf, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query(
    "quarantine",
    """WITH s AS (SELECT o.*, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') AS alone FROM orders o)
SELECT o_orderkey, 'no accepted line' AS reason FROM s WHERE alone
UNION ALL SELECT o_orderkey, 'status P' FROM s WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'no time' FROM s WHERE o_orderdate IS NULL""",
)
def quarantine_query(spark, sf):
    accepted = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    stays = missing_children(table(spark, sf, "orders"), accepted, "o_orderkey", "alone")
    rules = {
        "no accepted line": F.col("alone"),
        "status P": F.col("o_orderstatus") == "P",
        "no time": F.col("o_orderdate").isNull(),
    }
    return clean_and_bad(stays, "o_orderkey", rules)[1]


@query(
    "usable_stays",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderstatus <> 'P'
AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')""",
)
def usable_stays(spark, sf):
    accepted = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    stays = missing_children(table(spark, sf, "orders"), accepted, "o_orderkey", "alone")
    rules = {"no accepted line": F.col("alone"), "status P": F.col("o_orderstatus") == "P"}
    return clean_and_bad(stays, "o_orderkey", rules)[0].select("o_orderkey", "o_custkey")


@query("page_offset", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def page_offset(spark, sf):
    return offset_page(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 500, 1000)


@query("page_keyset", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 500")
def page_keyset(spark, sf):
    return keyset_page(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 700, 500)


@query(
    "fetch_ids",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)",
)
def fetch_ids(spark, sf):
    ids = table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return restrict(table(spark, sf, "orders"), ids, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "batches",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 128 AS batch FROM orders""",
)
def batches_query(spark, sf):
    return batches(table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 128).drop(
        "o_orderdate"
    )


@query("counts", "SELECT count(*) AS n_rows, CAST(ceil(count(*) / 128.0) AS BIGINT) AS n_pages FROM orders")
def counts(spark, sf):
    return page_count(table(spark, sf, "orders"), 128)


@query(
    "clean_records",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'status=' || o_orderstatus || ';' ELSE '' END || 'customer=' || o_custkey AS fields
FROM orders""",
)
def clean_records(spark, sf):
    """Records as maps of their non-null fields."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("F")).alias("status")
    )
    record = text.clean_record([("status", F.col("status")), ("customer", F.col("o_custkey"))])
    pairs = F.transform(F.map_entries(record), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return orders.select("o_orderkey", F.array_join(pairs, ";").alias("fields"))
