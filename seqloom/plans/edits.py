"""Queries for scripts of edits, and for positions after merges and membership joins."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import catalog, edits, keyed
from seqloom.operators import positions as at
from seqloom.plans import inputs
from seqloom.plans.registry import query
from seqloom.selectors import POS

# --- scripts ------------------------------------------------------------------------------


def _script(count: int, seed: int = 11) -> list[tuple]:
    """A mixed list of edits near the front, the middle and the end, the same for each run."""
    rng, out = random.Random(seed), []
    for i in range(count):
        index = rng.choice([rng.randrange(0, 900), -rng.randrange(1, 900)])
        kind = ("remove_at", "remove_range", "insert", "remove_at", "reverse", "insert", "remove_range")[i % 7]
        width = rng.randrange(1, 20)
        out.append((kind, abs(index) if kind == "remove_range" else index, width))
    return out


def _script_sql(steps: list[tuple]) -> str:
    """The edits one after the other, each as a step over the whole sequence."""
    ctes = ["e0 AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders)"]
    batch = "SELECT -c_custkey AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS j, count(*) OVER () AS m FROM customer"
    for i, (kind, index, width) in enumerate(steps):
        size = f"(SELECT count(*) FROM e{i})"
        if kind == "remove_at":
            at_ = str(index) if index >= 0 else f"({size} + {index})"
            step = f"SELECT k, p - CASE WHEN {at_} >= 0 AND p > {at_} THEN 1 ELSE 0 END AS p FROM e{i} WHERE p <> {at_}"
        elif kind == "remove_range":
            last = index + width - 1
            step = f"SELECT k, p - CASE WHEN p > {last} THEN {width} ELSE 0 END AS p FROM e{i} WHERE p NOT BETWEEN {index} AND {last}"
        elif kind == "reverse":
            step = f"SELECT k, {size} - 1 - p AS p FROM e{i}"
        else:  # the batch is made of the customers of one nation
            some = f"({batch} WHERE c_nationkey = {width})"
            if index >= 0:
                start, clamped = f"least({index}, {size})", f"greatest({index} - {size}, 0)"
                place = f"CASE WHEN j < {clamped} THEN j ELSE {clamped} + m - 1 - j END"
            else:
                start, clamped = f"greatest(0, {size} + {index})", f"greatest({-index} - {size}, 0)"
                place = f"CASE WHEN j < {clamped} THEN m - 1 - j ELSE j - {clamped} END"
            step = f"""SELECT k, p + CASE WHEN p >= {start} THEN (SELECT count(*) FROM {some}) ELSE 0 END AS p FROM e{i}
              UNION ALL SELECT k, {start} + {place} FROM {some}"""
        ctes.append(f"e{i + 1} AS MATERIALIZED ({step})")
    return f"WITH {', '.join(ctes)} SELECT k, p AS _pos FROM e{len(steps)}"


SCRIPT = _script(50)


@query("edit_script", _script_sql(SCRIPT))
def edit_script(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty mixed edits on the orders, in one scan of them."""
    orders = inputs.orders_seq(spark, sf).select(F.col("o_orderkey").alias("k"), POS)
    customers = inputs.table(spark, sf, "customer").select("c_custkey", "c_nationkey")

    def edit(kind: str, index: int, width: int) -> edits.Edit:
        if kind == "insert":
            some = at.with_pos(customers.filter(F.col("c_nationkey") == width), "c_custkey")
            return edits.Insert(index, some.select((-F.col("c_custkey")).alias("k"), POS))
        if kind == "remove_range":
            return edits.RemoveRange(index, index + width - 1)
        return edits.Reverse() if kind == "reverse" else edits.RemoveAt(index)

    return edits.edit_script(orders, [edit(*step) for step in SCRIPT])


# --- chains after merges and membership joins -----------------------------------------------


@query(
    "upsert_then_reverse",
    """WITH stored AS (SELECT user_id, min(event_id) AS e, 0 AS late FROM events WHERE event_type = 'click' GROUP BY user_id),
    new AS (SELECT user_id, min(event_id) AS e, 1 AS late FROM events WHERE event_type <> 'click'
      AND user_id NOT IN (SELECT user_id FROM stored) GROUP BY user_id),
    merged AS (SELECT * FROM stored UNION ALL SELECT * FROM new)
    SELECT user_id, e AS event_id, row_number() OVER (ORDER BY late DESC, e DESC) - 1 AS _pos FROM merged""",
)
def upsert_then_reverse(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.events_in_order(spark, sf).select("user_id", "event_id", "event_type", POS)
    clicks = F.col("event_type") == "click"
    stored = at.compact(at.first_by_key(events.filter(clicks), "user_id"))
    merged = keyed.upsert_first_wins(stored, events.filter(~clicks), "user_id")
    return at.reverse(merged).select("user_id", "event_id", POS)


_RICH = "SELECT c_custkey FROM customer WHERE c_acctbal > 5000"


@query(
    "semi_then_element_at",
    f"""WITH kept AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS _pos, count(*) OVER () AS n
      FROM orders WHERE o_custkey IN ({_RICH}))
    SELECT o_orderkey, _pos FROM kept WHERE _pos IN (5, n - 2)""",
)
def semi_then_element_at(spark: SparkSession, sf: str) -> DataFrame:
    rich = inputs.table(spark, sf, "customer").filter("c_acctbal > 5000").selectExpr("c_custkey AS o_custkey")
    kept = catalog.semi_members(inputs.orders_seq(spark, sf, "o_custkey"), rich, "o_custkey").select("o_orderkey", POS)
    return at.element_at(kept, 5).unionByName(at.element_at(kept, -2))


@query(
    "new_only_then_insert",
    f"""WITH kept AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p
      FROM orders WHERE o_custkey NOT IN ({_RICH})), n AS (SELECT count(*) AS m FROM supplier)
    SELECT o_orderkey, CASE WHEN p >= 12 THEN p + m ELSE p END AS _pos FROM kept, n
    UNION ALL SELECT -s_suppkey, 12 + m - row_number() OVER (ORDER BY s_suppkey) FROM supplier, n""",
)
def new_only_then_insert(spark: SparkSession, sf: str) -> DataFrame:
    rich = inputs.table(spark, sf, "customer").filter("c_acctbal > 5000").selectExpr("c_custkey AS o_custkey")
    kept = catalog.new_only(inputs.orders_seq(spark, sf, "o_custkey"), rich, "o_custkey").select("o_orderkey", POS)
    batch = at.with_pos(inputs.table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    return at.insert_at(kept, 12, batch.select((-F.col("s_suppkey")).alias("o_orderkey"), POS))


@query(
    "children_then_index_of",
    """WITH kept AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) - 1 AS p FROM customer
      WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0))
    SELECT coalesce(min(p) FILTER (c_mktsegment = 'BUILDING' AND p >= 3), -1) AS index FROM kept""",
)
def children_then_index_of(spark: SparkSession, sf: str) -> DataFrame:
    customers = at.with_pos(inputs.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    parents = inputs.table(spark, sf, "supplier").filter("s_acctbal < 0").select("s_nationkey").distinct()
    return at.index_of(catalog.children_of_many(customers, "c_nationkey", parents), "c_mktsegment", "BUILDING", start=3)


@query(
    "replace_children_then_split",
    """WITH kept AS (SELECT c_custkey AS id, 0 AS late FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
      UNION ALL SELECT -s_suppkey, 1 FROM supplier)
    SELECT id, CAST(ntile(9) OVER (ORDER BY late, abs(id)) - 1 AS BIGINT) AS chunk FROM kept""",
)
def replace_children_then_split(spark: SparkSession, sf: str) -> DataFrame:
    customers = at.with_pos(inputs.table(spark, sf, "customer").selectExpr("c_custkey AS id"), "id")
    urgent = inputs.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr("o_custkey AS id")
    posted = at.with_pos(inputs.table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    posted = posted.select((-F.col("s_suppkey")).alias("id"), POS)
    return at.balanced_split(catalog.replace_children(customers, urgent, posted, "id"), 9).drop(POS)
