"""Queries for positions, edits by position, cuts, bags and keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import aggregates, bags, keyed, sequence
from seqloom.operators import positions as at
from seqloom.plans import inputs
from seqloom.plans.inputs import ORDERS_SEQ
from seqloom.plans.registry import query
from seqloom.selectors import POS

@query("with_pos", f"WITH {ORDERS_SEQ} SELECT o_orderkey, o_custkey, _pos FROM orders_seq")
def with_pos(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.orders_seq(spark, sf, "o_custkey")


@query(
    "with_pos_any_order",
    """SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS _pos
    FROM orders""",
)
def with_pos_any_order(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return at.with_pos(orders, ["o_orderpriority", "o_orderkey"])


@query(
    "with_pos_by_group",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS _pos FROM conversations",
)
def with_pos_by_group(spark: SparkSession, sf: str) -> DataFrame:
    turns = inputs.table(spark, sf, "conversations").select("conv_id", "turn")
    return at.with_pos(turns, "turn", by="conv_id")


@query(
    "with_pos_large_groups",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1
    AS _pos FROM orders""",
)
def with_pos_large_groups(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return at.with_pos(orders, "o_orderkey", by="o_orderstatus")


@query(
    "with_pos_large_groups_any_order",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() OVER (
      PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS _pos
    FROM lineitem""",
)
def with_pos_large_groups_any_order(spark: SparkSession, sf: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = inputs.table(spark, sf, "lineitem").select(*order, "l_returnflag")
    return at.with_pos(lines, order, by="l_returnflag")


# --- reading by position -------------------------------------------------------------


@query("element_at", f"WITH {ORDERS_SEQ} SELECT o_orderkey, o_totalprice, _pos FROM orders_seq WHERE _pos = 42")
def element_at(spark: SparkSession, sf: str) -> DataFrame:
    return at.element_at(inputs.orders_seq(spark, sf, "o_totalprice"), 42)


@query(
    "element_at_from_end",
    """SELECT conv_id, turn, n - 1 AS _pos FROM (SELECT conv_id, turn,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p, count(*) OVER (PARTITION BY conv_id) AS n
      FROM conversations) WHERE p = n""",
)
def element_at_from_end(spark: SparkSession, sf: str) -> DataFrame:
    return at.element_at(with_pos_by_group(spark, sf), -1, by="conv_id")


@query(
    "index_of",
    f"""WITH {ORDERS_SEQ} SELECT o_custkey, coalesce(min(CASE WHEN o_orderpriority = '1-URGENT' AND _pos >= 10
      THEN _pos END), -1) AS index FROM orders_seq GROUP BY o_custkey""",
)
def index_of(spark: SparkSession, sf: str) -> DataFrame:
    seq = inputs.orders_seq(spark, sf, "o_custkey", "o_orderpriority")
    return at.index_of(seq, "o_orderpriority", "1-URGENT", start=10, by="o_custkey")


@query(
    "index_of_on",
    f"""WITH {ORDERS_SEQ} SELECT o_custkey, coalesce(max(CASE WHEN o_totalprice > 250000 THEN _pos END), -1) AS index
    FROM orders_seq GROUP BY o_custkey""",
)
def index_of_on(spark: SparkSession, sf: str) -> DataFrame:
    seq = inputs.orders_seq(spark, sf, "o_custkey", "o_totalprice")
    return at.index_of_on(seq, lambda r: r["o_totalprice"] > 250000, by="o_custkey")


@query(
    "last_index_of",
    """WITH turns AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p,
      count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
    SELECT conv_id, coalesce(min(CASE WHEN role = 'user' THEN n - 1 - p END), -1) AS index FROM turns GROUP BY conv_id""",
)
def last_index_of(spark: SparkSession, sf: str) -> DataFrame:
    turns = inputs.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return at.last_index_of(at.with_pos(turns, "turn", by="conv_id"), "role", "user", by="conv_id")


# --- edits ---------------------------------------------------------------------------


@query(
    "insert_at",
    f"""WITH {ORDERS_SEQ}, batch AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS j,
      count(*) OVER () AS m FROM customer)
    SELECT o_orderkey AS key, 'order' AS kind,
      _pos + CASE WHEN _pos >= 100 THEN (SELECT count(*) FROM customer) ELSE 0 END AS _pos FROM orders_seq
    UNION ALL SELECT c_custkey, 'customer', 100 + m - 1 - j FROM batch""",
)
def insert_at(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_seq(spark, sf).select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"), POS)
    customers = at.with_pos(inputs.table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    batch = customers.select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"), POS)
    return at.insert_at(orders, 100, batch)


@query(
    "remove_at",
    f"""WITH {ORDERS_SEQ} SELECT o_orderkey, _pos - CASE WHEN _pos > 7 THEN 1 ELSE 0 END AS _pos
    FROM orders_seq WHERE _pos <> 7""",
)
def remove_at(spark: SparkSession, sf: str) -> DataFrame:
    return at.remove_at(inputs.orders_seq(spark, sf), 7)


@query(
    "remove_range",
    f"""WITH {ORDERS_SEQ} SELECT o_orderkey, _pos - CASE WHEN _pos > 99 THEN 90 ELSE 0 END AS _pos
    FROM orders_seq WHERE NOT _pos BETWEEN 10 AND 99""",
)
def remove_range(spark: SparkSession, sf: str) -> DataFrame:
    return at.remove_range(inputs.orders_seq(spark, sf), 10, 99)


@query(
    "reverse",
    f"WITH {ORDERS_SEQ} SELECT o_orderkey, (SELECT count(*) FROM orders) - 1 - _pos AS _pos FROM orders_seq",
)
def reverse(spark: SparkSession, sf: str) -> DataFrame:
    return at.reverse(inputs.orders_seq(spark, sf))


@query(
    "reverse_by_group",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1 AS _pos FROM conversations",
)
def reverse_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return at.reverse(with_pos_by_group(spark, sf), by="conv_id")


@query(
    "replicate_index",
    """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS replicate,
    'S' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS tag FROM orders""",
)
def replicate_index(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    numbered = at.replicate_index(orders, "o_custkey", "o_orderkey")
    return numbered.withColumn("tag", at.tag_of(F.col("replicate")))


@query("balanced_split", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS chunk FROM orders")
def balanced_split(spark: SparkSession, sf: str) -> DataFrame:
    return at.balanced_split(inputs.orders_seq(spark, sf), 7).drop(POS)


@query(
    "balanced_split_by_group",
    """SELECT conv_id, turn, CAST(ntile(3) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS chunk
    FROM conversations""",
)
def balanced_split_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return at.balanced_split(with_pos_by_group(spark, sf), 3, by="conv_id").drop(POS)


@query(
    "fixed_chunks",
    f"""WITH {ORDERS_SEQ}, sized AS (SELECT (count(*) + 8 - 1) // 8 AS size FROM orders)
    SELECT o_orderkey, _pos // size AS chunk FROM orders_seq, sized""",
)
def fixed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return at.fixed_chunks(inputs.orders_seq(spark, sf), 8).drop(POS)


@query(
    "keep_last_by_key",
    "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def keep_last_by_key(spark: SparkSession, sf: str) -> DataFrame:
    kept = at.keep_last_by_key(inputs.events_in_order(spark, sf).select("user_id", "event_id", "event_type", POS), "user_id")
    return kept.drop(POS)


# --- bags and merges -----------------------------------------------------------------


@query(
    "append",
    f"""WITH {ORDERS_SEQ} SELECT o_orderkey AS key, _pos FROM orders_seq
    UNION ALL SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 + (SELECT count(*) FROM orders)
    FROM customer""",
)
def append(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_seq(spark, sf).withColumnRenamed("o_orderkey", "key")
    customers = at.with_pos(inputs.table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return bags.append(orders, customers.withColumnRenamed("c_custkey", "key"))


@query(
    "except_bag",
    """WITH removed AS (SELECT o_orderpriority, count(*) AS m FROM orders WHERE o_orderstatus = 'P'
      GROUP BY o_orderpriority),
    numbered AS (SELECT o_orderkey, o_orderpriority,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS nth FROM orders)
    SELECT o_orderkey, n.o_orderpriority FROM numbered n LEFT JOIN removed r USING (o_orderpriority)
    WHERE nth > coalesce(m, 0)""",
)
def except_bag(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus", POS)
    removed = orders.filter(F.col("o_orderstatus") == "P").select("o_orderpriority")
    kept = bags.except_bag(orders.drop("o_orderstatus"), "o_orderpriority", removed)
    return kept.drop(POS)


def _stored_and_incoming(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A table of the users seen by clicks, and all other events as incoming writes."""
    events = inputs.events_in_order(spark, sf).select("user_id", "event_id", "event_type", POS)
    clicks = F.col("event_type") == "click"
    return at.first_by_key(events.filter(clicks), "user_id"), events.filter(~clicks)


_MERGE = """WITH stored AS (SELECT * FROM events WHERE event_type = 'click'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
  tagged AS (SELECT user_id, event_id, event_type, 0 AS is_new FROM stored
    UNION ALL SELECT user_id, event_id, event_type, 1 FROM events WHERE event_type <> 'click')
  SELECT user_id, event_id, event_type FROM tagged
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {}) = 1"""


@query("upsert_first_wins", _MERGE.format("is_new, event_id"))
def upsert_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.upsert_first_wins(*_stored_and_incoming(spark, sf), "user_id").drop(POS)


@query("upsert_last_wins", _MERGE.format("is_new DESC, event_id DESC"))
def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.upsert_last_wins(*_stored_and_incoming(spark, sf), "user_id").drop(POS)


@query(
    "remove_key",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')""",
)
def remove_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").filter("o_orderpriority = '5-LOW'")
    gone = orders.select(F.col("o_custkey").alias("c_custkey"))
    return keyed.remove_keys(inputs.table(spark, sf, "customer").select("c_custkey", "c_name"), gone)


# --- dictionaries --------------------------------------------------------------------


def _first_event_of_user(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.dictionary(inputs.table(spark, sf, "events"), "user_id", "event_type", order="event_id")


_FIRST_EVENT = """pairs AS (SELECT user_id AS key, arg_min(event_type, event_id) AS value FROM events
  GROUP BY user_id)"""


@query("dict_keys", f"WITH {_FIRST_EVENT} SELECT key FROM pairs")
def dict_keys(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.dict_keys(_first_event_of_user(spark, sf))


@query("dict_values", f"WITH {_FIRST_EVENT} SELECT value FROM pairs")
def dict_values(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.dict_values(_first_event_of_user(spark, sf))


@query("dict_pairs", f"WITH {_FIRST_EVENT} SELECT key, value FROM pairs")
def dict_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.dict_pairs(_first_event_of_user(spark, sf)).select("pair.key", "pair.value")


@query(
    "dict_from_pairs_map",
    "SELECT user_id, event_type AS key, min(event_id) AS value FROM events GROUP BY user_id, event_type",
)
def dict_from_pairs_map(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.events_in_order(spark, sf)
    maps = keyed.maps_by_group(events, "user_id", "event_type", "event_id")
    return maps.select("user_id", F.explode("map").alias("key", "value"))


@query("value_not_none", "SELECT doc_id AS key, quality AS value FROM labels")
def value_not_none(spark: SparkSession, sf: str) -> DataFrame:
    labels = inputs.table(spark, sf, "labels").selectExpr("doc_id AS key", "quality AS value")
    return keyed.value_not_none(labels)


@query(
    "join_lookup_value",
    f"""WITH {_FIRST_EVENT} SELECT c_custkey, coalesce(value, 'none') AS value
    FROM customer LEFT JOIN pairs ON c_custkey = key""",
)
def join_lookup_value(spark: SparkSession, sf: str) -> DataFrame:
    customers = inputs.table(spark, sf, "customer").select("c_custkey")
    found = keyed.lookup_value(customers, "c_custkey", _first_event_of_user(spark, sf))
    return found.withColumn("value", F.coalesce("value", F.lit("none")))


# --- chains: positions stay dense after rows were taken out ------------------------------

_CHEAP = """cheap AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS p,
    count(*) OVER () AS n FROM orders WHERE o_totalprice < 200000)"""


def _cheap(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", POS)
    return sequence.where(orders, "o_totalprice < 200000")


@query("where_then_reverse", f"WITH {_CHEAP} SELECT o_orderkey, n - 1 - p AS _pos FROM cheap")
def where_then_reverse(spark: SparkSession, sf: str) -> DataFrame:
    return at.reverse(_cheap(spark, sf)).select("o_orderkey", POS)


@query("where_then_element_at", f"WITH {_CHEAP} SELECT o_orderkey, p AS _pos FROM cheap WHERE p = 7 OR p = n - 3")
def where_then_element_at(spark: SparkSession, sf: str) -> DataFrame:
    rows = _cheap(spark, sf).select("o_orderkey", POS)
    return at.element_at(rows, 7).unionByName(at.element_at(rows, -3))


@query(
    "where_then_insert",
    f"""WITH {_CHEAP} SELECT o_orderkey, CASE WHEN p >= 5 THEN p + 25 ELSE p END AS _pos FROM cheap
    UNION ALL SELECT -n_nationkey, 5 + 24 - (row_number() OVER (ORDER BY n_nationkey) - 1) FROM nation""",
)
def where_then_insert(spark: SparkSession, sf: str) -> DataFrame:
    batch = at.with_pos(inputs.table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS k"), "k")
    rows = _cheap(spark, sf).select("o_orderkey", POS)
    return at.insert_at(rows, 5, batch.select((-F.col("k")).alias("o_orderkey"), POS))


@query(
    "where_then_join_strings",
    f"""WITH {_CHEAP} SELECT p // 400 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY p) AS joined
    FROM cheap GROUP BY p // 400""",
)
def where_then_join_strings(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.join_strings(_cheap(spark, sf), "CAST(o_orderkey AS STRING)", ",", part_rows=400)


@query(
    "except_then_append",
    """WITH kept AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p, count(*) OVER () AS n
      FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT o_orderkey, p AS _pos FROM kept
    UNION ALL SELECT -n_nationkey, (SELECT max(n) FROM kept) + row_number() OVER (ORDER BY n_nationkey) - 1 FROM nation""",
)
def except_then_append(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", POS)
    kept = bags.except_bag(orders, "o_orderkey", orders.filter("o_orderkey % 3 = 0").select("o_orderkey"))
    more = at.with_pos(inputs.table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS k"), "k")
    return bags.append(kept, more.select((-F.col("k")).alias("o_orderkey"), POS))


@query(
    "hot_group_default",
    """WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS g FROM orders)
    SELECT o_orderkey, g, row_number() OVER (PARTITION BY g ORDER BY o_orderkey) - 1 AS _pos FROM g""",
)
def hot_group_default(spark: SparkSession, sf: str) -> DataFrame:
    """One group with a third of the rows, on the default settings."""
    orders = inputs.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS g"
    )
    return at.with_pos(orders, "o_orderkey", by="g")


# --- operators on values and dictionaries ------------------------------------------------


@query(
    "remove_value",
    """WITH first AS (SELECT min(o_orderkey) AS k FROM orders WHERE o_orderpriority = '2-HIGH')
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey <> (SELECT k FROM first)""",
)
def remove_value(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", "o_orderpriority", POS)
    return bags.remove_value(orders, "o_orderpriority", "2-HIGH").drop(POS)


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.dictionary(inputs.orders_in_order(spark, sf), "o_custkey", "o_orderpriority")


_DICT = """dict AS (SELECT o_custkey AS key, arg_min(o_orderpriority, o_orderkey) AS value, min(o_orderkey) AS seen
    FROM orders GROUP BY o_custkey)"""


@query(
    "dict_insert",
    f"""WITH {_DICT}, placed AS (SELECT key, value, row_number() OVER (ORDER BY seen) - 1 AS p FROM dict)
    SELECT key, value, CASE WHEN p >= 3 THEN p + 1 ELSE p END AS _pos FROM placed UNION ALL SELECT -1, 'new', 3""",
)
def dict_insert(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.pair_insert_at(_dictionary(spark, sf), 3, -1, "new")


@query("dict_count_key_of", f"WITH {_DICT} SELECT count(*) FILTER (key = 7) AS count FROM dict")
def dict_count_key_of(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.count_key_of(_dictionary(spark, sf), 7)


@query("dict_count_value_of", f"WITH {_DICT} SELECT count(*) FILTER (value = '5-LOW') AS count FROM dict")
def dict_count_value_of(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.count_value_of(_dictionary(spark, sf), "5-LOW")


@query(
    "dict_index_of_on",
    f"""WITH {_DICT}, placed AS (SELECT value, row_number() OVER (ORDER BY seen) - 1 AS p FROM dict)
    SELECT coalesce(max(p) FILTER (value = '5-LOW'), -1) AS index FROM placed""",
)
def dict_index_of_on(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.pair_index_of_on(_dictionary(spark, sf), "value = '5-LOW'")


@query(
    "compact",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS _pos FROM orders WHERE o_orderkey % 7 = 0""",
)
def compact(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", POS)
    return at.compact(orders.filter("o_orderkey % 7 = 0"))
