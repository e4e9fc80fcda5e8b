"""Queries for maps, filters, aggregates, sorts and steps of a sequence."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import aggregates as agg
from seqloom.operators import ordering, sequence
from seqloom.plans import inputs
from seqloom.plans.inputs import LABELLED, ORDERS_SEQ
from seqloom.plans.registry import query
from seqloom.selectors import POS, batched

# --- maps and filters ----------------------------------------------------------------


@query("select", "SELECT o_orderkey AS _pos, o_totalprice * 2 AS doubled, lower(o_orderpriority) AS prio FROM orders")
def select_(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf)
    return sequence.select(orders, doubled=lambda r: r["o_totalprice"] * 2, prio="lower(o_orderpriority)")


@query(
    "set_indexed",
    f"WITH {ORDERS_SEQ} SELECT o_orderkey, _pos, o_custkey + _pos AS o_custkey FROM orders_seq",
)
def set_indexed(spark: SparkSession, sf: str) -> DataFrame:
    seq = inputs.orders_seq(spark, sf, "o_custkey")
    return sequence.set_indexed(seq, "o_custkey", lambda value, index: value + index)


@query(
    "where",
    f"""WITH {LABELLED} SELECT doc_id, lang, coalesce(quality, -1) AS quality
    FROM labelled WHERE coalesce(quality = 1, true)""",
)
def where(spark: SparkSession, sf: str) -> DataFrame:
    kept = sequence.where(inputs.labelled_documents(spark, sf), lambda r: r["quality"] == 1)
    return kept.select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query(
    "remove_on",
    f"""WITH {LABELLED} SELECT doc_id, lang, coalesce(toxic, -1) AS toxic
    FROM labelled WHERE NOT coalesce(toxic = 1, false)""",
)
def remove_on(spark: SparkSession, sf: str) -> DataFrame:
    kept = sequence.remove_on(inputs.labelled_documents(spark, sf), "toxic = 1")
    return kept.select("doc_id", "lang", F.coalesce("toxic", F.lit(-1)).alias("toxic"))


@query("not_none", f"WITH {LABELLED} SELECT doc_id, quality, toxic FROM labelled WHERE quality IS NOT NULL")
def not_none(spark: SparkSession, sf: str) -> DataFrame:
    kept = sequence.not_none(inputs.labelled_documents(spark, sf), "quality")
    return kept.select("doc_id", "quality", "toxic")


@query("project_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.project(inputs.table(spark, sf, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@query(
    "split_on_null",
    f"""WITH {LABELLED} SELECT doc_id, CASE WHEN quality IS NULL THEN 'none' ELSE 'value' END AS branch
    FROM labelled""",
)
def split_on_null(spark: SparkSession, sf: str) -> DataFrame:
    some, none = sequence.split_on_null(inputs.labelled_documents(spark, sf), "quality")
    tag = lambda df, name: df.select("doc_id", F.lit(name).alias("branch"))
    return tag(some, "value").unionByName(tag(none, "none"))


@query("for_each", "SELECT count(*) AS elements, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events")
def for_each(spark: SparkSession, sf: str) -> DataFrame:
    elements, id_sum = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def visit(row):
        elements.add(1)
        id_sum.add(row["event_id"])

    sequence.for_each(inputs.table(spark, sf, "events").select("event_id"), visit)
    return spark.createDataFrame([(elements.value, id_sum.value)], "elements LONG, id_sum LONG")


@query(
    "for_each_if",
    f"""WITH {LABELLED} SELECT count(quality) AS known, count(*) - count(quality) AS unknown,
    CAST(coalesce(sum(quality), 0) AS BIGINT) AS good FROM labelled""",
)
def for_each_if(spark: SparkSession, sf: str) -> DataFrame:
    known, unknown, good = (spark.sparkContext.accumulator(0) for _ in range(3))

    def on_value(value):
        known.add(1)
        good.add(value)

    sequence.for_each_if(inputs.labelled_documents(spark, sf), "quality", on_value, lambda: unknown.add(1))
    return spark.createDataFrame([(known.value, unknown.value, good.value)], "known LONG, unknown LONG, good LONG")


@query(
    "selector",
    """SELECT o_orderkey AS _pos, o_custkey + 1 AS by_text, o_totalprice / 2 AS by_column,
    upper(o_orderpriority) AS by_function FROM orders WHERE o_custkey % 3 = 0 AND o_totalprice > 1000""",
)
def selector(spark: SparkSession, sf: str) -> DataFrame:
    """All three forms, as predicates and as values."""
    orders = inputs.orders_in_order(spark, sf)
    kept = sequence.where(sequence.where(orders, "o_custkey % 3 = 0"), F.col("o_totalprice") > 1000)
    return sequence.select(
        kept,
        by_text="o_custkey + 1",
        by_column=F.col("o_totalprice") / 2,
        by_function=lambda r: F.upper(r["o_orderpriority"]),
    )


def _initials(names: pa.Array, prices: pa.Array) -> pa.Array:
    """The capitals of a text and whether a price is a round number of hundreds: plain Python on whole batches."""
    capitals = ["".join(c for c in name if c.isupper()) for name in names.to_pylist()]
    return pa.array([f"{c}{'*' if p % 100 < 10 else ''}" for c, p in zip(capitals, prices.to_pylist(), strict=True)])


def _long_word(names: pa.Array) -> pa.Array:
    return pc.greater(pc.utf8_length(names), 5)


@query(
    "selector_batched",
    """SELECT o_orderkey AS _pos, regexp_replace(o_orderpriority, '[^A-Z]', '', 'g')
      || CASE WHEN o_totalprice % 100 < 10 THEN '*' ELSE '' END AS initials FROM orders WHERE length(o_orderpriority) > 5""",
)
def selector_batched(spark: SparkSession, sf: str) -> DataFrame:
    """A predicate and a value in vectorised Python."""
    orders = inputs.orders_in_order(spark, sf)
    kept = sequence.where(orders, batched(_long_word, "boolean", "o_orderpriority"))
    return sequence.select(kept, initials=batched(_initials, "string", "o_orderpriority", F.col("o_totalprice")))


@query(
    "pipe",
    f"""WITH {LABELLED} SELECT lang, count(*) AS length FROM labelled
    WHERE coalesce(quality = 1, true) AND NOT coalesce(toxic = 1, false) GROUP BY lang""",
)
def pipe(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.pipe(
        inputs.labelled_documents(spark, sf),
        lambda df: sequence.where(df, "quality = 1"),
        lambda df: sequence.remove_on(df, "toxic = 1"),
        lambda df: agg.length(df, by="lang"),
    )


@query(
    "pipe_if",
    """SELECT o_orderstatus, CASE WHEN (SELECT count(*) > 10 FROM orders)
      THEN CAST(max(o_totalprice) AS DOUBLE) ELSE CAST(min(o_totalprice) AS DOUBLE) END AS price
    FROM orders GROUP BY o_orderstatus""",
)
def pipe_if(spark: SparkSession, sf: str) -> DataFrame:
    return sequence.pipe_if(
        inputs.orders_in_order(spark, sf),
        F.count(F.lit(1)) > 10,
        lambda df: agg.max_of(df, "o_totalprice", by="o_orderstatus", name="price"),
        lambda df: agg.min_of(df, "o_totalprice", by="o_orderstatus", name="price"),
    )


@query("parallelize", "SELECT event_type, count(*) AS length FROM events GROUP BY event_type")
def parallelize(spark: SparkSession, sf: str) -> DataFrame:
    return agg.length(sequence.parallelize(inputs.table(spark, sf, "events"), 8), by="event_type")


# --- aggregates ----------------------------------------------------------------------


@query("length", "SELECT count(*) AS length FROM lineitem")
def length(spark: SparkSession, sf: str) -> DataFrame:
    return agg.length(inputs.table(spark, sf, "lineitem"))


@query("length_by", "SELECT o_custkey, count(*) AS length FROM orders GROUP BY o_custkey")
def length_by(spark: SparkSession, sf: str) -> DataFrame:
    return agg.length(inputs.table(spark, sf, "orders"), by="o_custkey")


@query(
    "count_of",
    """SELECT l_returnflag, CAST(count_if(l_linenumber IS NOT DISTINCT FROM 3) AS BIGINT) AS count
    FROM lineitem GROUP BY l_returnflag""",
)
def count_of(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_of(inputs.table(spark, sf, "lineitem"), "l_linenumber", 3, by="l_returnflag")


@query(
    "count_of_null",
    f"WITH {LABELLED} SELECT lang, CAST(count_if(quality IS NULL) AS BIGINT) AS count FROM labelled GROUP BY lang",
)
def count_of_null(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_of(inputs.labelled_documents(spark, sf), "quality", None, by="lang")


@query(
    "count_of_on",
    f"""WITH {LABELLED} SELECT source, CAST(count_if(coalesce(quality = 1, false)) AS BIGINT) AS count
    FROM labelled GROUP BY source""",
)
def count_of_on(spark: SparkSession, sf: str) -> DataFrame:
    return agg.count_of_on(inputs.labelled_documents(spark, sf), lambda r: r["quality"] == 1, by="source")


@query(
    "contains",
    "SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS contains FROM orders GROUP BY o_custkey",
)
def contains(spark: SparkSession, sf: str) -> DataFrame:
    return agg.contains(inputs.table(spark, sf, "orders"), "o_orderpriority", "1-URGENT", by="o_custkey")


@query(
    "all_of",
    f"WITH {LABELLED} SELECT source, bool_and(coalesce(quality = 1, true)) AS all_of FROM labelled GROUP BY source",
)
def all_of(spark: SparkSession, sf: str) -> DataFrame:
    return agg.all_of(inputs.labelled_documents(spark, sf), lambda r: r["quality"] == 1, by="source")


@query(
    "any_of",
    f"WITH {LABELLED} SELECT source, bool_or(coalesce(toxic = 1, false)) AS any_of FROM labelled GROUP BY source",
)
def any_of(spark: SparkSession, sf: str) -> DataFrame:
    return agg.any_of(inputs.labelled_documents(spark, sf), lambda r: r["toxic"] == 1, by="source")


@query(
    "sum",
    """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def sum_(spark: SparkSession, sf: str) -> DataFrame:
    lines = inputs.table(spark, sf, "lineitem")
    summed = agg.sum_of(lines, "CAST(l_quantity AS DECIMAL(18,2))", by=["l_returnflag", "l_linestatus"])
    return summed.withColumn("sum", F.col("sum").cast("double"))


@query("sum_of_none", f"WITH {LABELLED} SELECT source, CAST(coalesce(sum(toxic), 0) AS BIGINT) AS sum "
       "FROM labelled GROUP BY source")
def sum_of_none(spark: SparkSession, sf: str) -> DataFrame:
    return agg.sum_of(inputs.labelled_documents(spark, sf), "toxic", by="source")


@query(
    "average",
    "SELECT o_custkey, round(avg(CAST(o_orderkey AS DOUBLE)), 6) AS average FROM orders GROUP BY o_custkey",
)
def average(spark: SparkSession, sf: str) -> DataFrame:
    means = agg.average(inputs.table(spark, sf, "orders"), "o_orderkey", by="o_custkey")
    return means.withColumn("average", F.round("average", 6))


@query("max", "SELECT o_custkey, max(o_totalprice * 2) AS max FROM orders GROUP BY o_custkey")
def max_(spark: SparkSession, sf: str) -> DataFrame:
    return agg.max_of(inputs.table(spark, sf, "orders"), lambda r: r["o_totalprice"] * 2, by="o_custkey")


@query("min", "SELECT l_returnflag, min(l_extendedprice) AS min FROM lineitem GROUP BY l_returnflag")
def min_(spark: SparkSession, sf: str) -> DataFrame:
    return agg.min_of(inputs.table(spark, sf, "lineitem"), "l_extendedprice", by="l_returnflag")


_EDGE = """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey {}) = 1"""


@query("first", _EDGE.format(""))
def first(spark: SparkSession, sf: str) -> DataFrame:
    firsts = agg.first(inputs.orders_in_order(spark, sf), by="o_custkey")
    return firsts.select("o_custkey", "o_orderkey", "o_totalprice")


@query("last", _EDGE.format("DESC"))
def last(spark: SparkSession, sf: str) -> DataFrame:
    lasts = agg.last(inputs.orders_in_order(spark, sf), by="o_custkey")
    return lasts.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "first_on",
    """SELECT o_custkey, coalesce(min(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END), -1) AS first
    FROM orders GROUP BY o_custkey""",
)
def first_on(spark: SparkSession, sf: str) -> DataFrame:
    found = agg.first_on(inputs.orders_in_order(spark, sf), "o_orderkey", "o_orderstatus = 'F'", by="o_custkey")
    return found.withColumn("first", F.coalesce("first", F.lit(-1)))


@query(
    "last_on",
    """SELECT o_custkey, coalesce(arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'P'), '') AS last
    FROM orders GROUP BY o_custkey""",
)
def last_on(spark: SparkSession, sf: str) -> DataFrame:
    found = agg.last_on(inputs.orders_in_order(spark, sf), "o_orderpriority", "o_orderstatus = 'P'", by="o_custkey")
    return found.withColumn("last", F.coalesce("last", F.lit("")))


_JOINED = """WITH placed AS (SELECT {0} AS g, o_orderkey,
    (row_number() OVER (PARTITION BY {0} ORDER BY o_orderkey) - 1) // {1} AS part FROM orders)
  SELECT g AS {0}, part, string_agg(CAST(o_orderkey AS VARCHAR), '{2}' ORDER BY o_orderkey) AS {3}
  FROM placed GROUP BY g, part"""


@query("join_strings", _JOINED.format("o_custkey", 100000, ", ", "joined"))
def join_strings(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf)
    return agg.join_strings(orders, "CAST(o_orderkey AS STRING)", ", ", by="o_custkey")


@query("join_strings_large_groups", _JOINED.format("o_orderstatus", 500, "|", "joined"))
def join_strings_large_groups(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf)
    return agg.join_strings(orders, "CAST(o_orderkey AS STRING)", "|", by="o_orderstatus", part_rows=500)


@query("unique", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def unique(spark: SparkSession, sf: str) -> DataFrame:
    return agg.unique(inputs.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "count_distinct_next_lane",
    f"""WITH {inputs.RUN_TABLE} SELECT gsm_id, 'L' || lpad(CAST(count(DISTINCT lane_id) + 1 AS VARCHAR), 3, '0')
    AS next_lane FROM run_table GROUP BY gsm_id""",
)
def count_distinct_next_lane(spark: SparkSession, sf: str) -> DataFrame:
    return agg.next_lane(inputs.run_table(spark, sf), "gsm_id", "lane_id")


@query("collect_children", _JOINED.format("o_custkey", 100000, ",", "children"))
def collect_children(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf)
    return agg.collect_children(orders, "o_custkey", "CAST(o_orderkey AS STRING)")


@query(
    "expand_children",
    """SELECT o_custkey, nth // 100000 AS part, CAST(nth % 100000 AS INTEGER) AS place, child FROM (
      SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS nth,
        CAST(o_orderkey AS VARCHAR) AS child FROM orders)""",
)
def expand_children(spark: SparkSession, sf: str) -> DataFrame:
    return agg.expand_children(collect_children(spark, sf), "children")


@query(
    "location_pick",
    f"""WITH {inputs.RUN_TABLE}, known AS (SELECT * REPLACE (CASE WHEN _pos % 101 = 0 THEN NULL ELSE run_id END AS run_id)
        FROM run_table),
      choice AS (SELECT run_id, CASE WHEN arg_min(filetype, _pos) = 'fastq'
        THEN arg_min(location, _pos) ELSE arg_min(location, _pos) FILTER (egress = 'worldwide') END AS pick
      FROM known WHERE run_id IS NOT NULL GROUP BY run_id)
    SELECT coalesce(r.run_id, 'none') AS run_id, r._pos, r.location, coalesce(pick, 'rejected') AS picked
    FROM known r LEFT JOIN choice c ON r.run_id = c.run_id WHERE r.location = c.pick OR c.pick IS NULL""",
)
def location_pick(spark: SparkSession, sf: str) -> DataFrame:
    """Some rows have lost their run id."""
    run = F.when(F.col(POS) % 101 != 0, F.col("run_id"))
    rows = agg.location_pick(inputs.run_table(spark, sf).withColumn("run_id", run))
    known = lambda name, value: F.coalesce(name, F.lit(value)).alias(name)
    return rows.select(known("run_id", "none"), POS, "location", known("picked", "rejected"))


# --- whole frames ----------------------------------------------------------------------


@query(
    "whole_aggregates",
    """SELECT avg(o_totalprice) AS average, max(o_totalprice) AS max, min(o_totalprice) AS min, CAST(sum(o_custkey) AS BIGINT) AS sum,
    bool_or(o_orderpriority = '2-HIGH') AS contains, bool_or(o_orderpriority = 'none') AS contains_none,
    arg_min(o_custkey, o_orderkey) FILTER (o_orderstatus = 'F') AS first,
    arg_max(o_custkey, o_orderkey) FILTER (o_orderstatus = 'F') AS last FROM orders""",
)
def whole_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """Each aggregate of the whole sequence, one number each, side by side."""
    orders = inputs.orders_in_order(spark, sf)
    done = "o_orderstatus = 'F'"
    parts = [
        agg.average(orders, "o_totalprice"),
        agg.max_of(orders, "o_totalprice"),
        agg.min_of(orders, "o_totalprice"),
        agg.sum_of(orders, "o_custkey"),
        agg.contains(orders, "o_orderpriority", "2-HIGH"),
        agg.contains(orders, "o_orderpriority", "none", name="contains_none"),
        agg.first_on(orders, "o_custkey", done),
        agg.last_on(orders, "o_custkey", done),
    ]
    return spark.range(1).select(*[p.scalar().alias(p.columns[0]) for p in parts])


@query(
    "whole_first_last",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders) OR o_orderkey = (SELECT max(o_orderkey) FROM orders)""",
)
def whole_first_last(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.orders_in_order(spark, sf).select("o_orderkey", "o_custkey", POS)
    return agg.first(orders).unionByName(agg.last(orders)).drop(POS)


# --- sorts ---------------------------------------------------------------------------


def _sorted_columns(df: DataFrame) -> DataFrame:
    return df.select("o_orderpriority", "o_orderkey")


@query("order_by", "SELECT o_orderpriority, o_orderkey FROM orders ORDER BY o_orderpriority, o_orderkey")
def order_by(spark: SparkSession, sf: str) -> DataFrame:
    return _sorted_columns(ordering.order_by(inputs.orders_in_order(spark, sf), "o_orderpriority"))


@query(
    "order_by_descending",
    "SELECT o_orderpriority, o_orderkey FROM orders ORDER BY o_orderpriority DESC, o_orderkey DESC",
)
def order_by_descending(spark: SparkSession, sf: str) -> DataFrame:
    return _sorted_columns(ordering.order_by_descending(inputs.orders_in_order(spark, sf), "o_orderpriority"))


@query(
    "head",
    """SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2""",
)
def head(spark: SparkSession, sf: str) -> DataFrame:
    heads = ordering.head(inputs.orders_in_order(spark, sf), 2, by="o_custkey")
    return heads.select("o_custkey", "o_orderkey")
