"""Queries for the catalog: hierarchy joins, lookups, pending work."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import files
from seqloom.operators import catalog, ranges, sequence
from seqloom.plans import inputs
from seqloom.plans.inputs import FILE_KIND, RUN_FILES, RUNS, SAMPLES, SERIES, SIZE_GB
from seqloom.plans.registry import query
from seqloom.sources import listing, storage
from seqloom.staging import new_path

# --- hierarchy -----------------------------------------------------------------------


@query(
    "join_expand_hierarchy",
    f"""WITH {SERIES}, {SAMPLES}, {RUNS}, {RUN_FILES}, usable AS (
      SELECT series_title, gsm_id, size FROM series JOIN samples USING (gse_id) JOIN runs USING (gsm_id)
        JOIN run_files USING (run_id) WHERE {FILE_KIND} = 'fastq')
    SELECT series_title, gsm_id, count(*) AS files, sum({SIZE_GB}) AS size_gb
    FROM usable GROUP BY series_title, gsm_id""",
)
def join_expand_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: fastq volume per sample, largest first.

    Sizes are whole numbers times powers of 1024, so sums of doubles are exact in any order.
    """
    found = catalog.expand_hierarchy(
        inputs.series(spark, sf), inputs.samples(spark, sf), inputs.runs(spark, sf), inputs.run_files(spark, sf)
    )
    usable = sequence.where(found, lambda r: files.classify_filetype(r["path"]) == "fastq")
    by_sample = usable.groupBy("series_title", "gsm_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(files.parse_size_gb(F.col("size"))).alias("size_gb"),
    )
    return by_sample.orderBy(F.col("size_gb").desc(), F.col("gsm_id").desc())


@query(
    "join_parent",
    f"""WITH {SAMPLES}, {RUNS}, parents AS (SELECT * FROM samples WHERE sample_title LIKE '%1')
    SELECT run_id, coalesce(sample_title, 'missing') AS sample_title FROM runs LEFT JOIN parents USING (gsm_id)""",
)
def join_parent(spark: SparkSession, sf: str) -> DataFrame:
    parents = inputs.samples(spark, sf).filter(F.col("sample_title").endswith("1"))
    joined = catalog.join_parent(inputs.runs(spark, sf), parents, "gsm_id")
    return joined.select("run_id", F.coalesce("sample_title", F.lit("missing")).alias("sample_title"))


@query(
    "join_resolve_required",
    f"""WITH {SAMPLES}, wanted AS (SELECT 'GSM' || (o_custkey * 2) AS gsm_id, o_orderkey FROM orders)
    SELECT o_orderkey, gsm_id, sample_title IS NOT NULL AS resolved FROM wanted LEFT JOIN samples USING (gsm_id)""",
)
def join_resolve_required(spark: SparkSession, sf: str) -> DataFrame:
    wanted = inputs.table(spark, sf, "orders").selectExpr("concat('GSM', o_custkey * 2) AS gsm_id", "o_orderkey")
    resolved = catalog.resolve_required(wanted, inputs.samples(spark, sf), "gsm_id", name="resolved")
    return resolved.select("o_orderkey", "gsm_id", "resolved")


def _bridge(spark: SparkSession, sf: str) -> DataFrame:
    owned = inputs.runs(spark, sf).join(inputs.samples(spark, sf), "gsm_id")
    return owned.select(F.col("run_id").alias("SRR"), F.col("gsm_id").alias("GSM"), F.col("gse_id").alias("GSE"))


_BRIDGE = f"""{SAMPLES}, {RUNS},
  bridge AS (SELECT run_id AS SRR, gsm_id AS GSM, gse_id AS GSE FROM runs JOIN samples USING (gsm_id))"""
_ASKED = """asked AS (SELECT 'SRR' || (l_orderkey * 2) AS id FROM lineitem
  UNION SELECT 'GSM' || (c_custkey * 2) FROM customer UNION SELECT 'GSE' || s_nationkey FROM supplier
  UNION SELECT 'PRJ' || p_partkey FROM part)"""


def _asked(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all three kinds and of an unknown kind; half of the run and sample ids have no record."""
    read = lambda name: inputs.table(spark, sf, name)
    ids = read("lineitem").selectExpr("concat('SRR', l_orderkey * 2) AS id")
    ids = ids.union(read("customer").selectExpr("concat('GSM', c_custkey * 2) AS id"))
    ids = ids.union(read("supplier").selectExpr("concat('GSE', s_nationkey) AS id"))
    return ids.union(read("part").selectExpr("concat('PRJ', p_partkey) AS id")).distinct()


@query(
    "join_bridge_ids",
    f"""WITH {_BRIDGE}, {_ASKED}, hits AS (SELECT id, SRR, GSM, GSE FROM asked LEFT JOIN bridge ON id = SRR
        WHERE id LIKE 'SRR%'
      UNION ALL SELECT id, SRR, GSM, GSE FROM asked LEFT JOIN bridge ON id = GSM WHERE id LIKE 'GSM%'
      UNION ALL SELECT id, SRR, GSM, GSE FROM asked LEFT JOIN bridge ON id = GSE WHERE id LIKE 'GSE%'
      UNION ALL SELECT id, NULL, NULL, NULL FROM asked WHERE id LIKE 'PRJ%')
    SELECT id, CASE WHEN id LIKE 'PRJ%' THEN 'unknown' ELSE left(id, 3) END AS kind, coalesce(SRR, '') AS run,
      coalesce(GSM, '') AS sample, coalesce(GSE, '') AS series FROM hits""",
)
def join_bridge_ids(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.bridge_ids(_asked(spark, sf), _bridge(spark, sf))
    text = lambda name, to: F.coalesce(F.col(name), F.lit("")).alias(to)
    kind = F.coalesce("kind", F.lit("unknown")).alias("kind")
    return found.select("id", kind, text("SRR", "run"), text("GSM", "sample"), text("GSE", "series"))


@query(
    "lookup_by_id_kind",
    f"""WITH {SERIES}, {SAMPLES}, {RUNS}, {_ASKED}, records AS (SELECT gse_id AS id, series_title AS title FROM series
      UNION ALL SELECT gsm_id, sample_title FROM samples UNION ALL SELECT run_id, status FROM runs)
    SELECT id, CASE WHEN id LIKE 'PRJ%' THEN 'rejected' WHEN title IS NULL THEN 'absent' ELSE title END AS title
    FROM asked LEFT JOIN records USING (id)""",
)
def lookup_by_id_kind(spark: SparkSession, sf: str) -> DataFrame:
    sections = {
        "GSE": inputs.series(spark, sf).selectExpr("gse_id AS id", "series_title AS title"),
        "GSM": inputs.samples(spark, sf).selectExpr("gsm_id AS id", "sample_title AS title"),
        "SRR": inputs.runs(spark, sf).selectExpr("run_id AS id", "status AS title"),
    }
    looked_up = catalog.lookup_by_id_kind(_asked(spark, sf), sections)
    unknown = F.when(F.col("kind").isNull(), "rejected").otherwise("absent")
    return looked_up.select("id", F.when(F.col("found"), F.col("title")).otherwise(unknown).alias("title"))


@query(
    "point_lookup",
    """WITH asked AS (SELECT DISTINCT o_custkey * 2 AS id FROM orders)
    SELECT id, coalesce(c_name, '') AS c_name, c_custkey IS NOT NULL AS found
    FROM asked LEFT JOIN customer ON c_custkey = id""",
)
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ids = inputs.table(spark, sf, "orders").selectExpr("o_custkey * 2 AS id").distinct()
    customers = inputs.table(spark, sf, "customer").select("c_custkey", "c_name")
    found = sequence.search_many(customers, "c_custkey", ids)
    return found.withColumn("c_name", F.coalesce("c_name", F.lit("")))


@query(
    "children_of_parent",
    f"""WITH {SAMPLES} SELECT gsm_id, gse_id FROM samples
    WHERE gse_id IN (SELECT 'GSE' || s_nationkey FROM supplier WHERE s_acctbal < 0)""",
)
def children_of_parent(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = inputs.table(spark, sf, "supplier").filter("s_acctbal < 0")
    parents = suppliers.selectExpr("concat('GSE', s_nationkey) AS gse_id").distinct()
    return catalog.children_of_many(inputs.samples(spark, sf), "gse_id", parents).select("gsm_id", "gse_id")


@query(
    "filter_nested_by_membership",
    """WITH children AS (SELECT c_custkey, unnest(range(4)) AS place FROM customer),
      members AS (SELECT DISTINCT 'GSM' || o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'),
      kept AS (SELECT c_custkey, place, 'GSM' || (c_custkey * 4 + place) AS accession FROM children
        WHERE 'GSM' || (c_custkey * 4 + place) IN (SELECT id FROM members))
    SELECT c.c_custkey, coalesce(string_agg(accession, ',' ORDER BY place), '') AS targets
    FROM customer c LEFT JOIN kept k ON c.c_custkey = k.c_custkey GROUP BY c.c_custkey""",
)
def filter_nested_by_membership(spark: SparkSession, sf: str) -> DataFrame:
    nested = inputs.table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """transform(sequence(0L, 3L), j -> named_struct('accession', concat('GSM', c_custkey * 4 + j),
        'title', concat('t', j))) AS children""",
    )
    members = inputs.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    members = members.selectExpr("concat('GSM', o_orderkey) AS id")
    kept = catalog.nested_membership(nested, "c_custkey", "children", members)
    return kept.select("c_custkey", F.array_join("targets.accession", ",").alias("targets"))


@query(
    "rename_to_scheme",
    """SELECT 'GSM' || c_custkey AS accession_id, c_name AS title, c_mktsegment AS species,
    CAST(c_nationkey AS VARCHAR) AS parent_gse_id FROM customer""",
)
def rename_to_scheme(spark: SparkSession, sf: str) -> DataFrame:
    fetched = inputs.table(spark, sf, "customer").selectExpr(
        "concat('GSM', c_custkey) AS accession", "c_name AS title", "c_mktsegment AS taxon", "c_nationkey AS parent_gse"
    )
    scheme = {
        "accession_id": ("accession", "string"),
        "title": ("title", "string"),
        "species": ("taxon", "string"),
        "parent_gse_id": ("parent_gse", "string"),
    }
    return sequence.rename_to_scheme(fetched, scheme)


# --- dimension, membership -----------------------------------------------------------


@query(
    "join_reference_dim",
    """SELECT s_suppkey, CASE WHEN n_regionkey = 4 THEN 'none' ELSE '/ref/' || n_name END AS path
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def join_reference_dim(spark: SparkSession, sf: str) -> DataFrame:
    nations = inputs.table(spark, sf, "nation").filter("n_regionkey <> 4")
    genomes = nations.selectExpr("n_nationkey AS s_nationkey", "concat('/ref/', n_name) AS path")
    suppliers = inputs.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    found = catalog.reference_dim(suppliers, genomes, "s_nationkey", "path")
    return found.select("s_suppkey", F.coalesce("path", F.lit("none")).alias("path"))


@query(
    "semi_members",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def semi_members(spark: SparkSession, sf: str) -> DataFrame:
    listed = inputs.table(spark, sf, "customer").filter("c_acctbal < 0").selectExpr("c_custkey AS o_custkey")
    return catalog.semi_members(inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), listed, "o_custkey")


@query(
    "anti_new_only",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS
    (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)""",
)
def anti_new_only(spark: SparkSession, sf: str) -> DataFrame:
    known = inputs.table(spark, sf, "lineitem").filter("l_quantity > 45").selectExpr("l_partkey AS p_partkey")
    return catalog.new_only(inputs.table(spark, sf, "part").select("p_partkey", "p_name"), known, "p_partkey")


# --- pending work --------------------------------------------------------------------


#: Folders that result files are dealt over on a disk.
FOLDERS = 1024


def _written(spark: SparkSession, ids: DataFrame, column: str, label: str) -> DataFrame:
    """Write one result file for each id and list what is there: the ids with a result.

    On a disk the files are created one by one, as the tools do whose results they stand for: Hadoop's local file
    system starts a process for every file and folder to set its permissions. Elsewhere Spark's writer makes a folder
    for each id.
    """
    root = new_path(spark, label)
    named = ids.select(F.col(column).cast("string").alias("name")).where("name IS NOT NULL").distinct()
    # as many writers as there are cores
    results = named.repartition(spark.sparkContext.defaultParallelism, "name")
    folder = storage.local_path(spark, root)
    if folder is None:
        writer = results.withColumn("value", F.lit("done")).write
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("name").text(root)
    else:
        os.makedirs(folder)

        def finish(row):
            os.makedirs(f"{folder}/{row.place}", exist_ok=True)
            with open(f"{folder}/{row.place}/name={row.name}.txt", "w") as out:
                out.write("done\n")

        sequence.for_each(results.withColumn("place", F.pmod(F.xxhash64("name"), F.lit(FOLDERS))), finish)
    found = listing.dumped_ids(listing.file_listing(spark, root), r"/name=([^/]+?)(?:/|\.txt$)", extensions=(".txt",))
    return found.select(F.col("id").alias(column))


@query(
    "anti_pending_dump",
    f"""WITH {RUNS}, done AS (SELECT 'SRR' || o_orderkey AS run_id FROM orders WHERE o_totalprice > 480000)
    SELECT run_id, gsm_id FROM runs WHERE run_id NOT IN (SELECT run_id FROM done)""",
)
def anti_pending_dump(spark: SparkSession, sf: str) -> DataFrame:
    expected = inputs.runs(spark, sf).select("run_id", "gsm_id")
    done = inputs.table(spark, sf, "orders").filter("o_totalprice > 480000")
    present = _written(spark, done.selectExpr("concat('SRR', o_orderkey) AS run_id"), "run_id", "dumped")
    return catalog.pending_dump(expected, present, "run_id")


@query(
    "pending_count",
    """WITH present AS (SELECT DISTINCT o_custkey FROM orders),
      finished AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 490000),
      started AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)
    SELECT c_custkey AS o_custkey, c_custkey IN (SELECT o_custkey FROM started) AS restart FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM present) AND c_custkey NOT IN (SELECT o_custkey FROM finished)""",
)
def pending_count(spark: SparkSession, sf: str) -> DataFrame:
    """Finished means that the result file is there."""
    orders = inputs.table(spark, sf, "orders")
    samples = inputs.table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey")
    done = _written(spark, orders.filter("o_totalprice > 490000"), "o_custkey", "outs")
    return catalog.pending_count(
        samples,
        present=orders,
        finished=done.select(F.col("o_custkey").cast("long")),
        started=orders.filter("o_totalprice > 400000"),
        key="o_custkey",
    )


@query(
    "pending_by_group",
    """WITH have AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 490000)
    SELECT c_nationkey, bool_or(h.o_custkey IS NULL) AS any_empty, count(*) - count(h.o_custkey) AS pending
    FROM customer LEFT JOIN have h ON c_custkey = h.o_custkey GROUP BY c_nationkey""",
)
def pending_by_group(spark: SparkSession, sf: str) -> DataFrame:
    samples = inputs.table(spark, sf, "customer").selectExpr("c_custkey AS sample", "c_nationkey")
    done = inputs.table(spark, sf, "orders").filter("o_totalprice > 490000").selectExpr("o_custkey AS sample")
    present = _written(spark, done, "sample", "results").select(F.col("sample").cast("long"))
    return catalog.pending_by_group(samples, present, "c_nationkey", "sample")


_LAST_ASKED = "c_custkey * 10 + c_custkey % 40 + CASE WHEN c_custkey % 500 = 0 THEN 25000 ELSE 0 END"


@query(
    "listed_ids",
    f"""SELECT c_custkey, 'GSM' || unnest(range(c_custkey * 10, {_LAST_ASKED} + 1)) AS id FROM customer
    UNION ALL SELECT c_custkey, 'GSM99999' FROM customer""",
)
def listed_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Id ranges of any length, a row per id."""
    asked = inputs.table(spark, sf, "customer").selectExpr(
        "c_custkey", f"concat('GSM', c_custkey * 10, ':GSM', {_LAST_ASKED}, ',GSM99999') AS ids"
    )
    return catalog.listed_ranges(asked, "ids")


_ASKED_FROM, _ASKED_TO = "c_custkey * 7", "c_custkey * 7 + c_custkey % 5 + CASE WHEN c_custkey % 400 = 0 THEN 1000000000 ELSE 0 END"


@query(
    "range_members",
    f"""WITH asked AS (SELECT {_ASKED_FROM} AS low, {_ASKED_TO} AS high FROM customer
      UNION ALL SELECT c_custkey, c_custkey FROM customer WHERE c_nationkey = 3)
    SELECT o_orderkey, 'GSM' || o_orderkey AS id FROM orders
    WHERE EXISTS (SELECT 1 FROM asked WHERE o_orderkey BETWEEN low AND high)""",
)
def range_members(spark: SparkSession, sf: str) -> DataFrame:
    """Orders among the ids and ranges that customers list, some of them with a billion ids."""
    records = inputs.table(spark, sf, "orders").selectExpr("o_orderkey", "concat('GSM', o_orderkey) AS id")
    asked = inputs.table(spark, sf, "customer").selectExpr(
        f"""concat('GSM', {_ASKED_FROM}, ':GSM', {_ASKED_TO}, CASE WHEN c_nationkey = 3 THEN concat(',GSM', c_custkey)
        ELSE ',PRJ1' END) AS ids"""
    )
    return ranges.range_members(records, "id", asked, "ids")


@query(
    "replace_children",
    f"""WITH {SAMPLES} SELECT gsm_id, sample_title FROM samples
      WHERE gsm_id NOT IN (SELECT 'GSM' || o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    UNION ALL SELECT 'GSM' || s_suppkey, 'posted ' || s_name FROM supplier""",
)
def replace_children(spark: SparkSession, sf: str) -> DataFrame:
    urgent = inputs.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    removed = urgent.selectExpr("concat('GSM', o_custkey) AS gsm_id")
    posted = inputs.table(spark, sf, "supplier").selectExpr(
        "concat('GSM', s_suppkey) AS gsm_id", "concat('posted ', s_name) AS sample_title"
    )
    samples = inputs.samples(spark, sf).select("gsm_id", "sample_title")
    return catalog.replace_children(samples, removed, posted, "gsm_id")


