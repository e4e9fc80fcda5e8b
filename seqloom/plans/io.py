"""Queries for sources, sinks and the stream: write from the tables, read back, compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.operators import sequence
from seqloom.plans import inputs
from seqloom.plans.inputs import RUN_TABLE
from seqloom.plans.registry import query
from seqloom.selectors import POS
from seqloom.sources import documents, listing, markup, nested, tables, tsv
from seqloom.staging import new_path
from seqloom.streaming import ingest

# --- generated and text sequences ----------------------------------------------------


@query(
    "src_range",
    """SELECT l_orderkey, l_linenumber, i AS _pos, i * 3 + 1 AS value
    FROM lineitem, range(8) AS t(i) WHERE i < l_linenumber""",
)
def src_range(spark: SparkSession, sf: str) -> DataFrame:
    """A generated sequence for every line, as long as its number."""
    lines = inputs.table(spark, sf, "lineitem")
    lengths = lines.selectExpr("l_orderkey", "l_linenumber", "CAST(l_linenumber AS BIGINT) AS n")
    return documents.sequences_of(lengths, "n", f"{POS} * 3 + 1")


@query(
    "src_json_array",
    """SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS _pos, CAST(unnest(embedding) AS DOUBLE) AS value
    FROM embeddings""",
)
def src_json_array(spark: SparkSession, sf: str) -> DataFrame:
    texts = inputs.table(spark, sf, "embeddings").select("vec_id", F.to_json("embedding").alias("text"))
    values = documents.from_json_array(texts, "text", "FLOAT")
    return values.withColumn("value", F.col("value").cast("double"))


@query(
    "src_split_string",
    """SELECT doc_id, CAST(unnest(range(len(pieces))) AS INTEGER) AS _pos, unnest(pieces) AS value
    FROM (SELECT doc_id, string_split(text, '. ') AS pieces FROM documents)""",
)
def src_split_string(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return documents.from_string(docs, "text", ". ")


# --- tables --------------------------------------------------------------------------


@query(
    "src_table_open_or_create",
    """SELECT 'GSM' || c_custkey AS accession_id, c_name AS title, c_mktsegment AS species,
    'GSE' || c_nationkey AS parent_gse_id FROM customer""",
)
def src_table_open_or_create(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "samples")
    empty = tables.open_or_create(spark, path, tables.SAMPLES)
    fetched = inputs.table(spark, sf, "customer").selectExpr(
        "concat('GSM', c_custkey) AS accession",
        "c_name AS title",
        "c_name AS summary",
        "c_mktsegment AS taxon",
        "'' AS ftplink",
        "'' AS SRA",
        "concat('GSE', c_nationkey) AS parent_gse",
    )
    tables.replace(empty.unionByName(sequence.rename_to_scheme(fetched, tables.SAMPLE_SCHEME)), path)
    opened = tables.open_or_create(spark, path, tables.SAMPLES)
    return opened.select("accession_id", "title", "species", "parent_gse_id")


@query("sink_parquet", "SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders")
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "orders")
    first = tables.replace(inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), path)
    return tables.replace(first.withColumn("o_custkey", F.col("o_custkey") + 1), path)


@query("src_tsv", "SELECT 'GSM' || c_custkey AS gsm_id, c_name AS sample_name FROM customer")
def src_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "runs")
    rows = inputs.table(spark, sf, "customer").selectExpr("concat('GSM', c_custkey) AS gsm_id", "c_name AS sample_name")
    tsv.write_tsv(rows, path)
    return tsv.read_tsv(spark, path, tsv.RUN_LIST)


@query("src_tsv_checked_header", "SELECT 'SRR' || o_orderkey AS SRR_ID, o_orderpriority AS sample_name FROM orders")
def src_tsv_checked_header(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "samples")
    rows = inputs.table(spark, sf, "orders").selectExpr(
        "concat('SRR', o_orderkey) AS SRR_ID", "o_orderpriority AS sample_name"
    )
    tsv.write_tsv(rows, path)
    return tsv.read_checked(spark, path)


@query(
    "sink_tsv",
    f"""WITH {RUN_TABLE} SELECT dumped_filepath, run_id, lane_id, read_type, CAST(_pos % 8 AS INTEGER) AS replicate,
      'a' || chr(10) || '\\n' || chr(9) || '"' || run_id || ' \\' AS spieces FROM run_table""",
)
def sink_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Nulls, empty cells, and cells with line ends, tabs, quotes and backslashes."""
    path = new_path(spark, "runtable")
    table = inputs.run_table(spark, sf).withColumns(
        {
            "raw_filename": F.col("dumped_filename"),
            "sample_id": F.lit("1"),
            "spieces": F.concat(F.lit('a\n\\n\t"'), F.col("run_id"), F.lit(" \\")),
            "replicate": (F.col(POS) % 8).cast("int"),
        }
    )
    tsv.write_tsv(table.select(*tsv.RUN_TABLE.names), path)
    back = tsv.read_tsv(spark, path, tsv.RUN_TABLE)
    return back.select("dumped_filepath", "run_id", "lane_id", "read_type", "replicate", "spieces")


# --- nested store --------------------------------------------------------------------


def _sections(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    series = inputs.table(spark, sf, "customer").selectExpr(
        "concat('GSE', c_custkey) AS runid",
        "c_name AS title",
        "c_name AS summary",
        "array(c_mktsegment, 'other') AS species",
        "'' AS raw_link",
        "'' AS projna_id",
        "'' AS srp_id",
        """transform(sequence(0L, 2L), j -> named_struct('accession', concat('GSM', c_custkey * 3 + j),
        'title', concat('t', j))) AS child_gsm_ids""",
    )
    samples = inputs.table(spark, sf, "orders").selectExpr(
        "concat('GSM', o_orderkey) AS runid",
        "o_orderpriority AS title",
        "'' AS summary",
        "o_orderstatus AS species",
        "'' AS raw_link",
        "'' AS srx_id",
        "array(concat('SRR', o_orderkey * 2), concat('SRR', o_orderkey * 2 + 1)) AS child_srr_ids",
        "concat('GSE', o_custkey) AS parent_gse_id",
    )
    runs = inputs.run_files(spark, sf).selectExpr(
        "run_id AS runid",
        "path",
        "size",
        "'Fastq' AS filetype",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'L001' END AS lane_id",
        "'R1' AS readtype",
        "concat('GSM', l_partkey) AS parent_gsm",
    )
    return {"GSE": series, "GSM": samples, "SRR": runs}


def _flat(sections: dict[str, DataFrame]) -> DataFrame:
    """Every nested value of the three sections as (section, id, place, value)."""
    series = sections["GSE"].select(
        F.lit("GSE").alias("section"), "runid", F.posexplode("child_gsm_ids.accession").alias("place", "value")
    )
    species = sections["GSE"].select(
        F.lit("species").alias("section"), "runid", F.posexplode("species").alias("place", "value")
    )
    samples = sections["GSM"].select(
        F.lit("GSM").alias("section"), "runid", F.posexplode("child_srr_ids").alias("place", "value")
    )
    runs = sections["SRR"].select(
        F.lit("SRR").alias("section"),
        "runid",
        F.lit(0).alias("place"),
        F.concat_ws("|", "path", "size", F.coalesce("lane_id", F.lit("none"))).alias("value"),
    )
    return series.unionByName(species).unionByName(samples).unionByName(runs)


_STORE = f"""WITH {inputs.RUN_FILES}
  SELECT 'GSE' AS section, 'GSE' || c_custkey AS runid, j AS place, 'GSM' || (c_custkey * 3 + j) AS value
    FROM customer, (VALUES (0), (1), (2)) AS t(j)
  UNION ALL SELECT 'species', 'GSE' || c_custkey, j, CASE j WHEN 0 THEN c_mktsegment ELSE 'other' END
    FROM customer, (VALUES (0), (1)) AS t(j)
  UNION ALL SELECT 'GSM', 'GSM' || o_orderkey, j, 'SRR' || (o_orderkey * 2 + j) FROM orders, (VALUES (0), (1)) AS t(j)
  UNION ALL SELECT 'SRR', run_id, 0, path || '|' || size || '|' || CASE WHEN l_linenumber % 2 = 0
    THEN 'L001' ELSE 'none' END FROM run_files"""


@query("src_nested_store", _STORE)
def src_nested_store(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the series records are written in the older spelling."""
    path = new_path(spark, "store")
    sections = _sections(spark, sf)
    old = F.crc32(F.col("runid")) % 2 == 0
    nested.write_store({**sections, "GSE": sections["GSE"].filter(~old)}, path)
    older = sections["GSE"].filter(old).withColumnRenamed("runid", "id")
    older.withColumn("species", F.array_join("species", "; ")).write.mode("append").json(f"{path}/GSE")
    return _flat(nested.read_store(spark, path))


@query("sink_nested_store", _STORE)
def sink_nested_store(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "store")
    nested.write_store(_sections(spark, sf), path)
    written = {name: spark.read.schema(s).json(f"{path}/{name}") for name, s in nested.SECTIONS.items()}
    return _flat(written)


# --- JSON ----------------------------------------------------------------------------


@query(
    "sink_json_array",
    """SELECT o_custkey, 0 AS part, '[' || string_agg('"' || o_orderpriority || '"', ',' ORDER BY o_orderkey) || ']' AS json
    FROM orders GROUP BY o_custkey""",
)
def sink_json_array(spark: SparkSession, sf: str) -> DataFrame:
    arrays = documents.to_json_array(inputs.orders_in_order(spark, sf), "o_orderpriority", by="o_custkey")
    return arrays.withColumn("part", F.col("part").cast("int"))


@query(
    "sink_json_documents",
    f"""WITH {RUN_TABLE} SELECT run_id, '{{"run_id":"' || run_id || '","sc_runs":[' || string_agg(
      '{{"cloud_filepath":"' || cloud_filepath || '","lane_id":' || coalesce('"' || lane_id || '"', 'null')
      || ',"read_type":"' || read_type || '"}}', ',' ORDER BY _pos) || ']}}' AS json
    FROM run_table GROUP BY run_id""",
)
def sink_json_documents(spark: SparkSession, sf: str) -> DataFrame:
    table = inputs.run_table(spark, sf)
    fields = ["cloud_filepath", "lane_id", "read_type"]
    return documents.json_documents(table, "run_id", fields, children="sc_runs").select("run_id", "json")


# --- XML and HTML --------------------------------------------------------------------


@query(
    "src_run_xml",
    f"""WITH {RUN_TABLE}, listed AS (SELECT *, CAST(substr(run_id, 4) AS BIGINT) AS o FROM run_table)
    SELECT run_id, gsm_id, 'Homo sapiens' AS organism, true AS found,
      CAST(2 * (_pos - o * 8) AS INTEGER) AS place, cloud_filepath AS path,
      CASE WHEN cloud_filepath LIKE '%.fastq%' THEN 'fastq' ELSE 'bam' END AS filetype,
      (o * 1000 + 512) / 1073741824.0::DOUBLE AS size_gb,
      CASE WHEN filetype = 'bam' THEN 'Unknown' WHEN regexp_extract(cloud_filepath, '_([RI][12])', 1) = ''
        THEN 'Unknown' ELSE regexp_extract(cloud_filepath, '_([RI][12])', 1) END AS read_type
    FROM listed WHERE o % 17 <> 0 AND o % 19 <> 0
    UNION ALL SELECT 'SRR' || o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN 'GSM' || o_custkey END,
      CASE WHEN o_orderkey % 17 <> 0 THEN 'Homo sapiens' END, false, NULL, NULL, NULL, NULL, NULL
    FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0""",
)
def src_run_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Run documents: two runs of two members, every original file followed by a derived one; some without files, some broken."""
    files = F.expr(
        f"""array_join(transform(sequence(0L, {inputs.N_FILES} - 1), j -> concat(
        '<SRAFile supertype="Original" size="', o_orderkey * 1000 + 512, '"><Alternatives url="',
        {inputs.RUN_COLUMNS["cloud_filepath"]}, '"/><Alternatives url="other"/></SRAFile>',
        '<SRAFile supertype="Primary ETL" size="1"/>')), '')"""
    )
    head = F.expr(
        """concat('<RUN_SET><RUN accession="SRR', o_orderkey, '"><Pool><Member sample_name="GSM', o_custkey,
        '" organism="Homo sapiens"/><Member sample_name="second" organism="other"/></Pool><SRAFiles>')"""
    )
    second = (
        '</SRAFiles></RUN><RUN accession="x"><Pool><Member sample_name="other" organism="other"/></Pool><SRAFiles>'
        '<SRAFile supertype="Original" size="1"><Alternatives url="late.bam"/></SRAFile></SRAFiles></RUN></RUN_SET>'
    )
    given = F.when(F.col("o_orderkey") % 19 == 0, F.lit("")).otherwise(files)
    whole = F.concat(head, given, F.lit(second))
    orders = inputs.spread(inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey"))
    texts = orders.select(
        F.expr("concat('SRR', o_orderkey) AS run_id"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit("<RUN_SET><RUN>cut off")).otherwise(whole).alias("xml"),
    )
    return markup.run_files_from_xml(texts, "xml")


@query(
    "src_html_list",
    r"""WITH items AS (SELECT page_id, html, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS li FROM pages),
      rows AS (SELECT page_id, html, CAST(unnest(range(len(li))) AS INTEGER) AS row, unnest(li) AS item FROM items)
    SELECT page_id, row, trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g'))
      AS heading, regexp_extract(item, '<a href="([^"]*)"', 1) AS link,
      trim(regexp_replace(item, '<[^>]*>', '', 'g')) AS text FROM rows""",
)
def src_html_list(spark: SparkSession, sf: str) -> DataFrame:
    return markup.list_rows_from_html(inputs.table(spark, sf, "pages").select("page_id", "html"), "html")


_HTML_FILES = f"""WITH {RUN_TABLE}, files AS (SELECT *, CAST(substr(run_id, 4) AS BIGINT) AS o FROM run_table)
    SELECT run_id, gsm_id, 'Homosapiens' AS species, CAST(_pos - o * 8 + 1 AS INTEGER) AS row, cloud_filepath AS name,
      CAST(o AS VARCHAR) || 'M' AS size, location, egress FROM files"""
_CELLS = ("Name", "Size", "Location", "Free Egress")


def _run_pages(spark: SparkSession, sf: str, before: str = "") -> DataFrame:
    """Run pages: a heading, a table with a header, one row per file and one short row to skip."""
    rows = F.expr(
        f"""array_join(transform(sequence(0L, {inputs.N_FILES} - 1), j -> concat('<tr><td>',
        {inputs.RUN_COLUMNS["cloud_filepath"]}, '</td><td>', o_orderkey, 'M</td><td>', {inputs.RUN_COLUMNS["location"]},
        '</td>\n<td class="e"> ', {inputs.RUN_COLUMNS["egress"]}, ' </td></tr>')), '')"""
    )
    heading = F.expr("concat('<h1>GSM', o_custkey, ': a run; Homo sapiens; x (SRR', o_orderkey, ')</h1>')")
    head = "<table><thead><tr><th>Name</th><th>Size</th><th>Location</th><th>Free Egress</th></tr></thead><tbody>"
    table = F.concat(F.lit(head), rows, F.lit("<tr><td>no</td></tr></tbody></table>"))
    orders = inputs.spread(inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey"))
    return orders.select("o_orderkey", heading.alias("heading"), F.concat(heading, F.lit(before), table).alias("html"))


def _cells(found: DataFrame, *more: str | Column) -> DataFrame:
    names = dict(zip(_CELLS, ("name", "size", "location", "egress"), strict=True))
    return found.select("run_id", "gsm_id", "species", "row", *more, *[F.element_at("cells", h).alias(n) for h, n in names.items()])


@query("src_html_table", _HTML_FILES)
def src_html_table(spark: SparkSession, sf: str) -> DataFrame:
    pages = _run_pages(spark, sf).select("html")
    return _cells(markup.heading_fields(markup.table_rows_from_html(pages, "html")))


@query(
    "src_html_rows",
    f"""WITH pages AS (SELECT DISTINCT run_id, gsm_id, species FROM ({_HTML_FILES}) WHERE CAST(substr(run_id, 4) AS BIGINT) % 23 <> 0)
    SELECT run_id, gsm_id, species, row, 2 AS "table", name, size, location, egress, NULL AS place FROM ({_HTML_FILES})
      WHERE CAST(substr(run_id, 4) AS BIGINT) % 23 <> 0
    UNION ALL SELECT run_id, gsm_id, species, 1, 0, NULL, NULL, NULL, NULL, 's3 near' FROM pages
    UNION ALL SELECT run_id, gsm_id, species, 1, 1, NULL, NULL, NULL, NULL, 'inner' FROM pages
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 23 = 0""",
)
def src_html_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a table inside a cell of another before the table of files; some without tables and with a broken heading."""
    inner = "<table><tr><th>Place</th></tr><tr><td>inner</td></tr></table>"
    places = f"<table><tr><th>Place</th><th>Cost</th></tr><tr><td>s3 {inner}near</td><td>0</td></tr></table>"
    pages = _run_pages(spark, sf, places)
    empty = F.col("o_orderkey") % 23 == 0
    html = F.when(empty, F.lit("<h1>GSM1: only</h1><p>no files</p>")).otherwise(F.col("html"))
    found = markup.heading_fields(markup.table_rows_from_html(pages.select(html.alias("html")), "html"))
    return _cells(found, "table", F.element_at("cells", "Place").alias("place"))


@query(
    "src_html_nested_lists",
    """WITH items AS (SELECT o_orderkey, unnest(range(1 + o_orderkey % 3)) AS i FROM orders)
    SELECT o_orderkey, CAST(i AS INTEGER) AS row, '/o/' || i AS link, 'outer ' || i AS text FROM items
    UNION ALL SELECT o_orderkey, CAST(1 + o_orderkey % 3 + i AS INTEGER), '', 'inner ' || i FROM items""",
)
def src_html_nested_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A list whose every item holds a list of one item."""
    html = F.expr(
        """concat('<h1>x</h1><ul>', array_join(transform(sequence(0L, o_orderkey % 3), i -> concat('<li><a href="/o/', i,
        '">outer ', i, '</a><ol><li>inner ', i, '</li></ol></li>')), ' '), '</ul>')"""
    )
    pages = inputs.table(spark, sf, "orders").select("o_orderkey", html.alias("html"))
    return markup.list_rows_from_html(pages, "html").drop("heading")


# --- listing -------------------------------------------------------------------------


@query("src_file_listing", "SELECT DISTINCT 'GSE' || c_nationkey AS id FROM customer")
def src_file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Write one folder of result files per series and list which series have one."""
    root = new_path(spark, "resources")
    rows = inputs.table(spark, sf, "customer").selectExpr("c_name", "concat('GSE', c_nationkey) AS series")
    rows.write.partitionBy("series").json(root)
    found = listing.file_listing(spark, root)
    return listing.dumped_ids(found, "/series=([^/]+)/", extensions=(".json",))


# --- stream --------------------------------------------------------------------------


@query(
    "stream_upsert_first_wins",
    """SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type
    FROM events GROUP BY user_id""",
)
def stream_upsert_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
        ]
    )
    path, folder = new_path(spark, "ingested"), new_path(spark, "arriving")
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    # what arrives later has later event ids, as the order column asks for
    cuts = events.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.01)
    progress = new_path(spark, "progress")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        later = F.lit(True) if low is None else F.col("event_id") >= low
        earlier = F.lit(True) if high is None else F.col("event_id") < high
        events.filter(later & earlier).write.mode("append").parquet(folder)
        ingest.start_ingest(ingest.file_stream(spark, folder, schema), path, progress, "user_id", "event_id").awaitTermination()
    # all of it again under a new checkpoint: nothing is lost and nothing is new
    stream = ingest.file_stream(spark, folder, schema)
    ingest.start_ingest(stream, path, new_path(spark, "progress"), "user_id", "event_id").awaitTermination()
    return ingest.read_ingested(spark, path, schema).drop(ingest.BATCH, ingest.SOURCE, ingest.BUCKET)


@query(
    "stream_row_functions",
    """SELECT event_id, upper(event_type) AS kind, value * 2 AS doubled FROM events WHERE NOT event_type = 'error'""",
)
def stream_row_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Row operators run unchanged on a stream."""
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    events = ingest.file_stream(spark, f"{sf}/events.parquet", schema)
    kept = sequence.where(events, lambda r: r["event_type"] != "error")
    mapped = sequence.select(kept, event_id="event_id", kind="upper(event_type)", doubled="value * 2")
    path = new_path(spark, "mapped")
    out = mapped.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "progress"))
    out.trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(mapped.schema).parquet(path)
