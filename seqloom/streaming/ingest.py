"""Incremental ingest: records arrive batch by batch, the first write of a key wins.

The stored table is the state: entries of rows, each with a compact key filter beside its buckets, listed in a manifest.
A batch is compared with the filters of what is stored (four bytes a key, in the buckets that the batch touches) and only
where they hit with stored keys themselves. It is then written as an entry of its own and published at once. Whoever
finds that another writer came first compares again, so streams that bring the same keys at one time end as if they
had come one after the other, and a crash leaves either the old state or the new one.

An entry has as many buckets as its own rows ask for, so small batches are one bucket and a table of any size
has buckets of bounded size; entries of one size are merged once there are many. Writing a batch again replaces its
entry; once it is merged with others it is committed and writing it again changes nothing. A batch's order comes
from a source column, never from arrival.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seqloom.operators.positions import first_by_key
from seqloom.selectors import Names, as_names
from seqloom.sources import manifest, storage
from seqloom.staging import scope, stage

BATCH, SOURCE, BUCKET = "batch", "source", "bucket"
#: Rows that one bucket of an entry is meant to hold at most.
BUCKET_ROWS = 1 << 20
#: Entries of one size (within this factor) before they are merged.
FAN = 64
#: Buckets that a batch may name to the scan; more are read without naming them.
MOST_NAMED = 4096
_HASH, _FILTER, _ENTRY, _DEEPEST = "__hash", "__filter", "entry", 30
#: Partition columns of an entry's folders.
_PLACE = [T.StructField(_ENTRY, T.StringType()), T.StructField(BUCKET, T.IntegerType())]


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SOURCE, T.StringType()), T.StructField(BATCH, T.LongType()), *_PLACE])


def _read(spark: SparkSession, root: str, entries: list[dict], schema: T.StructType) -> DataFrame:
    folders = [f"{root}/{_ENTRY}={e['name']}" for e in entries if e["rows"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def read_ingested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table so far, with the source and the batch each row came in and its key bucket."""
    return _read(spark, path, manifest.latest(spark, path)[1], _stored(schema)).drop(_ENTRY)


def _bucket(depth: int) -> Column:
    """The key's bucket among 2^depth, from the upper half of its hash; the filter has the lower half."""
    return F.shiftrightunsigned(_HASH, 64 - depth).cast("int") if depth else F.lit(0)


def _depth(rows: int, bucket_rows: int) -> int:
    return min(_DEEPEST, max(0, (-(-rows // bucket_rows) - 1).bit_length()))


def _fingerprint() -> Column:
    return F.expr(f"CAST({_HASH} & 4294967295L AS BIGINT)").bitwiseXOR(F.lit(1 << 31)) - F.lit(1 << 31)


def _spans(spans: list[list[int]]) -> list[list[int]]:
    """Batch numbers as first-last pairs, neighbours joined."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _write(spark: SparkSession, rows: DataFrame, path: str, depth: int, batches: dict[str, list[list[int]]]) -> dict:
    """One entry: rows (with their hash, source and batch) in folders by bucket, their filter beside them."""
    name = uuid.uuid4().hex
    placed = rows.withColumn(BUCKET, _bucket(depth)).repartition(BUCKET)
    folder = f"{path}/{_ENTRY}={name}"
    placed.write.partitionBy(BUCKET).parquet(folder)
    data = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
    prints = data.select(_fingerprint().cast("int").alias("print"), BUCKET).repartition(BUCKET).sortWithinPartitions(BUCKET, "print")
    prints.write.partitionBy(BUCKET).parquet(f"{path}/_filters/{_ENTRY}={name}")
    return {"name": name, "depth": depth, "rows": data.count(), "batches": batches}


def _drop(spark: SparkSession, path: str, entry: dict) -> None:
    storage.delete(spark, f"{path}/{_ENTRY}={entry['name']}")
    storage.delete(spark, f"{path}/_filters/{_ENTRY}={entry['name']}")


def _known(spark: SparkSession, path: str, entries: list[dict], fresh: DataFrame, keys: list[str], rows: int) -> DataFrame | None:
    """The keys of `fresh` that are stored; None where no filter hits, without a look at any stored key."""
    found = []
    schema = T.StructType([T.StructField("print", T.IntegerType()), *_PLACE])
    for depth in sorted({e["depth"] for e in entries if e["rows"]}):
        alike = [e for e in entries if e["depth"] == depth and e["rows"]]
        asked = fresh.select(_bucket(depth).alias(BUCKET), _fingerprint().cast("int").alias("print")).distinct()
        filters = _read(spark, f"{path}/_filters", alike, schema)
        if depth and rows <= MOST_NAMED:
            filters = filters.filter(F.col(BUCKET).isin([r[0] for r in asked.select(BUCKET).distinct().collect()]))
        hits = filters.join(asked, [BUCKET, "print"], "left_semi").select(_ENTRY, BUCKET).distinct()
        places = hits.limit(MOST_NAMED + 1).collect()
        if not places:
            continue
        stored = T.StructType([*[fresh.schema[k] for k in keys], *_PLACE])
        hit: dict[str, list[int]] = {}
        for place in places:
            hit.setdefault(place[_ENTRY], []).append(place[BUCKET])
        if len(places) > MOST_NAMED:
            data = _read(spark, path, alike, stored)
        else:
            named = [(F.col(_ENTRY) == e) & F.col(BUCKET).isin(b) for e, b in hit.items()]
            data = _read(spark, path, [e for e in alike if e["name"] in hit], stored).filter(reduce(Column.__or__, named))
        found.append(data.select(*keys).join(fresh.select(*keys), keys, "left_semi"))
    return reduce(DataFrame.unionByName, found) if found else None


def append_new(
    batch: DataFrame, batch_id: int, path: str, key: Names, order: Names, source: str = "batch", bucket_rows: int = BUCKET_ROWS
) -> None:
    """Store the rows of one batch whose key no other batch has stored.

    The batch's own first writes are stored for the time of the merge: the source is read once, and Spark
    knows their size.
    """
    spark, keys = batch.sparkSession, as_names(key)
    with scope(spark):
        firsts = first_by_key(batch.dropna(subset=keys), keys, order)
        fresh = stage(firsts.withColumn(_HASH, F.xxhash64(*keys)), "batch")
        rows = fresh.count()
        while True:
            version, live = manifest.latest(spark, path)
            own = [e for e in live if any(a <= batch_id <= b for a, b in e["batches"].get(source, []))]
            if any(e["batches"] != {source: [[batch_id, batch_id]]} for e in own):
                return  # merged with others: committed long ago
            others = [e for e in live if e not in own]
            known = _known(spark, path, others, fresh, keys, rows)
            added = fresh if known is None else fresh.join(known, keys, "left_anti")
            tagged = added.withColumns({SOURCE: F.lit(source), BATCH: F.lit(batch_id).cast("long")})
            entry = _write(spark, tagged, path, _depth(rows, bucket_rows), {source: [[batch_id, batch_id]]})
            if manifest.publish(spark, path, version + 1, [*others, entry]):
                return
            _drop(spark, path, entry)


def merge_entries(
    spark: SparkSession, path: str, schema: T.StructType, key: Names, fan: int = FAN, bucket_rows: int = BUCKET_ROWS
) -> bool:
    """Merge the entries of one size, smallest first, once there are `fan` of them; whether any were.

    What is read stays the same, so rows move once for every factor of `fan` that the table grows by.
    """
    live = manifest.latest(spark, path)[1]
    tiers: dict[int, list[dict]] = {}
    for entry in live:
        tier, size = 0, entry["rows"]
        while size >= fan:
            tier, size = tier + 1, size // fan
        tiers.setdefault(tier, []).append(entry)
    many = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan), None)
    if many is None:
        return False
    batches: dict[str, list[list[int]]] = {}
    for entry in many:
        for source, spans in entry["batches"].items():
            batches[source] = _spans([*batches.get(source, []), *map(list, spans)])
    rows = _read(spark, path, many, _stored(schema)).drop(_ENTRY, BUCKET).withColumn(_HASH, F.xxhash64(*as_names(key)))
    merged = _write(spark, rows, path, _depth(sum(e["rows"] for e in many), bucket_rows), batches)
    while True:
        version, live = manifest.latest(spark, path)
        if any(e not in live for e in many):  # one was written again meanwhile
            _drop(spark, path, merged)
            return False
        if manifest.publish(spark, path, version + 1, [*[e for e in live if e not in many], merged]):
            return True


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete entries that the newest `keep` manifests do not list; call it when no open frame reads them."""
    for entry in manifest.forget(spark, path, keep)[0]:
        _drop(spark, path, entry)


def start_ingest(stream: DataFrame, path: str, checkpoint: str, key: Names, order: Names) -> StreamingQuery:
    """Ingest everything available now and stop; call again for what arrives later.

    The checkpoint names the source, so a new checkpoint is a new source beside the old ones.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    schema = stream.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, batch_id, path, key, order, source)
        merge_entries(batch.sparkSession, path, schema, key)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 64) -> DataFrame:
    """Stream the Parquet files of a folder, or the one file at `path`."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if storage.is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)
