"""Stores kept up to date from a stream of rows: each micro-batch is merged by key into the buckets it touches."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacquer.operators.merge import combine_states, merge_states
from lacquer.session import materialise

BUCKETS = 64
#: Versions a reader may still be reading.
KEPT_VERSIONS = 2


def _fs(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _manifests(spark: SparkSession, path: str) -> list[int]:
    root, fs = _fs(spark, f"{path}/manifests")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(root) if s.getPath().getName().isdigit()) if fs.exists(root) else []


def store_version(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The number and the manifest of the newest version: the folder of each bucket, the column types, and the last batch of each query."""
    known = _manifests(spark, path)
    if not known:
        return -1, {"buckets": {}, "schema": None, "batches": {}}
    return known[-1], json.loads(_read_text(spark, f"{path}/manifests/{known[-1]}"))


def _states(spark: SparkSession, path: str, manifest: dict, buckets: set[str] | None = None) -> DataFrame | None:
    folders = [f"{path}/data/{v}/bucket={b}" for b, v in manifest["buckets"].items() if buckets is None or b in buckets]
    return spark.read.schema(manifest["schema"]).parquet(*folders) if folders else None


def latest_version(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The number of the newest version of a store, and its rows: keys, order columns of the first row, merged columns."""
    number, manifest = store_version(spark, path)
    states = _states(spark, path, manifest)
    if states is None:
        return number, None
    columns = [F.col(c) if c in states.columns else F.transform(f"{c}__at", lambda x: x["e"]).alias(c) for c in manifest["columns"]]
    return number, states.select(*manifest["keys"], "first_seen.*", *columns)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint gives its query, which is the same after every restart."""
    return json.loads(_read_text(spark, f"{checkpoint}/metadata"))["id"]


def merge_batch(batch: DataFrame, path: str, keys: list[str], order: list[str], policies: dict[str, str], query: str, number: int, buckets: int = BUCKETS) -> bool:
    """Merge one batch into the store; false if this batch of this query is in it already.

    A value keeps the order it came with, so late rows find their place whatever batch they come
    in.  Only buckets with keys of the batch are rewritten; the new version appears as a whole
    with its manifest, and versions no reader may need any more are removed.
    """
    spark = batch.sparkSession
    version, manifest = store_version(spark, path)
    if manifest["batches"].get(query, -1) >= number:
        return False
    buckets = manifest.get("of", buckets)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
    new = materialise(merge_states(batch, keys, F.struct(*order), policies).withColumn("bucket", bucket), "stream-batch")
    touched = {r.bucket for r in new.select("bucket").distinct().collect()}  # at most the buckets
    columns = [c for c in new.columns if c != "bucket"]
    old = _states(spark, path, manifest, touched)
    both = new.drop("bucket") if old is None else new.drop("bucket").unionByName(old)
    merged = combine_states(both, keys, policies).select(*columns)
    target = version + 1
    merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/{target}")
    state = {
        "of": buckets, "keys": keys, "columns": list(policies), "schema": _ddl(merged),
        "buckets": manifest["buckets"] | dict.fromkeys(sorted(touched), str(target)), "batches": manifest["batches"] | {query: number},
    }
    _commit(spark, path, target, state)
    _clean(spark, path)
    return True


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _commit(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """A manifest is written aside and renamed, so that it is there as a whole or not at all."""
    part, fs = _fs(spark, f"{path}/manifests/_part-{number}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    final, _ = _fs(spark, f"{path}/manifests/{number}")
    if not fs.rename(part, final):
        raise OSError(f"version {number} of {path} is there already: two queries write one store")


def _clean(spark: SparkSession, path: str) -> None:
    known = _manifests(spark, path)
    kept = known[-KEPT_VERSIONS:]
    used = {v for n in kept for v in json.loads(_read_text(spark, f"{path}/manifests/{n}"))["buckets"].values()}
    for n in known[:-KEPT_VERSIONS]:
        at, fs = _fs(spark, f"{path}/manifests/{n}")
        fs.delete(at, False)
    root, fs = _fs(spark, f"{path}/data")
    for s in fs.listStatus(root):
        if s.getPath().getName() not in used and int(s.getPath().getName()) < kept[-1]:
            fs.delete(s.getPath(), True)


def upsert_stream(rows: DataFrame, path: str, keys: list[str], order: list[str], policies: dict[str, str], checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Merge every micro-batch into the store at ``path`` (see ``merge_batch``).

    A batch that is repeated after a failure is merged once; a query with a new checkpoint counts
    its batches anew, and none of them is taken for another query's.
    """
    columns = list(dict.fromkeys([*keys, *order, *policies]))

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch.select(*columns), path, keys, order, policies, _query_id(batch.sparkSession, checkpoint), number, buckets)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(rows: DataFrame, event_time: str, loaded: str, keys: list[Column], delay: str = "7 days", window: str = "1 day") -> DataFrame:
    """Rows per window of event time, with a watermark: what comes later than the delay is left out of closed windows."""
    return rows.withWatermark(event_time, delay).groupBy(F.window(event_time, window), *keys).agg(F.count("*").alias("rows"))
