"""Version history laid out by object.

Every job groups the history by object, and extraction reads it twice. Written once
as buckets by (type, id), sorted inside, it is read without an exchange: the
aggregates and the join of the survivors find each object in one bucket. Worth it for a
history that is read more than once; one that is read once is better read as it is.

A bucket is one file and one task. Objects have few versions against a bucket, but
an object with a large share of all rows makes its bucket as large; for such a
history ``read_history`` is the way, whose plan spreads an object over its editors.

A small file beside the buckets states how the table is laid out, so a reader in
another session needs the folder only.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.schema import HISTORY, validate
from strata.session import plan_bytes
from strata.sources.tables import _hadoop, refuse_self_overwrite, staged_uri, swap_in

KEYS = ["type", "id"]
ORDER = [*KEYS, "version"]
NOTE = "_layout.json"

#: Bytes of the input that a bucket holds unless their number is given. A bucket is
#: one task, whose aggregates take up to 60 times as much memory.
BUCKET_BYTES = 8 << 20

#: Unless it is "false", Spark joins by all keys of (type, id, version) and deals the history anew.
JOIN_BY_BUCKET = "spark.sql.requireAllClusterKeysForCoPartition"


def write_history_by_object(history: DataFrame, uri: str, buckets: int | None = None) -> int:
    """Write ``history`` as ``buckets`` buckets by (type, id), sorted by
    (type, id, version); returns their number, which unless given holds a bucket
    to ``BUCKET_BYTES`` of the input, up to Spark's limit of buckets. Replaces an older layout once it is complete.
    Rows without a type or id are kept (all readers drop them)."""
    spark = history.sparkSession
    validate(history, HISTORY, "history", required=ORDER)
    refuse_self_overwrite(history, uri)
    if buckets is None:
        size = plan_bytes(history)
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        buckets = min(most, max(1, math.ceil(size / BUCKET_BYTES))) if size < 1 << 60 else int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged, table = staged_uri(uri), f"strata_staged_{uuid.uuid4().hex}"
    fs, path = _hadoop(spark, staged)
    try:
        # One task per bucket writes one file: the shuffle deals rows as the buckets do.
        (history.repartition(buckets, *KEYS).write.format("parquet").option("path", path.toString())
                .bucketBy(buckets, *KEYS).sortBy(*ORDER).saveAsTable(table))
        note = {"buckets": buckets, "schema": spark.table(table).schema.jsonValue()}
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(path, NOTE))
        out.write(bytearray(json.dumps(note).encode()))
        out.close()
        swap_in(spark, staged, uri)
    except BaseException:
        fs.delete(path, True)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return buckets


def read_history_by_object(spark: SparkSession, uri: str) -> DataFrame:
    """The table that ``write_history_by_object`` left; Spark knows its buckets.
    Joins on (type, id) and more use them where the session has ``JOIN_BY_BUCKET``
    at "false", as the jobs set it."""
    fs, path = _hadoop(spark, uri)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(path, NOTE))
    note = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    schema, n = T.StructType.fromJson(note["schema"]), note["buckets"]
    # An identifier of its own per layout: one that was replaced may have other buckets.
    table = "strata_history_" + hashlib.md5(f"{path} {json.dumps(note)}".encode()).hexdigest()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) "
              f"SORTED BY ({', '.join(ORDER)}) INTO {n} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)
