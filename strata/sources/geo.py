"""GeoJSON and GeoParquet sinks.

GeoJSON is written as newline-delimited Features (one per line, RFC 8142
style), by every task in parallel. A FeatureCollection document is written
in parallel too: the features are globally sorted (range-partitioned), each
line carries its own separator, and a header and footer row sort before and
after them, so the part files concatenated in name order are the document
(``cat part-* > out.geojson``). No task holds the whole collection.

GeoParquet needs the ``geo`` key in the Parquet footer, which Spark's writer
cannot add, so each task writes its own file with pyarrow inside
``mapInArrow``; the driver commits the files of the attempts that counted. The
target must be a filesystem pyarrow can open (local, HDFS, S3).

Both sinks write beside their target and swap the result in at the end.
"""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.geo import (GEOMETRY_SOURCE_COLUMNS, feature_json, has_point, hilbert,
                                  iso_timestamp, marker_style, wkb_point)
from strata.scratch import Scratch
from strata.sources.tables import refuse_self_overwrite, staged_uri, swap_in


def features(df: DataFrame) -> DataFrame:
    """One ``feature`` JSON text per row; nodes first, then ways."""
    return df.select(F.col("type"), F.col("id"), feature_json(df).alias("feature"))


def write_geojson(df: DataFrame, uri: str, collection: bool = False) -> None:
    """Features as text under ``uri``. The output replaces an older one only
    when it is complete."""
    spark = df.sparkSession
    refuse_self_overwrite(df, uri)
    feats = features(df)
    staged = staged_uri(uri)
    if not collection:
        feats.select("feature").write.text(staged)
        swap_in(spark, staged, uri)
        return
    # nodes first, then the other types, each by id; written once, because the
    # first key, the sort's sample and the sort each read the features
    key = F.struct(F.when(F.col("type") == "node", 0).otherwise(1).alias("k"),
                   F.col("type").alias("t"), F.col("id").alias("i"))
    scratch = Scratch(spark, "geojson")
    keyed = scratch.save(feats.select(key.alias("key"), "feature"), "features")
    first = keyed.select(F.min("key")).scalar()      # one partial min per task
    body = keyed.select("key", F.when(F.col("key") == first, F.col("feature"))
                                 .otherwise(F.concat(F.lit(","), F.col("feature"))).alias("value"))

    def edge(k, text):
        return spark.createDataFrame([((k, "", 0), text)], body.schema)
    doc = (edge(-1, '{"type":"FeatureCollection","features":[')
           .unionByName(body)
           .unionByName(edge(2, "]}")))
    doc.orderBy("key").select("value").write.text(staged)
    swap_in(spark, staged, uri)
    scratch.close()


def geoparquet_frame(df: DataFrame, space_order: bool = False) -> DataFrame:
    """Node rows with a point: property columns, ``tags`` as JSON text,
    marker style and ``geometry`` as WKB. ``space_order`` deals and sorts them
    along a Hilbert curve and adds ``bbox``, each point's box."""
    pts = df.filter(has_point(df))
    if space_order:
        at = hilbert(F.col("last_lon"), F.col("last_lat"))
        pts = pts.withColumn("__at", at).repartitionByRange("__at", "type", "id").sortWithinPartitions("__at", "type", "id")
    cols = []
    for name in df.columns:
        if name in GEOMETRY_SOURCE_COLUMNS:
            continue
        dtype = df.schema[name].dataType
        if name == "good_tags":
            cols.append(F.to_json(F.col(name)).alias("tags"))
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            cols.append(iso_timestamp(F.col(name)).alias(name))
        else:
            cols.append(F.col(f"`{name}`"))
    signal = F.col("comment_signal") if "comment_signal" in df.columns else F.lit(None).cast("string")
    cols.extend(marker_style(signal))
    if space_order:
        lon, lat = F.col("last_lon").cast("double"), F.col("last_lat").cast("double")
        cols.append(F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax")).alias("bbox"))
    cols.append(wkb_point(F.col("last_lon"), F.col("last_lat")).alias("geometry"))
    return pts.select(*cols)


# WGS 84 as a PROJJSON object, the form GeoParquet 1.0.0 asks for.
CRS = {
    "$schema": "https://proj.org/schemas/v0.6/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84",
    "datum": {
        "type": "GeodeticReferenceFrame",
        "name": "World Geodetic System 1984",
        "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563},
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
        ],
    },
    "id": {"authority": "EPSG", "code": 4326},
}


def _geo_metadata(boxes: bool = False) -> bytes:
    column = {"encoding": "WKB", "geometry_types": ["Point"], "crs": CRS}
    if boxes:
        column["covering"] = {"bbox": {side: ["bbox", side] for side in ("xmin", "ymin", "xmax", "ymax")}}
    return json.dumps({"version": "1.1.0" if boxes else "1.0.0", "primary_column": "geometry", "columns": {"geometry": column}}).encode()


def _arrow_uri(uri: str) -> str:
    """Hadoop's S3 connector schemes name the same store pyarrow calls s3://."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            return "s3://" + uri[len(scheme):]
    return uri


def write_geoparquet(df: DataFrame, uri: str, space_order: bool = False, group_rows: int = 10_000) -> list[tuple[str, int]]:
    """Write GeoParquet files under ``uri``; returns (file name, rows) of each.

    ``space_order`` lays points that are near each other into the same files and
    row groups, with a ``bbox`` column whose statistics let a reader skip the row
    groups outside a box; ``group_rows`` bounds the rows of a row group.

    Every task attempt writes a file of its own name (its attempt id is unique
    in the application) into a staging folder. The driver gets one receipt
    for each partition, from the attempt that counted, removes the files of
    other attempts, compares the rows with the rows of the plan, adds a
    ``_SUCCESS`` marker and swaps the folder in. A run that fails leaves an
    older output as it was. Without node features only the marker is written.
    """
    from pyarrow import fs as pafs

    spark = df.sparkSession
    refuse_self_overwrite(df, uri)
    counted = Observation("geoparquet")
    frame = geoparquet_frame(df, space_order).observe(counted, F.count(F.lit(1)).alias("rows"))
    staged = staged_uri(uri)
    base = _arrow_uri(staged if "://" in staged or staged.startswith("file:") else os.path.abspath(staged))
    geo = _geo_metadata(space_order)

    def write_part(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}.parquet"
        filesystem, root = pafs.FileSystem.from_uri(base)
        writer, rows = None, 0
        for batch in batches:             # streamed: one batch in memory at a time
            if batch.num_rows == 0:
                continue
            if writer is None:
                filesystem.create_dir(root, recursive=True)
                schema = batch.schema.with_metadata({**(batch.schema.metadata or {}), b"geo": geo})
                writer = pq.ParquetWriter(f"{root}/{name}", schema, filesystem=filesystem)
            writer.write_batch(batch, row_group_size=group_rows)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        yield pa.RecordBatch.from_pydict({"path": pa.array([name] if rows else [], pa.string()),
                                          "rows": pa.array([rows] if rows else [], pa.int64())})

    filesystem, root = pafs.FileSystem.from_uri(base)
    try:
        # one row per written file (bounded by the partition count)
        receipts = sorted((r["path"], r["rows"]) for r in frame.mapInArrow(write_part, "path string, rows long").collect())
        if sum(n for _, n in receipts) != counted.get["rows"]:
            raise OSError(f"{uri}: receipts of {sum(n for _, n in receipts)} rows, {counted.get['rows']} expected")
        filesystem.create_dir(root, recursive=True)
        names = {name for name, _ in receipts}
        for info in filesystem.get_file_info(pafs.FileSelector(root)):
            if info.base_name not in names:
                filesystem.delete_file(info.path)
        with filesystem.open_output_stream(f"{root}/_SUCCESS"):
            pass
    except BaseException:
        if filesystem.get_file_info(root).type != pafs.FileType.NotFound:
            filesystem.delete_dir(root)
        raise
    swap_in(spark, staged, uri)
    return receipts


def read_geoparquet_metadata(path: str) -> dict:
    """The decoded ``geo`` footer of one GeoParquet file."""
    return json.loads(pq.read_schema(path).metadata[b"geo"])
