"""Geo export expressions: point geometry, feature properties, marker style,
WKB points. All native Column expressions except ``wkb_point`` (an Arrow
batch UDF: Spark has no function that turns a double into its bytes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Simplestyle marker per comment signal, and the fallback for
# rows without one. Must equal the reference's for identical map styling.
MARKER_STYLE = {
    "strong": {"marker-color": "#1a9850", "marker-symbol": "star", "marker-size": "medium"},
    "neutral": {"marker-color": "#999999", "marker-symbol": "circle", "marker-size": "small"},
    "exclude": {"marker-color": "#d73027", "marker-symbol": "cross", "marker-size": "small"},
}
DEFAULT_MARKER = {"marker-color": "#666666", "marker-symbol": "circle", "marker-size": "small"}
MARKER_FIELDS = ("marker-color", "marker-symbol", "marker-size")

# Columns that never become feature properties (they are the geometry).
GEOMETRY_SOURCE_COLUMNS = ("geometry", "last_lat", "last_lon", "last_nds")


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def has_point(df: DataFrame) -> Column:
    """Nodes with a finite last position; ways never have one here."""
    return (F.col("type") == "node") & _finite(F.col("last_lat")) & _finite(F.col("last_lon"))


def hilbert(lon: Column, lat: Column, order: int = 20) -> Column:
    """Place of a position along a Hilbert curve over ``2**order`` x ``2**order``
    cells of the globe; positions outside it count as on its edge. Positions that
    are near along the curve are near on the map, whatever way the curve goes."""
    cells = 1 << order

    def cell(c, low, span):
        return F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor((c.cast("double") - low) / span * cells))).cast("long")

    def step(acc, s):
        right = acc["x"].bitwiseAND(s) != 0
        up = acc["y"].bitwiseAND(s) != 0
        quarter = F.when(right, F.when(up, 2).otherwise(3)).otherwise(F.when(up, 1).otherwise(0))
        # The curve enters the two lower quarters turned: their axes change places.
        mirror = right & ~up
        x = F.when(mirror, F.lit(cells - 1) - acc["x"]).otherwise(acc["x"])
        y = F.when(mirror, F.lit(cells - 1) - acc["y"]).otherwise(acc["y"])
        return F.struct(F.when(up, x).otherwise(y).alias("x"), F.when(up, y).otherwise(x).alias("y"),
                        (acc["at"] + s * s * quarter).alias("at"))

    start = F.struct(cell(lon, -180.0, 360.0).alias("x"), cell(lat, -90.0, 180.0).alias("y"), F.lit(0).cast("long").alias("at"))
    sides = F.array(*[F.lit(1 << i).cast("long") for i in reversed(range(order))])
    return F.aggregate(sides, start, step, lambda acc: acc["at"])


def point_geometry(df: DataFrame) -> Column:
    """GeoJSON Point struct ``{type, coordinates: [lon, lat]}`` or NULL."""
    return F.when(has_point(df), F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("last_lon").cast("double"), F.col("last_lat").cast("double")).alias("coordinates"),
    ))


def marker_style(signal: Column) -> list[Column]:
    """Three columns ``marker-color``, ``marker-symbol``, ``marker-size``."""
    out = []
    for field in MARKER_FIELDS:
        expr = None
        for sig, style in MARKER_STYLE.items():
            expr = (F.when(signal == sig, F.lit(style[field])) if expr is None
                    else expr.when(signal == sig, F.lit(style[field])))
        out.append(expr.otherwise(F.lit(DEFAULT_MARKER[field])).alias(field))
    return out


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text without zone; a fraction only when there is one
    (``2020-01-02T03:04:05`` or ``2020-01-02T03:04:05.123456``)."""
    full = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def feature_properties(df: DataFrame) -> Column:
    """Properties object as JSON text: every column but the geometry ones,
    ``good_tags`` as the ``tags`` object, timestamps as ISO text, NULL and
    NaN values omitted, the marker style appended.

    ``type`` goes last among the data columns, where the reference's
    per-type partition read puts it back.
    """
    fields = []
    cols = [c for c in df.columns if c not in GEOMETRY_SOURCE_COLUMNS and c != "type"]
    if "type" in df.columns:
        cols.append("type")
    for name in cols:
        dtype = df.schema[name].dataType
        c = F.col(f"`{name}`")
        if name == "good_tags":
            fields.append(c.alias("tags"))
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            fields.append(iso_timestamp(c).alias(name))
        elif isinstance(dtype, T.DateType):
            fields.append(F.date_format(c, "yyyy-MM-dd").alias(name))
        elif isinstance(dtype, (T.DoubleType, T.FloatType)):
            fields.append(F.when(~F.isnan(c), c).alias(name))
        else:
            fields.append(c.alias(name))
    signal = F.col("comment_signal") if "comment_signal" in df.columns else F.lit(None).cast("string")
    fields.extend(marker_style(signal))
    # to_json drops NULL fields by default
    return F.to_json(F.struct(*fields))


def feature_json(df: DataFrame) -> Column:
    """One GeoJSON Feature as JSON text (``geometry: null`` kept)."""
    geom = F.coalesce(F.to_json(point_geometry(df)), F.lit("null"))
    return F.concat(F.lit('{"type":"Feature","geometry":'), geom,
                    F.lit(',"properties":'), feature_properties(df), F.lit("}"))


_WKB_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])


@F.arrow_udf(T.BinaryType())
def wkb_point(lon: pa.Array, lat: pa.Array) -> pa.Array:
    """Little-endian ISO WKB Point(lon, lat); NULL when either is missing.
    The packed records are the buffer of the result; nothing is sliced."""
    x, y = (pc.fill_null(v, float("nan")).to_numpy(zero_copy_only=False) for v in (lon, lat))
    rec = np.zeros(len(x), dtype=_WKB_POINT)
    rec["order"] = 1
    rec["kind"] = 1
    rec["x"] = x
    rec["y"] = y
    known = pa.array(~(np.isnan(x) | np.isnan(y)))
    offsets = np.arange(len(x) + 1, dtype=np.int32) * _WKB_POINT.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [known.buffers()[1], pa.py_buffer(offsets), pa.py_buffer(rec)])
