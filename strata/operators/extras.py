"""Operators the reference documents but does not code.

Definitions here are ours where the documentation is silent; the README
says which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.scratch import Scratch

Box = tuple[float, float, float, float]


def longitudes(box: Box) -> list[tuple[float, float]]:
    """The longitude ranges of a box: two where it goes over 180 degrees."""
    west, _, east, _ = box
    return [(west, east)] if west <= east else [(west, 180.0), (-180.0, east)]


def crop_bbox(df: DataFrame, bbox: tuple[float, float, float, float] | None) -> DataFrame:
    """Keep rows whose last visible position lies in ``(min_lon, min_lat,
    max_lon, max_lat)`` (inclusive). ``None`` = the whole planet. Rows
    without a position (ways, never-visible objects) fall outside. A box
    whose ``min_lon`` is the larger one goes over 180 degrees."""
    if bbox is None:
        return df
    inside = F.lit(False)
    for west, east in longitudes(bbox):
        inside = inside | F.col("last_lon").between(west, east)
    return df.filter(inside & F.col("last_lat").between(bbox[1], bbox[3]))


def way_envelopes(resolved: DataFrame) -> DataFrame:
    """(way_id, west, south, east, north) of the positions in ``resolve_ways``
    output; ways without any position have no row.

    ``west`` > ``east`` says that the envelope goes over 180 degrees: of the two
    ways round the globe the narrower one counts. The four numbers and the
    shifted longitudes merge partially before the shuffle.
    """
    known = resolved.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    turned = F.when(F.col("lon") < 0, F.col("lon") + 360).otherwise(F.col("lon"))
    ends = known.groupBy("way_id").agg(
        F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("south"), F.max("lat").alias("north"),
        F.max(F.when(F.col("lon") < 0, F.col("lon"))).alias("e_turned"), F.min(F.when(F.col("lon") >= 0, F.col("lon"))).alias("w_turned"),
        (F.max(turned) - F.min(turned)).alias("width"))
    over = F.coalesce(F.col("width") < F.col("e") - F.col("w"), F.lit(False)) & F.col("e_turned").isNotNull() & F.col("w_turned").isNotNull()
    return ends.select("way_id", F.when(over, F.col("w_turned")).otherwise(F.col("w")).alias("west"), "south",
                       F.when(over, F.col("e_turned")).otherwise(F.col("e")).alias("east"), "north")


def crop_objects(candidates: DataFrame, history: DataFrame, bbox: Box | None,
                 scratch: Scratch | None = None) -> DataFrame:
    """``candidates`` with ``crop``: ``inside`` the box, ``outside`` it, or
    ``nowhere`` (no position at all). Nodes are judged by their last visible
    position, ways by whether the envelope of their nodes' positions, as of the
    way's last visible version, meets the box. ``None`` = the whole planet:
    everything is inside. ``candidates`` should be a stored table."""
    if bbox is None:
        return candidates.withColumn("crop", F.lit("inside"))
    envelopes = way_envelopes(resolve_ways(candidates, history, scratch=scratch)).alias("w")
    c = candidates.alias("c")
    of_node = F.col("c.last_lon").isNotNull() & F.col("c.last_lat").isNotNull()
    west, east = F.coalesce("c.last_lon", "w.west"), F.coalesce("c.last_lon", "w.east")
    south, north = F.coalesce("c.last_lat", "w.south"), F.coalesce("c.last_lat", "w.north")
    meets = F.lit(False)
    for low, high in longitudes(bbox):
        plain = (west <= high) & (east >= low)
        meets = meets | F.when(west <= east, plain).otherwise((west <= high) | (east >= low))
    meets = meets & (south <= bbox[3]) & (north >= bbox[1])
    where = F.when(~of_node & F.col("w.way_id").isNull(), "nowhere").when(meets, "inside").otherwise("outside")
    return c.join(envelopes, (F.col("c.type") == "way") & (F.col("c.id") == F.col("w.way_id")), "left").select("c.*", where.alias("crop"))


def with_archive_dates(df: DataFrame) -> DataFrame:
    """``start_date`` <- created_at, ``end_date`` <- last_edit_at (calendar
    dates, as ISO text the archive's date tags use)."""
    return (df.withColumn("start_date", F.date_format(F.col("created_at"), "yyyy-MM-dd"))
              .withColumn("end_date", F.date_format(F.col("last_edit_at"), "yyyy-MM-dd")))


def review_key():
    """Deterministic pseudo-random order over (id, last_good_version):
    a multiplicative mix reduced mod a prime, ties broken by type and id."""
    return F.pmod(F.col("id") * 7919 + F.col("last_good_version") * 104729, F.lit(1000003))


def review_sample(df: DataFrame, n: int = 50) -> DataFrame:
    """``n`` rows for manual review, keyed by (type, id, last_good_version),
    the same rows on every run."""
    return (df.withColumn("review_key", review_key())
              .orderBy("review_key", "type", "id")
              .limit(n))


def way_node_refs(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """One row per (way, position, node ref) of the candidate ways, with the
    time ``at`` of the way's last visible version (taken before the refs are
    exploded, so one row per way is joined)."""
    ways = candidates.filter(F.col("type") == "way").select("id", "last_good_version", "last_nds")
    times = (history.filter(F.col("type") == "way")
                    .select("id", F.col("version").alias("last_good_version"), F.col("timestamp").alias("at")))
    return (ways.join(times, ["id", "last_good_version"])
                .select(F.col("id").alias("way_id"), "at", F.posexplode("last_nds").alias("pos0", "nd"))
                .select("way_id", "at", (F.col("pos0") + 1).alias("pos"), F.col("nd.ref").alias("ref")))


def asof_fill(events: DataFrame, key: str, order: list[str], state: str,
              partitions: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``asof``: the last non-NULL ``state`` of the same ``key`` at or
    before each row, in ``order`` (which must make rows unique).

    A running window partitioned by ``key`` alone would put a hot key (a
    node shared by a third of all ways) in one task. Here the rows are
    range-partitioned on ``(key, *order)``, which splits a hot key's
    timeline into contiguous slices, and *written* with their slice number:
    everything below reads that table, so all steps agree on the slices. A
    window per ``(slice, key)`` fills forward inside a slice. A key goes on from
    one slice to the next only if it is the next one's first key, so the
    states to carry over belong to at most one key per slice: a table of no
    more than two rows per slice, which is broadcast. The events are shuffled
    twice, no pairs are built and no group is gathered.
    """
    conf = events.sparkSession.conf
    # as many slices as AQE's sized initial partition count, when a job set one
    n = partitions or int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                          or conf.get("spark.sql.shuffle.partitions"))
    scratch = scratch or Scratch(events.sparkSession, "asof")
    sliced = scratch.save(events.repartitionByRange(n, key, *order)
                                .withColumn("_slice", F.spark_partition_id()), "slices")
    firsts = sliced.groupBy("_slice").agg(F.min(key).alias(key)).select(key).distinct()
    tails = (sliced.filter(F.col(state).isNotNull()).join(F.broadcast(firsts), key, "left_semi")
                   .groupBy("_slice", key).agg(F.max_by(state, F.struct(*order)).alias("_tail")))
    slices = sliced.join(F.broadcast(firsts), key, "left_semi").select("_slice", key).distinct()
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (slices.join(tails, ["_slice", key], "left")
                   .select("_slice", key, F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
                   .filter(F.col("_carried").isNotNull()))
    carry = scratch.save(carry, "carry")
    w = Window.partitionBy("_slice", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumn("_local", F.last(state, ignorenulls=True).over(w))
    return (local.join(F.broadcast(carry), ["_slice", key], "left")
                 .withColumn("asof", F.coalesce(F.col("_local"), F.col("_carried")))
                 .drop("_slice", "_local", "_carried"))


def resolve_ways(candidates: DataFrame, history: DataFrame,
                 partitions: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Node positions of candidate ways, as of the way's last visible version.

    For each (way, pos, ref): the node's latest version whose timestamp is
    <= the timestamp of the way's last visible version; ``lon``/``lat`` are
    NULL when that version is deleted or no version existed yet.

    As-of join without pairs: way refs (written once) and the versions of the
    nodes they name are unioned, keyed by node id and ordered by time (node
    versions before refs at equal time), and ``asof_fill`` carries the newest
    node state onto each ref.
    """
    scratch = scratch or Scratch(candidates.sparkSession, "ways")
    refs = scratch.save(way_node_refs(candidates, history), "refs")
    nodes = (history.filter(F.col("type") == "node")
                    .select(F.col("id").alias("ref"), F.col("timestamp").alias("at"),
                            "version", "visible", "lat", "lon")
                    .join(refs.select("ref").distinct(), "ref", "left_semi"))
    events = nodes.select(
        "ref", "at", F.lit(0).alias("kind"), F.col("version").alias("seq"),
        F.struct(F.col("version").alias("node_version"),
                 F.when(F.col("visible"), F.col("lon")).alias("lon"),
                 F.when(F.col("visible"), F.col("lat")).alias("lat")).alias("state"),
        F.lit(None).cast("long").alias("way_id"), F.lit(None).cast("int").alias("pos"),
    ).unionByName(refs.select(
        "ref", "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("struct<node_version:bigint,lon:double,lat:double>").alias("state"),
        "way_id", "pos",
    ))
    carried = asof_fill(events, "ref", ["at", "kind", "seq", "way_id", "pos"], "state", partitions, scratch)
    return (carried.filter(F.col("kind") == 1)
                   .select("way_id", "pos", "ref",
                           F.col("asof.node_version").alias("node_version"),
                           F.col("asof.lon").alias("lon"), F.col("asof.lat").alias("lat")))


def way_linestrings(resolved: DataFrame) -> DataFrame:
    """GeoJSON LineString text per way from ``resolve_ways`` output; NULL
    when fewer than two positions resolved. A way's node list is bounded by
    the data format (at most 2000 refs in OSM), so gathering it is safe."""
    pts = resolved.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    coords = (pts.groupBy("way_id")
                 .agg(F.array_sort(F.collect_list(F.struct("pos", F.array("lon", "lat").alias("xy"))))
                      .alias("pts")))
    return coords.select(
        "way_id",
        F.when(F.size("pts") >= 2,
               F.to_json(F.struct(F.lit("LineString").alias("type"),
                                  F.transform("pts", lambda p: p["xy"]).alias("coordinates"))))
         .alias("geometry"))


# Ours: closed ways with one of these keys are lines unless they say area=yes.
LINEAR_KEYS = ["highway", "barrier", "railway", "waterway"]


def is_area(tags: Column) -> Column:
    """If a closed way with these tags is an area (our definition)."""
    linear = F.exists(F.map_keys(tags), lambda k: k.isin(LINEAR_KEYS))
    return F.coalesce(tags["area"] == "yes", F.lit(False)) | (~F.coalesce(linear, F.lit(False)) & F.coalesce(tags["area"] != "no", F.lit(True)))


def way_geometries(resolved: DataFrame, candidates: DataFrame) -> DataFrame:
    """(way_id, n_refs, n_resolved, geometry_type, n_parts, geometry) of every
    way with node refs in ``resolve_ways`` output; no line skips a vertex.

    Consecutive resolved vertices make a run, and a run of two or more is a
    line: one is a LineString, several (gaps between them) a MultiLineString,
    none leaves the geometry NULL. A way of four refs or more that ends where
    it begins, without a gap, is a Polygon if ``is_area`` takes its ``good_tags`` for
    an area. A way's node list is bounded by the data format (at most 2000
    refs in OSM), so gathering it is safe.
    """
    per_way = resolved.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "lon", "lat"))).alias("refs"))
    known = F.filter("refs", lambda r: r["lon"].isNotNull() & r["lat"].isNotNull())
    # vertices of one run keep their distance from their number among the resolved ones
    placed = F.transform(F.col("known"), lambda r, i: F.struct((r["pos"] - i).alias("run"), F.array(r["lon"], r["lat"]).alias("xy")))
    runs = F.transform(F.array_distinct(F.transform("placed", lambda p: p["run"])),
                       lambda n: F.transform(F.filter("placed", lambda p: p["run"] == n), lambda p: p["xy"]))
    out = per_way.withColumn("known", known).withColumn("placed", placed).withColumn("lines", F.filter(runs, lambda x: F.size(x) >= 2))
    tags = candidates.filter(F.col("type") == "way").select(F.col("id").alias("way_id"), is_area(F.col("good_tags")).alias("area"))
    out = out.join(tags, "way_id", "left")
    n = F.size("refs")
    closed = (n >= 4) & (F.size("known") == n) & (F.element_at("refs", 1)["ref"] == F.element_at("refs", -1)["ref"])
    kind = (F.when(F.size("lines") == 0, None).when(closed & F.coalesce("area", F.lit(False)), "Polygon")
             .when(F.size("lines") == 1, "LineString").otherwise("MultiLineString"))
    out = out.withColumn("geometry_type", kind)
    text = lambda shape: F.to_json(F.struct(F.col("geometry_type").alias("type"), shape.alias("coordinates")))
    geometry = F.when(F.col("geometry_type") == "LineString", text(F.col("lines")[0])).when(F.col("geometry_type").isNotNull(), text(F.col("lines")))
    return out.select("way_id", n.cast("long").alias("n_refs"), F.size("known").cast("long").alias("n_resolved"), "geometry_type",
                      F.size("lines").cast("long").alias("n_parts"), geometry.alias("geometry"))


def stratified_sample(df: DataFrame, k: int, strata: list[str], seed: int = 7) -> DataFrame:
    """``k`` rows of every stratum for review, those with the smallest hash of
    (type, id), the same under any partitioning.

    Each task keeps the ``k`` smallest of its rows per stratum before anything
    is shuffled (a rank filtered by a literal is such a partial limit), so a
    stratum with most rows costs ``k`` rows per task.
    """
    order = Window.partitionBy(*strata).orderBy("sample_key", "type", "id")
    return (df.withColumn("sample_key", F.xxhash64(F.lit(seed), "type", "id"))
              .withColumn("sample_rank", F.row_number().over(order))
              .filter(F.col("sample_rank") <= k))
