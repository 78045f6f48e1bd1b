"""Geo expressions and sinks, and the jobs end to end on scratch folders."""

import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.functions.geo import feature_json, iso_timestamp, marker_style, wkb_point
from strata.operators import extras as X
from strata.operators.rules import shipped_rules
from strata.plans import jobs
from strata.sources import geo as G
from strata.sources.fixtures import fixture_changesets, fixture_history
from strata.sources.tables import read_candidates, write_candidates


def test_wkb_point_bytes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "lon double, lat double")
    got = [r[0] for r in df.select(F.hex(wkb_point("lon", "lat"))).collect()]
    assert got == ["0101000000000000000000F03F0000000000000040", None]


def test_marker_style_lookup(spark):
    df = spark.createDataFrame([("strong",), ("neutral",), ("exclude",), (None,), ("other",)], "s string")
    rows = df.select(*marker_style(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("#1a9850", "star", "medium"), ("#999999", "circle", "small"), ("#d73027", "cross", "small"),
        ("#666666", "circle", "small"), ("#666666", "circle", "small")]


def test_iso_timestamp(spark):
    df = spark.sql("select timestamp_ntz'2020-01-02 03:04:05' a, timestamp_ntz'2020-01-02 03:04:05.25' b")
    r = df.select(iso_timestamp(F.col("a")), iso_timestamp(F.col("b"))).first()
    assert tuple(r) == ("2020-01-02T03:04:05", "2020-01-02T03:04:05.250000")


def test_feature_json_drops_nulls_and_nan(spark):
    df = spark.createDataFrame(
        [("node", 1, 10.0, 20.0, {"name": "x"}, None, float("nan"), "strong"),
         ("way", 2, None, None, {"ref": "y"}, "c", 1.5, None)],
        "type string, id long, last_lat double, last_lon double, good_tags map<string,string>, "
        "cs_comment string, score double, comment_signal string")
    feats = [json.loads(r[0]) for r in df.select(feature_json(df)).collect()]
    node, way = feats
    assert node["geometry"] == {"type": "Point", "coordinates": [20.0, 10.0]}
    assert node["properties"]["tags"] == {"name": "x"}
    assert "cs_comment" not in node["properties"] and "score" not in node["properties"]
    assert node["properties"]["marker-symbol"] == "star"
    assert list(node["properties"])[-4] == "type"
    assert way["geometry"] is None and way["properties"]["cs_comment"] == "c"
    assert way["properties"]["marker-color"] == "#666666"


def test_jobs_end_to_end(spark, scratch):
    cand_uri = os.path.join(scratch, "candidates")
    enr_uri = os.path.join(scratch, "enriched")
    allp = os.path.join(scratch, "all.parquet")
    geo_base = os.path.join(scratch, "export")

    m = jobs.run_extract(spark, fixture_history(spark, SF_SMALL), shipped_rules(), cand_uri)
    assert m == {"rows": 115, "nodes": 88, "ways": 27, "dropped_by_crop": 0}
    assert sorted(d for d in os.listdir(cand_uri) if d.startswith("type=")) == ["type=node", "type=way"]

    cands = read_candidates(spark, cand_uri)
    em = jobs.run_enrich(spark, cands, fixture_changesets(spark, SF_SMALL), enr_uri, show=False)
    assert em["before"] == {"rows": 115, "strong": 68, "neutral": 18, "exclude": 29}
    assert em["after"] == {"rows": 86, "strong": 68, "neutral": 18, "exclude": 0}
    ids = cands.select("last_changeset").distinct().count()
    assert em["candidates"] == 115 and em["unique_changesets"] == ids

    am = jobs.run_enrich_keep_all(spark, cands, fixture_changesets(spark, SF_SMALL), allp, show=False)
    assert am["rows"] == 115 and am["unique_changesets"] == ids

    gm = jobs.run_export_geo(spark, read_candidates(spark, enr_uri), geo_base)
    lines = [json.loads(l) for f in glob.glob(geo_base + ".geojson/part-*") for l in open(f)]
    assert len(lines) == 86 == gm["rows"]
    assert all(l["type"] == "Feature" for l in lines)
    files = glob.glob(geo_base + ".geoparquet/*.parquet")
    assert files and os.path.exists(geo_base + ".geoparquet/_SUCCESS")
    meta = G.read_geoparquet_metadata(files[0])
    crs = meta["columns"]["geometry"]["crs"]   # PROJJSON, never a plain text
    assert crs["type"] == "GeographicCRS" and crs["id"] == {"authority": "EPSG", "code": 4326}
    table = pq.read_table(files)
    assert table.num_rows == gm["geoparquet_rows"] == sum(1 for l in lines if l["geometry"])
    assert set(table.column("type").to_pylist()) == {"node"}

    counts = jobs.run_profile(spark, read_candidates(spark, enr_uri))
    assert sum(counts.values()) == 86


def test_geojson_single_collection(spark, scratch):
    c = read_candidates_fixture(spark, scratch)
    out = os.path.join(scratch, "fc.geojson")
    G.write_geojson(c, out, collection=True)
    parts = sorted(glob.glob(out + "/part-*"))
    doc = json.loads("".join(open(p).read() for p in parts))
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 115
    kinds = [f["properties"]["type"] for f in doc["features"]]
    assert kinds == sorted(kinds, key=lambda k: k != "node")
    ids = [f["properties"]["id"] for f in doc["features"] if f["properties"]["type"] == "node"]
    assert ids == sorted(ids)
    # written by several tasks, not funnelled through one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        G.write_geojson(c, out, collection=True)
        parts = sorted(glob.glob(out + "/part-*"))
        assert len(parts) > 1
        assert json.loads("".join(open(p).read() for p in parts)) == doc
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def read_candidates_fixture(spark, scratch):
    from strata.operators.rules import extract_candidates
    return extract_candidates(fixture_history(spark, SF_SMALL), shipped_rules())


def test_partition_read_tolerates_missing_type(spark, scratch):
    out = os.path.join(scratch, "c")
    write_candidates(read_candidates_fixture(spark, scratch), out)
    assert read_candidates(spark, out, types=["relation"]).count() == 0
    assert read_candidates(spark, out, types=["way"]).count() == 27
    assert "type" in read_candidates(spark, out, types=["way"]).columns


def test_refuses_to_overwrite_its_input(spark, scratch):
    out = os.path.join(scratch, "c")
    write_candidates(read_candidates_fixture(spark, scratch), out)
    with pytest.raises(ValueError, match="refusing"):
        write_candidates(read_candidates(spark, out), out)


def test_extras(spark, scratch):
    c = read_candidates_fixture(spark, scratch)
    assert X.crop_bbox(c, None) is c
    cropped = X.crop_bbox(c, (-180, -90, 180, 90)).collect()
    assert all(r["type"] == "node" for r in cropped) and len(cropped) == 88
    d = X.with_archive_dates(c).select("created_at", "start_date").first()
    assert d["start_date"] == d["created_at"].strftime("%Y-%m-%d")
    a = [tuple(r) for r in X.review_sample(c, 5).select("type", "id").collect()]
    b = [tuple(r) for r in X.review_sample(c, 5).select("type", "id").collect()]
    assert a == b and len(a) == 5


def test_resolve_ways_against_brute_force(spark, scratch):
    h = fixture_history(spark, SF_SMALL)
    c = read_candidates_fixture(spark, scratch)
    got = {(r["way_id"], r["pos"]): (r["node_version"], r["lon"], r["lat"])
           for r in X.resolve_ways(c, h).collect()}
    hist = h.collect()
    ways = [r for r in c.collect() if r["type"] == "way"]
    nodes = {}
    for r in hist:
        if r["type"] == "node":
            nodes.setdefault(r["id"], []).append(r)
    expected = {}
    for w in ways:
        at = next(r["timestamp"] for r in hist if r["type"] == "way" and r["id"] == w["id"]
                  and r["version"] == w["last_good_version"])
        for pos, nd in enumerate(w["last_nds"], start=1):
            before = [n for n in nodes.get(nd["ref"], []) if n["timestamp"] <= at]
            if not before:
                expected[(w["id"], pos)] = (None, None, None)
                continue
            best = max(before, key=lambda n: (n["timestamp"], n["version"]))
            vis = best["visible"]
            expected[(w["id"], pos)] = (best["version"], best["lon"] if vis else None,
                                        best["lat"] if vis else None)
    assert got == expected and len(got) > 0
    lines = X.way_linestrings(X.resolve_ways(c, h)).collect()
    assert all(json.loads(r["geometry"])["type"] == "LineString" for r in lines if r["geometry"])


def test_geoparquet_overwrite_leaves_no_stale_files_and_maps_s3a(spark, scratch):
    from strata.sources.geo import _arrow_uri

    assert _arrow_uri("s3a://b/k") == "s3://b/k" and _arrow_uri("/x/y") == "/x/y"
    out = os.path.join(scratch, "gp")
    os.makedirs(out)
    open(os.path.join(out, "_tmp-00000-0.parquet"), "w").write("left by an earlier run")
    receipts = G.write_geoparquet(read_candidates_fixture(spark, scratch), out)
    assert receipts and not glob.glob(out + "/_tmp-*")
    assert sum(r for _, r in receipts) == pq.read_table(glob.glob(out + "/*.parquet")).num_rows


def failing(df):
    """The same rows by a plan that fails in the middle of its last task."""
    boom = F.when(F.col("id") == F.lit(df.agg(F.max("id")).first()[0]), F.raise_error(F.lit("boom")).cast("string"))
    return df.withColumn("cs_comment", boom)


@pytest.mark.parametrize("collection", [False, True])
def test_a_failed_export_keeps_the_old_one(spark, scratch, collection):
    c = read_candidates_fixture(spark, scratch)
    geojson, geoparquet = os.path.join(scratch, "x.geojson"), os.path.join(scratch, "x.geoparquet")
    G.write_geojson(c, geojson, collection=collection)
    G.write_geoparquet(c, geoparquet)
    before = {p: open(p, "rb").read() for d in (geojson, geoparquet) for p in glob.glob(d + "/*")}
    for write in (lambda d: G.write_geojson(d, geojson, collection=collection), lambda d: G.write_geoparquet(d, geoparquet)):
        with pytest.raises(Exception, match="boom"):
            write(failing(c))
    assert before == {p: open(p, "rb").read() for d in (geojson, geoparquet) for p in glob.glob(d + "/*")}
    G.write_geoparquet(c.limit(3), geoparquet)
    assert pq.read_table(glob.glob(geoparquet + "/*.parquet")).num_rows <= 3
    assert not glob.glob(scratch + "/_x.geoparquet-*")


def test_geo_sinks_refuse_their_input(spark, scratch):
    out = os.path.join(scratch, "c")
    write_candidates(read_candidates_fixture(spark, scratch), out)
    for write in (G.write_geojson, G.write_geoparquet):
        with pytest.raises(ValueError, match="refusing"):
            write(read_candidates(spark, out), out)


def test_repeated_attempts_leave_one_file_each(spark, scratch):
    """A task that fails after it wrote a part is run again; only the file of
    the attempt that counted stays."""
    import subprocess
    import sys
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from pyspark import TaskContext
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {scratch!r} + "/ck")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate())
from strata.sources import geo as G

@F.udf("string")
def once(i):
    if i == 77 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
    return "ok"

df = spark.range(0, 100, 1, 4).select(F.lit("node").alias("type"), "id", F.lit(1.0).alias("last_lat"), F.lit(2.0).alias("last_lon"), once("id").alias("note"))
receipts = G.write_geoparquet(df, {scratch!r} + "/out")
print("RECEIPTS", sum(n for _, n in receipts), len(receipts))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "RECEIPTS 100 4" in done.stdout, done.stderr[-2000:]
    files = glob.glob(scratch + "/out/*.parquet")
    assert len(files) == 4 and pq.read_table(files).num_rows == 100
