"""History by object, pruned changeset scans, space order and restarts."""

import glob
import json
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.functions.geo import hilbert
from strata.operators import enrich as E
from strata.operators import rules as rules_module
from strata.operators.rules import extract_candidates, shipped_rules, survivors_of_scalar_rules
from strata.plans import jobs as J
from strata.plans.catalog import comparable
from strata.scratch import Ledger, Scratch
from strata.sources import geo as G
from strata.sources.fixtures import fixture_changesets, fixture_history
from strata.sources.layout import JOIN_BY_BUCKET, read_history_by_object, write_history_by_object
from strata.sources.tables import read_candidates, read_history
from tests.conftest import SF_SMALL

RULES = dict(min_versions=2, min_distinct_users=1, min_lifetime_days=0, min_age_at_deletion_days=0, min_tag_count_last_visible=0,
             required_tags_any=None, exclude_deletions_by_creator=False)


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def conf(spark):
    """Sets session settings and puts back what was there."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# ---------------------------------------------------------------- by object

def test_by_object_needs_no_exchange_of_the_history(spark, tmp_path, conf):
    h, uri, rules = fixture_history(spark, SF_SMALL), f"{tmp_path}/h", shipped_rules().replace(**RULES)
    assert write_history_by_object(h, uri, 4) == 4
    laid = read_history_by_object(spark, uri)
    assert same(comparable(laid), comparable(h))
    assert "Exchange" not in plan(survivors_of_scalar_rules(rules_module.prepare_history(laid), rules))
    assert "Exchange" in plan(survivors_of_scalar_rules(rules_module.prepare_history(h), rules))
    want = Scratch(spark, "want").save(comparable(extract_candidates(h, rules)), "want")
    assert want.count() > 20
    conf(JOIN_BY_BUCKET, "false")
    for threshold in ("10m", "-1"):         # survivors broadcast, or joined bucket by bucket
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = extract_candidates(laid, rules)
        assert same(comparable(got), want)
        assert plan(got).count("Exchange hashpartitioning") <= (threshold == "-1")     # at most of the survivors
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert same(comparable(extract_candidates(laid.unionByName(laid), rules, dedupe=True)), want)


def test_a_layout_is_replaced_whole(spark, tmp_path):
    h, uri = fixture_history(spark, SF_SMALL), f"{tmp_path}/h"
    write_history_by_object(h, uri, 2)
    with pytest.raises(Exception):
        write_history_by_object(h.withColumn("lat", F.raise_error(F.lit("lost")).cast("double")), uri, 3)
    assert read_history_by_object(spark, uri).count() == h.count()
    write_history_by_object(h.limit(0), uri, 3)
    assert read_history_by_object(spark, uri).count() == 0
    assert [p for p in glob.glob(f"{tmp_path}/*")] == [uri]
    with pytest.raises(ValueError):
        write_history_by_object(read_history_by_object(spark, uri), uri)


def test_rows_without_a_key_stay_in_the_layout(spark, tmp_path):
    h, uri = fixture_history(spark, SF_SMALL).limit(5), f"{tmp_path}/h"
    odd = h.unionByName(h.withColumn("type", F.lit(None).cast("string"))).unionByName(h.withColumn("id", F.lit(None).cast("long")))
    write_history_by_object(odd, uri)
    assert read_history_by_object(spark, uri).count() == 15


# ---------------------------------------------------------------- pruned scan

def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "cs_id long")


def test_a_cover_is_bounded_and_holds_every_id(spark):
    assert E.id_cover(ids(spark)) == []
    assert E.id_cover(ids(spark, 7, 7)) == [(7, 7)]
    assert E.id_cover(ids(spark, 1, 2, 100, 101, 5000), ranges=3) == [(1, 2), (100, 101), (5000, 5000)]
    assert E.id_cover(ids(spark, 1, 2, 100, 101, 5000), ranges=2) == [(1, 101), (5000, 5000)]
    far = ids(spark, -(1 << 63), 0, (1 << 63) - 1)
    cover = E.id_cover(far)
    assert cover[0][0] == -(1 << 63) and cover[-1][1] == (1 << 63) - 1
    many = spark.range(100_000).select((F.col("id") * F.col("id") % 7_000_003).alias("cs_id"))
    cover = E.id_cover(many, ranges=20, slots=512)
    assert len(cover) == 20 and all(a <= b for a, b in cover) and all(b < c for (_, b), (c, _) in zip(cover, cover[1:]))
    assert many.filter(~E.in_cover(F.col("cs_id"), cover)).isEmpty()
    assert many.filter(E.in_cover(F.col("cs_id"), [])).isEmpty()


def scanned(df):
    """Rows that leave the plan's scan, by Spark's own count."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_cover_reaches_the_scan(spark, tmp_path, conf, fmt):
    conf("spark.sql.adaptive.enabled", "false")
    # Twelve files of 5,000 rows by id; a range partitioning samples, so its files would differ from run to run.
    cs = spark.range(0, 60_000, 1, 12).select(F.col("id"), F.lit("u").alias("user"), F.col("id").alias("uid"),
                                    F.create_map(F.lit("comment"), F.lit("c")).alias("tags"))
    cs.write.format(fmt).save(f"{tmp_path}/cs")
    stored = spark.read.format(fmt).load(f"{tmp_path}/cs")
    need = ids(spark, *range(100, 150), *range(33_000, 33_100), 59_999)
    whole, pruned = E.changeset_lookup(stored, need), E.changeset_lookup(stored, need, cover=E.id_cover(need))
    assert same(whole, pruned) and pruned.count() == 151
    left = stored.filter(E.in_cover(F.col("id"), E.id_cover(need)))
    assert scanned(stored.filter("uid is not null")) == 60_000 and scanned(left) <= 15_000


def test_enrichment_with_a_cover_is_the_same(spark):
    c = Scratch(spark, "c").save(extract_candidates(fixture_history(spark, SF_SMALL), shipped_rules().replace(**RULES), deletion_changeset=True), "c")
    cs = fixture_changesets(spark, SF_SMALL)
    needed, both = E.needed_changesets(c), E.needed_by_roles(c)
    assert same(comparable(E.enrich(c, cs)), comparable(E.enrich(c, cs, cover=E.id_cover(needed, 5))))
    assert same(comparable(E.enrich_roles(c, cs)), comparable(E.enrich_roles(c, cs, cover=E.id_cover(both, 5))))


# ---------------------------------------------------------------- space order

def test_hilbert_visits_neighbours(spark):
    side = 1 << 5
    cells = spark.range(side * side).select((F.col("id") % side).alias("x"), F.floor(F.col("id") / side).alias("y"))
    lon, lat = (F.col("x") + 0.5) * 360 / side - 180, (F.col("y") + 0.5) * 180 / side - 90
    path = sorted((r.at, r.x, r.y) for r in cells.select(hilbert(lon, lat, 5).alias("at"), "x", "y").collect())
    assert [p[0] for p in path] == list(range(side * side))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(path, path[1:]))


def test_hilbert_at_the_edges(spark):
    rows = spark.createDataFrame([(180.0, 90.0), (-180.0, -90.0), (999.0, -999.0), (0.0, 0.0)], "lon double, lat double")
    got = [r[0] for r in rows.select(hilbert(F.col("lon"), F.col("lat"))).collect()]
    assert all(0 <= v < 1 << 40 for v in got) and len(set(got)) == 4


def groups_in(uri, box):
    """(row groups that may hold points of the box, all row groups)."""
    hit = total = 0
    for path in glob.glob(f"{uri}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}
            total += 1
            hit += (cols["bbox.xmin"].min <= box[2] and cols["bbox.xmax"].max >= box[0]
                    and cols["bbox.ymin"].min <= box[3] and cols["bbox.ymax"].max >= box[1])
    return hit, total


def test_a_small_box_touches_few_row_groups(spark, tmp_path):
    n = 40_000
    rows = spark.range(n, numPartitions=4).select(
        F.lit("node").alias("type"), "id", (F.col("id") * 7919 % n / n * 360 - 180).alias("last_lon"), (F.col("id") * 104729 % 39_989 / 39_989 * 180 - 90).alias("last_lat"),
        F.lit("strong").alias("comment_signal"))
    uri = f"{tmp_path}/geo"
    files = G.write_geoparquet(rows, uri, space_order=True, group_rows=500)
    assert sum(k for _, k in files) == n
    meta = G.read_geoparquet_metadata(glob.glob(f"{uri}/*.parquet")[0])
    assert meta["version"] == "1.1.0" and meta["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
    hit, total = groups_in(uri, (10.0, 40.0, 20.0, 45.0))
    assert total >= 80 and 1 <= hit <= 6
    box = "bbox.xmax >= 10 and bbox.xmin <= 20 and bbox.ymax >= 40 and bbox.ymin <= 45"
    assert spark.read.parquet(uri).filter(box).count() == rows.filter("last_lon between 10 and 20 and last_lat between 40 and 45").count() > 0


def test_space_order_of_hot_places_and_nothing(spark, tmp_path):
    rows = spark.range(300).select(F.lit("node").alias("type"), "id", F.lit(5.0).alias("last_lon"), F.lit(6.0).alias("last_lat"))
    assert sum(k for _, k in G.write_geoparquet(rows, f"{tmp_path}/hot", space_order=True)) == 300
    assert G.write_geoparquet(rows.limit(0), f"{tmp_path}/none", space_order=True) == []


# ---------------------------------------------------------------- restart

def fails(*_, **__):
    raise OSError("lost")


def history_at(spark, path):
    fixture_history(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return read_history(spark, path, "parquet")


def test_a_restart_does_not_read_the_history(spark, tmp_path, monkeypatch):
    rules, out, run = shipped_rules().replace(**RULES), f"{tmp_path}/out", uuid.uuid4().hex
    h = history_at(spark, f"{tmp_path}/h")
    J.run_extract(spark, h, rules, f"{tmp_path}/plain")
    with monkeypatch.context() as m:
        m.setattr(J, "write_candidates", fails)
        with pytest.raises(OSError):
            J.run_extract(spark, h, rules, out, run_id=run)
    # The history is empty now: what the second run has comes from the finished steps.
    fixture_history(spark, SF_SMALL).limit(0).write.mode("overwrite").parquet(f"{tmp_path}/h")
    empty = read_history(spark, f"{tmp_path}/h", "parquet")
    with pytest.raises(ValueError):
        J.run_extract(spark, empty, rules, out, sample_rate=0.5, run_id=run)
    metrics = J.run_extract(spark, empty, rules, out, run_id=run)
    got, want = read_candidates(spark, out), read_candidates(spark, f"{tmp_path}/plain")
    assert metrics["rows"] == want.count() > 20 and same(comparable(got), comparable(want))
    # The run is over: the same id begins anew.
    assert J.run_extract(spark, empty, rules, out, run_id=run)["rows"] == 0


def test_a_restart_begins_behind_the_survivors(spark, tmp_path, monkeypatch):
    rules, out, run = shipped_rules().replace(**RULES), f"{tmp_path}/out", uuid.uuid4().hex
    h = history_at(spark, f"{tmp_path}/h")
    with monkeypatch.context() as m:
        m.setattr(rules_module, "attach_payload", fails)
        with pytest.raises(OSError):
            J.run_extract(spark, h, rules, out, run_id=run)
    # Counting lifecycles again would fail.
    with monkeypatch.context() as m:
        real = rules_module.lifecycle_scalar
        m.setattr(rules_module, "lifecycle_scalar", lambda *a: real(*a).withColumn("num_versions", F.raise_error(F.lit("again")).cast("int")))
        J.run_extract(spark, h, rules, out, run_id=run)
    assert same(comparable(read_candidates(spark, out)), comparable(extract_candidates(h, rules)))


def test_export_does_finished_outputs_once(spark, tmp_path, monkeypatch):
    rows = Scratch(spark, "rows").save(extract_candidates(fixture_history(spark, SF_SMALL), shipped_rules().replace(**RULES)), "rows")
    base, run = f"{tmp_path}/x", uuid.uuid4().hex
    with monkeypatch.context() as m:
        m.setattr(J.G, "write_geoparquet", fails)
        with pytest.raises(OSError):
            J.run_export_geo(spark, rows, base, run_id=run)
    with monkeypatch.context() as m:
        m.setattr(J.G, "write_geojson", fails)
        counts = J.run_export_geo(spark, rows, base, run_id=run)
    assert counts["rows"] == rows.count() and counts["geoparquet_rows"] > 0


def test_half_written_steps_are_done_again(spark, tmp_path):
    run = uuid.uuid4().hex
    ledger = Ledger(spark, "t", run, {"a": (1, 2)})
    with pytest.raises(Exception):
        ledger.save(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("x")).cast("long")).otherwise(F.col("id")).alias("id")), "s")
    again = Ledger(spark, "t", run, {"a": [1, 2]})
    assert again.save(spark.range(5), "s").count() == 5
    assert Ledger(spark, "t", run, {"a": [1, 2]}).save(spark.range(99), "s").count() == 5
    assert again.once("n", lambda: {"n": 1}) == again.once("n", fails) == {"n": 1}
    again.drop("s")
    assert again.save(spark.range(6), "s").count() == 6
    with pytest.raises(ValueError):
        Ledger(spark, "t", run, {"a": [1]})
    again.close()
    assert json.dumps(Ledger(spark, "t", run, {"a": [1]}).once("n", lambda: {"n": 2})) == '{"n": 2}'
