"""The job CLI on files, and the table readers' input normalisation."""

import glob
import json
import math
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.schema import CANDIDATE_COLUMNS, ENRICHED
from strata.functions.tags import normalize_tags
from strata.operators.rules import extract_candidates, load_rules, shipped_rules
from strata.plans import jobs
from strata.sources.fixtures import fixture_changesets, fixture_history
from strata.sources.tables import read_candidates, read_history


def test_cli_extract_and_enrich_on_files(spark, scratch):
    hist = os.path.join(scratch, "history")
    cs = os.path.join(scratch, "changesets")
    fixture_history(spark, SF_SMALL).write.parquet(hist)
    fixture_changesets(spark, SF_SMALL).write.parquet(cs)
    rules = os.path.join(scratch, "rules.json")
    with open(rules, "w") as f:
        json.dump({**shipped_rules().extra, "_note": "test copy"}, f)
    out = os.path.join(scratch, "out")
    assert jobs.main(["extract", "--history_uri", hist, "--rules_uri", rules,
                      "--output_uri", out, "--format", "parquet"]) == 0
    assert read_candidates(spark, out).count() == 115
    enr = os.path.join(scratch, "enr")
    assert jobs.main(["enrich", "--candidates_uri", out, "--changesets_uri", cs,
                      "--output_uri", enr, "--format", "parquet"]) == 0
    assert read_candidates(spark, enr).count() == 86


def test_load_rules_from_path(spark, scratch):
    p = os.path.join(scratch, "r.json")
    with open(p, "w") as f:
        json.dump(shipped_rules().extra, f)
    assert load_rules(spark, p) == shipped_rules()


def test_read_history_casts_and_fills(spark, scratch):
    p = os.path.join(scratch, "h")
    (fixture_history(spark, SF_SMALL).drop("nds")
        .withColumn("lat", F.col("lat").cast("decimal(10,7)"))
        .withColumn("id", F.col("id").cast("int"))
        .write.parquet(p))
    h = read_history(spark, p, fmt="parquet")
    assert dict(h.dtypes)["lat"] == "double" and dict(h.dtypes)["id"] == "bigint"
    assert h.filter(F.col("nds").isNotNull()).count() == 0
    assert extract_candidates(h, shipped_rules().replace(way_min_nodes=0)).count() > 0


def test_normalize_tag_layouts(spark):
    df = spark.createDataFrame(
        [([{"key": "a", "value": "1"}, {"key": None, "value": "x"}, {"key": "a", "value": "2"}],
          [["b", "1"], ["c", "2"]])],
        "s array<struct<key:string,value:string>>, p array<array<string>>")
    r = df.select(normalize_tags(F.col("s"), df.schema["s"].dataType).alias("s"),
                  normalize_tags(F.col("p"), df.schema["p"].dataType).alias("p")).first()
    assert r["s"] == {"a": "2"} and r["p"] == {"b": "1", "c": "2"}


def test_rules_bbox_crops(spark):
    h = fixture_history(spark, SF_SMALL)
    rules = shipped_rules().replace(bbox=[-180, -90, 180, -50])
    got = extract_candidates(h, rules).collect()
    assert len(got) == 22 and all(r["type"] == "node" and r["last_lat"] <= -50 for r in got)


def test_partition_sizing_fills_only_unset(spark):
    from strata.session import SHUFFLE_TARGET_BYTES, plan_bytes, size_partitions

    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        table = f"{SF_SMALL}/lineitem.parquet"
        assert plan_bytes(spark.read.parquet(table)) == os.path.getsize(table)
        assert keys[1] not in size_partitions(spark, 10 << 20)       # 10 MB: nothing to raise
        for k in keys:
            spark.conf.unset(k)
        big = size_partitions(spark, 100 << 40)        # 100 TB
        assert int(big[keys[1]]) == (100 << 40) // SHUFFLE_TARGET_BYTES
        assert size_partitions(spark, 200 << 40) == {}  # a value that is set wins
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cli_options(spark, scratch):
    """Every documented option of the jobs, from history to lines of ways."""
    import glob
    hist, cs = os.path.join(scratch, "history"), os.path.join(scratch, "changesets")
    h = fixture_history(spark, SF_SMALL)
    h.unionByName(h.filter("id % 3 = 0")).write.parquet(hist)      # versions stored twice
    fixture_changesets(spark, SF_SMALL).write.parquet(cs)
    rules, out, enr = (os.path.join(scratch, x) for x in ("rules.json", "out", "all"))
    with open(rules, "w") as f:
        json.dump(shipped_rules().extra, f)
    assert jobs.main(["extract", "--history_uri", hist, "--rules_uri", rules, "--output_uri", out,
                      "--format", "parquet", "--dedupe", "--review_rows", "7", "--deletion_changeset"]) == 0
    assert read_candidates(spark, out).where("deletion_changeset is not null").count() == 115
    assert spark.read.parquet(out + "_review").count() == 7
    assert jobs.main(["enrich-all", "--input", out, "--changesets_uri", cs, "--output", enr, "--format", "parquet"]) == 0
    assert spark.read.parquet(enr).count() == 115
    base = os.path.join(scratch, "export")
    assert jobs.main(["export-geo", "--input", out, "--output_base", base, "--archive_dates",
                      "--history_uri", hist, "--format", "parquet"]) == 0
    feature = json.loads(open(sorted(glob.glob(base + ".geojson/part-*"))[0]).readline())
    assert feature["properties"]["start_date"] <= feature["properties"]["end_date"]
    lines = spark.read.parquet(base + ".ways")
    assert lines.count() == 27 and lines.where("geometry like '%LineString%'").count() > 20
    assert jobs.main(["profile", "--input", out]) == 0


def test_nothing_kept_runs_through_all_jobs(spark, scratch):
    out, enr, base = (os.path.join(scratch, x) for x in ("out", "enr", "export"))
    none = shipped_rules().replace(min_versions=10**6)
    m = jobs.run_extract(spark, fixture_history(spark, SF_SMALL), none, out)
    assert m["rows"] == 0
    cands = read_candidates(spark, out)
    assert cands.count() == 0 and cands.columns == CANDIDATE_COLUMNS
    em = jobs.run_enrich(spark, cands, fixture_changesets(spark, SF_SMALL), enr)
    assert em["candidates"] == em["unique_changesets"] == 0
    jobs.run_enrich_keep_all(spark, cands, fixture_changesets(spark, SF_SMALL), os.path.join(scratch, "all"))
    for collection in (False, True):
        gm = jobs.run_export_geo(spark, read_candidates(spark, enr, schema=ENRICHED), base, collection=collection)
        assert gm["rows"] == gm["geoparquet_rows"] == 0
    assert os.listdir(base + ".geoparquet") == ["_SUCCESS"]
    assert jobs.run_profile(spark, read_candidates(spark, enr, schema=ENRICHED)) == {}


def test_crop_is_reported(spark, scratch):
    rules = shipped_rules().replace(bbox=[-180, -90, 180, -50])
    m = jobs.run_extract(spark, fixture_history(spark, SF_SMALL), rules, os.path.join(scratch, "out"))
    assert m == {"rows": 22, "nodes": 22, "ways": 0, "dropped_by_crop": 93}


def test_cli_extract(spark, scratch):
    hist = os.path.join(scratch, "history")
    fixture_history(spark, SF_SMALL).write.parquet(hist)
    rules = os.path.join(scratch, "rules.json")
    with open(rules, "w") as f:
        json.dump(shipped_rules().extra, f)
    out = os.path.join(scratch, "candidates")
    assert jobs.main(["extract", "--history_uri", hist, "--rules_uri", rules,
                      "--output_uri", out, "--format", "parquet"]) == 0
    assert read_candidates(spark, out).count() == 115


def test_queries_size_their_partitions_by_their_tables(spark, tmp_path):
    """A session's next query is sized anew; what the deployment has set stays."""
    from strata.plans.catalog import catalog
    from strata.session import ADVISORY_BYTES, SHUFFLE_TARGET_BYTES, resize_partitions
    from strata.sources.fixtures import fixture_history
    from strata.sources.layout import BUCKET_BYTES, write_history_by_object

    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    for name, n in (("small", 1000), ("large", 1_300_000)):
        spark.range(n, numPartitions=1).select(
            F.abs(F.xxhash64("id") % (1 << 40)).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
            F.lit(1).alias("l_linenumber"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate")).coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        spark.range(10).select(F.col("id").alias("p_partkey"), F.lit(1).alias("p_size")).write.parquet(f"{tmp_path}/{name}/part.parquet")
    size = sum(os.path.getsize(f) for t in ("lineitem", "part") for f in glob.glob(f"{tmp_path}/large/{t}.parquet/*.parquet"))
    saved = {k: spark.conf.get(k, None) for k in [*keys, "spark.sql.shuffle.partitions"]}
    try:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        for name in ("small", "large", "small", "large"):
            catalog()["extract_candidates_window_plan"](spark, f"{tmp_path}/{name}")
            assert spark.conf.get(keys[0]) == str(ADVISORY_BYTES)
            want = str(math.ceil(size / SHUFFLE_TARGET_BYTES)) if name == "large" else None
            assert spark.conf.get(keys[1], None) == want and want != "1"
        resize_partitions(spark, 1000)
        spark.conf.set(keys[1], "2")         # the deployment's choice
        catalog()["lifecycle_stats"](spark, f"{tmp_path}/large")
        assert spark.conf.get(keys[1]) == "2"
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    h = fixture_history(spark, f"{tmp_path}/large")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/large/lineitem.parquet/*.parquet"))
    assert write_history_by_object(h, f"{tmp_path}/laid") == math.ceil(size / BUCKET_BYTES) > 1


def test_a_larger_advisory_size_is_lowered(spark):
    """The advisory size bounds a task's memory: Spark's own 64 MB, stated by the
    deployment, is lowered for every input; a smaller one stays."""
    from strata.session import ADVISORY_BYTES, resize_partitions

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    saved = spark.conf.get(key, None)
    try:
        for given, want in (("64m", ADVISORY_BYTES), ("67108864b", ADVISORY_BYTES), ("1g", ADVISORY_BYTES), ("8m", "8m"), (str(ADVISORY_BYTES), ADVISORY_BYTES)):
            spark.conf.set(key, given)
            for n in (1000, 100 << 30, 1000):
                resize_partitions(spark, n)
                assert spark.conf.get(key) == str(want)
    finally:
        resize_partitions(spark, 1000)
        spark.conf.unset(key) if saved is None else spark.conf.set(key, saved)
