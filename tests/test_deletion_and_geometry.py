"""Deletion comments, ways in a crop, geometries with gaps, review strata,
the rule funnel and outputs that survive a failed run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import enrich as E
from strata.operators import extras as X
from strata.operators.lifecycle import lifecycle, prepare_history
from strata.operators.rules import extract_candidates, rule_funnel, rule_predicates, shipped_rules
from strata.plans import jobs
from strata.scratch import Scratch
from strata.sources.fixtures import fixture_changesets, fixture_history
from strata.sources.tables import read_candidates, write_candidates, write_parquet

RESOLVED = "way_id long, pos int, ref long, node_version long, lon double, lat double"


@pytest.fixture(scope="module")
def candidates(spark):
    c = extract_candidates(fixture_history(spark, SF_SMALL), shipped_rules(), deletion_changeset=True)
    return Scratch(spark, "test").save(c, "candidates")


def test_both_roles_equal_two_single_enrichments(spark, candidates):
    cs = fixture_changesets(spark, SF_SMALL)
    got = {(r["type"], r["id"]): r for r in E.enrich_roles(candidates, cs.unionByName(cs)).collect()}
    assert len(got) == candidates.count()
    for column, prefix in E.ROLES.items():
        for r in E.enrich(candidates, cs, changeset_col=column).collect():
            mine = got[r["type"], r["id"]]
            for c in ("cs_user", "cs_uid", "cs_comment", "cs_created_by", "cs_source", "comment_signal"):
                assert mine[prefix + c] == r[c]
    assert any(r["comment_signal"] != r["deletion_comment_signal"] for r in got.values())


def test_roles_scan_the_changesets_once(spark, candidates, scratch):
    fixture_changesets(spark, SF_SMALL).write.parquet(f"{scratch}/cs")
    plan = E.enrich_roles(candidates, spark.read.parquet(f"{scratch}/cs"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("user#") and sum("Relation [id#" in line and "user#" in line for line in plan.splitlines()) == 1


def test_roles_need_the_deletion_changeset(spark, candidates):
    with pytest.raises(ValueError, match="deletion_changeset"):
        E.enrich_roles(candidates.drop("deletion_changeset"), fixture_changesets(spark, SF_SMALL))


def test_cli_deletion_and_dedupe(spark, scratch):
    hist, cs, out, enr = (os.path.join(scratch, x) for x in ("history", "cs", "out", "enr"))
    fixture_history(spark, SF_SMALL).write.parquet(hist)
    once = fixture_changesets(spark, SF_SMALL)
    once.unionByName(once).write.parquet(cs)
    rules = os.path.join(scratch, "rules.json")
    with open(rules, "w") as f:
        json.dump(shipped_rules().extra | {"bbox": [-180, -90, 180, -50]}, f)
    assert jobs.main(["extract", "--history_uri", hist, "--rules_uri", rules, "--output_uri", out, "--format", "parquet",
                      "--deletion_changeset", "--crop_ways", "--review_strata", "2"]) == 0
    rows = read_candidates(spark, out)
    assert rows.where("type = 'way'").count() > 0 and rows.where("type = 'node'").count() == 22
    assert [r["count"] for r in spark.read.parquet(out + "_review").groupBy("type").count().collect()] == [2, 2]
    for extra in ([], ["--deletion", "--keep_by", "deletion_comment_signal", "--no-unicode_case"]):
        assert jobs.main(["enrich", "--candidates_uri", out, "--changesets_uri", cs, "--output_uri", enr, "--format", "parquet", "--dedupe", *extra]) == 0
        kept = read_candidates(spark, enr)
        assert kept.groupBy("type", "id").count().where("count > 1").isEmpty()
        assert kept.where(f"{extra[2] if extra else 'comment_signal'} = 'exclude'").isEmpty()
    assert jobs.main(["enrich-all", "--input", out, "--changesets_uri", cs, "--output", enr + "-all", "--format", "parquet", "--deletion"]) == 0
    assert spark.read.parquet(enr + "-all").count() == rows.count()


def test_crop_reports_what_it_drops(spark, scratch):
    rules = shipped_rules().replace(bbox=[-180, -90, 180, -50])
    m = jobs.run_extract(spark, fixture_history(spark, SF_SMALL), rules, os.path.join(scratch, "out"), crop_ways=True)
    assert m["rows"] + m["dropped_by_crop"] + m["outside_crop"] == 115 and m["nodes"] == 22 and m["ways"] > 0
    same = extract_candidates(fixture_history(spark, SF_SMALL), rules, crop_ways=True)
    assert same.count() == m["rows"]


def test_envelopes_and_boxes_over_180_degrees(spark):
    rows = [(1, 1, 1, 1, 179.0, 1.0), (1, 2, 2, 1, -179.0, 2.0), (2, 1, 1, 1, -10.0, 0.0), (2, 2, 2, 1, 20.0, 5.0), (2, 3, 3, 1, None, None),
            (3, 1, 1, 1, None, None), (4, 1, 1, 1, 170.0, 3.0)]
    got = {r["way_id"]: (r["west"], r["east"], r["south"], r["north"]) for r in X.way_envelopes(spark.createDataFrame(rows, RESOLVED)).collect()}
    assert got == {1: (179.0, -179.0, 1.0, 2.0), 2: (-10.0, 20.0, 0.0, 5.0), 4: (170.0, 170.0, 3.0, 3.0)}
    assert X.longitudes((170.0, 0, -170.0, 1)) == [(170.0, 180.0), (-180.0, -170.0)]
    pts = spark.createDataFrame([(175.0, 0.0), (-175.0, 0.0), (0.0, 0.0), (None, None)], "last_lon double, last_lat double")
    assert X.crop_bbox(pts, (170.0, -1.0, -170.0, 1.0)).count() == 2


def geometries(spark, ways, tags=None):
    rows = [(w, i, ref, 1, *(xy or (None, None))) for w, refs in ways.items() for i, (ref, xy) in enumerate(refs, 1)]
    c = spark.createDataFrame([("way", w, (tags or {}).get(w, {"building": "yes"})) for w in ways], "type string, id long, good_tags map<string,string>")
    return {r["way_id"]: r for r in X.way_geometries(spark.createDataFrame(rows, RESOLVED), c).collect()}


def test_no_line_skips_a_vertex(spark):
    p = {i: (float(i), float(i) / 2) for i in range(10)}
    got = geometries(spark, {
        1: [(i, p[i]) for i in range(5)],
        2: [(0, p[0]), (1, p[1]), (2, None), (3, p[3]), (4, p[4]), (5, None), (6, p[6])],
        3: [(0, None), (1, p[1]), (2, None)],
        4: [(0, p[0]), (1, p[1]), (2, p[2]), (0, p[0])],
        5: [(0, p[0]), (1, p[1]), (2, p[2]), (0, p[0])],
        6: [(0, p[0]), (1, None), (2, p[2]), (3, p[3]), (0, p[0])],
        7: [(0, None), (1, p[1]), (2, p[2])],
        8: [(0, p[0]), (1, p[1]), (2, p[2]), (0, p[0])],
    }, {5: {"highway": "service"}, 8: {"highway": "pedestrian", "area": "yes"}})
    shape = {w: (r["geometry_type"], r["n_refs"], r["n_resolved"], r["n_parts"]) for w, r in got.items()}
    assert shape == {1: ("LineString", 5, 5, 1), 2: ("MultiLineString", 7, 5, 2), 3: (None, 3, 1, 0), 4: ("Polygon", 4, 4, 1), 5: ("LineString", 4, 4, 1),
                     6: ("LineString", 5, 4, 1), 7: ("LineString", 3, 2, 1), 8: ("Polygon", 4, 4, 1)}
    assert json.loads(got[2]["geometry"])["coordinates"] == [[list(p[0]), list(p[1])], [list(p[3]), list(p[4])]]
    assert json.loads(got[4]["geometry"])["coordinates"] == [[list(p[i]) for i in (0, 1, 2, 0)]]
    assert got[3]["geometry"] is None and json.loads(got[1]["geometry"])["coordinates"] == [list(p[i]) for i in range(5)]


def test_export_of_way_geometries(spark, candidates, scratch):
    base = os.path.join(scratch, "export")
    jobs.run_export_geo(spark, candidates, base, history=fixture_history(spark, SF_SMALL), way_geometries=True)
    kinds = {r["geometry_type"]: r["count"] for r in spark.read.parquet(base + ".ways").groupBy("geometry_type").count().collect()}
    assert sum(kinds.values()) == 27 and kinds["LineString"] > 0 and None in kinds


def test_strata_do_not_depend_on_the_partitions(spark, candidates):
    take = lambda df: sorted((r["type"], r["id"]) for r in X.stratified_sample(df, 3, ["type"]).collect())
    one = take(candidates.coalesce(1))
    assert one == take(candidates.repartition(7)) and [t for t, _ in one] == ["node"] * 3 + ["way"] * 3
    plan = X.stratified_sample(candidates.repartition(7), 3, ["type"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2   # one before the shuffle


def test_funnel_against_one_rule_at_a_time(spark):
    base = lifecycle(prepare_history(fixture_history(spark, SF_SMALL), types=shipped_rules().object_types))
    preds = rule_predicates(shipped_rules())
    rows = base.select(*[F.coalesce(p, F.lit(False)).alias(n) for n, p in preds.items()]).collect()
    names = list(preds)
    want = []
    for i, n in enumerate(names):
        want.append((i + 1, n, sum(not r[n] for r in rows), sum(not r[n] and all(r[m] for m in names if m != n) for r in rows),
                     sum(not r[n] and all(r[m] for m in names[:i]) for r in rows)))
    assert [tuple(r) for r in rule_funnel(base, shipped_rules()).orderBy("step").collect()] == want
    assert sum(w[4] for w in want) + sum(all(r) for r in rows) == len(rows)


@pytest.mark.parametrize("write", [write_candidates, write_parquet])
def test_a_failed_run_keeps_the_old_output(spark, scratch, write):
    out = os.path.join(scratch, "out")
    write(spark.range(5).select("id", F.lit("node").alias("type")), out)
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 50, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"), F.lit("way").alias("type"))
    with pytest.raises(Exception, match="stop"):
        write(bad, out)
    assert spark.read.parquet(out).count() == 5 and os.listdir(scratch) == ["out"]
    write(spark.range(3).select("id", F.lit("way").alias("type")), out)
    assert spark.read.parquet(out).count() == 3 and os.listdir(scratch) == ["out"]
