"""Fixture checksums, expected figures (FIXTURES.md §3) and properties."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MEDIUM, SF_SMALL
from strata.operators.enrich import enrich, keep_signals
from strata.operators.lifecycle import KEYS, prepare_history
from strata.operators.reports import signal_distribution
from strata.operators.rules import extract_candidates, shipped_rules
from strata.operators.sampling import sample_bucket, sample_objects
from strata.plans.catalog import catalog, comparable
from strata.sources.fixtures import fixture_changesets, fixture_history

CHECKSUMS = {  # versions, objects, sum(version), sum(uid), visible rows, sum(nds), changesets
    SF_SMALL: (6000, 1473, 18008, 24119, 4366, 5375, 200),
    SF_MEDIUM: (60000, 14743, 179498, 2414604, 43495, 52568, 2000),
}
FIGURES = {  # candidates, nodes, ways, exclude, neutral, strong
    SF_SMALL: (115, 88, 27, 29, 18, 68),
    SF_MEDIUM: (1259, 888, 371, 361, 165, 733),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_fixture_checksums(spark, sf):
    h = fixture_history(spark, sf)
    r = h.agg(F.count(F.lit(1)), F.count_distinct("type", "id"), F.sum("version"), F.sum("uid"),
              F.count_if("visible"), F.sum(F.size("nds"))).first()
    n_cs = fixture_changesets(spark, sf).count()
    assert tuple(r) + (n_cs,) == CHECKSUMS[sf]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_expected_figures(spark, sf):
    c = extract_candidates(fixture_history(spark, sf), shipped_rules())
    by_type = dict(c.groupBy("type").count().collect())
    e = enrich(c, fixture_changesets(spark, sf))
    sig = dict(signal_distribution(e).collect())
    got = (c.count(), by_type.get("node", 0), by_type.get("way", 0),
           sig.get("exclude", 0), sig.get("neutral", 0), sig.get("strong", 0))
    assert got == FIGURES[sf]


def test_extract_equals_the_role_joins(spark):
    h = fixture_history(spark, SF_MEDIUM)
    a = comparable(extract_candidates(h, shipped_rules()))
    b = catalog()["extract_candidates_window_plan"](spark, SF_MEDIUM)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tightening_a_rule_gives_a_subset(spark):
    h = fixture_history(spark, SF_MEDIUM)
    loose = extract_candidates(h, shipped_rules()).select(*KEYS)
    for change in ({"min_versions": 7}, {"min_distinct_users": 4}, {"min_age_at_deletion_days": 700},
                   {"min_tag_count_last_visible": 4}, {"way_min_nodes": 5}):
        tight = extract_candidates(h, shipped_rules().replace(**change)).select(*KEYS)
        assert tight.exceptAll(loose).count() == 0, change


def test_distribution_after_is_before_minus_exclude(spark):
    c = extract_candidates(fixture_history(spark, SF_MEDIUM), shipped_rules())
    e = enrich(c, fixture_changesets(spark, SF_MEDIUM))
    before = dict(signal_distribution(e).collect())
    after = dict(signal_distribution(keep_signals(e)).collect())
    before.pop("exclude")
    assert before == after


def test_sample_bucket_rounding():
    assert sample_bucket(0.001) == 1000
    assert sample_bucket(0.7) == 2 and sample_bucket(0.4) == 2   # half-to-even
    with pytest.raises(ValueError):
        sample_bucket(0)


def test_sampling_keeps_whole_objects_and_matches_abs_form(spark):
    h = comparable(prepare_history(fixture_history(spark, SF_MEDIUM)))   # maps cannot be EXCEPTed
    s = sample_objects(h, 0.1)
    abs_form = h.filter(F.abs(F.hash("type", "id").cast("long")) % 10 == 0)
    assert s.exceptAll(abs_form).count() == 0 and abs_form.exceptAll(s).count() == 0
    per_obj = s.groupBy(*KEYS).count().join(h.groupBy(*KEYS).count().withColumnRenamed("count", "all"), KEYS)
    assert per_obj.filter(F.col("count") != F.col("all")).count() == 0
    assert 0 < s.select(*KEYS).distinct().count() < h.select(*KEYS).distinct().count()
    assert sample_objects(h, 1.0) is h
