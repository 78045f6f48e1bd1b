"""Each rule at threshold-1 / threshold / NULL on tiny hand-made histories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.tags import KeyMatcher, has_any_key
from strata.operators.lifecycle import lifecycle
from strata.operators.rules import Rules, extract_candidates, rule_predicates, shipped_rules
from strata.schema import CANDIDATE_COLUMNS, HISTORY, SchemaError

T0 = dt.datetime(2015, 1, 1, 12, 0, 0)
GOOD_TAGS = {"name": "x", "building": "yes", "source": "survey"}


def day(n):
    return T0 + dt.timedelta(days=n)


def obj(oid, versions, typ="node"):
    """versions: list of (uid, day, visible, tags, nds_len) for versions 1..n."""
    rows = []
    for i, (uid, d, vis, tags, nds) in enumerate(versions, start=1):
        rows.append((typ, oid, i, vis, uid, day(d), 1000 * oid + i,
                     tags if vis else {}, 1.0 if vis and typ == "node" else None,
                     2.0 if vis and typ == "node" else None,
                     [(r,) for r in range(nds)] if typ == "way" and vis else []))
    return rows


def good(oid, typ="node", **kw):
    """A history passing every shipped rule: 5 versions, 3 editors, deleted
    after 400 days by someone other than the creator."""
    uids = kw.get("uids", [1, 2, 3, 2, 4])
    days = kw.get("days", [0, 100, 200, 300, 400])
    tags = kw.get("tags", GOOD_TAGS)
    nds = kw.get("nds", 4)
    vis = kw.get("visible", [True, True, True, True, False])
    return obj(oid, [(u, d, v, tags, nds) for u, d, v in zip(uids, days, vis)], typ)


def run(spark, rows, rules=None):
    df = spark.createDataFrame(rows, HISTORY)
    out = extract_candidates(df, rules or shipped_rules())
    return sorted(r["id"] for r in out.collect())


def test_passing_object(spark):
    rows = good(1) + good(2, typ="way")
    assert run(spark, rows) == [1, 2]


def test_output_columns(spark):
    df = spark.createDataFrame(good(1), HISTORY)
    assert extract_candidates(df, shipped_rules()).columns == CANDIDATE_COLUMNS


def test_still_visible_fails(spark):
    assert run(spark, good(1, visible=[True] * 5)) == []


def test_must_be_deleted_off_keeps_live(spark):
    # a live object's last version has tags, so the tag rules still pass
    rules = shipped_rules().replace(must_be_deleted=False, exclude_deletions_by_creator=False)
    assert run(spark, good(1, visible=[True] * 5), rules) == [1]


@pytest.mark.parametrize("n,expected", [(4, []), (5, [1])])
def test_min_versions_threshold(spark, n, expected):
    rows = good(1, uids=[1, 2, 3, 2, 4][:n], days=[0, 100, 200, 300, 400][:n],
                visible=[True] * (n - 1) + [False])
    assert run(spark, rows) == expected


def test_num_versions_is_max_version_not_row_count(spark):
    rows = [r for r in good(1) if r[2] != 2]      # version 2 missing: 4 rows, max version 5
    assert run(spark, rows) == [1]


@pytest.mark.parametrize("uids,expected", [([1, 2, 1, 2, 2], []), ([1, 2, 3, 2, 2], [1])])
def test_min_distinct_users(spark, uids, expected):
    # the deleter differs from the creator in both cases
    assert run(spark, good(1, uids=uids)) == expected


def test_null_uids_not_counted(spark):
    assert run(spark, good(1, uids=[1, None, None, 2, 2])) == []
    assert run(spark, good(1, uids=[1, None, 3, 2, 4])) == [1]


def test_anonymous_deleter_fails_creator_rule(spark):
    assert run(spark, good(1, uids=[1, 2, 3, 5, None])) == []


def test_creator_is_deleter_fails(spark):
    assert run(spark, good(1, uids=[1, 2, 3, 4, 1])) == []
    rules = shipped_rules().replace(exclude_deletions_by_creator=False)
    assert run(spark, good(1, uids=[1, 2, 3, 4, 1]), rules) == [1]


@pytest.mark.parametrize("last_day,expected", [(364, []), (365, [1])])
def test_min_age_at_deletion(spark, last_day, expected):
    assert run(spark, good(1, days=[0, 100, 200, 300, last_day])) == expected


def test_min_lifetime_only_bites_above_age_threshold(spark):
    # lifetime >= age always; with lifetime 500 > age 365 it can reject alone
    rules = shipped_rules().replace(min_lifetime_days=500)
    assert run(spark, good(1, days=[0, 100, 200, 300, 499]), rules) == []
    assert run(spark, good(1, days=[0, 100, 200, 300, 500]), rules) == [1]


def test_never_visible_object_fails_tag_rules(spark):
    rows = good(1, visible=[False] * 5)
    assert run(spark, rows) == []
    df = spark.createDataFrame(rows, HISTORY)
    base = lifecycle(df).collect()[0]
    assert base["good_tags"] is None and base["last_good_version"] is None


def test_resurrected_object_uses_last_visible_version(spark):
    tags_late = {"name": "late", "shop": "bakery", "building": "yes"}
    rows = obj(1, [(1, 0, True, GOOD_TAGS, 0), (2, 100, False, {}, 0), (3, 200, True, tags_late, 0),
                   (2, 300, True, tags_late, 0), (4, 400, False, {}, 0)])
    df = spark.createDataFrame(rows, HISTORY)
    c = extract_candidates(df, shipped_rules()).collect()
    assert len(c) == 1 and c[0]["last_good_version"] == 4 and c[0]["good_tags"]["name"] == "late"
    assert c[0]["last_changeset"] == 1004


def test_required_tags_exact_and_prefix(spark):
    assert run(spark, good(1, tags={"name:es": "x", "a": "1", "b": "2"})) == [1]
    assert run(spark, good(1, tags={"was:shop": "x", "a": "1", "b": "2"})) == [1]
    assert run(spark, good(1, tags={"ref": "x", "a": "1", "b": "2"})) == []
    # case-sensitive; "name:*" needs the colon
    assert run(spark, good(1, tags={"Name": "x", "a": "1", "b": "2"})) == []
    assert run(spark, good(1, tags={"namespace": "x", "a": "1", "b": "2"})) == []


def test_excluded_tags(spark):
    assert run(spark, good(1, tags={**GOOD_TAGS, "fixme": "?"})) == []
    assert run(spark, good(1, tags={**GOOD_TAGS, "FIXME": "?"})) == []
    assert run(spark, good(1, tags={**GOOD_TAGS, "Fixme": "?"})) == [1]


@pytest.mark.parametrize("tags,expected", [({"name": "x", "a": "1"}, []),
                                           ({"name": "x", "a": "1", "b": "2"}, [1])])
def test_min_tag_count(spark, tags, expected):
    assert run(spark, good(1, tags=tags)) == expected


@pytest.mark.parametrize("nds,expected", [(2, []), (3, [2])])
def test_way_min_nodes(spark, nds, expected):
    assert run(spark, good(2, typ="way", nds=nds)) == expected


def test_way_min_nodes_ignores_nodes(spark):
    assert run(spark, good(1, nds=0)) == [1]


def test_object_types_filter(spark):
    assert run(spark, good(3, typ="relation")) == []
    rules = shipped_rules().replace(object_types=["relation"])
    assert run(spark, good(3, typ="relation"), rules) == [3]


def test_empty_optional_lists_mean_off(spark):
    rules = shipped_rules().replace(required_tags_any=[], exclude_tags_keys=[])
    assert run(spark, good(1, tags={"fixme": "1", "a": "1", "b": "2"}), rules) == [1]
    assert set(rule_predicates(rules)) >= {"min_versions", "min_tag_count_last_visible"}
    assert "required_tags_any" not in rule_predicates(rules)


def test_null_key_rows_dropped(spark):
    rows = good(1) + [("node", None, 1, True, 9, day(0), 1, {}, None, None, [])]
    assert run(spark, rows) == [1]


def test_missing_required_rule_key():
    d = {"object_types": ["node"], "min_versions": 1}
    with pytest.raises(KeyError, match="min_distinct_users"):
        Rules.from_dict(d)


def test_rules_ignore_comments_and_unknown_keys():
    r = Rules.from_dict({"_c": "x", "object_types": ["node"], "min_versions": 1,
                         "min_distinct_users": 1, "min_lifetime_days": 0,
                         "min_age_at_deletion_days": 0, "min_tag_count_last_visible": 0,
                         "country": None})
    assert not r.must_be_deleted and r.way_min_nodes == 0


def test_shipped_rules_values():
    r = shipped_rules()
    assert (r.min_versions, r.min_distinct_users, r.min_lifetime_days,
            r.min_age_at_deletion_days, r.min_tag_count_last_visible, r.way_min_nodes) == (5, 3, 180, 365, 3, 3)
    prefixes = sum(k.endswith("*") for k in r.required_tags_any)
    assert (len(r.required_tags_any) - prefixes, prefixes) == (43, 15)


def test_key_matcher_against_plain_python(spark):
    keys = ["name", "name:es", "NAME", "a.b", "axb", "was:shop", "wa", "*", "", "x\\Ey", "new\nline", "é:1", "é"]
    rules = [["name"], ["name", "a.b"], ["name:*"], ["was:*", "name"], ["*"], [], ["x\\E*"], ["new*", "é:*"], ["a.*"], ["name*", "name"], [""]]
    df = spark.createDataFrame([([k],) for k in keys] + [([],), (keys,)], "k array<string>")
    for rule in rules:
        def wanted(ks):
            return not rule or any(k == r or r.endswith("*") and k.startswith(r[:-1]) for k in ks for r in rule)
        rows = df.select("k", KeyMatcher.of(rule)(F.col("k")).alias("hit")).collect()
        assert [r.hit for r in rows] == [wanted(r.k) for r in rows], rule


def test_has_any_key_edge_cases(spark):
    df = spark.createDataFrame([(["name"],), ([],), (None,), (["x:y"],)], "k array<string>")
    got = df.select(has_any_key(F.col("k"), ["*"]).alias("star"),
                    has_any_key(F.col("k"), []).alias("empty"),
                    has_any_key(F.col("k"), ["x:*"]).alias("pre")).collect()
    assert [r["star"] for r in got] == [True, False, None, True]
    assert [r["empty"] for r in got] == [True] * 4
    assert [r["pre"] for r in got] == [False, False, None, True]


def test_schema_validation_names_missing_column(spark):
    df = spark.createDataFrame(good(1), HISTORY).drop("visible")
    with pytest.raises(SchemaError, match="visible"):
        extract_candidates(df, shipped_rules())
