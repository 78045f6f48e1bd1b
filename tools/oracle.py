"""DuckDB SQL for every checked catalog query.

The SQL is the naive formulation on purpose: ranking windows and joins
(the reference's shape) over the fixture derivation written as SQL text,
so the Spark side - fused aggregate, skew-safe derivation, library
functions - is checked against an independent route to the same rows.
Thresholds and lexicons come from the same data the library uses; everything
else (key matching, markers, hashes, encodings) is written out here.
"""

from __future__ import annotations

from strata.functions.lexicon import LEXICONS, alternation
from strata.operators.rules import Rules, shipped_rules
from strata.plans.catalog import BBOX, BBOX_OVER, EXACT_KEYS, PREFIX_KEYS, RULE_QUERY_NAMES

# ---------------------------------------------------------------- fixtures

HISTORY_CTES = """
v AS (
  SELECT l_orderkey o, l_partkey p, l_suppkey s, l_linenumber ln, l_shipdate ts,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS BIGINT) v,
    CAST(count(*) OVER (PARTITION BY l_orderkey) AS BIGINT) n
  FROM lineitem),
h0 AS (
  SELECT *,
    CASE WHEN o % 10 = 0 THEN 'relation' WHEN o % 10 IN (1, 2, 3) THEN 'way' ELSE 'node' END AS type,
    CASE WHEN o % 13 = 0 THEN false WHEN v = n AND o % 4 <> 0 THEN false
         WHEN v = 3 AND o % 5 = 0 THEN false ELSE true END AS visible,
    CAST(CASE WHEN o % 7 = 0 AND v IN (1, n) THEN 1 WHEN o % 11 = 0 THEN 1 + v % 2
         WHEN s % 23 = 0 THEN NULL ELSE s END AS BIGINT) AS uid
  FROM v),
h1 AS (
  SELECT type, o AS id, v AS version, visible, uid, ts + to_seconds(v * 600 + o % 600) AS ts,
    CASE WHEN o % 50 = 0 THEN -1 - p ELSE p END AS changeset, ln,
    CASE WHEN visible THEN CASE (o + v // 2) % 9 WHEN 0 THEN 'name,amenity,source' WHEN 1 THEN 'name:es,ref,source'
      WHEN 2 THEN 'building,height,fixme' WHEN 3 THEN 'highway,surface' WHEN 4 THEN 'ref,source,layer'
      WHEN 5 THEN 'historic:civilization,start_date,wikidata' WHEN 6 THEN 'was:shop,addr:street,addr:city'
      WHEN 7 THEN 'building,name,building:levels' ELSE 'name,shop,FIXME' END ELSE '' END AS keys,
    CASE WHEN type = 'node' AND visible THEN CAST(-90 + ((o * 37 + v * 11) % 18000) / 100.0 AS DOUBLE) END AS lat,
    CASE WHEN type = 'node' AND visible THEN CAST(-180 + ((o * 61 + v * 17) % 36000) / 100.0 AS DOUBLE) END AS lon,
    CAST(CASE WHEN type = 'way' AND visible THEN ln ELSE 0 END AS BIGINT) AS n_nds
  FROM h0),
hall AS (
  SELECT *, CASE WHEN keys = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(keys, ',') END AS klist,
    CASE WHEN keys = '' THEN '' ELSE array_to_string(list_sort(list_transform(string_split(keys, ','),
      lambda k: k || '=' || k || '-' || version)), ',') END AS tags_text,
    array_to_string(list_transform(range(1, n_nds + 1), lambda i: id - id % 10 + 4 + (id + i + version) % 6), ',') AS nds_refs
  FROM h1),
hist AS (SELECT * FROM hall WHERE type IN ({types}))"""

CHANGESET_CTES = """
cs AS (
  SELECT p_partkey AS cs_id, 'user_' || CAST(p_size AS VARCHAR) AS cs_user, CAST(p_size AS BIGINT) AS cs_uid,
    ['building demolished', 'reverted vandalism', 'update', NULL, 'edificio derribado', 'mass import of shops',
     '', 'torn down, was a test', 'abgerissen', 'fix import error', 'снесли', 'survey',
     'prédio derrubado', 'bâtiment supprimé', 'edificio abbattuto', 'budynek zburzony', 'gebouw gesloopt',
     'bygning fjernet', 'budova zbourana', 'bina yıkıldı', 'κατεδαφίστηκε', 'המבנה הוסר', 'أزيل المبنى',
     'تخریب شد', 'भवन ध्वस्त', '建筑拆除', '建物を撤去', '건물 철거',
     'duplicado por error', 'duplicado por erro', 'doublon annulé', 'doppelt, aus versehen',
     'vandalismo, duplicato', 'откат правок', '撤回', 'edificio ya no existe'][p_partkey % 36 + 1] AS cs_comment,
    CASE p_partkey % 5 WHEN 0 THEN 'iD 2.20' WHEN 1 THEN 'JOSM/1.5' WHEN 2 THEN 'Potlatch 2'
      WHEN 3 THEN 'Vespucci' END AS cs_created_by,
    CASE WHEN p_partkey % 3 = 0 THEN 'survey' END AS cs_source
  FROM part)"""

LIFECYCLE_CTES = """
stats AS (
  SELECT type, id, max(version) AS num_versions, count(DISTINCT uid) AS distinct_users,
         min(ts) AS created_at, max(ts) AS last_edit_at
  FROM hist GROUP BY type, id),
lastv AS (
  SELECT type, id, visible AS last_visible, uid AS last_uid, ts AS deleted_at, changeset AS deletion_changeset
  FROM hist QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version DESC) = 1),
firstv AS (
  SELECT type, id, uid AS creator_uid
  FROM hist QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version ASC) = 1),
lastvis AS (
  SELECT type, id, klist AS good_klist, tags_text AS good_tags_text, nds_refs AS last_nds_refs,
         lat AS last_lat, lon AS last_lon, n_nds AS last_n_nds,
         changeset AS last_changeset, version AS last_good_version
  FROM hist WHERE visible QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version DESC) = 1),
base AS (
  SELECT *,
    CAST(date_diff('day', CAST(created_at AS DATE), CAST(last_edit_at AS DATE)) AS INTEGER) AS lifetime_days,
    CAST(date_diff('day', CAST(created_at AS DATE), CAST(deleted_at AS DATE)) AS INTEGER) AS age_at_deletion_days
  FROM stats JOIN lastv USING (type, id) JOIN firstv USING (type, id) LEFT JOIN lastvis USING (type, id))"""

BASE_COLS = """type, id, num_versions, distinct_users, created_at, last_edit_at, last_visible, last_uid,
  deleted_at, creator_uid, good_tags_text, last_lat, last_lon, last_nds_refs, last_changeset, last_good_version"""

CAND_COLS = """type, id, num_versions, distinct_users, created_at, last_edit_at, deleted_at,
  lifetime_days, age_at_deletion_days, creator_uid, last_uid, last_changeset, last_good_version,
  last_lat, last_lon, last_nds_refs, good_tags_text"""

ROW_COLS = """type, id, version, visible, uid, ts AS "timestamp", changeset,
  tags_text, lat, lon, nds_refs"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _key_sql(key: str) -> str:
    return f"starts_with(k, {_q(key[:-1])})" if key.endswith("*") else f"k = {_q(key)}"


def has_any_sql(klist: str, keys) -> str:
    wanted = " OR ".join(map(_key_sql, keys))
    return f"(len(list_filter({klist}, lambda k: {wanted})) > 0)" if keys else "true"


def rule_sql(rules: Rules) -> dict[str, str]:
    out = {}
    if rules.must_be_deleted:
        out["must_be_deleted"] = "last_visible = false"
    out["min_versions"] = f"num_versions >= {rules.min_versions}"
    out["min_distinct_users"] = f"distinct_users >= {rules.min_distinct_users}"
    out["min_lifetime_days"] = f"lifetime_days >= {rules.min_lifetime_days}"
    out["min_age_at_deletion_days"] = f"age_at_deletion_days >= {rules.min_age_at_deletion_days}"
    if rules.exclude_deletions_by_creator:
        out["exclude_deletions_by_creator"] = "creator_uid <> last_uid"
    if rules.required_tags_any:
        out["required_tags_any"] = has_any_sql("good_klist", rules.required_tags_any)
    if rules.exclude_tags_keys:
        out["exclude_tags_keys"] = "NOT " + has_any_sql("good_klist", rules.exclude_tags_keys)
    out["min_tag_count_last_visible"] = f"len(good_klist) >= {rules.min_tag_count_last_visible}"
    if rules.way_min_nodes:
        out["way_min_nodes"] = f"(type <> 'way' OR last_n_nds >= {rules.way_min_nodes})"
    return out


def signal_sql(col: str, lexicon: str) -> str:
    neg, pos = LEXICONS[lexicon]
    # RE2's (?i) folds Unicode case; the fixture comments are ASCII or lower case
    return (f"CASE WHEN regexp_matches({col}, {_q('(?i)' + alternation(neg))}) THEN 'exclude' "
            f"WHEN regexp_matches({col}, {_q('(?i)' + alternation(pos))}) THEN 'strong' "
            f"ELSE 'neutral' END")


def _little_endian(col: str) -> str:
    """Hex of a double's bytes, the last one first."""
    return (f"array_to_string(list_transform(range(8), lambda i: "
            f"hex(unbin(substr(CAST(CAST({col} AS BIT) AS VARCHAR), 57 - 8 * i, 8)))), '')")


def _mix(k: str) -> str:
    return f"(({k}) * 3432918353) & 4294967295"


def _rotate(x: str, n: int) -> str:
    return f"((({x}) << {n}) | (({x}) >> {32 - n})) & 4294967295"


def _murmur_of_word(word: str, seed: int) -> int:
    """Murmur3 of a short ASCII string, four bytes at a time and then one by
    one, as 32 unsigned bits."""
    m = 0xFFFFFFFF
    data = word.encode()
    whole = len(data) // 4 * 4
    units = [int.from_bytes(data[i:i + 4], "little") for i in range(0, whole, 4)] + list(data[whole:])
    h = seed
    for k in units:
        k = k * 0xCC9E2D51 & m
        k = ((k << 15 | k >> 17) & m) * 0x1B873593 & m
        h ^= k
        h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def _murmur_cte(buckets: int) -> str:
    """kept_ids: objects whose Murmur3 of (type, id), seed 42 chained through
    both, is divisible by ``buckets`` as a signed integer."""
    m = 4294967295
    seeds = " ".join(f"WHEN '{t}' THEN {_murmur_of_word(t, 42)}" for t in ("node", "way", "relation"))
    step = lambda k, h, n: (f"{_mix(k)} AS a{n}, {_rotate(f'a{n}', 15)} AS b{n}, (b{n} * 461845907) & {m} AS c{n}, "  # noqa: E731
                            f"xor({h}, c{n}) AS d{n}, {_rotate(f'd{n}', 13)} AS e{n}, (e{n} * 5 + 3864292196) & {m} AS h{n}")
    return f"""
hashed AS (SELECT type, id, CAST(CASE type {seeds} END AS HUGEINT) AS h0, CAST(id & {m} AS HUGEINT) AS low, CAST((id >> 32) & {m} AS HUGEINT) AS high,
  {step('low', 'h0', 1)}, {step('high', 'h1', 2)}, xor(h2, 8) AS f0,
  (xor(f0, f0 >> 16) * 2246822507) & {m} AS f1, (xor(f1, f1 >> 13) * 3266489909) & {m} AS f2, xor(f2, f2 >> 16) AS f3
  FROM (SELECT DISTINCT type, id FROM hist)),
kept_ids AS (SELECT type, id FROM hashed WHERE (CASE WHEN f3 >= 2147483648 THEN f3 - 4294967296 ELSE f3 END) % {buckets} = 0)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def build() -> dict[str, str]:
    rules = shipped_rules()
    types = ", ".join(_q(t) for t in rules.object_types)
    hist = HISTORY_CTES.format(types=types)
    preds = rule_sql(rules)
    all_rules = " AND ".join(f"({p})" for p in preds.values())
    cand_cte = f"""
cand0 AS (SELECT * FROM base WHERE {all_rules}),
cand AS (SELECT * FROM cand0)"""
    life = _with(hist, LIFECYCLE_CTES)
    cand = _with(hist, LIFECYCLE_CTES, cand_cte)

    def enriched_cte(lexicon):
        return f"""
enr AS (
  SELECT c.*, l.cs_user, l.cs_uid, l.cs_comment, l.cs_created_by, l.cs_source,
         {signal_sql('l.cs_comment', lexicon)} AS comment_signal
  FROM cand c LEFT JOIN (SELECT * FROM cs WHERE cs_id IN (SELECT last_changeset FROM cand)) l
    ON c.last_changeset = l.cs_id),
kept AS (SELECT * FROM enr WHERE comment_signal <> 'exclude')"""

    enr = _with(hist, LIFECYCLE_CTES, cand_cte, CHANGESET_CTES, enriched_cte("full"))
    enr_short = _with(hist, LIFECYCLE_CTES, cand_cte, CHANGESET_CTES, enriched_cte("short"))
    enr_cols = CAND_COLS + ", cs_user, cs_uid, cs_comment, cs_created_by, cs_source, comment_signal"

    sql: dict[str, str] = {}
    sql["extract_candidates"] = f"{cand} SELECT {CAND_COLS} FROM cand"
    sql["extract_candidates_window_plan"] = sql["extract_candidates"]
    sql["extract_candidates_two_pass"] = sql["extract_candidates"]
    sql["filter_object_types"] = f"{_with(hist)} SELECT {ROW_COLS} FROM hist"
    sql["last_version"] = (f"{_with(hist)} SELECT {ROW_COLS} FROM hist "
                           "QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version DESC) = 1")
    sql["first_version"] = (f"{_with(hist)} SELECT {ROW_COLS} FROM hist "
                            "QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version ASC) = 1")
    sql["last_visible_version"] = (f"{_with(hist)} SELECT {ROW_COLS} FROM hist WHERE visible "
                                   "QUALIFY row_number() OVER (PARTITION BY type, id ORDER BY version DESC) = 1")
    sql["lifecycle_stats"] = f"{life} SELECT * FROM stats"
    sql["join_last"] = (f"{life} SELECT s.*, l.last_visible, l.last_uid, l.deleted_at "
                        "FROM stats s JOIN lastv l USING (type, id)")
    sql["join_first"] = (f"{life} SELECT s.*, l.last_visible, l.last_uid, l.deleted_at, f.creator_uid "
                         "FROM stats s JOIN lastv l USING (type, id) JOIN firstv f USING (type, id)")
    sql["join_last_visible_left"] = f"{life} SELECT {BASE_COLS} FROM base"
    sql["lifecycle_fused"] = sql["join_last_visible_left"]
    for rule, pred in preds.items():
        sql[RULE_QUERY_NAMES[rule]] = f"{life} SELECT {BASE_COLS} FROM base WHERE {pred}"
    sql["rule_min_lifetime_strict"] = f"{life} SELECT {BASE_COLS} FROM base WHERE lifetime_days >= 400"
    sql["rules_all"] = f"{life} SELECT {BASE_COLS} FROM base WHERE {all_rules}"
    for name, keys in (("tag_match_exact", EXACT_KEYS), ("tag_match_prefix", PREFIX_KEYS),
                       ("tag_match_any", ["*"])):
        sql[name] = f"{_with(hist)} SELECT type, id, version, {has_any_sql('klist', keys)} AS matched FROM hall"

    sql["needed_changesets"] = (f"{cand} SELECT DISTINCT last_changeset AS cs_id FROM cand "
                                "WHERE last_changeset IS NOT NULL")
    sql["changeset_projection"] = f"{_with(CHANGESET_CTES)} SELECT * FROM cs"
    sql["changeset_semi_lookup"] = (f"{_with(hist, LIFECYCLE_CTES, cand_cte, CHANGESET_CTES)} "
                                    "SELECT * FROM cs WHERE cs_id IN (SELECT last_changeset FROM cand)")
    sql["enrich_left"] = f"{enr} SELECT {enr_cols} FROM enr"
    sql["comment_signal_full"] = (f"{_with(CHANGESET_CTES)} SELECT cs_id, cs_comment, "
                                  f"{signal_sql('cs_comment', 'full')} AS comment_signal FROM cs")
    sql["comment_signal_short"] = (f"{_with(CHANGESET_CTES)} SELECT cs_id, cs_comment, "
                                   f"{signal_sql('cs_comment', 'short')} AS comment_signal FROM cs")
    sql["enrich_short_keep_all"] = f"{enr_short} SELECT {enr_cols} FROM enr"
    sql["signal_distribution_before"] = f'{enr} SELECT comment_signal, count(*) AS "count" FROM enr GROUP BY 1'
    sql["signal_distribution_after"] = f'{enr} SELECT comment_signal, count(*) AS "count" FROM kept GROUP BY 1'
    sql["keep_non_excluded"] = f"{enr} SELECT {enr_cols} FROM kept"
    sql["top_editors"] = (f'{enr} SELECT cs_created_by, count(*) AS "count" FROM kept GROUP BY 1 '
                          'ORDER BY "count" DESC, cs_created_by ASC NULLS FIRST LIMIT 15')
    sql["top_editors_non_null"] = (f'{enr_short} SELECT cs_created_by, count(*) AS "count" FROM enr '
                                   'WHERE cs_created_by IS NOT NULL GROUP BY 1 '
                                   'ORDER BY "count" DESC, cs_created_by ASC NULLS FIRST LIMIT 10')
    sql["strong_comments"] = (f"{enr} SELECT DISTINCT cs_comment FROM kept WHERE comment_signal = 'strong' "
                              "ORDER BY cs_comment ASC NULLS FIRST LIMIT 20")
    sql["tag_key_frequency"] = (
        f'{cand} SELECT type, key, "count", CAST("rank" AS INTEGER) AS "rank" FROM ('
        f'  SELECT type, key, count(*) AS "count", row_number() OVER (PARTITION BY type '
        f'    ORDER BY count(*) DESC, key ASC) AS "rank"'
        f'  FROM (SELECT type, unnest(good_klist) AS key FROM cand) GROUP BY type, key)'
        f' WHERE "rank" <= 20')
    sql["run_metrics"] = (f"{cand} SELECT count(*) AS total, CAST(count_if(type = 'node') AS BIGINT) AS nodes, "
                          "CAST(count_if(type = 'way') AS BIGINT) AS ways, "
                          "count(DISTINCT last_changeset) AS unique_changesets FROM cand")
    sql["preview"] = (f"{cand} SELECT {CAND_COLS} FROM cand "
                      "QUALIFY row_number() OVER (PARTITION BY type ORDER BY id) <= 5")
    sql["write_candidates_roundtrip"] = sql["extract_candidates"]
    sql["read_partition_roundtrip"] = f"{cand} SELECT {CAND_COLS} FROM cand WHERE type IN ('way', 'relation')"
    sql["union_types"] = f"{enr} SELECT {enr_cols} FROM kept"

    sql["node_points"] = (
        f"""{cand} SELECT type, id, CASE WHEN type = 'node' AND last_lat IS NOT NULL AND last_lon IS NOT NULL
          AND NOT isnan(last_lat) AND NOT isnan(last_lon)
          THEN '{{"type":"Point","coordinates":[' || CAST(last_lon AS VARCHAR) || ','
               || CAST(last_lat AS VARCHAR) || ']}}' END AS geometry FROM cand""")
    color = ("CASE comment_signal WHEN 'strong' THEN '#1a9850' WHEN 'neutral' THEN '#999999' "
             "WHEN 'exclude' THEN '#d73027' ELSE '#666666' END")
    symbol = ("CASE comment_signal WHEN 'strong' THEN 'star' WHEN 'neutral' THEN 'circle' "
              "WHEN 'exclude' THEN 'cross' ELSE 'circle' END")
    size = "CASE comment_signal WHEN 'strong' THEN 'medium' ELSE 'small' END"
    sql["marker_style"] = (f'{enr} SELECT type, id, comment_signal, {color} AS "marker-color", '
                           f'{symbol} AS "marker-symbol", {size} AS "marker-size" FROM enr')
    prop_cols = ["type", "id", "num_versions", "distinct_users", "created_at", "last_edit_at", "deleted_at",
                 "lifetime_days", "age_at_deletion_days", "creator_uid", "last_uid", "last_changeset",
                 "last_good_version", "good_klist", "cs_user", "cs_uid", "cs_comment", "cs_created_by",
                 "cs_source", "comment_signal"]
    n_props = " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in prop_cols)
    sql["feature_properties"] = (
        f"{enr} SELECT type, id, 3 + {n_props} AS n_properties, "
        "strftime(deleted_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(deleted_at) % 1000000 <> 0 "
        "THEN '.' || lpad(CAST(microsecond(deleted_at) % 1000000 AS VARCHAR), 6, '0') ELSE '' END "
        f"AS deleted_at_iso, {color} AS marker_color, cs_comment FROM kept")
    feature_cols = prop_cols[:13] + prop_cols[14:]
    iso = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"
    shown = {c: iso.format(c) for c in ("created_at", "last_edit_at", "deleted_at")}
    shown |= {'"marker-color"': color, '"marker-symbol"': symbol, '"marker-size"': size}
    pairs = ", ".join(f"'{c.strip(chr(34))}=' || CAST({shown.get(c, c)} AS VARCHAR)"
                      for c in [*feature_cols, '"marker-color"', '"marker-symbol"', '"marker-size"'])
    sql["geojson_features"] = (
        f"{enr} SELECT 'Feature' AS feature_type, CASE WHEN last_lat IS NOT NULL THEN 'Point' END AS geometry_type, "
        "last_lon AS lon, last_lat AS lat, replace(good_tags_text, ',', '|') AS tags_text, "
        f"array_to_string(list_sort(list_filter([{pairs}], lambda x: x IS NOT NULL)), '|') AS properties_text FROM kept")
    sql["job_export_geo"] = sql["geojson_features"]
    sql["tags_json"] = (f"""{_with(hist)} SELECT type, id, version, '{{{{' || array_to_string(list_transform(klist,
        lambda k: '"' || k || '":"' || k || '-' || version || '"'), ',') || '}}}}' AS tags_json FROM hist""").replace("{{", "{").replace("}}", "}")
    sql["orc_history"] = sql["filter_object_types"]
    sql["orc_changesets"] = sql["changeset_projection"]
    sql["needed_changesets_sorted"] = (f"{cand} SELECT count(DISTINCT last_changeset) AS n, min(last_changeset) AS low, "
                                       "max(last_changeset) AS high, 0::BIGINT AS out_of_order FROM cand")
    sql["write_parquet_roundtrip"] = sql["enrich_left"]
    sql["job_extract"] = sql["extract_candidates"]
    sql["job_enrich"] = sql["keep_non_excluded"]
    sql["job_enrich_all"] = sql["enrich_short_keep_all"]
    sql["job_profile"] = f"{cand} SELECT type, count(*) AS rows FROM cand GROUP BY type"
    sql["wkb_points"] = (f"{cand} SELECT type, id, '0101000000' || {_little_endian('last_lon')} || {_little_endian('last_lat')} AS wkb_hex "
                         "FROM cand WHERE type = 'node'")
    sql["sample_objects"] = f"{_with(hist)}, {_murmur_cte(10)} SELECT {ROW_COLS} FROM hist SEMI JOIN kept_ids USING (type, id)"
    sql["crop_bbox"] = (f"{cand} SELECT {CAND_COLS} FROM cand WHERE last_lon BETWEEN {BBOX[0]} AND {BBOX[2]} "
                        f"AND last_lat BETWEEN {BBOX[1]} AND {BBOX[3]}")
    sql["archive_dates"] = (f"{cand} SELECT type, id, strftime(created_at, '%Y-%m-%d') AS start_date, "
                            "strftime(last_edit_at, '%Y-%m-%d') AS end_date FROM cand")
    sql["review_sample"] = (f"{cand} SELECT type, id, last_good_version, "
                            "(id * 7919 + last_good_version * 104729) % 1000003 AS review_key FROM cand "
                            "ORDER BY review_key, type, id LIMIT 50")
    sql["resolve_ways"] = f"""{cand},
refs AS (
  SELECT c.id AS way_id, c.last_good_version, g.pos, c.id - c.id % 10 + 4 + (c.id + g.pos + c.last_good_version) % 6 AS ref
  FROM cand c, LATERAL (SELECT unnest(generate_series(1, c.last_n_nds)) AS pos) g
  WHERE c.type = 'way'),
timed AS (SELECT r.*, w.ts AS at FROM refs r JOIN hall w
  ON w.type = 'way' AND w.id = r.way_id AND w.version = r.last_good_version),
pairs AS (
  SELECT t.way_id, t.pos, n.version, n.visible, n.lat, n.lon,
         row_number() OVER (PARTITION BY t.way_id, t.pos ORDER BY n.ts DESC, n.version DESC) AS rk
  FROM timed t JOIN hall n ON n.type = 'node' AND n.id = t.ref AND n.ts <= t.at)
SELECT t.way_id, CAST(t.pos AS INTEGER) AS pos, t.ref, p.version AS node_version,
  CASE WHEN p.visible THEN p.lon END AS lon, CASE WHEN p.visible THEN p.lat END AS lat
FROM timed t LEFT JOIN pairs p ON p.way_id = t.way_id AND p.pos = t.pos AND p.rk = 1"""
    sql["way_linestrings"] = f"""SELECT way_id, CASE WHEN n >= 2 THEN n END AS n_points, CASE WHEN n >= 2 THEN first_lon END AS first_lon,
  CASE WHEN n >= 2 THEN last_lat END AS last_lat FROM (SELECT way_id, count(*) AS n, arg_min(lon, pos) AS first_lon, arg_max(lat, pos) AS last_lat
  FROM ({sql["resolve_ways"]}) WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY way_id)"""
    both = f"""
two AS (
  SELECT c.*, l.cs_user, l.cs_uid, l.cs_comment, l.cs_created_by, l.cs_source, {signal_sql('l.cs_comment', 'full')} AS comment_signal,
    d.cs_user AS deletion_cs_user, d.cs_uid AS deletion_cs_uid, d.cs_comment AS deletion_cs_comment, d.cs_created_by AS deletion_cs_created_by,
    d.cs_source AS deletion_cs_source, {signal_sql('d.cs_comment', 'full')} AS deletion_comment_signal
  FROM cand c LEFT JOIN cs l ON c.last_changeset = l.cs_id LEFT JOIN cs d ON c.deletion_changeset = d.cs_id)"""
    two_cols = enr_cols + ", deletion_changeset, " + ", ".join(
        f"deletion_{c}" for c in ("cs_user", "cs_uid", "cs_comment", "cs_created_by", "cs_source", "comment_signal"))
    two = _with(hist, LIFECYCLE_CTES, cand_cte, CHANGESET_CTES, both)
    sql["enrich_deletion"] = f"{two} SELECT {two_cols} FROM two"
    sql["job_enrich_deletion"] = f"{two} SELECT {two_cols} FROM two WHERE deletion_comment_signal <> 'exclude'"
    sql["enrich_dedupe"] = sql["enrich_left"]

    def crop_sql(box):
        """Degree by degree: a way's arc is the shorter one round the globe that
        holds its vertices; it meets the box if any of its whole hundredths does."""
        west, south, east, north = box
        inside = f"BETWEEN {west} AND {east}" if west <= east else f"NOT BETWEEN {east + 0.005} AND {west - 0.005}"
        return f"""WITH pos AS ({sql["resolve_ways"]}),
spread AS (SELECT way_id, min(lat) AS south, max(lat) AS north, min(lon) AS w, max(lon) AS e,
  min(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS w2, max(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS e2
  FROM pos WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY way_id),
arc AS (SELECT way_id, south, north, CASE WHEN e2 - w2 < e - w THEN w2 ELSE w END AS a, CASE WHEN e2 - w2 < e - w THEN e2 ELSE e END AS b FROM spread),
step AS (SELECT way_id, south, north, unnest(generate_series(CAST(round(a * 100) AS BIGINT), CAST(round(b * 100) AS BIGINT))) / 100.0 AS x FROM arc),
hit AS (SELECT way_id, bool_or((CASE WHEN x > 180 THEN x - 360 ELSE x END) {inside} AND south <= {north} AND north >= {south}) AS hit FROM step GROUP BY way_id)"""

    judged = lambda box: (
        f"CASE WHEN type = 'way' THEN CASE WHEN h.hit IS NULL THEN 'nowhere' WHEN h.hit THEN 'inside' ELSE 'outside' END "
        f"WHEN last_lon IS NULL OR last_lat IS NULL THEN 'nowhere' WHEN last_lon {'' if box[0] <= box[2] else 'NOT '}BETWEEN "
        + (f"{box[0]} AND {box[2]}" if box[0] <= box[2] else f"{box[2] + 0.005} AND {box[0] - 0.005}")
        + f" AND last_lat BETWEEN {box[1]} AND {box[3]} THEN 'inside' ELSE 'outside' END AS crop")
    of_ways = "(SELECT * FROM ({cand} SELECT * FROM cand)) c LEFT JOIN hit h ON c.type = 'way' AND h.way_id = c.id".replace("{cand}", cand)
    sql["crop_bbox_ways"] = f"{crop_sql(BBOX)} SELECT type, id, {judged(BBOX)} FROM {of_ways}"
    sql["crop_bbox_antimeridian"] = f"{crop_sql(BBOX_OVER)} SELECT type, id, {judged(BBOX_OVER)} FROM {of_ways}"
    sql["job_extract_crop_ways"] = f"{crop_sql(BBOX)} SELECT {CAND_COLS} FROM (SELECT c.*, {judged(BBOX)} FROM {of_ways}) WHERE crop = 'inside'"
    linear = "list_has_any(good_klist, ['highway', 'barrier', 'railway', 'waterway'])"   # no fixture object has an area tag
    sql["way_geometries"] = f"""WITH pos AS ({sql["resolve_ways"]}),
ends AS (SELECT way_id, count(*) AS n_refs, count(lon) AS n_resolved, arg_min(ref, pos) = arg_max(ref, pos) AS same FROM pos GROUP BY way_id),
island AS (SELECT way_id, pos, '[' || lon || ',' || lat || ']' AS xy, pos - row_number() OVER (PARTITION BY way_id ORDER BY pos) AS run FROM pos WHERE lon IS NOT NULL),
line AS (SELECT way_id, min(pos) AS first, '[' || string_agg(xy, ',' ORDER BY pos) || ']' AS line FROM island GROUP BY way_id, run HAVING count(*) >= 2),
shape AS (SELECT way_id, count(*) AS n_parts, string_agg(line, ',' ORDER BY first) AS lines FROM line GROUP BY way_id),
typed AS (SELECT e.*, coalesce(n_parts, 0) AS n_parts, lines, CASE WHEN n_parts IS NULL THEN NULL
  WHEN same AND n_refs >= 4 AND n_resolved = n_refs AND NOT {linear} THEN 'Polygon' WHEN n_parts = 1 THEN 'LineString' ELSE 'MultiLineString' END AS geometry_type
  FROM ends e LEFT JOIN shape s USING (way_id) JOIN (SELECT * FROM ({cand} SELECT * FROM cand)) c ON c.type = 'way' AND c.id = e.way_id)
SELECT way_id, n_refs, n_resolved, geometry_type, n_parts, '{{"type":"' || geometry_type || '","coordinates":' ||
  CASE WHEN geometry_type = 'LineString' THEN lines ELSE '[' || lines || ']' END || '}}' AS geometry FROM typed"""
    fails = {rule: f"(NOT coalesce({pred}, false))" for rule, pred in preds.items()}
    steps = []
    for i, (rule, fail) in enumerate(fails.items()):
        others = " AND ".join(f"NOT {f}" for r, f in fails.items() if r != rule) or "true"
        before = " AND ".join(f"NOT {f}" for f in list(fails.values())[:i]) or "true"
        steps.append(f"SELECT CAST({i + 1} AS INTEGER) AS step, '{rule}' AS rule, count(*) FILTER ({fail}) AS rejects, "
                     f"count(*) FILTER ({fail} AND {others}) AS alone, count(*) FILTER ({fail} AND {before}) AS after FROM base")
    sql["rule_funnel"] = f"{life} " + " UNION ALL ".join(steps)
    sql["review_strata"] = f"{enr} SELECT type, comment_signal, least(count(*), 5) AS n FROM enr GROUP BY type, comment_signal"
    sql["rules_from_file"] = sql["rules_all"]
    sql["geoparquet_roundtrip"] = (
        f"{enr} SELECT type, id, '0101000000' || {_little_endian('last_lon')} || {_little_endian('last_lat')} AS wkb_hex, "
        f"strftime(deleted_at, '%Y-%m-%dT%H:%M:%S') AS deleted_at, comment_signal, {color} AS marker_color FROM kept "
        "WHERE type = 'node' AND last_lat IS NOT NULL")
    sql["geoparquet_space_order"] = (
        f"{enr} SELECT type, id, '0101000000' || {_little_endian('last_lon')} || {_little_endian('last_lat')} AS wkb_hex, "
        "comment_signal, last_lon AS xmin, last_lat AS ymin, last_lon AS xmax, last_lat AS ymax FROM kept "
        "WHERE type = 'node' AND last_lat IS NOT NULL")
    sql["extract_by_object"] = sql["extract_candidates"]
    sql["extract_restarted"] = sql["extract_candidates"]
    sql["enrich_pruned"] = sql["enrich_left"]
    sql["deletion_changeset"] = (f"{cand} SELECT type, id, last_changeset, deletion_changeset FROM cand")
    return sql
