"""Declarative candidate rules compiled into one Spark predicate.

A rule set is a JSON object (see ``strata/resources/rules.json``). Keys
starting with ``_`` are comments and unknown keys are ignored. Each enabled
rule becomes a named Column; ``compile_rules`` ANDs them, so Catalyst can
push every part to the lowest operator that has its inputs (count and
lifetime rules land right above the aggregate).

NULL handling is three-valued on purpose and matches the reference: a rule
that evaluates to NULL (e.g. tag rules on a never-visible object, or
``creator_uid != last_uid`` with an anonymous editor) drops the row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from importlib import resources

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.tags import has_any_key
from strata.schema import CANDIDATE_COLUMNS
from strata.operators.lifecycle import attach_payload, lifecycle_scalar, prepare_history
from strata.operators.extras import crop_bbox, crop_objects
from strata.operators.sampling import sample_objects
from strata.scratch import Scratch

REQUIRED_KEYS = ("object_types", "min_versions", "min_distinct_users", "min_lifetime_days",
                 "min_age_at_deletion_days", "min_tag_count_last_visible")


@dataclass(frozen=True)
class Rules:
    object_types: tuple[str, ...]
    min_versions: int
    min_distinct_users: int
    min_lifetime_days: int
    min_age_at_deletion_days: int
    min_tag_count_last_visible: int
    must_be_deleted: bool = False
    exclude_deletions_by_creator: bool = False
    required_tags_any: tuple[str, ...] = ()
    exclude_tags_keys: tuple[str, ...] = ()
    way_min_nodes: int = 0
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_dict(cls, d: dict) -> "Rules":
        missing = [k for k in REQUIRED_KEYS if k not in d]
        if missing:
            raise KeyError(f"rules: required key(s) missing: {', '.join(missing)}")
        return cls(
            object_types=tuple(d["object_types"]),
            min_versions=int(d["min_versions"]),
            min_distinct_users=int(d["min_distinct_users"]),
            min_lifetime_days=int(d["min_lifetime_days"]),
            min_age_at_deletion_days=int(d["min_age_at_deletion_days"]),
            min_tag_count_last_visible=int(d["min_tag_count_last_visible"]),
            must_be_deleted=bool(d.get("must_be_deleted")),
            exclude_deletions_by_creator=bool(d.get("exclude_deletions_by_creator")),
            required_tags_any=tuple(d.get("required_tags_any") or ()),
            exclude_tags_keys=tuple(d.get("exclude_tags_keys") or ()),
            way_min_nodes=int(d.get("way_min_nodes") or 0),
            extra={k: v for k, v in d.items() if not k.startswith("_")},
        )

    @classmethod
    def from_json(cls, text: str) -> "Rules":
        return cls.from_dict(json.loads(text))

    def replace(self, **changes) -> "Rules":
        d = dict(self.extra)
        d.update({k: getattr(self, k) for k in REQUIRED_KEYS})
        for k in ("must_be_deleted", "exclude_deletions_by_creator", "required_tags_any",
                  "exclude_tags_keys", "way_min_nodes"):
            d[k] = getattr(self, k)
        d.update(changes)
        return Rules.from_dict(d)


def shipped_rules() -> Rules:
    text = resources.files("strata.resources").joinpath("rules.json").read_text()
    return Rules.from_json(text)


def load_rules(spark, uri: str) -> Rules:
    """Read a rules JSON from any Hadoop filesystem path (local, HDFS, S3A...).

    The file is tiny; it is read as one text record and parsed on the driver.
    """
    rows = spark.read.text(uri, wholetext=True).collect()
    if not rows:
        raise FileNotFoundError(uri)
    return Rules.from_json(rows[0][0])


def lifetime_days() -> Column:
    return F.datediff(F.col("last_edit_at"), F.col("created_at"))


def age_at_deletion_days() -> Column:
    return F.datediff(F.col("deleted_at"), F.col("created_at"))


def rule_predicates(rules: Rules) -> dict[str, Column]:
    """Every enabled rule as a named predicate over the lifecycle table."""
    keys = F.map_keys(F.col("good_tags"))
    preds: dict[str, Column] = {}
    if rules.must_be_deleted:
        preds["must_be_deleted"] = F.col("last_visible") == F.lit(False)
    preds["min_versions"] = F.col("num_versions") >= rules.min_versions
    preds["min_distinct_users"] = F.col("distinct_users") >= rules.min_distinct_users
    preds["min_lifetime_days"] = lifetime_days() >= rules.min_lifetime_days
    preds["min_age_at_deletion_days"] = age_at_deletion_days() >= rules.min_age_at_deletion_days
    if rules.exclude_deletions_by_creator:
        preds["exclude_deletions_by_creator"] = F.col("creator_uid") != F.col("last_uid")
    if rules.required_tags_any:
        preds["required_tags_any"] = has_any_key(keys, rules.required_tags_any)
    if rules.exclude_tags_keys:
        preds["exclude_tags_keys"] = ~has_any_key(keys, rules.exclude_tags_keys)
    preds["min_tag_count_last_visible"] = F.size(F.col("good_tags")) >= rules.min_tag_count_last_visible
    if rules.way_min_nodes:
        preds["way_min_nodes"] = ((F.col("type") != "way")
                                  | (F.size(F.col("last_nds")) >= rules.way_min_nodes))
    return preds


# Rules that read the last visible version's tags or node refs.
PAYLOAD_RULES = ("required_tags_any", "exclude_tags_keys", "min_tag_count_last_visible",
                 "way_min_nodes")


def compile_rules(rules: Rules, only=None, skip=()) -> Column:
    """AND of the enabled rules (``only``: restrict to these names; ``skip``: leave these out)."""
    out = F.lit(True)
    for name, pred in rule_predicates(rules).items():
        if (only is None or name in only) and name not in skip:
            out = out & pred
    return out


def funnel_counts(rules: Rules, only=None, skip=()) -> list[Column]:
    """Aggregates that say what each rule rejects (a rule that is NULL rejects
    too): ``<rule>`` all rows that fail it, ``<rule>:alone`` those that fail no
    other one, ``<rule>:after`` those that the rules before it let through. A
    row's failures are one bit per rule; only the counts are kept."""
    names = [n for n in rule_predicates(rules) if (only is None or n in only) and n not in skip]
    preds = rule_predicates(rules)
    bits = F.lit(0)
    for i, n in enumerate(names):
        bits = bits + F.when(preds[n], 0).otherwise(1 << i)
    out = [F.count(F.lit(1)).alias("rows"), F.count_if(bits == 0).alias("kept")]
    for i, n in enumerate(names):
        out += [F.count_if(bits.bitwiseAND(F.lit(1 << i)) != 0).alias(n), F.count_if(bits == 1 << i).alias(f"{n}:alone"),
                F.count_if(bits.bitwiseAND(F.lit((1 << i + 1) - 1)) == 1 << i).alias(f"{n}:after")]
    return out


def rule_funnel(objects: DataFrame, rules: Rules, only=None, skip=()) -> DataFrame:
    """(step, rule, rejects, alone, after) over lifecycle rows: one aggregate of
    their failure patterns, partial before the shuffle, then one row per rule."""
    names = [n for n in rule_predicates(rules) if (only is None or n in only) and n not in skip]
    counts = objects.agg(*funnel_counts(rules, only, skip))
    rows = [F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("rule"), F.col(f"`{n}`").alias("rejects"),
                     F.col(f"`{n}:alone`").alias("alone"), F.col(f"`{n}:after`").alias("after")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def project_candidates(base: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return (base.withColumn("lifetime_days", lifetime_days())
                .withColumn("age_at_deletion_days", age_at_deletion_days())
                .select(*CANDIDATE_COLUMNS, *(extra or [])))


def survivors_of_scalar_rules(history: DataFrame, rules: Rules,
                              deletion_changeset: bool = False, funnel: Observation | None = None) -> DataFrame:
    """Hash-aggregated lifecycle rows passing every rule that needs no payload.
    ``funnel`` observes what each of these rules rejects in the same pass."""
    objects = lifecycle_scalar(history, deletion_changeset)
    if funnel is not None:
        objects = objects.observe(funnel, *funnel_counts(rules, skip=PAYLOAD_RULES))
    return objects.filter(compile_rules(rules, skip=PAYLOAD_RULES))


def extract_candidates(history: DataFrame, rules: Rules, sample_rate: float = 1.0,
                       dedupe: bool = False, deletion_changeset: bool = False,
                       scratch: Scratch | None = None, funnel: tuple[Observation, Observation] | None = None,
                       crop_ways: bool = False) -> DataFrame:
    """Version history -> deleted objects worth keeping (17 columns).

    The rules that need numbers only run on the narrow aggregate. Its few
    survivors are written to ``scratch`` (this part runs at once), and only
    they are joined to the tags and node refs, which the remaining rules judge.
    The same plan runs at every size; Spark picks the join from the
    survivors' file size. ``funnel`` observes the rules of both halves. A box in
    the rules keeps nodes inside it; with ``crop_ways`` ways that meet it too.
    """
    h = prepare_history(history, dedupe=dedupe)
    h = sample_objects(h, sample_rate)
    h = h.filter(F.col("type").isin(list(rules.object_types)))
    scratch = scratch or Scratch(h.sparkSession, "extract")
    survivors = scratch.save(survivors_of_scalar_rules(h, rules, deletion_changeset, funnel and funnel[0]), "survivors",
                             seen=[funnel[0]] if funnel else [])
    base = attach_payload(survivors, h)
    if funnel:
        base = base.observe(funnel[1], *funnel_counts(rules, only=PAYLOAD_RULES))
    base = base.filter(compile_rules(rules, only=PAYLOAD_RULES))
    out = project_candidates(base, ["deletion_changeset"] if deletion_changeset else None)
    # optional crop (documented for the rule file, never shipped): a bbox
    # [min_lon, min_lat, max_lon, max_lat] on the last visible position
    bbox = rules.extra.get("bbox")
    if bbox and crop_ways:
        whole = scratch.save(out, "uncropped")
        return crop_objects(whole, prepare_history(history, dedupe=dedupe), tuple(bbox), scratch).filter("crop = 'inside'").drop("crop")
    return crop_bbox(out, tuple(bbox)) if bbox else out
