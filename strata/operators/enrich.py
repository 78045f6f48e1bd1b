"""Changeset enrichment: look up the changeset of each candidate, classify
its comment, keep what is not excluded.

Scale: the changeset table is the big side (hundreds of millions of rows);
the candidates are small. The table is cut down to the needed ids with a
left-semi join *before* anything else touches it, so the regex and the
candidate join only ever see needed rows. Which side is broadcast, if any, is
left to Spark's statistics and AQE at every size. A hot changeset shared by
many candidates is only a problem for a shuffled join, where AQE's skew-join
split applies (left outer, skew on the candidate side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.signal import comment_signal
from strata.functions.tags import normalize_tags
from strata.schema import CHANGESETS, validate


def project_changesets(changesets: DataFrame) -> DataFrame:
    """id/user/uid renamed, three tag values pulled out, the map dropped.
    A missing tag key gives NULL."""
    validate(changesets, CHANGESETS, "changesets")
    tags = normalize_tags(F.col("tags"), changesets.schema["tags"].dataType)
    return changesets.select(
        F.col("id").cast("long").alias("cs_id"),
        F.col("user").alias("cs_user"),
        F.col("uid").cast("long").alias("cs_uid"),
        tags.getItem("comment").alias("cs_comment"),
        tags.getItem("created_by").alias("cs_created_by"),
        tags.getItem("source").alias("cs_source"),
    )


def needed_changesets(candidates: DataFrame, changeset_col: str = "last_changeset",
                      ordered: bool = False) -> DataFrame:
    """Distinct non-NULL changeset ids referenced by the candidates (``cs_id``),
    optionally sorted (a range-partitioned sort, not a driver-side one)."""
    ids = (candidates.select(F.col(changeset_col).alias("cs_id"))
                     .filter(F.col("cs_id").isNotNull())
                     .distinct())
    return ids.orderBy("cs_id") if ordered else ids


#: A cover of needed ids has at most COVER ranges, found on at most COVER_SLOTS rows.
COVER, COVER_SLOTS = 64, 4096

Cover = list[tuple[int, int]]


def id_cover(needed_ids: DataFrame, ranges: int = COVER, slots: int = COVER_SLOTS) -> Cover:
    """At most ``ranges`` closed, ascending ranges that hold every ``cs_id``.

    The span of the ids is cut into ``slots`` equal slots, of which the lowest
    and highest id come to the driver (at most ``slots`` rows, whatever the
    table); the widest gaps between them separate the ranges. No id: no range.
    """
    low, high = needed_ids.agg(F.min("cs_id"), F.max("cs_id")).first()
    if low is None:
        return []
    slot = F.width_bucket(F.col("cs_id").cast("double"), F.lit(float(low)), F.lit(float(high) + 1.0), F.lit(slots))
    found = sorted(tuple(r) for r in needed_ids.groupBy(slot.alias("slot")).agg(
        F.min("cs_id").alias("low"), F.max("cs_id").alias("high")).select("low", "high").collect())
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][1] - found[i][0])[:ranges - 1]
    starts = [0, *sorted(gaps)]
    return [(found[a][0], found[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(found)])]


def in_cover(col: Column, cover: Cover) -> Column:
    """If ``col`` lies in the cover: one comparison with its ends and one with
    each gap, joined by AND, so that every part reaches the scan by itself."""
    if not cover:
        return F.lit(False)
    out = (col >= cover[0][0]) & (col <= cover[-1][1])
    for (_, before), (after, _) in zip(cover, cover[1:]):
        out = out & ((col <= before) | (col >= after))
    return out


def changeset_lookup(changesets: DataFrame, needed_ids: DataFrame, dedupe: bool = False,
                     cover: Cover | None = None) -> DataFrame:
    """Projected changesets restricted to ``needed_ids`` (left-semi join).

    ``dedupe`` keeps one row per id (the table has unique ids; without it a
    repeated id fans out in the later join, as in the reference). ``cover``, an
    ``id_cover`` of the needed ids, lets the scan skip what lies in its gaps.
    """
    if cover is not None:
        changesets = changesets.filter(in_cover(F.col("id"), cover))
    out = project_changesets(changesets).join(needed_ids.select("cs_id"), "cs_id", "left_semi")
    return out.dropDuplicates(["cs_id"]) if dedupe else out


def enrich(candidates: DataFrame, changesets: DataFrame, lexicon: str = "full",
           unicode_case: bool | None = None, changeset_col: str = "last_changeset",
           dedupe: bool = False, needed_ids: DataFrame | None = None, cover: Cover | None = None) -> DataFrame:
    """Candidates + ``cs_user, cs_uid, cs_comment, cs_created_by, cs_source,
    comment_signal``. Candidates without a changeset row keep NULLs (and are
    ``neutral``). ``candidates`` is read twice, once for the ids unless
    ``needed_ids`` has them, so it should be a stored table. ``cover``: see
    ``changeset_lookup``."""
    ids = needed_changesets(candidates, changeset_col) if needed_ids is None else needed_ids
    lookup = changeset_lookup(changesets, ids, dedupe, cover)
    joined = (candidates.join(lookup, F.col(changeset_col) == lookup["cs_id"], "left")
                        .drop("cs_id"))
    return joined.withColumn("comment_signal",
                             comment_signal(F.col("cs_comment"), lexicon, unicode_case))


#: Changeset columns of a candidate and what the columns of their changeset begin with.
ROLES = {"last_changeset": "", "deletion_changeset": "deletion_"}


def needed_by_roles(candidates: DataFrame, roles: dict[str, str] = ROLES) -> DataFrame:
    """Distinct changeset ids (``cs_id``) that any role of a candidate names."""
    return (candidates.select(F.explode(F.array(*roles)).alias("cs_id"))
                      .filter(F.col("cs_id").isNotNull()).distinct())


def enrich_roles(candidates: DataFrame, changesets: DataFrame, roles: dict[str, str] = ROLES,
                 lexicon: str = "full", unicode_case: bool | None = None,
                 needed_ids: DataFrame | None = None, cover: Cover | None = None) -> DataFrame:
    """``enrich`` for several changesets of a candidate at once: for every role
    its ``<prefix>cs_*`` columns and ``<prefix>comment_signal``.

    The ids of all roles are unpivoted into one narrow column, so the changeset
    table is scanned and cut down once; what is found is pivoted back to one row
    per (type, id) before the candidates are joined. One row comes out per
    candidate: of changesets under one id the smallest by all columns counts.
    A role without a changeset row keeps NULLs and is ``neutral``.
    ``candidates`` is read three times, so it should be a stored table.
    """
    missing = [c for c in roles if c not in candidates.columns]
    if missing:
        raise ValueError(f"candidates lack {', '.join(missing)} (extract with the deletion's changeset)")
    ids = needed_by_roles(candidates, roles) if needed_ids is None else needed_ids
    lookup = changeset_lookup(changesets, ids, cover=cover)
    fields = [c for c in lookup.columns if c != "cs_id"]
    named = candidates.select("type", "id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("role"), F.col(c).alias("cs_id")) for c in roles])).alias("one")).select("type", "id", "one.*")
    found = named.join(lookup, "cs_id").groupBy("type", "id").agg(*[
        F.min(F.when(F.col("role") == c, F.struct(*fields))).alias(f"_{c}") for c in roles])
    mine, theirs = candidates.alias("c"), found.alias("f")
    joined = mine.join(theirs, (F.col("c.type") == F.col("f.type")) & (F.col("c.id") == F.col("f.id")), "left")
    out = []
    for column, prefix in roles.items():
        out += [F.col(f"f._{column}.{name}").alias(prefix + name) for name in fields]
        out.append(comment_signal(F.col(f"f._{column}.cs_comment"), lexicon, unicode_case).alias(f"{prefix}comment_signal"))
    return joined.select("c.*", *out)


def keep_signals(enriched: DataFrame, signal_col: str = "comment_signal") -> DataFrame:
    """Drop ``exclude`` rows; ``strong`` and ``neutral`` stay."""
    return enriched.filter(F.col(signal_col) != "exclude")
