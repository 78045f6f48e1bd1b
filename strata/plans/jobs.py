"""End-to-end batch jobs.

    python -m strata.plans.jobs extract --history_uri H --rules_uri R --output_uri O [--sample_rate 0.001]
    python -m strata.plans.jobs enrich  --candidates_uri C --changesets_uri CS --output_uri O
    python -m strata.plans.jobs enrich-all --input C --changesets_uri CS --output O
    python -m strata.plans.jobs export-geo --input E --output_base B
    python -m strata.plans.jobs profile --input C
    python -m strata.plans.jobs layout --history_uri H --output_uri O [--buckets 512]

Each job runs on the session ``spark-submit`` provides and fills in only
unset settings. Metrics come from ``DataFrame.observe`` on the write itself,
not from extra passes; reports read the (small) written output back, so the
big inputs are scanned once. Jobs fail fast; a later job reads what an
earlier one wrote, which also cuts lineage between them.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import enrich as E
from strata.operators import extras as X
from strata.operators import reports as R
from strata.operators.lifecycle import prepare_history
from strata.operators.rules import Rules, extract_candidates, load_rules
from strata.schema import ENRICHED
from strata.scratch import Scratch, run_scratch
from strata.session import ensure_job_settings, plan_bytes, resize_partitions
from strata.sources import geo as G
from strata.sources.layout import JOIN_BY_BUCKET, read_history_by_object, write_history_by_object
from strata.sources.tables import (input_roots, read_candidates, read_changesets, read_history,
                                   write_candidates, write_parquet)


def _log(job: str, msg: str) -> None:
    print(f"[{job}] {msg}", flush=True)


def _signal_observer(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col("comment_signal") == s).alias(s)
                       for s in ("strong", "neutral", "exclude")])
    return out, obs


def _size(spark: SparkSession, job: str, *inputs: DataFrame) -> None:
    ensure_job_settings(spark)
    sized = resize_partitions(spark, plan_bytes(*inputs))
    if sized:
        _log(job, f"partition sizing: {json.dumps(sized)}")


# ---------------------------------------------------------------- B1

def run_extract(spark: SparkSession, history: DataFrame, rules: Rules, output_uri: str,
                sample_rate: float = 1.0, dedupe: bool = False, review_rows: int = 0,
                deletion_changeset: bool = False, crop_ways: bool = False, review_strata: int = 0,
                run_id: str | None = None) -> dict:
    """History -> candidates written partitioned by type; returns metrics.

    A bbox in the rules crops to positions inside it; ``dropped_by_crop`` says
    how many candidates that cost (ways among them: they have no position).
    With ``crop_ways`` ways whose envelope meets the box stay, ``outside_crop`` are
    those elsewhere and ``dropped_by_crop`` those without any position.
    ``review_rows`` writes that many rows for manual review beside the output,
    ``review_strata`` as many of each type. What each rule rejects is logged;
    it is counted in the passes that apply the rules.

    With a ``run_id`` the survivors of the number rules and the whole candidates are
    finished steps (``Ledger``): a run that failed and is started again under its id
    begins behind the last of them, without the history once both are written.
    """
    _size(spark, "extract", history)
    scratch = run_scratch(spark, "extract", run_id, {
        "history": input_roots(history), "output": output_uri, "rules": rules.extra, "sample_rate": sample_rate, "dedupe": dedupe,
        "deletion_changeset": deletion_changeset, "crop_ways": crop_ways})
    bbox = rules.extra.get("bbox")
    funnel = Observation("scalar_rules"), Observation("payload_rules")
    whole = extract_candidates(history, rules.replace(bbox=None), sample_rate=sample_rate, dedupe=dedupe,
                               deletion_changeset=deletion_changeset, scratch=scratch, funnel=funnel)
    if run_id or bbox and crop_ways:
        whole = scratch.save(whole, "uncropped", seen=[funnel[1]])
    if bbox and crop_ways:
        judged = scratch.save(X.crop_objects(whole, prepare_history(history, dedupe=dedupe), tuple(bbox), scratch), "cropped")
        lost = {r["crop"]: r["n"] for r in judged.groupBy("crop").agg(F.count(F.lit(1)).alias("n")).collect()}   # three rows
        observed, obs = R.observe_counts(judged.filter("crop = 'inside'").drop("crop"), "extract")
        write_candidates(observed, output_uri)
        metrics = dict(obs.get) | {"dropped_by_crop": lost.get("nowhere", 0), "outside_crop": lost.get("outside", 0)}
    else:
        whole, before = R.observe_counts(whole, "extract_whole")
        observed, obs = R.observe_counts(X.crop_bbox(whole, tuple(bbox) if bbox else None), "extract")
        write_candidates(observed, output_uri)
        metrics = dict(obs.get) | {"dropped_by_crop": before.get["rows"] - obs.get["rows"]}
    for part in funnel:
        rejects = scratch.metrics[part._name] if part._name in scratch.metrics else part.get
        _log("extract", f"{part._name}: {json.dumps(rejects)}")
    scratch.close()
    if review_rows or review_strata:
        rows = read_candidates(spark, output_uri)
        review = X.stratified_sample(rows, review_strata, ["type"]) if review_strata else X.review_sample(rows, review_rows)
        write_parquet(review, f"{output_uri.rstrip('/')}_review")
    _log("extract", f"wrote {output_uri}: {json.dumps(metrics)}")
    return metrics


# ---------------------------------------------------------------- B2

def _enriched(spark: SparkSession, candidates: DataFrame, changesets: DataFrame, lexicon: str, scratch: Scratch,
              dedupe: bool = False, unicode_case: bool | None = None, deletion: bool = False) -> tuple[DataFrame, Observation, int]:
    """Enriched rows with an observer of them, and the number of different
    changesets that the candidates name."""
    if deletion:
        ids = scratch.save(E.needed_by_roles(candidates), "ids")
        enriched = E.enrich_roles(candidates, changesets, lexicon=lexicon, unicode_case=unicode_case, needed_ids=ids,
                                  cover=E.id_cover(ids))
    else:
        ids = scratch.save(E.needed_changesets(candidates), "ids")
        enriched = E.enrich(candidates, changesets, lexicon=lexicon, unicode_case=unicode_case, dedupe=dedupe, needed_ids=ids,
                            cover=E.id_cover(ids))
    return *_signal_observer(enriched, "signals"), ids.count()


def run_enrich(spark: SparkSession, candidates: DataFrame, changesets: DataFrame,
               output_uri: str, lexicon: str = "full", show: bool = True, dedupe: bool = False,
               unicode_case: bool | None = None, deletion: bool = False, keep_by: str = "comment_signal",
               run_id: str | None = None) -> dict:
    """Candidates + changesets -> non-excluded rows written partitioned by
    type; candidates loaded, different changesets, and signal counts before
    and after the filter from the same pass.

    ``deletion`` adds the changeset that deleted the object and its signal, for
    candidates extracted with it; ``keep_by`` names the signal that decides.
    ``dedupe`` takes one row of a changeset that is stored twice (``deletion``
    always does). The scan of the changesets skips the gaps between the needed ids
    (``id_cover``). With a ``run_id`` the needed ids are a finished step.
    """
    _size(spark, "enrich", candidates, changesets)
    scratch = run_scratch(spark, "enrich", run_id, {"candidates": input_roots(candidates), "changesets": input_roots(changesets),
                                                    "output": output_uri, "deletion": deletion})
    enriched, before, ids = _enriched(spark, candidates, changesets, lexicon, scratch, dedupe, unicode_case, deletion)
    kept, after = _signal_observer(E.keep_signals(enriched, keep_by), "signals_after")
    write_candidates(kept, output_uri)
    metrics = {"candidates": before.get["rows"], "unique_changesets": ids,
               "before": dict(before.get), "after": dict(after.get)}
    scratch.close()
    _log("enrich", f"wrote {output_uri}: {json.dumps(metrics)}")
    if show:
        written = read_candidates(spark, output_uri, schema=ENRICHED)
        _log("enrich", "editors used most:")
        R.top_editors(written, n=15).show(truncate=False)
        _log("enrich", "some comments that say strongly that an object is gone:")
        R.strong_comments(written, n=20).show(truncate=False)
    return metrics


# ---------------------------------------------------------------- B3

def run_enrich_keep_all(spark: SparkSession, candidates: DataFrame, changesets: DataFrame,
                        output_uri: str, lexicon: str = "short", show: bool = True, dedupe: bool = False,
                        unicode_case: bool | None = None, deletion: bool = False, run_id: str | None = None) -> dict:
    """Every candidate with its changeset fields and signal (nothing
    dropped), one unpartitioned Parquet table. Options as of ``run_enrich``."""
    _size(spark, "enrich-all", candidates, changesets)
    scratch = run_scratch(spark, "enrich-all", run_id, {"candidates": input_roots(candidates), "changesets": input_roots(changesets),
                                                        "output": output_uri, "deletion": deletion})
    enriched, obs, ids = _enriched(spark, candidates, changesets, lexicon, scratch, dedupe, unicode_case, deletion)
    write_parquet(enriched, output_uri)
    metrics = dict(obs.get) | {"unique_changesets": ids}
    scratch.close()
    _log("enrich-all", f"wrote {output_uri}: {json.dumps(metrics)}")
    if show:
        R.top_editors(spark.read.parquet(output_uri), n=10, drop_null=True).show(truncate=False)
    return metrics


# ---------------------------------------------------------------- B4

def run_export_geo(spark: SparkSession, rows: DataFrame, output_base: str, collection: bool = False,
                   archive_dates: bool = False, history: DataFrame | None = None, way_geometries: bool = False,
                   space_order: bool = False, run_id: str | None = None) -> dict:
    """Candidates or enriched rows -> ``<base>.geojson`` (features) and
    ``<base>.geoparquet`` (node points). ``archive_dates`` adds start_date and
    end_date; with ``history``, the ways' lines go to ``<base>.ways``, or with
    ``way_geometries`` their lines and polygons, broken where a vertex is not known.
    ``space_order`` lays the points out along a Hilbert curve. With a ``run_id`` each
    output is a finished step, and so are the tables behind the ways' lines."""
    _size(spark, "to_geo", rows)
    scratch = run_scratch(spark, "to_geo", run_id, {
        "rows": input_roots(rows), "history": input_roots(history) if history is not None else None, "output": output_base,
        "collection": collection, "archive_dates": archive_dates, "way_geometries": way_geometries, "space_order": space_order})
    if archive_dates:
        rows = X.with_archive_dates(rows)

    def geojson():
        observed, obs = R.observe_counts(rows, "features")
        G.write_geojson(observed, f"{output_base}.geojson", collection=collection)
        return dict(obs.get)

    def geoparquet():
        files = G.write_geoparquet(rows, f"{output_base}.geoparquet", space_order=space_order)
        return {"geoparquet_rows": sum(n for _, n in files), "geoparquet_files": len(files)}

    def ways():
        resolved = scratch.save(X.resolve_ways(rows, history, scratch=scratch), "resolved")
        lines = X.way_geometries(resolved, rows) if way_geometries else X.way_linestrings(resolved)
        lines, seen = R.observe_rows(lines, "ways")
        write_parquet(lines, f"{output_base}.ways")
        return {"way_lines": seen.get["rows"]}

    steps = [("geojson", geojson), ("geoparquet", geoparquet)] + ([("ways", ways)] if history is not None else [])
    counts = {}
    for name, step in steps:
        counts |= scratch.once(name, step)
    scratch.close()
    _log("to_geo", json.dumps(counts))
    return counts


# ---------------------------------------------------------------- layout

def run_layout(spark: SparkSession, history: DataFrame, output_uri: str, buckets: int | None = None) -> int:
    """The history laid out by object, for runs that read it more than once;
    returns the number of buckets."""
    _size(spark, "layout", history)
    n = write_history_by_object(history, output_uri, buckets)
    _log("layout", f"wrote {output_uri}: {n} buckets by object")
    return n


# ---------------------------------------------------------------- B5

def run_profile(spark: SparkSession, rows: DataFrame, n_preview: int = 5, n_keys: int = 20) -> dict:
    """Row counts per type, a preview and the most common tag keys per type."""
    ensure_job_settings(spark)
    counts = {r["type"]: r["n"] for r in rows.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()}
    _log("profile", f"rows per type: {counts}")
    R.preview(rows, n_preview).show(truncate=60)
    R.tag_key_frequency(rows, n_keys).orderBy("type", "rank").show(2 * n_keys, truncate=False)
    return counts


# ---------------------------------------------------------------- CLI

def _history(spark: SparkSession, uri: str, fmt: str) -> DataFrame:
    if fmt != "by-object":
        return read_history(spark, uri, fmt)
    spark.conf.set(JOIN_BY_BUCKET, "false")
    return read_history_by_object(spark, uri)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="strata.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    x = sub.add_parser("extract")
    x.add_argument("--history_uri", required=True)
    x.add_argument("--rules_uri", required=True)
    x.add_argument("--output_uri", required=True)
    x.add_argument("--sample_rate", type=float, default=1.0)
    x.add_argument("--format", default="orc", choices=["orc", "parquet", "by-object"])
    x.add_argument("--review_rows", type=int, default=0)
    x.add_argument("--deletion_changeset", action="store_true")
    x.add_argument("--dedupe", action="store_true", help="keep one row of a version stored twice")
    x.add_argument("--crop_ways", action="store_true", help="a bbox keeps the ways that meet it")
    x.add_argument("--review_strata", type=int, default=0, help="rows of each type for manual review")
    e = sub.add_parser("enrich")
    e.add_argument("--candidates_uri", required=True)
    e.add_argument("--changesets_uri", required=True)
    e.add_argument("--output_uri", required=True)
    e.add_argument("--format", default="orc", choices=["orc", "parquet"])
    a = sub.add_parser("enrich-all")
    a.add_argument("--input", required=True)
    a.add_argument("--changesets_uri", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--format", default="orc", choices=["orc", "parquet"])
    for job in (e, a):
        job.add_argument("--dedupe", action="store_true", help="take one row of a changeset stored twice")
        job.add_argument("--deletion", action="store_true", help="add the changeset that deleted the object")
        job.add_argument("--unicode_case", action=argparse.BooleanOptionalAction, help="fold case beyond ASCII")
    e.add_argument("--keep_by", default="comment_signal", choices=["comment_signal", "deletion_comment_signal"])
    g = sub.add_parser("export-geo")
    g.add_argument("--input", required=True)
    g.add_argument("--output_base", required=True)
    g.add_argument("--collection", action="store_true")
    g.add_argument("--archive_dates", action="store_true")
    g.add_argument("--history_uri", help="resolve the ways' lines from this history")
    g.add_argument("--way_geometries", action="store_true", help="lines broken at unknown vertices, and polygons")
    g.add_argument("--format", default="orc", choices=["orc", "parquet", "by-object"])
    g.add_argument("--space_order", action="store_true", help="GeoParquet along a Hilbert curve, with boxes of the points")
    o = sub.add_parser("layout")
    o.add_argument("--history_uri", required=True)
    o.add_argument("--output_uri", required=True)
    o.add_argument("--buckets", type=int)
    o.add_argument("--format", default="orc", choices=["orc", "parquet"])
    for job in (x, e, a, g):
        job.add_argument("--run_id", help="finished steps of a failed run under this id are not done again")
    r = sub.add_parser("profile")
    r.add_argument("--input", required=True)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"strata-{args.job}").getOrCreate()
    ensure_job_settings(spark)
    if args.job == "extract":
        run_extract(spark, _history(spark, args.history_uri, args.format),
                    load_rules(spark, args.rules_uri), args.output_uri,
                    sample_rate=args.sample_rate, dedupe=args.dedupe, review_rows=args.review_rows, deletion_changeset=args.deletion_changeset,
                    crop_ways=args.crop_ways, review_strata=args.review_strata, run_id=args.run_id)
    elif args.job == "enrich":
        run_enrich(spark, read_candidates(spark, args.candidates_uri),
                   read_changesets(spark, args.changesets_uri, args.format), args.output_uri, dedupe=args.dedupe,
                   unicode_case=args.unicode_case, deletion=args.deletion, keep_by=args.keep_by, run_id=args.run_id)
    elif args.job == "enrich-all":
        run_enrich_keep_all(spark, read_candidates(spark, args.input, types=["node", "way"]),
                            read_changesets(spark, args.changesets_uri, args.format), args.output, dedupe=args.dedupe,
                            unicode_case=args.unicode_case, deletion=args.deletion, run_id=args.run_id)
    elif args.job == "export-geo":
        run_export_geo(spark, read_candidates(spark, args.input, types=["node", "way"]),
                       args.output_base, collection=args.collection, archive_dates=args.archive_dates, way_geometries=args.way_geometries,
                       space_order=args.space_order, run_id=args.run_id,
                       history=_history(spark, args.history_uri, args.format) if args.history_uri else None)
    elif args.job == "layout":
        run_layout(spark, read_history(spark, args.history_uri, args.format), args.output_uri, args.buckets)
    elif args.job == "profile":
        run_profile(spark, read_candidates(spark, args.input, types=["node", "way"]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
