"""Readers and writers for the pipeline's tables.

History and changesets are read with the declared schema columns they need
(column pruning reaches the ORC/Parquet scan). Candidate tables are written
partitioned by ``type`` and read back from the *root* with a filter on
``type``, which prunes partitions and keeps the column; reading one
``type=`` directory directly would lose it, and a missing type then simply
yields no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.tags import normalize_tags
from strata.schema import CANDIDATE_COLUMNS, CANDIDATES, CHANGESETS, HISTORY, validate


def _reader(spark: SparkSession, fmt: str):
    if fmt not in ("orc", "parquet"):
        raise ValueError(f"unsupported format {fmt!r} (orc | parquet)")
    return spark.read.format(fmt)


def read_history(spark: SparkSession, uri: str, fmt: str = "orc") -> DataFrame:
    """Version history with columns cast to the declared types."""
    df = _reader(spark, fmt).load(uri)
    validate(df, HISTORY, "history", required=["type", "id", "version", "visible",
                                               "uid", "timestamp", "changeset"])
    cols = []
    for f in HISTORY.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "tags":
            cols.append(normalize_tags(F.col("tags"), df.schema["tags"].dataType).alias("tags"))
        elif f.name == "timestamp":
            cols.append(F.col("timestamp"))  # TIMESTAMP or TIMESTAMP_NTZ, as stored
        elif f.name == "nds":
            cols.append(F.col("nds"))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_changesets(spark: SparkSession, uri: str, fmt: str = "orc") -> DataFrame:
    df = _reader(spark, fmt).load(uri)
    validate(df, CHANGESETS, "changesets")
    return df


def _hadoop(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def read_candidates(spark: SparkSession, uri: str, types: Sequence[str] | None = None,
                    schema: T.StructType = CANDIDATES) -> DataFrame:
    """Candidates (or enriched rows) written partitioned by ``type``.

    ``types`` prunes partitions; a type without a directory gives no rows.
    A root without any ``type=`` directory, which a run that kept nothing
    leaves, is an empty table of the declared ``schema``.
    """
    fs, root = _hadoop(spark, uri)
    if not any(s.getPath().getName().startswith("type=") for s in fs.listStatus(root)):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(uri)
    if types is not None:
        df = df.filter(F.col("type").isin(list(types)))
    return df


def input_roots(df: DataFrame) -> list[str]:
    """The folders and files that the plan's scans were given (not their
    contents, which a large table has millions of)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            roots += [paths.apply(k).toString() for k in range(paths.size())]
    return roots


def refuse_self_overwrite(df: DataFrame, uri: str) -> None:
    _, target = _hadoop(df.sparkSession, uri)
    target = target.toString().rstrip("/")
    for root in input_roots(df):
        source = _hadoop(df.sparkSession, root)[1].toString().rstrip("/")
        if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
            raise ValueError(f"refusing to overwrite {uri}: it is an input of this plan")


def swap_in(spark: SparkSession, staged: str, uri: str) -> None:
    """Put the finished folder ``staged`` (beside ``uri``) in the place of
    ``uri``; what was there goes only once the new folder is in its place."""
    fs, new = _hadoop(spark, staged)
    _, target = _hadoop(spark, uri)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{staged}-old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{uri} can't be moved aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{staged} can't be renamed to {uri}")
    if had:
        fs.delete(old, True)


def staged_uri(uri: str) -> str:
    """A folder beside ``uri`` for a run that may fail."""
    parent, _, name = uri.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{uuid.uuid4().hex}" if parent else f"_{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, uri: str, mode: str, partition_by: list[str]) -> None:
    """An overwrite goes beside ``uri`` and is swapped in when it is complete, so
    a run that fails leaves an older output as it was."""
    refuse_self_overwrite(df, uri)
    if mode != "overwrite":
        df.write.mode(mode).partitionBy(*partition_by).parquet(uri)
        return
    spark, staged = df.sparkSession, staged_uri(uri)
    try:
        df.write.partitionBy(*partition_by).parquet(staged)
        swap_in(spark, staged, uri)
    except BaseException:
        fs, path = _hadoop(spark, staged)
        fs.delete(path, True)
        raise


def write_candidates(df: DataFrame, uri: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by ``type`` (an overwrite replaces every
    ``type=`` directory, as the reference job does)."""
    _write(df, uri, mode, ["type"])


def write_parquet(df: DataFrame, uri: str, mode: str = "overwrite") -> None:
    """Unpartitioned Parquet (the keep-everything enrichment output)."""
    _write(df, uri, mode, [])


def candidate_columns(df: DataFrame) -> list[str]:
    return [c for c in CANDIDATE_COLUMNS if c in df.columns]
