"""Declared table schemas and load-time validation.

The history and changeset tables are read with a declared schema instead of
trusting file footers, so a missing or retyped column fails at load with a
message naming it rather than deep inside a plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NODE_REF = T.StructType([T.StructField("ref", T.LongType())])
TAG_MAP = T.MapType(T.StringType(), T.StringType())

HISTORY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("version", T.LongType()),
    T.StructField("visible", T.BooleanType()),
    T.StructField("uid", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("changeset", T.LongType()),
    T.StructField("tags", TAG_MAP),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("nds", T.ArrayType(NODE_REF)),
])

CHANGESETS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("tags", TAG_MAP),
])

# Output of the extract job, in its fixed column order.
CANDIDATE_COLUMNS = [
    "type", "id",
    "num_versions", "distinct_users",
    "created_at", "last_edit_at", "deleted_at",
    "lifetime_days", "age_at_deletion_days",
    "creator_uid", "last_uid",
    "last_changeset", "last_good_version",
    "last_lat", "last_lon", "last_nds",
    "good_tags",
]

_CANDIDATE_TYPES = {
    "type": T.StringType(), "created_at": T.TimestampType(), "last_edit_at": T.TimestampType(),
    "deleted_at": T.TimestampType(), "lifetime_days": T.IntegerType(),
    "age_at_deletion_days": T.IntegerType(), "last_lat": T.DoubleType(), "last_lon": T.DoubleType(),
    "last_nds": T.ArrayType(NODE_REF), "good_tags": TAG_MAP,
}
CANDIDATES = T.StructType([T.StructField(c, _CANDIDATE_TYPES.get(c, T.LongType())) for c in CANDIDATE_COLUMNS])

CHANGESET_COLUMNS = ["cs_user", "cs_uid", "cs_comment", "cs_created_by", "cs_source"]
ENRICHED_COLUMNS = CANDIDATE_COLUMNS + CHANGESET_COLUMNS + ["comment_signal"]
ENRICHED = T.StructType(CANDIDATES.fields + [
    T.StructField(c, T.LongType() if c == "cs_uid" else T.StringType()) for c in CHANGESET_COLUMNS + ["comment_signal"]])

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_TIMESTAMP = (T.TimestampType, T.TimestampNTZType)


class SchemaError(ValueError):
    pass


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    if isinstance(expected, _TIMESTAMP):
        return isinstance(actual, _TIMESTAMP)
    if isinstance(expected, (T.LongType, T.DoubleType)):
        return isinstance(actual, _NUMERIC)
    if isinstance(expected, T.ArrayType):
        return isinstance(actual, T.ArrayType)
    if isinstance(expected, T.MapType):
        # a list of {key, value} structs is accepted too (normalised later)
        return isinstance(actual, (T.MapType, T.ArrayType))
    return type(expected) is type(actual)


def validate(df: DataFrame, schema: T.StructType, name: str,
             required: list[str] | None = None) -> DataFrame:
    """Check that ``df`` carries the columns of ``schema`` with usable types.

    ``required`` limits the check to the named columns (a job that never
    touches ``nds`` should not demand it). Returns ``df`` unchanged.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    wanted = required if required is not None else schema.fieldNames()
    problems = []
    for col in wanted:
        exp = schema[col].dataType
        if col not in fields:
            problems.append(f"missing column `{col}` ({exp.simpleString()})")
        elif not _compatible(exp, fields[col]):
            problems.append(f"column `{col}` is {fields[col].simpleString()}, "
                            f"expected {exp.simpleString()}")
    if problems:
        raise SchemaError(f"{name}: " + "; ".join(problems))
    return df
