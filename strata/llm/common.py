"""What several operators share: scratch tables, word and window hashes,
Arrow batch plumbing, distributed ranks and connected components.

Words are ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split()`` yields on
UTF-8 text (no byte of a multi-byte character is ASCII white space).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.scratch import Scratch

#: Rows and bytes of one Arrow batch handed to a Python worker: documents can
#: be 100 KB each, so the default of 10,000 rows would be up to 1 GB.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    with contextlib.suppress(Exception):  # a setting that older versions lack
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def map_rows(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str, rows: int = 100_000) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns the columns of a batch (as a dict of
    Arrow arrays) into dicts of equally long columns; output batches hold
    about ``rows`` rows at most."""
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(kinds)

    def run(batches):
        for batch in batches:
            for cols in fn({n: batch.column(i) for i, n in enumerate(batch.schema.names)}):
                out = pa.RecordBatch.from_arrays(
                    [x if isinstance(x := cols[f.name], pa.Array) else pa.array(x, type=f.type) for f in arrow], schema=arrow)
                for at in range(0, out.num_rows, rows):
                    yield out.slice(at, rows)

    return df.mapInArrow(run, kinds)


# ---------------------------------------------------------------- hashes
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Windows:
    """Hash of any window ``[start, end)`` of a word sequence in constant time
    (prefix sums of a polynomial modulo 2**64)."""

    def __init__(self, hashes: np.ndarray):
        self.power, self.inverse = _powers_to(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.power[:-1], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def second(hashes: np.ndarray) -> np.ndarray:
    """A second word hash; with the first one, windows get 128 bits."""
    return mix(hashes ^ np.uint64(0xD6E8FEB86659FD93))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ------------------------------------------------------------- Spark helpers
def buckets_for(df: DataFrame) -> int:
    """Sub-buckets of a group that may hold most rows: as many as the session
    has shuffle partitions, which deployments size by the input."""
    return max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, keys: list[str], order: list, bucket: Column, name: str, scratch: Scratch, label: str) -> DataFrame:
    """``df`` (a table that is read again, not recomputed) with ``name``, the
    rank from 0 of each row in its group.

    A group may hold a third of all rows, so it isn't ranked by one window:
    rows are ranked in ``bucket`` (monotone in ``order`` or any hash of the
    row, if only distinct ranks matter), and each bucket starts at the number
    of rows of the buckets before it.
    """
    from pyspark.sql import Window
    rows = df.withColumn("__bucket", bucket)
    counts = rows.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    starts = scratch.save(counts.withColumn("__start", F.coalesce(F.sum("__n").over(
        Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n"), label)
    inner = rows.withColumn("__row", F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy(*order)) - 1)
    left, right = inner.alias("l"), starts.alias("r")
    same = F.lit(True)
    for k in [*keys, "__bucket"]:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, same).select(
        *[F.col(f"l.`{c}`") for c in df.columns], (F.col("r.__start") + F.col("l.__row")).cast("long").alias(name))


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: longs) as (node, root), root
    the smallest node, for every node with an edge to another one.

    Large-star and small-star steps in turn: each hangs nodes to the smallest
    one near by, with aggregates and joins only, until the links are stars.
    """
    e = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-0")
    seen, step = None, 0
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.save(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{label}-{step}l")
        large = scratch.save(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{label}-{step}s")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        step += 1
        e = scratch.save(small.distinct(), f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}", f"{label}-{step - 1}l", f"{label}-{step - 1}s")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
