"""Token counts kept by delta (operator 5).

Totals by source, language and tokenizer version are never counted anew: a
batch of signed changes (an insert adds a text's counts, a delete takes them
off, a revision does both) is summed to one delta for each group, and totals
are the sum of the deltas committed. A batch commits once: its delta is
written aside and renamed to its name in one step, and a name that is there
already is left alone, so a batch that is sent again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_rows
from strata.llm.quality import SPACE
from strata.llm.tokens import ByteBpe

GROUP = ["source", "lang", "tokenizer"]
COUNTS = ["n_docs", "n_chars", "n_tokens"]
DELTA = "source string, lang string, tokenizer string, n_docs long, n_chars long, n_tokens long"


class Rollup:
    """Totals in a folder that Spark reaches: one table of deltas per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch: str) -> bool:
        path, fs = self._path(f"batch={batch}")
        return fs.exists(path)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit ``changes`` (GROUP, COUNTS and ``sign``, 1 or -1) as
        ``batch``; false, and nothing done, if it was committed before."""
        if self.committed(batch):
            return False
        delta = changes.groupBy(*GROUP).agg(*[F.sum(F.col("sign") * F.col(c)).cast("long").alias(c) for c in COUNTS])
        delta.where(" or ".join(f"{c} <> 0" for c in COUNTS)).write.mode("overwrite").parquet(f"{self.folder}/_aside-{batch}")
        aside, fs = self._path(f"_aside-{batch}")
        final, _ = self._path(f"batch={batch}")
        if not fs.rename(aside, final) and not fs.exists(final):
            raise OSError(f"batch {batch} can't be committed to {self.folder}")
        return True

    def totals(self) -> DataFrame:
        """GROUP and COUNTS over all batches; groups without a document go."""
        deltas = self.spark.read.schema(DELTA).option("basePath", self.folder).parquet(f"{self.folder}/batch=*")
        sums = deltas.groupBy(*GROUP).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])
        return sums.where(" or ".join(f"{c} <> 0" for c in COUNTS))


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The counts of every row by each tokenizer version: (doc_id, source,
    lang, copy, edited, tokenizer, COUNTS, revised COUNTS). The revised text has no
    white space at its ends. Null texts count as empty; ``copy`` is a hash of
    the text."""
    def run(cols) -> Iterator[dict]:
        bpe = ByteBpe.shared(vocabulary)
        count = lambda texts: [len(bpe.encode(t.as_py())) // 4 if t.is_valid else None for t in texts]
        tokens, again = count(cols["text"]), count(cols["new"])
        # Words are counted here: their arrays would fill an executor's heap beside its workers.
        words = [len(t.as_py().encode().split()) for t in cols["text"]]
        yield {c: cols[c] for c in kept} | dict(words=words, bpe=tokens, new_bpe=[a if b is None else b for a, b in zip(tokens, again)])

    old = F.coalesce(F.col("text").cast("string"), F.lit(""))
    new = F.btrim(old, F.lit(SPACE))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.xxhash64(old).alias("copy"), (old != new).alias("edited"), F.length(old).cast("long").alias("n_chars"), F.length(new).cast("long").alias("new_chars"),
                       old.alias("text"), F.when(old != new, new).alias("new"))
    kept = ["doc_id", "source", "lang", "copy", "edited", "n_chars", "new_chars"]
    schema = "doc_id long, source string, lang string, copy long, edited boolean, n_chars long, new_chars long, words long, bpe long, new_bpe long"
    versions = F.array(F.struct(F.lit("words-1").alias("tokenizer"), F.col("words").alias("n_tokens"), F.col("words").alias("new_tokens")),
                       F.struct(F.lit("byte-bpe-50k-1").alias("tokenizer"), F.col("bpe").alias("n_tokens"), F.col("new_bpe").alias("new_tokens")))
    return map_rows(rows, run, schema).select("doc_id", "source", "lang", "copy", "edited", F.lit(1).cast("long").alias("n_docs"), "n_chars", "new_chars", F.inline(versions))


def maintained_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token totals of ``docs`` (GROUP and COUNTS) after three batches.

    The first inserts every row. The second revises the rows whose text has
    white space at an end to the counts of the text without it. The third
    deletes the rows that repeat the text of a smaller doc_id. Then the second
    one is sent again, which changes nothing. Rows with a null doc_id are
    inserted and revised, never deleted, and rows that repeat a doc_id don't
    delete each other; null sources and languages are groups.
    """
    scratch = Scratch(docs.sparkSession, "rollups")
    rows = scratch.save(counted(docs, vocabulary), "counted")
    old = [*GROUP, *COUNTS]
    new = [*GROUP, "n_docs", F.col("new_chars").alias("n_chars"), F.col("new_tokens").alias("n_tokens")]
    edited = rows.where("edited")
    revisions = edited.select(*old, F.lit(-1).alias("sign")).unionByName(edited.select(*new, F.lit(1).alias("sign")))
    first = scratch.save(rows.groupBy("copy").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("copy", "first"), "first")
    gone = rows.join(first, "copy").where("doc_id > first")
    out = Rollup(docs.sparkSession, scratch.path("rollup"))
    out.apply("1-insert", rows.select(*old, F.lit(1).alias("sign")))
    out.apply("2-revise", revisions)
    out.apply("3-delete", gone.select(*new, F.lit(-1).alias("sign")))
    out.apply("2-revise", revisions)
    return out.totals()
