import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The whole small documents table as a list of (doc_id, text)."""
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and very long texts, ties, repeated rows, shared passages
    and near copies, as a list of (doc_id, text)."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage, line = text(200), text(60), text(12)
    near = base.split()
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, base), (7, base), (7, base), (None, base), (None, None)]
    for i in range(12):  # near copies with another word each
        words = list(near)
        words[15 * i + 3] = f"edit{i}"
        rows.append((10 + i, " ".join(words)))
    rows += [(30 + i, f"{text(30 + i)}\n{passage} {text(20)}") for i in range(8)]  # a shared passage
    rows += [(40 + i, f"{line}\n{text(40)}\n{line}\n\n{text(9)}") for i in range(6)]  # a common line
    rows += [(50, "la " * 3000), (51, "la " * 2000), (52, text(9000)), (53, "x" * 30000), (54, "é ß   ñ <|endoftext|> 日本 語"), (55, f"{passage}\r\n{passage}")]
    rows += [(60, base + " " + text(20)), (61, text(20) + " " + base), (60, text(70))]
    return rows


@pytest.fixture()
def table(spark):
    """Rows of (doc_id, text) as a documents table with clashing extra columns."""
    def make(rows):
        df = spark.createDataFrame([(i, t, "en", "s0", len(t) if t else None) for i, t in rows], SCHEMA)
        for name in ("doc", "pos", "n", "m", "node", "size", "length", "kept_text", "words", "rank", "links", "line", "key"):
            df = df.withColumn(name, F.lit("extra"))
        return df.repartition(3)
    return make
