"""Quality rules as a short-circuit cascade (operator 7, DataFrame functions only).

Each rule's cost and selectivity are estimated on a sample, and the rules are
asked in the order of rejections per cost: a document that one rejects is not
shown to the rest. The order changes what is computed, never the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Documents whose costs and verdicts are sampled.
SAMPLE = 2000
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    text = F.coalesce(text, F.lit(""))
    for c in SPACE[1:]:  # a byte search each, where translate makes a string of every character
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns FEATURES; texts are whole, null has no words."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    has_word = lambda x: F.translate(x, SPACE, "") != ""
    rows = docs.drop(*FEATURES).withColumn("__text", F.col("text").cast("string"))
    rows = rows.withColumn("__words", words_of(F.col("__text"))).withColumn("__lines", F.filter(F.split(text, "\n"), has_word))
    n = F.size("__words")
    # Equal 3-word windows come next to each other in the sorted (hash, place)
    # pairs. The arrays that follow are columns of their own and are each read
    # twice, so that no lambda computes one anew for every element.
    rows = rows.withColumn("__w2", F.slice("__words", F.lit(2), F.greatest(n - 1, F.lit(0)))).withColumn("__w3", F.slice("__words", F.lit(3), F.greatest(n - 2, F.lit(0))))
    grams = F.slice(F.transform(F.arrays_zip(F.col("__words").alias("a"), F.col("__w2").alias("b"), F.col("__w3").alias("c")),
                                lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i"))), F.lit(1), F.greatest(n - 2, F.lit(0)))
    rows = rows.withColumn("__grams", F.sort_array(grams))
    after = F.concat(F.slice("__grams", F.lit(2), F.greatest(F.size("__grams") - 1, F.lit(0))), F.array(F.lit(None)))
    place = lambda x: [x["i"], x["i"] + 1, x["i"] + 2]
    twice = F.zip_with("__grams", after, lambda x, y: F.when(x["h"] == y["h"], F.array(*place(x), *place(y))).otherwise(F.array().cast("array<int>")))
    repeat = F.when(n < 3, 0).otherwise(F.size(F.array_distinct(F.flatten(twice))))
    # A generator at the end: a filter on what follows from the features stays
    # above it and is not pushed below, where it would compute them once more.
    return rows.select(*docs.drop(*FEATURES).columns, F.inline(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words")))))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The rules' rejections. Symbols: more than one for ten words. Word length:
    on average below 2 or above 15 characters. Capitals: more than 3 of 10
    characters. Shouting: more than one ! or ? for ten words. Lines: more than
    one repeated line for twenty words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    return {
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
        "capitals": 10 * left(r"\p{Lu}") > 3 * F.col("word_chars"),
        "shouting": 10 * (F.length(text) - F.length(F.translate(text, "!?", ""))) > F.col("n_words"),
        "lines": 20 * F.col("n_dup_lines") > F.col("n_words"),
    }


def order_rules(docs: DataFrame, checks: dict[str, Column], sample: int = SAMPLE) -> list[str]:
    """The names of ``checks`` by rejections per cost on about ``sample`` rows
    of ``docs`` (with features), the best first."""
    total = docs.count()
    if not total:
        return list(checks)
    few = features(docs.sample(min(1.0, sample / total), seed=7)).select("text", *FEATURES).persist()
    try:
        seen = max(1, few.count())

        def cost(check: Column) -> tuple[float, int]:
            took = []
            for _ in range(2):
                began = time.perf_counter()
                hits = few.agg(F.count_if(check)).first()[0]
                took.append(time.perf_counter() - began)
            return min(took), hits

        floor = cost(F.lit(False))[0]
        rate = {}
        for name, check in checks.items():
            seconds, hits = cost(check)
            rate[name] = (hits + 0.5) / seen / max(seconds - floor, 1e-3)
    finally:
        few.unpersist()
    return sorted(checks, key=rate.get, reverse=True)


def judge(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with FEATURES, base_failed and kept added.

    kept is false where base_failed is (fewer than 50 words, or more than half
    of them in 3-word windows found twice in the text), else unless a rule of
    the cascade rejects. Null and empty texts have no words and fail. Columns
    of ``docs`` under these names are replaced.
    """
    checks = rules()
    docs = docs.drop("base_failed", "kept")
    verdict = F.when(F.col("base_failed"), False)
    for name in order_rules(docs, checks, sample):
        verdict = verdict.when(checks[name], False)
    return features(docs).withColumn("base_failed", base_failed()).withColumn("kept", verdict.otherwise(True))


SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (select rid, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
u as (select rid, unnest(range(len(ws))) as i, unnest(ws) as a from w),
g as (select rid, i, a, lead(a, 1) over o as b, lead(a, 2) over o as c from u window o as (partition by rid order by i)),
h as (select rid, i, count(*) over (partition by rid, a, b, c) as c from g where c is not null),
p as (select rid, count(distinct i + o) as n from h, (values (0), (1), (2)) t(o) where c > 1 group by rid),
l as (select rid, count(*) - count(distinct line) as n from (select rid, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
f as (select d.doc_id, d.text, len(ws)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(p.n, 0)::bigint as n_repeat_words
  from d join w using (rid) left join p using (rid) left join l using (rid)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 15 * n_words
    or 10 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 3 * word_chars
    or 10 * length(regexp_replace(text, '[^!?]', '', 'g')) > n_words or 20 * n_dup_lines > n_words) as kept
from b
"""
