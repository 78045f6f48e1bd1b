"""Line deduplication within an edit of one word (operator 8, DataFrame functions only).

*Deletion neighbourhood*: two lines are at most one word edit apart exactly
when they share a variant: the same line, the same rest after leaving out the
word at the same place (a changed word), or one line's rest and the other line
(an added word). Every line emits its variants as hashed keys, equal keys meet
in an aggregate that keeps the earliest line, and the edit distance to that
line is verified on the words.

Two lines one edit apart agree in their first or in their second half, so only
lines that share a half with another line emit variants; that leaves no pair out.
No pairs are formed: each key keeps its earliest line, each line gets the
earliest of its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch
from strata.llm.quality import words_of

#: Every line with a word is compared; lines from FUZZY words on also match with
#: one edit: one word of five is a similarity of 0.8, as near duplicates have it.
LEAST, FUZZY = 1, 5


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, copy, line, words, n) of the lines that are compared."""
    text = F.col("text").cast("string")
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("copy"), F.split(text, "\n").alias("lines"))
    # The outer generators here and below spare the filter on a non-empty array
    # that the optimizer puts under a plain one, which would compute the array again.
    rows = rows.select("doc", "copy", F.posexplode_outer("lines").alias("line", "__text")).where("line is not null")
    # Words come out of a generator, so that filters on them stay above it.
    rows = rows.select("doc", "copy", "line", F.inline(F.array(F.struct(words_of(F.col("__text")).alias("words")))))
    return rows.withColumn("n", F.size("words"))


def _halves() -> list[Column]:
    """Keys of the halves that a line may share with one of as many words, or
    one more or one fewer."""
    def keys(n):
        half = F.floor(n / 2).cast("int")
        return [F.xxhash64(F.lit(1), half, F.slice("words", F.lit(1), half)),
                F.xxhash64(F.lit(2), n - half, F.slice("words", F.col("n") - (n - half) + 1, n - half))]
    return keys(F.col("n")) + keys(F.col("n") - 1)


#: Words of a line that are scanned in one go.
BLOCK = 64


def _running(values: Column, start: Column) -> Column:
    return F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))


def _scan(values: Column) -> Column:
    """The running XOR of an array, beginning with 0, one longer than it.

    Every step copies what it has so far; long arrays are therefore scanned
    block by block from the running XOR of the blocks, which leaves one copy of
    a number per block in place of one per word."""
    zero = F.lit(0).cast("long")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))
    total = lambda block: F.aggregate(block, zero, lambda acc, x: acc.bitwiseXOR(x))
    starts = _running(F.transform(blocks, total), zero)
    parts = F.zip_with(blocks, starts, lambda block, start: F.when(block.isNotNull(), F.slice(_running(block, start), F.lit(2), F.lit(BLOCK))))
    return F.when(F.size(values) <= BLOCK, _running(values, zero)).otherwise(F.concat(F.array(zero), F.flatten(F.filter(parts, lambda p: p.isNotNull()))))


def variants(lines: DataFrame) -> DataFrame:
    """(v, size, place, k1, k2, first) of lines (k1, k2, first, words): the hash
    of the rest after leaving out the word at ``place``, and of the whole line
    (place -1); ``size`` words are left.

    A line's hash is the XOR of its words' hashes with their places, so that
    running XORs from both ends give all rests in one pass.
    """
    rows = lines.withColumn("__at", F.transform("words", lambda w, i: F.xxhash64(w, i))).withColumn("__before", F.transform("words", lambda w, i: F.xxhash64(w, i - 1)))
    rows = rows.select("k1", "k2", "first", F.size("words").alias("n"), _scan(F.col("__at")).alias("left"), _scan(F.col("__before")).alias("right"))
    whole = F.element_at("left", -1)
    ends = F.element_at("right", -1)
    after = F.slice("right", F.lit(2), F.col("n"))
    rests = F.transform(F.arrays_zip(F.slice("left", F.lit(1), F.col("n")).alias("l"), after.alias("r")),
                        lambda x, i: F.struct(x["l"].bitwiseXOR(x["r"]).alias("x"), i.alias("place"), F.lit(-1).alias("size")))
    rows = rows.select("k1", "k2", "first", "n", ends.alias("ends"), F.explode_outer(F.concat(rests, F.array(F.struct(whole.alias("x"), F.lit(-1).alias("place"), F.lit(0).alias("size"))))).alias("r"))
    v = F.when(F.col("r.place") < 0, F.col("r.x")).otherwise(F.col("r.x").bitwiseXOR(F.col("ends")))
    return rows.select(v.alias("v"), (F.col("n") + F.col("r.size")).alias("size"), F.col("r.place").alias("place"), "k1", "k2", "first")


def _one_edit(a: Column, b: Column) -> Column:
    """If the word arrays are at most one edit apart: left out of the longer
    one, or changed in both, is the word after their common beginning."""
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    same = F.zip_with(longer, shorter, lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False).cast("int")  # from 1; 0: none differs
    rest = F.slice(longer, at + 1, F.size(longer))
    other = F.when(F.size(longer) == F.size(shorter), F.slice(shorter, at + 1, F.size(longer))).otherwise(F.slice(shorter, F.greatest(at, F.lit(1)), F.size(longer)))
    return (F.size(longer) - F.size(shorter) <= 1) & ((at == 0) | (rest == other))


def earlier_lines(docs: DataFrame, scratch: Scratch, least: int = LEAST, fuzzy: int = FUZZY) -> DataFrame:
    """(doc, copy, line) of every line with an earlier one at most an edit away."""
    key = [F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(3), "words").alias("k2")]
    halves = [F.when(F.col("n") >= fuzzy, h).alias(f"h{i}") for i, h in enumerate(_halves())]
    found = scratch.save(_lines(docs).where(F.col("n") >= least).select("doc", "copy", "line", *key, *halves), "lines")
    distinct = found.groupBy("k1", "k2").agg(F.min(F.struct("doc", "line", "copy")).alias("f"), F.count("*").alias("copies"), *[F.first(f"h{i}").alias(f"h{i}") for i in range(len(halves))])
    distinct = scratch.save(distinct.select("k1", "k2", F.struct("f.doc", "f.line").alias("first"), F.col("f.copy").alias("copy"), "copies", *[f"h{i}" for i in range(len(halves))]), "distinct")

    each = F.array_distinct(F.array(*[F.col(f"h{i}") for i in range(len(halves))]))
    one = distinct.where("h0 is not null").select("k1", "k2", F.explode_outer(each).alias("half"))
    shared = scratch.save(one.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).where("a <> b").select("half"), "shared")
    keys = scratch.save(one.join(shared, "half", "left_semi").select("k1", "k2").distinct(), "keys")
    # Nothing below reads the halves: both tables go on without them, before the texts are shuffled.
    found = scratch.save(found.select("doc", "copy", "line", "k1", "k2"), "places")
    distinct = scratch.save(distinct.select("k1", "k2", "first", "copy", "copies"), "unique")
    scratch.drop("shared", "lines", "distinct")
    chosen = distinct.join(keys, ["k1", "k2"]).select(F.col("first.doc").alias("doc"), "copy", F.struct(F.col("first.line").alias("line"), "k1", "k2", "first").alias("c"))
    chosen = scratch.save(chosen.groupBy("doc", "copy").agg(F.collect_list("c").alias("chosen")), "chosen")
    text = F.col("text").cast("string")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("copy"), text.alias("text"))
    picked = texts.join(chosen, ["doc", "copy"]).select("chosen", F.split("text", "\n").alias("lines"))
    # The lines are read twice below, which keeps their array a column of its own.
    there = F.filter("chosen", lambda c: c["line"] < F.size("lines"))
    picked = picked.select(F.explode_outer(F.transform(there, lambda c: F.struct(c["k1"].alias("k1"), c["k2"].alias("k2"), c["first"].alias("first"), F.element_at("lines", c["line"] + 1).alias("line")))).alias("c")).where("c is not null")
    lines = picked.select("c.k1", "c.k2", "c.first", words_of(F.col("c.line")).alias("words"))
    lines = scratch.save(lines.dropDuplicates(["k1", "k2"]), "words")
    scratch.drop("keys", "chosen")

    rows = scratch.save(variants(lines), "variants")
    meets = rows.groupBy("v", "size").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).where("a <> b").select("v", "size")
    near = scratch.save(rows.join(scratch.save(meets, "meets"), ["v", "size"], "left_semi"), "near")
    scratch.drop("variants")
    whole = F.when(F.col("place") < 0, F.col("first"))
    rest = F.when(F.col("place") >= 0, F.col("first"))
    sides = scratch.save(near.groupBy("v", "size").agg(F.min(whole).alias("whole"), F.min(rest).alias("rest")), "sides")
    same = scratch.save(near.groupBy("v", "size", "place").agg(F.min("first").alias("same")), "same")
    partner = F.when(F.col("place") < 0, F.col("rest")).otherwise(F.least("same", "whole"))
    best = near.join(same, ["v", "size", "place"]).join(sides, ["v", "size"]).withColumn("partner", partner).where("partner < first")
    best = scratch.save(best.groupBy("k1", "k2").agg(F.min("partner").alias("partner")), "partners")
    mine = best.join(lines.select("k1", "k2", F.col("words").alias("a")), ["k1", "k2"])
    pairs = mine.join(lines.select(F.col("first").alias("partner"), F.col("words").alias("b")), "partner")
    proved = scratch.save(pairs.where(_one_edit(F.col("a"), F.col("b"))).groupBy("k1", "k2").agg(F.min("partner").alias("partner")), "proved")

    cut = distinct.join(proved, ["k1", "k2"], "left").where("copies > 1 or partner is not null")
    cut = scratch.save(cut.select("k1", "k2", F.least("first", "partner").alias("earliest")), "cut")
    return found.join(cut, ["k1", "k2"]).where(F.col("earliest") < F.struct("doc", "line")).select("doc", "copy", "line").distinct()


def remove_lines(docs: DataFrame, least: int = LEAST, fuzzy: int = FUZZY) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_removed`` added.

    A line goes if an earlier line, by (doc_id, place), has the same words, or
    from ``fuzzy`` words on differs by one word left out, added or changed.
    Lines of fewer than ``least`` words stay. Lines are judged on the input:
    one also goes when its earlier line goes. Null and empty texts stay (null:
    no lines). Rows with a null doc_id stay whole and are no one's earlier
    line; rows that repeat a doc_id and a text share their verdicts. Columns
    that ``docs`` has under these names are replaced.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    gone = earlier_lines(docs, scratch, least, fuzzy).groupBy("doc", "copy").agg(F.sort_array(F.collect_list("line")).alias("gone"))
    gone = scratch.save(gone.select(F.col("doc").alias("__doc"), F.col("copy").alias("__copy"), F.col("gone").alias("__gone")), "gone")
    scratch.keep("gone")
    kept = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_removed")]
    text = F.col("text").cast("string")
    rows = docs.select(*kept, F.col("doc_id").cast("long").alias("__doc"), F.xxhash64(text).alias("__copy"))
    none = F.array().cast("array<int>")
    rows = rows.join(gone, ["__doc", "__copy"], "left").withColumn("__gone", F.coalesce("__gone", none)).withColumn("__lines", F.split(text, "\n"))
    # The lines between two removed ones, for all neighbours in the list.
    parts = F.zip_with(F.concat(F.array(F.lit(-1)), F.col("__gone")), F.concat(F.col("__gone"), F.array(F.size("__lines"))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    left = F.flatten(F.transform(parts, lambda p: F.slice("__lines", p["a"] + 2, F.greatest(p["b"] - p["a"] - 1, F.lit(0)))))
    return rows.select(*kept, F.when(F.size("__gone") == 0, text).otherwise(F.array_join(left, "\n")).alias("kept_text"),
                       F.greatest(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"), F.size("__gone").cast("long").alias("n_removed"))


SQL = r"""
with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
o as (select doc_id, unnest(range(len(ls))) as i, ls from d where text is not null),
l as (select doc_id, i, list_filter(string_split_regex(ls[i + 1], '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from o),
c as (select doc_id, i, w, {'d': doc_id, 'i': i} as place, array_to_string(w, ' ') as t, len(w) as n from l where len(w) >= 1),
e as (select t, any_value(w) as w, any_value(n) as n, min(place) as place from c group by t),
v as (select t, n, place, p, array_to_string(list_concat(w[1:p], w[p + 2:n]), ' ') as r from (select *, unnest(range(n)) as p from e where n >= 5)),
m as (
  select t, min(low) as low from (
    select t, min(place) over (partition by r, p, n) as low from v
    union all select v.t, e.place from v join e on e.t = v.r and e.n >= 5
    union all select e.t, v.place from v join e on e.t = v.r and e.n >= 5
    union all select t, place from e) group by t),
g as (select c.doc_id, c.i from c join m using (t) where m.low < c.place),
k as (select o.doc_id, o.i, o.ls[o.i + 1] as line, g.doc_id is not null as gone from o left join g on o.doc_id = g.doc_id and o.i = g.i),
s as (select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_removed,
  coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as kept from k group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join s using (doc_id)
"""
