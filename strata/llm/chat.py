"""Chat formatting by quotation linking (operator 4).

A message may quote others in lines that begin with ``>``, one for each level.
Quoted passages, the consecutive lines of one level, are normalised and hashed and
linked to the messages of the same conversation that say them; so each reply
finds the message it answers, the messages fall into threads, and a conversation
is put out thread by thread, each message formatted without the quotes.

A conversation may hold a third of all messages: a passage finds its latest earlier
message on a timeline that is split between tasks, without pairs, and places in a
conversation come from a range partitioning, not from one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, buckets_for, map_rows
from strata.operators.extras import asof_fill

#: One level of quotation for each ``>`` that a line begins with.
QUOTE = r"^[ \t>]*>[ \t]?"
#: ASCII white space, which is cut off the ends of a message.
BLANK = " \t\n\x0b\f\r"
TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>")


def normalise(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[ \t-\r]+", " ")))


#: Moduli and bases of the running hash of a message's lines; products stay below 2**63.
MODULI, BASES = (2147483647, 2147483629), (1000003, 998244353)


def _by_message(fn):
    """For ``map_rows``: ``fn`` turns one row, a dict, into dicts of the rows to put out."""
    def columns(batch):
        rows = []
        for values in zip(*batch.values()):
            for row in fn(dict(zip(batch, (v.as_py() for v in values)))):
                rows.append(row)
                if len(rows) == 10_000:
                    yield {k: [r[k] for r in rows] for k in rows[0]}
                    rows = []
        if rows:
            yield {k: [r[k] for r in rows] for k in rows[0]}
    return columns


def message_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, m, levels, keys): the lines with a word of each different
    message of a turn; a line's level is 0 for its own, its key the hash of the
    normalised line."""
    def line(raw):
        head = F.regexp_extract(raw, QUOTE, 0)
        return F.struct((F.length(head) - F.length(F.translate(head, ">", ""))).alias("level"), normalise(F.regexp_replace(raw, QUOTE, "")).alias("line"))

    rows = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", "text").distinct()
    rows = rows.select("conv_id", "turn", F.xxhash64("text").alias("m"), F.transform(F.split("text", "\n"), line).alias("lines"))
    rows = rows.withColumn("lines", F.filter("lines", lambda x: x["line"] != ""))
    return rows.select("conv_id", "turn", "m", F.transform("lines", lambda x: x["level"]).alias("levels"), F.transform("lines", lambda x: F.xxhash64(x["line"])).alias("keys"))


def quoted_passages(lines: DataFrame) -> DataFrame:
    """Consecutive lines of one quote level: conv_id, turn, m, level, run (place of the
    first line), first (its key), size, h1 and h2 (hash of the passage), b1 and b2
    (the bases to the power of size) and the lines' keys."""
    def cut(row):
        levels, keys, at = row["levels"], row["keys"], 0
        while at < len(levels):
            end = at
            while end < len(levels) and levels[end] == levels[at]:
                end += 1
            if levels[at]:
                out = {k: row[k] for k in ("conv_id", "turn", "m")} | {"level": levels[at], "run": at, "first": keys[at], "size": end - at, "keys": keys[at:end]}
                for i, (base, modulus) in enumerate(zip(BASES, MODULI), 1):
                    value = 0
                    for key in keys[at:end]:
                        value = (value * base + key) % modulus
                    out |= {f"h{i}": value, f"b{i}": pow(base, end - at, modulus)}
                yield out
            at = end

    return map_rows(lines.where(F.exists("levels", lambda x: x > 0)), _by_message(cut), "conv_id long, turn long, m long, level int, run int, first long, size int, h1 long, h2 long, b1 long, b2 long, keys array<long>")


def own_lines(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, m, pos, key, h1, h2): a message's own lines with the hash of
    those before them, and a last row (null key) with the hash of all."""
    def run(row):
        own = [k for k, level in zip(row["keys"], row["levels"]) if not level]
        values = [0, 0]
        for pos, key in enumerate([*own, None]):
            yield {k: row[k] for k in ("conv_id", "turn", "m")} | {"pos": pos, "key": key, "h1": values[0], "h2": values[1]}
            if key is not None:
                values = [(v * base + key) % modulus for v, base, modulus in zip(values, BASES, MODULI)]

    return map_rows(lines, _by_message(run), "conv_id long, turn long, m long, pos int, key long, h1 long, h2 long")


def _latest_before(asked: DataFrame, said: DataFrame, key: list[str], scratch: Scratch) -> DataFrame:
    """``asked`` with ``said``, the latest turn before its own in which ``said`` has its
    key, or null. One timeline per key, split where a key is hot."""
    order = ["turn", "kind", "m", "run", "i"]
    name = F.concat_ws(" ", *key).alias("k")
    said = said.join(asked.select(*key).distinct(), key, "left_semi").select(*key, "turn").distinct()
    rest = [c for c in asked.columns if c not in (*order, "k")]
    ask = asked.select(name, "turn", F.lit(0).alias("kind"), "m", "run", "i", F.struct(*rest).alias("ask"), F.lit(None).cast("long").alias("state"))
    say = said.select(name, "turn", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("m"), F.lit(0).alias("run"), F.lit(0).alias("i"),
                      F.lit(None).cast(ask.schema["ask"].dataType).alias("ask"), F.col("turn").alias("state"))
    filled = asof_fill(ask.unionByName(say), "k", order, "state", scratch=scratch)
    return filled.where("kind = 0").select("turn", "m", "run", "i", "ask.*", F.col("asof").alias("said"))


def links(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, reply_to).

    A quoted passage (consecutive lines of one level; blank lines do not count) belongs to
    the latest earlier message that has it as a run of its own lines; only where none has, each of
    its lines belongs to the latest earlier message that says it. Of the
    lowest quote level with such a message, the one to which most lines belong
    is answered, the later one of equals.
    """
    lines = scratch.save(message_lines(messages), "lines")
    asked = scratch.save(quoted_passages(lines), "passages")
    # Only conversations with quotes, and in them only runs that begin as a passage does and are as long.
    own = scratch.save(own_lines(lines.join(asked.select("conv_id").distinct(), "conv_id", "left_semi")), "own")
    wanted = asked.select("conv_id", F.col("first").alias("key"), "size", "b1", "b2").distinct()
    begins = own.join(wanted, ["conv_id", "key"]).select("conv_id", "turn", "m", (F.col("pos") + F.col("size")).alias("pos"), "size", *[F.col(f"h{i}").alias(f"g{i}") for i in (1, 2)], "b1", "b2")
    runs = begins.join(own.select("conv_id", "turn", "m", "pos", "h1", "h2"), ["conv_id", "turn", "m", "pos"])
    runs = runs.select("conv_id", "turn", "size", *[F.pmod(F.col(f"h{i}") - F.col(f"g{i}") * F.col(f"b{i}"), F.lit(n)).alias(f"h{i}") for i, n in enumerate(MODULI, 1)])
    whole = _latest_before(asked.select("conv_id", "turn", "m", "level", "run", F.lit(0).alias("i"), "size", "h1", "h2", "keys"), runs,
                           ["conv_id", "size", "h1", "h2"], Scratch(messages.sparkSession, "chat-passages"))
    whole = scratch.save(whole, "whole")
    single = whole.where("said is null").select("conv_id", "turn", "m", "level", "run", F.posexplode("keys").alias("i", "key"))
    single = _latest_before(single, own.where("key is not null"), ["conv_id", "key"], Scratch(messages.sparkSession, "chat-lines"))
    votes = whole.select("conv_id", "turn", "level", "said", "size").unionByName(single.select("conv_id", "turn", "level", "said", F.lit(1).alias("size")))
    votes = votes.where("said is not null").groupBy("conv_id", "turn", "level", "said").agg(F.sum("size").alias("votes"))
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "votes", "said")).alias("best"))
    return scratch.save(best.select("conv_id", "turn", F.col("best.said").alias("reply_to")), "links")


def threads(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, thread): the first message that links lead to. Every
    round doubles the length of the links, and a link leads to an earlier turn."""
    now, step = found.withColumnRenamed("reply_to", "thread"), 0
    while True:
        further = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        joined = scratch.save(now.join(further, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"), F.col("next").isNotNull().alias("moved")), f"threads{step}")
        now, step = joined.drop("moved"), step + 1
        if joined.where("moved").isEmpty():
            return now


def _placed(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``position``, from 0 in each conversation, by thread, turn
    and then the message itself."""
    order = ["conv_id", "thread", "turn", "role", "body"]
    kinds = rows.schema.add("__part", "integer").add("__at", "long")

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, conv, at = TaskContext.get().partitionId(), object(), 0
        for b in batches:
            places = []
            for c in b.column(b.schema.get_field_index("conv_id")).to_pylist():
                at = at + 1 if c == conv else 0
                conv = c
                places.append(at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(places, pa.int64())], names=[*b.schema.names, "__part", "__at"])

    dealt = rows.repartitionByRange(buckets_for(rows), *order).sortWithinPartitions(*order).mapInArrow(number, kinds)
    dealt = scratch.save(dealt, "placed")
    from pyspark.sql import Window
    counts = dealt.groupBy("conv_id", "__part").agg(F.count("*").alias("n"))
    split = counts.groupBy("conv_id").agg(F.collect_list(F.struct("__part", "n")).alias("parts")).where(F.size("parts") > 1)
    split = split.select("conv_id", F.inline("parts")).withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    # Ranges are contiguous: two neighbours share one conversation at most, so
    # these are fewer rows than twice the partitions, and can be broadcast.
    split = scratch.save(split.where("before is not null").select(F.col("conv_id").alias("__conv"), F.col("__part").alias("__of"), "before"), "split")
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__part") == F.col("__of"))
    return dealt.join(F.broadcast(split), same, "left").select(*rows.columns, (F.col("__at") + F.coalesce("before", F.lit(0))).cast("long").alias("position"))


def format_chats(messages: DataFrame, template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """One row per message: conv_id, position (from 0, in reply order), turn,
    role, reply_to (the turn answered, or null), thread (the turn its thread
    begins with), n_quoted (quoted lines) and formatted (role and text without
    quotes in the template).

    Reply order is by thread and then by turn, so a message always follows the
    one it answers. Messages without a quote that is found begin a thread.
    Null and empty texts give an empty message, a null role the role "user".
    Messages with a null conv_id are one conversation, null turns come first;
    neither is linked. Repeated messages are kept, side by side.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"), text.alias("text"))
    found = links(rows, scratch)
    roots = threads(found, scratch)
    known = scratch.save(found.join(roots, ["conv_id", "turn"]), "known")
    own = F.filter(F.split("text", "\n"), lambda x: ~F.regexp_like(x, F.lit(QUOTE)))
    quoted = F.size(F.split("text", "\n")) - F.size(own)
    rows = rows.join(known, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"), quoted.cast("long").alias("n_quoted"),
        F.btrim(F.array_join(own, "\n"), F.lit(BLANK)).alias("body"))
    begin, middle, end = map(F.lit, template)
    return _placed(rows, scratch).select("conv_id", "position", "turn", "role", "reply_to", "thread", "n_quoted",
                                         F.concat(begin, "role", middle, "body", end).alias("formatted"))


SQL = r"""
with recursive m as (select conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text, row_number() over () as rid from conversations),
u as (select rid, conv_id, turn, unnest(range(len(string_split(text, chr(10))))) as i, string_split(text, chr(10)) as ls from m),
l as (select rid, conv_id, turn, i, ls[i + 1] as raw, regexp_extract(ls[i + 1], '^([ \t]*>)+[ \t]?') as head from u),
n as (select *, length(head) - length(replace(head, '>', '')) as level,
  lower(trim(regexp_replace(substr(raw, length(head) + 1), '[ \t-\r]+', ' ', 'g'))) as line from l),
x as (select conv_id, turn, text, min(rid) as rid from m where conv_id is not null and turn is not null group by all),
z as (select n.*, row_number() over (partition by rid order by i) - row_number() over (partition by rid, level order by i) as g
  from n semi join x using (rid) where line <> ''),
q as (select rid, conv_id, turn, level, g, list(line order by i) as ls, count(*) as size from z where level > 0 group by all),
o as (select rid, conv_id, turn, list(line order by i) as own from z where level = 0 group by all),
w as (select distinct conv_id, turn, own[b + 1:b + size] as ls from (
  select o.*, size, unnest(range(len(own) - size + 1)) as b from o join (select distinct conv_id, size from q) using (conv_id))),
h as (select q.rid, q.conv_id, q.turn, level, g, q.ls, size, max(w.turn) as said
  from q left join w on w.conv_id = q.conv_id and w.ls = q.ls and w.turn < q.turn group by all),
k as (select conv_id, turn, level, unnest(range(size)) as i, rid, g, unnest(ls) as line from h where said is null),
y as (select k.conv_id, k.turn, k.level, k.rid, k.g, k.i, max(z.turn) as said
  from k join z on z.level = 0 and z.conv_id = k.conv_id and z.line = k.line and z.turn < k.turn group by all),
v as (select conv_id, turn, level, said, sum(size) as votes from (
  select conv_id, turn, level, said, size from h where said is not null union all select conv_id, turn, level, said, 1 from y) group by all),
p as (select conv_id, turn, arg_max(said, {'l': -level, 'v': votes, 's': said}) as reply_to from v group by all),
t as (select conv_id, turn, reply_to as thread from p union all select t.conv_id, t.turn, p.reply_to from t join p on p.conv_id = t.conv_id and p.turn = t.thread),
r as (select conv_id, turn, min(thread) as thread from t group by all),
b as (select rid, count(*) filter (where level > 0) as n_quoted, coalesce(string_agg(raw, chr(10) order by i) filter (where level = 0), '') as body from n group by rid),
a as (select m.conv_id, m.turn, m.role, p.reply_to, coalesce(r.thread, m.turn) as thread, n_quoted,
  regexp_replace(body, '^[ \t-\r]+|[ \t-\r]+$', '', 'g') as body
  from m join b using (rid) left join p on p.conv_id = m.conv_id and p.turn = m.turn left join r on r.conv_id = m.conv_id and r.turn = m.turn)
select conv_id, row_number() over (partition by conv_id order by thread, turn, role, body) - 1 as position, turn, role, reply_to, thread, n_quoted,
  '<|im_start|>' || role || chr(10) || body || '<|im_end|>' as formatted
from a
"""
