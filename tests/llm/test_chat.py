"""Chat formatting against a plain version, on made-up mail threads."""

import itertools
import random
import re
from collections import Counter

import pytest

from strata.llm import chat
from strata.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, position string, thread string, key string"
HEAD = re.compile(r"^([ \t]*>)+[ \t]?")


def read(rows):
    """(conv, turn, lines with a word as (level, line)) of the different messages that can be linked."""
    for conv, turn, text in {(r[0], r[1], r[3] or "") for r in rows if None not in r[:2]}:
        lines = []
        for raw in text.split("\n"):
            m = HEAD.match(raw)
            line = re.sub(r"[ \t-\r]+", " ", raw[m.end() if m else 0:]).strip(" ").lower()
            line and lines.append((m[0].count(">") if m else 0, line))
        yield conv, turn, lines


def answered(rows):
    messages = list(read(rows))
    own = [(conv, turn, [x for level, x in lines if not level]) for conv, turn, lines in messages]

    def latest(conv, turn, passage):
        n = len(passage)
        return max((t for c, t, said in own if c == conv and t < turn and any(said[i:i + n] == passage for i in range(len(said) - n + 1))), default=None)

    votes = Counter()
    for conv, turn, lines in messages:
        for level, run in itertools.groupby(lines, lambda x: x[0]):
            passage = [x for _, x in run]
            if level:
                whole = latest(conv, turn, passage)
                for part in [passage] if whole is not None else [[x] for x in passage]:
                    said = latest(conv, turn, part)
                    if said is not None:
                        votes[conv, turn, level, said] += len(part)
    best = {}
    for (conv, turn, level, parent), n in votes.items():
        best[conv, turn] = max(best.get((conv, turn), (-99, 0, 0)), (-level, n, parent))
    return best


def brute(rows):
    best = answered(rows)

    def root(conv, turn):
        while (conv, turn) in best:
            turn = best[conv, turn][2]
        return turn

    out = []
    for conv, turn, role, text in rows:
        raw = (text or "").split("\n")
        own = [x for x in raw if not HEAD.match(x)]
        body = re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", "\n".join(own))
        out.append((conv, root(conv, turn), turn, role or "user", body, best.get((conv, turn), (0, 0, None))[2], len(raw) - len(own)))
    none = lambda x: (x is not None, x or 0)
    out.sort(key=lambda r: (none(r[0]), none(r[1]), none(r[2]), r[3], r[4]))
    seen = Counter()
    for conv, thread, turn, role, body, parent, quoted in out:
        yield (conv, seen[conv], turn, role, parent, thread, quoted, f"<|im_start|>{role}\n{body}<|im_end|>")
        seen[conv] += 1


def run(spark, rows):
    prepare(spark)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return Counter(map(tuple, chat.format_chats(df).collect()))


def mail(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        past = []
        for turn in range(rng.randint(1, 9)):
            lines = [f"Line {rng.randint(0, 30)} of   {conv}" for _ in range(rng.randint(1, 4))]
            if past and rng.random() < 0.7:
                lines = [f"{rng.choice(['> ', '>', ' >\t'])}{x}" for x in rng.choice(past)] + lines
            rng.random() < 0.2 and lines.append("> nobody said this")
            past.append(lines)
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), "\n".join(lines)))
    return rows


def test_threads(spark):
    rows = mail(40)
    want = Counter(brute(rows))
    assert any(r[4] is not None for r in want) and run(spark, rows) == want


def test_awkward_messages(spark):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (1, 1, None, ""), (None, 0, "user", "hi"), (None, None, "user", "> hi"), (2, None, "user", "a"), (2, 3, "user", "> a"),
            (3, 0, "user", "A  b\nc"), (3, 5, "user", ">>a B\n>  C\n x"), (3, 2, "user", "> a b"), (3, 9, "user", "> > > a b \nlong " + "word " * 9000), (4, 1, "user", "> self\nself")]
    assert run(spark, rows) == Counter(brute(rows))


def test_one_conversation_holds_all(spark):
    rows = [(7, i // 2, "user", f"say {i // 3}\n> say {i // 5}") for i in range(400)]
    assert run(spark, rows) == Counter(brute(rows))


def test_the_passage_decides(spark):
    """A whole quote of a later message that repeats earlier lines goes to the later one."""
    rows = [(1, 0, "user", "a\nb"), (1, 3, "user", "a\nb\nc"), (1, 4, "user", "> a\n> b\n> c\nyes"), (1, 5, "user", "a\nb"), (1, 6, "user", "> b\n>\n> c"),
            (1, 7, "user", "> c\n> b"), (1, 8, "user", ">> a\n> yes\n> nobody"), (2, 1, "user", "> a\n> b")]
    got = run(spark, rows)
    assert got == Counter(brute(rows))
    assert {r[2]: r[4] for r in got if r[0] == 1} == {0: None, 3: None, 4: 3, 5: None, 6: 3, 7: 5, 8: 4}


def test_most_lines_counted_per_message(spark):
    """On the mail, the message with most of the lowest level's lines, the later of equals, is the one found."""
    rows = mail(40)
    messages = list(read(rows))
    own = {(conv, turn): {x for level, x in lines if not level} for conv, turn, lines in messages}
    want = {}
    for conv, turn, lines in messages:
        for level in sorted({level for level, _ in lines if level}):
            counts = [(sum(x in said for lv, x in lines if lv == level), t) for (c, t), said in own.items() if c == conv and t < turn]
            if max(counts, default=(0, 0))[0]:
                want[conv, turn] = max(counts)[1]
                break
    got = {(r[0], r[2]): r[4] for r in run(spark, rows) if r[4] is not None}
    assert len(want) > 100 and got == want


def test_sql_says_the_same(spark):
    import duckdb
    import pandas as pd
    rows = mail(40) + [(9, 0, "user", None), (None, 1, "user", "> a"), (9, 2, "user", "> > x")]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    cols = "conv_id, position, turn, role, reply_to, thread, n_quoted, formatted"
    assert Counter(con.execute(f"select {cols} from ({chat.SQL})").fetchall()) == run(spark, rows)


def test_empty_table(spark):
    assert not run(spark, [])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_small_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert Counter(map(tuple, chat.format_chats(df).collect())) == Counter(brute([tuple(r) for r in df.collect()]))


def test_hostile_lines(spark):
    """A line of a million > and a message with a million spaces inside."""
    rows = [(1, 0, "user", "> " * 500_000 + "x"), (1, 1, "user", ">" * 1_000_000), (1, 2, "user", " \t a" + " " * 1_000_000 + "b \n"), (1, 3, "user", " > > deep\nown")]
    got = {r.turn: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t].n_quoted for t in range(4)] == [1, 1, 0, 1]
    assert got[2].formatted == "<|im_start|>user\na" + " " * 1_000_000 + "b<|im_end|>" and got[3].formatted == "<|im_start|>user\nown<|im_end|>"
