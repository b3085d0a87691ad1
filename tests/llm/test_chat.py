import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SF, duck, same_as_sql, write_tables
from tablesync.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def test_whole_table(spark):
    assert same_as_sql(chat.op6_chat(spark, SF), chat.OP6_SQL)


def test_control_conversation(spark, tmp_path):
    got = chat.op6_chat(spark, write_tables(spark, tmp_path)).collect()
    said = f"user\n{chat.CONTROL_TEXT}\nassistant\n{chat.CONTROL_TEXT}\n"
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(-1, 2, len(chat.CONTROL_TEXT))]
    assert got[0].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[0].loss_sha256 == hashlib.sha256(chat.CONTROL_TEXT.encode()).hexdigest()


def test_escaping_is_reversible(spark):
    bits = ["<", "[", "\\", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|im_end|>", "<|im_start|>", "a", "\n", "$1", "é", "s>"]

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(bits), max_size=9).map("".join), min_size=40, max_size=60))
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
        for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
            assert r.u == r.t
            assert not any(c in r.e for c in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "<|im_start|>"))

    run()


def test_windows(spark):
    """Every turn is new once; the system turn leads; loss covers each assistant text once."""
    rows = [(1, 0, "system", "be kind")]
    for i in range(1, 120):
        rows.append((1, i, "user" if i % 2 else "assistant", f"t{i} " + "word " * (i % 17)))
    rows += [(2, 0, "assistant", None), (2, 0, "user", None), (2, None, None, "</s>"), (None, 1, "assistant", "x"), (None, 1, "assistant", "x")]
    rows += [(3, 1, "user", "w " * 30_000), (3, 2, "assistant", "end"), (4, 1, "a b\n%", "q<"), (5, 1, "system", "only")]
    turns = spark.createDataFrame(rows, TURNS).withColumns({"window": F.lit(1), "part": F.lit("x"), "tokens": F.lit(0)})
    windows = chat.format_chats(turns, budget=100, history=20)
    by = {}
    for w in windows.collect():
        by.setdefault(w.conv_id, {})[w.window] = w
    assert sorted(by[1]) == list(range(len(by[1]))) and len(by[1]) > 5
    assert all(w.tokens <= 100 for w in by[1].values())
    assert all(w.formatted.startswith("<|im_start|>system\nbe kind<|im_end|>\n") for w in by[1].values())
    assert any(w.n_repeated > 1 for w in by[1].values())
    read, learnt = {}, {}
    for r in chat.read_back(windows).collect():
        read.setdefault(r.conv_id, {})[r.window] = [(t.role, t.text) for t in r.turns]
        learnt.setdefault(r.conv_id, {})[r.window] = list(r.learnt)
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv in (1, 2, 3, 4, 5, None):
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        assert [t for w in sorted(read[conv]) for t in read[conv][w]] == mine
        assert [t for w in sorted(learnt[conv]) for t in learnt[conv][w]] == [t for role, t in mine if role == "assistant"]


def _greedy(sizes, budget, history):
    """Window of each turn: (first, size) pairs in order, filled one after the other."""
    lead = sizes[0][1] if sizes[0][0] else 0
    room, at, used, window, before, out = max(1, budget - history - lead), 0, 0, 0, 0, []
    for is_lead, size in sizes:
        mine = 0 if is_lead else size
        stretch = at // (room * chat.STRETCH)
        limit = budget - lead if window == 0 else room
        if stretch != before or (used > 0 and used + mine > limit):
            window, used = window + 1, 0
        used, at, before = used + mine, at + mine, stretch
        out.append(window)
    return out


def test_spans_are_filled(spark):
    """Windows equal those filled one turn at a time; a conversation of many windows fills them."""
    rng = random.Random(5)
    rows = []
    for conv in range(12):
        n = rng.choice([(1, 5), (40, 30), (700, 12), (60, 130)])
        rows += [(conv, 0, "system", "w " * rng.choice([0, 7, 90, 120]))] if conv % 3 else []
        rows += [(conv, i, "user" if i % 2 else "assistant", "w " * rng.randrange(n[1])) for i in range(1, n[0] + 1)]
    rows += [(99, i, "user", "w " * 6) for i in range(900)]
    windows = chat.format_chats(spark.createDataFrame(rows, TURNS), budget=100, history=20)
    got, full = {}, []
    for r in chat.read_back(windows).collect():
        got.setdefault(r.conv_id, {})[r.window] = len(r.turns)
    for w in windows.where("conv_id = 99").collect():
        full.append(w.tokens)
    for conv in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == conv)
        sizes = [(i == 0 and r[2] == "system", len(r[3].split()) + chat.TURN_TOKENS) for i, r in enumerate(mine)]
        want = _greedy(sizes, 100, 20)
        assert got[conv] == {w: want.count(w) for w in set(want)}
    assert max(full) <= 100 and sum(full) / len(full) > 85


def test_plan_has_no_python(spark):
    plan = chat.op6_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_turns_are_those_of_the_table(spark):
    n = duck().execute("SELECT count(*) FROM conversations").fetchone()[0]
    assert chat.op6_chat(spark, SF).agg(F.sum("n_turns")).first()[0] == n + 2
