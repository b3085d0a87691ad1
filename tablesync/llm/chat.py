"""Chat formatting in budgeted windows, with DataFrame and SQL functions only.

Each turn is rendered as ``<|im_start|>role`` newline ``text<|im_end|>`` newline. A control
string inside a text gets a backslash behind its first character (one more if it has some
already), so no text can end a turn and unescaping gives the text back.

Prefix sums of the turns' tokens cut a conversation into stretches of some windows' length;
in a stretch whole turns go into a span until the next one would not fit. A span's
window opens with the system turn and with as many turns from the end of the span before
as the history allows; both are repeated, so they are not learnt again: the loss mask
covers each assistant text in the one window where it is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, table

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common templates, without their first character ``<`` or ``[``.
CONTROL_TAILS = r"\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
CONTROL = rf"(<|\[)(\\*)(?={CONTROL_TAILS})"
ESCAPED = rf"(<|\[)\\(\\*)(?={CONTROL_TAILS})"
#: Tokens of a turn besides its words: its markers and role.
TURN_TOKENS = 4
BUDGET, HISTORY = 1024, 128
#: Windows' worth of tokens in a stretch, which is filled in one row.
STRETCH = 16


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2"))


def format_chats(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of the conversations in ``turns`` (conv_id, turn, role, text).

    Returns conv_id, window (from 0), formatted, loss_spans (start and length in code
    points of ``formatted``), n_repeated (turns at its head that an earlier window has)
    and tokens (words and ``TURN_TOKENS`` a turn).

    A window keeps to ``budget`` tokens as long as no turn is longer than what the system
    turn and the history leave; turns are never cut. A span ends where the next turn would
    not fit, or with its stretch (``STRETCH`` windows of tokens). The system turn is a first turn
    of role system. Turns go by turn (null first), ties by role and text; rows that repeat
    are turns of their own. A null text or role is empty, and rows of a null conv_id are
    one conversation. An empty table gives no windows. Other columns are not used.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = turns.withColumns(
        {
            "place": F.row_number().over(order),
            "tokens": (F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).cast("long"),
        }
    )
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("conv_id")
    system = (F.col("place") == 1) & (F.col("role") == "system")
    turns = turns.withColumns({"system": system, "ends": F.sum("tokens").over(so_far)})
    turns = turns.withColumn("first_tokens", F.coalesce(F.max(F.when(F.col("system"), F.col("tokens"))).over(whole), F.lit(0)))
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.col("first_tokens"))
    behind_system = F.greatest(F.lit(0), F.col("ends") - F.col("tokens") - F.col("first_tokens"))
    turns = turns.withColumn("stretch", F.floor(behind_system / (room * STRETCH)))
    each = F.struct("place", "role", "text", "tokens", "system", "ends")
    stretches = turns.groupBy("conv_id", "stretch").agg(
        F.max("first_tokens").alias("first_tokens"), F.array_sort(F.collect_list(each)).alias("all")
    )

    def fill(state: Column, t: Column) -> Column:
        size = F.when(t["system"], 0).otherwise(t["tokens"])
        first = (F.col("stretch") == 0) & (F.size(state["starts"]) == 0)  # no history goes before it
        limit = F.when(first, F.lit(budget) - F.col("first_tokens")).otherwise(room)
        full = (state["used"] > 0) & (state["used"] + size > limit)
        used = F.when(full, size).otherwise(state["used"] + size)
        starts = F.when(full, F.concat(state["starts"], F.array(t["place"]))).otherwise(state["starts"])
        return F.struct(used.alias("used"), starts.alias("starts"))

    nothing = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("starts"))
    opens = F.when(F.col("stretch") > 0, F.slice(F.transform("all", lambda t: t["place"]), 1, 1)).otherwise(F.array().cast("array<int>"))
    starts = F.concat(opens, F.aggregate("all", nothing, fill, lambda s: s["starts"]))
    turns = stretches.select("conv_id", starts.alias("starts"), "all").select("conv_id", "starts", F.inline("all"))
    order = W.partitionBy("conv_id").orderBy("place")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    new_span = F.array_contains("starts", F.col("place")).cast("long")
    turns = turns.withColumns({"window": F.sum(new_span).over(so_far), "begins": F.col("ends") - F.col("tokens")}).drop("starts")
    turns = turns.withColumns(
        {"last": F.max("window").over(whole), "behind": F.max("ends").over(W.partitionBy("conv_id", "window"))}
    )
    none = F.array().cast("array<bigint>")
    next_one = F.col("window") + 1
    recent = (F.col("behind") - F.col("begins") <= history) & (F.col("window") < F.col("last"))
    again = (
        F.when(F.col("system") & (F.col("window") < F.col("last")), F.sequence(next_one, F.col("last")))
        .when(~F.col("system") & recent, F.array(next_one))
        .otherwise(none)
    )
    parts = turns.withColumn("into", F.explode(F.concat(F.array("window"), again)))
    repeated = F.col("into") > F.col("window")
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    parts = parts.select(
        "conv_id",
        F.col("into").alias("window"),
        "tokens",
        F.struct(
            "place",
            repeated.alias("repeated"),
            ((F.col("role") == "assistant") & ~repeated).alias("learnt"),
            head.alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("part"),
    )
    windows = parts.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.sum("tokens").alias("tokens")
    )
    tail = F.lit(END + "\n")
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], tail)), "")

    def place(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        size = F.length(p["body"])
        here = F.struct(start.alias("start"), size.alias("length"))
        spans = F.when(p["learnt"], F.concat(state["spans"], F.array(here))).otherwise(state["spans"])
        return F.struct((start + size + len(END) + 1).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return windows.select(
        "conv_id",
        "window",
        formatted.alias("formatted"),
        F.aggregate("parts", begin, place, lambda s: s["spans"]).alias("loss_spans"),
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"),
        "tokens",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """What formatted windows say, per window: conv_id, window, turns (role, text) that are new, learnt (texts)."""
    turns = F.split("formatted", r"<\|im_start\|>", -1)  # the first is what stands before any turn: nothing
    turns = F.slice(turns, F.col("n_repeated") + 2, F.size(turns) - F.col("n_repeated") - 1)

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        size = F.length(t) - F.length(role) - len(END) - 2
        return F.struct(F.url_decode(role).alias("role"), unescape(t.substr(F.length(role) + 2, size)).alias("text"))

    def learnt(s: Column) -> Column:
        return unescape(F.col("formatted").substr(s["start"] + 1, s["length"]))

    return windows.select(
        "conv_id", "window", F.transform(turns, turn).alias("turns"), F.transform("loss_spans", learnt).alias("learnt"), "formatted"
    )


# --------------------------------------------------------------------------------- queries
#: A conversation that consists of control strings (fixed by the query's contract).
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op6_chat(spark, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its windows.

    A digest is one value over a whole conversation, so here its windows meet in a row.
    """
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    read = read_back(format_chats(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.struct("window", said.alias("said"), F.array_join("learnt", "").alias("learnt")).alias("w"),
        F.length("formatted").cast("long").alias("chars"),
    )
    found = each.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars")
    )
    learnt = F.array_join(F.transform("w", lambda x: x["learnt"]), "")
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("w", lambda x: x["said"]), ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP6_SQL = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
t AS (SELECT conv_id, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {TURN_TOKENS} AS tokens,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)),
e AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) AS ends, place = 1 AND role = 'system' AS system,
    coalesce(max(CASE WHEN place = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS ft FROM t),
s AS (SELECT *, CASE WHEN system THEN 0 ELSE tokens END AS fresh, greatest(1, {BUDGET} - {HISTORY} - ft) AS room,
    greatest(0, ends - tokens - ft) // (greatest(1, {BUDGET} - {HISTORY} - ft) * {STRETCH}) AS stretch FROM e),
g(conv_id, place, stretch, used, win) AS (SELECT conv_id, place, stretch, fresh::HUGEINT, 0 FROM s WHERE place = 1
  UNION ALL SELECT n.conv_id, n.place, n.stretch, CASE WHEN n.full THEN n.fresh ELSE n.used + n.fresh END, n.win + n.full::INT
  FROM (SELECT s.*, g.used, g.win, s.stretch <> g.stretch
      OR (g.used > 0 AND g.used + s.fresh > CASE WHEN g.win = 0 THEN {BUDGET} - s.ft ELSE s.room END) AS full
    FROM g JOIN s ON s.conv_id IS NOT DISTINCT FROM g.conv_id AND s.place = g.place + 1) n),
w AS (SELECT s.*, g.win FROM s JOIN g ON s.conv_id IS NOT DISTINCT FROM g.conv_id AND s.place = g.place),
b AS (SELECT *, max(win) OVER (PARTITION BY conv_id) AS last, max(ends) OVER (PARTITION BY conv_id, win) AS behind FROM w),
r AS (SELECT *, CASE WHEN system THEN 1 + last - win
    WHEN win < last AND behind - (ends - tokens) <= {HISTORY} THEN 2 ELSE 1 END AS times FROM b)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(times * (length(url_encode(role)) + length(text) + {len(START) + len(END) + 2}
    + len(regexp_extract_all(text, '(<|\[)\\*({CONTROL_TAILS})'))))::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""
