"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A well-formed conversation is empty, or an optional system turn and then pairs of a user's
and an assistant's turn. Turns are kept, given another role, deleted, or inserted with an
empty text; a dynamic programme finds the cheapest edits, and of equally cheap ones those
whose initials read least.

Rows are dealt out by conversation and sorted by turn, and ``mapInPandas`` streams them. The
first stream runs from the last turn to the first and carries, across Arrow batches, only
the costs to the end from each of the four states that a conversation can be in. For every
row it writes the best edit in each state, two bits a state, to a table in the shared
folder: these backpointers are all that is kept of a conversation, so a giant one takes no
more memory than a short one. The second stream runs from the first turn on, follows the
backpointers and meets the texts, which are shuffled only there.

That a row has the role and text of an earlier one takes no memory either: the first row of
each (conversation, role, text) is found by an aggregation, and a mark for it is sorted into
the first stream next to the row.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, table, worker_keeps

#: Fixed by the query's contract: what edits cost, and a truncated turn that stays.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("", "blank", "duplicate", "truncated")

#: States: nothing yet, after the system turn, after a user's, after an assistant's turn.
_BY_INITIAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")  # the role that a new or renamed turn gets
_DONE = (0, 3)
#: Edits by the two bits of a backpointer, in the order of their initials.
_EDITS = "DIKR"


# ----------------------------------------------------------------------- the dynamic programme
def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    return costs


#: Costs from each state when no row is left.
AT_END = tuple(_with_inserts([0 if s in _DONE else 1 << 30 for s in range(4)]))


def step_back(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs to the end before a row, given those after it, and the row's backpointers.

    Costs are relative: the least is 0. Of equally cheap edits that with the least initial is
    taken; in a state no two edits have one initial, so the whole text of initials is least.
    """
    extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
    stays = FAULTS[fault] not in ("blank", "duplicate")
    options = []
    for s in range(4):
        found = {"D": DELETE + after[s]}
        if stays:
            if initial in _BY_INITIAL[s]:
                found["K"] = extra + after[_BY_INITIAL[s][initial]]
            found["R"] = RENAME + extra + after[_NEXT[s]]
        options.append(found)
    costs = _with_inserts([min(o.values()) for o in options])
    pointers = 0
    for s, found in enumerate(options):
        found["I"] = INSERT + costs[_NEXT[s]]
        best = min(e for e, c in found.items() if c == costs[s])
        pointers |= _EDITS.index(best) << 2 * s
    least = min(costs)
    return tuple(c - least for c in costs), pointers


# ------------------------------------------------------------------------------- the streams
_KEY = "has_conv boolean, conv long, has_turn boolean, turn long, role string, text_hash string"
_POINTERS = f"{_KEY}, place long, pointers int, fault int"
_ROWS = "has_conv boolean, conv_id long, place long, edit string, has_turn boolean, turn long, old_role string, role string, text string, fault string"


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Backpointers of the rows, which come conversation by conversation from the last one.

    A row is an original if the mark of its role and text comes right behind it.
    """
    worker_keeps()  # nothing of an earlier stage
    known: dict = {}
    conv, after, place, held = None, AT_END, 0, None

    def passed(marked: bool) -> tuple:
        nonlocal after, place
        key, initial, blank, cut = held
        fault = 1 if blank else 2 if not marked else 3 if cut else 0
        step = (after, initial, fault)
        if step not in known:
            known[step] = step_back(*step)
        after, pointers = known[step]
        place += 1
        return (*key, place, pointers, fault)

    names = [c.split()[0] for c in _POINTERS.split(", ")]
    for batch in batches:
        out = []
        columns = (batch[c].tolist() for c in ("has_conv", "conv", "has_turn", "turn", "role", "text_hash", "mark", "initial", "blank", "cut"))
        for *key, mark, initial, blank, cut in zip(*columns, strict=True):
            if held is not None:
                out.append(passed(bool(mark) and held[0] == key))
                held = None
            if conv != key[:2]:
                conv, after, place = key[:2], AT_END, 0
            if not mark:
                held = (key, initial, blank, cut)
        yield pd.DataFrame(out, columns=names)
    if held is not None:
        yield pd.DataFrame([passed(False)], columns=names)


def _forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edited rows, from rows in order, each key's backpointers before its texts."""
    worker_keeps()
    conv, state, place, todo = None, 0, 0, deque()

    def row(edit: str, turn: tuple, old_role: str | None, role: str, text: str, fault: str) -> tuple:
        nonlocal place
        place += 1
        return (*conv, place, edit, *turn, old_role, role, text, fault)

    def inserted() -> tuple:
        nonlocal state
        made = row("I", (False, 0), None, _ROLE[state], "", "")
        state = _NEXT[state]
        return made

    names = [c.split()[0] for c in _ROWS.split(", ")]
    for batch in batches:
        out = []
        columns = (batch[c].tolist() for c in ("has_conv", "conv", "has_turn", "turn", "role", "text", "pointers", "fault", "is_row"))
        for has_conv, conv_id, has_turn, turn, role, text, pointers, fault, is_row in zip(*columns, strict=True):
            if conv != (has_conv, conv_id):
                while state not in _DONE:
                    out.append(inserted())
                conv, state, place, todo = (has_conv, conv_id), 0, 0, deque()
            if not is_row:
                todo.append((pointers, fault))  # of rows alike, of one turn: the first is the original
                continue
            pointers, fault = todo.popleft()
            edit = _EDITS[pointers >> 2 * state & 3]
            while edit == "I":
                out.append(inserted())
                edit = _EDITS[pointers >> 2 * state & 3]
            new_role = role
            if edit == "R":
                new_role, state = _ROLE[state], _NEXT[state]
            elif edit == "K":
                state = _BY_INITIAL[state][role[:1]]
            out.append(row(edit, (has_turn, turn), role, new_role, text, FAULTS[fault]))
        yield pd.DataFrame(out, columns=names)
    if conv is not None:
        yield pd.DataFrame([inserted() for _ in range(2) if state not in _DONE], columns=names)


def _repaired(turns: DataFrame) -> DataFrame:
    """Edited rows (``_ROWS``); each conversation's are side by side in their order."""
    flag = lambda c: F.col(c).isNotNull()  # noqa: E731
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))  # noqa: E731
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        flag("conv_id").alias("has_conv"), number("conv_id").alias("conv"), flag("turn").alias("has_turn"), number("turn").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.md5(text.cast("binary")).alias("text_hash"), text.alias("text"),
    )  # fmt: skip
    key = [c.split()[0] for c in _KEY.split(", ")]
    end = F.rtrim("text", F.lit(BLANKS))
    thin = rows.select(*key, F.lit(0).alias("mark"), F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    first = thin.groupBy("has_conv", "conv", "role", "text_hash").agg(F.min(F.struct("has_turn", "turn")).alias("at"))
    marks = first.select(
        "has_conv", "conv", "at.has_turn", "at.turn", "role", "text_hash", F.lit(1).alias("mark"), F.lit("").alias("initial"),
        F.lit(False).alias("blank"), F.lit(False).alias("cut"),
    )  # fmt: skip
    backward = thin.unionByName(marks).repartition("has_conv", "conv")
    backward = backward.sortWithinPartitions(*[F.col(c).desc() for c in key], "mark")
    pointers = saved(backward.mapInPandas(_backward, _POINTERS), "repair-pointers")
    pointers = pointers.withColumns({"text": F.lit(""), "is_row": F.lit(False)})
    rows = rows.withColumns({"place": F.lit(0).cast("long"), "pointers": F.lit(0), "fault": F.lit(0), "is_row": F.lit(True)})
    both = rows.unionByName(pointers).repartition("has_conv", "conv")
    return both.sortWithinPartitions(*key, "is_row", F.col("place").desc()).mapInPandas(_forward, _ROWS)


def repair(turns: DataFrame) -> DataFrame:
    """The edited rows of the conversations in ``turns`` (conv_id, turn, role, text), deleted ones too.

    Returns conv_id, place (from 1, in the conversation's order), edit (K kept, R renamed, D
    deleted, I inserted), turn (null for an inserted row), old_role (null for one), role, text
    and fault (blank, duplicate, truncated or empty). Without the D rows the conversation is
    well formed: roles begin with ``(s?(ua)+)?``.

    A null role or text is one space. Turns go by turn (null first), ties by role and by a
    hash of the text; rows that repeat are rows of their own, the later ones duplicates. Rows
    of a null conv_id are one conversation; one without rows has none here; an empty table
    gives none. Other columns are not used. conv_id and turn are read as longs.
    """
    out = _repaired(turns)
    null = lambda flag, c: F.when(F.col(flag), F.col(c))  # noqa: E731
    return out.select(
        null("has_conv", "conv_id").alias("conv_id"), "place", "edit", null("has_turn", "turn").alias("turn"), "old_role", "role", "text", "fault"
    )


# --------------------------------------------------------------------------------- queries
_DIGEST = (
    "has_conv boolean, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_LEGAL = ("su", "ua", "au")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation, as its edited rows stream by."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    conv = None

    def done() -> tuple:
        gaps = high - low + 1 - turns if turns else 0
        return (*conv, gaps, faults[1], faults[2], faults[3], illegal, cost, "".join(audit), sha.hexdigest())

    for batch in batches:
        out = []
        columns = (batch[c].tolist() for c in ("has_conv", "conv_id", "edit", "has_turn", "turn", "old_role", "role", "text", "fault"))
        for has_conv, conv_id, edit, has_turn, turn, old_role, role, text, fault in zip(*columns, strict=True):
            if conv != (has_conv, conv_id):
                if conv is not None:
                    out.append(done())
                conv, audit, sha, faults, illegal, cost = (has_conv, conv_id), [], hashlib.sha256(), [0] * 4, 0, 0
                turns, low, high, last, written = 0, 0, 0, None, False
            audit.append(edit)
            cost += {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}[edit]
            if edit != "D":
                cost += TRUNCATED * (fault == "truncated")
                sha.update(f"{chr(10) * written}{role}:{text}".encode())
                written = True
            if edit != "I":
                faults[FAULTS.index(fault)] += 1
                illegal += last is not None and last + old_role[:1] not in _LEGAL
                last = old_role[:1]
                if has_turn:
                    if not turns:
                        low = turn
                    turns += not turns or turn != high
                    high = turn
        yield pd.DataFrame(out, columns=names)
    if conv is not None:
        yield pd.DataFrame([done()], columns=names)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows after the damage that the query's contract prescribes; a null is one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    turns = turns.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"))
    kind = F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20
    turns = turns.withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_repair(spark, sf_dir: str) -> DataFrame:
    """What was wrong with every conversation, its cheapest edits and a digest of what they give."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    digests = _repaired(damaged(given)).mapInPandas(_digest, _DIGEST)
    every = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    every = every.select(F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"))
    found = every.join(digests, ["has_conv", "conv_id"], "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return found.select(
        F.when(F.col("has_conv"), F.col("conv_id")).alias("conv_id"),
        *zero.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


#: The CRC by its table, then the programme row by row: costs from the last row on, edits from the first.
OP11_SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), '')]),
      lambda c, x: xor(c >> 8, tab.t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM given, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
    regexp_replace(text, '[ 	-]+$', '') AS core FROM hurt),
flawed AS (SELECT *, left(role, 1) AS c,
    CASE WHEN core = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) AS before FROM placed),
turns AS (SELECT *, (fault = 'truncated')::INT AS x, fault IN ('blank', 'duplicate') AS gone FROM flawed),
ends AS (SELECT conv_id, max(pos) AS n FROM turns GROUP BY conv_id),
costs AS (
  SELECT conv_id, n + 1 AS pos, 0 AS c0, 4 AS c1, 2 AS c2, 0 AS c3, '' AS e0, 'I' AS e1, 'I' AS e2, '' AS e3 FROM ends
  UNION ALL
  SELECT conv_id, pos, c0, c1, c2, c3,
    CASE c0 WHEN d0 THEN 'D' WHEN 2 + c2 THEN 'I' WHEN k0 THEN 'K' ELSE 'R' END, CASE c1 WHEN d1 THEN 'D' WHEN 2 + c2 THEN 'I' WHEN k1 THEN 'K' ELSE 'R' END,
    CASE c2 WHEN d2 THEN 'D' WHEN 2 + c3 THEN 'I' WHEN k2 THEN 'K' ELSE 'R' END, CASE c3 WHEN d3 THEN 'D' WHEN 2 + c2 THEN 'I' WHEN k3 THEN 'K' ELSE 'R' END
  FROM (SELECT *, least(g0, 2 + c2) AS c0, least(g1, 2 + c2) AS c1
    FROM (SELECT *, least(g2, 2 + g3) AS c2, least(g3, 2 + g2) AS c3
      FROM (SELECT *, least(d0, k0, r0) AS g0, least(d1, k1, r1) AS g1, least(d2, k2, r2) AS g2, least(d3, k3, r3) AS g3
        FROM (SELECT t.conv_id, t.pos, 3 + o.c0 AS d0, 3 + o.c1 AS d1, 3 + o.c2 AS d2, 3 + o.c3 AS d3,
            CASE WHEN gone THEN 99999999 WHEN c = 's' THEN x + o.c1 WHEN c = 'u' THEN x + o.c2 ELSE 99999999 END AS k0,
            CASE WHEN NOT gone AND c = 'u' THEN x + o.c2 ELSE 99999999 END AS k1,
            CASE WHEN NOT gone AND c = 'a' THEN x + o.c3 ELSE 99999999 END AS k2,
            CASE WHEN NOT gone AND c = 'u' THEN x + o.c2 ELSE 99999999 END AS k3,
            CASE WHEN gone THEN 99999999 ELSE 2 + x + o.c2 END AS r0, CASE WHEN gone THEN 99999999 ELSE 2 + x + o.c2 END AS r1,
            CASE WHEN gone THEN 99999999 ELSE 2 + x + o.c3 END AS r2, CASE WHEN gone THEN 99999999 ELSE 2 + x + o.c2 END AS r3
          FROM costs o JOIN turns t ON t.conv_id IS NOT DISTINCT FROM o.conv_id AND t.pos = o.pos - 1))))),
walk AS (
  SELECT conv_id, 1::BIGINT AS pos, 0 AS s, '' AS audit, [0]::BIGINT[] AS picked, ['']::VARCHAR[] AS roles FROM ends
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN pos ELSE pos + 1 END,
    CASE WHEN e = 'D' THEN s WHEN e = 'K' AND s = 0 AND c = 's' THEN 1 WHEN s = 2 THEN 3 ELSE 2 END, audit || e,
    CASE e WHEN 'D' THEN picked WHEN 'I' THEN list_append(picked, 0) ELSE list_append(picked, pos) END,
    CASE e WHEN 'D' THEN roles WHEN 'K' THEN list_append(roles, role) ELSE list_append(roles, CASE WHEN s = 2 THEN 'assistant' ELSE 'user' END) END
  FROM (SELECT w.*, t.c, t.role, [o.e0, o.e1, o.e2, o.e3][w.s + 1] AS e FROM walk w
    JOIN costs o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.pos = w.pos
    LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos) WHERE e <> ''),
done AS (SELECT w.*, o.c0 AS cost FROM walk w JOIN ends n ON n.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN costs o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.pos = 1 WHERE w.pos = n.n + 1 AND w.s IN (0, 3)),
lines AS (SELECT conv_id, string_agg(role || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS repaired
  FROM (SELECT d.conv_id, d.k, d.role, t.text FROM (SELECT conv_id, unnest(roles[2:]) AS role, unnest(picked[2:]) AS pos, unnest(range(len(roles) - 1)) AS k FROM done) d
    LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND t.pos = d.pos) GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM v.conv_id
"""
