import hashlib
import itertools
import random
import re
import zlib

from helpers import SF, same_as_sql, write_tables
from pyspark.sql import functions as F

from tablesync.llm import repair as R
from tablesync.llm.common import table

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, role, text


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = WORD.findall(text)
        if not words:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least cost, then least audit, over all edits: Dijkstra over (row, roles so far's state), by brute force."""
    import heapq

    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, best = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in best and best[i, state] <= (cost, audit) and best[i, state] != (cost, audit):
            continue
        if (i, state) in best:
            continue
        best[i, state] = (cost, audit)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in ("user", "assistant"):
            if (state, role[0]) in legal:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*out, f"{role}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                if (state, role[:1]) in legal:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (state, new[0]) in legal:
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, new[0], (*out, f"{new}:{text}")))


def all_edits(rows, faults, inserts=3):
    """Every audit with at most ``inserts`` insertions, tried one by one."""
    best = None
    n = len(rows)
    spots = [s for k in range(inserts + 1) for s in itertools.combinations_with_replacement(range(n + 1), k)]
    for edits in itertools.product("DKR", repeat=n):
        if any(f in ("blank", "duplicate") and e != "D" for e, f in zip(edits, faults)):
            continue
        for at in spots:
            audit = "".join("I" * at.count(i) + (edits[i] if i < n else "") for i in range(n + 1))
            cost = sum({"D": 3, "K": 0, "R": 2, "I": 2}[e] for e in audit)
            cost += sum(f == "truncated" and e != "D" for e, f in zip(edits, faults))
            if best and (cost, audit) >= best:
                continue
            fixed = [r[2][:1] if e == "K" else None for e, r in zip(edits, rows) if e != "D"]
            # K rows give their initials; the others may be u or a.
            letters = []
            k = 0
            for e in audit:
                if e == "D":
                    continue
                if e == "I":
                    letters.append("ua")
                else:
                    letters.append(fixed[k] or "ua" if e == "R" else fixed[k])
                    k += 1
            if any(x == "" for x in letters):
                continue
            if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in itertools.product(*letters)):
                best = (cost, audit)
    return best


def expected(given):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest())
    by = {r[0]: [] for r in given}
    for r in damage(given):
        by[r[0]].append(r)
    out = {}
    for conv, rows in by.items():
        rows.sort(key=key)
        faults = faults_of(rows)
        turns = {r[1] for r in rows if r[1] is not None}
        cost, audit, repaired = cheapest(rows, faults)
        roles = [r[2][:1] for r in rows]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_given_table(spark):
    given = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(R.op11_repair(spark, SF)) == expected(given)


def random_rows(rnd, conv, n):
    texts = ["", " \n", "a.", "a", "b?", "c!\t", "same.", "é."]
    return [(conv, rnd.choice([None, *range(-1, n)]), rnd.choice(["user", "assistant", "system", "tool", "", None]), rnd.choice([*texts, None])) for _ in range(n)]


def test_odd_conversations(spark, tmp_path):
    """Nulls, ties, repeated rows, unknown roles and one long conversation that spans Arrow batches."""
    rnd = random.Random(5)
    given = [r for conv in [None, *range(300)] for r in random_rows(rnd, conv, rnd.randrange(1, 9))]
    given += [(1000, i, rnd.choice(["user", "assistant"]), rnd.choice(["x.", "y.", f"{i}", f"{i}."])) for i in range(3000)]
    given += [(1001, 5, "user", "again.")] * 40
    df = spark.createDataFrame(given, TURNS).withColumns({"place": F.lit("x"), "mark": F.lit(1), "text_hash": F.lit("y")})
    sf = write_tables(spark, tmp_path, conversations=df)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert got(R.op11_repair(spark, sf)) == expected(given)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_costs_against_all_edits():
    rnd = random.Random(3)
    for _ in range(120):
        rows = [(1, i, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["a.", "b.", f"{i}", ""])) for i in range(rnd.randrange(0, 5))]
        faults = faults_of(rows)
        assert cheapest(rows, faults)[:2] == all_edits(rows, faults)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "user", "cut"), (1, 3, "user", ""), (2, None, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumn("edit", F.lit("x"))
    out = R.repair(df).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.place, r.edit, r.turn, r.old_role, r.role, r.text, r.fault) for r in out] == [
        (1, 1, "K", 0, "system", "system", "Be kind.", ""),
        (1, 2, "I", None, None, "user", "", ""),
        (1, 3, "K", 1, "assistant", "assistant", "Yes.", ""),
        (1, 4, "D", 2, "user", "user", "cut", "truncated"),
        (1, 5, "D", 3, "user", "user", "", "blank"),
        (2, 1, "D", None, " ", " ", " ", "blank"),
    ]


def test_empty_table(spark, tmp_path):
    assert got(R.op11_repair(spark, write_tables(spark, tmp_path))) == {}


def test_dropped_conversation(spark, tmp_path):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    sf = write_tables(spark, tmp_path, conversations=spark.createDataFrame([(conv, 0, "user", "x")], TURNS))
    assert got(R.op11_repair(spark, sf)) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_given_table_in_sql(spark):
    assert same_as_sql(R.op11_repair(spark, SF), R.OP11_SQL)
