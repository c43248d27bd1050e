"""Conversation repair against all edits of small conversations and a search over whole strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskloom.llm import dialogue

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def all_edits(rows):
    """Cost and audit of the cheapest edits, by trying every one; rows: (initial, forced, truncated)."""
    best = None

    def ends(roles):
        return re.fullmatch("(s?(ua)+)?", roles)

    def go(i, roles, cost, audit, inserted):
        nonlocal best
        if best and (cost > best[0]) or not re.fullmatch("s?(ua)*u?", roles):
            return
        if i == len(rows):
            if ends(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
        else:
            initial, forced, cut = rows[i]
            go(i + 1, roles, cost + 4, audit + "D", 0)
            if not forced:
                go(i + 1, roles + initial, cost + 3 * cut, audit + "K", 0)
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + 3 * cut, audit + "R", 0)
        if inserted < 3:
            for r in "ua":
                go(i, roles + r, cost + 3, audit + "I", inserted + 1)

    go(0, "", 0, "", 0)
    return best


def whole_strings(rows):
    """The same for long conversations: a plain search that keeps whole audits."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for x, (c, t) in list(out.items()):
                for r in "ua":
                    if (x, r) in step:
                        y = step[x, r]
                        out[y] = min(out.get(y, (c + 3, t + "I")), (c + 3, t + "I"))
        return out

    states = {"": (0, "")}
    for initial, forced, cut in rows:
        new = {}

        def put(y, c, t):
            new[y] = min(new.get(y, (c, t)), (c, t))

        for x, (c, t) in inserted(states).items():
            put(x, c + 4, t + "D")
            if not forced:
                if (x, initial) in step:
                    put(step[x, initial], c + 3 * cut, t + "K")
                for r in "ua":
                    if (x, r) in step:
                        put(step[x, r], c + 3 + 3 * cut, t + "R")
        states = new
    return min(v for x, v in inserted(states).items() if x in ("", "a"))


def found(rows):
    s = dialogue.Survivors()
    for r in rows:
        s.row(*r)
        assert len({id(n) for _, _, n in s.live.values()}) == len(s.live)
    cost, audit = s.end()
    return cost, audit.decode()


def test_edits_against_all_edits():
    rng = random.Random(1)
    for _ in range(400):
        rows = [(rng.choice("ssuuuaax"), rng.random() < 0.15, rng.random() < 0.3) for _ in range(rng.randint(0, 4))]
        rows = [(i, f, c and not f) for i, f, c in rows]
        assert found(rows) == all_edits(rows), rows


@pytest.mark.parametrize("letters", ["ua", "u", "a", "s", "sua", "uua", "x"])
def test_edits_against_whole_strings(letters):
    rng = random.Random(letters)
    for _ in range(60):
        rows = [(rng.choice(letters), rng.random() < 0.1, False) for _ in range(rng.randint(5, 80))]
        rows = [(i, f, not f and rng.random() < 0.2) for i, f, _ in rows]
        assert found(rows) == whole_strings(rows), rows


def test_survivors_coalesce():
    s = dialogue.Survivors()
    most = 0
    rng = random.Random(7)
    for k in range(20_000):
        s.row("ua"[k % 2] if rng.random() < 0.9 else rng.choice("sua"), rng.random() < 0.05, False)
        most = max(most, s.held())
    assert most < 200 and len(s.done) > 19_000


def brute(rows):
    """The contract's columns of every conversation, row by row."""
    space = lambda x: " " if x is None else str(x)
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out.setdefault(conv, [])
        if kind:
            out[conv] += [(turn, role, text)] * (1 + (kind == 3))
    got = {}
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, flags, faults = set(), [], [0, 0, 0]
        for _, role, text in kept:
            body = re.findall("[^\x20\x09-\x0D]", text)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            flags.append((role[:1], fault < 2, fault == 2))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit = whole_strings(flags)
        lines, at, before = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else kept[at][1:]
            at += edit != "I"
            if edit in "IR":
                role = "assistant" if before == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{text}")
                before = role[:1]
        got[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults,
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(flags, flags[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return got


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_against_brute_force(spark):
    got = E.queries()["op13_conversation_repair"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in got.select(*COLUMNS).collect()} == brute(rows)


def test_odd_conversations(spark):
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "A?"), (1, None, "user", "A?"),
            (2, 5, "", "x"), (2, 5, "", "x"), (2, 9, "tool", "  \t"), (3, -4, "user", "word " * 200_000)]
    for conv in range(4, 60):
        for turn in range(rng.randint(1, 30)):
            rows.append((conv, rng.choice([turn, None, 3]) if conv % 5 == 0 else turn, rng.choice(["user", "assistant", "system", None]),
                         rng.choice(["Yes.", "no", "", None, "What?", "été \U0001f600!"])))
    df = spark.createDataFrame(rows, TURNS).withColumn("audit", F.lit(1)).withColumn("part", F.lit(2)).repartition(7)
    got = dialogue.repair(dialogue.damaged(df)).select(*COLUMNS).collect()
    want = brute(rows)
    assert len(got) == len(want) and {r[0]: tuple(r[1:]) for r in got} == want
    gone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS)
    r = dialogue.repair(dialogue.damaged(one)).select(*COLUMNS).first()
    assert tuple(r) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert dialogue.repair(dialogue.damaged(one.limit(0))).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Bye."), (1, 3, "assistant", "Bye!")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("gone", F.lit(False))
    edits = dialogue.find_edits(turns)
    assert edits.first().audit == "KIKKK"
    got = [tuple(r) for r in dialogue.apply_edits(turns, edits, lines=True).orderBy("place").collect()]
    assert got == [(1, 0, "system", "Be kind."), (1, 1, "user", ""), (1, 2, "assistant", "Hi."), (1, 3, "user", "Bye."),
                   (1, 4, "assistant", "Bye!")]
