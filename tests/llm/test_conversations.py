import hashlib
import heapq
import random
import re
import zlib

import pytest

from cohortweave.llm import conversations as c
from cohortweave.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, mid string"
GOAL = re.compile("(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def cheapest(roles, faults):
    """(cost, audit, repaired roles by edit) by uniform-cost search over whole edit sequences, least (cost, audit) first."""
    heap, best = [(0, "", 0, "")], {}
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        if i == len(roles) and GOAL.fullmatch(said):
            return cost, audit
        key = (i, said[:1] == "s" and len(said) == 1, said[-1:])
        if key in best and best[key] <= (cost, audit):
            continue
        best[key] = cost, audit

        def go(price, letter, step, x):
            if not x or re.fullmatch("s?(ua)*u?", said + x) or GOAL.fullmatch(said + x):
                heapq.heappush(heap, (cost + price, audit + letter, i + step, said + x))

        for x in "ua":
            go(5, "I", 0, x)
        if i < len(roles):
            go(2, "D", 1, "")
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if roles[i][:1] in ("s", "u", "a"):
                    go(more, "K", 1, roles[i][0])
                for x in "ua":
                    go(1 + more, "R", 1, x)


def by_hand(originals, rows):
    """The digest columns by conv_id, from damaged (conv_id, turn, role, text) rows."""
    out = {}
    for conv in originals:
        own = [(t, " " if r is None else r, " " if x is None else x) for i, t, r, x in rows if i == conv]
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
        faults, seen = [], set()
        for _, role, text in own:
            shown = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest([r for _, r, _ in own], faults)
        said, texts, i = "", [], 0
        for letter in audit:
            if letter in "IR":
                x = next(x for x in "ua" if re.fullmatch("s?(ua)*u?", said + x))
                texts.append(f"{NAMES[x]}:{'' if letter == 'I' else own[i][2]}")
                said += x
            elif letter == "K":
                texts.append(f"{own[i][1]}:{own[i][2]}")
                said += own[i][1][0]
            i += letter != "I"
        assert GOAL.fullmatch(said) and i == len(own)
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(texts).encode()).hexdigest()}
    return out


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def answer(df):
    rows = [r.asDict() for r in df.collect()]
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r.pop("conv_id"): r for r in rows}


def made_up(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " \t", "", "Fine. \n", None, "ÄÖ…", "a.b"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 13])):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "s"])
            rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None, -3]), role, rng.choice(texts)))
            rows += rows[-1:] * rng.choice([0, 0, 0, 2])
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [65_536, 2])
def test_equals_plain_search(spark, block):
    rows = made_up(3, 150)
    got = answer(c.repaired_conversations(table(spark, rows), c.damaged(table(spark, rows)), block))
    assert got == by_hand(dict.fromkeys(r[0] for r in rows), damage_by_hand(rows))


def test_edits_are_whole_and_apply(spark):
    rows = [(1, 0, "system", "Rules."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Go."), (1, 2, "user", "Go."), (2, 5, "user", "Alone."), (3, 0, "assistant", " ")]
    found = c.repair(table(spark, rows))
    assert found.edits.columns == ["conv_id", "mid", "step", "edit", "turn", "role", "text"]
    edits = sorted(map(tuple, found.edits.collect()))
    assert [(e[0], *e[3:]) for e in edits] == [
        (1, "K", 0, "system", "Rules."), (1, "R", 1, "user", "Hi."), (1, "R", 2, "assistant", "Go."), (1, "D", 2, "user", "Go."),
        (2, "D", 5, "user", "Alone."), (3, "D", 0, "assistant", " ")]
    assert {r["conv_id"]: r["cost"] for r in found.counts.collect()} == {1: 4, 2: 2, 3: 2}


def test_long_runs_by_powers():
    for runs in ([(3, 1000)], [(5, 777), (3, 1), (0, 12)], [(7, 3), (4, 90)]):
        signs = [s for s, n in runs for _ in range(n)]
        step = c.AT_END
        for s in reversed(signs):
            step = c.costs(c.power(s, 0), step)
        assert c.advanced(runs, c.costs, c.AT_END) == step == c.costs(c.block_costs(runs), c.AT_END)


def test_one_long_conversation_spreads(spark):
    rows = [(7, i, ("user", "assistant", "user")[i % 3], f"t {i}.") for i in range(3000)] + [(8, 0, "user", "Q?"), (8, 1, "assistant", "A.")]
    df = table(spark, rows).repartition(8)
    assert c.blocks_of(c.sorted_turns(df), "bigint", c.pa.int64(), 700).where("conv_id = 7").count() >= 5
    got = answer(c.repaired_conversations(df, df, 700))
    assert got == by_hand([7, 8], rows)


def test_empty_tables_and_other_columns(spark):
    none = table(spark, [(1, 1, "user", "x")]).where("false")
    assert c.repaired_conversations(none, none).count() == 0
    assert answer(c.repaired_conversations(table(spark, [(4, None, None, None)]), none)) == by_hand([4], [])
    typed = spark.createDataFrame([("k", 1, "user", "Hello.", 1), ("k", 2, "assistant", "Hello.", 2)], "conv_id string, turn int, role string, text string, edit int")
    got = answer(c.repaired_conversations(typed, typed))
    assert got["k"]["audit"] == "KK" and got["k"]["cost"] == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = answer(QUERIES["op11_conversation_repair"](spark, sf_dir))
    assert got == by_hand(dict.fromkeys(r[0] for r in rows), damage_by_hand(rows))
