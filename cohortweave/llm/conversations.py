"""Conversation structure repair by a run-length dynamic programme.

The turns of a conversation are taken in order of (turn, role, text), a null turn first. A turn has one fault at most: blank
(white space only), duplicate (role and text of an earlier turn) or truncated (does not end in `.`, `!` or `?`). The cheapest
edits make the first letters of the roles read `(s?(ua)+)?`: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only
choice for blank and duplicate turns), Insert an empty user or assistant turn 5; a truncated turn that stays costs 5 more.
Of equally cheap edits the ones whose letters come first in ASCII order are taken.

Four states say what may come next. What a turn does to the cost of reaching the end from each state is a 4 x 4 min-plus matrix,
of which there is one for each of nine symbols (first letter of the role, fault). Runs of one symbol are collapsed, and a
run of n is advanced by the cached powers of its matrix for the bits of n.

* A conversation is cut into blocks of at most `block` turns that lie in one range of the sorted turns, so one of any length
  spreads over many tasks. The blocks' matrices, folded from the end, give each block the costs behind it; with them a block
  unrolls its edits for each state it may be entered in, and a fold from the front picks one of the four.
* A conversation's SHA-256 is one stream by definition: `digests` reads the turns of a conversation in order, keeping none.
  All other work on a long conversation is spread.
* Tables read more than once are written to the shared folder, so a lost executor costs a re-read.

Defined results: a null role or text is one space; a null conv_id is a conversation of its own; an empty role has no letter and
is never kept as it is; equal turns, however many, are duplicates but for one; turns of other texts under one number are all
taken; an empty table gives empty results; columns beside the four are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.runtime import settle

BLOCK = 65_536
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
FAR = 1 << 60  # no way to the end
DELETE, INSERT, TRUNCATED = 2, 5, 5

# 0: nothing yet, 1: after system, 2: after user, 3: after assistant; the first and the last may end
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TURN_OF = ("u", "u", "a", "u")  # whom a state lets speak, apart from a first system turn
NAMES = {"u": "user", "a": "assistant"}
END = (0, FAR, FAR, 0)

MUST_GO = 0
LETTERS = "sua"


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    """0: must go; else first letter (s, u, a, another) and whether the turn is truncated."""
    if must_go:
        return MUST_GO
    place = LETTERS.find(initial) if initial else -1
    return 1 + 2 * (place if place >= 0 else 3) + truncated


def choices(state: int, sign: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a turn, in ASCII order."""
    out = [("D", DELETE, state)]
    if sign != MUST_GO:
        place, more = divmod(sign - 1, 2)
        kept = STEPS.get((state, LETTERS[place])) if place < 3 else None
        if kept is not None:
            out.append(("K", TRUNCATED * more, kept))
        out.append(("R", 1 + TRUNCATED * more, STEPS[state, TURN_OF[state]]))
    return out


def product(a: tuple, b: tuple) -> tuple:
    columns = tuple(zip(*b))
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in columns) for row in a)


def costs(a: tuple, behind: tuple) -> tuple:
    return tuple(min(FAR, *(x + y for x, y in zip(row, behind))) for row in a)


def inserting() -> tuple:
    """Cost of going from state to state by insertions alone."""
    rows = []
    for start in range(4):
        row, state, paid = [FAR] * 4, start, 0
        while row[state] > paid:
            row[state], paid, state = paid, paid + INSERT, STEPS[state, TURN_OF[state]]
        rows.append(tuple(row))
    return tuple(rows)


INSERTING = inserting()
AT_END = costs(INSERTING, END)


@lru_cache(maxsize=1024)
def power(sign: int, bit: int) -> tuple:
    """The matrix of 2**bit turns of one symbol, insertions before each included."""
    if bit:
        half = power(sign, bit - 1)
        return product(half, half)
    rows = []
    for state in range(4):
        row = [FAR] * 4
        for _, cost, to in choices(state, sign):
            row[to] = min(row[to], cost)
        rows.append(tuple(row))
    return product(INSERTING, tuple(rows))


def advanced(runs: list[tuple[int, int]], by: Callable, value: tuple) -> tuple:
    """`value` taken through the runs from the last to the first; `by` applies a matrix to it."""
    for sign, n in reversed(runs):
        bit = 0
        while n >> bit:
            if n >> bit & 1:
                value = by(power(sign, bit), value)
            bit += 1
    return value


def block_costs(runs: list[tuple[int, int]]) -> tuple:
    unit = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
    return advanced(runs, lambda a, b: tuple(tuple(min(FAR, x) for x in row) for row in product(a, b)), unit)


def unroll(runs: list[tuple[int, int]], behind: tuple, last: bool) -> tuple[list[int], list[str]]:
    """The edits of a block for each state it may be entered in, and the state it is left in."""
    signs = [sign for sign, n in runs for _ in range(n)]
    togo = [behind]
    for sign in reversed(signs):
        togo.append(costs(power(sign, 0), togo[-1]))
    togo.reverse()
    exits, audits = [], []
    for state in range(4):
        letters = []
        for i, sign in enumerate(signs):
            while True:
                here, insert = togo[i][state], STEPS[state, TURN_OF[state]]
                options = [(letter, to, cost + togo[i + 1][to]) for letter, cost, to in choices(state, sign)]
                options.append(("I", insert, INSERT + togo[i][insert]))
                letter, state, _ = min(o for o in options if o[2] == here)
                letters.append(letter)
                if letter != "I":
                    break
        while last and END[state]:
            state = STEPS[state, TURN_OF[state]]
            letters.append("I")
        exits.append(state)
        audits.append("".join(letters))
    return exits, audits


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    waiting = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), schema.types)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), schema.types)], schema=schema)


def stream(df: DataFrame, schema: str, kinds: list[pa.DataType], work: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """`work` over the rows of each partition in order, without a partition ever being whole in memory."""
    arrow = pa.schema(list(zip([f.split()[0] for f in schema.split(", ")], kinds)))
    return df.mapInArrow(lambda batches: batched(work(rows_of(batches)), arrow), schema)


def sorted_turns(conversations: DataFrame) -> DataFrame:
    """Turns with `mid`, their place in the order of all conversations, and what is needed of them; written once."""
    turn, space = F.col("turn").cast("long"), F.lit(" ")
    rows = conversations.select("conv_id", turn.alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                F.coalesce(F.col("text").cast("string"), space).alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv_id", "turn", "role", "text", "tie"]  # equal turns, however many, need not lie in one range
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shown = F.rtrim("text", F.lit(WHITE))
    return settle(rows.select(
        F.monotonically_increasing_id().alias("mid"), "conv_id", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"),
        F.sha2(F.col("text").cast("binary"), 256).alias("h"), (F.ltrim(shown, F.lit(WHITE)) == "").alias("blank"),
        (~F.right(shown, F.lit(1)).isin(*ENDS)).alias("truncated")))


def duplicates(turns: DataFrame) -> DataFrame:
    """`mid` of the turns whose role and text came earlier in their conversation."""
    seen = turns.where(~F.col("blank")).select("conv_id", "role", "h", "mid")
    first = seen.groupBy("conv_id", "role", "h").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("k"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("k"))
    return seen.join(first, same).where("mid <> first").select("mid")


STATS = ("blank", "duplicate", "truncated", "illegal")


def blocks_of(turns: DataFrame, kind: str, arrow_kind: pa.DataType, most: int = BLOCK) -> DataFrame:
    """One row per block: its first `mid`, runs, matrix and counts."""
    facts = turns.select("mid", F.lit(1).alias("real"), "conv_id", "turn", "initial", "blank", "truncated")
    marks = duplicates(turns).select("mid", F.lit(0).alias("real"), F.lit(None).cast(kind).alias("conv_id"), F.lit(None).cast("long").alias("turn"),
                                     F.lit("").alias("initial"), F.lit(False).alias("blank"), F.lit(False).alias("truncated"))
    dealt = facts.union(marks).repartition(F.shiftright("mid", 33)).sortWithinPartitions("mid", "real")

    def cut(rows):
        marked, block = None, None

        def done(b):
            matrix = [x for row in block_costs(b["runs"]) for x in row]
            signs, lengths = zip(*b["runs"])
            return (b["conv"], b["mid"], list(signs), list(lengths), matrix, *b["stats"], b["from"], b["last"], b["turns"], b["low"], b["high"])

        for mid, real, conv, turn, initial, blank, truncated in rows:
            if not real:
                marked = mid
                continue
            if block is None or block["conv"] != conv or mid >> 33 != block["mid"] >> 33 or block["n"] == most:
                if block:
                    yield done(block)
                block = {"conv": conv, "mid": mid, "n": 0, "runs": [], "stats": [0, 0, 0, 0], "from": initial, "last": None, "turns": 0, "low": None, "high": None}
            again = mid == marked
            fault = 0 if blank else 1 if again else 2 if truncated else None
            sign, runs = symbol(initial, blank or again, truncated), block["runs"]
            if runs and runs[-1][0] == sign:
                runs[-1] = sign, runs[-1][1] + 1
            else:
                runs.append((sign, 1))
            if fault is not None:
                block["stats"][fault] += 1
            block["stats"][3] += block["last"] is not None and block["last"] + initial not in ("su", "ua", "au")
            if turn is not None and turn != block["high"]:
                block["turns"] += 1
                block["low"] = turn if block["low"] is None else block["low"]
                block["high"] = turn
            block["last"] = initial
            block["n"] += 1
        if block:
            yield done(block)

    schema = f"conv_id {kind}, mid long, signs array<int>, lengths array<int>, costs array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string, turns long, low long, high long"
    ints, longs, n = pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()
    return settle(stream(dealt, schema, [arrow_kind, n, ints, ints, longs, n, n, n, n, pa.string(), pa.string(), n, n, n], cut))


def costs_behind(blocks: DataFrame) -> DataFrame:
    """(mid, behind, final): what lies behind each block costs, from each state; `final` where nothing does."""
    def fold(rows):
        at, value = rows, None  # no conversation yet
        for conv, mid, matrix in rows:
            final = at is rows or conv != at
            if final:
                at, value = conv, AT_END
            yield mid, list(value), final
            value = costs(tuple(tuple(matrix[4 * i:4 * i + 4]) for i in range(4)), value)

    dealt = blocks.select("conv_id", "mid", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("mid"))
    return stream(dealt, "mid long, behind array<long>, final boolean", [pa.int64(), pa.list_(pa.int64()), pa.bool_()], fold)


def chosen_edits(blocks: DataFrame, kind: str, arrow_kind: pa.DataType) -> DataFrame:
    """(conv_id, mid, entry, audit) of every block; where a conversation ends its counts and cost as well."""
    facts = ("conv_id", "mid", *STATS, "first", "last", "turns", "low", "high", "costs", "behind", "final")

    def unrolled(rows):
        for *kept, signs, lengths in rows:
            exits, audits = unroll(list(zip(signs, lengths)), tuple(kept[12]), kept[13])
            yield (*kept, exits, audits)

    n, text, longs = pa.int64(), pa.string(), pa.list_(pa.int64())
    schema = f"conv_id {kind}, mid long, blank long, duplicate long, truncated long, illegal long, first string, last string, turns long, low long, high long, costs array<long>, behind array<long>, final boolean, exits array<int>, audits array<string>"
    met = blocks.join(costs_behind(blocks), "mid").select(*facts, "signs", "lengths")
    ways = stream(met, schema, [arrow_kind, n, n, n, n, n, text, text, n, n, n, longs, longs, pa.bool_(), pa.list_(pa.int32()), pa.list_(text)], unrolled)

    def fold(rows):
        total, fresh = None, True
        for conv, mid, *counts, first, last, turns, low, high, matrix, behind, final, exits, audits in rows:
            if fresh:
                whole = costs(tuple(tuple(matrix[4 * i:4 * i + 4]) for i in range(4)), tuple(behind))
                total, state, before, fresh = {"n": [0] * 4, "turns": 0, "low": None, "high": None, "cost": whole[0]}, 0, None, False
            total["n"] = [x + y for x, y in zip(total["n"], counts)]
            total["n"][3] += before is not None and before + first not in ("su", "ua", "au")
            if low is not None:
                total["turns"] += turns - (low == total["high"])
                total["low"], total["high"] = low if total["low"] is None else total["low"], high
            entry, state, before = state, exits[state], last
            gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
            yield (conv, mid, entry, audits[entry], *((gaps, *total["n"], total["cost"]) if final else (None,) * 6))
            fresh = final

    dealt = ways.repartition("conv_id").sortWithinPartitions("conv_id", "mid")
    schema = f"conv_id {kind}, mid long, entry int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return settle(stream(dealt, schema, [arrow_kind, n, pa.int32(), text, n, n, n, n, n, n], fold))


def edited_turns(turns: DataFrame, chosen: DataFrame, kind: str, arrow_kind: pa.DataType) -> DataFrame:
    """(conv_id, mid, step, edit, turn, role, text), one row per edit; of a deleted turn as it was, an inserted one has no number."""
    rows = turns.select("mid", F.lit(1).alias("real"), "conv_id", "turn", "role", "text", F.lit(0).alias("entry"))
    plans = chosen.select("mid", F.lit(0).alias("real"), "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), "entry")
    dealt = rows.union(plans).repartition(F.shiftright("mid", 33)).sortWithinPartitions("mid", "real")

    def work(rows):
        audit, at, end, state = "", 0, 0, 0
        for mid, real, conv, turn, role, text, entry in rows:
            if not real:
                audit, at, state = text, 0, entry
                end = len(audit.rstrip("I"))
                continue
            step = 0
            while True:
                letter = audit[at]
                at += 1
                if letter in "IR":
                    speaker = NAMES[TURN_OF[state]]
                    state = STEPS[state, TURN_OF[state]]
                    yield (conv, mid, step, "I", None, speaker, "") if letter == "I" else (conv, mid, step, "R", turn, speaker, text)
                else:
                    state = STEPS[state, role[:1]] if letter == "K" else state
                    yield conv, mid, step, letter, turn, role, text
                step += 1
                if letter != "I" and at < end or at == len(audit):
                    break

    n, string = pa.int64(), pa.string()
    return stream(dealt, f"conv_id {kind}, mid long, step int, edit string, turn long, role string, text string", [arrow_kind, n, pa.int32(), string, n, string, string], work)


@dataclass
class Repair:
    """`edits`: conv_id, mid, step, edit, turn, role, text, in the order of (mid, step). `counts`: conv_id, gaps, faults, cost."""

    edits: DataFrame
    counts: DataFrame


def repair(conversations: DataFrame, block: int = BLOCK) -> Repair:
    """The cheapest edits of every conversation of (conv_id, turn, role, text)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = conversations.schema["conv_id"].dataType
    types = kind.simpleString(), to_arrow_type(kind)
    turns = sorted_turns(conversations)
    chosen = chosen_edits(blocks_of(turns, *types, block), *types)
    counts = chosen.where("cost IS NOT NULL").select("conv_id", "gaps", *STATS, "cost")
    return Repair(edited_turns(turns, chosen, *types), counts)


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the edits' letters, the hash of the repaired `role:text` joined by newlines."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = edits.schema["conv_id"].dataType

    def work(rows):
        at, letters, digest, empty = rows, [], hashlib.sha256(), True
        for conv, edit, role, text in rows:
            if at is rows or conv != at:
                if at is not rows:
                    yield at, "".join(letters), digest.hexdigest()
                at, letters, digest, empty = conv, [], hashlib.sha256(), True
            letters.append(edit)
            if edit != "D":
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                empty = False
        if at is not rows:
            yield at, "".join(letters), digest.hexdigest()

    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "mid", "step").select("conv_id", "edit", "role", "text")
    return stream(dealt, f"conv_id {kind.simpleString()}, audit string, repaired_sha256 string", [to_arrow_type(kind), pa.string(), pa.string()], work)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows by crc32 of `conv_id:turn`, modulo 20: dropped (0), emptied (1), without `.!?` (2), twice (3), said by the user (4)."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    said = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": said, "role": F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(times)).select("conv_id", "turn", "role", "text")


def repaired_conversations(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for every conv_id of `conversations`: counts, cost, audit and hash of the repaired `rows`."""
    found = repair(rows, block)
    name = lambda df, new: df.withColumnRenamed("conv_id", new)
    out = conversations.select("conv_id").distinct()
    out = out.join(name(found.counts, "c1"), F.col("conv_id").eqNullSafe(F.col("c1")), "left")
    out = out.join(name(digests(found.edits), "c2"), F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()} | dict.fromkeys(("gaps", *STATS, "cost"), 0)
    return out.select("conv_id", *[F.coalesce(F.col(c), F.lit(v).cast("string" if isinstance(v, str) else "long")).alias(c) for c, v in none.items()])
