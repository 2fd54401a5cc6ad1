"""Conversation repair: the cheapest edits that give a conversation its structure, by run-length dynamic programming.

A turn is one of nine symbols: to be deleted, or one of four kinds of role with or without a cut end. Equal symbols in
a row are a run. The state of the wanted structure (nothing yet, after the system turn, after the user, after the
assistant) turns a symbol into a 4 x 4 min-plus matrix; a run is its power, put together from powers to 2^k that are
computed once per worker. From the end backwards that gives the cost still to pay at every run, and from the front the
choices, a block of turns at a time.

Turns are classed where they stand, by joins and windows without their texts; runs are made in ranges of (conversation,
turn), so a very long conversation is the work of many tasks. One task then has only its runs, and for the digest of
the repaired text its turns in order, as a stream: SHA-256 allows no parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import saved, worker_state

START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
# The state after a user or assistant turn made at will, and after a turn kept as it is.
TURNED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
# What is left to pay behind the last turn: turns to insert until an assistant's.
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
_BLOCK = 256

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def symbol_options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """The (edit, cost, next state) that use up a turn: 'd' must go; s, u, a, o are roles, in capitals with a cut end."""
    options = [("D", DELETE, state)]
    if symbol != "d":
        cut = CUT if symbol.isupper() else 0
        if (state, symbol.lower()) in KEPT:
            options.append(("K", KEEP + cut, KEPT[state, symbol.lower()]))
        options.append(("R", REROLE + cut, TURNED[state]))
    return options


def transition(symbol: str) -> Matrix:
    """Cheapest cost from state to state over one turn, with any turns inserted before it."""
    rows = []
    for state in range(4):
        row, paid, at = [NEVER] * 4, 0, state
        for _ in range(3):  # two more inserted turns lead back
            for _, cost, after in symbol_options(symbol, at):
                row[after] = min(row[after], paid + cost)
            paid, at = paid + INSERT, TURNED[at]
        rows.append(tuple(row))
    return tuple(rows)


def powers(symbol: str, k: int) -> Matrix:
    """The transition over 2^k equal turns; kept by the worker."""
    known = worker_state().setdefault("transitions", {})
    if (symbol, k) not in known:
        if k == 0:
            known[symbol, 0] = transition(symbol)
        else:
            half = powers(symbol, k - 1)
            known[symbol, k] = tuple(tuple(min(half[i][j] + half[j][m] for j in range(4)) for m in range(4)) for i in range(4))
    return known[symbol, k]


def before(symbol: str, n: int, cost: Vector) -> Vector:
    """Costs still to pay before n equal turns, from those behind them."""
    k = 0
    while n:
        if n & 1:
            cost = tuple(min(row[j] + cost[j] for j in range(4)) for row in powers(symbol, k))
        n, k = n >> 1, k + 1
    return cost


def cheapest(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair of runs (symbol, length); of equal ones the least in ASCII order.

    At every point the edits that a cheapest repair may go on with are known from the costs still to pay, and each
    leads to one state, so taking the least letter gives the least text.
    """
    behind = [AT_END]
    for symbol, n in reversed(runs):
        behind.append(before(symbol, n, behind[-1]))
    total, state, edits = behind[-1][START], START, []
    for (symbol, n), end in zip(runs, reversed(behind[:-1])):
        options = [symbol_options(symbol, at) for at in range(4)]
        for begin in range(0, n, _BLOCK):
            size = min(_BLOCK, n - begin)
            costs = [before(symbol, n - begin - size, end)]
            for _ in range(size):
                costs.append(before(symbol, 1, costs[-1]))
            for here, after in zip(reversed(costs), reversed(costs[:-1])):
                while True:
                    choices = [(edit, to) for edit, cost, to in options[state] if cost + after[to] == here[state]]
                    if choices and (choices[0][0] == "D" or INSERT + here[TURNED[state]] != here[state]):
                        break
                    edits.append("I")
                    state = TURNED[state]
                edits.append(choices[0][0])
                state = choices[0][1]
    while AT_END[state]:
        edits.append("I")
        state = TURNED[state]
    return total, "".join(edits)


def damage(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32(conv_id:turn) modulo 20 deals to every row."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), filled(role).alias("role"), filled(text).alias("text"),
        (F.crc32(F.concat_ws(":", filled(conv_id), filled(turn))) % 20).alias("hit")).where("hit <> 0")
    return dealt.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


_ORDER = ["turn", "role", "h1", "h2", "copy"]


def _order() -> list[Column]:
    """Turns in order, nulls first; ties by role, then by the hash of the text."""
    return [F.col(c).asc_nulls_first() for c in _ORDER]


def _hashed(turns: DataFrame) -> DataFrame:
    return turns.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("row"), "text", F.length("text"))})


def symbols(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, copy, initial, fault) of turns; the first fault that holds counts.

    fault is blank, duplicate, truncated or null. A turn is a duplicate if one before it has its role and text.
    """
    end = F.rtrim("text", F.lit(SPACE))
    slim = _hashed(turns).select(
        "conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"),
        F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    again = (nth > 1) & ~F.col("fault").eqNullSafe("blank")
    return slim.withColumn("nth", nth).withColumn("fault", F.when(again, "duplicate").otherwise(F.col("fault"))).drop("nth")


def _symbol(initial: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "d"
    kind = initial if initial in ("s", "u", "a") else "o"
    return kind.upper() if fault == "truncated" else kind


_COUNTS = ["blank", "duplicate", "truncated"]


def _piece(rows: list[tuple]) -> dict:
    """Consecutive rows (turn, initial, fault) of one conversation in short."""
    turns = [t for t, _, _ in rows if t is not None]
    initials = [i for _, i, _ in rows]
    runs = [(s, len(list(same))) for s, same in groupby(_symbol(i, f) for _, i, f in rows)]
    return {"first": initials[0], "last": initials[-1], "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "turns": len(set(turns)), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            **{c: sum(f == c for _, _, f in rows) for c in _COUNTS}, "symbols": [s for s, _ in runs], "lengths": [n for _, n in runs]}


def _joined(left: dict | None, right: dict) -> dict:
    """Two neighbouring pieces of one conversation as one."""
    if left is None:
        return right
    both = {c: left[c] + right[c] for c in (*_COUNTS, "illegal", "turns", "symbols", "lengths")}
    both |= {"first": left["first"], "last": right["last"]}
    both["illegal"] += left["last"] + right["first"] not in LEGAL
    both["turns"] -= left["last_turn"] is not None and left["last_turn"] == right["first_turn"]
    both["first_turn"] = left["first_turn"] if left["first_turn"] is not None else right["first_turn"]
    both["last_turn"] = right["last_turn"] if right["last_turn"] is not None else left["last_turn"]
    at = len(left["symbols"])
    if left["symbols"][-1] == right["symbols"][0]:
        both["symbols"] = both["symbols"][:at] + both["symbols"][at + 1:]
        both["lengths"] = [*left["lengths"][:-1], left["lengths"][-1] + right["lengths"][0], *right["lengths"][1:]]
    return both


def pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, part, piece fields): the runs of each conversation in each range of (conversation, turn)."""
    fields = ["first", "last", "illegal", "turns", "first_turn", "last_turn", *_COUNTS, "symbols", "lengths"]
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, part int, first string, last string, illegal bigint, turns bigint, first_turn bigint,"
              " last_turn bigint, blank bigint, duplicate bigint, truncated bigint, symbols array<string>, lengths array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[dict], ids: pa.Array, part: int) -> pa.RecordBatch:
            types = {"first": pa.string(), "last": pa.string(), "symbols": pa.list_(pa.string()), "lengths": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([part] * len(rows), pa.int32()),
                 *[pa.array([r[f] for r in rows], types.get(f, pa.int64())) for f in fields]], ["conv_id", "part", *fields])

        open_id, opened, part, id_type = None, None, 0, None
        for batch in batches:
            id_type, done = batch.column(0).type, []
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for conv, same in groupby(rows, key=lambda r: r[0]):
                part, here = batch.column(4)[0].as_py(), _piece([r[1:] for r in same])
                if opened is not None and conv != open_id:
                    done.append((open_id, opened))
                    opened = None
                open_id, opened = conv, _joined(opened, here)
            if done:
                yield made([d for _, d in done], pa.array([c for c, _ in done], id_type), part)
        if opened is not None:
            yield made([opened], pa.array([open_id], id_type), part)

    ranged = turns.repartitionByRange("conv_id", *_order()).sortWithinPartitions("conv_id", *_order())
    return ranged.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "initial", "fault",
                         F.spark_partition_id().alias("part")).mapInArrow(run, schema)


def plans(parts: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``ids``."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    fields = [c for c in parts.columns if c != "conv_id"]
    numbers = ["gaps", *_COUNTS, "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in batch.column(1).to_pylist():
                whole = None
                for piece in sorted((p for p in found if p["part"] is not None), key=lambda p: p["part"]):
                    whole = _joined(whole, piece)
                if whole is None:
                    rows.append((*[0] * len(numbers), ""))
                    continue
                cost, audit = cheapest(list(zip(whole["symbols"], whole["lengths"])))
                gaps = whole["last_turn"] - whole["first_turn"] + 1 - whole["turns"] if whole["turns"] else 0
                rows.append((gaps, *[whole[c] for c in _COUNTS], whole["illegal"], cost, audit))
            columns = list(zip(*rows)) or [()] * (len(numbers) + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())],
                ["conv_id", *numbers, "audit"])

    # A piece per range and conversation, so a list is as long as there are ranges at most.
    all_ids = parts.unionByName(ids, allowMissingColumns=True)
    lists = all_ids.groupBy("conv_id").agg(F.collect_list(F.struct(*fields)).alias("pieces"))
    return lists.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{n} bigint' for n in numbers)}, audit string")


class _Repair:
    """The repaired text of one conversation, fed turn by turn."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.rows = audit, 0, START, 0
        self.digest = hashlib.sha256()

    def _line(self, role: bytes, text: bytes) -> None:
        self.digest.update((b"\n" if self.rows else b"") + role + b":")
        self.digest.update(text)
        self.rows += 1

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.state, self.at = TURNED[self.state], self.at + 1
            self._line(ROLE[self.state].encode(), b"")

    def turn(self, role: bytes, text: bytes) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = KEPT[self.state, role[:1].decode()]
            self._line(role, text)
        elif edit == "R":
            self.state = TURNED[self.state]
            self._line(ROLE[self.state].encode(), text)

    def done(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def digests(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's plan, then its turns in order, pass one task as a stream."""
    kind = planned.schema["conv_id"].dataType.simpleString()
    heads = planned.select("conv_id", F.lit(False).alias("is_turn"), F.col("audit").cast("binary").alias("body"))
    rows = _hashed(turns).select("conv_id", F.lit(True).alias("is_turn"), F.col("text").cast("binary").alias("body"), *_ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repair, id_type = None, None, None
        for batch in batches:
            id_type, done = batch.column(0).type, []
            ids, roles = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for i, is_turn in enumerate(batch.column(1).to_pylist()):
                body = batch.column(2)[i].as_py()
                if is_turn:
                    repair.turn(roles[i], body)
                    continue
                if repair is not None:
                    done.append((conv, repair.done()))
                conv, repair = ids[i], _Repair(body.decode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in done], id_type), pa.array([d for _, d in done], pa.string())], ["conv_id", "repaired_sha256"])
        if repair is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], id_type), pa.array([repair.done()], pa.string())],
                                             ["conv_id", "repaired_sha256"])

    both = heads.unionByName(rows, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "is_turn", *_order())
    slim = both.select("conv_id", "is_turn", "body", F.col("role").cast("binary").alias("role"))
    return slim.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repaired(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The cheapest repair of conversations (conv_id, turn, role, text, copy): a row per conversation of ``ids`` or turns.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256). Turns are taken in order,
    nulls first, ties by role and hash of the text. Edits: K keeps a turn (0), R gives it the role user or assistant
    (1), D deletes it (2; a must for blank and repeated turns), I inserts an empty one (5); a kept turn with a cut end
    costs 5 more. They lead to an optional system turn and pairs of user and assistant, or to nothing. Roles count by
    their first letter. Null ids are one conversation; a conversation of ``ids`` without turns has zeros, an empty
    audit and the digest of an empty text; an empty table gives an empty result.
    """
    slim = saved(symbols(turns), "symbols")
    everyone = turns.select("conv_id").distinct() if ids is None else ids
    planned = saved(plans(saved(pieces(slim), "pieces"), everyone), "plans")
    found = digests(turns, planned)
    return planned.join(found.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def damaged_and_repaired(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """:func:`repaired` after :func:`damage`, for every conversation of the table; null roles and texts are one space.

    Damage by crc32 of conv_id:turn (a null is a space there) modulo 20: 0 drops a row, 1 empties its text, 2 removes
    its marks . ! ?, 3 repeats it, 4 makes it the user's. Other columns are not read.
    """
    ids = conversations.select(F.col(conv_id).alias("conv_id")).distinct()
    return repaired(saved(damage(conversations, conv_id, turn, role, text), "damaged"), ids)
