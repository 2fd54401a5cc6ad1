"""Conversation repair: against brute force over every edit, and long runs."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from jobtide.llm.conversations import before, cheapest, damaged_and_repaired, repaired, transition

SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_repair(rows):
    """(cost, audit, lines) of (role, text, fault) rows: all edits, by state, cheapest and then least."""
    user, assistant = ("user", 2), ("assistant", 3)
    turned = {0: user, 1: user, 2: assistant, 3: user}
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(found):
        grown = dict(found)
        for _ in range(3):
            for state, (cost, audit, lines) in list(grown.items()):
                role, to = turned[state]
                offer = (cost + 5, audit + "I", (*lines, f"{role}:"))
                if to not in grown or offer < grown[to]:
                    grown[to] = offer
        return grown

    found = {0: (0, "", ())}
    for role, text, fault in rows:
        after = defaultdict(list)
        for state, (cost, audit, lines) in inserted(found).items():
            after[state].append((cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                cut = 5 * (fault == "truncated")
                if (state, role[:1]) in kept:
                    after[kept[state, role[:1]]].append((cost + cut, audit + "K", (*lines, f"{role}:{text}")))
                new, to = turned[state]
                after[to].append((cost + 1 + cut, audit + "R", (*lines, f"{new}:{text}")))
        found = {state: min(offers) for state, offers in after.items()}
    done = inserted(found)
    return min(done[s] for s in (0, 3) if s in done)


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        said = text.rstrip(SPACE)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def brute(conversations):
    ids, kept = set(), defaultdict(list)
    for conv, turn, role, text in conversations:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
        role = "user" if hit == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    want = {}
    for conv in ids:
        rows = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in rows if t is not None]
        faulty = faults([r[1:] for r in rows])
        cost, audit, lines = brute_repair(faulty)
        count = lambda kind: sum(f == kind for _, _, f in faulty)
        want[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"),
                      count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
                      cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


def results(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                        "repaired_sha256").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def made_up(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t\x0b", "Why?  ", "é… 😀", "Yes.", None, "a.b", "so long"]
    rows = []
    for conv in [*range(60), None]:
        turn = draw.choice([0, 5, -3])
        for _ in range(draw.randint(1, 14)):
            turn += draw.choice([1, 1, 1, 2, 4])
            rows.append((conv, turn, draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Über"]), draw.choice(texts)))
        if draw.random() < 0.2:
            rows.append((conv, None, "user", "first?"))
    draw.shuffle(rows)
    return rows


def test_repair_matches_brute_force(spark):
    rows = made_up(4)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{TURNS}, audit string, copy int").repartition(5)
    got = results(damaged_and_repaired(df))
    assert got == brute(rows)
    assert all(any(edit in r[6] for r in got.values()) for edit in "KRD")  # an insertion never beats a deletion
    assert results(damaged_and_repaired(df.limit(0))) == {}


def test_dropped_conversations_stay(spark):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = results(damaged_and_repaired(spark.createDataFrame([(conv, 0, "user", "Hi.")], TURNS)))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_turn_by_turn(seed):
    draw = random.Random(seed)
    names = {"d": ("user", "blank"), **{k: (r, None) for k, r in zip("suao", ("system", "user", "assistant", "tool"))},
             **{k.upper(): (r, "truncated") for k, r in zip("suao", ("system", "user", "assistant", "tool"))}}
    for _ in range(300):
        runs = [(draw.choice("dsuaoSUAO"), draw.choice([1, 1, 2, 3, 7])) for _ in range(draw.randint(0, 6))]
        rows = [(names[s][0], "x", names[s][1]) for s, n in runs for _ in range(n)]
        cost, audit, _ = brute_repair(rows)
        assert cheapest(runs) == (cost, audit)


def test_powers_equal_single_steps():
    for symbol in "dsuaoSUAO":
        costs = [(0, 10, 5, 0)]
        for _ in range(1000):
            costs.append(tuple(min(row[j] + costs[-1][j] for j in range(4)) for row in transition(symbol)))
        assert all(before(symbol, n, costs[0]) == costs[n] for n in (0, 1, 2, 3, 255, 256, 257, 999, 1000))


def test_a_long_conversation_in_many_ranges(spark):
    rows = [(7, i // 2, ("user", "assistant", "user")[i % 3], f"Say {i}." if i % 5 else f"say {i}") for i in range(3000)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{TURNS}, copy int").repartition(7)
    got = results(repaired(df))
    order = sorted((r for r in rows if r[0] == 7), key=lambda r: r[1:3])
    assert got[8] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest())
    assert got[7][:5] == (0, 0, 0, 600, sum(a[2][0] + b[2][0] not in ("su", "ua", "au") for a, b in itertools.pairwise(order)))
    by_hand = brute_repair(faults([r[2:] for r in order]))
    assert got[7][5] == by_hand[0]  # ties of a turn go by hash, which leaves the cost here
    assert len(got[7][6].replace("I", "")) == 3000


def test_ranges_are_merged(spark):
    """A conversation over several ranges gives what one range gives."""
    rows = [(1, i, "user" if i % 7 else "assistant", f"t{i // 40}.") for i in range(400)]
    df = spark.createDataFrame([(*r, 0) for r in rows], f"{TURNS}, copy int")
    wide = results(repaired(df))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert results(repaired(df)) == wide
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    cost, audit, lines = brute_repair(faults([r[2:] for r in rows]))
    assert wide[1][5:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
