"""Conversation repair against a plain shortest path over the grammar."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from delaylens.llm import conversation_repair as C
from delaylens.llm import turn_alignment as T

NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
AFTER = {"s": 1, "u": 2, "a": 3}
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(signs):
    """(cost, audit) by a search over (turn, state) in order of cost and audit."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(signs) and state in (0, 3):
            return cost, audit
        for c in NEXT[state]:
            if c != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, AFTER[c]))
        if i < len(signs):
            x = signs[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            for c in NEXT[state] if x != "D" else "":
                extra = 3 if x.isupper() else 0
                if x.lower() == c:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, AFTER[c]))
                elif c != "s":
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, AFTER[c]))


def plain(rows):
    """conv_id -> the report's row, from all rows of the table."""
    kept = {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, signs, faults = set(), "", ""
        for _, role, text in own:
            stripped = text.strip(" \t\n\v\f\r")
            fault = "B" if not stripped else "D" if (role, text) in seen else "T" if stripped[-1] not in ".!?" else "-"
            seen.add((role, text))
            faults += fault
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            signs += "D" if fault in "BD" else kind.upper() if fault == "T" else kind
        cost, audit = cheapest(signs)
        turns = {t for t, _, _ in own if t is not None}
        made, state, left = [], 0, iter(own)
        n = len(audit) - audit.count("D")
        goal = iter(("s" if n % 2 else "") + "ua" * (n // 2))
        for e in audit:
            _, role, text = next(left) if e != "I" else (None, "", "")
            if e != "D":
                c = next(goal)
                made.append((role if e == "K" else {"u": "user", "a": "assistant"}[c]) + ":" + text)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("B"), faults.count("D"), faults.count("T"),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                     hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 8, 40])):
            role = "system" if not turn and rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            role = rng.choice(["tool", "", None, "system", role]) if rng.random() < 0.1 else role
            text = rng.choice(["Yes.", "yes", " \t\n", None, "A b c!", "Why?\n", f"long {turn} ü."])
            rows.append((conv, None if rng.random() < 0.04 else turn * rng.choice([1, 1, 1, 2]), role, text))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("alphabet", ["suaUAxSD", "suauauauaUAD", "D", "x"])
def test_alignment_is_the_cheapest_and_ascii_least(alphabet):
    rng = random.Random(alphabet)
    for _ in range(400):
        signs = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 9, 20, 45])))
        assert T.repair(signs) == cheapest(signs), signs


@pytest.mark.parametrize("whole, run", [(20_000, 1024), (3, 4)])
def test_report_against_plain_python(spark, whole, run):
    """With tiny limits most conversations take the path of those that lie over several tasks."""
    rows = conversations(5, 120)
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("text", "Text").selectExpr("*", "1 AS part", "'x' AS audit")
    frame = frame.withColumnRenamed("Text", "text")
    got = {r[0]: tuple(r)[1:] for r in C.repair_report(frame, C.damage(frame), whole, run).collect()}
    assert got == plain(rows)


def test_one_conversation_over_all_tasks(spark):
    rng = random.Random(2)
    rows = [(7, t, ["user", "assistant"][t % 2], rng.choice(["So.", f"turn {t}", f"Turn {t}!"])) for t in range(3000)]
    rows += [(8, 1, "user", "Same.")] * 500
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in C.repair_report(frame, C.damage(frame)).collect()}
    assert got == plain(rows)


def test_turns_are_well_formed_rows(spark):
    rows = conversations(9, 40)
    done = C.repair(spark.createDataFrame(rows, SCHEMA))
    by_conv = {}
    for r in sorted(done.turns.collect(), key=lambda r: (r["part"], r["seq"])):
        by_conv.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert by_conv and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by_conv.values())


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(frame, C.damage(frame)).count() == 0
