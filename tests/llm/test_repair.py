"""Conversation repair against all edit scripts and a plain reading of the rules."""

import hashlib
import random
import re
import zlib

import pytest
from helpers import SMALL

from dimledger.llm import repair

VALID = re.compile(r"(s?(ua)+)?")
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def every_audit(codes):
    """(cost, audit) of the cheapest edits by trying all paths, bounded by deleting every row."""
    best = (4 * len(codes), "D" * len(codes))

    def walk(row, made, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if row == len(codes) and VALID.fullmatch(made):
            best = min(best, (cost, audit))
        if row < len(codes):
            letter, fault = "sua?"[codes[row] // 4], codes[row] % 4
            walk(row + 1, made, cost + 4, audit + "D")
            if fault >= 2:
                more = 3 if fault == 2 else 0
                walk(row + 1, made + letter, cost + more, audit + "K")
                for to in "ua":
                    walk(row + 1, made + to, cost + more + 3, audit + "R")
        for to in "ua":
            walk(row, made + to, cost + 3, audit + "I")

    walk(0, "", 0, "")
    return best


def test_cheapest_and_least_audit_by_all_paths():
    rng = random.Random(3)
    for n in (0, 1, 1, 2, 2, 3, 3, 4, 4, 4, 4, 4):
        for _ in range(6):
            codes = bytes(4 * rng.randrange(4) + rng.choice((0, 1, 2, 3, 3, 3)) for _ in range(n))
            assert repair.repair(codes) == every_audit(codes), list(codes)


def states_table(codes):
    """(cost, audit) by a table over rows and states, for longer conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "p", ("p", "u"): "u"}
    turn = {"": "u", "s": "u", "u": "p", "p": "u"}

    def closed(table):
        for _ in range(3):
            for q, (cost, audit) in list(table.items()):
                to = turn[q]
                table[to] = min(table.get(to, (10 ** 9, "")), (cost + 3, audit + "I"))
        return table

    table = closed({"": (0, "")})
    for code in codes:
        letter, fault = "sua?"[code // 4], code % 4
        made = {}
        for q, (cost, audit) in table.items():
            options = [(q, cost + 4, "D")]
            if fault >= 2:
                more = 3 if fault == 2 else 0
                options.append((turn[q], cost + 3 + more, "R"))
                if (q, letter) in step:
                    options.append((step[q, letter], cost + more, "K"))
            for to, c, edit in options:
                made[to] = min(made.get(to, (10 ** 9, "")), (c, audit + edit))
        table = closed(made)
    return min(table[q] for q in ("", "p") if q in table)


def test_long_conversations_by_a_table():
    rng = random.Random(5)
    for n in (7, 12, 40, 150):
        for _ in range(15):
            codes = bytes(4 * rng.choice((0, 1, 1, 2, 2, 3)) + rng.choice((0, 1, 2, 3, 3, 3, 3)) for _ in range(n))
            assert repair.repair(codes) == states_table(codes), list(codes)


def by_hand(rows):
    """What the contract says of (conv_id, turn, role, text) rows, in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        out = convs.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    result = {}
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, seen = [], set()
        for _, role, text in out:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            seen.add((role, text))
            codes.append(4 * ("sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3) + fault)
        turns = [t for t, _, _ in out if t is not None]
        letters = ["sua?"[c // 4] for c in codes]
        cost, audit = states_table(bytes(codes))
        lines, state, left = [], "", list(out)
        turn = {"": "u", "s": "u", "u": "p", "p": "u"}
        for edit in audit:
            row = None if edit == "I" else left.pop(0)
            if edit == "D":
                continue
            if edit == "K":
                lines.append(f"{row[1]}:{row[2]}")
                state = {"s": "s", "u": "u", "a": "p"}[row[1][0]]
            else:
                lines.append(f"{'assistant' if state == 'u' else 'user'}:{row[2] if row else ''}")
                state = turn[state]
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            sum(c % 4 == 0 for c in codes), sum(c % 4 == 1 for c in codes), sum(c % 4 == 2 for c in codes),
            sum("".join(p) not in ("su", "ua", "au") for p in zip(letters, letters[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def run(spark, folder):
    got = repair.op13_conversation_repair(spark, folder).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}


def test_whole_table_by_hand(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, SMALL) == by_hand(rows)


@pytest.mark.parametrize("empty", [False, True])
def test_nulls_ties_blanks_and_long_conversations(spark, scratch, empty):
    rng = random.Random(9)
    texts = [None, "", " \n", "Yes.", "Yes", "no?  ", "x" * 50_000 + "!", "ünï."]
    roles = [None, "", "user", "assistant", "system", "tool"]
    rows = [(conv, rng.choice([None, t, t, t % 7]), rng.choice(roles), rng.choice(texts))
            for conv, n in ((1, 9), (2, 1), (3, 40), (None, 12), (4, 3)) for t in range(n)]
    rows += [(7, t, ("user", "assistant")[t % 2], f"turn {t % 400}.") for t in range(3000)]
    rows += [(8, 10 ** 6, "user", "far."), (8, 0, "assistant", "near.")]
    rows += [(k, 0, "user", "alone.") for k in range(100, 160)]              # some lose their only row
    df = spark.createDataFrame([] if empty else rows, "conv_id long, turn long, role string, text string")
    df.selectExpr("*", "'x' AS place", "'x' AS code", "'x' AS kind", "'x' AS digest").write.parquet(
        f"{scratch}/conversations.parquet")
    assert run(spark, scratch) == ({} if empty else by_hand(rows))
