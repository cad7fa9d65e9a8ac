"""Conversation repair against all edit sequences, and pieces against whole conversations."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tierlake.llm import conversations as cv


def brute(initials, fault, extra=4):
    """(cost, audit) over every audit with at most ``extra`` inserts."""
    n, best = len(initials), None
    for size in range(n, n + extra + 1):
        for audit in product("DIKR", repeat=size):
            if sum(x != "I" for x in audit) != n:
                continue
            cost, i, roles = 0, 0, []
            for x in audit:
                if x == "I":
                    cost += 3
                    roles.append("?")
                    continue
                if x == "D":
                    cost += 4
                elif fault[i] in "bd":
                    break
                else:
                    cost += 3 * (x == "R") + 3 * (fault[i] == "t")
                    roles.append(initials[i] if x == "K" else "?")
                i += 1
            else:
                body = roles[1:] if roles[:1] == ["s"] else roles
                fits = all(r in ("?", "ua"[k % 2]) for k, r in enumerate(body)) and len(body) % 2 == 0 and (body or not roles)
                if fits and (best is None or (cost, "".join(audit)) < best):
                    best = (cost, "".join(audit))
    return best


def test_agenda_equals_all_edit_sequences():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4):
        for _ in range(25):
            initials, fault = "".join(rng.choice("suua-a") for _ in range(n)), "".join(rng.choice("---tbd") for _ in range(n))
            ((cost, audit),) = cv.agenda(initials, fault, cv.START, cv.ACCEPTED).values()
            assert (cost, audit) == brute(initials, fault, 4 if n < 4 else 3), (initials, fault)


def test_joined_spans_equal_one_agenda():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 14)
        initials, fault = "".join(rng.choice("suua-a") for _ in range(n)), "".join(rng.choice("---tbd") for _ in range(n))
        cuts = [0, *sorted(rng.sample(range(1, n), min(n - 1, 3))), n]
        parts = [{(q, p): w for q in range(4) for p, w in cv.agenda(initials[a:b], fault[a:b], q, None).items()} for a, b in zip(cuts, cuts[1:])]
        whole = cv._tree(parts)
        for q in range(4):
            assert {p: w for (a, p), w in whole.items() if a == q} == cv.agenda(initials, fault, q, None)


def plain(rows):
    """The contract's columns of each conversation, row by row."""
    by_conv = {}
    for conv, turn, role, text in rows:
        live = by_conv.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        live += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return by_conv


def expected(live, order):
    live = sorted(live, key=lambda r: (r[0] is not None, r[0] or 0, order[r[1], r[2]]))
    seen, fault = set(), ""
    for _, role, text in live:
        bare = re.sub("[ \t\n\x0b\x0c\r]+$", "", text)
        fault += "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
    roles = [r[1] for r in live]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    ((cost, audit),) = cv.agenda("".join(map(cv.initial, roles)), fault, 0, (0, 3)).values()
    out, kept, place = [], [], iter(live)
    for x in audit:
        row = None if x == "I" else next(place)
        if x != "D":
            kept.append((x, row))
    body = 1 if kept and kept[0][0] == "K" and kept[0][1][1][:1] == "s" else 0
    for k, (x, row) in enumerate(kept):
        name = row[1] if x == "K" else ("user", "assistant")[(k - body) % 2]
        out.append(f"{name}:{row[2] if row else ''}")
    known = [r[0] for r in live if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, sha, out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = ["Fine.", "What?", "cut off", "", "  \t\n", None, "Yes!\n", "ä.", "x" * 30_000 + ".", "!\x0b", "..."]
    out = []
    for conv in [None, *range(25)]:
        for turn in range(rng.choice([1, 2, 5, 9, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "sys", "Unknown"])
            out.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), role, rng.choice(texts)))
    out += [(7, t, ["user", "assistant"][t % 2], f"turn {t % 60}.") for t in range(300)]
    return out + out[:3]


@pytest.mark.parametrize("piece_rows", [3, 256])
def test_repair_equals_row_by_row(spark, rows, piece_rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, piece long, Text string")
    repair = cv.Repair(cv.damaged(table.repartition(3)), piece_rows=piece_rows)
    damaged = cv.damaged(table).selectExpr("role", "text", "xxhash64(role, text) as h").distinct().collect()
    order = {(r.role, r.text): r.h for r in damaged}
    want = {conv: expected(live, order) for conv, live in plain(rows).items()}
    got = repair.summary().collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: w[:-1] for c, w in want.items()} and len(got) == len(want)
    assert (repair.pieces.where("edge").count() > 100) == (piece_rows == 3)
    lines = {}
    for r in sorted(repair.turns().collect(), key=lambda r: (r.piece, r.at)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}


def test_dropped_and_empty(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = cv.Repair(cv.damaged(table)).summary().collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert cv.Repair(cv.damaged(table.limit(0))).summary().count() == 0
