"""The repair of conversations against exhaustive search and a plain Python version of the whole query."""

import hashlib
import itertools
import random
import zlib

from shelfspan.llm import conversations as c
from shelfspan.llm.queries import op13_conversation_repair


def plain(rows):
    """Cheapest edits by dynamic programming over (cost, edits), least in ASCII order: rows of (initial, gone, cut)."""
    then = {"start": ("u", "U"), "S": ("u", "U"), "U": ("a", "A"), "A": ("u", "U")}

    def offer(best, state, cost, path):
        if state not in best or (cost, path) < best[state]:
            best[state] = (cost, path)

    def insert(best):
        for _ in range(4):
            for state, (cost, path) in list(best.items()):
                offer(best, then[state][1], cost + 3, path + "I")

    best = {"start": (0, "")}
    for initial, gone, cut in rows:
        insert(best)
        after = {}
        for state, (cost, path) in best.items():
            offer(after, state, cost + 4, path + "D")
            if gone:
                continue
            extra = 3 if cut else 0
            offer(after, then[state][1], cost + 3 + extra, path + "R")
            if initial == then[state][0]:
                offer(after, then[state][1], cost + extra, path + "K")
            elif initial == "s" and state == "start":
                offer(after, "S", cost + extra, path + "K")
        best = after
    insert(best)
    return min(best[s] for s in ("start", "A") if s in best)


def as_bytes(rows):
    kinds = {"u": c.USER, "a": c.ASSISTANT, "s": c.SYSTEM}
    return bytes(kinds.get(i, c.OTHER) | (c.GONE if gone else 0) | (c.CUT if cut else 0) for i, gone, cut in rows)


def test_search_equals_dynamic_programming():
    kinds = [(i, g, t) for i in "uasx" for g, t in ((False, False), (True, False), (False, True))]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert c.search(as_bytes(rows)) == plain(rows), rows
    dice = random.Random(3)
    for n in (5, 9, 30, 400, 3000):
        for _ in range(20 if n < 100 else 2):
            rows = [(dice.choice("uuuaaasx"), dice.random() < 0.1, dice.random() < 0.2) for _ in range(n)]
            assert c.search(as_bytes(rows)) == plain(rows)


def test_first_bound_is_raised_and_never_too_high():
    rows = as_bytes([("a", False, False), ("u", False, False)])
    assert c.estimates(rows)[0] < c.search(rows)[0]


def brute(rows):
    """The whole query in plain Python for rows of (conv_id, turn, role, text)."""
    space = lambda v: " " if v is None else str(v)
    md5 = lambda role, text: hashlib.md5(f"{role}\n{text}".encode()).digest()
    out, convs = [], {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        form = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if form == 0:
            continue
        if form == 1:
            text = ""
        if form == 2:
            text = "".join(ch for ch in text if ch not in ".!?")
        if form == 4:
            role = "user"
        held += [(turn is not None, turn or 0, md5(role, text), turn, role, text)] * (2 if form == 3 else 1)
    for conv, held in convs.items():
        held.sort(key=lambda r: r[:3])
        seen, faults, marks = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for *_, role, text in held:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            marks.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, path = plain(marks) if marks else (0, "")
        lines, at, state = [], 0, 0
        for edit in path:
            expected = ("user", "user", "assistant", "user")[state]
            if edit == "I":
                lines.append(f"{expected}:")
            else:
                role, text = held[at][4:]
                at += 1
                if edit == "D":
                    continue
                if edit == "K" and role[:1] == "s":
                    lines.append(f"{role}:{text}")
                    state = 1
                    continue
                lines.append(f"{role if edit == 'K' else expected}:{text}")
            state = 3 if expected == "assistant" else 2
        turns = [r[3] for r in held if r[3] is not None]
        roles = [r[4][:1] for r in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, len(held), gaps, *faults.values(), illegal, cost, path, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_on_whole_tables(spark):
    for scale in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{scale}"
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert result(op13_conversation_repair(spark, folder)) == brute(rows)


def test_nulls_ties_repeats_long_and_clashing_columns(spark):
    dice = random.Random(5)
    rows = [(None, t, dice.choice(["user", "assistant", None, ""]), dice.choice(["Yes.", None, "", "so", "\t"])) for t in (*range(30), None, None, 3, 3)]
    rows += [(i % 9, dice.choice([None, *range(12)]), dice.choice(["system", "user", "assistant", "tool"]), dice.choice(["a.", "b!", "c", "é?  ", "x" * 2_000_000 + "."])) for i in range(150)]
    rows += [(70, t, "user" if t % 2 == 0 else "assistant", f"row {t}.") for t in range(2000)] + [(-(1 << 62), 1 << 62, "user", "one."), (-(1 << 62), -(1 << 62), "user", "two.")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, copy int, audit string")
    assert result(c.repair(c.damage(df), df.select("conv_id"))) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.repair(c.damage(df), df.select("conv_id")).collect() == []
