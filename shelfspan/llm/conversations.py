"""Repair of the structure of conversations by iterative-deepening A*.

A conversation must read ``(s?(ua)+)?`` in the initials of its roles: perhaps a
system row, then user and assistant in turn, or nothing. Rows may be kept,
given another role, deleted, and empty rows inserted. A depth-first search
tries the edits of a row in ASCII order (Delete, Insert, Keep, Rerole) as long
as the cost so far and the least cost of what is left stay within a bound; the
bound then rises to the least total that went beyond it. A transposition table
holds states that failed, with the slack they had. The first path that arrives
is the cheapest, and of these the least in ASCII order.

The least cost of what is left is that of the rows from there on if the role
before them could be chosen, which never exceeds the true one and differs from
it by a few edits however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspan.llm.blobs import groups
from shelfspan.session import settle

DELETE, INSERT, KEEP, REROLE, TRUNCATED = 4, 3, 0, 3, 3
FORMS = 20
#: What a row is: a bit for the fault that matters, and the initial of its role.
USER, ASSISTANT, SYSTEM, OTHER = range(4)
GONE, CUT, BLANK = 4, 8, 16
# States of the grammar: nothing yet, behind system, behind user, behind assistant; the last two columns say what Keep makes of s.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: The role a state waits for, and the state behind it.
WANTS = (USER, USER, ASSISTANT, USER)
THEN = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
NAMES = ("user", "assistant")
FAR = 1 << 60


def keep_state(state: int, role: int) -> int:
    """The state behind a kept row, or -1."""
    if role == WANTS[state]:
        return THEN[state]
    return AFTER_SYSTEM if role == SYSTEM and state == START else -1


KEEP_STATE = tuple(tuple(keep_state(state, role) for role in range(4)) for state in range(4))


def estimates(rows: bytes) -> np.ndarray:
    """For each place, the least cost of the rows from there on over all states the search may be in."""
    n = len(rows)
    least = np.zeros(n + 1, np.int64)
    # Costs to the end from each state, only of the place at hand. Insertions: one step and two steps of the grammar.
    now = [0, 2 * INSERT, INSERT, 0]
    for at in range(n - 1, -1, -1):
        row = rows[at]
        role, extra = row & 3, TRUNCATED if row & CUT else 0
        own = []
        for state in range(4):
            cost = now[state] + DELETE
            if not row & GONE:
                kept = KEEP_STATE[state][role]
                if kept >= 0:
                    cost = min(cost, now[kept] + KEEP + extra)
                cost = min(cost, now[THEN[state]] + REROLE + extra)
            own.append(cost)
        own[AFTER_USER] = min(own[AFTER_USER], own[AFTER_ASSISTANT] + INSERT)
        user = own[AFTER_USER] + INSERT
        own = [min(own[START], user), min(own[AFTER_SYSTEM], user), own[AFTER_USER], min(own[AFTER_ASSISTANT], user)]
        own[AFTER_USER] = min(own[AFTER_USER], own[AFTER_ASSISTANT] + INSERT)
        now = own
        least[at] = min(now)
    return least


def search(rows: bytes) -> tuple[int, str]:
    """Cost and initials of the edits that repair a conversation."""
    n = len(rows)
    least = estimates(rows).tolist()
    bound = least[0]
    while True:
        beyond = FAR
        failed: dict[int, int] = {}
        # A frame: place, state, cost so far, next edit to try. The path holds one initial for each frame but the first.
        places, states, costs, tries, path = [0], [START], [0], [0], []
        while places:
            at, state, cost, edit = places[-1], states[-1], costs[-1], tries[-1]
            if edit == 0:
                if at == n and state in (START, AFTER_ASSISTANT):
                    return cost, "".join(path)
                # Less or equal slack than a failed visit fails too.
                if failed.get(at * 4 + state, -1) >= bound - cost:
                    edit = 4
            row = rows[at] if at < n else GONE
            step = None
            while edit < 4 and step is None:
                if edit == 0:
                    if at < n:
                        step = (at + 1, state, cost + DELETE, "D")
                elif edit == 1:
                    step = (at, THEN[state], cost + INSERT, "I")
                elif not row & GONE:
                    extra = TRUNCATED if row & CUT else 0
                    if edit == 3:
                        step = (at + 1, THEN[state], cost + REROLE + extra, "R")
                    elif (kept := KEEP_STATE[state][row & 3]) >= 0:
                        step = (at + 1, kept, cost + KEEP + extra, "K")
                edit += 1
                if step is not None and step[2] + least[step[0]] > bound:
                    beyond = min(beyond, step[2] + least[step[0]])
                    step = None
            if step is None:
                key = at * 4 + state
                failed[key] = max(failed.get(key, -1), bound - cost)
                places.pop(), states.pop(), costs.pop(), tries.pop()
                if path:
                    path.pop()
                continue
            tries[-1] = edit
            places.append(step[0]), states.append(step[1]), costs.append(step[2]), tries.append(0), path.append(step[3])
        bound = beyond


def damage(rows: DataFrame, forms: int = FORMS) -> DataFrame:
    """``conv_id, turn, role, text, copy`` after damage chosen by the crc32 of ``conv_id:turn`` modulo ``forms``.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    row (``copy`` 1), 4 gives it the role user. Null roles and texts are one
    space, as are null ids and turns inside the checksum.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    form = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(forms))
    marked = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), form.alias("_form")).where("_form <> 0")
    text = F.when(F.col("_form") == 1, "").when(F.col("_form") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_form") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_form") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def symbol_of(role: Column, text: Column) -> Column:
    """The row's role and faults but repeats, as a number below 32."""
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "u", USER).when(initial == "a", ASSISTANT).when(initial == "s", SYSTEM).otherwise(OTHER)
    bare = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(F.length(bare) == 0, GONE + BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(CUT)
    return (kind + fault).cast("int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[list[np.ndarray]]]]:
    """Each conversation of sorted rows ``key, conv_id, ...`` and its other columns, as arrays in pieces."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0)
        # Null ids are one conversation; the flag tells them from every number.
        ids = conv.fill_null(0).to_numpy(zero_copy_only=False)
        null = conv.is_null().to_numpy(zero_copy_only=False)
        cuts = [*np.union1d(groups(ids), groups(null)).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            name = None if null[a] else int(ids[a])
            if held and name != now:
                yield now, held
                held = []
            now = name
            held.append([c.slice(a, b - a) for c in batch.columns[1:]])
    if held:
        yield now, held


def _whole(held: list, place: int) -> pa.Array:
    return pa.concat_arrays([h[place] for h in held])


AUDITS = "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of sorted rows ``conv_id, turn, symbol, content``; a conversation takes some bytes a row, no texts."""
    names = [c.split()[0] for c in AUDITS.split(", ")]
    types = [pa.int64()] * 8 + [pa.string()]
    known: dict[bytes, tuple[int, str]] = {}
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        out.clear()
        return batch

    for conv, held in _runs(batches):
        turns = _whole(held, 0).drop_null().to_numpy(zero_copy_only=False)
        symbols = _whole(held, 1).to_numpy(zero_copy_only=False).astype(np.uint8)
        contents = _whole(held, 2).to_pylist()
        seen: set[bytes] = set()
        blank = (symbols & BLANK) > 0
        again = np.zeros(len(symbols), bool)
        for i, content in enumerate(contents):
            again[i] = content in seen
            seen.add(content)
        again &= ~blank
        truncated = ((symbols & CUT) > 0) & ~again
        roles = symbols & 3
        legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
        illegal = sum((a, b) not in legal for a, b in zip(roles[:-1].tolist(), roles[1:].tolist(), strict=True))
        rows = (roles | np.where(blank | again, GONE, 0) | np.where(truncated, CUT, 0)).astype(np.uint8).tobytes()
        if rows in known:
            cost, path = known[rows]
        else:
            cost, path = search(rows)
            if len(rows) <= 16 and len(known) < 100_000:  # short conversations look alike
                known[rows] = cost, path
        distinct = int((turns[1:] != turns[:-1]).sum()) + 1 if len(turns) else 0
        gaps = int(turns[-1]) - int(turns[0]) + 1 - distinct if len(turns) else 0
        out.append((conv, len(rows), min(gaps, (1 << 63) - 1), int(blank.sum()), int(again.sum()), int(truncated.sum()), illegal, cost, path))
        if len(out) >= 2000 or len(path) > 100_000:
            yield flush()
    if out:
        yield flush()


def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of repaired conversations: sorted rows ``conv_id, audit, role, text``, the audit first; texts stream through."""
    out: list[tuple] = []
    state = {"conv": None, "open": False}

    def close() -> None:
        if state["open"]:
            _edit(state, None, None)
            out.append((state["conv"], state["hash"].hexdigest()))
            state["open"] = False

    for batch in batches:
        for conv, audit, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if audit is not None:
                close()
                state.update(conv=conv, open=True, audit=audit, at=0, state=START, hash=hashlib.sha256(), empty=True)
            else:
                _edit(state, role, text)
        if out:
            yield _hashes(out)
    close()
    if out:
        yield _hashes(out)


def _hashes(out: list[tuple]) -> pa.RecordBatch:
    conv, digest = zip(*out, strict=True)
    out.clear()
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(digest, pa.string())], ["conv_id", "repaired_sha256"])


def _edit(state: dict, role: str | None, text: str | None) -> None:
    """Write the insertions before a row and what its own edit makes of it; without a role, the insertions at the end."""

    def write(line: str) -> None:
        state["hash"].update((line if state["empty"] else "\n" + line).encode())
        state["empty"] = False

    audit = state["audit"]
    while state["at"] < len(audit):
        edit, now = audit[state["at"]], state["state"]
        if edit != "I" and role is None:
            break
        state["at"] += 1
        if edit == "I":
            write(NAMES[WANTS[now]] + ":")
            state["state"] = THEN[now]
            continue
        if edit == "R":
            write(f"{NAMES[WANTS[now]]}:{text}")
            state["state"] = THEN[now]
        elif edit == "K":
            write(f"{role}:{text}")
            state["state"] = AFTER_SYSTEM if role[:1] == "s" else THEN[now]
        break


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of all ``conversations (conv_id)``.

    ``rows (conv_id, turn, role, text, copy)`` are taken by turn, nulls first;
    rows of one turn by the MD5 of role and text, then copy. Null roles and texts
    are one space. Rows of a null conv_id are one conversation. Roles are told by their first character; other ones than
    system, user and assistant can't be kept. Conversations without rows have
    zeros, an empty audit and the hash of the empty string.

    What a search needs of a row is a symbol and an MD5, so the rows of a
    conversation meet without their texts first; texts then stream past the
    edits. One conversation is worked on by one task, as its hash demands.
    """
    by = F.coalesce("conv_id", F.lit(-1))
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], "copy")
    content = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    # The order of rows of one turn, without carrying their texts.
    tied = F.md5(F.concat("role", F.lit("\n"), "text").cast("binary"))
    small = rows.select("conv_id", "turn", symbol_of(F.col("role"), F.col("text")).alias("symbol"), F.unhex(content).alias("content"), F.unhex(tied).alias("tied"), "copy")
    sorted_small = small.repartition(by).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "tied", "copy")
    audits = settle(sorted_small.select("conv_id", "turn", "symbol", "content").mapInArrow(audit_batches, AUDITS), "audits")
    none = F.lit(None).cast("string")
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("tied"), F.lit(0).alias("copy"), "audit", none.alias("role"), none.alias("text"))
    lines = rows.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), F.unhex(tied).alias("tied"), F.col("copy").cast("int").alias("copy"), none.alias("audit"), "role", "text")
    both = heads.unionByName(lines).repartition(by).sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "tied", "copy")
    hashes = both.select("conv_id", "audit", "role", "text").mapInArrow(hash_batches, "conv_id long, repaired_sha256 string")
    done = audits.withColumnRenamed("conv_id", "_conv").join(hashes.withColumnRenamed("conv_id", "_same"), F.col("_conv").eqNullSafe(F.col("_same")))
    every = conversations.select("conv_id").distinct()
    joined = every.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
