"""Conversation structure repair: the cheapest edits that make a conversation well formed.

Rows are damaged and their faults found with DataFrame expressions; each conversation is then
repaired by a dynamic programme over (row, state of the grammar ``(s?(ua)+)?``). The backward cost
vectors are kept only at every ``ceil(sqrt(n))``-th row; walking forward, each block's vectors are
computed again from the checkpoint at its end, so a conversation of n rows needs O(sqrt(n)) cost
vectors besides its rows. The walk takes, at each step, the ASCII-least edit that stays on a
cheapest path, which gives the ASCII-least cheapest edit string.
"""

import hashlib
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANK, DUPLICATE, TRUNC = 1, 2, 3
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
INF = 1 << 60
SPACE = "[\\x20\\x09-\\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, with their order and first fault, and the dropped ones marked.

    Nulls in role and text are one space, and so are null conv_id and turn in the key
    ``conv_id:turn`` whose crc32 mod 20 picks the damage: 0 drops the row, 1 empties the text,
    2 removes ``.``, ``!`` and ``?``, 3 repeats the row, 4 makes it a user row. Dropped rows are kept
    with ``dropped`` true, so that every conversation is reported. Order: turn (nulls first), then
    role, text and copy, so equal rows are adjacent and their order does not matter.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id"), F.col("turn"), d.alias("damage"),
        F.when(d == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(d == 1, F.lit("")).when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    # one shuffle: every window below is clustered by conv_id already
    rows = rows.withColumn("dropped", F.col("damage") == 0).repartition("conv_id")
    live = Window.partitionBy("conv_id", "dropped")
    order = live.orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    last = F.regexp_extract("text", f"([^\\x20\\x09-\\x0D]){SPACE}*\\z", 1)
    seen = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(
        F.col("turn").asc_nulls_first(), "copy"))
    fault = (F.when(~F.col("text").rlike("[^\\x20\\x09-\\x0D]"), BLANK).when(seen > 1, DUPLICATE)
             .when(~last.isin(".", "!", "?"), TRUNC).otherwise(0))
    return rows.select("conv_id", "turn", "role", "text", "dropped",
                       F.row_number().over(order).alias("pos"), fault.alias("fault"))


def _moves(initial: str, fault: int, state: int):
    """(letter, cost, next state) of the edits of one row from ``state``, in ASCII order of letters."""
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED if fault == TRUNC else 0
    want = ASSISTANT if state == USER else USER
    if state == START and initial == "s":
        out.append(("K", KEEP + extra, SYSTEM))
    elif (want == USER and initial == "u") or (want == ASSISTANT and initial == "a"):
        out.append(("K", KEEP + extra, want))
    out.append(("R", REROLE + extra, want))
    return out


def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _closed(b: list) -> list:
    """Let empty user or assistant rows be inserted before going on (costs are positive)."""
    for _ in range(4):
        b = [min(b[s], INSERT + b[_inserted(s)]) for s in range(4)]
    return b


def _back(row, after: list) -> list:
    initial, fault = row
    return _closed([min(cost + after[nxt] for _, cost, nxt in _moves(initial, fault, s)) for s in range(4)])


def repair(rows: list) -> tuple[int, str, list]:
    """Cheapest cost, ASCII-least edit letters and the repaired (role, text) rows.

    ``rows``: (role, text, fault) in order. Letters: D delete, I insert, K keep, R rerole.
    """
    n = len(rows)
    marks = [(r[0][:1], r[2]) for r in rows]
    end = _closed([0 if s in FINAL else INF for s in range(4)])
    step = max(1, math.isqrt(max(n - 1, 0)) + 1)
    saved = {n: end}
    b = end
    for i in range(n - 1, -1, -1):
        b = _back(marks[i], b)
        if i % step == 0:
            saved[i] = b
    cost = saved[0][START]
    letters, out, state = [], [], START
    for block in range(0, n, step):
        stop = min(n, block + step)
        vectors = [None] * (stop - block + 1)
        vectors[-1] = saved[stop]
        for i in range(stop - 1, block - 1, -1):
            vectors[i - block] = _back(marks[i], vectors[i - block + 1])
        for i in range(block, stop):
            here, after = vectors[i - block], vectors[i - block + 1]
            while True:
                options = [(m, c, nxt) for m, c, nxt in _moves(*marks[i], state) if c + after[nxt] == here[state]]
                ins = _inserted(state)
                if INSERT + here[ins] == here[state]:
                    options.append(("I", INSERT, ins))
                letter, _, nxt = min(options)
                letters.append(letter)
                if letter == "I":
                    out.append(("user" if nxt == USER else "assistant", ""))
                    state = nxt
                    continue
                if letter == "K":
                    out.append((rows[i][0], rows[i][1]))
                elif letter == "R":
                    out.append(("user" if nxt == USER else "assistant", rows[i][1]))
                state = nxt
                break
    while state not in FINAL:
        state = _inserted(state)
        letters.append("I")
        out.append(("user" if state == USER else "assistant", ""))
    return cost, "".join(letters), out


def _illegal(initials: list) -> int:
    return sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au"))


SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def _gaps_of(turns: list) -> int:
    t = [x for x in turns if x is not None]
    return max(t) - min(t) + 1 - len(set(t)) if t else 0


def _result(conv, rows: list) -> tuple:
    """rows: (turn, role, text, fault) of the live rows of one conversation, in order."""
    cost, audit, out = repair([(r, t, f) for _, r, t, f in rows])
    faults = [f for *_, f in rows]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (conv, _gaps_of([t for t, *_ in rows]), faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNC),
            _illegal([r[:1] for _, r, _, _ in rows]), cost, audit, digest)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _stream(batches):
    """Conversations in a partition sorted by conv_id; one may go on into the next batch."""
    conv, rows, seen = None, [], False
    for pdf in batches:
        out = []
        ids = [None if pd.isna(x) else int(x) for x in pdf["conv_id"]]
        turns = [None if pd.isna(x) else int(x) for x in pdf["turn"]]
        for c, turn, role, text, dropped, fault in zip(ids, turns, pdf["role"], pdf["text"], pdf["dropped"],
                                                        pdf["fault"]):
            if seen and c != conv:
                out.append(_result(conv, rows))
                rows = []
            conv, seen = c, True
            if not dropped:
                rows.append((turn, role, text, int(fault)))
        if out:
            yield pd.DataFrame(out, columns=NAMES)
    if seen:
        yield pd.DataFrame([_result(conv, rows)], columns=NAMES)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id.

    A conversation whose rows are all dropped has zeros, an empty audit and the sha256 of the empty
    string. gaps counts the missing turns between the smallest and largest turn (nulls ignored, 0
    if all are null). Rows of one conversation form one group: its result is one hash over all of
    its text, which no split could produce.
    """
    rows = damaged(conversations.select("conv_id", "turn", "role", "text"))
    ordered = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "dropped", "pos")
    return ordered.select("conv_id", "turn", "role", "text", "dropped", "fault").mapInPandas(_stream, SCHEMA)
