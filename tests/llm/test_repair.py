"""Conversation repair against a plain model: damage, faults and every edit string by brute force."""

import hashlib
import itertools
import re
import zlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from leafmill.llm import repair

VALID = re.compile(r"(s?(ua)+)?")


def plain_rows(rows):
    """(conv_id, turn, role, text) -> {conv_id: ordered (turn, role, text) after damage}."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if d == 0:
            continue
        text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        out[conv] += [(turn, role, text, c) for c in range(2 if d == 3 else 1)]
    return {k: [r[:3] for r in sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3]))]
            for k, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        stripped = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not stripped:
            out.append(repair.BLANK)
        elif (role, text) in seen:
            out.append(repair.DUPLICATE)
        elif stripped[-1] not in ".!?":
            out.append(repair.TRUNC)
        else:
            out.append(0)
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest (cost, letters, repaired rows) over all edit strings with at most two inserts in a row."""
    best = None
    n = len(rows)
    marks = faults(rows)

    def walk(i, roles, letters, out, cost, run):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == n and VALID.fullmatch(roles):
            cand = (cost, "".join(letters), list(out))
            best = cand if best is None or cand[:2] < best[:2] else best
        if run < 2:
            nxt = "a" if roles.endswith("u") else "u"
            walk(i, roles + nxt, letters + ["I"], out + [("user" if nxt == "u" else "assistant", "")], cost + 2, run + 1)
        if i == n:
            return
        role, text = rows[i][1], rows[i][2]
        f = marks[i]
        walk(i + 1, roles, letters + ["D"], out, cost + 3, 0)
        if f in (repair.BLANK, repair.DUPLICATE):
            return
        extra = 1 if f == repair.TRUNC else 0
        walk(i + 1, roles + role[:1], letters + ["K"], out + [(role, text)], cost + extra, 0)
        for new in ("user", "assistant"):
            walk(i + 1, roles + new[0], letters + ["R"], out + [(new, text)], cost + 2 + extra, 0)

    walk(0, "", [], [], 0, 0)
    # keep only strings that stay a prefix of the grammar: prune invalid at the end
    return best


def test_dp_equals_brute_force():
    stock = [("user", "Hi."), ("assistant", "Hello"), ("system", "Be kind."), ("user", " "), ("tool", "x!"),
             ("assistant", "Sure."), ("user", "Hi.")]
    for n in range(0, 6):
        for combo in itertools.islice(itertools.product(stock, repeat=n), 0, 400, 7 if n > 3 else 1):
            rows = [(k, r, t) for k, (r, t) in enumerate(combo)]
            cost, audit, out = repair.repair([(r, t, f) for (_, r, t), f in zip(rows, faults(rows))])
            want = brute(rows)
            assert (cost, audit) == want[:2], rows
            assert out == want[2]


def plain_result(rows):
    per = plain_rows(rows)
    result = {}
    for conv, ordered in per.items():
        turns = [t for t, _, _ in ordered if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        f = faults(ordered)
        initials = [r[:1] for _, r, _ in ordered]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = repair.repair([(r, t, x) for (_, r, t), x in zip(ordered, f)])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        result[conv] = (gaps, f.count(1), f.count(2), f.count(3), illegal, cost, audit, digest)
    return result


def test_whole_operator_on_table_and_odd_rows(spark):
    table = pq.read_table("/root/testdata/sf0.01/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table]
    rows += [(9001, None, None, None), (9001, 3, "user", "same."), (9001, 3, "user", "same."), (9001, 7, "", "x"),
             (None, 1, "user", "no id."), (None, None, "assistant", "no turn"), (9002, 0, "user", "é" * 5000 + "?"),
             (9003, 0, "bot", "\t\n"), (9004, 0, "system", "Only system.")]
    rows += [(9100 + k, 0, "user", "drop me") for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1))
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repaired(df).collect()}
    want = plain_result(rows)
    assert got == want
    dropped = [k for k in got if k is not None and k >= 9100]
    assert all(got[k] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in dropped if got[k][6] == "")
    assert spark.createDataFrame([], "conv_id long, turn long, role string, text string").transform(repair.repaired).count() == 0
