"""Exact substring removal over UTF-8 bytes, by suffix arrays built from Lyndon-prefix groups.

Every 50-byte window holds the minimum of the hashes of its 16-byte pieces (its anchor). Equal
windows have equal anchors, so the documents are cut into runs of windows sharing an anchor
occurrence ("pieces", each at most 50 + 34 bytes), and no window is compared with anything outside
its anchor group. The shuffle that lets pieces meet is narrow: a hash of the anchor, a hash of the
piece and the document. It tells which pieces have copies in other documents, and which differ from
another document's piece of the same anchor. Only the latter send their bytes, from their smallest document. In a
group of these, pieces are cut down to the windows whose hashes meet, equal rests are merged, and a
suffix array over the rests is built by grouping suffixes by their Lyndon prefixes (processed in descending
order with previous-smaller pointers, then induced in ascending order, without recursion);
runs of suffixes sharing 50 bytes are windows that occur in several pieces.

A byte of a document is removed when a 50-byte window covering it also starts in a document with
a smaller doc_id: for a piece whose copies lie in several documents, every copy but those of the
smallest id is removed whole; in the documents of the smallest id, the windows the suffix array
finds in pieces of smaller ids. Rows with a null doc_id count as larger than every id; rows with
equal ids never remove from each other; null text is empty.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import _BYTES, _powers, mixed, raw, saved

WIDTH = 50
ANCHOR = 16
SPAN = WIDTH - ANCHOR + 1
LAST = (1 << 63) - 1
#: The mark of a piece that is removed whole; other marks have a bit for each of its windows.
WHOLE = -1
#: Bytes of pieces that a task looks at in one go, if no single group has more.
SLICE = 1 << 21
_PLACE = np.uint64((1 << 28) - 1)


def gsaca(t: list[int]) -> list[int]:
    """Suffix array of ``t``, whose last value is its unique smallest, by grouping Lyndon prefixes."""
    n = len(t)
    if n == 0:
        return []
    # Phase 1: groups of equal Lyndon prefix, kept as a doubly linked list in ascending order.
    values = sorted(set(t))
    gnext, gprev, members = {}, {}, {}
    ids = {v: k for k, v in enumerate(values)}
    for k in range(len(values)):
        members[k] = []
        gprev[k] = k - 1 if k else None
        gnext[k] = k + 1 if k + 1 < len(values) else None
    group = [ids[v] for v in t]
    for i in range(n):
        members[group[i]].append(i)
    fresh = len(values)
    prev = [-1] * n
    above = [False] * n
    g = len(values) - 1
    while g is not None:
        todo = members[g]
        for i in todo:
            above[i] = True
        for i in todo:  # ascending positions
            j = i - 1
            while j >= 0 and above[j]:
                j = prev[j]
            prev[i] = j
        times = {}
        for i in todo:
            p = prev[i]
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moves = {}
        for p, k in times.items():
            moves.setdefault(group[p], {}).setdefault(k, []).append(p)
        for h, by_k in moves.items():
            after = h
            for k in sorted(by_k):
                new = fresh
                fresh += 1
                members[new] = sorted(by_k[k])
                nxt = gnext[after]
                gnext[after], gprev[new], gnext[new] = new, after, nxt
                if nxt is not None:
                    gprev[nxt] = new
                after = new
                for p in by_k[k]:
                    group[p] = new
            moved = {p for k in by_k for p in by_k[k]}
            members[h] = [p for p in members[h] if p not in moved]
        g = gprev[g]
    # Phase 2: groups ascending; each suffix placed when the suffix after its Lyndon prefix is met.
    order, start = [], {}
    g = 0
    while g is not None:
        if members[g]:
            start[g] = len(order)
            order.extend([None] * len(members[g]))
        g = gnext[g]
    fill = dict(start)
    sa = order
    sa[0] = n - 1
    fill[group[n - 1]] += 1
    for r in range(n):
        s = sa[r]
        j = s - 1
        while j > prev[s]:
            gj = group[j]
            sa[fill[gj]] = j
            fill[gj] += 1
            j = prev[j]
    return sa


def lcp(t: list[int], sa: list[int]) -> list[int]:
    """Longest common prefix of each suffix with the one before it in ``sa`` (Kasai)."""
    n = len(t)
    rank = [0] * n
    for r, s in enumerate(sa):
        rank[s] = r
    out = [0] * n
    h = 0
    for i in range(n):
        r = rank[i]
        if r == 0:
            h = 0
            continue
        j = sa[r - 1]
        while i + h < n and j + h < n and t[i + h] == t[j + h]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    return out


def _prefix_sums(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which ``_hashes`` tells the hash of any stretch, and the factors it takes."""
    a = np.frombuffer(data, np.uint8)
    up, down = _powers(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTES[a] * up[:len(a)], out=sums[1:])
    return sums, down


def pieces(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, starts and ends of the runs of windows that share an anchor occurrence, in order.

    Each window [i, i + WIDTH) lies in exactly one piece; a piece spans its windows' bytes. Of grams whose hashes
    are equal in the bits compared, a window's first one is its anchor.
    """
    n = len(data)
    if n < WIDTH:
        none = np.empty(0, np.int64)
        return none, none, none
    sums, down = _prefix_sums(data)
    h = mixed((sums[ANCHOR:] - sums[:n - ANCHOR + 1]) * down[:n - ANCHOR + 1])
    best = np.empty(n - WIDTH + 1, np.int64)
    # Places within a slice fit the bits that break ties.
    for at in range(0, len(best), int(_PLACE) - SPAN):
        part = h[at:at + int(_PLACE)]
        value = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(part) // SPAN) * SPAN, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(part)] = value
        blocks = padded.reshape(-1, SPAN)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        smallest = np.minimum(behind[:len(part) - SPAN + 1], ahead[SPAN - 1:len(part)])
        best[at:at + len(smallest)] = (smallest & _PLACE).astype(np.int64) + at
    starts = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    ends = np.concatenate([starts[1:], [len(best)]]) - 1 + WIDTH
    return h[best[starts]].view(np.int64), starts, ends


def piece_keys(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(data[s:e]) for s, e in zip(starts.tolist(), ends.tolist())], np.uint64).view(np.int64)


def _named(batches):
    """anchor, pkey of the pieces of each text, with its docn and part."""
    for batch in batches:
        out, size = [], 0
        for docn, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch, "text"), strict=True):
            anchors, starts, ends = pieces(text or b"")
            if not len(anchors):
                continue
            pkeys, first = np.unique(piece_keys(text, starts, ends), return_index=True)
            out.append((anchors[first], pkeys, np.full(len(first), docn), np.full(len(first), part)))
            size += len(first)
            if size > 200_000:
                yield _rows(("anchor", "pkey", "docn", "part"), out)
                out, size = [], 0
        if out:
            yield _rows(("anchor", "pkey", "docn", "part"), out)


def _rows(names, out):
    return pa.RecordBatch.from_pydict({k: np.concatenate(v).astype(np.int64) for k, v in zip(names, zip(*out, strict=True), strict=True)})


def _met(batches):
    """Of rows sorted by anchor, pkey and docn: those of pieces that are copies of a smaller docn's (``ask`` is 0), and those of the
    smallest docn of each piece whose anchor has several pieces and documents (1).

    The latter wait until that is known of their anchor, while all rows so far are of one piece or of one docn.
    """
    names = ("docn", "part", "pkey", "ask")
    anchor = pkey = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, p, d, q = (batch.column(k).to_numpy() for k in range(4))
        n = len(a)
        new = np.concatenate([[anchor is None or a[0] != anchor], a[1:] != a[:-1]])
        turn = new.copy()
        turn[0] |= p[0] != pkey
        turn[1:] |= p[1:] != p[:-1]
        if new[0]:
            several, low, high, waiting = False, d[0], d[0], []
        # The smallest docn of each piece; the first piece may have begun before.
        run = np.maximum.accumulate(np.where(turn, np.arange(n), 0))
        least = d[run]
        if not turn[0]:
            least[:np.argmax(turn) if turn.any() else n] = first
        copies = d != least
        starts = np.flatnonzero(new) if new[0] else np.concatenate([[0], np.flatnonzero(new)])
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        kinds = np.add.reduceat((turn & ~new).astype(np.int64), starts) > 0
        lows, highs = np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)
        kinds[0] |= several
        lows[0], highs[0] = min(lows[0], low), max(highs[0], high)
        open_ = kinds & (lows < highs)
        asked = ~copies & open_[group]
        out = [(d[copies], q[copies], p[copies], np.zeros(copies.sum())), (d[asked], q[asked], p[asked], np.ones(asked.sum()))]
        if open_[0] and waiting:
            out += waiting
            waiting = []
        if len(starts) > 1:
            waiting = []
        tail = (group == len(starts) - 1) & ~copies
        if not open_[-1] and tail.any():
            waiting.append((d[tail], q[tail], p[tail], np.ones(tail.sum())))
        anchor, pkey, first, several, low, high = a[-1], p[-1], least[-1], kinds[-1], lows[-1], highs[-1]
        yield _rows(names, out)


def _asked(batches):
    """anchor, docn, part, piece of the pieces of each text that ``asked`` names."""
    for batch in batches:
        out, size = [], 0
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("docn", "part")]
        asked = batch.column(batch.schema.get_field_index("asked"))
        for docn, part, text, named in zip(*columns, raw(batch, "text"), asked, strict=True):
            anchors, starts, ends = pieces(text or b"")
            found = np.flatnonzero(np.isin(piece_keys(text or b"", starts, ends), named.values.to_numpy()))
            anchors, starts, ends = anchors[found].tolist(), starts[found].tolist(), ends[found].tolist()
            out += [(k, docn, part, text[s:e]) for k, s, e in zip(anchors, starts, ends, strict=True)]
            if len(out) > 50_000:
                yield _piece_rows(out)
                out = []
        if out:
            yield _piece_rows(out)


def _piece_rows(out):
    *numbers, held = zip(*out, strict=True)
    return pa.RecordBatch.from_pydict(
        {k: np.array(v, np.int64) for k, v in zip(("anchor", "docn", "part"), numbers, strict=True)} | {"piece": pa.array(held, pa.binary())})


def _met_windows(data: bytes, offsets: np.ndarray, docn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each piece among those whose hash other documents' pieces hold as well; first is -1 if there is none."""
    count = np.diff(offsets) - WIDTH + 1
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[:-1][owner] + inside
    sums, down = _prefix_sums(data)
    h = (sums[at + WIDTH] - sums[at]) * down[at]
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    d = docn[owner[order]]
    several = np.minimum.reduceat(d, starts) < np.maximum.reduceat(d, starts)
    met = np.zeros(len(owner), bool)
    met[order] = np.repeat(several, np.diff(np.append(starts, len(order))))
    first, last = np.full(len(count), -1), np.full(len(count), -1)
    of, j = owner[met], inside[met]
    last[of] = j
    first[of[::-1]] = j[::-1]
    return first, last


def least_holders(items: list[bytes], holders: list[int]) -> list[list[int]]:
    """For each window of each of the different ``items``, the smallest of ``holders`` among the items that hold it."""
    out = [[h] * (len(x) - WIDTH + 1) for x, h in zip(items, holders, strict=True)]
    if len(items) == 1:
        return out
    t, owner, offset = [], [], []
    for k, piece in enumerate(items):
        t.extend(b + len(items) + 1 for b in piece)
        owner.extend([k] * len(piece))
        offset.extend(range(len(piece)))
        t.append(k + 1)
        owner.append(-1)
        offset.append(-1)
    t.append(0)
    sa = gsaca(t)
    common = lcp(t, sa)
    r = 0
    while r < len(sa):
        e = r + 1
        while e < len(sa) and common[e] >= WIDTH:
            e += 1
        if e - r > 1:
            least = min(holders[owner[sa[x]]] for x in range(r, e))
            for x in range(r, e):
                out[owner[sa[x]]][offset[sa[x]]] = least
        r = e
    return out


def _found(table: pa.Table) -> pa.RecordBatch | None:
    """docn, part, pkey, mark of the pieces that hold windows of smaller docns' pieces, from whole anchor groups sorted by anchor."""
    anchor, docn, part = (table[k].to_numpy() for k in ("anchor", "docn", "part"))
    held = table["piece"].to_pylist()
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])])
    first, last = _met_windows(b"".join(held), offsets, docn)
    at = np.flatnonzero(first >= 0)
    groups = np.split(at, np.flatnonzero(anchor[at][1:] != anchor[at][:-1]) + 1) if len(at) else []
    out = []
    for group in groups:
        rests = [held[k][i:j + WIDTH] for k, i, j in zip(group.tolist(), first[group].tolist(), last[group].tolist(), strict=True)]
        least = {}
        for rest, d in zip(rests, docn[group].tolist(), strict=True):
            least[rest] = min(least.get(rest, LAST), d)
        found = dict(zip(least, least_holders(list(least), list(least.values())), strict=True))
        for k, rest in zip(group.tolist(), rests, strict=True):
            d, start = int(docn[k]), int(first[k])
            mark = sum(1 << (start + j) for j, holder in enumerate(found[rest]) if holder < d)
            if mark:
                out.append((d, int(part[k]), xxhash.xxh3_64_intdigest(held[k]), mark))
    if not out:
        return None
    docn, part, pkey, mark = zip(*out, strict=True)
    return pa.RecordBatch.from_pydict({
        "docn": np.array(docn, np.int64), "part": np.array(part, np.int64), "pkey": np.array(pkey, np.uint64).view(np.int64), "mark": np.array(mark, np.int64)})


def _shared(batches):
    """``_found`` of rows sorted by anchor, many groups at a time."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < SLICE:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        anchor = table["anchor"].to_numpy()
        whole = int(np.searchsorted(anchor, anchor[-1]))
        if whole:
            if (out := _found(table.slice(0, whole))) is not None:
                yield out
            held = table.slice(whole).to_batches()
            size = sum(b.nbytes for b in held)
    if held and (out := _found(pa.Table.from_batches(held).combine_chunks())) is not None:
        yield out


def _digest(batches):
    for batch in batches:
        rows = []
        marks = batch.column(batch.schema.get_field_index("marks"))
        for text, marked in zip(raw(batch, "text"), marks, strict=True):
            data = text or b""
            cover = np.zeros(len(data) + 1, np.int32)
            if marked.is_valid:
                _, starts, ends = pieces(data)
                of = {}
                for pkey, mark in zip(marked.values.field("pkey").to_pylist(), marked.values.field("mark").to_pylist(), strict=True):
                    of[pkey] = of.get(pkey, 0) | mark
                for pkey, start, end in zip(piece_keys(data, starts, ends).tolist(), starts.tolist(), ends.tolist(), strict=True):
                    mark = of.get(pkey, 0)
                    if mark == WHOLE:
                        cover[start] += 1
                        cover[end] -= 1
                    elif mark:
                        for j in range(end - start - WIDTH + 1):
                            if mark >> j & 1:
                                cover[start + j] += 1
                                cover[start + j + WIDTH] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (1 if len(gone) and gone[0] else 0))
            rows.append((len(data), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
        n_bytes, n_removed, n_spans, digests = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def deduplicated(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of every row."""
    # Whether a piece is removed depends on its bytes and docn alone; ``part`` only deals rows of one docn to several groups.
    part = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("text").bitwiseAND(F.lit(255)))
    docs = documents.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("docn"), part.alias("part"), "text")

    names = docs.select("docn", "part", "text").mapInArrow(_named, "anchor long, pkey long, docn long, part long")
    met = saved(names.repartition("anchor").sortWithinPartitions("anchor", "pkey", "docn").mapInArrow(
        _met, "docn long, part long, pkey long, ask long"))

    asked = met.where("ask = 1").groupBy("docn", "part").agg(F.collect_list("pkey").alias("asked"))
    held = docs.join(asked, ["docn", "part"]).select("doc_id", "docn", "part", "text", "asked").mapInArrow(
        _asked, "anchor long, docn long, part long, piece binary")
    found = held.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _shared, "docn long, part long, pkey long, mark long")
    marks = met.where("ask = 0").select("docn", "part", "pkey", F.lit(WHOLE).cast("long").alias("mark")).unionByName(found)
    marks = marks.groupBy("docn", "part").agg(F.collect_list(F.struct("pkey", "mark")).alias("marks"))
    joined = docs.join(marks, ["docn", "part"], "left").select("doc_id", "docn", "part", "text", "marks")
    return joined.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
