"""Exact join of documents on the Jaccard similarity of their word shingles.

A document's shingles are hashed into groups, and the numbers per group are its point. Two documents
share at most the sum of the smaller coordinates, so points whose summed minima are too small are
never verified. Points are indexed in R-trees: leaves of points alike in size and coordinates with
their upper corner, which bounds all of them at once.

One tree over all points cannot prune: groups are many, and random documents of one size lie nearly as
close in each of them as similar ones do, so work would grow with the square of the input. Points
therefore meet first by a prefix: of sets that are similar enough, the rarest fifth of either one
holds a common shingle. A tree is built for each such shingle. Shingles that many documents hold come last
in the order, so they open no large group.

The steps: (1) a row per document with the hash of its set, equal sets being one node from here on;
(2) prefixes by shingle, of which those of one node only are dropped; (3) in each group of a shingle, nodes
are paired with the first one and with their predecessor, and verified links joined to components;
(4) groups that still hold several components are joined completely by their trees, leaving out pairs within a
component; (5) components of all links.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import in_parts, raw, saved, small_batches, stored, text_shingles
from leafmill.llm.components import components

#: Similarity as a fraction: 100 x intersection >= 80 x union.
NUMERATOR, DENOMINATOR = 4, 5
#: Coordinates of a point.
GROUPS = 64
#: Points of a leaf, and points of a shingle's group that a task holds at once.
LEAF, BLOCK = 32, 2000
#: Pairs within leaves that a task looks at in one go.
PAIRS = 100_000
#: Shingles held by so many documents of one batch are candidates for the end of the order, and so many are put there.
COMMON_IN_BATCH, COMMON = 4, 200_000
#: Nodes from which on a shingle met in prefixes is put there as well.
COMMON_IN_PREFIXES = 8
#: Bits of the filter that tells which documents' sets are needed.
FILTER_BITS = 1 << 23

NODE = "struct<sig: long, n: int>"


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(text_shingles(text))


def signature(values: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes(), seed=len(values))).astype(np.int64))


def prefix_size(n):
    """Of two sets of n and any number of shingles, similar ones have a common one among so many first of either."""
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def similar(shared: int, n: int, m: int) -> bool:
    return DENOMINATOR * shared >= NUMERATOR * (n + m - shared)


def least_shared(n, m):
    """Smallest intersection of similar sets of n and m."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def point(values: np.ndarray) -> np.ndarray:
    """Shingles by group."""
    counts = np.bincount((values >> np.uint64(20)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return counts.astype(np.uint32)


_ROW = "doc_id long, text_key long, sig long, n int, point binary, token long, times long"


def _described(batches):
    """A row per text: its node and point. And rows of shingles that several different sets of a batch hold."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, _ROW.split(", "))])
    for batch in batches:
        sigs, sizes, points, held, seen, size = [], [], [], [], set(), 0
        common = []
        for text in (t for part in in_parts([batch]) for t in raw(part, "text")):
            values = shingle_set(text)
            sig = signature(values)
            sigs.append(sig)
            sizes.append(len(values))
            points.append(point(values).tobytes() if len(values) else None)
            if sig not in seen:
                seen.add(sig)
                held.append(values)
                size += len(values)
            if size > 2_000_000:
                common.append(_repeated(held))
                held, size = [], 0
        if held:
            common.append(_repeated(held))
        none = pa.nulls(len(sigs), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sigs, pa.int64()), pa.array(sizes, pa.int32()), pa.array(points, pa.binary()), none, none], schema=schema)
        for values, counts in common:
            if len(values):
                blank = [pa.nulls(len(values), schema.field(k).type) for k in range(5)]
                yield pa.RecordBatch.from_arrays([*blank, pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], schema=schema)


def _repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    often = counts >= COMMON_IN_BATCH
    return values[often], counts[often]


def _prefixes(common: np.ndarray):
    def run(batches):
        done = set()
        for batch in in_parts(batches):
            tokens, sigs, sizes = [], [], []
            for text in raw(batch, "text"):
                values = shingle_set(text)
                n = len(values)
                sig = signature(values)
                if not n or (sig, n) in done:
                    continue
                if len(done) < 200_000:
                    done.add((sig, n))
                if len(common):
                    last = common[np.searchsorted(common, values).clip(max=len(common) - 1)] == values
                    if last.any():
                        values = np.concatenate([values[~last], values[last]])
                p = prefix_size(n)
                tokens.append(values[:p])
                sigs.append(np.full(p, sig))
                sizes.append((np.int64(n) << np.int64(32)) + np.arange(p))
            if tokens:
                yield pa.RecordBatch.from_pydict({
                    "token": np.concatenate(tokens).view(np.int64), "sig": np.concatenate(sigs), "place": np.concatenate(sizes)})

    return run


def _shared(batches):
    """Of rows sorted by token, sig and place: those whose token several nodes hold, with the first of
    them and their predecessor.

    In a group of near copies these are the same two for all of a node's shingles, so that its links stay few.
    """
    hub = last = None  # (token, sig, place); whether the hub was put out
    shown = False
    for batch in batches:
        if not batch.num_rows:
            continue
        token, sig, place = (batch.column(k).to_numpy() for k in range(3))
        if last is not None:
            token, sig, place = (np.concatenate([[a], b]) for a, b in zip(last, (token, sig, place), strict=True))
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1]) | (place[1:] != place[:-1])
        token, sig, place = token[keep], sig[keep], place[keep]
        n = len(token)
        new = np.ones(n, bool)
        new[1:] = token[1:] != token[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        hub_sig, hub_place = sig[first], place[first]
        if hub is not None and last is not None and hub[0] == token[0]:
            run = token == token[0]
            hub_sig = np.where(run, hub[1], hub_sig)
            hub_place = np.where(run, hub[2], hub_place)
        out = ~new
        # The head of a run is put out with the run's second row.
        heads = np.zeros(n, bool)
        heads[first[out]] = True
        if last is not None and heads[0] and (shown or (hub[1], hub[2]) != (sig[0], place[0])):
            heads[0] = False
        at = np.flatnonzero(out | heads)
        if len(at):
            before = np.where(new[at], at, at - 1)
            yield pa.RecordBatch.from_pydict({
                "token": token[at], "sig": sig[at], "place": place[at], "hub_sig": hub_sig[at], "hub_place": hub_place[at],
                "prev_sig": sig[before], "prev_place": place[before]})
        continues = hub is not None and last is not None and hub[0] == token[-1] and first[-1] == 0
        shown = bool(out[-1] or (continues and shown))
        hub = hub if continues else (token[-1], hub_sig[-1], hub_place[-1])
        last = (token[-1], sig[-1], place[-1])


def _sets(bits: np.ndarray):
    """Sets of the texts whose key the filter names; one row per set and task."""
    def run(batches):
        done = set()
        for batch in in_parts(batches):
            slots = batch.column(1).to_numpy() % FILTER_BITS
            named = np.flatnonzero(bits[slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1))
            out = []
            for text in raw(batch.take(pa.array(named)), "text"):
                values = shingle_set(text)
                node = signature(values), len(values)
                if node in done:
                    continue
                if len(done) < 200_000:
                    done.add(node)
                out.append(({"sig": node[0], "n": node[1]}, values.tobytes()))
                if len(out) == 500:
                    yield _set_rows(out)
                    out = []
            if out:
                yield _set_rows(out)

    return run


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit for each value of ``key``, modulo ``FILTER_BITS``: a table of fixed size, whatever the number of keys.

    Texts that it names beyond those are only computed in vain.
    """
    slot = F.pmod("key", F.lit(FILTER_BITS))
    words = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("word"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.collect():  # at most FILTER_BITS / 64 rows
        bits[r["at"]] = r["word"]
    return bits.view(np.uint64)


def _set_rows(out):
    nodes, sets = zip(*out, strict=True)
    return pa.RecordBatch.from_pydict({
        "node": pa.array(nodes, pa.struct([("sig", pa.int64()), ("n", pa.int32())])), "set": pa.array(sets, pa.binary())})


def _bounded(batches):
    """Pairs (a, b) whose points allow a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, m = (batch.column(k).field("n").to_numpy().astype(np.int64) for k in (0, 1))
        p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, GROUPS) for k in (2, 3))
        keep = np.minimum(p, q).sum(axis=1) >= least_shared(n, m)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))


def _verified(batches):
    """Pairs whose sets are similar."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            keep.append(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, bounded: bool = False) -> DataFrame:
    """The pairs (a, b) that are links: first by their points, unless they are ``bounded`` by them already, then by the sets of those that are left.

    ``nodes``: node, point, text_key; ``texts``: text, text_key.
    """
    # Rows with two sets are wide: batches of Spark's usual size would fill an executor's memory outside the heap.
    with small_batches(pairs.sparkSession):
        return _links(pairs, nodes, texts, bounded)


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, bounded: bool) -> DataFrame:
    schema = f"a {NODE}, b {NODE}"

    def both(pairs, table, column):
        x = table.select(F.col("node").alias("a"), F.col(column).alias("x"))
        y = table.select(F.col("node").alias("b"), F.col(column).alias("y"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")

    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = saved(pairs if bounded else both(pairs, nodes, "point").mapInArrow(_bounded, schema))
    ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    keys = nodes.select("node", F.col("text_key").alias("key")).join(ends, "node", "left_semi")
    # Both joins read the sets from one shuffle: storing them would write the widest rows once more.
    sets = texts.mapInArrow(_sets(key_filter(keys)), f"node {NODE}, set binary").join(ends, "node", "left_semi").dropDuplicates(["node"])
    return stored(both(near, sets, "set").mapInArrow(_verified, schema))


def tree_leaves(points: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Sort-tile packing: by size, then by the heaviest groups' sum, into leaves of at most ``LEAF`` points."""
    order = np.lexsort((points[:, : GROUPS // 2].sum(axis=1), sizes))
    slabs = max(1, int(np.ceil(np.sqrt(len(order) / LEAF))))
    leaves = []
    for slab in np.array_split(order, slabs):
        inner = slab[np.argsort(points[slab, : GROUPS // 2].sum(axis=1), kind="stable")]
        leaves += np.array_split(inner, max(1, -(-len(inner) // LEAF)))
    return [leaf for leaf in leaves if len(leaf)]


def tree_pairs(points, sizes, places, parts, cells):
    """Index pairs that may be links: other component, sizes and places that allow it, and enough summed minima.

    ``cells`` tells, for groups joined in blocks, which of the two blocks a point is from (None: one block).
    """
    leaves = tree_leaves(points, sizes)
    upper = np.array([points[leaf].max(axis=0) for leaf in leaves])
    low = np.array([sizes[leaf].min() for leaf in leaves])
    high = np.array([sizes[leaf].max() for leaf in leaves])
    out = []
    for k, leaf in enumerate(leaves):
        bound = np.minimum(upper[k], upper[k:]).sum(axis=1)
        near = (bound >= least_shared(low[k], low[k:])) & (DENOMINATOR * high[k:] >= NUMERATOR * low[k]) & (DENOMINATOR * high[k] >= NUMERATOR * low[k:])
        for j in k + np.flatnonzero(near):
            other = leaves[j]
            n, m = sizes[leaf][:, None], sizes[other][None, :]
            ok = (parts[leaf][:, None] != parts[other][None, :]) & (DENOMINATOR * n >= NUMERATOR * m) & (DENOMINATOR * m >= NUMERATOR * n)
            least = least_shared(n, m)
            # At their first common shingle, no more can be shared than what follows in either.
            ok &= np.minimum(n - places[leaf][:, None], m - places[other][None, :]) >= least
            if j == k:
                ok &= np.arange(len(leaf))[:, None] < np.arange(len(other))[None, :]
            if cells is not None:
                ok &= cells[leaf][:, None] != cells[other][None, :]
            a, b = np.nonzero(ok)
            if len(a):
                enough = np.minimum(points[leaf[a]], points[other[b]]).sum(axis=1) >= least[a, b]
                out += zip(leaf[a[enough]].tolist(), other[b[enough]].tolist(), strict=True)
    return out


def _leaf_pairs(points, sizes, places, parts, cells, starts, counts):
    """``tree_pairs`` of many groups of one leaf each, whose rows begin at ``starts``; ``cells`` differ, or are -1 in groups of one block."""
    out = []
    for k in np.unique(counts[counts > 1]).tolist():
        base = starts[counts == k]
        i, j = np.triu_indices(k, 1)
        step = max(1, PAIRS // len(i))
        for at in range(0, len(base), step):
            a, b = ((base[at:at + step, None] + x).ravel() for x in (i, j))
            n, m = sizes[a], sizes[b]
            least = least_shared(n, m)
            ok = (parts[a] != parts[b]) & (DENOMINATOR * n >= NUMERATOR * m) & (DENOMINATOR * m >= NUMERATOR * n)
            ok &= (np.minimum(n - places[a], m - places[b]) >= least) & ((cells[a] != cells[b]) | (cells[a] < 0))
            a, b, least = a[ok], b[ok], least[ok]
            enough = np.minimum(points[a], points[b]).sum(axis=1) >= least
            out.append((a[enough], b[enough]))
    return out


def _group_pairs(table: pa.Table) -> pa.RecordBatch | None:
    """Candidate pairs of whole groups (token, block, other), sorted by these."""
    table = table.combine_chunks()
    token, block, other, cell, places = (table[k].to_numpy().astype(np.int64) for k in ("token", "block", "other", "cell", "pos"))
    node, part = (table[k].combine_chunks() for k in ("node", "part"))
    sizes = node.field("n").to_numpy().astype(np.int64)
    parts = np.unique(np.stack([part.field("sig").to_numpy(), part.field("n").to_numpy().astype(np.int64)]), axis=1, return_inverse=True)[1].ravel()
    points = np.frombuffer(b"".join(table["point"].to_pylist()), np.uint32).reshape(-1, GROUPS)
    cells = np.where(block == other, -1, cell)
    starts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (block[1:] != block[:-1]) | (other[1:] != other[:-1])]))
    counts = np.diff(np.append(starts, len(token)))
    small = counts <= LEAF
    out = _leaf_pairs(points, sizes, places, parts, cells, starts[small], counts[small])
    for s, n in zip(starts[~small].tolist(), counts[~small].tolist(), strict=True):
        of = slice(s, s + n)
        found = tree_pairs(points[of].astype(np.int64), sizes[of], places[of], parts[of], None if cells[s] < 0 else cells[of])
        if found:
            out.append(tuple(np.array(found, np.int64).T + s))
    a, b = (np.concatenate([x[k] for x in out]) if out else np.empty(0, np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b))], ["a", "b"]) if len(a) else None


def _joined(batches):
    """Candidate pairs of each group (token, block, other); rows come sorted by these."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        key = np.stack([table[k].to_numpy().astype(np.int64) for k in ("token", "block", "other")])
        whole = np.flatnonzero((key != key[:, -1:]).any(axis=0))
        if len(whole):
            if (out := _group_pairs(table.slice(0, whole[-1] + 1))) is not None:
                yield out
            held = table.slice(whole[-1] + 1).to_batches()
    if held and (out := _group_pairs(pa.Table.from_batches(held))) is not None:
        yield out


def _node(sig: str, place: str):
    return F.struct(F.col(sig).alias("sig"), F.shiftright(place, 32).cast("int").alias("n"))


def _pos(place: str):
    return F.col(place).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _may_link(a: str, p: str, b: str, q: str) -> str:
    """Different nodes whose sizes allow a link, and whose places do if the shingle is their first common one."""
    n, m = f"{a}.n", f"{b}.n"
    return (f"{a} != {b} and {DENOMINATOR} * {n} >= {NUMERATOR} * {m} and {DENOMINATOR} * {m} >= {NUMERATOR} * {n} "
            f"and {NUMERATOR + DENOMINATOR} * least({n} - {p}, {m} - {q}) >= {NUMERATOR} * ({n} + {m})")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key (a hash of the text) of every row of ``docs`` (doc_id, text).

    Words are runs outside \\x20 and \\x09-\\x0D with A-Z in lower case. Rows whose sets are similar are
    linked; ``component_id`` is the smallest doc_id among the rows that links reach. Rows without a word are linked with
    nothing. Repeated rows are copies of each other. Null ids are not smallest unless all are null. Shingles and sets are told by 64-bit hashes, sets by their size as well.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = docs.select("text", "text_key").where(F.col("text").isNotNull())
    described = saved(docs.mapInArrow(_described, _ROW))
    rows = described.where("token is null").select("doc_id", "text_key", F.struct("sig", "n").alias("node"), "point")
    nodes = saved(rows.where("node.n > 0").groupBy("node").agg(
        F.min("text_key").alias("text_key"), F.first("point").alias("point")))

    often = described.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    top = often.orderBy(F.desc("times"), "token").limit(COMMON).select("token")
    common = np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))

    # What batches are too small to show is seen in the prefixes of all texts.
    prefix = "token long, sig long, place long"
    met = texts.select("text").mapInArrow(_prefixes(common), prefix).groupBy("token").count().where(F.col("count") >= COMMON_IN_PREFIXES)
    more = met.orderBy(F.desc("count"), "token").limit(COMMON).select("token")
    common = np.union1d(common, np.array([r[0] for r in more.collect()], np.int64).view(np.uint64))

    prefixes = texts.select("text").mapInArrow(_prefixes(common), prefix)
    ordered = prefixes.repartition("token").sortWithinPartitions("token", "sig", "place")
    shared = saved(ordered.mapInArrow(_shared, "token long, sig long, place long, hub_sig long, hub_place long, prev_sig long, prev_place long"))
    shared = shared.select(
        "token", _node("sig", "place").alias("node"), _pos("place").alias("pos"), _node("hub_sig", "hub_place").alias("hub"),
        _pos("hub_place").alias("hub_pos"), _node("prev_sig", "prev_place").alias("prev"), _pos("prev_place").alias("prev_pos"))

    star = [shared.where(_may_link("node", "pos", c, f"{c}_pos")).select(F.col("node").alias("a"), F.col(c).alias("b")) for c in ("hub", "prev")]
    first = links(star[0].unionByName(star[1]), nodes, texts)
    parts = components(first)

    rest = shared.select("token", "node", "pos").join(parts, "node", "left").select(
        "token", "node", "pos", F.coalesce("component", "node").alias("part"))
    several = rest.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("rows")).where("low != high")
    blocks = several.select("token", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    open_ = rest.join(blocks, "token").withColumn("cell", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    open_ = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_ = open_.select("token", "node", "pos", "part", "cell", F.least("cell", "other").alias("block"), F.greatest("cell", "other").alias("other"))
    open_ = open_.join(nodes.select("node", "point"), "node")
    open_ = open_.repartition("token", "block", "other").sortWithinPartitions("token", "block", "other")
    second = links(open_.mapInArrow(_joined, f"a {NODE}, b {NODE}"), nodes, texts, bounded=True)

    whole = components(first.unionByName(second))
    named = rows.where("node.n > 0").drop("point").join(whole, "node", "left").withColumn("part", F.coalesce("component", "node"))
    smallest = named.groupBy("part").agg(F.min("doc_id").alias("smallest"))
    found = named.join(smallest, "part").select(
        "doc_id", F.col("node.n").cast("long").alias("n_shingles"), F.col("smallest").alias("component_id"), "text_key")
    alone = rows.where("node.n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_key")
    return found.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component, with all their columns.

    Of rows that repeat both doc_id and text one stays. Texts without a word are alone and stay; a row with
    a null id stays where no id of its component is known.
    """
    found = join(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept"), F.col("text_key").alias("_key"))
    rows = docs.withColumn("_text_key", F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(F.col("_kept")) & (F.col("_text_key") == F.col("_key")), "left_semi")
    return rows.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")
