"""Operators that bring rows together."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmill.llm import components, jaccard, passages, shards
from leafmill.llm.common import WordHashes, shingle_hashes
from tests.llm import models


@pytest.fixture(scope="module")
def corpus():
    """Unrelated texts, a hot group of near copies with a chain, a passage in a third of the texts, copies, odd texts."""
    rnd = random.Random(11)
    stock = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(3000)]
    prose = lambda n: [rnd.choice(stock) for _ in range(n)]
    texts = [" ".join(prose(rnd.randint(1, 160))) for _ in range(150)]
    passage = prose(60)
    texts += [" ".join(prose(rnd.randint(5, 60)) + passage + prose(rnd.randint(5, 60))) for _ in range(90)]
    base = prose(120)
    for _ in range(80):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(stock)
        texts.append(" ".join(w))
    chain = prose(100)
    for k in range(8):  # each like its neighbours only
        texts.append(" ".join(chain[3 * k:3 * k + 70]))
    texts += [texts[5].upper()] * 30 + [texts[160]] * 20
    texts += [None, "", " \n", "one two", "One  two", "one two three four five", "w " * 2000]
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, node int, token string").repartition(7)


def test_jaccard_components(spark, corpus, monkeypatch):
    found = jaccard.join(frame(spark, corpus)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == models.components(corpus)
    monkeypatch.setattr(jaccard, "BLOCK", 7)  # groups in blocks
    monkeypatch.setattr(jaccard, "COMMON", 0)
    found = jaccard.join(frame(spark, corpus)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == models.components(corpus)


def test_jaccard_odd_rows(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, "A B C D E F")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()]
    assert sorted(found, key=str) == sorted([(3, 3), (3, 3), (None, 3), (None, None), (9, 3)], key=str)
    assert sorted(jaccard.one_of_each(df).collect(), key=str) == sorted([(3, "a b c d e f"), (None, None)], key=str)


def test_tree_pairs_keep_every_link():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, 150, replace=False), rnd.integers(0, 2**63, rnd.integers(0, 30)).astype(np.uint64)])) for _ in range(120)]
    points = np.array([jaccard.point(s) for s in sets]).astype(np.int64)
    sizes = np.array([len(s) for s in sets])
    n = len(sets)
    pairs = {tuple(sorted(p)) for p in jaccard.tree_pairs(points, sizes, np.zeros(n, np.int64), np.arange(n), None)}
    links = {(i, j) for j in range(n) for i in range(j) if jaccard.similar(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))}
    assert links <= pairs


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_compact_windows_are_a_partition():
    rnd = np.random.default_rng(3)
    for _ in range(30):
        tokens = rnd.integers(0, 2**63, rnd.integers(0, 60)).astype(np.uint64)
        width = int(rnd.integers(1, 12))
        windows = list(zip(*passages.compact_windows(tokens, 0, width), strict=True))
        for i in range(len(tokens)):
            for j in range(i + width - 1, len(tokens)):
                assert sum(l <= i <= c <= j <= r for l, c, r in windows) == 1


def test_passages(spark, corpus):
    found = passages.repeated(frame(spark, corpus)).collect()
    texts = dict(corpus)
    for r in found:
        a, b = models.words(texts[r["doc_id"]])[r["start"]:r["end"]], models.words(texts[r["other_doc_id"]])[r["other_start"]:r["other_end"]]
        assert min(len(a), len(b)) >= 50 and models.similar(models.shingles(" ".join(a)), models.shingles(" ".join(b)))
    named = {r["doc_id"] for r in found} | {r["other_doc_id"] for r in found}
    holders = {}
    for i, t in corpus:
        w = models.words(t)
        for k in range(len(w) - 49):
            holders.setdefault(tuple(w[k:k + 50]), set()).add(i)
    must = set().union(*[s for s in holders.values() if len(s) > 1])
    assert must <= named
    clean = {i for i, t in corpus if i < 150} - must
    assert not clean & named
    assert passages.repeated(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect() == []


def test_passages_with_edits():
    rnd = random.Random(2)
    w = [str(rnd.random()) for _ in range(120)]
    edited = w[:60] + w[61:]
    x, y = (shingle_hashes([t.encode() for t in ["p"] * 9 + v + ["q"] * 9], WordHashes()) for v in (w, edited))
    (s, e, p, q, j), = passages.compared(x, y, 46)
    assert e - s >= 112 and q - p >= 110 and 0.9 < j < 1


def test_passages_like_neither_partner(spark, monkeypatch):
    """Versions of a passage, too different for links, two texts with each: whatever their order, all versions are found."""
    monkeypatch.setattr(passages, "BLOCK", 5, raising=False)
    rnd = random.Random(31)
    word = lambda: str(rnd.randrange(10**9))
    texts, kinds = [], []
    for group in range(12):
        base = [word() for _ in range(60)]
        for version in range(8):
            own = list(base)
            own[6 * version + 5] = own[6 * version + 12] = word()
            for _ in range(2):
                texts.append(" ".join([word() for _ in range(20)] + own + [word() for _ in range(20)]))
                kinds.append((group, version))
    found = passages.repeated(frame(spark, list(enumerate(texts)))).collect()
    linked = {frozenset((r["doc_id"], r["other_doc_id"])) for r in found}
    pairs = [frozenset(i for i, x in enumerate(kinds) if x == kind) for kind in set(kinds)]
    assert sum(p not in linked for p in pairs) == 0
    for r in found:
        a, b = texts[r["doc_id"]].split()[r["start"]:r["end"]], texts[r["other_doc_id"]].split()[r["other_start"]:r["other_end"]]
        assert min(len(a), len(b)) >= 50 and models.similar(models.shingles(" ".join(a)), models.shingles(" ".join(b)))


def test_passages_join_chains_across_classes(spark, monkeypatch):
    """Versions of a passage, each like the one before and after it only: one class, in whatever order texts meet."""
    monkeypatch.setattr(passages, "BLOCK", 3)
    rnd = random.Random(41)
    word = lambda: str(rnd.randrange(10**9))
    texts, group_of = [], []
    for group in range(15):
        own = [word() for _ in range(60)]
        for version in range(6):
            if version:
                own = list(own)
                own[6 + 8 * version] = word()
            texts.append(" ".join([word() for _ in range(20)] + own + [word() for _ in range(20)]))
            group_of.append(group)
    found = passages.repeated(frame(spark, list(enumerate(texts)))).collect()
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for r in found:
        assert group_of[r["doc_id"]] == group_of[r["other_doc_id"]]
        parent[root(r["doc_id"])] = root(r["other_doc_id"])
    assert [len({root(k) for k in range(len(texts)) if group_of[k] == g}) for g in range(15)] == [1] * 15


@pytest.mark.parametrize("split", [False, True])
def test_class_links_join_what_all_pairs_join(split, monkeypatch):
    monkeypatch.setattr(passages, "EACH", 0)
    rnd = np.random.default_rng(5)
    for _ in range(20):
        base = rnd.integers(0, 2**32, 60).astype(np.uint32)
        contexts = []
        for _ in range(50):
            own = base.copy()
            own[rnd.integers(0, 60, rnd.integers(0, 8))] = rnd.integers(0, 2**32)
            contexts.append(own)
        nodes, classes = rnd.integers(0, 30, 50), rnd.integers(0, 6, 50)
        cells = rnd.integers(3, 5, 50) if split else None

        def joined(pairs):
            parent = {("class", c): ("class", c) for c in classes.tolist()}
            root = lambda k: k if parent[k] == k else root(parent[k])
            for i, j in pairs:
                parent[root(("class", int(classes[i])))] = root(("class", int(classes[j])))
            return [root(("class", c)) for c in classes.tolist()]

        same = lambda roots: [[a == b for b in roots] for a in roots]
        pairs = [(i, j) for i in range(50) for j in range(i) if nodes[i] != nodes[j] and classes[i] != classes[j]
                 and (not split or cells[i] != cells[j]) and passages.compared(contexts[i], contexts[j], 46)]
        found = passages.class_links(nodes, contexts, classes, cells, 46)
        assert all((i, j) in pairs or (j, i) in pairs for i, j in found) and same(joined(found)) == same(joined(pairs))
        monkeypatch.setattr(passages, "EACH", 50)
        assert {frozenset(p) for p in passages.class_links(nodes, contexts, classes, cells, 46)} == {frozenset(p) for p in pairs}
        monkeypatch.setattr(passages, "EACH", 0)


def test_short_passages_with_edits():
    rnd = random.Random(12)
    word = lambda: str(rnd.random())
    tokens = lambda w: shingle_hashes([t.encode() for t in w], WordHashes())
    alike = 0
    for n, edits in [(80, 1), (60, 1)] + [(rnd.randint(51, 100), rnd.randint(1, 3)) for _ in range(400)]:
        one = [word() for _ in range(n)]
        two = list(one)
        for _ in range(edits):
            k = rnd.randrange(len(two))
            two[k:k + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 1)
        a, b = (set(tokens(w).tolist()) for w in (one, two))
        if min(len(one), len(two)) < 50 or 5 * len(a & b) < 4 * len(a | b):
            continue
        alike += 1
        around = [[word() for _ in range(rnd.randint(0, 40))] for _ in range(4)]
        x, y = tokens(around[0] + one + around[1]), tokens(around[2] + two + around[3])
        found = passages.compared(x, y, 46)
        assert any(s < len(around[0]) + n and e > len(around[0]) for s, e, *_ in found), (n, edits)
        for s, e, p, q, j in found:
            c, d = set(x[s:e].tolist()), set(y[p:q].tolist())
            assert min(e - s, q - p) >= 46 and j == len(c & d) / len(c | d) >= 0.8
    assert alike > 150


def test_best_stretches_against_brute_force():
    rnd = np.random.default_rng(8)
    for _ in range(200):
        found, width = rnd.random(rnd.integers(0, 40)) < 0.85, int(rnd.integers(1, 12))
        sums = np.concatenate([[0], np.cumsum(np.where(found, 1, -4))])
        best = max((sums[e] - sums[s] for s in range(len(sums)) for e in range(s + width, len(sums))), default=-1)
        out = passages.best_stretches(found, width, 4)
        assert bool(out) == (best >= 0) and all(e - s >= width and sums[e] - sums[s] >= 0 for s, e in out)
        assert not out or sums[out[0][1]] - sums[out[0][0]] == best


def test_shards(spark, corpus):
    rows = corpus + [(None, "x"), corpus[0]] + [(5000 + k, "same text of some length") for k in range(200)]
    df = frame(spark, rows).withColumns({
        "lang": F.when(F.col("doc_id") % 3 > 0, "en").otherwise(F.lit(None)), "source": F.when(F.col("doc_id") % 2 > 0, "a").otherwise("b")})
    found = shards.shard(df, shards=7).collect()
    assert len(found) == len(rows)
    sizes = {}
    for r in found:
        sizes.setdefault(r["shard"], []).append(r)
    for held in sizes.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    size = {k: sum(r["size"] for r in held) for k, held in sizes.items()}
    largest = max(r["size"] for r in found)
    assert max(size.values()) - min(size.values()) <= 2 * largest and set(size) <= set(range(7))
    assert sum(size.values()) == sum(len((t or "").encode()) + 1 for _, t in rows)
    by_bytes = shards.shard(df, target_bytes=20_000)
    assert by_bytes.groupBy("shard").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] <= 20_000 + 2 * largest
    assert shards.shard(spark.createDataFrame([], "doc_id long, text string, lang string, source string"), shards=3).collect() == []


def test_small_batches_hold_while_sets_are_compared(spark, monkeypatch):
    """Sets of two texts a row go to Python in batches of 8 MB, and the session's size is as before afterwards."""
    key, seen, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df: (seen.append(spark.conf.get(key)), stored(df))[1])
    before = spark.conf.get(key)
    texts = [" ".join(f"w{k}" for k in range(40)), " ".join(f"w{k}" for k in range(39))]
    found = jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["component_id"] for r in found] == [0, 0]
    assert "8m" in seen and spark.conf.get(key) == before


def test_pairs_of_groups_however_batched():
    """Small groups go through one leaf each, large ones through a tree; batches may cut groups anywhere."""
    rnd = np.random.default_rng(4)
    kind = pa.struct([("sig", pa.int64()), ("n", pa.int32())])
    rows = []
    for token, (size, other) in enumerate([(1, 0), (2, 0), (9, 1), (32, 0), (33, 0), (70, 1)]):
        for _ in range(size):
            values = rnd.choice(60, 50, replace=False).astype(np.uint64) << np.uint64(20)
            rows.append({"token": token, "node": {"sig": len(rows), "n": 50}, "pos": int(rnd.integers(0, 6)), "part": {"sig": int(rnd.integers(0, 3)), "n": 50},
                         "cell": int(rnd.integers(0, other + 1)), "block": 0, "other": other, "point": jaccard.point(values).tobytes()})
    expected = set()
    for j, y in enumerate(rows):
        for i, x in enumerate(rows[:j]):
            if x["token"] == y["token"] and x["part"] != y["part"] and (not x["other"] or x["cell"] != y["cell"]):
                p, q = (np.frombuffer(r["point"], np.uint32) for r in (x, y))
                if min(50 - x["pos"], 50 - y["pos"]) >= 45 <= np.minimum(p, q).sum():
                    expected.add((i, j))
    assert expected
    schema = pa.schema([("token", pa.int64()), ("node", kind), ("pos", pa.int32()), ("part", kind), ("cell", pa.int32()),
                        ("block", pa.int32()), ("other", pa.int32()), ("point", pa.binary())])
    for size in (1, 5, 1000):
        batches = [pa.RecordBatch.from_pylist(rows[k:k + size], schema=schema) for k in range(0, len(rows), size)]
        got = [tuple(sorted((r["a"]["sig"], r["b"]["sig"]))) for b in jaccard._joined(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_passages_send_words_of_regions_only(spark, monkeypatch):
    """What moves for the comparison are texts and words of regions, not all token hashes; a text of many regions is dealt to several tasks."""
    monkeypatch.setattr(passages, "MANY", 3)
    rnd = random.Random(51)
    prose = lambda n: " ".join(str(rnd.randrange(10**9)) for _ in range(n))
    shared = prose(70)
    texts = [f"{prose(30)}\t{shared.upper()}  {prose(300)}" for _ in range(20)]
    found = passages.repeated(frame(spark, list(enumerate(texts)))).collect()
    assert {i for r in found for i in (r["doc_id"], r["other_doc_id"])} == set(range(20))
    for r in found:
        a, b = models.words(texts[r["doc_id"]])[r["start"]:r["end"]], models.words(texts[r["other_doc_id"]])[r["other_start"]:r["other_end"]]
        a, b = (models.shingles(" ".join(w)) for w in (a, b))
        assert len(a & b) / len(a | b) == r["similarity"] >= 0.8
    batch = pa.RecordBatch.from_pylist(
        [{**dict.fromkeys(passages._REGION), "side": -1, "text": b"a b\n c d e f g h"},
         {"a": 1, "b": 2, "a_from": 1, "a_to": 3, "b_from": 0, "b_to": 9, "side": 0, "text": None},
         {"a": 0, "b": 1, "a_from": 5, "a_to": 6, "b_from": 2, "b_to": 9, "side": 1, "text": None},
         {"a": 0, "b": 1, "a_from": 5, "a_to": 6, "b_from": 9, "b_to": 12, "side": 1, "text": None}],
        schema=pa.schema([*[(k, pa.int64()) for k in passages._REGION], ("side", pa.int32()), ("text", pa.binary())]))
    assert [w for b in passages._cut(iter([batch.slice(0, 2), batch.slice(2)])) for w in b.column("words").to_pylist()] == [b"b\n c d e f g", b"c d e f g h", b""]


def test_groups_covered_by_their_first_text_are_not_opened(spark, monkeypatch):
    """Of windows whose pair with the first text covers them nothing goes on to the classes; of others the group does."""
    seen, classes = [], passages._keyed
    monkeypatch.setattr(passages, "_keyed", lambda bits: (seen.append(int(bits.any())), classes(bits))[1])
    rnd = random.Random(61)
    prose = lambda n: " ".join(str(rnd.randrange(10**9)) for _ in range(n))
    shared, few = prose(80), prose(24)
    passages.repeated(spark.createDataFrame([(k, f"{shared}") for k in range(3)] + [(9, f"{shared} x")], "doc_id long, text string")).collect()
    passages.repeated(spark.createDataFrame([(k, f"{prose(50)} {few} {prose(50)}") for k in range(40)], "doc_id long, text string")).collect()
    assert seen == [0, 1]


def test_compared_as_with_plain_sets():
    """Similarities are those of the shingle sets, also of repeated tokens and equal texts."""
    rnd = np.random.default_rng(9)
    for _ in range(100):
        x = rnd.integers(0, 2**63, 90).astype(np.uint64)[rnd.integers(0, 90, 120)]
        y = np.delete(x, rnd.integers(0, 120, rnd.integers(0, 9)))
        for s, e, p, q, j in passages.compared(x, y, 46):
            a, b = set(x[s:e].tolist()), set(y[p:q].tolist())
            assert j == len(a & b) / len(a | b) >= 0.8 and min(e - s, q - p) >= 46
    assert passages.compared(x, x.copy(), 46) == [(0, 120, 0, 120, 1.0)]
    assert passages.compared(x[:45], x[:45].copy(), 46) == []


def test_classes_of_texts_that_repeat_themselves_are_compared_only_where_they_may_link(monkeypatch):
    """Contexts with few different tokens share one of them, but only those that share most of a stretch are compared."""
    cycles = [[0] + [100 * k + i for i in range(1, 30)] for k in range(40)]
    cycles[21] = [*cycles[20][:29], 7777]
    cycles[31] = cycles[30][::-1]
    contexts = [np.array((c * 5)[:123], np.uint32) for c in cycles]
    some = np.arange(40)
    calls, plain = [], passages.compared
    want = [(i, j) for i in range(40) for j in range(i + 1, 40) if plain(contexts[i], contexts[j], 46)]
    monkeypatch.setattr(passages, "compared", lambda *a: calls.append(1) or plain(*a))
    assert passages.class_links(some, contexts, some, None, 46) == want == [(20, 21), (30, 31)]
    assert len(calls) <= 4
    rnd = np.random.default_rng(0)
    for _ in range(300):
        x, width = rnd.integers(0, rnd.integers(1, 12), rnd.integers(1, 40)).astype(np.uint32), int(rnd.integers(1, 15))
        assert passages.fewest(x, width) == min([len({*x[s:s + width].tolist()}) for s in range(len(x) - width + 1)] or [len({*x.tolist()})])


@pytest.mark.parametrize("split", [False, True])
def test_class_links_of_many_candidates_are_all_pairs(split):
    """Also where candidates are many, each pair of similar contexts is a link, not only those that join classes."""
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**32, 60).astype(np.uint32)
    contexts = []
    for k in range(60):
        own = base.copy()
        own[k % 20] = rnd.integers(0, 2**32)
        contexts.append(own)
    contexts[40:] = contexts[:20]
    some, cells = np.arange(60), np.arange(60) % 2 + 4 if split else None
    found = passages.class_links(some, contexts, some, cells, 46)
    assert len(found) == len({frozenset(p) for p in found}) == (900 if split else 60 * 59 // 2)
    # A class below 0 is of windows of several classes.
    mixed = np.array([-1] * 2 + [7] * 58)
    assert len(passages.class_links(some, contexts, mixed, None, 46)) == 1 + 2 * 58


def test_windows_of_a_text_that_repeats_itself_are_one_run():
    """What a word that is repeated gives is one stretch of tokens, not one for each place, and windows apart are runs of their own."""
    rnd = random.Random(71)
    prose = lambda n: " ".join(str(rnd.randrange(10**9)) for _ in range(n))
    again = " ".join(["again"] * 80)
    text = f"{prose(150)} {again} {prose(400)} {again} {prose(150)}"
    every = np.full(passages.FILTER_BITS // 64, ~np.uint64(0))
    batch = pa.RecordBatch.from_pydict({"text": [text]})
    rows = [r for b in passages._contexts(1, 46, 61, every)(iter([batch])) for r in b.to_pylist()]
    tokens = passages.text_shingles(text.encode())
    l, c, r = passages.compact_windows(tokens, 0, 46)
    assert sum(tokens[c] == tokens[150]) > 40
    key = int(passages.mixed(tokens[150:151] ^ passages._FACTORS[0]).view(np.int64)[0])
    runs = [r for r in rows if r["key"] == key]
    assert len(runs) == 2 and len(rows) < len(c)
    for row in runs:
        around = np.frombuffer(row["tokens"], np.uint32)
        assert row["low"] == row["first"] - 61 and len(around) == row["last"] - row["first"] + 123
        assert (around == tokens[row["low"]:row["low"] + len(around)].astype(np.uint32)).all() and row["left"] <= row["low"]
    assert passages.run_starts(np.array([3, 125, 247, 370, 371]), 61).tolist() == [0, 3]
    # The alignment of stretches of different lengths drifts in small steps, and covers both whole.
    for s, e, p, q in [(0, 50, 9, 59), (0, 50, 100, 400), (70, 320, 5, 60)]:
        places = passages.places_met(s, e, p, q)
        shifts = [y - x for x, y in places]
        assert places[0] == (s, p) and max(map(abs, np.diff(shifts)), default=0) <= passages.DRIFT
        assert e - s == q - p or places[-1] == (e - 1, q - 1)


def test_passages_of_texts_that_repeat_words_link_all_classes(spark):
    """Texts around a repeated word, none alike but there, are linked each with each across classes."""
    rnd = random.Random(81)
    prose = lambda n: " ".join(str(rnd.randrange(10**9)) for _ in range(n))
    texts = [f"{prose(70)} {' '.join([word] * rnd.randint(60, 140))} {prose(70)}" for word in ("one", "two") for _ in range(8)]
    found = passages.repeated(frame(spark, list(enumerate(texts)))).collect()
    linked = {frozenset((r["doc_id"], r["other_doc_id"])) for r in found}
    parent = list(range(16))
    root = lambda k: k if parent[k] == k else root(parent[k])
    for a, b in map(tuple, linked):
        assert a // 8 == b // 8
        parent[root(a)] = root(b)
    assert len({root(k) for k in range(16)}) == 2
    for r in found:
        a, b = texts[r["doc_id"]].split()[r["start"]:r["end"]], texts[r["other_doc_id"]].split()[r["other_start"]:r["other_end"]]
        assert min(len(a), len(b)) >= 50 and models.similar(models.shingles(" ".join(a)), models.shingles(" ".join(b)))


def test_contexts_agree_place_by_place():
    """Rows that agree in enough of some 46 places are similar there, and one pair of stretches is enough for windows with centres."""
    rnd = np.random.default_rng(13)
    rows = rnd.permutation(10**6)[:4 * 123].astype(np.uint64).reshape(4, 123)
    rows[1, 20:66] = rows[0, 20:66]
    rows[1, [30, 40, 50, 60, 65]] += np.uint64(10**7)
    rows[2, 20:66] = rows[1, 20:66]
    rows[2, 22] += np.uint64(10**8)
    assert passages.agree(rows, np.array([0, 0, 1, 0]), np.array([1, 2, 2, 3]), 46).tolist() == [True, False, True, False]
    contexts, centres = [*rows, np.roll(rows[0], 7)], np.array([61, 61, 61, 61, 54])
    some = np.arange(5)
    found = [(i, j) for i, j, _ in passages.class_stretches(some, contexts, some, None, 46, centres)]
    assert found == passages.class_links(some, contexts, some, None, 46) == [(0, 1), (0, 4), (1, 2), (1, 4)]
    for i, j in found:
        one, = passages.compared(contexts[i], contexts[j], 46, True)[:1]
        assert one in passages.compared(contexts[i], contexts[j], 46)
