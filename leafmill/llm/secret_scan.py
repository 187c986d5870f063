"""Secret scan: base patterns, and a linear-chain conditional random field that adds to them.

Tokens are tagged as begin, inside or outside of a secret from their shape, the neighbouring words
and features of the whole text. The field is trained on what the base patterns find in a sample,
so it learns the look and surroundings of secrets and then also tags those no pattern names.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import appended, last_picks, strings

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # greedy and maximal: shorter runs need no second look
KINDS = ("assign", "access", "hex", "crf")
#: What a text must hold for the first two patterns.
HINT = re.compile("passw|secret|token|api", re.ASCII | re.IGNORECASE)
#: The same finds as a filter inside the JVM, only to choose the sample.
LIKELY = r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

BEGIN, INSIDE, OUTSIDE = 0, 1, 2
TOKEN = re.compile(r"""[^\s=:"'(),;<>\[\]{}|]+|[=:"'(),;<>\[\]{}|]""")
SPACE = re.compile(r"\s")
#: Characters of a text tagged at once, and tokens a task remembers.
BLOCK, MEMORY = 1 << 18, 200_000
OFFSETS = (-1, -2, -3, 1)
NO_TOKEN = "\n"


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, ordered; kind counts through ``KINDS``."""
    if not text:
        return []
    found = []
    if HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves are: of an assignment only its value."""
    parts = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if HINT.search(text) else []
    return sorted({*parts, *((s, e) for s, k, e in base_spans(text) if k)})


#: Features of words by length, without and with a mark at their end.
_PLAIN: dict[int, list[str]] = {}
_ENDED: dict[int, list[str]] = {}


def shape_features(token: str) -> list[str]:
    """Length, kinds of characters and how they mix."""
    n = len(token)
    if n in _PLAIN and token[:-1].isalpha():
        return _PLAIN[n] if token[-1].isalpha() else _ENDED[n]
    size = "1" if n == 1 else "short" if n < 8 else "mid" if n < 12 else "long" if n < 16 else "key" if n < 64 else "huge"
    if n < 8 or token.isalpha():
        kind = "delim" if n == 1 and not token.isalnum() else "digits" if token.isdigit() else "alpha" if token.isalpha() else "mixed"
        return [f"size={size}", f"kind={kind}", f"size={size}&kind={kind}"]
    digits = sum(c.isdigit() for c in token)
    uppers = sum("A" <= c <= "Z" for c in token)
    lowers = sum("a" <= c <= "z" for c in token)
    joins = sum(c in "+/_.-" for c in token)
    other = n - digits - uppers - lowers - joins
    kind = "".join(k for k, v in (("d", digits), ("u", uppers), ("l", lowers), ("j", joins), ("x", other)) if v)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    mix = min(4, 10 * changes // n)
    web = "@" in token or "." in token or "/" in token
    distinct = min(4, 8 * len(set(token)) // n)
    return [f"size={size}", f"kind={kind}", f"size={size}&kind={kind}", f"mix={mix}", f"size={size}&mix={mix}",
            f"web={web}", f"distinct={distinct}", f"digits={4 * digits // n}"]


_PLAIN.update({n: shape_features("a" * n) for n in range(2, 64)})
_ENDED.update({n: [*_PLAIN[n], "ended"] for n in _PLAIN})


def file_features(text: str) -> list[str]:
    """Length and how much the text looks like code or settings."""
    n = max(1, len(text))
    marks = sum(map(text.count, "={};"))
    return [f"file_size={min(5, len(str(n)))}", f"file_marks={min(3, 1000 * marks // n // 3)}"]


def _word(token: str) -> str:
    return token.lower()[:24]


def neighbour_feature(offset: int, token: str) -> str:
    return f"at{offset}={_word(token)}"


class Field:
    """Weights of the features (begin, inside, outside) and of the transitions."""

    def __init__(self, weights: dict[str, list[float]], moves: list[list[float]]):
        self.weights, self.moves = weights, np.array(moves, np.float64)
        t = self.moves
        #: The most that tagging a token b or i instead of o can gain from its two transitions.
        self.gain = [max(t[a, x] + t[x, b] - t[a, 2] - t[2, b] for a in range(3) for b in range(3)) for x in (0, 1)]

        #: Words with a weight as a neighbour: scores for each of ``OFFSETS``, one after the other.
        self.around: dict[str, list[float]] = {}
        for k, offset in enumerate(OFFSETS):
            head = f"at{offset}="
            for feature, row in weights.items():
                if feature.startswith(head):
                    self.around.setdefault(feature[len(head):], [0.0] * 3 * len(OFFSETS))[3 * k:3 * k + 3] = row

    def score(self, features) -> list[float]:
        rows = [self.weights[f] for f in features if f in self.weights]
        return [sum(column) for column in zip(*rows, strict=True)] if rows else [0.0] * 3


class Tagger:
    """Viterbi over the tokens of a text; scores of tokens are computed once per token and task."""

    def __init__(self, field: Field):
        self.field = field
        self.reset()

    def reset(self):
        self.rows: dict[str, int] = {}
        self.shapes: dict[tuple, list[float]] = {}
        self.table = np.zeros((4096, 3 * (1 + len(OFFSETS))))
        self._add([NO_TOKEN])

    def _add(self, tokens: list[str]):
        plain, around, rows = [0.0] * 3 * len(OFFSETS), self.field.around, []
        for token in tokens:
            features = tuple(shape_features(token)) if token != NO_TOKEN else ()
            shape = self.shapes.get(features)
            if shape is None:
                shape = self.shapes[features] = self.field.score(features)
            rows.append(shape + around.get(_word(token), plain))
        first = len(self.rows)
        while first + len(rows) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[first:first + len(rows)] = rows
        self.rows.update(zip(tokens, range(first, first + len(rows)), strict=True))

    def _ids(self, tokens: list[str]) -> np.ndarray:
        new = {*tokens}.difference(self.rows)
        if len(self.rows) + len(new) > MEMORY:
            self.reset()
            new = {*tokens}
        if new:
            self._add(list(new))
        return np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))

    def tags(self, tokens: list[str], file_score: np.ndarray) -> list[tuple[int, int]]:
        """First and last token of each secret, by the best path over the whole sequence.

        A token whose own score cannot outweigh the most that transitions could gain is outside on the
        best path; only the runs between such tokens are walked.
        """
        n = len(tokens)
        if not n:
            return []
        ids = self._ids(tokens)
        scores = self.table[ids, :3] + file_score
        for k, offset in enumerate(OFFSETS):
            part = self.table[:, 3 * (k + 1):3 * (k + 2)]
            there = np.zeros(n, np.int64)  # beyond either end: the row of no token
            if offset < 0:
                there[-offset:] = ids[:offset] if n > -offset else ids[:0]
            else:
                there[:-offset] = ids[offset:]
            scores += part[there]
        lead = scores[:, :2] - scores[:, 2:]
        open_ = np.flatnonzero((lead[:, 0] + self.field.gain[0] >= 0) | (lead[:, 1] + self.field.gain[1] >= 0))
        found = []
        if len(open_):
            for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
                found += [(run[0] + a, run[0] + b) for a, b in self._walk(scores[run])]
        return found

    def _walk(self, scores: np.ndarray) -> list[tuple[int, int]]:
        moves = self.field.moves
        best, back = moves[OUTSIDE] + scores[0], []
        for row in scores[1:]:
            paths = best[:, None] + moves
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        tag = int((best + moves[:, OUTSIDE]).argmax())
        path = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            path.append(tag)
        path.reverse()
        out, start = [], None
        for i, tag in enumerate([*path, OUTSIDE]):
            if start is not None and tag != INSIDE:
                out.append((start, i - 1))
                start = None
            if tag == BEGIN or tag == INSIDE and start is None:
                start = i
        return out

    def spans(self, text: str | None) -> list[tuple[int, int]]:
        """Code points of the secrets in the whole text, tagged in blocks cut at white space."""
        if not text:
            return []
        file_score = np.array(self.field.score(file_features(text)))
        found, at = [], 0
        while at < len(text):
            cut = SPACE.search(text, at + BLOCK) if at + BLOCK < len(text) else None
            stop = cut.start() if cut else len(text)
            tokens = TOKEN.findall(text, at, stop)
            runs = self.tags(tokens, file_score)
            if runs:
                places = [m.span() for m in TOKEN.finditer(text, at, stop)]
                found += [(places[a][0], places[b][1]) for a, b in runs]
            at = stop
        return found


def training_windows(text: str, reach: int = 8, plain: int = 6) -> list[tuple[list[list[str]], list[int]]]:
    """Token features and tags around each secret, and around some tokens without one."""
    places = [m.span() for m in TOKEN.finditer(text)]
    if not places:
        return []
    tokens = [text[a:b] for a, b in places]
    tags, k = [OUTSIDE] * len(tokens), 0
    secrets = secret_parts(text)
    for i, (a, b) in enumerate(places):
        while k < len(secrets) and secrets[k][1] <= a:
            k += 1
        if k < len(secrets) and secrets[k][0] < b and a < secrets[k][1]:
            inside = i and tags[i - 1] != OUTSIDE and places[i - 1][1] > secrets[k][0]
            tags[i] = INSIDE if inside else BEGIN
    marked = [i for i, t in enumerate(tags) if t != OUTSIDE]
    odd = [i for i, t in enumerate(tokens) if tags[i] == OUTSIDE and any(map(str.isdigit, t))]
    centers = marked[:20] + odd[:plain] + [j * len(tokens) // plain for j in range(plain)]
    shared, out, done = file_features(text), [], -1
    for c in sorted(centers):
        if c <= done:
            continue
        first, last = max(0, c - reach), min(len(tokens), c + reach)
        done = last - 1
        features = [shape_features(tokens[i]) + shared + [
            neighbour_feature(o, tokens[i + o] if 0 <= i + o < len(tokens) else NO_TOKEN) for o in OFFSETS] for i in range(first, last)]
        out.append((features, tags[first:last]))
    return out


def train_field(windows, rounds: int = 60, rate: float = 0.5, decay: float = 1e-5, least: int = 3) -> Field:
    """Maximise the likelihood of the tags by gradient steps over all windows at once."""
    counts: dict[str, int] = {}
    for features, _ in windows:
        for row in features:
            for f in row:
                counts[f] = counts.get(f, 0) + 1
    index = {f: i + 1 for i, f in enumerate(sorted(f for f, n in counts.items() if n >= least))}
    size = max(len(tags) for _, tags in windows)
    wide = max(len(row) for features, _ in windows for row in features)
    x = np.zeros((len(windows), size, wide), np.int64)  # 0: no feature
    y = np.full((len(windows), size), OUTSIDE)
    live = np.zeros((len(windows), size), bool)
    for s, (features, tags) in enumerate(windows):
        for t, row in enumerate(features):
            known = [index[f] for f in row if f in index]
            x[s, t, :len(known)] = known
        y[s, :len(tags)] = tags
        live[s, :len(tags)] = True
    truth = np.eye(3)[y] * live[..., None]
    pairs = np.zeros((3, 3))
    both = live[:, 1:] & live[:, :-1]
    np.add.at(pairs, (y[:, :-1][both], y[:, 1:][both]), 1)
    w, moves = np.zeros((len(index) + 1, 3)), np.zeros((3, 3))
    seen_w, seen_m = np.full_like(w, 1e-8), np.full_like(moves, 1e-8)
    flat = x.reshape(-1, wide)
    for _ in range(rounds):
        e = w[x].sum(axis=2)
        forward = np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for t in range(1, size):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        behind = np.zeros_like(e)
        expected = np.zeros((3, 3))
        for t in range(size - 2, -1, -1):
            ahead = moves + (e[:, t + 1] + behind[:, t + 1])[:, None, :]
            behind[:, t] = np.where(live[:, t + 1, None], np.logaddexp.reduce(ahead, axis=2), 0.0)
            joint = np.exp(forward[:, t, :, None] + ahead - total[:, None, None])
            expected += joint[live[:, t + 1]].sum(axis=0)
        chance = np.exp(forward + behind - total[:, None, None]) * live[..., None]
        slack = (truth - chance).reshape(-1, 3)
        grad = np.stack([np.bincount(flat.ravel(), np.repeat(slack[:, k], wide), len(w)) for k in range(3)], axis=1)
        grad = grad / len(windows) - decay * w
        grad[0] = 0
        grad_m = (pairs - expected) / len(windows) - decay * moves
        seen_w += grad ** 2
        seen_m += grad_m ** 2
        w += rate * grad / np.sqrt(seen_w)
        moves += rate * grad_m / np.sqrt(seen_m)
    return Field({f: w[i].tolist() for f, i in index.items()}, moves.tolist())


def _windows(batches):
    for batch in batches:
        rows = [(f, t) for text in strings(batch, "text") for f, t in training_windows(text or "")]
        if rows:
            yield pa.RecordBatch.from_pydict({
                "features": pa.array([f for f, _ in rows], pa.list_(pa.list_(pa.string()))),
                "tags": pa.array([t for _, t in rows], pa.list_(pa.int32()))})


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    windows = sorted(([list(map(str, r)) for r in f], [int(x) for x in t]) for f, t in zip(group["features"], group["tags"], strict=True))
    field = train_field(windows)
    return pd.DataFrame({"features": [list(field.weights)], "weights": [[x for v in field.weights.values() for x in v]],
                         "moves": [field.moves.ravel().tolist()]})


def fit_field(docs: DataFrame, sample: int = 500) -> Field | None:
    """Train on at most ``sample`` different texts with base finds and as many others, the first by a hash.

    None when no text has a base find.
    """
    texts = docs.select("text").where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("pick"), F.col("text").rlike(LIKELY).alias("likely"))
    ends = last_picks(texts, "likely", sample)
    if True not in ends:
        return None
    # The pattern is only tried on texts whose hash is small enough for either part.
    chosen = texts.where(((F.col("pick") <= ends[True]) & F.col("likely")) | ((F.col("pick") <= F.lit(ends.get(False)).cast("long")) & ~F.col("likely")))
    windows = chosen.dropDuplicates(["pick"]).select("text").mapInArrow(_windows, "features array<array<string>>, tags array<int>")
    rows = windows.groupBy(F.lit(0).alias("model")).applyInPandas(_fit, "features array<string>, weights array<double>, moves array<double>").collect()
    if not rows:
        return None
    weights = np.array(rows[0]["weights"]).reshape(-1, 3).tolist()
    return Field(dict(zip(rows[0]["features"], weights, strict=True)), np.array(rows[0]["moves"]).reshape(3, 3).tolist())


def scan(docs: DataFrame, field: Field | None = None, sample: int = 500) -> DataFrame:
    """Add ``secrets``, an array of (kind, start, end) in code points, ordered by start and kind, to ``docs``.

    Base finds always stay; a tagged span is added (kind ``crf``) where it touches none of them.
    Null is an empty text; texts are read whole.
    """
    field = field or fit_field(docs, sample)

    def start():
        tagger = Tagger(field) if field else None

        def work(texts):
            return [[_all_spans(text, tagger) for text in texts]]

        return work

    return appended(docs, "secrets array<struct<kind: string, start: int, end: int>>", start, ["text"])


def _all_spans(text, tagger):
    base = base_spans(text)
    more = tagger.spans(text) if tagger else []
    found = base + [(a, 3, b) for a, b in more if not any(s < b and a < e for s, _, e in base)] if more else base
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)]


def redacted(docs: DataFrame, field: Field | None = None, mark: str = "[SECRET]", sample: int = 500) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; touching or overlapping spans become one mark.

    Null texts stay null.
    """
    field = field or fit_field(docs, sample)

    def start():
        tagger = Tagger(field) if field else None

        def clean(text):
            spans = _all_spans(text, tagger)
            if not spans:
                return text
            out, at = [], 0
            for s in spans:
                if not out or s["start"] > at:
                    out += [text[at:s["start"]], mark]
                at = max(at, s["end"])
            return "".join([*out, text[at:]])

        return lambda texts: [[clean(t) for t in texts]]

    found = appended(docs, "_redacted string", start, ["text"])
    return found.select(*[F.col("_redacted").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
