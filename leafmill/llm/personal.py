"""Personal data: base patterns, and identifiers found by bootstrapped context.

The spans of the base patterns are seeds. The words before and after them become patterns; a pattern
is scored by how much of what follows (or precedes) it in the whole corpus are known identifiers, an
unknown identifier-like token by the patterns around it, and both in turn, over a table of
(pattern, instance) edges. Neighbouring tokens of that kind are one instance. Those that sure patterns surround are added as
spans of kind ``context``.
All work is expressions, joins and aggregations of the JVM.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored

_LOCAL = "[A-Za-z0-9._%+-]"
_NAME = "[A-Za-z0-9-]"
#: Possessive forms of the base patterns: what they match is the same, in linear time and without recursion.
#: A match that could start inside a run starts at the run's head, or where the last match ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = tuple(BASE)
_BREAK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
#: A token with a digit or an at sign.
TOKEN = rf"(?<!{_WORD}){_WORD}*?[0-9@]{_WORD}*+"
#: Matches whose places are added up one by one; longer lists are handled in blocks of so many.
BLOCK = 256


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _find(text: str, pattern: str, need: str = "") -> Column:
    """All matches, left to right."""
    found = F.expr(f"regexp_extract_all({text}, {_literal(pattern)}, 0)")
    return F.when(F.contains(F.col(text), F.lit(need)), found).otherwise(F.array().cast("array<string>")) if need else found


def _placed(text: str, pattern: str, matches: str, gap: dict[str, str] | None = None) -> Column:
    """Array of (at, len, value) of ``matches``, at counting code points of ``text``, and of the strings that ``gap`` names.

    Those are expressions of ``i``, the number of the match, and ``gaps``, of which i stands before it and i + 1 behind it.
    Lengths of gaps and matches are added up within blocks, and blocks then shifted, so that
    the work grows with the number of matches and not with its square.
    """
    gap = gap or {}
    kind = f"array<struct<at: int, len: int, value: string{''.join(f', {k}: string' for k in gap)}>>"
    made, kept = ("".join(f", {value} as {k}" for k, value in pairs) for pairs in (gap.items(), [(k, f"s.{k}") for k in gap]))
    return F.expr(f"""
        case when size({matches}) = 0 then cast(array() as {kind})
        else transform(array(split({text}, {_literal(pattern)}, -1)), gaps ->
            transform(array(transform(sequence(0, cast(ceil(size({matches}) / {BLOCK}) as int) - 1), b ->
                aggregate(sequence(b * {BLOCK}, least((b + 1) * {BLOCK}, size({matches})) - 1),
                    struct(0 as total, cast(array() as {kind}) as out),
                    (a, i) -> struct(
                        a.total + length(get(gaps, i)) + length(get({matches}, i)) as total,
                        concat(a.out, array(struct(
                            a.total + length(get(gaps, i)) as at, length(get({matches}, i)) as len, get({matches}, i) as value{made}))) as out)))),
                blocks -> transform(array(aggregate(blocks, cast(array(0) as array<int>),
                        (o, x) -> concat(o, array(get(o, size(o) - 1) + x.total)))),
                    shifts -> flatten(transform(blocks, (x, k) -> transform(x.out,
                        s -> struct(s.at + get(shifts, k) as at, s.len as len, s.value as value{kept})))))[0])[0])[0]
        end""")


def _digits(value: str) -> str:
    return f"translate({value}, translate({value}, '0123456789', ''), '')"


def _passes(kind: str) -> str:
    """Condition on span ``s``."""
    if kind == "ip":
        part = "0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
        return f"s.value rlike '^{part}([.]{part}){{3}}$'"
    if kind == "card":
        d = _digits("s.value")
        luhn = f"""aggregate(sequence(1, length({d})), 0, (a, i) -> a + transform(array(
            cast(substr({d}, -i, 1) as int) * if(i % 2 = 0, 2, 1)), v -> v - if(v > 9, 9, 0))[0]) % 10 = 0"""
        return f"length({d}) between 14 and 19 and {luhn}"
    if kind == "phone":
        return f"length({_digits('s.value')}) between 10 and 15"
    return "true"


def _with_base(rows: DataFrame) -> DataFrame:
    """Add ``base``: array of (start, k, end, value), ordered, k counting through ``KINDS``."""
    rows = rows.withColumns({f"m_{k}": _find("text", BASE[k], NEEDS[k]) for k in KINDS})
    rows = rows.withColumns({f"p_{k}": _placed("text", BASE[k], f"m_{k}") for k in KINDS})
    parts = [f"""transform(filter(p_{kind}, s -> {_passes(kind)}),
        s -> struct(s.at as start, {n} as k, s.at + s.len as end, s.value as value))""" for n, kind in enumerate(KINDS)]
    return rows.withColumn("base", F.expr(f"sort_array(concat({', '.join(parts)}))")).drop(*[f"{p}_{k}" for k in KINDS for p in "mp"])


def _word(gap: str, last: bool) -> str:
    """The last (or first) word of a gap between tokens, or an empty string."""
    pattern = rf"(?<!{_WORD})({_WORD}++){_BREAK}*+\z" if last else rf"^{_BREAK}*+({_WORD}++)"
    return f"regexp_extract({gap}, {_literal(pattern)}, 1)"


def _normal(word: str) -> str:
    """A word in lower case, a run of digits as 0; empty for null."""
    return f"lower(regexp_replace(coalesce({word}, ''), '[0-9]+', '0'))"


def detected(docs: DataFrame) -> DataFrame:
    """row, doc_id, base and candidates of all ``docs`` (doc_id, text), stored; both with the words ``left`` and ``right`` of them.

    ``candidates`` are tokens with a digit or an at sign that touch no base span, neighbouring ones as one. Since the first of several may be
    the word that tells (as in ``type2 K81``), they also stand without it, with it as their left word; likewise the last. A base span's
    words are those around the tokens it touches. Where no other word stands between two tokens, each is the other's word.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = _with_base(rows)
    rows = rows.withColumn("m_token", _find("text", TOKEN))
    rows = rows.withColumn("p_token", _placed("text", TOKEN, "m_token", {
        "before": _word("get(gaps, i)", True), "after": _word("get(gaps, i + 1)", False)}))
    rows = rows.withColumn("tokens", F.expr(f"""transform(p_token, (s, i) -> struct(
        i, s.at as start, s.at + s.len as end, s.value as value, i > 0 and s.before = '' as next,
        {_normal("if(s.before = '', get(m_token, i - 1), s.before)")} as left, {_normal("if(s.after = '', get(m_token, i + 1), s.after)")} as right,
        not exists(base, b -> b.start < s.at + s.len and s.at < b.end) as free))"""))
    rows = rows.withColumn("heads", F.expr("filter(tokens, (t, i) -> t.free and not (t.next and get(tokens, i - 1).free))"))
    rows = rows.withColumn("tails", F.expr("filter(tokens, (t, i) -> t.free and not coalesce(get(tokens, i + 1).next and get(tokens, i + 1).free, false))"))
    joined = "array_join(slice(m_token, {0} + 1, {1} - {0} + 1), ' ')"
    candidates = F.expr(f"""flatten(transform(heads, (h, k) -> transform(array(get(tails, k)), t -> if(h.i = t.i,
        array(struct(h.start as start, t.end as end, h.value as value, h.left as left, t.right as right)),
        array(struct(h.start as start, t.end as end, {joined.format("h.i", "t.i")} as value, h.left as left, t.right as right),
              struct(get(tokens, h.i + 1).start as start, t.end as end, {joined.format("(h.i + 1)", "t.i")} as value, get(tokens, h.i + 1).left as left, '' as right),
              struct(h.start as start, get(tokens, t.i - 1).end as end, {joined.format("h.i", "(t.i - 1)")} as value, '' as left, get(tokens, t.i - 1).right as right))))[0]))""")
    base = F.expr("""transform(base, b -> transform(array(filter(tokens, t -> not t.free and b.start < t.end and t.start < b.end)), o -> struct(
        b.start as start, b.k as k, b.end as end, b.value as value, get(o, 0).left as left, get(o, size(o) - 1).right as right))[0])""")
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), candidates.alias("candidates")))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (as ``_normal`` writes it), total: how often it stands in all texts."""
    words = F.explode(F.split(F.col("text"), _BREAK + "+")).alias("word")
    counts = docs.select(words).where("word != ''").groupBy("word").count()
    return counts.groupBy(F.expr("lower(regexp_replace(word, '[0-9]+', '0'))").alias("word")).agg(F.sum("count").alias("total"))


def _edges(rows: DataFrame, spans: str) -> DataFrame:
    """(pattern, instance) with the number of times they meet; a pattern is a side and a word."""
    s = rows.select(F.explode(spans).alias("s"))
    sides = F.explode(F.array(F.struct(F.lit("L").alias("side"), F.col("s.left").alias("word")), F.struct(F.lit("R").alias("side"), F.col("s.right").alias("word"))))
    return (s.select("s.value", sides.alias("p")).where("p.word != ''")
            .groupBy(F.col("p.side").alias("side"), F.col("p.word").alias("word"), "value").agg(F.count("*").alias("n")))


def sure_patterns(rows: DataFrame, docs: DataFrame, rounds: int = 3, support: int = 3, sure: float = 0.5) -> DataFrame:
    """side, word, score of the patterns that tell an identifier.

    A pattern starts from at least ``support`` different seeds. Its score is the confidence of its instances, summed over
    their occurrences and divided by all occurrences of its word; an instance's is the chance
    that not all of its patterns are wrong, seeds being certain. Patterns below ``sure`` pass nothing on.
    """
    seeds = _edges(rows, "base").withColumn("seed", F.lit(1.0))
    others = _edges(rows, "candidates").withColumn("seed", F.lit(0.0))
    induced = stored(seeds.groupBy("side", "word").agg(F.count("*").alias("different")).where(F.col("different") >= support)
                     .join(word_counts(docs), "word").select("side", "word", "total"))
    edges = stored(seeds.unionByName(others).join(induced, ["side", "word"]))
    score = F.least(F.lit(1.0), F.sum(F.col("n") * F.col("belief")) / F.max("total"))
    patterns = edges.withColumn("belief", F.col("seed")).groupBy("side", "word").agg(score.alias("score"))
    for _ in range(rounds - 1):
        passed = edges.join(patterns.where(F.col("score") >= sure), ["side", "word"])
        # log of the chance that all are wrong
        beliefs = passed.groupBy("value").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("found"))
        belief = F.greatest("seed", F.coalesce("found", F.lit(0.0)))
        patterns = stored(edges.join(beliefs, "value", "left").withColumn("belief", belief).groupBy("side", "word").agg(score.alias("score")))
    return patterns.where(F.col("score") >= sure)


def find(docs: DataFrame, rounds: int = 3, support: int = 3, sure: float = 0.5) -> DataFrame:
    """doc_id and ``personal``, an array of (kind, start, end) in code points ordered by start and kind.

    A row for each row of ``docs`` (doc_id, text), read whole; null is an empty text. Base spans always stay.
    """
    rows = detected(docs)
    patterns = sure_patterns(rows, docs.select("text"), rounds, support, sure)
    spans = rows.select("row", F.explode("candidates").alias("s"))
    hits = None
    for side, name in (("L", "left"), ("R", "right")):
        words = patterns.where(F.col("side") == side).select(F.col("word").alias("w"))
        hit = spans.join(words, spans[f"s.{name}"] == F.col("w"), "left_semi")
        hits = hit if hits is None else hits.unionByName(hit)
    added = hits.select("row", F.struct(F.col("s.start").alias("start"), F.lit(len(KINDS)).alias("k"), F.col("s.end").alias("end")).alias("s"))
    added = added.groupBy("row").agg(F.collect_set("s").alias("added"))
    names = F.array(*[F.lit(k) for k in (*KINDS, "context")])
    merged = F.sort_array(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"))),
        F.coalesce("added", F.array().cast("array<struct<start: int, k: int, end: int>>"))))
    out = F.transform(merged, lambda s: F.struct(names[s["k"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(added, "row", "left").select("doc_id", out.alias("personal"))
