"""Quality rules under weak supervision.

Each rule looks at one measure of a text and votes good, bad, or not at all. How far to trust a rule
in either direction is estimated from the votes alone by expectation-maximisation, and a text is kept
when its posterior probability of being good is large enough, instead of having to pass every rule.
All work on rows is expressions of the JVM.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored

WORD_BREAKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENDS = ".!?"
MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of ``text``, a row for each row of ``docs``; null counts as empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, n_capitals, n_ends, n_marks.
    Repeated three-word windows are told by a 64-bit hash.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", F.length("text").alias("n_chars"), count_of(F.col("text"), WORD_BREAKS).alias("n_breaks"),
        count_of(F.col("text"), SYMBOLS).alias("n_symbols"), count_of(F.col("text"), CAPITALS).alias("n_capitals"),
        count_of(F.col("text"), ENDS).alias("n_ends"), count_of(F.col("text"), MARKS).alias("n_marks"),
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    rows = rows.select(
        "doc_id", "n_chars", "n_breaks", "n_symbols", "n_capitals", "n_ends", "n_marks", F.size("words").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.expr("""case when size(words) < 3 then array()
                  else transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) end""").alias("windows"))
    rows = rows.select("*", F.expr("""
        case when size(array_distinct(windows)) = size(windows) then null
             else sort_array(transform(windows, (h, i) -> struct(h, i))) end""").alias("ordered"))
    rows = rows.select("*", F.expr("""
        sort_array(transform(filter(ordered, (x, k) ->
            (k > 0 and ordered[greatest(k - 1, 0)].h = x.h)
            or (k < size(ordered) - 1 and ordered[least(k + 1, size(ordered) - 1)].h = x.h)), x -> x.i))""").alias("repeats"))
    # A repeated window covers three words, less those that the one before has covered.
    covered = F.expr("""coalesce(aggregate(repeats, struct(0 as n, -3 as last),
        (a, p) -> struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n), 0)""")
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), (F.col("n_chars") - F.col("n_breaks")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), "n_chars", "n_capitals", "n_ends", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good`` and bad from ``bad`` on (the other way round if good is larger)."""

    name: str
    value: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.value)
        up = self.good < self.bad
        good = value <= self.good if up else value >= self.good
        bad = value >= self.bad if up else value <= self.bad
        return F.when(good, 1).when(bad, -1).otherwise(0)


RULES = (
    Rule("words", "n_words", 50, 15),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.05, 0.2),
    Rule("marks", "n_marks / greatest(word_chars, 1)", 0.08, 0.12),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.2, 0.5),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.2, 0.4),
    Rule("lines", "n_dup_lines / greatest(n_words, 1)", 0.01, 0.05),
    Rule("long_words", "word_chars / greatest(n_words, 1)", 8.5, 12),
    Rule("short_words", "word_chars / greatest(n_words, 1)", 3, 2),
    Rule("sentences", "n_ends / greatest(n_words, 1)", 0.02, 0.005),
    Rule("endings", "n_ends / greatest(n_words, 1)", 0.35, 0.7),
)


@dataclass
class LabelModel:
    """Per rule, how often it votes good on good and on bad texts; and the share of good texts."""

    on_good: list[float]
    on_bad: list[float]
    share: float

    def weights(self) -> list[tuple[float, float]]:
        """What a good and a bad vote add to the log odds."""
        return [(math.log(a / b), math.log((1 - a) / (1 - b))) for a, b in zip(self.on_good, self.on_bad, strict=True)]

    def log_odds(self, votes) -> float:
        total = math.log(self.share / (1 - self.share))
        for v, (good, bad) in zip(votes, self.weights(), strict=True):
            total += good if v > 0 else bad if v < 0 else 0.0
        return total

    def posterior(self, votes: Column) -> Column:
        """The same for a column holding the array of votes."""
        total = F.lit(math.log(self.share / (1 - self.share)))
        for k, (good, bad) in enumerate(self.weights()):
            total = total + F.when(votes[k] > 0, good).when(votes[k] < 0, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


#: Before the votes are seen: how often a rule votes good on good and on bad texts, and the share of good texts. A
#: rule is seldom wrong on a good text, while a bad one usually breaks one or two rules and passes the others.
BELIEF = LabelModel([0.99] * len(RULES), [0.75] * len(RULES), 0.85)


def fit(patterns: list[tuple[list[int], int]], start: LabelModel = BELIEF, rounds: int = 200, weight: float = 0.005) -> LabelModel:
    """Expectation-maximisation over (votes, number of rows with them).

    ``start`` is also a prior that counts like ``weight`` of the rows (20 at least) on either side, which names the sides.
    """
    model, rows = start, sum(n for _, n in patterns)
    belief = max(20.0, weight * rows)
    for _ in range(rounds):
        good = [[a * belief, belief] for a in start.on_good]
        bad = [[a * belief, belief] for a in start.on_bad]
        total = start.share * belief
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(votes)))))
            total += n * p
            for k, v in enumerate(votes):
                if v:
                    good[k][0] += n * p * (v > 0)
                    good[k][1] += n * p
                    bad[k][0] += n * (1 - p) * (v > 0)
                    bad[k][1] += n * (1 - p)
        clip = lambda x: min(0.9999, max(0.0001, x))
        new = LabelModel([clip(a / b) for a, b in good], [clip(a / b) for a, b in bad], clip(total / (rows + belief)))
        moved = max(abs(x - y) for x, y in zip(new.on_good + new.on_bad + [new.share], model.on_good + model.on_bad + [model.share], strict=True))
        model = new
        if moved < 1e-7:
            break
    return model


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, belief: LabelModel = BELIEF, threshold: float = 0.5) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, votes, quality, kept.

    Votes of all rows are counted by pattern, of which there are at most 3 to the number of rules,
    and the model is fitted on these counts. A row is kept when it does not fail the base rules and
    its posterior ``quality`` reaches ``threshold``. Null and empty texts fail. An empty table gives no row.
    """
    rows = measured(docs).withColumn("votes", F.array(*[r.vote() for r in rules]))
    rows = stored(rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "votes"))
    patterns = [(list(r["votes"]), r["count"]) for r in rows.groupBy("votes").count().orderBy("votes").collect()]
    model = fit(patterns, belief)
    return (rows.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior(F.col("votes")))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
