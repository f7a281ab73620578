"""Quality of documents by weak supervision: rules vote or abstain, EM weighs the votes.

Each rule says good (1), bad (-1) or nothing (0) about a document. How often a rule is right
is not known; expectation-maximisation estimates it from how the rules agree, and a
document's posterior probability of being good follows from its votes. Rows with equal votes
are counted first, so that EM works on at most ``3 ** rules`` counted patterns, however many
documents there are. All work on texts is column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acopio.llm.text import EDGES, words

WINDOW = 5
ROUNDS = 50
#: Before any vote is seen: the share of good documents, the chance that a vote on a good and on a bad one
#: is right (most rules see nothing wrong with most bad ones), and how many votes these beliefs count for.
PRIOR_GOOD, PRIOR_RIGHT, PRIOR_VOTES = 0.85, (0.3, 0.98), 50.0
LEAST_RIGHT = (0.02, 0.8)

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct"]


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The counts that the rules look at, beside ``docs``; columns of these names are replaced.

    n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``), n_dup_lines (lines
    with a word equal to an earlier one), n_repeat_words (words in 5-word windows that stand
    in the text twice or more), n_lines (with a word), n_upper (A-Z), n_distinct (different words). A null text counts as empty: all are 0.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, h, two, four, five, t, located, same = (f"_op7_{c}" for c in ("words", "hashes", "two", "four", "five", "lines", "located", "same"))
    n, m = F.size(w), F.size(located)

    def joined(left: str, right: str, ahead: int) -> Column:
        """Element i of ``left`` and element i + ahead of ``right`` as one number; null past the end."""
        return F.zip_with(left, F.slice(right, ahead + 1, n), lambda a, b: a.bitwiseXOR(F.shiftleft(b, ahead)))

    # Each of these is a column of its own: inside a lambda it would be worked out for every element.
    steps = {
        w: words(F.col(text_col)),
        h: F.transform(w, lambda x: F.xxhash64(x)),
        two: F.when(n >= WINDOW, joined(h, h, 1)),
        four: joined(two, two, 2),
        # few texts repeat four words: only those get windows of five, located and sorted
        five: F.when(F.size(F.array_distinct(four)) < n - 2, joined(four, h, 4)),
        t: F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(EDGES)) != ""),
        located: F.sort_array(F.transform(F.slice(five, 1, n - WINDOW + 1), lambda x, i: F.struct(x.alias("g"), i.alias("i")))),
        same: F.zip_with(F.slice(located, 1, m - 1), F.slice(located, 2, m - 1), lambda a, b: a["g"] == b["g"]),
    }
    staged = docs
    for name, e in steps.items():
        staged = staged.withColumn(name, e)
    edge = F.array(F.lit(False))
    twin = F.zip_with(F.concat(edge, F.col(same)), F.concat(F.col(same), edge), lambda a, b: a | b)
    starts = F.sort_array(F.filter(F.zip_with(F.col(located), twin, lambda x, hit: F.when(hit, x["i"])), lambda i: i.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, s: F.struct((acc["n"] + F.least(s - acc["last"], F.lit(WINDOW))).alias("n"), s.alias("last")),
        lambda acc: acc["n"],
    )
    of = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(t) - F.size(F.array_distinct(t)),
        "n_repeat_words": F.when(F.col(located).isNotNull(), covered).otherwise(0),
        "n_lines": F.size(t),
        "n_upper": F.length(F.regexp_replace(text, "[^A-Z]+", "")),
        "n_distinct": F.size(F.array_distinct(h)),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in of]
    return staged.select(*kept, *(e.cast("long").alias(c) for c, e in of.items()))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """What each rule says of a row of metrics: 1 good, -1 bad, 0 nothing."""
    n, m = F.col("n_words"), {c: F.col(c) for c in METRICS}
    chars = m["word_chars"]
    return {
        "length": _vote(n.between(30, 100_000), n < 10),
        "word_length": _vote((n > 0) & chars.between(3 * n, 10 * n), (n == 0) | (chars < 2 * n) | (chars > 20 * n)),
        "symbols": _vote((n > 0) & (100 * m["n_symbols"] <= 5 * n), (n > 0) & (10 * m["n_symbols"] > 3 * n)),
        "symbol_share": _vote((n > 0) & (100 * m["n_symbols"] <= chars), (n > 0) & (100 * m["n_symbols"] > 8 * chars)),
        "lines": _vote((m["n_lines"] > 1) & (m["n_dup_lines"] == 0), (m["n_lines"] > 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
        "repeats": _vote((n >= 30) & (100 * m["n_repeat_words"] <= 5 * n), (n > 0) & (100 * m["n_repeat_words"] > 20 * n)),
        "case": _vote((chars >= 50) & (10 * m["n_upper"] <= 2 * chars), (chars >= 20) & (10 * m["n_upper"] > 6 * chars)),
        "variety": _vote((n >= 20) & (n <= 2_000) & (10 * m["n_distinct"] >= 3 * n), (n >= 20) & (10 * m["n_distinct"] < n) & (m["n_distinct"] < 200)),
    }


@dataclass(frozen=True)
class Weights:
    """The share of good documents, and per rule the chance of each vote in good and bad ones."""

    good: float
    chances: dict[str, dict[int, tuple[float, float]]]

    def posterior(self) -> Column:
        """The probability that a row with the rules' votes as columns is good."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for name, by in self.chances.items():
            said = F.col(name)
            odds = odds + F.when(said == 1, math.log(by[1][0] / by[1][1])).when(said == -1, math.log(by[-1][0] / by[-1][1])).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = ROUNDS) -> Weights:
    """EM over counted vote patterns. An abstaining rule says nothing about the document.

    A rule is right with one chance on good and another on bad documents; both start at, and
    are drawn towards, ``PRIOR_RIGHT``, and on good ones stay at ``LEAST_RIGHT`` at least, so that
    a rule that hardly votes says little and good and bad can't change places. No patterns give
    the prior.
    """
    good = PRIOR_GOOD
    right = {(j, g): PRIOR_RIGHT[g] for j in range(len(names)) for g in (0, 1)}
    total = sum(k for _, k in patterns)
    for _ in range(rounds):
        mass, agree, voted = 0.0, dict.fromkeys(right, 0.0), dict.fromkeys(right, 0.0)
        for votes, k in patterns:
            odds = math.log(good / (1 - good))
            for j, v in enumerate(votes):
                if v:
                    a, b = right[j, 1], right[j, 0]
                    odds += math.log(a / (1 - b)) if v > 0 else math.log((1 - a) / b)
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            mass += k * p
            for j, v in enumerate(votes):
                if v:
                    voted[j, 1] += k * p
                    voted[j, 0] += k * (1 - p)
                    agree[j, 1] += k * p * (v > 0)
                    agree[j, 0] += k * (1 - p) * (v < 0)
        before = dict(right), good
        good = min(max((mass + PRIOR_VOTES * PRIOR_GOOD) / (total + PRIOR_VOTES), 0.02), 0.98)
        for key in right:
            r = (agree[key] + PRIOR_VOTES * PRIOR_RIGHT[key[1]]) / (voted[key] + PRIOR_VOTES)
            right[key] = min(max(r, LEAST_RIGHT[key[1]]), 0.999)
        if max(abs(good - before[1]), *(abs(right[k] - before[0][k]) for k in right)) < 1e-9:
            break
    chances = {n: {1: (right[j, 1], 1 - right[j, 0]), -1: (1 - right[j, 1], right[j, 0])} for j, n in enumerate(names)}
    return Weights(good, chances)


def with_votes(metrics: DataFrame) -> DataFrame:
    said = rules()
    kept = [F.col(f"`{c}`") for c in metrics.columns if c not in said]
    return metrics.select(*kept, *(v.cast("int").alias(k) for k, v in said.items()))


def learn(votes: DataFrame, rounds: int = ROUNDS) -> Weights:
    """Weights from a frame of votes; only the counts of its vote patterns (3 ** rules at most) leave the cluster."""
    names = list(rules())
    counted = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).collect()
    patterns = sorted((tuple(r[n] for n in names), r["_n"]) for r in counted)
    return estimate(patterns, names, rounds)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(votes: DataFrame, weights: Weights) -> DataFrame:
    """``votes`` with base_failed, quality (the posterior) and kept; columns of these names are replaced.

    A document that fails the base test is never kept; any other is kept if its posterior is
    one half or more. Null and empty texts have no words and fail.
    """
    out = {"base_failed": base_failed(), "quality": weights.posterior()}
    kept = votes.select(*(F.col(f"`{c}`") for c in votes.columns if c not in {*out, "kept"}), *(v.alias(k) for k, v in out.items()))
    return kept.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
