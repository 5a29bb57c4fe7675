"""Quality rules by weak supervision (op 1), in DataFrame functions only.

Each rule votes accept, reject or abstains on text statistics.  The votes of all documents are
counted per vote pattern (at most 3^rules patterns, whatever the corpus size); expectation
maximisation over those counts estimates how often each rule is right on good and on bad
documents, and a document's posterior probability of being good decides.

Edge cases: a null or blank text has no words and fails the base rules; repeated rows are judged
alike; an empty table gives an empty result; other columns are ignored or, when filtering, kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import WORD, checkpointed, fresh, let, with_struct

WINDOW = 5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_upper", "n_letters", "n_marks", "n_symbol_runs"]


def repeat_words(words: Column) -> Column:
    """Words lying in 5-word windows that occur at least twice in the array."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - WINDOW + 1, F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))

    def covered(at: Column) -> Column:
        ends = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(ends, F.lit(0), lambda a, x: a + x)

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda s: F.transform(
            F.filter(s, lambda p, i: F.coalesce(F.get(s, i - 1)["h"] == p["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == p["h"], F.lit(False))),
            lambda p: p["i"]))
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeated, let(F.sort_array(starts), covered)).otherwise(0)

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)


def text_stats(text: Column) -> Column:
    """A struct of the statistics named in ``STATS`` (all long)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    both = F.struct(t.alias("t"), F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)).alias("w"), lines.alias("l"))

    def count(s: Column) -> Column:
        left = lambda keep: F.length(F.regexp_replace(s["t"], keep, ""))
        values = {
            "n_words": F.size(s["w"]),
            "word_chars": F.length(F.array_join(s["w"], "")),
            "n_symbols": left(r"[^#*$%&|<>]+"),
            "n_dup_lines": F.size(s["l"]) - F.size(F.array_distinct(s["l"])),
            "n_repeat_words": repeat_words(s["w"]),
            "n_lines": F.size(s["l"]),
            "n_upper": left(r"\P{Lu}+"),
            "n_letters": F.length(F.array_join(s["w"], "")) - left(r"[\p{L}\x20\x09-\x0D]+"),
            "n_marks": left(r"[^!?]+"),
            "n_symbol_runs": F.regexp_count(s["t"], F.lit(r"[#*$%&|<>]+")),
        }
        return F.struct(*[values[k].cast("long").alias(k) for k in STATS])

    return let(both, count)


def base_failed(s: Column) -> Column:
    """Too short, or over a fifth of the words in repeated windows."""
    return (s["n_words"] < 10) | (s["n_repeat_words"] * 100 > s["n_words"] * 20)


def ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def _vote(accept: Column, reject: Column) -> Column:
    return F.when(reject, -1).when(accept, 1).otherwise(0)


def votes(s: Column) -> dict[str, Column]:
    """The rules: 1 accepts, -1 rejects, 0 abstains."""
    symbols = ratio(s["n_symbols"], s["n_words"])
    dup = ratio(s["n_dup_lines"], s["n_lines"])
    repeats = ratio(s["n_repeat_words"], s["n_words"])
    upper = ratio(s["n_upper"], s["n_letters"])
    marks = ratio(s["n_marks"], s["n_words"])
    length = ratio(s["word_chars"], s["n_words"])
    letters = ratio(s["n_letters"], s["word_chars"])
    runs = ratio(s["n_symbol_runs"], s["n_words"])
    return {
        "length": _vote(s["n_words"] >= 50, s["n_words"] < 20),
        "symbols": _vote(symbols <= 0.02, symbols > 0.1),
        "lines": _vote((dup <= 0.1) & (s["n_lines"] >= 3), dup > 0.3),
        "repeats": _vote((repeats <= 0.05) & (s["n_words"] >= 50), repeats > 0.15),
        "capitals": _vote(upper <= 0.15, upper > 0.4),
        "marks": _vote(marks <= 0.05, marks > 0.25),
        "word_length": _vote(length.between(3, 10), (length < 2) | (length > 20)),
        "letters": _vote(letters >= 0.93, letters < 0.9),
        "symbol_runs": _vote(runs <= 0.02, runs > 0.08),
    }


#: Starting point: good documents rarely trip a rule, bad ones trip one or two of them.
START_PRIOR, START_GOOD, START_BAD = 0.9, 0.998, 0.75


@dataclass
class Model:
    """P(good), and per rule P(accept | good, votes) and P(accept | bad, votes)."""

    prior: float
    accept_good: dict[str, float]
    accept_bad: dict[str, float]

    def posterior(self, vote: dict[str, Column]) -> Column:
        z = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, v in vote.items():
            g, b = self.accept_good[rule], self.accept_bad[rule]
            z = z + F.when(v > 0, math.log(g / b)).when(v < 0, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def maximise(patterns: Column, n_rules: int, rounds: int, strength: float) -> Column:
    """EM over an array of (votes, n): the parameters struct after ``rounds`` rounds.

    E-step: the posterior of each pattern; M-step: the expected accept shares.  ``strength``
    pseudo-votes hold each rule near its starting accuracy, so that a rule that hardly ever
    fires cannot drift."""
    constant = lambda x: F.array_repeat(F.lit(x), n_rules)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    clip = lambda x, lo, hi: F.greatest(F.least(x, F.lit(hi)), F.lit(lo))

    def expect(params: Column) -> Column:
        odds = lambda votes: total(F.transform(votes, lambda v, j: F.when(
            v > 0, F.log(F.get(params["good"], j) / F.get(params["bad"], j))).when(
            v < 0, F.log((1 - F.get(params["good"], j)) / (1 - F.get(params["bad"], j)))).otherwise(0.0)))
        z = lambda p: F.log(params["prior"] / (1 - params["prior"])) + odds(p["votes"])
        return F.transform(patterns, lambda p: F.struct(
            p["votes"].alias("votes"), p["n"].alias("n"), (1 / (1 + F.exp(-z(p)))).alias("q")))

    def share(es: Column, j: Column, weight, start: float) -> Column:
        of = total(F.transform(es, lambda e: F.when(F.get(e["votes"], j) != 0, weight(e)).otherwise(0.0)))
        hit = total(F.transform(es, lambda e: F.when(F.get(e["votes"], j) > 0, weight(e)).otherwise(0.0)))
        return (hit + start * strength) / (of + strength)

    def improve(es: Column) -> Column:
        rules = F.sequence(F.lit(0), F.lit(n_rules - 1))
        good = total(F.transform(es, lambda e: e["q"] * e["n"]))
        n = total(F.transform(es, lambda e: e["n"]))
        return F.struct(
            clip((good + START_PRIOR * strength) / (n + strength), 0.5, 0.99).alias("prior"),
            F.transform(rules, lambda j: clip(share(es, j, lambda e: e["q"] * e["n"], START_GOOD), 0.9, 0.9995)).alias("good"),
            F.transform(rules, lambda j: clip(share(es, j, lambda e: (1 - e["q"]) * e["n"], START_BAD), 0.001, 0.89)).alias("bad"))

    start = F.struct(F.lit(START_PRIOR).alias("prior"), constant(START_GOOD).alias("good"), constant(START_BAD).alias("bad"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda params, _: let(expect(params), improve))


def with_stats(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the statistics under new names, and the map from statistic to column."""
    names = dict(zip(STATS, fresh(docs, *STATS)))
    return with_struct(docs, text_stats(F.col("text")), {v: k for k, v in names.items()}), names


def as_struct(names: dict[str, str]) -> Column:
    return F.struct(*[F.col(v).alias(k) for k, v in names.items()])


def fit(stats: DataFrame, names: dict[str, str], rounds: int = 10, strength: float = 20.0) -> Model:
    """Expectation maximisation over the counted vote patterns.

    The documents are aggregated per pattern; what the base rules reject is decided already and
    takes no part.  The patterns, at most 3^rules rows whatever the corpus, meet in one row, and
    one row of parameters reaches the driver."""
    ballot = let(as_struct(names), lambda s: F.struct(
        F.array(*[v.cast("int") for v in votes(s).values()]).alias("votes"), base_failed(s).alias("failed")))
    rules = list(votes(as_struct(names)))
    ballots = stats.select(F.inline(F.array(ballot))).filter(~F.col("failed"))
    counted = ballots.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    one = counted.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    row = one.select(F.inline(F.array(maximise(F.col("patterns"), len(rules), rounds, strength)))).first()
    return Model(row["prior"], dict(zip(rules, row["good"])), dict(zip(rules, row["bad"])))


def verdict(names: dict[str, str], model: Model) -> Column:
    """A struct of base_failed, posterior and kept."""
    return let(as_struct(names), lambda s: let(
        F.struct(base_failed(s).alias("failed"), model.posterior(votes(s)).alias("p")),
        lambda v: F.struct(v["failed"].alias("base_failed"), v["p"].alias("posterior"),
                           (~v["failed"] & (v["p"] >= 0.5)).alias("kept"))))


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the statistics, base_failed, kept and the posterior.

    The statistics (a few numbers a document) are written once to the shared folder; fitting
    and judging read them from there."""
    stats, names = with_stats(docs.select("doc_id", "text"))
    stats = checkpointed(stats.select("doc_id", *names.values()))
    judged = stats.withColumn("v", verdict(names, fit(stats, names)))
    return judged.select("doc_id", *[F.col(names[k]).alias(k) for k in STATS[:5]], "v.base_failed", "v.kept", "v.posterior")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the method keeps, columns as given."""
    stats, names = with_stats(docs)
    numbers, own = with_stats(docs.select("text"))
    model = fit(numbers, own)
    (v,) = fresh(stats, "v")
    return with_struct(stats, verdict(names, model), {v: "kept"}).filter(F.col(v)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
