"""Mixing sources to target weights (op 9).

Tokens are summed per source; a source's rate is its target over its size.  Each document is
emitted floor(rate) times, plus once more when a number seeded by its id falls below the rate's
fraction.  Everything is DataFrame operations; the per-source table is the only thing that
reaches the driver's planning, and only as two sums per round of resharing.

Edge cases: a null text has size 0; a null source is a source of its own, sorted last; a source
of size 0 gets target 0 and rate 0; repeated rows with one id get the same number of copies; a
null id is seeded as empty text; empty tables give empty results.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelbeam.llm.common import WORD, fresh, hash_fraction
from parcelbeam.operators.attach import join_small

CAP = 3
CYCLE = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """Position (from 0) of each source in code point order, null last.

    One row per source goes through the window; rows are already summed per source."""
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    return sizes.withColumn("weight", ((F.row_number().over(order) - 1) % CYCLE + 1).cast("long"))


def source_targets(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """Columns source, source_size (long), weight (long), target (double).

    Shares are proportional to the weights 1, 2, 3, 1, ...; a source whose share passes
    ``cap`` times its size stops there and the rest is shared again by weight.  Each round is
    one aggregate over the source table: the capped sources' size and the others' weight."""
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    weighted = numbered_sources(sizes).persist()
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    capped_size, open_weight = 0, None
    while True:
        row = weighted.agg(
            F.sum(F.when(capped, F.col("source_size") * cap).otherwise(0)).alias("c"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("w")).first()
        now = (row["c"] or 0, row["w"] or 0)
        if now == (capped_size, open_weight) or not now[1]:
            break
        capped_size, open_weight = now
        # share > cap * size, without division: weight * rest > cap * size * open_weight
        capped = capped | (F.col("weight").cast("decimal(38,0)") * F.lit(total - capped_size)
                           > F.col("source_size").cast("decimal(38,0)") * F.lit(cap * open_weight))
    share = F.col("weight").cast("double") * F.lit(float(total - capped_size)) / F.lit(float(open_weight or 1))
    target = F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(share)
    return weighted.select("source", "source_size", "weight", target.alias("target"))


def mix_plan(docs: DataFrame, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``mix`` of size, source_size, target and copies."""
    size, source_size, target, weight, source = fresh(docs, "size", "source_size", "target", "weight", "source")
    targets = source_targets(docs, cap).select(
        F.struct(F.col("source").isNull().alias("missing"), F.coalesce(F.col("source"), F.lit("")).alias("s")).alias(source),
        F.col("source_size").alias(source_size), F.col("target").alias(target))
    keyed = docs.withColumn(source, F.struct(F.col("source").isNull().alias("missing"),
                                             F.coalesce(F.col("source"), F.lit("")).alias("s")))
    joined = join_small(keyed, targets, on=source)
    rate = F.coalesce(F.col(target) / F.when(F.col(source_size) > 0, F.col(source_size)), F.lit(0.0))
    extra = hash_fraction(seed, F.col("doc_id")) < rate - F.floor(rate)
    mix = F.struct(word_count(F.col("text")).alias("size"), F.col(source_size).alias("source_size"),
                   F.col(target).alias("target"),
                   (F.floor(rate) + extra.cast("long")).cast("long").alias("copies"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], mix.alias(fresh(docs, "mix")[0]))


def mix_documents(docs: DataFrame, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """The mix itself: each document as many times as its rate asks, columns as given."""
    (mix,) = fresh(docs, "mix")
    planned = mix_plan(docs, cap, seed)
    copies = F.array_repeat(F.lit(0), F.col(mix)["copies"].cast("int"))
    return planned.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(copies).alias(mix)).drop(mix)


def mix_report(docs: DataFrame, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (size times copies), copies."""
    (mix,) = fresh(docs.select("doc_id", "text", "source"), "mix")
    m = F.col(mix)
    return mix_plan(docs.select("doc_id", "text", "source"), cap, seed).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * m["copies"]).alias("taken"), m["copies"].alias("copies"))
