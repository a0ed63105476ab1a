"""Mixing sources to target weights by iterative proportional fitting. Spark expressions only.

Token weights of the cells (source, language, topic) are raked to the marginals of each in turn,
never above what a cell holds; the fitted share of a cell is the probability of its documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACES, content, written

MARGINS = ("source", "lang", "topic")
#: Topics by what a text holds, in order; the first that holds counts.
TOPICS: tuple[tuple[str, str], ...] = (
    ("licence", "icense"),
    ("contact", "@"),
    ("table", " | "),
    ("web", "http"),
)
OTHER_TOPIC = "prose"


def topic(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    """The first topic whose mark the text holds."""
    found = None
    for name, marked in topics:
        condition = text.contains(marked)
        found = F.when(condition, name) if found is None else found.when(condition, name)
    return F.lit(OTHER_TOPIC) if found is None else found.otherwise(OTHER_TOPIC)


def words(text: Column) -> Column:
    """Words of a text: its weight in tokens where no tokenizer has counted them."""
    return F.size(F.array_remove(F.split(text, f"{SPACES}+"), "")).cast("long")


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets (margin, share) in proportion to a power of the tokens: below 1 lifts rare levels."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    sums = sums.withColumn("t", F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0))
    return sums.select(margin, (F.col("t") / F.lit(_total(sums, "t"))).alias("share"))


def named(cells: DataFrame, margin: str, shares: Mapping[str, float]) -> DataFrame:
    """Targets with given shares for some levels; the others share the rest as they stand."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    given = F.lit(None).cast("double")
    for level, share in shares.items():
        given = F.when(F.col(margin) == level, F.lit(float(share))).otherwise(given)
    marked = sums.withColumn("g", given)
    rest = max(0.0, 1 - sum(shares.values())) / _total(marked.where("g IS NULL"), "t")
    return marked.select(margin, F.coalesce("g", F.lit(rest) * F.col("t")).alias("share"))


def _total(rows: DataFrame, column: str) -> float:
    """One number; 1 where there is nothing to divide."""
    return float(rows.agg(F.sum(column)).first()[0] or 0) or 1.0


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], *, budget: float, rounds: int
) -> DataFrame:
    """``cells`` (margins, tokens) with ``weight``: tokens to draw, ``budget`` of all of them.

    Each round scales the weights to the target of every margin in turn, and then down to the
    tokens that a cell holds. Where the targets can be met so, the weights tend to them; where a
    level hasn't enough tokens, all of it is drawn. A round is written to the shared folder before
    the next. Cells are few (levels multiply), but nothing here needs them in one place.
    """
    goal = F.lit(budget * _total(cells, "tokens"))
    fitted = cells
    for margin, target in targets.items():
        fitted = fitted.join(target.withColumnRenamed("share", f"_{margin}"), margin)
    fitted = fitted.withColumn("weight", F.lit(budget) * F.col("tokens"))
    for _ in range(rounds):
        for margin in targets:
            held = F.sum("weight").over(Window.partitionBy(margin))
            scale = F.when(held > 0, goal * F.col(f"_{margin}") / held).otherwise(0.0)
            fitted = fitted.withColumn("weight", F.col("weight") * scale)
        fitted = fitted.withColumn("weight", F.least("weight", F.col("tokens").cast("double")))
        fitted = written(fitted, "raked")
    return fitted.select(*targets, "tokens", "weight")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def leveled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the levels of the margins and the tokens, under names of their own."""
    return docs.withColumns(
        {
            "_source": F.coalesce("source", F.lit("")),
            "_lang": F.coalesce("lang", F.lit("")),
            "_topic": topic(content(text)),
            "_tokens": words(content(text)),
        }
    )


def rates(
    leveled_rows: DataFrame, powers: Mapping[str, float], *, budget: float, rounds: int = 12
) -> DataFrame:
    """The probability of every cell (margins under their own names), raked to tempered targets."""
    named_cells = [F.col(f"_{m}").alias(m) for m in MARGINS]
    cells = leveled_rows.groupBy(*named_cells).agg(F.sum("_tokens").alias("tokens"))
    cells = written(cells, "cells")
    targets = {m: tempered(cells, m, powers[m]) for m in MARGINS}
    fitted = rake(cells, targets, budget=budget, rounds=rounds)
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    # Written, so that Spark knows its size and only then broadcasts it.
    return written(fitted.select(*(F.col(m).alias(f"_{m}") for m in MARGINS), rate.alias("_rate")), "rates")


def mix(
    docs: DataFrame,
    powers: Mapping[str, float],
    *,
    budget: float,
    rounds: int = 12,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: key, margins, tokens, probability and kept.

    ``powers`` gives the tempering of each margin's target. A null source or language is the level
    '', a null text has no tokens (probability 0 when all of its cell has none: nothing to draw);
    rows of one key share their draw; empty tables give no rows. Other columns are not read. The words
    of a very long text all count; it is one row's work.
    """
    rows = leveled(docs.select(F.col(key).alias("_key"), "source", "lang", F.col(text).alias("_text")), "_text")
    rows = written(rows.drop("source", "lang", "_text"), "weighed")
    found = rows.join(rates(rows, powers, budget=budget, rounds=rounds), [f"_{m}" for m in MARGINS])
    return found.select(
        F.col("_key").alias(key),
        *(F.col(f"_{m}").alias(m) for m in MARGINS),
        F.col("_tokens").alias("tokens"),
        F.col("_rate").alias("probability"),
        (draw(F.col("_key"), seed) < F.col("_rate")).alias("kept"),
    )


def drawn(
    docs: DataFrame,
    powers: Mapping[str, float],
    *,
    budget: float,
    rounds: int = 12,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with all their columns. Reads the texts twice."""
    named_ = [F.col(key).alias("_key"), "source", "lang", F.col(text).alias("_text")]
    rows = leveled(docs.select(*named_, F.struct("*").alias("_row")), "_text")
    held = rates(rows, powers, budget=budget, rounds=rounds)
    found = rows.join(held, [f"_{m}" for m in MARGINS])
    return found.where(draw(F.col("_key"), seed) < F.col("_rate")).select("_row.*")
