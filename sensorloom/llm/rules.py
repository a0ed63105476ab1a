"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for
each failed rule. Policies are versioned masks over the bits, so applying another policy, or asking
what a rule alone costs, reads the ledger and never the texts. Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACE_CHARS, SPACES, content, without

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")

#: Rules by bit: name and the condition under which a document fails. Bits are never reused, so
#: ledgers of different dates stay comparable; add rules at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_upper > word_chars"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BITS = {name: 1 << bit for bit, (name, _) in enumerate(RULES)}
#: Rules that every policy holds.
BASE = ("few_words", "repeated_windows")
#: Policies by version; a document is kept when it fails none of the rules of the policy.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines"),
    "v3": (*BASE, "symbols", "repeated_lines", "shouting", "word_length"),
}
CURRENT = "v3"


def mask(names: tuple[str, ...]) -> int:
    return sum(BITS[n] for n in set(names))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements of the whole text; a null text has no words and no lines.

    Words in 3-word windows found twice or more: the windows of a text are hashed to numbers. Only
    where a number repeats are (hash, place) pairs sorted and those with an equal neighbour kept;
    their places, in order, cover three words each, less the overlap with the next. No step
    compares all windows with all, so a very long text costs n log n.

    The measurements come out of a generator. A later condition on plain columns would be moved
    below them, and each would be computed again wherever the condition reads it.
    """
    whole = content(text)
    words = F.array_remove(F.split(whole, f"{SPACES}+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{SPACES[1:-1]}]"))
    bare = without(whole, SPACE_CHARS)
    step = docs.withColumns({"_words": words, "_lines": lines, "_bare": bare})
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length("_bare").cast("long"),
            "n_symbols": (
                F.octet_length("_bare") - F.octet_length(without(F.col("_bare"), SYMBOLS))
            ).cast("long"),
            "n_upper": (
                F.char_length("_bare") - F.char_length(F.regexp_replace("_bare", r"\p{Lu}+", ""))
            ).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.when(
                F.size("_words") > 2,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - 3),
                    lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(3))),
                ),
            ),
        }
    )
    step = step.withColumn("_again", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_pairs", F.when(F.col("_again"), F.sort_array(pairs)))
    alike = F.filter(
        "_pairs",
        lambda pair, i: F.coalesce(F.get("_pairs", i + 1)["h"] == pair["h"], F.lit(False))
        | F.coalesce(F.get("_pairs", i - 1)["h"] == pair["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(alike, lambda pair: pair["i"]))
    step = step.withColumn("_places", F.when(F.col("_again"), places))
    cover = F.aggregate(
        F.transform(
            "_places", lambda p, i: F.least(F.coalesce(F.get("_places", i + 1) - p, F.lit(3)), F.lit(3))
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    step = step.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0).cast("long")))
    return step.select(*docs.columns, F.inline(F.array(F.struct(*MEASURES))))


def ledger(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its key, the measurements and ``failures`` (long).

    Bit b of ``failures`` is set when rule b fails. Empty and null texts fail ``few_words`` only.
    Null and repeated keys stay; other columns of ``docs`` are not read; no rows give no rows. A very
    long text is measured whole; it is one row's work.
    """
    rows = measured(docs.select(F.col(key), F.col(text).alias("_text")), "_text").drop("_text")
    return rows.select(key, *MEASURES, failures().alias("failures"))


def failures() -> Column:
    """The bits of the rules that measured rows fail."""
    bits = F.lit(0).cast("long")
    for bit, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def passing(docs: DataFrame, policy: str = CURRENT, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns."""
    rows = measured(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    return rows.where(verdict(failures(), policy)).select("row.*")


def verdict(failed: Column, policy: str = CURRENT) -> Column:
    """Whether a document is kept under a policy, from its failure bits."""
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, and that only it rejects.

    One pass over the failure bits of a ledger; a row for each rule.
    """
    held = mask(POLICIES[policy])
    failed = F.col("failures").bitwiseAND(F.lit(held).cast("long"))
    counts = []
    for name in POLICIES[policy]:
        bit = F.lit(BITS[name]).cast("long")
        counts.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(failed.bitwiseAND(bit) != 0).alias("failed"),
                F.count_if(failed == bit).alias("only_this"),
            )
        )
    return rows.agg(F.array(*counts).alias("rules")).select(F.inline("rules"))
