"""Mixing sources to target weights by iterative proportional fitting (raking).

The documents' token counts are summed to cells of (source, language, topic). The cells' weights
are scaled in turn until the sums by source, by language and by topic meet their targets; the
calibrated weights give every cell a probability by which its documents are drawn. DataFrame
expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import WORD, stored, unit_hash

MARGINS = ("source", "lang", "topic")
#: Topic: what the text counts most of, per hundred words; plain prose if none reaches the floor.
TOPICS = {
    "tables": r"\|",
    "shouting": r"[A-Z]{3,}",
    "markup": r"[#$%&*]{2,}",
    "figures": r"[0-9]{2,}",
}
TOPIC_FLOOR = 5
PLAIN_TOPIC = "prose"
#: Label of rows whose source or language is null.
UNKNOWN = "(none)"
ROUNDS = 20
#: Rounds between two tables written to cut the plan.
ROUNDS_AT_ONCE = 5


def n_tokens(text: Column) -> Column:
    """Words of the text plus one for its end, so no document weighs nothing."""
    return (F.regexp_count(text, F.lit(WORD)) + 1).cast("long")


def topic_of(text: Column, words: Column, topics: Mapping[str, str] = TOPICS) -> Column:
    """The topic whose pattern matches most often; ties go to the first in alphabetical order."""
    counts = [
        F.struct(
            (-F.regexp_count(text, F.lit(pattern))).alias("order"), F.lit(name).alias("name")
        )
        for name, pattern in topics.items()
    ]
    best = counts[0] if len(counts) == 1 else F.least(*counts)
    enough = -best["order"] * 100 >= words * TOPIC_FLOOR
    return F.when(enough & (best["order"] < 0), best["name"]).otherwise(PLAIN_TOPIC)


def label_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", lang_column: str = "lang", keep: str | None = None,
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens (and column ``keep``) of every row; null labels
    become UNKNOWN, a null text counts as empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    labelled = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(source_column), F.lit(UNKNOWN)).alias("source"),
        F.coalesce(F.col(lang_column), F.lit(UNKNOWN)).alias("lang"),
        topic_of(text, F.regexp_count(text, F.lit(WORD))).alias("topic"),
        n_tokens(text).alias("n_tokens"),
        *([keep] if keep else []),
    )
    return labelled


def flattened_targets(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """Target shares in proportion to (own tokens) ** exponent: below 1, small labels gain."""
    sums = cells.groupBy(margin).agg(F.sum("n").alias("n"))
    power = F.pow(F.col("n").cast("double"), F.lit(exponent))
    # One row for each label; only their sum is gathered.
    whole = sums.agg(F.sum(power).alias("whole")).first()["whole"]
    return sums.select(margin, (power / F.lit(whole or 1.0)).alias("target"))


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, weight: str = "w"
) -> DataFrame:
    """Fits column ``weight`` of ``cells`` (columns of the margins and tokens ``n``) to targets.

    ``targets`` has for each margin a table of label and target share. Labels without a target
    get none of the weight; targets without a cell are given up, and the others share what they
    leave. Weights start at the cells' share of all tokens and sum to 1. Each step is one narrow
    window over the cells (one row for each combination that occurs, however many documents it
    has); every few rounds the cells are written to the shared folder.
    """
    total = cells.agg(F.sum("n").alias("n")).first()["n"] or 1
    fitted = cells.withColumn(weight, F.col("n") / F.lit(float(total)))
    for margin, target in targets.items():
        target = target.select(margin, F.col("target").alias(f"_{margin}"))
        fitted = fitted.join(target, margin, "left")
        labels = target.join(cells.select(margin).distinct(), margin, "left_semi")
        reached = labels.agg(F.sum(f"_{margin}").alias("s")).first()["s"] or 1.0
        fitted = fitted.withColumn(
            f"_{margin}", F.coalesce(F.col(f"_{margin}"), F.lit(0.0)) / F.lit(reached)
        )
    fitted = stored(fitted, "raked")
    for done in range(1, rounds + 1):
        for margin in targets:
            now = F.sum(weight).over(Window.partitionBy(margin))
            scaled = F.when(now > 0, F.col(weight) * F.col(f"_{margin}") / now).otherwise(0.0)
            fitted = fitted.withColumn(weight, scaled)
        if done % ROUNDS_AT_ONCE == 0:
            fitted = stored(fitted, "raked")
    return fitted.drop(*[f"_{margin}" for margin in targets])


def _odds(fitted: DataFrame, rate: float) -> DataFrame:
    total = fitted.agg(F.sum("n").alias("n")).first()["n"] or 1
    odds = F.lit(rate) * F.col("w") * F.lit(float(total)) / F.col("n")
    return fitted.select(*MARGINS, F.least(F.lit(1.0), odds).alias("probability"), "w")


def _draw_number(key: Column, seed: int) -> Column:
    return unit_hash(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{seed}")))


def draw(labelled: DataFrame, fitted: DataFrame, rate: float, seed: int = 0) -> DataFrame:
    """Draws documents by their cell's probability: min(1, rate * weight / share of tokens).

    So a cell's expected tokens are ``rate`` of all tokens times its calibrated weight, unless
    the cell has too few and is taken whole. A document is in if a hash of its id and the seed
    is below the probability: the draw does not depend on the partitioning, repeats of an id
    share their fate, and a higher rate only adds documents. A null id counts as the empty text.
    """
    odds = _odds(fitted, rate)
    number = _draw_number(F.col("doc_id"), seed)
    return labelled.join(odds, list(MARGINS)).where(number < F.col("probability"))


def _fit(labelled: DataFrame, exponents: Mapping[str, float], rounds: int) -> DataFrame:
    cells = stored(labelled.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n")), "cells")
    targets = {m: stored(flattened_targets(cells, m, exponents[m]), "targets") for m in MARGINS}
    return stored(rake(cells, targets, rounds), "fitted")


def keep_drawn(
    docs: DataFrame, exponents: Mapping[str, float], rate: float, rounds: int = ROUNDS, seed: int = 0,
    id_column: str = "doc_id", **columns: str,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; see ``mix_documents``.

    Texts are labelled twice, for the fit and for the draw, and not shuffled: they meet their
    cell's probability in a join with the cells.
    """
    labelled = label_documents(docs, id_column=id_column, **columns)
    fitted = _fit(stored(labelled, "labelled"), exponents, rounds)
    whole = docs.select("*", F.struct(*docs.columns).alias(fresh := _unused(docs)))
    rows = label_documents(whole, id_column=id_column, keep=fresh, **columns)
    return draw(rows, fitted, rate, seed).select(f"{fresh}.*")


def _unused(docs: DataFrame) -> str:
    name = "row"
    while name in docs.columns or name in (*MARGINS, "doc_id", "n_tokens", "probability", "w"):
        name = f"_{name}"
    return name


def mix_documents(
    docs: DataFrame, exponents: Mapping[str, float], rate: float, rounds: int = ROUNDS,
    seed: int = 0, **columns: str,
) -> DataFrame:
    """The drawn documents: doc_id, source, lang, topic, n_tokens, weight (of the cell's tokens
    in the mix) and probability.

    Targets are the margins' own shares flattened by ``exponents``. Repeated rows are drawn
    alike; empty tables give no rows; columns of other names are not read. One pass over the
    texts; the labelled rows without texts are stored, and summed per cell before the shuffle,
    so a source with most of the rows is a few rows to each task.
    """
    labelled = stored(label_documents(docs, **columns), "labelled")
    fitted = _fit(labelled, exponents, rounds)
    return draw(labelled, fitted, rate, seed).select(
        "doc_id", *MARGINS, "n_tokens", F.round("w", 9).alias("weight"),
        F.round("probability", 9).alias("probability"),
    )
