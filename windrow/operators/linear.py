"""Linear models by their normal equations: least squares and penalised logistic regression.

The design has standardised numbers and one column for each value of each category. What a fit
needs of the rows is the matrix of the columns' products, and that is a handful of grouped sums:
numbers by numbers, numbers by each value of a category, and each pair of values that occurs. A
task adds them up over its Arrow batches and hands on one number for each product, so rows are
neither multiplied nor moved; the driver solves equations whose size is the number of columns, not
of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.categories import dictionary, with_indexes

#: Columns of a design at most: the driver holds their square (32 MB).
MAX_COLUMNS = 2_000
#: Sums that a task hands on in one Arrow batch.
SUMS_AT_ONCE = 100_000
#: Directions of the design below this share of the largest are taken as dependent columns.
RANK_TOLERANCE = 1e-11
INTERCEPT = "(intercept)"


class TooManyColumns(ValueError):
    """The one-hot design is wider than what is solved directly."""


@dataclass(frozen=True)
class Design:
    """The columns of a design: ``numeric`` (name, mean, deviation), then the values of each
    category in ascending order."""

    numeric: list[tuple[str, float, float]]
    values: dict[str, list[str]]

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(map(len, self.values.values()))

    @property
    def names(self) -> list[tuple[str, str | None]]:
        """Feature and value of each column; numbers have no value."""
        pairs = [(name, None) for name, _, _ in self.numeric]
        return pairs + [(feature, v) for feature, values in self.values.items() for v in values]

    @property
    def starts(self) -> list[int]:
        """The first column of each category."""
        sizes = [len(v) for v in self.values.values()]
        return [len(self.numeric) + sum(sizes[:i]) for i in range(len(sizes))]

    def scaled(self, i: int) -> Column:
        name, mean, deviation = self.numeric[i]
        return (F.col(name).cast("double") - F.lit(mean)) / F.lit(deviation)


@dataclass(frozen=True)
class Fit:
    """Coefficients by column of the design; ``errors`` are standard errors where they are known."""

    design: Design
    coefficients: np.ndarray
    intercept: float
    errors: np.ndarray | None = None
    rounds: int = 1

    def score_sql(self) -> str:
        """The linear score of a row with the features' own columns, as SQL."""
        terms = [_double(self.intercept)]
        for i, (name, mean, deviation) in enumerate(self.design.numeric):
            scaled = f"(CAST(`{name}` AS DOUBLE) - {_double(mean)}) / {_double(deviation)}"
            terms.append(f"{_double(self.coefficients[i])} * ({scaled})")
        for (feature, values), start in zip(self.design.values.items(), self.design.starts, strict=True):
            if values:
                pairs = ", ".join(
                    f"{_text(v)}, {_double(self.coefficients[start + k])}" for k, v in enumerate(values)
                )
                # A value the fit has not seen adds nothing.
                terms.append(f"coalesce(element_at(map({pairs}), CAST(`{feature}` AS STRING)), 0D)")
        return " + ".join(terms)

    def regressor(self) -> PipelineModel:
        """A stored-and-loaded stage like any other of MLlib, adding ``prediction``."""
        return _stage(f"{self.score_sql()} AS prediction")

    def classifier(self) -> PipelineModel:
        """Adds ``probability_1`` and ``prediction`` (1.0 where that is above one half)."""
        chance = f"1D / (1D + exp(-({self.score_sql()})))"
        return PipelineModel([
            *_stage(f"{chance} AS probability_1").stages,
            *_stage("CAST(probability_1 > 0.5D AS DOUBLE) AS prediction").stages,
        ])

    def table(self, spark: SparkSession) -> DataFrame:
        """feature, value (null for numbers and the intercept), coefficient, standard_error."""
        errors = [None] * (self.design.width + 1) if self.errors is None else self.errors.tolist()
        rows = [(INTERCEPT, None, float(self.intercept), errors[-1])]
        rows += [
            (feature, value, float(c), e)
            for (feature, value), c, e in zip(self.design.names, self.coefficients, errors[:-1], strict=True)
        ]
        return spark.createDataFrame(rows, "feature string, value string, coefficient double, standard_error double")


def _stage(columns: str) -> PipelineModel:
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")])


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class _Rows:
    """The rows of a fit, encoded: ``_y``, ``_x0``… (scaled numbers) and ``_c0``… (numbers of the
    values). They are kept for the passes of the fit; a lost block is worked out again."""

    def __init__(self, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, max_columns: int):
        found = dictionary(df, categorical)
        if len(numeric) + sum(found.sizes.values()) > max_columns:
            raise TooManyColumns(f"more than {max_columns} columns: {found.sizes}")
        values: dict[str, list[str]] = {c: [""] * found.sizes[c] for c in categorical}
        for row in found.table.collect():  # max_columns rows at most
            values[row["feature"]][row["index"]] = row["value"]
        stats = df.agg(*[F.struct(F.avg(c), F.stddev_pop(c)) for c in numeric], F.count("*").alias("n")).first()
        self.n = stats["n"]
        if not self.n:
            raise ValueError("there are no rows to fit")
        spread = [(float(s[0]), float(s[1]) or 1.0) for s in stats[:-1]]
        self.design = Design([(c, m, d) for c, (m, d) in zip(numeric, spread, strict=True)], values)
        names = {c: f"_c{i}" for i, c in enumerate(categorical)}
        self.x = [f"_x{i}" for i in range(len(numeric))]
        self.c = list(names.values())
        self.sizes = [len(v) for v in values.values()]
        encoded = with_indexes(df, found, names).select(
            F.col(target).cast("double").alias("_y"), *[F.col(c).cast("int").alias(c) for c in self.c],
            *[self.design.scaled(i).alias(x) for i, x in enumerate(self.x)],
        )
        self.df = encoded.persist(StorageLevel.MEMORY_AND_DISK)

    def score(self, coefficients: np.ndarray, intercept: float) -> Column:
        total = F.lit(float(intercept))
        for x, b in zip(self.x, coefficients, strict=False):
            total = total + F.lit(float(b)) * F.col(x)
        for c, start, values in zip(self.c, self.design.starts, self.design.values.values(), strict=True):
            own = ", ".join(_double(b) for b in coefficients[start : start + len(values)])
            if own:
                total = total + F.coalesce(F.expr(f"element_at(array({own}), CAST({c} AS INT) + 1)"), F.lit(0.0))
        return total

    def sums(self, df: DataFrame, *of: str) -> list[np.ndarray]:
        """For each column ``of``: its sums times each column of the design, and its own sum last."""
        return self._totals(df, of, None)[0]

    def products(self, df: DataFrame, weight: str, *of: str) -> tuple[np.ndarray, list[np.ndarray]]:
        """Weighted products of all columns by all columns, the constant last, and the sums of
        ``of``. At most the square of the design's width comes to the driver."""
        sums, products = self._totals(df, (weight, *of), weight)
        products[-1, :] = products[:, -1] = sums[0]
        own = np.arange(len(self.x), self.design.width)
        products[own, own] = sums[0][own]
        return products, sums[1:]

    def _totals(self, df: DataFrame, of: Sequence[str], weight: str | None) -> tuple[list[np.ndarray], np.ndarray]:
        k, m, size = len(self.x), len(of), self.design.width + 1
        starts, sizes, at_once = self.design.starts, self.sizes, SUMS_AT_ONCE

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, products = np.zeros((m, size)), np.zeros((size, size) if weight else (0, 0))
            for batch in batches:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                values, x, codes = columns[:m], columns[m : m + k], columns[m + k :]
                categories = list(zip(starts, sizes, codes, strict=True))
                for total, v in zip(sums, values, strict=True):
                    total[:k] += [v @ one for one in x]
                    total[-1] += v.sum()
                    # A row without a value of a category counts in a place after the last.
                    for start, n, code in categories:
                        total[start : start + n] += np.bincount(code, v, n + 1)[:n]
                if not weight:
                    continue
                weighted = [values[0] * one for one in x]
                for i, one in enumerate(weighted):
                    products[i, : i + 1] += [one @ other for other in x[: i + 1]]
                    for start, n, code in categories:
                        products[start : start + n, i] += np.bincount(code, one, n + 1)[:n]
                for (start, n, code), (start_2, n_2, code_2) in combinations(categories, 2):
                    pairs = np.bincount(code * (n_2 + 1) + code_2, values[0], (n + 1) * (n_2 + 1))
                    products[start_2 : start_2 + n_2, start : start + n] += pairs.reshape(n + 1, n_2 + 1)[:n, :n_2].T
            found = np.concatenate([sums.ravel(), products.ravel()])
            cells = np.flatnonzero(found)
            for at in range(0, len(cells), at_once):
                some = cells[at : at + at_once]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["cell", "total"])

        # What is null adds nothing, as in any sum.
        numbers = [F.coalesce(F.col(c), F.lit(0.0)).alias(f"_n{i}") for i, c in enumerate([*of, *self.x])]
        codes = [F.coalesce(F.col(c), F.lit(n)).cast("bigint").alias(c) for c, n in zip(self.c, sizes, strict=True)]
        added = df.select(*numbers, *codes).mapInArrow(partial, "cell bigint, total double")
        found = added.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
        whole = np.zeros(m * size + (size * size if weight else 0))
        whole[found["cell"].to_numpy()] = found["total"].to_numpy()
        lower = whole[m * size :].reshape(size, size) if weight else np.zeros((size, size))
        return list(whole[: m * size].reshape(m, size)), lower + np.tril(lower, -1).T


def least_squares(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
    max_columns: int = MAX_COLUMNS,
) -> Fit:
    """The least-squares fit of ``target`` with an intercept; of all fits that are equally good, as
    a one-hot design has many, the one whose coefficients have the smallest sum of squares.

    Rows must have no nulls in the columns used. The first solution is refined once by the sums of
    its own residuals, as products of columns lose half of the digits.
    """
    rows = _Rows(df, numeric, categorical, target, max_columns)
    try:
        ones = rows.df.withColumn("_w", F.lit(1.0))
        whole, _ = rows.products(ones, "_w")
        mean = whole[-1, :-1] / rows.n
        solve = _solver(whole[:-1, :-1] - rows.n * np.outer(mean, mean))
        coefficients, intercept = np.zeros(rows.design.width), 0.0
        for _ in range(2):
            left = rows.df.withColumn("_r", F.col("_y") - rows.score(coefficients, intercept))
            (residuals,) = rows.sums(left, "_r")
            step = solve(residuals[:-1] - residuals[-1] * mean)
            coefficients = coefficients + step
            intercept += residuals[-1] / rows.n - float(mean @ step)
        return Fit(rows.design, coefficients, intercept)
    finally:
        rows.df.unpersist()


def _solver(matrix: np.ndarray):
    """Of a symmetric matrix: the shortest vector that solves as much as can be solved."""
    values, vectors = np.linalg.eigh(matrix)
    kept = values > RANK_TOLERANCE * max(values.max(initial=0.0), 1e-300)
    inverse = np.where(kept, 1 / np.where(kept, values, 1), 0)
    return lambda right: vectors @ (inverse * (vectors.T @ right))


def logistic(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
    penalty: float = 1.0, max_rounds: int = 50, max_columns: int = MAX_COLUMNS,
) -> Fit:
    """Logistic regression of a 0/1 ``target`` by reweighted least squares.

    It minimises the summed loss and half of ``penalty`` times the squares of the coefficients (not
    of the intercept) until no gradient exceeds 1e-12 a row. Each round takes two aggregations; one
    that makes things worse is halved. Standard errors are those of the penalised
    information; the intercept's comes last.
    """
    rows = _Rows(df, numeric, categorical, target, max_columns)
    try:
        width = rows.design.width
        pull = np.append(np.full(width, float(penalty)), 0.0)
        beta, before, least = np.zeros(width + 1), np.zeros(width + 1), np.inf
        limit = max(1e-9, 1e-12 * rows.n)
        for done in range(1, max_rounds + 1):
            scored = rows.df.withColumn("_z", rows.score(beta[:-1], beta[-1]))
            scored = scored.withColumn("_p", 1 / (1 + F.exp(-F.col("_z"))))
            scored = scored.withColumns({"_r": F.col("_y") - F.col("_p"), "_w": F.col("_p") * (1 - F.col("_p"))})
            loss = F.log1p(F.exp(-F.abs("_z"))) + F.greatest("_z", F.lit(0.0)) - F.col("_y") * F.col("_z")
            information, (residuals, losses) = rows.products(scored.withColumn("_l", loss), "_w", "_r", "_l")
            total = losses[-1] + float(pull @ beta**2) / 2
            if total > least * (1 + 1e-12) + 1e-12 and done < max_rounds:
                beta = (beta + before) / 2
                continue
            least = min(least, total)
            gradient = residuals - pull * beta
            information = information + np.diag(pull)
            if np.abs(gradient).max() <= limit:
                break
            before, beta = beta, beta + _solver(information)(gradient)
        errors = np.sqrt(np.clip(np.diag(np.linalg.pinv(information, hermitian=True)), 0, None))
        return Fit(rows.design, beta[:-1], float(beta[-1]), errors, done)
    finally:
        rows.df.unpersist()


def column_sums(df: DataFrame, design: Design, of: str) -> DataFrame:
    """feature, value, row_count, total: sums of ``of`` times each column of the design over
    ``df``, which has the features' own columns. A value the design lacks has a row too."""
    numbers = [(INTERCEPT, F.col(of)), *[(name, design.scaled(i) * F.col(of)) for i, (name, _, _) in enumerate(design.numeric)]]
    names, categories = [name for name, _ in numbers], list(design.values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = [pc.sum(batch.column(i)).as_py() for i in range(len(names))]
            parts = [pa.table({
                "feature": pa.array(names, pa.string()), "value": pa.nulls(len(names), pa.string()),
                "row_count": pa.array([batch.num_rows] * len(names), pa.int64()), "total": pa.array(sums, pa.float64()),
            })]
            for i, name in enumerate(categories, len(names)):
                rows = pa.table({"value": batch.column(i), "total": batch.column(0)})
                found = rows.group_by("value", use_threads=False).aggregate([([], "count_all"), ("total", "sum")])
                parts.append(pa.table({
                    "feature": pa.array([name] * len(found), pa.string()), "value": found["value"],
                    "row_count": found["count_all"], "total": found["total_sum"],
                }))
            yield from pa.concat_tables(parts).combine_chunks().to_batches()

    given = df.select(
        *[part.cast("double").alias(f"_n{i}") for i, (_, part) in enumerate(numbers)],
        *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(categories)],
    )
    # A batch gives a row for each of its values.
    parts = given.mapInArrow(partial, "feature string, value string, row_count bigint, total double")
    return parts.groupBy("feature", "value").agg(F.sum("row_count").alias("row_count"), F.sum("total").alias("total"))
