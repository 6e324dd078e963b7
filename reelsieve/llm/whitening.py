"""Embedding whitening: principal components of all distinct vectors, and every vector in their scale.

The entries of a vector are taken in steps of 1/256 as whole numbers, so that every sum is exact and no result depends on
how rows are dealt out. Generated SQL sums the centred products of every pair of dimensions (the upper triangle) in one
aggregation without grouping: tasks send one row each, of d (d + 1) / 2 numbers. Products are centred at the mean rounded to
a whole number, and what rounding left is taken off exactly afterwards. The covariance is decomposed by LAPACK on the
driver, which holds d x d numbers; projecting is column arithmetic again.

Rows are left out if their vector is null, holds null or a non-finite entry (or one whose steps don't fit a long), or is
shorter than the longest one, which means that entries are missing. Repeated vectors count once in the fit, and each of
their rows gets its own result; null ids pass through. Components without variance have no scale: their values are null.
Without any row the result is empty. Values so large that sums of products could leave a long are summed as doubles. A
deviation that doesn't fit a long is null. Other columns pass through; columns named like new ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsieve.llm.common import cut

STEPS = 256
#: Pairs of dimensions in one aggregation; 64 dimensions have 2,080. Wider vectors take several.
MOST_PAIRS = 8192
_LONG = 2**63


@dataclass(frozen=True)
class Model:
    n: int  # vectors of the fit list
    sums: list[int]
    low: list[int]
    high: list[int]
    values: list[float]  # eigenvalues, falling
    vectors: list[list[float]]  # unit eigenvectors, in that order
    trace: float

    @property
    def scaled(self) -> list[bool]:
        """Whether a component has variance, beyond what rounding leaves."""
        return [e > len(self.sums) * 2.3e-16 * self.values[0] for e in self.values]


def steps(vector: Column) -> Column:
    """The vector in whole steps, or null if a row is to be left out for it."""
    v = vector.cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * STEPS < float(_LONG)))
    return F.when(F.coalesce(sound, F.lit(False)) & (F.size(v) > 0), F.transform(F.when(sound, v), lambda c: F.floor(c * STEPS)))


def _columns(d: int, of) -> list[Column]:
    return [F.expr(of(i)) for i in range(d)]


def _terms(terms) -> str:
    return " + ".join(terms)


def _triangle(rows: DataFrame, d: int, number: str) -> dict[tuple[int, int], int | float]:
    """Sums of y_i * y_j over rows, for i <= j."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    out = {}
    for at in range(0, len(pairs), MOST_PAIRS):
        part = pairs[at : at + MOST_PAIRS]
        sums = ", ".join(f"sum(CAST(y{i} AS {number}) * y{j})" for i, j in part)
        out |= zip(part, rows.sparkSession.sql(f"SELECT {sums} FROM {{rows}}", rows=rows).first())
    return out


def fit(vectors: DataFrame) -> Model | None:
    """vectors: x, an array<long> a row, each once and all of one length."""
    first = vectors.select("x").first()
    if first is None:
        return None
    d = len(first.x)
    stats = [s for i in range(d) for s in (f"sum(CAST(x[{i}] AS DECIMAL(38, 0)))", f"min(x[{i}])", f"max(x[{i}])")]
    n, *rest = vectors.selectExpr("count(*)", *stats).first()
    sums, low, high = [int(s) for s in rest[0::3]], rest[1::3], rest[2::3]
    near = [(2 * s + n) // (2 * n) for s in sums]  # rounded means
    reach = max(max(h - m, m - l) for l, m, h in zip(low, near, high))
    cov = [[0.0] * d for _ in range(d)]
    if n * reach * reach < _LONG:
        rows = vectors.select(*_columns(d, lambda i: f"x[{i}] - {near[i]}L AS y{i}"))
        rest = [s - n * m for s, m in zip(sums, near)]
        for (i, j), s in _triangle(rows, d, "BIGINT").items():
            cov[i][j] = cov[j][i] = (n * s - rest[i] * rest[j]) / (n * n)  # whole numbers, rounded once
    else:
        rows = vectors.select(*_columns(d, lambda i: f"CAST(x[{i}] AS DOUBLE) - {sums[i] / n!r}D AS y{i}"))
        for (i, j), s in _triangle(rows, d, "DOUBLE").items():
            cov[i][j] = cov[j][i] = s / n
    import numpy as np

    values, units = np.linalg.eigh(np.array(cov))
    return Model(n, sums, low, high, [max(0.0, float(e)) for e in values[::-1]], units.T[::-1].tolist(), sum(cov[i][i] for i in range(d)))


def _whitened(model: Model, components: int, x: str = "x") -> list[str]:
    """SQL of a row's coordinates on the first components; null where they have no variance."""
    out = []
    for e, unit, ok in list(zip(model.values, model.vectors, model.scaled))[:components]:
        terms = _terms(f"({x}[{i}] - {s / model.n!r}D) * {u!r}D" for i, (s, u) in enumerate(zip(model.sums, unit)))
        out.append(f"({terms}) / {e**0.5!r}D" if ok else "CAST(NULL AS DOUBLE)")
    return out


def _deviation(model: Model, x: str = "x") -> str:
    """SQL of the sum of (n * x - S) ^ 2 over the dimensions."""
    n, d = model.n, len(model.sums)
    reach = max(max(n * h - s, s - n * l) for l, s, h in zip(model.low, model.sums, model.high))
    if d * reach * reach < _LONG:
        return _terms(f"({n}L * {x}[{i}] - {s}L) * ({n}L * {x}[{i}] - {s}L)" for i, s in enumerate(model.sums))
    whole = [f"try_subtract(try_multiply(CAST({n} AS DECIMAL(19, 0)), CAST({x}[{i}] AS DECIMAL(19, 0))), CAST({s} AS DECIMAL(38, 0)))" for i, s in enumerate(model.sums)]
    total = f"try_multiply({whole[0]}, {whole[0]})"
    for w in whole[1:]:
        total = f"try_add({total}, try_multiply({w}, {w}))"
    return f"try_cast({total} AS BIGINT)"


def identity_error(vectors: DataFrame, model: Model, components: int) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over the components with variance."""
    k = [c for c in range(min(components, len(model.values))) if model.scaled[c]]
    if not k:
        return None
    sql = _whitened(model, components)
    rows = vectors.select(*[F.expr(f"{sql[c]} AS w{i}") for i, c in enumerate(k)])
    means = rows.agg(*[F.sum(f"w{i}") / model.n for i in range(len(k))]).first()
    centred = rows.select(*[(F.col(f"w{i}") - m).alias(f"y{i}") for i, m in enumerate(means)])
    return max(abs(s / model.n - (i == j)) for (i, j), s in _triangle(centred, len(k), "DOUBLE").items())


def whiten(rows: DataFrame, vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """Rows that are not left out, without their vector, and for each component: component (from 1), n, deviation, whitened,
    explained (share of all variance; null if there is none), identity_error."""
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    out = [c for c in rows.columns if c.lower() not in {vector_col.lower(), *names}]
    inner = rows.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in out]).alias("row"), steps(F.col(f"`{vector_col}`")).alias("x")).filter("x IS NOT NULL")
    distinct = cut(inner.select("x").distinct())
    d = distinct.agg(F.max(F.size("x"))).first()[0] or 0
    vectors = distinct.filter(F.size("x") == d)
    model = fit(vectors)
    if model is None:
        new = "CAST(0 AS INT) AS component, 0L AS n, 0L AS deviation, 0D AS whitened, 0D AS explained, 0D AS identity_error"
        return inner.filter("false").select(*[F.col("row").getField(c).alias(c) for c in out], *map(F.expr, new.split(", ")))
    error = identity_error(vectors, model, components)
    parts = []
    for k, sql in enumerate(_whitened(model, components)):
        share = model.values[k] / model.trace if model.trace > 0 else None
        parts.append(F.struct(F.lit(k + 1).alias("component"), F.expr(sql).alias("whitened"), F.lit(share).cast("double").alias("explained")))
    met = inner.filter(F.size("x") == d).select("row", F.expr(_deviation(model)).alias("deviation"), F.explode(F.array(*parts)).alias("c"))
    values = {"component": F.col("c.component"), "n": F.lit(model.n).cast("long"), "deviation": F.col("deviation"), "whitened": F.col("c.whitened"), "explained": F.col("c.explained"), "identity_error": F.lit(error).cast("double")}
    return met.select(*[F.col("row").getField(c).alias(c) for c in out], *[values[c].alias(c) for c in names])


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
