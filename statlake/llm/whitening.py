"""Whitening of embeddings on an exact covariance.

An entry c becomes the integer x = floor(64 c) + 1000000.  All sums over rows
are exact: tasks add up integer products, Spark adds up the tasks' sums.  With
n rows and sums S the integer scatter M = n * sum(x x') - S S' is n squared
times the covariance, so its characteristic polynomial is an integer
polynomial.  It is found modulo one prime per Spark row (Hessenberg reduction)
and put together by Chinese remaindering; its roots are isolated by exact sign
counts, and each root's vectors come from inverse iteration, a Spark row per
root (``exact_spectrum``).  A last pass projects every row.

What reaches the driver are sums per pair of dimensions, residues of the
polynomial's coefficients and the components: bounded by the dimension squared
whatever the number of rows.  Shifting every entry by 1000000 changes neither
M nor any centred value, so tasks work on the small integers floor(64 c).

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are left out, and so are entries too large for a long (64 |c| >= 2^62)
and vectors of another length than the most frequent one (the longer of equally
frequent ones); null ids and repeated rows are rows like any other; dimensions
without variance give no component (they would be divided by zero), so equal
vectors, a single row and an empty table give no rows; equal eigenvalues give
any orthonormal components of their space; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm import exact_spectrum
from statlake.llm.frames import ship

#: Components returned.
COMPONENTS = 32
#: Sums travel as three limbs of this base, each in a decimal of 38 digits.
LIMB = 10 ** 18
ROWS = 4096   # rows projected at once


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (doubles): the rows that have an integer vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    small = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float(2 ** 56)), F.lit(False)))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & small)
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).first()
    return rows.where(F.size("v") == (size["size"] if size else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """floor(64 c) of a batch, a row per vector."""
    lists = batch.column("v")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(64 * flat).astype(np.int64).reshape(batch.num_rows, -1)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y in Python integers: float products where they are exact, else integer ones."""
    top = int(np.abs(y).max(initial=1))
    step = 2 ** 53 // max(1, top * top)
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if step < 16:
        big = y.astype(object)
        return total + big.T @ big
    for lo in range(0, len(y), step):
        part = y[lo:lo + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _limbs(values: list[int]) -> list[pa.Array]:
    parts = []
    for x in values:
        high, low = divmod(x, LIMB)
        parts.append((*divmod(high, LIMB), low))
    return [pa.array([int(p[k]) for p in parts], pa.int64()).cast(pa.decimal128(38, 0)) for k in range(3)]


def _partial_sums(batches):
    """A task's rows, sums and products: i, j (j = -1: the sum of i; both -1: rows), limbs."""
    n, sums, products = 0, None, None
    for b in batches:
        if not b.num_rows:
            continue
        y = _matrix(b)
        n += len(y)
        s, p = np.array([int(x) for x in y.astype(object).sum(0)], dtype=object) if np.abs(y).max() > 2 ** 40 \
            else y.sum(0).astype(object), exact_products(y)
        sums, products = (s, p) if sums is None else (sums + s, products + p)
    if not n:
        return
    d = len(sums)
    i, j = np.triu_indices(d)
    at = [(-1, -1), *[(k, -1) for k in range(d)], *zip(i.tolist(), j.tolist())]
    values = [n, *[int(x) for x in sums], *[int(x) for x in products[i, j]]]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in at], pa.int32()), pa.array([x for _, x in at], pa.int32()),
                                      *_limbs(values)], ["i", "j", "a", "b", "c"])


def scatter(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S of floor(64 c) and M = n * sum(y y') - S S', exactly."""
    limb = "decimal(38,0)"
    sums = (rows.select("v").mapInArrow(_partial_sums, f"i int, j int, a {limb}, b {limb}, c {limb}")
            .groupBy("i", "j").agg(*[F.sum(x).cast(limb).alias(x) for x in "abc"]).collect())
    total = {(r["i"], r["j"]): (int(r["a"]) * LIMB + int(r["b"])) * LIMB + int(r["c"]) for r in sums}
    n = total.get((-1, -1), 0)
    d = sum(1 for i, j in total if j == -1 and i >= 0)
    s = [total[k, -1] for k in range(d)]
    return n, s, [[n * total[min(i, j), max(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)]


def _per_row(spark: SparkSession, count: int, fn, schema: str) -> list:
    """``fn(k)`` -> a row, for k below ``count``, spread over the cluster."""
    def run(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                out = fn(k)
                yield pa.RecordBatch.from_pylist([out])

    parts = max(1, min(count, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, count, 1, parts).mapInArrow(run, schema).collect()


def components(spark: SparkSession, matrix: list[list[int]], most: int = COMPONENTS):
    """Eigenvalues (exact to double precision, as fractions) and unit
    eigenvectors of ``matrix`` by falling eigenvalue, positive ones only."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return [], []
    ship(spark)
    shared = spark.sparkContext.broadcast(matrix)   # a side per dimension
    primes = exact_spectrum.primes_for(exact_spectrum.coefficient_bits(trace, d))

    def residues(k):
        return {"k": k, "c": exact_spectrum.charpoly_mod(shared.value, primes[k])}

    found = _per_row(spark, len(primes), residues, "k long, c array<long>")
    polynomial = exact_spectrum.combine({primes[r["k"]]: list(r["c"]) for r in found})
    roots, once = exact_spectrum.isolate(polynomial, most)

    def vectors(k):
        root = roots[k]
        a, s = exact_spectrum.refine(once, root)
        bits = root.gap.bit_length() - 1 - root.scale
        return {"k": k, "a": str(a), "s": s,
                "v": exact_spectrum.null_vectors(shared.value, a, s, bits, root.times)}

    values, axes = [], []
    for r in sorted(_per_row(spark, len(roots), vectors, "k long, a string, s long, v array<array<double>>"),
                    key=lambda r: r["k"]):
        for v in r["v"]:
            values.append(Fraction(int(r["a"]), 2 ** r["s"]))
            axes.append(list(v))
    return values[:most], axes[:most]


def _projector(n: int, sums: list[int], axes: np.ndarray):
    """Whitened values and the integer deviation n x - S of a batch's vectors."""
    def run(y: np.ndarray):
        top = max(abs(n) * int(np.abs(y).max(initial=0)) + max((abs(x) for x in sums), default=0), 1)
        if top < 2 ** 62:
            off = n * y - np.array(sums, np.int64)
            whole = [int(x) for x in (off * off).sum(1)] if top * top * y.shape[1] < 2 ** 62 else \
                [sum(int(x) ** 2 for x in row) for row in off]
        else:
            off = n * y.astype(object) - np.array(sums, dtype=object)
            whole = [sum(x * x for x in row) for row in off]
        return (off / n).astype(np.float64) @ axes, whole
    return run


def _whitened(project):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                b = batch.slice(lo, ROWS)
                z, deviation = project(_matrix(b))
                lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), z.ravel())
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array([str(x) for x in deviation]).cast(pa.decimal128(38, 0)), lists],
                    ["vec_id", "deviation", "whitened"])
    return run


def _moments(project):
    """Per task and pair of components: rows, both means, and the products of
    the values less their means."""
    def run(batches):
        n, mean, cov = 0, None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                z, _ = project(_matrix(batch.slice(lo, ROWS)))
                m, k = z.mean(0), len(z)
                c = (z - m).T @ (z - m)
                if n:
                    step = m - mean
                    cov = cov + c + np.outer(step, step) * (n * k / (n + k))
                    mean = mean + step * (k / (n + k))
                else:
                    mean, cov = m, c
                n += k
        if n:
            i, j = np.triu_indices(len(mean))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), n, np.int64)),
                 pa.array(mean[i]), pa.array(mean[j]), pa.array(cov[i, j])], ["i", "j", "n", "x", "y", "xy"])
    return run


def identity_error(rows: DataFrame, project) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    # the means of tasks differ by little, the mean of all is near zero: the
    # tasks' centred products are put together around the common mean
    parts = rows.mapInArrow(_moments(project), "i int, j int, n long, x double, y double, xy double")
    both = parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(F.expr("n * x")).alias("x"), F.sum(F.expr("n * y")).alias("y"),
        F.sum(F.expr("xy + n * x * y")).alias("xy"))
    entry = F.expr("(xy - x * y / n) / n - if(i = j, 1D, 0D)")
    return both.agg(F.max(F.abs(entry)).alias("worst")).first()["worst"]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           most: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation
    (sum of (n x - S)^2, an exact decimal), whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ship(spark)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, " \
             "identity_error double"
    rows = usable(vectors, id_col, vector_col)
    n, sums, matrix = scatter(rows)
    values, axes = components(spark, matrix, most) if n else ([], [])
    if not values:
        return spark.createDataFrame([], schema)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    scale = np.array([float(x / (n * n)) for x in values]) ** 0.5    # M is n squared times the covariance
    project = _projector(n, sums, (np.array(axes) / scale[:, None]).T)
    worst = identity_error(rows, project)
    explained = F.array(*[F.lit(float(x / trace)) for x in values])
    out = rows.mapInArrow(_whitened(project), "vec_id long, deviation decimal(38,0), whitened array<double>")
    return (out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "whitened", explained[F.col("at")].alias("explained"),
                    F.lit(worst).cast("double").alias("identity_error")))
