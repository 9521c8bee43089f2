"""Embedding whitening by spectrum slicing.

Rows whose vector is null, or holds a null or non-finite entry, take no part.
An entry c becomes the whole number x = floor(1024 c) + 100000.  Three passes
over the table: counts and sums per dimension (exact), the covariance of the
centred vectors (each task adds up one matrix, Spark adds up their cells), and
the projection.  The driver sees one covariance matrix, whose size is that of a
vector squared, whatever the number of rows.

Spectrum slicing, on that matrix.  The signs of the blocks of a symmetric
factorisation L D L' of V - s I (``inertia``) tell how many eigenvalues lie
above s.  Bisection by such counts isolates the k-th largest eigenvalue in an
interval that holds no other.  Rayleigh quotient iteration from there converges
cubically; it is taken only if it ends inside the interval, else the interval is
halved further.  Finally counts just below and just above the value found
certify its number.  Eigenvalues that counts cannot tell apart (equal to
rounding) form a group with one basis, orthogonal to all before.

Defined cases: the length of the vectors is that of most rows (ties: the longer
one); rows of another length, and empty vectors, take no part; repeated rows and
ids and null ids are kept; an empty table gives an empty result.  A component
whose eigenvalue is zero (to rounding) has whitened null, and takes no part in
identity_error; without variance explained is null.  deviation is null where it
exceeds a long.  Entries beyond 2^32 in size count as 2^32.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.session import scratch_path

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 32)
_EPS = np.finfo(np.float64).eps


# --------------------------------------------------------------------- spectrum
def inertia(a: np.ndarray) -> int:
    """Number of negative eigenvalues of a symmetric matrix: blocks of one and
    two rows are eliminated with diagonal pivoting (Bunch and Kaufman), and by
    Sylvester's law the signs of the blocks are those of the eigenvalues."""
    a = a.copy()
    n, k, negative = len(a), 0, 0
    alpha = (1 + 17 ** 0.5) / 8
    tiny = _EPS * max(np.abs(a).max(initial=0.0), np.finfo(float).tiny)

    def swap(i, j):
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        largest, block = (below[r - k - 1] if r > k else 0.0), 1
        if abs(a[k, k]) < alpha * largest:
            other = np.abs(a[k:, r])
            other[r - k] = 0
            most = other.max()
            if abs(a[k, k]) * most >= alpha * largest * largest:
                pass
            elif abs(a[r, r]) >= alpha * most:
                swap(k, r)
            else:
                swap(k + 1, r)
                block = 2
        if block == 1:
            d = a[k, k] if abs(a[k, k]) > tiny else tiny
            negative += d < 0
            c = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(c / d, c)
        else:                                   # determinant below zero: one of each sign
            negative += 1
            c = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
        k += block
    return int(negative)


def _above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues above s."""
    return inertia(s * np.eye(len(v)) - v)


def _without(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            x = x - (b @ x) * b
    return x / np.linalg.norm(x)


def _rayleigh(v: np.ndarray, shift: float, x: np.ndarray, basis: list[np.ndarray], size: float):
    """Rayleigh quotient iteration from ``shift``: value, vector, residual."""
    value = shift
    best = None
    for step in range(12):
        m = v - value * np.eye(len(v))
        try:
            y = np.linalg.solve(m, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(m + _EPS * size * np.eye(len(v)), x)
        if not np.isfinite(y).all() or not y.any():
            break
        x = _without(y / np.linalg.norm(y), basis)
        if step:                                # the first step is inverse iteration at the interval's middle
            value = float(x @ v @ x)
        rest = float(np.linalg.norm(v @ x - (x @ v @ x) * x))
        if best is None or rest < best[2]:
            best = float(x @ v @ x), x, rest
        elif step > 2:
            break
    return best


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors (columns)."""
    d = len(v)
    size = float(np.abs(v).sum(axis=1).max(initial=0.0))
    if size == 0:
        return np.zeros(count), np.eye(d)[:, :count]
    least = 8 * _EPS * size                      # narrower than this counts cannot tell
    values: list[float] = []
    basis: list[np.ndarray] = []
    known = {-size * 1.001: d, size * 1.001: 0}  # numbers of eigenvalues above a shift
    rng = np.random.Generator(np.random.PCG64(d))

    def number(s: float) -> int:
        if s not in known:
            known[s] = _above(v, s)
        return known[s]

    while len(values) < count:
        k = len(values)
        low = max(s for s, n in known.items() if n > k)       # the (k + 1)-th lies in [low, high]
        high = min((s for s, n in known.items() if n <= k and s > low), default=size * 1.001)
        found = None
        while high - low > least:
            if number(low) == k + 1 and number(high) == k and high - low < 0.25 * max(abs(low), abs(high)):
                found = _rayleigh(v, (low + high) / 2, _without(rng.standard_normal(d), basis), basis, size)
                # counts around the value found certify its number
                if found and low <= found[0] <= high and found[2] <= 64 * least:
                    room = max(4 * found[2], least)
                    if number(found[0] - room) == k + 1 and number(found[0] + room) == k:
                        break
                found = None
            middle = (low + high) / 2
            if number(middle) > k:
                low = middle
            else:
                high = middle
        if found:
            values.append(found[0])
            basis.append(found[1])
            continue
        # several that counts cannot tell apart, or one too close to another
        for _ in range(max(1, min(number(low), count) - k)):
            got = _rayleigh(v, (low + high) / 2, _without(rng.standard_normal(d), basis), basis, size)
            values.append(got[0])
            basis.append(got[1])
    order = np.argsort(-np.array(values[:count]), kind="stable")
    return np.array(values)[order], np.column_stack([basis[i] for i in order])


# ----------------------------------------------------------------------- passes
def _valid(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, entries as doubles."""
    v = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)


def _matrix(col, d: int) -> np.ndarray:
    """Entries of a list column, one row each, as whole numbers."""
    c = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * np.clip(c, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _sums(batches):
    total: dict[int, list] = {}
    for batch in batches:
        col = batch.column(0)
        size = col.value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(size).tolist():
            x = _matrix(col.filter(pa.array(size == d)), d)
            part = total.setdefault(d, [0, [0] * d])
            part[0] += len(x)
            part[1] = [a + int(b) for a, b in zip(part[1], x.sum(axis=0).tolist(), strict=True)]
    for d, (n, sums) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                                          pa.array([n] * d, pa.int64()), pa.array(sums, pa.int64())],
                                         names=["d", "i", "n", "s"])


def _cells(mean: np.ndarray):
    d = len(mean)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column(0).slice(a, 4096), d) - mean
                total += x.T @ x
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], names=["i", "j", "s"])
    return run


def _projected(n: int, sums: list[int], axes: np.ndarray):
    d = len(sums)
    s = np.array(sums, np.int64)
    mean, largest = s / n, float(1 << 62)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            whitened = (x - mean) @ axes
            fits = np.square(n * x.astype(float) - s).sum(axis=1) < largest
            deviation = np.square(n * x - s).sum(axis=1)
            flat = pa.array(whitened.reshape(-1), mask=np.isnan(whitened).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * axes.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, mask=~fits), lists],
                                             names=["vec_id", "deviation", "w"])
    return run


def fit(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS):
    """The whitening of a table: (n, sums per dimension, covariance, eigenvalues,
    eigenvectors as columns), or None without a vector."""
    rows = _valid(embeddings, id_col, vector_col)
    per = rows.select("v").mapInArrow(_sums, "d int, i int, n long, s long").groupBy("d", "i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"))
    most = per.filter("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    d, n = most["d"], most["n"]
    sums = [r["s"] for r in per.filter(F.col("d") == d).orderBy("i").collect()]        # d numbers
    cells = (rows.filter(F.size("v") == d).select("v").mapInArrow(_cells(np.array(sums, np.int64) / n), "i int, j int, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas())                 # d * d numbers
    v = np.zeros((d, d))
    v[cells["i"], cells["j"]] = v[cells["j"], cells["i"]] = cells["s"] / n
    values, axes = leading(v, min(components, d))
    return n, sums, v, values, axes


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and leading component: vec_id, component (from 1), n,
    deviation, whitened, explained (share of the whole variance) and
    identity_error (largest entry of whitened's covariance minus the identity)."""
    spark = embeddings.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit(embeddings, id_col, vector_col, components)
    if fitted is None:
        return spark.createDataFrame([], schema)
    n, sums, v, values, axes = fitted
    trace = float(np.trace(v))
    some = values > 64 * _EPS * trace
    scaled = np.where(some, axes / np.sqrt(np.where(some, values, 1.0)), np.nan)
    path = scratch_path(spark, "whitened")
    (_valid(embeddings, id_col, vector_col).filter(F.size("v") == len(sums))
     .mapInArrow(_projected(n, sums, scaled), "vec_id long, deviation long, w array<double>").write.parquet(path))
    rows = spark.read.parquet(path)
    use = np.flatnonzero(some).tolist()
    w = [F.col("w")[i] for i in use]
    error = None
    if use:
        mean = list(rows.agg(*[F.avg(c) for c in w]).first())
        pairs = [(i, j) for i in range(len(use)) for j in range(i, len(use))]
        cov = rows.agg(*[F.avg((w[i] - F.lit(mean[i])) * (w[j] - F.lit(mean[j]))) for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs, strict=True))
    share = F.array(*[F.lit(max(0.0, float(e)) / trace if trace > 0 else None).cast("double") for e in values])
    return (rows.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(share, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error")))
