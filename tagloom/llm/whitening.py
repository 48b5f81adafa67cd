"""Embedding whitening by polarisation covariance.

Entries become integers x = floor(1024 * c) + 100000, so every sum below is exact. A first
aggregate gives n and the per-dimension sums S. A second pass centres each row exactly as
n * x - S and sums, in integers, the squared centred value of every dimension and of every
sum of two dimensions; partial sums are formed inside each task and merged by key as
decimal(38, 0). By polarisation, 2 * cov(a, b) = var(a + b) - var(a) - var(b), so those
d + d(d-1)/2 squares give the whole covariance matrix, assembled on the driver (d x d numbers)
for ``numpy.linalg.eigh``. A third pass projects every row on the leading components; a fourth
sums the products of the whitened values to measure how far their covariance is from identity.

Defined cases:

* a null vector, a vector holding a null, NaN or infinite entry, and a vector whose length
  differs from the table's dimension (its longest vector) is dropped, as holding missing entries;
* a table with no remaining rows, or of dimension 0, gives no rows;
* repeated rows (same vec_id too) are separate rows of the fit list and of the result;
* a component of eigenvalue 0 gives whitened 0 (there is no spread to scale);
* signs: each component's entry of largest magnitude is made positive;
* other columns of ``embeddings`` are ignored, whatever their names.
"""

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the integer form of an entry.
SCALE = 1024
SHIFT = 100000
COMPONENTS = 8

LIMIT = (1 << 62) - 1


def integer_vectors(embeddings, column="embedding"):
    """(vec_id, x) of the rows to fit, x an array of longs; dimension d, the longest vector."""
    x = F.transform(F.col(column), lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    d = embeddings.select(F.max(F.size(column))).first()[0]
    d = int(d) if d is not None and d > 0 else 0
    clean = embeddings.where(
        F.col(column).isNotNull()
        & (F.size(column) == d)
        & F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    )
    return clean.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")), d


def _matrix(frame, d):
    return np.array(frame["x"].tolist(), dtype=np.int64).reshape(len(frame), d)


def _square_sums(centred):
    """Exact sums over rows of c_i^2 (i) and (c_i + c_j)^2 (i < j), as Python integers."""
    d = centred.shape[1]
    out = [0] * (d + d * (d - 1) // 2)
    top = int(np.abs(centred).max()) if centred.size else 0
    if 4 * top * top > LIMIT:  # values too large for int64 squares: Python integers
        rows = [[int(v) for v in r] for r in centred]
        for r in rows:
            k = d
            for i in range(d):
                out[i] += r[i] * r[i]
                for j in range(i + 1, d):
                    out[k] += (r[i] + r[j]) ** 2
                    k += 1
        return out
    step = max(1, LIMIT // max(1, 4 * top * top))
    for lo in range(0, len(centred), step):
        block = centred[lo : lo + step]
        square = (block * block).sum(axis=0)
        for i in range(d):
            out[i] += int(square[i])
        k = d
        for i in range(d - 1):
            pair = block[:, i : i + 1] + block[:, i + 1 :]
            sums = (pair * pair).sum(axis=0)
            out[k : k + len(sums)] = [a + int(b) for a, b in zip(out[k : k + len(sums)], sums)]
            k += len(sums)
    return out


def polarised_sums(vectors, n, sums, d):
    """(key, total) rows: key i < d is sum (n x_i - S_i)^2, then one key for each pair i < j, in order."""
    centre = np.array(sums, dtype=object)

    def partial(batches):
        totals = None
        for frame in batches:
            if len(frame) == 0:
                continue
            x = _matrix(frame, d)
            if n * int(np.abs(x).max()) + int(max(abs(s) for s in sums)) < LIMIT:
                centred = x * np.int64(n) - np.array(sums, dtype=np.int64)
            else:
                centred = (x.astype(object) * n - centre)
            part = _square_sums(centred if centred.dtype != object else centred.astype(object))
            totals = part if totals is None else [a + b for a, b in zip(totals, part)]
        if totals is not None:
            yield pd.DataFrame({"key": np.arange(len(totals), dtype=np.int32), "total": [str(v) for v in totals]})

    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("total", T.StringType())])
    parts = vectors.select("x").mapInPandas(partial, schema)
    return parts.groupBy("key").agg(F.sum(F.col("total").cast(T.DecimalType(38, 0))).cast("string").alias("total"))


def covariance(vectors, d):
    """n, S and the covariance matrix (divisor n) of the integer vectors, by polarisation."""
    aggs = vectors.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    n = int(aggs["n"])
    if n == 0:
        return 0, [], None
    sums = [int(aggs[f"s{i}"]) for i in range(d)]
    totals = {row["key"]: int(row["total"]) for row in polarised_sums(vectors, n, sums, d).collect()}
    square = [totals.get(i, 0) for i in range(d)]
    scale = Fraction(1, n**3)  # centred values carry a factor n; the divisor is n
    cov = np.zeros((d, d))
    k = d
    for i in range(d):
        cov[i, i] = float(square[i] * scale)
        for j in range(i + 1, d):
            cross = Fraction(totals.get(k, 0) - square[i] - square[j], 2) * scale
            cov[i, j] = cov[j, i] = float(cross)
            k += 1
    return n, sums, cov


def components(cov, count=COMPONENTS):
    """Eigenvalues (falling) and unit eigenvectors (columns) of the leading ``count`` components."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(count, len(values))]
    values, vectors = values[order], vectors[:, order]
    flip = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.maximum(values, 0.0), vectors * np.where(flip == 0, 1.0, flip)


def _projector(n, sums, d, values, vectors):
    centre = np.array(sums, dtype=np.int64) if max(abs(s) for s in sums) < LIMIT else None
    scale = np.where(values > 0, 1.0 / np.sqrt(np.where(values > 0, values, 1.0)), 0.0)

    def project(frame):
        x = _matrix(frame, d)
        if centre is not None and n * int(np.abs(x).max(initial=0)) < LIMIT // 2:
            centred = x * np.int64(n) - centre
            wide = np.abs(centred).max(initial=0) ** 2 * d > LIMIT
        else:
            centred, wide = None, True
        if wide:
            exact = x.astype(object) * n - np.array(sums, dtype=object)
            deviation = [int(sum(int(v) * int(v) for v in r)) for r in exact]
            shifted = np.array([[float(Fraction(int(v), n)) for v in r] for r in exact]).reshape(len(frame), d)
        else:
            deviation = (centred * centred).sum(axis=1)
            shifted = centred / n
        return np.asarray(deviation, dtype=object), (shifted @ vectors) * scale

    return project


def whiten(embeddings, column="embedding", count=COMPONENTS):
    """For each row to fit and each leading component: vec_id, component, n, deviation, whitened,
    explained and identity_error (see the module text for the defined cases)."""
    spark = embeddings.sparkSession
    vectors, d = integer_vectors(embeddings, column)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums, cov = covariance(vectors, d) if d else (0, [], None)
    if n == 0:
        return spark.createDataFrame([], schema)
    values, basis = components(cov, count)
    k = len(values)
    trace = float(np.trace(cov))
    explained = values / trace if trace > 0 else np.zeros(k)
    project = _projector(n, sums, d, values, basis)

    def products(batches):
        total = np.zeros((k, k))
        first = np.zeros(k)
        for frame in batches:
            if len(frame):
                _, w = project(frame)
                total += w.T @ w
                first += w.sum(axis=0)
        yield pd.DataFrame({"cell": np.arange(k * k + k, dtype=np.int32), "v": np.concatenate([total.ravel(), first])})

    cells = vectors.select("x").mapInPandas(products, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    merged = np.zeros(k * k + k)
    for row in cells:
        merged[row["cell"]] = row["v"]
    mean = merged[k * k :] / n
    white_cov = merged[: k * k].reshape(k, k) / n - np.outer(mean, mean)
    identity_error = float(np.abs(white_cov - np.eye(k)).max())

    def rows(batches):
        for frame in batches:
            if len(frame) == 0:
                continue
            deviation, w = project(frame)
            m = len(frame)
            yield pd.DataFrame(
                {
                    "vec_id": np.repeat(frame["vec_id"].to_numpy(), k),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, n, dtype=np.int64),
                    "deviation": np.repeat(np.array([int(v) for v in deviation], dtype=np.int64), k),
                    "whitened": w.ravel(),
                    "explained": np.tile(explained, m),
                    "identity_error": np.full(m * k, identity_error),
                }
            )

    return vectors.mapInPandas(rows, schema)
