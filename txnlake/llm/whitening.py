"""Whitening of embeddings by an exact characteristic polynomial.

Vectors become integers, so their scatter matrix M (n times the sum of products less the product of
sums, n * n times the covariance) is exact.  Four steps after it:

1. det(x - M) modulo many primes, each by reduction to Hessenberg form, one prime a row of a Spark
   job; Chinese remaindering gives the integer polynomial.  As M has no negative eigenvalue, its
   coefficients are bounded by the trace, and so is the number of primes.
2. All roots are real, so the sign changes of the polynomial shifted by a are the number of
   roots beyond a, exactly.  Bisection on that count isolates the largest roots to 128 bits.
3. Inverse iteration on M - root with 120 digits turns start vectors into the null space; roots that
   are equal to 80 bits share one, and get orthogonal vectors in it.
4. Rows are centred by whole numbers, projected and scaled.

Rows are read three times and never shuffled; what leaves them is a matrix of the dimension squared.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from decimal import Decimal
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import stored

COMPONENTS = 8
SCALE = 1024
LARGEST = 2.0**52  # of an entry: its integer then fits a long
LIMB = 20  # bits; products of limbs of 4,096 rows are exact in double precision
BLOCK_ROWS = 4096
FLUSH_BLOCKS = 1024
ROOT_BITS = 128
SAME_BITS = 80
DIGITS = 120
STEPS = 3


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite entries of at most LARGEST; NaN counts as the largest."""
    v = F.col(vector)
    return rows.filter(
        v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))
    )


def integers(column: pa.ListArray, dimensions: int) -> np.ndarray:
    """floor(SCALE * entry) of all vectors, as a matrix of longs."""
    flat = np.asarray(column.flatten(), np.float64) * SCALE
    return np.floor(flat).astype(np.int64).reshape(-1, dimensions)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    size, sign = np.abs(y), np.sign(y)
    count = max(1, -(-int(size.max(initial=0)).bit_length() // LIMB))
    mask = (1 << LIMB) - 1
    return [(((size >> (LIMB * k)) & mask) * sign).astype(np.float64) for k in range(count)]


def _scatter(rows: DataFrame, dimensions: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums of the dimensions, and sums of all products, as Python integers."""
    width = dimensions + 1  # a column of ones first: its products are the count and the sums
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        blocks = 0

        def flush():
            for level, total in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(upper[0])), pa.int32()),
                        pa.array(np.full(len(upper[0]), level), pa.int32()),
                        pa.array(total[upper]),
                    ],
                    names=["cell", "level", "part"],
                )

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                y = integers(batch.column(0).slice(start, BLOCK_ROWS), dimensions)
                limbs = _limbs(np.hstack([np.ones((len(y), 1), np.int64), y]))
                for i, a in enumerate(limbs):
                    for j, b in enumerate(limbs):
                        part = (a.T @ b).astype(np.int64)
                        sums[i + j] = sums[i + j] + part if i + j in sums else part
                blocks += 1
                if blocks % FLUSH_BLOCKS == 0:
                    yield from flush()
                    sums = {}
        yield from flush()

    parts = rows.mapInArrow(run, "cell int, level int, part long")
    total = F.sum(F.col("part").cast("decimal(20,0)")).alias("total")
    matrix = np.zeros((width, width), object)
    for row in parts.groupBy("cell", "level").agg(total).collect():  # the dimension squared
        i, j = upper[0][row.cell], upper[1][row.cell]
        matrix[i, j] += int(row.total) << (LIMB * row.level)
    matrix = matrix + np.triu(matrix, 1).T
    return int(matrix[0, 0]), [int(s) for s in matrix[0, 1:]], matrix[1:, 1:]


def hessenberg_polynomial(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo p, constant first; `a` has longs from 0 to p - 1."""
    h, d = a.copy(), len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[pivot, m]] = h[[m, pivot]]
            h[:, [pivot, m]] = h[:, [m, pivot]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    # Polynomials of the leading blocks; `chain` has the products of subdiagonal entries down to k.
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    chain = np.zeros(0, np.int64)
    for k in range(1, d + 1):
        last = polynomials[k - 1]
        out = np.r_[0, last[:-1]] - h[k - 1, k - 1] * last % p
        if k > 1:
            chain = np.r_[chain, 1] * h[k - 1, k - 2] % p
            weights = h[: k - 1, k - 1] * chain % p
            out -= (weights[:, None] * polynomials[: k - 1] % p).sum(axis=0) % p
        polynomials[k] = out % p
    return polynomials[d]


def _is_prime(n: int) -> bool:
    """For odd n below 2**31."""
    s = (n - 1 & 1 - n).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, n - 1 >> s, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def _primes(product: int) -> list[int]:
    """Primes below 2**31, from the largest on, until their product exceeds a number."""
    found, total, n = [], 1, (1 << 31) - 1
    while total <= product:
        if _is_prime(n):
            found.append(n)
            total *= n
        n -= 2
    return found


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), constant first, for a matrix without negative eigenvalues."""
    d = len(matrix)
    trace = int(sum(matrix.diagonal()))
    bound = max(comb(d, k) * (trace // k + 1) ** k for k in range(1, d + 1))
    primes = _primes(2 * bound + 1)
    shared = spark.sparkContext.broadcast((matrix, primes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, moduli = shared.value
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            found = [
                hessenberg_polynomial((whole % moduli[i]).astype(np.int64), moduli[i]).tolist()
                for i in numbers
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["number", "residues"],
            )

    tasks = spark.range(0, len(primes), 1, min(len(primes), 1 + len(primes) // 16))
    rows = tasks.mapInArrow(run, "number long, residues array<long>").collect()
    product = 1
    for p in primes:
        product *= p
    totals = [0] * (d + 1)
    for row in rows:
        rest = product // primes[row.number]
        lift = rest * pow(rest, -1, primes[row.number])
        for k, residue in enumerate(row.residues):
            totals[k] += residue * lift
    totals = [t % product for t in totals]
    return [t - product if 2 * t > product else t for t in totals]


def roots_beyond(polynomial: list[int], a: int) -> int:
    """Roots greater than a, each as often as it occurs, of a polynomial with real roots only."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs[:-1], signs[1:], strict=True))


def isolated_root(polynomial: list[int], k: int, upper: int) -> tuple[int, int] | None:
    """(a, s): the k-th largest root lies in ((a - 1) / 2**s, a / 2**s]; None if it is not positive.

    `upper` is no less than any root.
    """
    if roots_beyond(polynomial, 0) < k:
        return None
    d = len(polynomial) - 1
    s = max(0, ROOT_BITS - upper.bit_length())
    while True:
        scaled = [c << (s * (d - i)) for i, c in enumerate(polynomial)]
        low, high = 0, upper << s
        while high - low > 1:
            middle = (low + high) // 2
            if roots_beyond(scaled, middle) >= k:
                low = middle
            else:
                high = middle
        if high.bit_length() > ROOT_BITS // 2:
            return high, s
        s += ROOT_BITS  # a root that is small beside the largest


def _eliminated(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangular factors in one matrix, and the order of rows, by partial pivoting."""
    a = a.copy()
    order = np.arange(len(a))
    for k in range(len(a) - 1):
        pivot = k + max(range(len(a) - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        if a[k, k]:
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])
    return a, order


def _solved(factors: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = b[order]
    for k in range(1, len(x)):
        x[k] = x[k] - factors[k, :k] @ x[:k]
    for k in range(len(x) - 1, -1, -1):
        x[k] = (x[k] - factors[k, k + 1 :] @ x[k + 1 :]) / factors[k, k]
    return x


def null_vectors(matrix: np.ndarray, root: Decimal, count: int) -> np.ndarray:
    """`count` orthogonal unit vectors that matrix - root turns almost into nothing."""
    with decimal.localcontext(prec=DIGITS):
        d = len(matrix)
        shifted = np.array([[Decimal(int(x)) for x in row] for row in matrix], object)
        for i in range(d):
            shifted[i, i] -= root
        factors, order = _eliminated(shifted)
        start = np.random.default_rng(d).integers(1, 1 << 30, (count, d))
        vectors = [np.array([Decimal(int(x)) for x in row], object) for row in start]
        for _ in range(STEPS):
            done: list[np.ndarray] = []
            for v in vectors:
                x = _solved(factors, order, v)
                for _ in range(2):  # once more for what the first pass leaves
                    for other in done:
                        x = x - (x @ other) * other
                    x = x / (x @ x).sqrt()
                done.append(x)
            vectors = done
        out = np.array([[float(x) for x in v] for v in vectors])
    # Either sign would do: the largest entry is positive.
    top = np.abs(out).argmax(axis=1)
    return out * np.sign(out[np.arange(count), top])[:, None]


def eigenpairs(spark: SparkSession, matrix: np.ndarray, count: int):
    """The largest eigenvalues that are not zero, as Decimals, falling, and their unit vectors."""
    trace = int(sum(matrix.diagonal()))
    if not trace:
        return [], np.zeros((0, len(matrix)))
    shared = spark.sparkContext.broadcast((matrix, characteristic_polynomial(spark, matrix)))
    count = min(count, len(matrix))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root = isolated_root(shared.value[1], k, trace)
                if root:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k]), pa.array([str(root[0])]), pa.array([root[1]], pa.int32())],
                        names=["k", "a", "s"],
                    )

    numbers = spark.range(1, count + 1, 1, count)
    found = numbers.mapInArrow(find, "k long, a string, s int").collect()
    # A little beyond the interval, so that M - root is never quite singular.
    with decimal.localcontext(prec=DIGITS):
        roots = [
            (Decimal(int(r.a)) + Decimal("0.25")) / (1 << r.s)
            for r in sorted(found, key=lambda r: r.k)
        ]
        groups: list[list[Decimal]] = []
        for root in roots:
            if groups and groups[-1][-1] - root <= groups[-1][-1] / (1 << SAME_BITS):
                groups[-1].append(root)
            else:
                groups.append([root])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column(0).to_pylist():
                vectors = null_vectors(shared.value[0], groups[g][0], len(groups[g]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([g] * len(vectors)),
                        pa.array(range(len(vectors)), pa.int32()),
                        pa.array(vectors.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["g", "i", "v"],
                )

    tasks = spark.range(0, len(groups), 1, len(groups))
    solved = tasks.mapInArrow(solve, "g long, i int, v array<double>").collect()
    return roots, np.array([r.v for r in sorted(solved, key=lambda r: (r.g, r.i))])


def _projected(rows: DataFrame, n: int, sums: list[int], directions: np.ndarray) -> DataFrame:
    """Rows (id, deviation_exact, w): the squared distance from the mean, n * n times, and whitened.

    `directions` are the components over the roots of their variances.
    """
    dimensions = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]  # the nearest whole numbers to the mean
    rest = [s - n * c for s, c in zip(sums, middle, strict=True)]
    shared = rows.sparkSession.sparkContext.broadcast((middle, rest, directions))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, rest, directions = shared.value
        whole, part = np.array(rest, object), np.array([r / n for r in rest])
        square = sum(r * r for r in rest)
        for batch in batches:
            y = integers(batch.column("v"), dimensions)
            largest = int(np.abs(y).max(initial=0)) + max(map(abs, middle))
            if dimensions * largest * max(largest, n) < 1 << 62:
                off = y - np.array(middle, np.int64)
                own, cross = (off * off).sum(axis=1), off @ whole.astype(np.int64)
            else:
                off = y.astype(object) - np.array(middle, object)
                own, cross = (off * off).sum(axis=1), off @ whole
            pairs = zip(own.tolist(), cross.tolist(), strict=True)
            exact = [n * n * a - 2 * n * b + square for a, b in pairs]
            exact = [x if x < 10**38 else None for x in exact]
            w = (off.astype(np.float64) - part) @ directions.T
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(exact, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel())),
                ],
                names=["id", "deviation_exact", "w"],
            )

    return rows.mapInArrow(run, f"id {kind}, deviation_exact decimal(38,0), w array<double>")


def _identity_error(white: DataFrame, count: int) -> float:
    """How far the covariance of the whitened values is from the identity, at most."""
    values = [F.element_at("w", i + 1) for i in range(count)]
    means = white.agg(*(F.avg(v).alias(f"m{i}") for i, v in enumerate(values))).first()
    cells = [
        F.avg((values[i] - F.lit(means[i])) * (values[j] - F.lit(means[j]))) - F.lit(float(i == j))
        for i in range(count)
        for j in range(i, count)
    ]
    found = white.agg(*(F.abs(cell).alias(f"c{k}") for k, cell in enumerate(cells))).first()
    return max(found)


def whiten(
    rows: DataFrame,
    vector: str = "embedding",
    row_id: str = "vec_id",
    components: int = COMPONENTS,
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error, deviation_exact).

    The column of ids keeps its name.  One row for each usable vector and each of the first
    `components` components (from 1), fewer where fewer have a variance: none where all vectors are
    equal, so also for one vector or an empty table.  A vector is not usable that is null, holds a
    null, NaN, infinite or larger entry than 2**52, or has another length than most (of lengths
    equally frequent the greatest counts).  Null and repeated ids stay; repeated vectors count as
    often as they occur.  Components of equal variance are some orthogonal choice.  `deviation` is
    null beyond a long; `deviation_exact` has up to 38 digits.  Other columns are not read.
    """
    spark = rows.sparkSession
    slim = usable(rows.select(F.col(row_id).alias("id"), F.col(vector).alias("v")), "v")
    kind = slim.schema["id"].dataType.simpleString()
    schema = (
        f"`{row_id}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double, deviation_exact decimal(38,0)"
    )
    lengths = slim.groupBy(F.size("v").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if most is None or not most.d:
        return spark.createDataFrame([], schema)
    slim = slim.filter(F.size("v") == most.d)
    n, sums, products = _scatter(slim.select("v"), most.d)
    matrix = n * products - np.outer(np.array(sums, object), np.array(sums, object))
    roots, vectors = eigenpairs(spark, matrix, components)
    if not roots:
        return spark.createDataFrame([], schema)
    with decimal.localcontext(prec=DIGITS):
        deviations = [float(root.sqrt() / n) for root in roots]
        trace = Decimal(int(sum(matrix.diagonal())))
        explained = [float(root / trace) for root in roots]
    directions = vectors / np.array(deviations)[:, None]
    white = stored(_projected(slim, n, sums, directions), "whitened")
    error = _identity_error(white, len(roots))
    share = F.array(*map(F.lit, explained))
    exact = F.col("deviation_exact")
    return white.select(
        F.col("id").alias(row_id), "deviation_exact", F.posexplode("w").alias("at", "whitened")
    ).select(
        row_id,
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.when(exact <= F.lit((1 << 63) - 1), exact.cast("long")).alias("deviation"),
        "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_exact",
    )
