"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Vectors become whole numbers; the distinct ones are the fit list.  Its sums and products are added up
exactly, so ``n * products - sums * sums`` is n**2 times the covariance without any rounding.  The
characteristic polynomial of that integer matrix comes from its Hessenberg forms modulo many primes, dealt
to tasks, and the Chinese remainder theorem.  The matrix is symmetric, so all roots are real and Descartes' rule is exact:
the changes of sign of p(x + a) count the roots above a, which isolates the leading roots by bisection; signs
of p alone then narrow each to ``DIGITS`` binary digits below the trace.  Inverse iteration at that root in
fixed-point numbers gives the null space of ``matrix - root``, orthonormalised; roots that agree to all those
digits share one space.  What goes through the driver is a matrix of dimension x dimension and
its polynomial, whatever the number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries, or is empty, are dropped;
repeated rows and equal vectors each get rows, the fit list has a vector once; vectors of different
length are fits of their own; a table without remaining rows gives none; fewer than four dimensions give as many
components.  A component without variance (one distinct vector, say) has ``whitened`` 0 and its own entry of
the identity is missed by 1; ``explained`` is then 0.  Entries beyond the range of a long take its end; a ``deviation`` beyond
it is null.  Null ids stay null; further columns of the table aren't looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import scratch, written

SCALE, COMPONENTS, DIGITS, PRIMES_A_TASK = 256, 4, 160, 32


# --- whole numbers ------------------------------------------------------------------------------

def whole(column: pa.Array, scale: int = SCALE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: (rows, matrix of floor(scale * entry) as int64) of the vectors that remain."""
    arr = column.cast(pa.large_list(pa.float64()))
    size = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(arr.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    out = {}
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        part = flat[start[rows][:, None] + np.arange(dim)]
        good = np.isfinite(part).all(axis=1)
        if good.any():
            low, high = -2.0 ** 63, np.nextafter(2.0 ** 63, 0)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * part[good]), low, high).astype(np.int64)
            out[dim] = rows[good], x
    return out


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold it; equal rows are equal bytes."""
    out = np.empty(len(x), object)
    low, high = x.min(axis=1), x.max(axis=1)
    left = np.ones(len(x), bool)
    for kind in (np.int8, np.int16, np.int32, np.int64):
        info = np.iinfo(kind)
        fits = left & (low >= info.min) & (high <= info.max)
        rows = np.flatnonzero(fits)
        out[rows] = [r.tobytes() for r in x[rows].astype(kind)]
        left &= ~fits
    return out.tolist()


def unpacked(values: pa.Array, dim: int) -> np.ndarray:
    """The rows that ``packed`` wrote, as int64."""
    size = pc.binary_length(values).to_numpy(zero_copy_only=False) // dim
    out = np.empty((len(values), dim), np.int64)
    for width in np.unique(size).tolist():
        rows = np.flatnonzero(size == width)
        raw = b"".join(values.take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(raw, f"<i{width}").reshape(-1, dim)
    return out


def products(x: np.ndarray) -> list[list[int]]:
    """The exact matrix x.T @ x as Python integers."""
    high = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    total = np.zeros((x.shape[1], x.shape[1]), object)
    if high < 1 << 26:  # a product of floats is exact while its sums stay below 2**53
        rows = max(1, (1 << 52) // (high * high))
        for a in range(0, len(x), rows):
            part = x[a:a + rows].astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
    else:
        wide = x.astype(object)
        for a in range(0, len(x), 64):
            total += wide[a:a + 64].T @ wide[a:a + 64]
    return total.tolist()


# --- characteristic polynomial --------------------------------------------------------------------

def primes_below(top: int, many: int) -> list[int]:
    """The ``many`` largest primes below ``top`` (Miller-Rabin, sure up to 3.2e9)."""
    found, n = [], top - 1 - top % 2
    while len(found) < many:
        if all(n % p for p in (3, 5, 7, 11, 13)):
            d, s = n - 1, 0
            while d % 2 == 0:
                d, s = d // 2, s + 1
            for base in (2, 3, 5, 7):
                y = pow(base, d, n)
                if y not in (1, n - 1) and not any((y := y * y % n) == n - 1 for _ in range(s - 1)):
                    break
            else:
                found.append(n)
        n -= 2
    return found


def inverses(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """a**-1 modulo p for arrays (0 for 0)."""
    out, base, e = np.ones_like(a), a % p, p - 2
    while e.any():
        out = np.where(e & 1 == 1, out * base % p, out)
        base, e = base * base % p, e >> 1
    return np.where(a % p == 0, 0, out)


def polynomials_modulo(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime below 2**31, from x**0 up; all primes at once."""
    d, many = len(matrix), len(primes)
    p = np.array(primes, np.int64)
    q, qq = p[:, None], p[:, None, None]
    exact = np.array(matrix, object)
    h = np.stack([(exact % k).astype(np.int64) for k in primes])
    every = np.arange(many)
    for k in range(d - 2):  # Hessenberg form: clear column k below the subdiagonal
        pivot = k + 1 + np.argmax(h[:, k + 1:, k] != 0, axis=1)
        swap, keep = h[every, pivot].copy(), h[:, k + 1].copy()
        h[every, pivot], h[:, k + 1] = keep, swap
        swap, keep = h[every, :, pivot].copy(), h[:, :, k + 1].copy()
        h[every, :, pivot], h[:, :, k + 1] = keep, swap
        m = h[:, k + 2:, k] * inverses(h[:, k + 1, k], p)[:, None] % q
        h[:, k + 2:] = (h[:, k + 2:] - m[:, :, None] * h[:, k + 1][:, None, :] % qq) % qq
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2:] * m[:, None, :] % qq).sum(axis=2)) % q
    poly = np.zeros((d + 1, many, d + 1), np.int64)  # of the leading blocks
    poly[0, :, 0] = 1
    for k in range(d):
        new = np.zeros((many, d + 1), np.int64)
        new[:, 1:] = poly[k][:, :-1]
        new = (new - h[:, k, k][:, None] * poly[k] % q) % q
        chain = np.ones(many, np.int64)
        for i in range(k - 1, -1, -1):
            chain = chain * h[:, i + 1, i] % p
            if not chain.any():
                break
            new = (new - (chain * h[:, i, k] % p)[:, None] * poly[i] % q) % q
        poly[k + 1] = new
    return poly[d]


def combined(primes: list[int], residues: list[list[int]]) -> list[int]:
    """The integers of least absolute value with those residues."""
    modulus = math.prod(primes)
    out = [0] * len(residues[0])
    for p, row in zip(primes, residues):
        rest = modulus // p
        unit = rest * pow(rest, -1, p)
        out = [(a + int(r) * unit) % modulus for a, r in zip(out, row)]
    return [a - modulus if a > modulus // 2 else a for a in out]


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient is larger: with eigenvalues of at least 0 the k-th is at most C(d, k) (trace/d)**k."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean ** k for k in range(d + 1))


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix) of a positive semidefinite matrix, from x**0 up, exact."""
    bits = 2 * coefficient_bound(matrix) + 1
    primes = primes_below(1 << 31, bits.bit_length() // 30 + 1)
    tasks = -(-len(primes) // PRIMES_A_TASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                mine = primes[k * PRIMES_A_TASK:(k + 1) * PRIMES_A_TASK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine, pa.int64()),
                     pa.array(polynomials_modulo(matrix, mine).tolist(), pa.list_(pa.int64()))],
                    names=["prime", "residues"])

    # a row for each prime, of one number per dimension: bounded by the dimension alone
    rows = spark.range(0, tasks, 1, tasks).mapInArrow(run, "prime long, residues array<long>").collect()
    return combined([r.prime for r in rows], [r.residues for r in rows])


# --- roots ----------------------------------------------------------------------------------------

def roots_above(poly: list[int], a: int, shift: int) -> int:
    """How many roots (counted as often as they are ones) lie above a / 2**shift; all must be real."""
    d = len(poly) - 1
    c = [v << shift * (d - k) for k, v in enumerate(poly)]  # of p(x / 2**shift), times a constant
    for i in range(d):
        carry = 0
        for k in range(d, i - 1, -1):
            carry = c[k] + carry * a
            c[k] = carry
    signs = [v > 0 for v in c if v]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, shift: int) -> int:
    total, unit = 0, 0
    for v in reversed(poly):
        total = total * a + (v << unit)
        unit += shift
    return (total > 0) - (total < 0)


def leading_roots(poly: list[int], trace: int, many: int, digits: int = DIGITS) -> list[tuple[int, int]]:
    """(root * 2**digits, rounded up; how often) of the ``many`` largest roots, the largest first.

    All roots lie in [0, trace].  Roots that differ by less than trace / 2**digits count as one."""
    d = len(poly) - 1
    finest = max(0, digits - trace.bit_length()) if trace else 0  # steps of trace / 2**digits at least
    found: list[tuple[int, int]] = []
    have = 0
    while have < min(many, d):
        low, high, shift = -1, trace, 0  # root number have + 1 is in (low, high] / 2**shift
        above_low, above_high = d, 0
        while above_low - above_high > 1 or above_high != have:
            if high - low <= 1:
                if shift >= finest:
                    break
                low, high, shift = low * 2, high * 2, shift + 1
            middle = (low + high) // 2
            above = roots_above(poly, middle, shift)
            if above > have:
                low, above_low = middle, above
            else:
                high, above_high = middle, above
        times = above_low - have
        at_high = sign_at(poly, high, shift)
        low, high = low << finest - shift, high << finest - shift
        if times == 1 and at_high:  # one simple root: the sign of p tells the side
            while high - low > 1:
                middle = (low + high) // 2
                now = sign_at(poly, middle, finest)
                if now == at_high or now == 0:
                    high = middle
                    if now == 0:
                        break
                else:
                    low = middle
        found.append((high << digits - finest, times))
        have += times
    return found


# --- components -----------------------------------------------------------------------------------

def null_space(matrix: list[list[int]], root: int, many: int, digits: int = DIGITS) -> list[list[float]]:
    """``many`` orthonormal vectors v with (matrix - root / 2**digits) v nearly 0, by inverse iteration.

    Fixed-point numbers, exact to far beyond the last place of a double."""
    d = len(matrix)
    scale = max(1, max(matrix[i][i] for i in range(d)).bit_length())
    work = 2 * digits + scale  # binary digits behind the point
    one = 1 << work
    a = np.array(matrix, object) * one
    a[np.arange(d), np.arange(d)] -= root << work - digits
    # LU with row exchanges; a pivot of 0 becomes the smallest number
    order = np.arange(d)
    for k in range(d):
        best = k + int(np.argmax(np.abs(a[k:, k])))
        if best != k:
            a[[k, best]] = a[[best, k]]
            order[[k, best]] = order[[best, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            a[k + 1:, k] = (a[k + 1:, k] << work) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k][:, None] * a[k, k + 1:][None, :]) >> work
    rng = np.random.default_rng(5)
    vectors = [np.array([int(v) << work - 20 for v in rng.integers(-(1 << 20), 1 << 20, d)], object)
               for _ in range(many)]
    for _ in range(3):
        solved: list[np.ndarray] = []
        for v in vectors:
            y = v[order].copy()
            for k in range(d):
                y[k + 1:] -= (a[k + 1:, k] * y[k]) >> work
            for k in reversed(range(d)):
                y[k] = (y[k] << work) // a[k, k]
                y[:k] -= (a[:k, k] * y[k]) >> work
            for _ in range(2):  # Gram-Schmidt, twice for full accuracy
                size = math.isqrt(int((y * y).sum())) or 1
                y = (y << work) // size
                for u in solved:
                    y = y - ((u * (int((u * y).sum()) >> work)) >> work)
            size = math.isqrt(int((y * y).sum())) or 1
            solved.append((y << work) // size)
        vectors = solved
    return [[float(Fraction(int(v), one)) for v in u] for u in vectors]


@dataclass(frozen=True)
class Whitening:
    """The fit of the vectors of one length; ``scatter`` is n**2 times the covariance."""

    dim: int
    n: int
    sums: list[int]
    trace: int  # of the scatter
    roots: list[float]  # eigenvalues of the scatter, falling
    explained: list[float]
    axes: list[list[float]]

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2, exact; null beyond a long."""
        high = (self.n * int(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, self.sums)) + 2)
        if high * high * self.dim < 1 << 63:
            c = self.n * x - np.array(self.sums, np.int64)
            return (c * c).sum(axis=1).tolist()
        c = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) if v < 1 << 63 else None for v in (c * c).sum(axis=1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(x - S/n) on the axes, over the square roots of the eigenvalues of the covariance."""
        high = self.n * int(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, self.sums)) + 2
        if high < 1 << 53:
            c = (self.n * x - np.array(self.sums, np.int64)).astype(np.float64)
        else:
            c = (x.astype(object) * self.n - np.array(self.sums, object)).astype(np.float64)
        roots = np.array(self.roots)
        with np.errstate(divide="ignore"):
            scale = np.where(roots > 0, 1 / np.sqrt(roots), 0.0)
        return c @ np.array(self.axes).T * scale


def fit(spark: SparkSession, dim: int, n: int, sums: list[int], squares: list[list[int]],
        components: int = COMPONENTS) -> Whitening:
    """The whitening of n distinct vectors with those sums and products."""
    scatter = [[n * squares[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    trace = sum(scatter[i][i] for i in range(dim))
    if trace == 0:  # one distinct vector: every axis will do
        many = min(components, dim)
        return Whitening(dim, n, sums, 0, [0.0] * many, [0.0] * many, np.eye(dim)[:many].tolist())
    poly = characteristic(spark, scatter)
    roots, explained, axes = [], [], []
    for root, times in leading_roots(poly, trace, components):
        for v in null_space(scatter, root, min(times, components - len(roots))):
            axes.append(v)
            exact = Fraction(root, 1 << DIGITS)
            tiny = exact <= Fraction(2 * trace, 1 << DIGITS)  # the root 0, rounded up
            roots.append(0.0 if tiny else float(exact))
            explained.append(0.0 if tiny else float(exact / trace))
    return Whitening(dim, n, sums, trace, roots, explained, axes)


# --- tables ----------------------------------------------------------------------------------------

def fit_list(vectors: DataFrame, column: str, scale: int = SCALE) -> DataFrame:
    """``dim, x``: the distinct whole vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (_, x) in whole(batch.column(0), scale).items():
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(x), pa.int32()),
                                                  pa.array(packed(x), pa.binary())], names=["dim", "x"])

    return vectors.select(column).mapInArrow(run, "dim int, x binary").distinct()


def moments(listed: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """Per length: (n, sums, products) of the fit list.  A task adds up its rows; the sums are put together
    by Spark as pairs of a low and a high part, so that none overflows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                x = unpacked(batch.column("x").filter(pa.array(dims == dim)), dim)
                x1 = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)  # row 0: n and the sums
                held[dim] = held.get(dim, 0) + np.array(products(x1), object)
        for dim, total in held.items():
            i, j = np.triu_indices(dim + 1)
            values = [int(v) for v in total[i, j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([v & ((1 << 60) - 1) for v in values], pa.decimal128(38, 0)),
                 pa.array([v >> 60 for v in values], pa.decimal128(38, 0))],
                names=["dim", "i", "j", "low", "high"])

    parts = listed.mapInArrow(run, "dim int, i int, j int, low decimal(38,0), high decimal(38,0)")
    total = parts.groupBy("dim", "i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    out: dict[int, list] = {}
    for r in total.collect():  # (dim + 1)(dim + 2) / 2 rows per length
        cells = out.setdefault(r.dim, [[0] * (r.dim + 1) for _ in range(r.dim + 1)])
        cells[r.i][r.j] = cells[r.j][r.i] = int(r.low) + (int(r.high) << 60)
    return {dim: (c[0][0], c[0][1:], [row[1:] for row in c[1:]]) for dim, c in out.items()}


def identity_errors(listed: DataFrame, fits: dict[int, Whitening]) -> dict[int, float]:
    """Per length the largest absolute entry of (covariance of the whitened fit list - identity)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                w = fits[dim].whitened(unpacked(batch.column("x").filter(pa.array(dims == dim)), dim))
                w = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                held[dim] = held.get(dim, 0) + w.T @ w
        for dim, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()),
                                              pa.array([total.ravel().tolist()], pa.list_(pa.float64()))],
                                             names=["dim", "total"])

    rows = (listed.mapInArrow(run, "dim int, total array<double>")
            .select("dim", F.posexplode("total").alias("cell", "part"))
            .groupBy("dim", "cell").agg(F.sum("part").alias("part")).collect())  # 25 cells per length
    out = {}
    for dim, f in fits.items():
        k = len(f.roots) + 1
        cells = np.zeros(k * k)
        for r in rows:
            if r.dim == dim:
                cells[r.cell] = r.part
        cells = cells.reshape(k, k) / f.n
        cov = cells[1:, 1:] - np.outer(cells[0, 1:], cells[0, 1:])
        out[dim] = float(np.abs(cov - np.eye(k - 1)).max())
    return out


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``<id_col>, component, n, deviation, whitened, explained, identity_error`` per row and component."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].alias("vec"))
    with scratch(spark):
        listed = written(fit_list(rows, "vec", scale), "whitening")
        fits = {dim: fit(spark, dim, *m, components) for dim, m in moments(listed).items()}
        errors = identity_errors(listed, fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (at, x) in whole(batch.column("vec"), scale).items():
                f, k = fits[dim], len(fits[dim].roots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(np.repeat(at, k))),
                     pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(len(x) * k, f.n), pa.int64()),
                     pa.array([v for v in f.deviation(x) for _ in range(k)], pa.int64()),
                     pa.array(f.whitened(x).ravel()), pa.array(f.explained * len(x)),
                     pa.array([errors[dim]] * (len(x) * k))], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    out = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    return rows.mapInArrow(run, out)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
