"""Whitening of vectors by exact eigenvalues.

Vectors become integers. Their scatter matrix is summed in integers, its characteristic polynomial
is found modulo many primes (Hessenberg reduction) and put together by Chinese remaindering, its
roots are isolated and refined with integers, and each component is the null space of the
shifted scatter matrix, by inverse iteration in long fixed-point numbers. Sums, primes and
components are Spark tasks; what the driver holds depends on the width of the vectors alone."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import stored

#: Bits after the point of roots and components, relative to the largest root.
BITS = 192
#: Exact sums leave a task in limbs of this many bits, whose sums fit longs.
LIMB, LIMBS = 40, 5
#: Largest integer entry of a vector; vectors with larger ones have no integer form.
LARGEST = 1 << 61
#: Vectors worked on at a time.
CHUNK = 4096

_KINDS = (np.int8, np.int16, np.int32, np.int64)


# Vectors as integers


def _packed(values: np.ndarray) -> bytes:
    """Integers in the smallest kind that holds them all, whose number comes first."""
    for number, kind in enumerate(_KINDS):
        info = np.iinfo(kind)
        if info.min <= values.min(initial=0) and values.max(initial=0) <= info.max:
            return bytes([number]) + values.astype(kind).tobytes()
    raise OverflowError


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, _KINDS[packed[0]], offset=1).astype(np.int64)


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, width int, x binary): floor(scale * entry) of the vectors that have only finite
    entries, none null, at least one, and products that a long holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, widths = [], []
            for value in batch.column("embedding"):
                x = None
                if value.is_valid and len(value.values) and not value.values.null_count:
                    scaled = np.floor(scale * np.asarray(value.values, np.float64))
                    if np.all(np.abs(scaled) < LARGEST):
                        x = scaled.astype(np.int64)
                packed.append(None if x is None else _packed(x))
                widths.append(0 if x is None else len(x))
            columns = [batch.column("vec_id"), pa.array(widths, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "width", "x"])

    kind = dict(vectors.dtypes)["vec_id"]
    rows = vectors.select("vec_id", "embedding").mapInArrow(work, f"vec_id {kind}, width int, x binary")
    return rows.filter("x IS NOT NULL")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[int], pa.RecordBatch]]:
    """(width, vectors [rows, width], their rows in the batch, the batch)"""
    for batch in batches:
        widths = np.asarray(batch.column("width"))
        packed = batch.column("x")
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            for n in range(0, len(at), CHUNK):
                rows = at[n : n + CHUNK].tolist()
                yield width, np.stack([_unpacked(packed[i].as_py()) for i in rows]), rows, batch


# Exact sums


def _products(x: np.ndarray) -> np.ndarray:
    """x^T x in exact integers."""
    largest = int(np.abs(x).max(initial=0))
    if largest * largest * len(x) < 1 << 52:
        return (x.astype(np.float64).T @ x.astype(np.float64)).astype(np.int64).astype(object)
    if largest * largest * len(x) < 1 << 62:
        return (x.T @ x).astype(object)
    high, low = x >> 20, x & ((1 << 20) - 1)
    if len(x) > 1 and (largest >> 20) >= 1 << 20:
        half = len(x) // 2
        return _products(x[:half]) + _products(x[half:])
    if (largest >> 20) >= 1 << 24:
        x = x.astype(object)
        return x.T @ x
    cross = (high.T @ low).astype(object)
    return ((high.T @ high).astype(object) << 40) + ((cross + cross.T) << 20) + (low.T @ low).astype(object)


def _limbs(value: int) -> list[int]:
    """Parts of LIMB bits, the last one signed and of any size that a long holds."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


@dataclass
class Moments:
    """Of the distinct vectors x of one width: their number, their sums and n * sum(x x^T) - S S^T,
    which is n^2 times the covariance."""

    width: int
    n: int
    sums: list[int]
    scatter: np.ndarray = field(repr=False)


def _moments(distinct: DataFrame) -> list[Moments]:
    """One aggregate over the distinct vectors. Row 0 of the sums are the sums of the entries, row i + 1
    those of the products with entry i from i on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for width, x, _, _ in _chunks(batches):
            sums, products = x.astype(object).sum(axis=0), _products(x)
            if width in held:
                own = held[width]
                own[0], own[1], own[2] = own[0] + len(x), own[1] + sums, own[2] + products
            else:
                held[width] = [len(x), sums, products]
        for width, (n, sums, products) in held.items():
            rows = [sums, *(products[i, i:] for i in range(width))]
            for i, row in enumerate(rows):
                limbs = [_limbs(int(v)) for v in row]
                columns = [[width] * len(row), [i] * len(row), range(len(row)), [n] * len(row), *zip(*limbs, strict=True)]
                kinds = [pa.int32()] * 3 + [pa.int64()] * (1 + LIMBS)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    limbs = [f"l{k}" for k in range(LIMBS)]
    names = ["width", "i", "j", "n", *limbs]
    parts = distinct.select("width", "x").mapInArrow(work, "width int, i int, j int, n long" + "".join(f", {x} long" for x in limbs))
    totals = parts.groupBy("width", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", *limbs)])
    found: dict[int, tuple[list, np.ndarray, int]] = {}
    for width, i, j, n, *values in totals.collect():
        sums, products, _ = found.get(width) or ([0] * width, np.zeros((width, width), object), 0)
        value = sum(v << (LIMB * k) for k, v in enumerate(values))
        if i == 0:
            sums[j] = value
        else:
            products[i - 1, i - 1 + j] = products[i - 1 + j, i - 1] = value
        found[width] = (sums, products, n)
    out = []
    for width, (sums, products, n) in sorted(found.items()):
        s = np.array(sums, object)
        out.append(Moments(width, n, sums, n * products - np.outer(s, s)))
    return out


# The characteristic polynomial


def _is_prime(n: int) -> bool:
    """Of odd n below 2^31, by witnesses that decide all of these."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def _primes(bits: int) -> list[int]:
    """The largest primes below 2^31, together of more than that many bits."""
    out, have, n = [], 0, (1 << 31) - 1
    while have <= bits:
        if _is_prime(n):
            out.append(n)
            have += 30
        n -= 2
    return out


def characteristic_mod(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - a) modulo a prime below 2^31, the constant one first: reduction to
    Hessenberg form by similar matrices, then the recurrence of its leading minors."""
    h, n = a % p, len(a)
    for k in range(n - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    minors = [np.array([1], np.int64)]
    for k in range(n):
        new = np.zeros(k + 2, np.int64)
        new[1:] = minors[k]
        new[: k + 1] -= int(h[k, k]) * minors[k] % p
        along = 1
        for i in range(1, k + 1):
            along = along * int(h[k - i + 1, k - i]) % p
            if along == 0:
                break
            weight = along * int(h[k - i, k]) % p
            new[: k - i + 1] -= weight * minors[k - i] % p
        minors.append(new % p)
    return minors[n].tolist()


def _coefficient_bits(scatter: np.ndarray) -> int:
    """Bits that every coefficient fits in: for a matrix without negative eigenvalues, those of the power
    (1 + largest row sum)^width."""
    largest = max(int(sum(abs(v) for v in row)) for row in scatter)
    return len(scatter) * (largest + 1).bit_length() + 2


def characteristic_polynomial(spark: SparkSession, scatter: np.ndarray) -> list[int]:
    """Integer coefficients of det(x I - scatter), the constant one first. Each task takes some primes."""
    primes = _primes(_coefficient_bits(scatter))
    shared = spark.sparkContext.broadcast(scatter)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        for batch in batches:
            found = [characteristic_mod((matrix % p).astype(np.int64), p) for p in batch.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(found, pa.list_(pa.int64()))], ["p", "c"])

    slots = max(1, min(len(primes) // 4, 4 * spark.sparkContext.defaultParallelism))
    frame = spark.createDataFrame([(p,) for p in primes], "p long").repartition(slots)
    residues = {r.p: r.c for r in frame.mapInArrow(work, "p long, c array<long>").collect()}
    shared.destroy()
    modulus, found = 1, [0] * (len(scatter) + 1)
    for p in primes:
        inverse = pow(modulus, -1, p)
        found = [c + modulus * ((r - c) * inverse % p) for c, r in zip(found, residues[p], strict=True)]
        modulus *= p
    return [c - modulus if 2 * c > modulus else c for c in found]


# Roots. All roots are real and none is negative, so the changes of sign among the coefficients of
# p(x + a) count exactly the roots above a, each as often as it occurs.


def _scaled(poly: list[int], shift: int) -> list[int]:
    """The polynomial whose roots are 2^shift times as large (a power of two times the coefficients)."""
    n = len(poly) - 1
    return [c << (shift * (n - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    c = list(poly)
    n = len(c) - 1
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], x: int, shift: int) -> int:
    """The sign-exact value of poly at x / 2^shift, times a power of two."""
    out = 0
    for k, c in enumerate(reversed(poly)):
        out = out * x + (c << (shift * k))
    return out


def largest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(root * 2^shift rounded down, shift) of the `count` largest positive roots, as often as each occurs.
    Intervals are halved until each holds one root, or several too close to tell apart; then
    a sign of the polynomial finds each further bit."""
    zeros = next(k for k, c in enumerate(poly) if c)
    poly = poly[zeros:]
    degree = len(poly) - 1
    if not degree:
        return []
    top = 0
    while roots_above(poly, 1 << top):
        top += 1
    shift = max(0, bits - top)
    coarse = max(0, top - 64)
    fine = max(0, 48 - top)  # isolation works on integers after this shift
    work = _scaled(poly, fine)
    low_end, high_end = 0, 1 << (top + fine)
    isolated: list[tuple[int, int, int]] = []
    waiting = [(low_end, high_end, degree, 0)]
    while waiting and sum(k for *_, k in isolated) < count:
        low, high, above_low, above_high = waiting.pop()
        if above_low - above_high == 1 or high - low <= 1 << max(0, coarse + fine - 64):
            isolated.append((low, high, above_low - above_high))
            continue
        middle = (low + high) // 2
        above = roots_above(work, middle)
        if above_low > above:
            waiting.append((low, middle, above_low, above))
        if above > above_high:
            waiting.append((middle, high, above, above_high))
    out = []
    for low, high, k in isolated:
        out += [(_refined(poly, low, high, fine, shift, k), shift)] * k
    return out[:count]


def _refined(poly: list[int], low: int, high: int, fine: int, shift: int, k: int) -> int:
    """The root in (low, high] / 2^fine, as an integer over 2^shift."""
    more = max(0, shift - fine)
    low, high, have = low << more, high << more, fine + more
    at_high = _value(poly, high, have)
    if k % 2 == 0 or at_high == 0:
        if at_high == 0 and k == 1:
            return high >> (have - shift)
        scaled = _scaled(poly, have)
        above = roots_above(scaled, high)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(scaled, middle) > above else (low, middle)
        return high >> (have - shift)
    while high - low > 1:
        middle = (low + high) // 2
        value = _value(poly, middle, have)
        if value == 0:
            return middle >> (have - shift)
        low, high = (low, middle) if (value > 0) == (at_high > 0) else (middle, high)
    return high >> (have - shift)


# Components


def null_space(scatter: np.ndarray, root: int, shift: int, size: int, scale: int) -> np.ndarray:
    """`size` orthonormal vectors [size, width] of the null space of scatter - root / 2^shift, in doubles.
    Two steps of inverse iteration in fixed-point numbers of 2 * BITS bits, in units of 2^scale, from
    vectors of no symmetry."""
    n, point = len(scatter), 2 * BITS
    one = 1 << point
    a = np.array([[int(v) << point >> scale for v in row] for row in scatter], object)
    a[np.arange(n), np.arange(n)] -= (root << point) >> (shift + scale)
    order, lower = list(range(n)), np.zeros((n, n), object)
    for k in range(n):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        if pivot != k:
            a[[k, pivot]], lower[[k, pivot]] = a[[pivot, k]], lower[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1  # the smallest number, as inverse iteration divides by it
        for i in range(k + 1, n):
            if a[i, k]:
                factor = (a[i, k] << point) // a[k, k]
                lower[i, k] = factor
                a[i, k:] -= (factor * a[k, k:]) >> point
    rng = np.random.default_rng(11)
    found: list[np.ndarray] = []
    for _ in range(size):
        x = np.array([int(v * (1 << 30)) << (point - 30) for v in rng.uniform(0.5, 1.0, n) * rng.choice([-1, 1], n)], object)
        for _ in range(3):
            for own in found:
                x = x - (own * (int((own * x).sum()) >> point) >> point)
            y = x[order].copy()
            for k in range(n):
                y[k] -= int((lower[k, :k] * y[:k]).sum()) >> point
            for k in range(n - 1, -1, -1):
                y[k] = ((y[k] - (int((a[k, k + 1 :] * y[k + 1 :]).sum()) >> point)) << point) // a[k, k]
            largest = max(abs(v) for v in y)
            x = np.array([(v << point) // largest for v in y], object)
        for own in found:
            x = x - (own * (int((own * x).sum()) >> point) >> point)
        length = _root_of(int((x * x).sum()))
        found.append(np.array([(v << point) // length for v in x], object))
    out = np.array([[float(v) / float(one) if abs(v) < 1 << 1000 else 0.0 for v in x] for x in found])
    signs = np.sign(out[np.arange(size), np.argmax(np.abs(out), axis=1)])
    return out * signs[:, None]


def _root_of(n: int) -> int:
    """The integer square root."""
    x = 1 << ((n.bit_length() + 1) // 2)
    while True:
        y = (x + n // x) // 2
        if y >= x:
            return x
        x = y


@dataclass(frozen=True)
class Whitening:
    """Of the vectors of one width: their number and sums, and the leading components [k, width] with
    their eigenvalues and shares of the trace."""

    width: int
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]

    def project(self, x: np.ndarray) -> np.ndarray:
        centred = self.n * x.astype(object) - np.array(self.sums, object)
        return (centred / self.n).astype(np.float64) @ self.components.T / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2, exact."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if largest * largest * self.width < 1 << 62:
            d = self.n * x - np.array(self.sums)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return (d * d).sum(axis=1).tolist()


def fit_whitening(distinct: DataFrame, n_components: int = 16) -> list[Whitening]:
    """One model per width of the distinct integer vectors (width, x). It has as many components as there
    are positive eigenvalues, `n_components` at most."""
    spark = distinct.sparkSession
    models = []
    for m in _moments(distinct):
        trace = sum(int(m.scatter[i, i]) for i in range(m.width))
        if not trace:
            models.append(Whitening(m.width, m.n, m.sums, np.zeros((0, m.width)), [], []))
            continue
        poly = characteristic_polynomial(spark, m.scatter)
        roots = largest_roots(poly, n_components)
        vectors = _components(spark, m.scatter, roots, trace.bit_length())
        values = [root / (m.n * m.n << shift) for root, shift in roots]
        shares = [root / (trace << shift) for root, shift in roots]
        models.append(Whitening(m.width, m.n, m.sums, vectors, values, shares))
    return models


def _components(spark: SparkSession, scatter: np.ndarray, roots: list[tuple[int, int]], scale: int) -> np.ndarray:
    """One task per different root; equal ones, to half the bits, share a null space."""
    groups: list[list[tuple[int, int]]] = []
    for root in roots:
        if groups and groups[-1][0][0] - root[0] <= groups[-1][0][0] >> (BITS // 2):
            groups[-1].append(root)
        else:
            groups.append([root])
    shared = spark.sparkContext.broadcast(scatter)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, root, shift, size in zip(*(batch.column(c).to_pylist() for c in ("g", "root", "shift", "size")), strict=True):
                found = null_space(shared.value, int(root), shift, size, scale)
                yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([found.tobytes()], pa.binary())], ["g", "v"])

    rows = [(g, str(own[0][0]), own[0][1], len(own)) for g, own in enumerate(groups)]
    frame = spark.createDataFrame(rows, "g long, root string, shift int, size int").repartition(len(rows), "g")
    found = {r.g: np.frombuffer(bytes(r.v)).reshape(-1, len(scatter)) for r in frame.mapInArrow(work, "g long, v binary").collect()}
    shared.destroy()
    return np.concatenate([found[g] for g in range(len(groups))])


def identity_errors(distinct: DataFrame, models: list[Whitening]) -> dict[int, float]:
    """By width, the largest absolute entry of the covariance of the whitened distinct vectors minus the
    identity. Tasks give means and centred products, which are put together pairwise."""
    by_width = {m.width: m for m in models if m.eigenvalues}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for width, x, _, _ in _chunks(batches):
            if width in by_width:
                w = by_width[width].project(x)
                own = (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)))
                held[width] = _joined(held[width], own) if width in held else own
        for width, (n, mean, products) in held.items():
            row = [[width], [n], [mean.tobytes()], [products.tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["width", "n", "mean", "products"])

    # One small row per task: they are put together by the driver as they come.
    totals: dict[int, tuple] = {}
    for r in distinct.mapInArrow(work, "width int, n long, mean binary, products binary").toLocalIterator():
        k = len(by_width[r.width].eigenvalues)
        own = (r.n, np.frombuffer(bytes(r.mean)), np.frombuffer(bytes(r.products)).reshape(k, k))
        totals[r.width] = _joined(totals[r.width], own) if r.width in totals else own
    return {w: float(np.abs(p / n - np.eye(len(p))).max()) for w, (n, _, p) in totals.items()}


def _joined(a: tuple, b: tuple) -> tuple:
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def whiten(vectors: DataFrame, n_components: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """Whitens vectors (vec_id, embedding): one row each (vec_id, width int, n long, deviation decimal,
    whitened, explained, eigenvalues array<double>, identity_error double).

    Entries become x = floor(scale * entry) + offset. The fit takes each distinct x vector once: n of
    them, and components by falling eigenvalue of their covariance (divisor n), each with its
    largest entry positive. `deviation` is the exact sum of (n * x - S)^2, S being the sums of the
    fit; null where it has more than 38 digits. Nothing depends on the offset.

    Vectors that are null, empty, or hold null or non-finite entries (or such as a long cannot
    hold scaled) are left out. Vectors of another width are a fit of their own. Components of
    variance zero are left out, so vectors that are all equal get empty arrays and a null error. Equal
    eigenvalues share their space. Repeated rows and null ids are whitened like others; other
    columns are not read."""
    rows = integer_vectors(vectors, scale)
    distinct = stored(rows.select("width", "x").distinct(), "vectors")
    models = fit_whitening(distinct, n_components)
    errors = identity_errors(distinct, models)
    by_width = {m.width: m for m in models}
    kind = dict(vectors.dtypes)["vec_id"]
    double = pa.list_(pa.float64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, x, at, batch in _chunks(batches):
            model = by_width[width]
            size = len(at)
            exact = [str(d) if d < 10**38 else None for d in model.deviations(x)]
            projected = model.project(x) if model.eigenvalues else np.zeros((size, 0))
            columns = [
                batch.column("vec_id").take(pa.array(at)),
                pa.array([width] * size, pa.int32()),
                pa.array([model.n] * size, pa.int64()),
                pa.array(exact, pa.string()),
                pa.array(list(projected), double),
                pa.array([model.explained] * size, double),
                pa.array([model.eigenvalues] * size, double),
                pa.array([errors.get(width)] * size, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, OUT)

    schema = f"vec_id {kind}, width int, n long, deviation string, whitened array<double>, explained array<double>, eigenvalues array<double>, identity_error double"
    return rows.mapInArrow(work, schema).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


OUT = ["vec_id", "width", "n", "deviation", "whitened", "explained", "eigenvalues", "identity_error"]
