"""Eigenvalues and eigenvectors of an exact integer matrix, such as a scatter matrix.

The characteristic polynomial is computed modulo many primes by Hessenberg reduction and put
together by the Chinese remainder theorem. Its roots are isolated and narrowed with integers
only. Vectors follow by inverse iteration with fixed-point numbers of several hundred bits. All
of it depends on the size of the matrix, never on the number of rows that it sums up.
"""

from __future__ import annotations

from math import comb, isqrt

import numpy as np

#: Moduli are primes below this, so that products of two residues fit 64 bits.
PRIMES_BELOW = 1 << 31
#: A root is narrowed to this many bits of its own size.
ROOT_BITS = 160
#: Bits after the point of the vectors' arithmetic, and steps of inverse iteration.
VECTOR_BITS, STEPS = 512, 4


def _is_prime(n: int) -> bool:
    """Exact below 2 ** 32 (Miller-Rabin with bases that are known to suffice there)."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes whose product has more than so many bits."""
    found, product, n = [], 1, PRIMES_BELOW - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def _inverses(values: np.ndarray, moduli: np.ndarray) -> np.ndarray:
    return np.array([pow(int(v), -1, int(p)) if v else 0 for v, p in zip(values, moduli, strict=True)], np.int64)


def _hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """``a`` (modulus, row, column) brought to upper Hessenberg form by similarity, for each
    modulus by itself."""
    size = a.shape[1]
    rows, cells = p[:, None], p[:, None, None]
    for k in range(size - 2):
        below = a[:, k + 1 :, k] != 0
        first = np.where(below.any(axis=1), below.argmax(axis=1), 0) + k + 1
        for m in np.flatnonzero(first != k + 1):
            a[m, [k + 1, first[m]]] = a[m, [first[m], k + 1]]
            a[m][:, [k + 1, first[m]]] = a[m][:, [first[m], k + 1]]
        factors = a[:, k + 2 :, k] * _inverses(a[:, k + 1, k], p)[:, None] % rows
        a[:, k + 2 :] = (a[:, k + 2 :] - factors[:, :, None] * a[:, None, k + 1] % cells) % cells
        moved = (a[:, :, k + 2 :] * factors[:, None, :] % cells).sum(axis=2)
        a[:, :, k + 1] = (a[:, :, k + 1] + moved) % rows
    return a


def _hessenberg_polynomials(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients from the constant up, modulo each modulus, of ``det(x - h)``."""
    size, rows = h.shape[1], p[:, None]
    known = [np.zeros((len(p), size + 1), np.int64)]
    known[0][:, 0] = 1
    for k in range(size):
        following = np.roll(known[k], 1, axis=1)
        following = (following - h[:, k, k, None] * known[k] % rows) % rows
        product = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            product = product * h[:, i + 1, i] % p
            following = (following - (h[:, i, k] * product % p)[:, None] * known[i] % rows) % rows
        known.append(following)
    return known[size]


def characteristic_polynomial(matrix: list[list[int]]) -> list[int]:
    """The exact coefficients of ``det(x - matrix)``, from the constant up.

    So many moduli are taken that their product exceeds twice any possible coefficient: the
    one of ``x ** (size - k)`` is a sum of ``comb(size, k)`` products of ``k`` eigenvalues, and none
    of these exceeds the largest sum of a row's absolute values.
    """
    size = len(matrix)
    radius = max((sum(map(abs, row)) for row in matrix), default=0) or 1
    bound = max(comb(size, k) * radius**k for k in range(size + 1))
    moduli = primes(bound.bit_length() + 2)
    p = np.array(moduli, np.int64)
    residues = np.array([[[x % m for x in row] for row in matrix] for m in moduli], np.int64).reshape(len(moduli), size, size)
    found = _hessenberg_polynomials(_hessenberg(residues, p), p)
    product, sums = 1, [0] * (size + 1)
    for m in moduli:
        product *= m
    for k, m in enumerate(moduli):
        rest = product // m
        unit = rest * pow(rest, -1, m)
        sums = [s + int(r) * unit for s, r in zip(sums, found[k], strict=True)]
    sums = [s % product for s in sums]
    return [s - product if 2 * s > product else s for s in sums]


def _shifted(coefficients: list[int], by: int) -> list[int]:
    """Coefficients of ``p(x + by)``."""
    out = list(coefficients)
    for start in range(len(out) - 1):
        for k in range(len(out) - 2, start - 1, -1):
            out[k] += by * out[k + 1]
    return out


def _above(coefficients: list[int], point: int) -> int:
    """Roots above ``point``, each as often as it counts. All roots are real, and then the number
    of sign changes is exactly the number of positive roots (Descartes)."""
    signs = [c > 0 for c in _shifted(coefficients, point) if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(coefficients: list[int], point: int) -> int:
    out = 0
    for c in reversed(coefficients):
        out = out * point + c
    return out


def _scaled(coefficients: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are those of the given one times ``2 ** bits``."""
    size = len(coefficients) - 1
    return [c << bits * (size - k) for k, c in enumerate(coefficients)]


def largest_roots(coefficients: list[int], count: int, bits: int = ROOT_BITS) -> list[tuple[int, int, int]]:
    """The ``count`` largest positive roots of a polynomial whose roots are all real, none of them negative, falling, as
    ``(low, multiplicity, scale)``: a root lies in ``(low, low + 1] / 2 ** scale``, where ``low`` has
    about ``bits`` bits, and so many roots share that interval. The last one may exceed ``count``."""
    positive = _above(coefficients, 0)
    # No root exceeds their sum.
    top = 1 << abs(coefficients[-2]).bit_length()
    out, taken = [], 0
    whole = [(0, top, 0, positive, 0)]
    while whole and taken < count:
        low, high, more, inside, scale = whole.pop()
        narrow = high - low == 1
        if narrow and low.bit_length() >= bits:
            out.append((low, inside, scale))
            taken += inside
            continue
        if narrow:
            # As many further bits as a root of this size still lacks, or a few if near zero.
            extra = max(16, bits - low.bit_length())
            low, high, scale = low << extra, high << extra, scale + extra
        q = _scaled(coefficients, scale)
        if inside == 1:
            # A single root is bracketed by a change of sign, or the upper end is the root.
            sign = _value(q, high) or None
            while high - low > 1:
                middle = (low + high) // 2
                value = _value(q, middle)
                inside_upper = (value > 0) != (sign > 0) and value != 0 if sign else value != 0 and _above(q, middle) > more
                low, high = (middle, high) if inside_upper else (low, middle)
            whole.append((low, high, more, 1, scale))
            continue
        middle = (low + high) // 2
        upper = _above(q, middle) - more
        if inside - upper:
            whole.append((low, middle, more + upper, inside - upper, scale))
        if upper:
            whole.append((middle, high, more, upper, scale))
    return out


def _fixed_solve(matrix: list[list[int]], vectors: list[np.ndarray], scale: int, root: int) -> list[np.ndarray]:
    """Inverse iteration for ``matrix - root / 2 ** scale`` in fixed point; vectors have length 1
    (``2 ** VECTOR_BITS``). Equal roots get orthogonal vectors."""
    one, size = VECTOR_BITS, len(matrix)
    norm = max(max(abs(x) for x in row) for row in matrix).bit_length()
    shift = one - norm
    move = lambda x, by: x << by if by >= 0 else x >> -by
    a = np.array([[move(x, shift) for x in row] for row in matrix], object)
    for k in range(size):
        a[k, k] -= move(root, shift - scale)
    order, steps = list(range(size)), []
    for k in range(size):
        best = max(range(k, size), key=lambda r: abs(a[r, k]))
        a[[k, best]] = a[[best, k]]
        order[k], order[best] = order[best], order[k]
        pivot = a[k, k] = a[k, k] or 1
        factors = (a[k + 1 :, k] << one) // pivot
        a[k + 1 :, k + 1 :] -= (factors[:, None] * a[None, k, k + 1 :]) >> one
        steps.append(factors)
    for _ in range(STEPS):
        solved = []
        for vector in vectors:
            b = vector[order]
            for k in range(size):
                b[k + 1 :] -= (steps[k] * b[k]) >> one
            x = np.zeros(size, object)
            for k in range(size - 1, -1, -1):
                x[k] = ((b[k] - (int((a[k, k + 1 :] * x[k + 1 :]).sum() if k + 1 < size else 0) >> one)) << one) // a[k, k]
            for other in solved:
                x = x - (other * ((other * x).sum() >> one) >> one)
            solved.append((x << one) // (isqrt(int((x * x).sum())) or 1))
        vectors = solved
    return vectors


def components_of(matrix: list[list[int]], count: int) -> list[tuple[float, np.ndarray]]:
    """The ``count`` largest positive eigenvalues of a symmetric integer matrix without negative
    ones, falling, with unit eigenvectors, both correct as doubles. Fewer if fewer are positive.
    The largest entry of a vector is positive."""
    if not matrix or not any(any(row) for row in matrix):
        return []
    size, out = len(matrix), []
    for low, times, scale in largest_roots(characteristic_polynomial(matrix), count):
        starts = []
        for t in range(times):
            # Any start will do that has a part of the vector sought; these are never alike.
            start = np.array([((k * k + 3 * k + 7) * (t + 2) * 2654435761) % 1009 + (k % times == t) * 2000 + 1 for k in range(size)], object)
            starts.append((start << VECTOR_BITS) // isqrt(int((start * start).sum())))
        for vector in _fixed_solve(matrix, starts, scale, low):
            unit = np.array([float(int(x)) for x in (vector >> VECTOR_BITS - 200)]) * 2.0**-200
            unit = unit * np.sign(unit[np.argmax(np.abs(unit))])
            out.append((low / (1 << scale), unit))
    return out[:count]

