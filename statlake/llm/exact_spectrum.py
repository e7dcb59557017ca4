"""Exact spectrum of an integer matrix: characteristic polynomial by modular
Hessenberg reduction and Chinese remaindering, real roots isolated by exact
sign counts, eigenvectors by inverse iteration in fixed-point integers.

Everything here works on one small matrix (a side per dimension) and on Python
integers, so nothing is rounded before the last step.  The matrix is symmetric
and positive semidefinite, hence all roots are real and none is negative; then
the number of sign changes in the coefficients of p(t + a) *is* the number of
roots above a, with their multiplicity (Budan and Fourier).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Primes lie just below this, so a product of two residues fits a signed long.
PRIME_TOP = 1 << 31
#: Bits by which a root is known beyond its distance to the next ones.
EXTRA_BITS = 72
#: Fraction bits of the fixed-point elimination.
FRACTION_BITS = 144


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every n below 3.2e9."""
    if n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        if a % n == 0:
            continue
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


def primes_for(bits: int) -> list[int]:
    """Primes below ``PRIME_TOP`` whose product has more than ``bits`` bits."""
    out, product, n = [], 1, PRIME_TOP - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bits(trace: int, size: int) -> int:
    """Bits of the largest coefficient: by Maclaurin's inequality the k-th
    symmetric sum of non-negative roots is at most C(size, k) (trace / size)^k."""
    most = max(math.comb(size, k) * trace ** k // size ** k for k in range(size + 1))
    return most.bit_length() + 1


def charpoly_mod(matrix: list[list[int]], p: int) -> list[int]:
    """det(tI - A) modulo ``p``, coefficients from t**0 up, by reduction to
    Hessenberg form with similarity transforms over the field."""
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    n = len(h)
    for j in range(n - 2):
        below = np.flatnonzero(h[j + 1:, j])
        if not len(below):
            continue
        i = j + 1 + int(below[0])
        if i != j + 1:
            h[[i, j + 1], :] = h[[j + 1, i], :]
            h[:, [i, j + 1]] = h[:, [j + 1, i]]
        factor = h[j + 2:, j] * pow(int(h[j + 1, j]), p - 2, p) % p
        h[j + 2:, :] = (h[j + 2:, :] - factor[:, None] * h[j + 1, :][None, :]) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2:] * factor[None, :] % p).sum(1)) % p
    polys = [np.array([1], np.int64)]
    for k in range(1, n + 1):
        new = np.zeros(k + 1, np.int64)
        new[1:] = polys[k - 1]
        new[:k] = (new[:k] - h[k - 1, k - 1] * polys[k - 1]) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            new[:i] = (new[:i] - int(h[i - 1, k - 1]) * below % p * polys[i - 1]) % p
        polys.append(new)
    return polys[n].tolist()


def combine(residues: dict[int, list[int]]) -> list[int]:
    """Signed integers with the given residues (prime -> one list of residues)."""
    product = math.prod(residues)
    parts = [(product // p * pow(product // p, -1, p), row) for p, row in residues.items()]
    width = len(next(iter(residues.values())))
    out = [sum(unit * row[k] for unit, row in parts) % product for k in range(width)]
    return [x - product if 2 * x > product else x for x in out]


# ------------------------------------------------------------------- roots

def _derivative(c: list[int]) -> list[int]:
    return [k * x for k, x in enumerate(c)][1:]


def _primitive(c: list[int]) -> list[int]:
    while c and c[-1] == 0:
        c = c[:-1]
    g = math.gcd(*c) if c else 0
    return [x // g for x in c] if g > 1 else c


def _gcd_degree_mod(a: list[int], b: list[int], p: int) -> int:
    """Degree of the greatest common divisor modulo p (never below the true one
    unless p divides a leading coefficient)."""
    a, b = [x % p for x in a], [x % p for x in b]
    while True:
        while b and b[-1] == 0:
            b = b[:-1]
        if not b:
            return len(a) - 1
        inverse = pow(b[-1], -1, p)
        while len(a) >= len(b):
            f, shift = a[-1] * inverse % p, len(a) - len(b)
            a = [(x - f * b[i - shift]) % p if i >= shift else x for i, x in enumerate(a)][:-1]
        a, b = b, a


def _remainder(a: list[int], b: list[int]) -> list[int]:
    """A multiple of the remainder of a by b, content removed."""
    a = list(a)
    while len(a) >= len(b):
        lead, shift = a[-1], len(a) - len(b)
        a = [x * b[-1] - (lead * b[i - shift] if i >= shift else 0) for i, x in enumerate(a)][:-1]
        a = _primitive(a)
        if not a:
            break
    return a


def squarefree(c: list[int]) -> list[int]:
    """The polynomial with the same roots, each once."""
    d = _derivative(c)
    if len(c) <= 2 or _gcd_degree_mod(c, d, primes_for(1)[0]) == 0:
        return c
    a, b = _primitive(c), _primitive(d)
    while b:
        a, b = b, _remainder(a, b)
    if len(a) == 1:
        return c
    if a[-1] < 0:
        a = [-x for x in a]
    rest, out = [x * a[-1] ** len(c) for x in c], []
    while len(rest) >= len(a):   # exact after scaling by powers of the divisor's first coefficient
        f, shift = rest[-1] // a[-1], len(rest) - len(a)
        out.append(f)
        rest = [x - f * a[i - shift] if i >= shift else x for i, x in enumerate(rest)][:-1]
    return _primitive(out[::-1])


def roots_above(c: list[int], a: int, s: int) -> int:
    """Roots greater than a / 2**s of a polynomial whose roots are all real."""
    n = len(c) - 1
    g = [x << s * (n - k) for k, x in enumerate(c)]
    for i in range(n):
        for k in range(n - 1, i - 1, -1):
            g[k] += a * g[k + 1]
    signs = [x > 0 for x in g if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _positive(c: list[int], a: int, s: int) -> int:
    """Sign of the polynomial at a / 2**s."""
    n, value = len(c) - 1, 0
    for k in range(n, -1, -1):
        value = value * a + (c[k] << s * (n - k))
    return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Root:
    """One root in (low, high] / 2**scale, how often it occurs, and a lower
    bound gap / 2**scale of its distance to every other root."""

    low: int
    high: int
    scale: int
    times: int
    gap: int


def _halve(c: list[int], low: int, high: int, s: int) -> tuple[int, int, int]:
    """Half of an interval that holds one root of the squarefree ``c``."""
    if high - low == 1:
        low, high, s = 2 * low, 2 * high, s + 1
    mid = (low + high) // 2
    at, end = _positive(c, mid, s), _positive(c, high, s)
    if end == 0:                 # the root is the upper end
        return mid, high, s
    return (low, mid, s) if at in (0, end) else (mid, high, s)


def isolate(coefficients: list[int], most: int) -> tuple[list[Root], list[int]]:
    """The ``most`` largest positive roots, largest first and counted with
    multiplicity, and the squarefree polynomial they belong to."""
    c = list(coefficients)
    while len(c) > 1 and c[0] == 0:
        c = c[1:]
    if len(c) == 1:
        return [], c
    once = squarefree(c)
    if once[-1] < 0:
        once = [-x for x in once]
    top = -c[-2] + 1                       # the sum of all roots, plus one
    found: list[list[int]] = []            # [low, high, scale, times]
    todo = [(0, top, 0, roots_above(once, 0, 0), 0)]
    taken = 0
    while todo and taken <= most:          # one root more than wanted, for its distance
        low, high, s, above_low, above_high = todo.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            times = roots_above(c, low, s) - roots_above(c, high, s) if len(once) < len(c) else 1
            found.append([low, high, s, times])
            taken += times
            continue
        if high - low == 1:
            low, high, s = 2 * low, 2 * high, s + 1
        mid = (low + high) // 2
        above = roots_above(once, mid, s)
        todo.append((low, mid, s, above_low, above))
        todo.append((mid, high, s, above, above_high))
    # refine until no interval is wider than its distance to the next one
    while True:
        scale = max([s for *_, s, _ in found], default=0)
        ends = [(lo << scale - s, hi << scale - s) for lo, hi, s, _ in found]
        below = [hi for _, hi in ends[1:]] + [0]              # zero counts as a root: it may be one
        above = [math.inf] + [lo for lo, _ in ends[:-1]]
        gaps = [min(lo - below[i], above[i] - hi) for i, (lo, hi) in enumerate(ends)]
        wide = [i for i, (lo, hi) in enumerate(ends) if hi - lo > gaps[i]]
        if not wide:
            break
        for i in sorted({j for i in wide for j in (i - 1, i, i + 1) if 0 <= j < len(found)}):
            found[i][:3] = _halve(once, *found[i][:3])
    out, taken = [], 0
    for (lo, hi, s, times), gap in zip(found, gaps):
        if taken >= most:
            break
        out.append(Root(lo << scale - s, hi << scale - s, scale, times, gap))
        taken += times
    return out, once


def refine(c: list[int], root: Root) -> tuple[int, int]:
    """(a, s): a / 2**s is within gap / 2**EXTRA_BITS of the root."""
    low, high, s = root.low, root.high, root.scale
    while (high - low) << EXTRA_BITS > root.gap << s - root.scale:
        if _positive(c, high, s) == 0:
            return high, s
        low, high, s = _halve(c, low, high, s)
    return low + high, s + 1


# ------------------------------------------------------------- eigenvectors

def null_vectors(matrix: list[list[int]], a: int, s: int, gap_bits: int, times: int) -> list[list[float]]:
    """``times`` orthonormal vectors of the null space of A - (a / 2**s) I, the
    shift being a root to ``EXTRA_BITS`` beyond the distance to the others:
    inverse iteration with a fixed-point LU, rounded to doubles at the end.

    ``gap_bits``: log2 of that distance; more fraction bits where it is below one.
    """
    n = len(matrix)
    f = FRACTION_BITS + max(0, -gap_bits)
    shift = a << f - s if f >= s else a >> s - f
    u = np.array([[x << f for x in row] for row in matrix], dtype=object)
    for i in range(n):
        u[i, i] -= shift
    order, factors = np.arange(n), []
    for k in range(n):
        i = k + max(range(n - k), key=lambda r: abs(u[k + r, k]))
        if i != k:
            u[[i, k], :] = u[[k, i], :]
            order[[i, k]] = order[[k, i]]
            for column in factors:
                column[i], column[k] = column[k], column[i]
        if u[k, k] == 0:
            u[k, k] = 1
        column = np.zeros(n, dtype=object)
        if k + 1 < n:
            column[k + 1:] = (u[k + 1:, k] << f) // u[k, k]
            u[k + 1:, k:] = u[k + 1:, k:] - ((column[k + 1:, None] * u[k, k:][None, :]) >> f)
            u[k + 1:, k] = 0
        factors.append(column)

    def solve(b):
        x = b[order].copy()
        for k in range(n - 1):
            x[k + 1:] = x[k + 1:] - ((factors[k][k + 1:] * x[k]) >> f)
        for k in range(n - 1, -1, -1):
            rest = int((u[k, k + 1:] * x[k + 1:]).sum() >> f) if k + 1 < n else 0
            x[k] = ((int(x[k]) - rest) << f) // u[k, k]
        return x

    def scaled(x):
        """Largest entry near 2**f."""
        bits = max(abs(int(v)) for v in x).bit_length() - f
        return np.array([int(v) >> bits if bits > 0 else int(v) << -bits for v in x], dtype=object)

    def without(x, others):
        for v, norm in others:
            x = np.array([xi - int(dot_) * int(vi) // norm for xi, vi, dot_ in
                          zip(x, v, [int((x * v).sum())] * n)], dtype=object)
        return x

    rng = np.random.default_rng(len(matrix))
    found: list[tuple] = []
    for _ in range(times):
        x = np.array([int(v) << f - 20 for v in rng.integers(1, 1 << 20, n) * rng.choice([-1, 1], n)], dtype=object)
        for _ in range(3):
            x = scaled(without(scaled(solve(scaled(without(x, found)))), found))
        found.append((x, int((x * x).sum())))
    out = []
    for x, norm in found:
        length = math.isqrt(norm)
        v = [int(xi) / length for xi in x]
        lead = max(range(n), key=lambda i: (abs(v[i]), -i))
        out.append([-w for w in v] if v[lead] < 0 else v)
    return out
