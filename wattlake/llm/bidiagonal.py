"""Singular values and right singular vectors of a small triangular matrix.

Householder reflections make it bidiagonal, the differential quotient-difference algorithm with
shifts (dqds; Fernando and Parlett, "Accurate singular values and differential qd algorithms")
finds the squared singular values, small ones as accurately as large ones, and a twisted
factorisation of the shifted matrix gives each vector (Dhillon and Parlett, "Orthogonal
eigenvectors and relative gaps").
"""

from __future__ import annotations

import heapq
import math

import numpy as np

EPS = np.finfo(np.float64).eps
#: An off-diagonal this small, relative to what is left of the diagonal, is zero.
_NEGLIGIBLE = (16 * EPS) ** 2
#: Vectors of values closer than this are made orthogonal to each other.
_CLOSE = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V, with R = U B V^T for an orthogonal U."""
    work = np.array(r, np.float64)
    n = work.shape[1]
    v = np.eye(n)
    for k in range(n):
        mirror = _reflector(work[k:, k])
        if mirror is not None:
            work[k:, k:] -= np.outer(mirror, 2 * (mirror @ work[k:, k:]))
        mirror = _reflector(work[k, k + 1 :])
        if mirror is not None:
            work[k:, k + 1 :] -= np.outer(2 * (work[k:, k + 1 :] @ mirror), mirror)
            v[:, k + 1 :] -= np.outer(2 * (v[:, k + 1 :] @ mirror), mirror)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector whose reflection takes ``x`` to a multiple of its first axis."""
    if len(x) < 2 or not x[1:].any():
        return None
    largest = np.abs(x).max()
    mirror = x / largest
    mirror[0] += math.copysign(np.linalg.norm(mirror), mirror[0])
    return mirror / np.linalg.norm(mirror)


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step: the factors of the shifted matrix, and the d's, which are all positive or
    zero exactly if the shift is not above the smallest value.  It stops at the first negative one."""
    new_q, new_e, ds = [], [], []
    d = q[0] - shift
    for i, off in enumerate(e):
        ds.append(d)
        if d < 0:
            return new_q, new_e, ds
        total = d + off
        new_q.append(total)
        if total == 0.0:
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / total
            new_e.append(off * ratio)
            d = d * ratio - shift
    ds.append(d)
    new_q.append(d)
    return new_q, new_e, ds


def _trailing(q: list[float], e: list[float]) -> float:
    """The smaller value of the last two rows and columns, never below the smallest of all."""
    a, b, c2 = q[-2] + e[-1], q[-1], q[-1] * e[-1]
    half = (a - b) / 2
    return max(0.0, b - c2 / (half + math.copysign(math.sqrt(half * half + c2), half or 1.0)))


def squared_singular_values(diagonal: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, largest first."""
    found: list[float] = []
    pending = [([float(a) ** 2 for a in diagonal], [float(b) ** 2 for b in off], 0.0)]
    while pending:
        q, e, sigma = pending.pop()
        for _ in range(100 * (len(q) + 1)):
            if len(q) < 2:
                found += [max(0.0, x + sigma) for x in q]
                break
            if q[0] * 1.5 < q[-1]:
                # convergence is at the end of the list, where small values should be
                q, e = _turned(q, e)
            plain = _transform(q, e, 0.0)
            cut = next(
                (i for i in range(len(e) - 1, -1, -1) if e[i] <= _NEGLIGIBLE * (sigma + plain[2][i])), None
            )
            if cut is not None:
                pending.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            step, shift = _shifted(q, e, plain)
            q, e, sigma = step[0], step[1], sigma + shift
        else:
            raise ArithmeticError("singular values did not converge")
    return np.array(heapq.nlargest(len(found), found))


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """Factors with the same values whose rows run the other way."""
    return q[::-1], e[::-1]


def _shifted(q: list[float], e: list[float], plain: tuple) -> tuple[tuple, float]:
    """A step with a shift as near below the smallest value as can be had."""
    shift = _trailing(q, e)
    for _ in range(2):
        if shift <= 0:
            break
        step = _transform(q, e, shift)
        if len(step[2]) == len(q) and step[2][-1] >= 0:
            return step, shift
        if len(step[2]) < len(q):
            break
        # only the last d is negative: by so much at most the shift is too large
        shift = (shift + step[2][-1]) * (1 - 4 * EPS)
    if min(plain[2]) > 0:
        # the sum of the inverses bounds every one of them
        shift = (1 - 4 * EPS * len(q)) / sum(1 / d for d in plain[2])
        step = _transform(q, e, shift)
        if len(step[2]) == len(q) and step[2][-1] >= 0:
            return step, shift
    return plain, 0.0


class _Twisted:
    """B^T B - value, factored from both ends and joined at row ``at``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float, tiny: float):
        n = len(a)
        self.down, self.up = np.zeros(n), np.zeros(n)
        self.lower, self.upper = np.zeros(n), np.zeros(n)
        s = np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            self.down[i] = self._pivot(a[i] * a[i] + s[i], tiny)
            self.lower[i] = a[i] * b[i] / self.down[i]
            s[i + 1] = b[i] * b[i] / self.down[i] * s[i] - value
        p = np.zeros(n)
        p[-1] = a[-1] * a[-1] - value
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = self._pivot(b[i] * b[i] + p[i + 1], tiny)
            self.upper[i] = a[i] * b[i] / self.up[i + 1]
            p[i] = a[i] * a[i] / self.up[i + 1] * p[i + 1] - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.middle = self._pivot(gamma[self.at], tiny)

    @staticmethod
    def _pivot(x: float, tiny: float) -> float:
        return x if abs(x) > tiny else math.copysign(tiny, x)

    def vector(self) -> np.ndarray:
        """The solution for a right-hand side that is zero but in row ``at``."""
        z = np.zeros(len(self.down))
        z[self.at] = 1.0
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, y: np.ndarray) -> np.ndarray:
        x, n = np.array(y), len(y)
        for i in range(self.at):
            x[i + 1] -= self.lower[i] * x[i]
        for i in range(n - 2, self.at - 1, -1):
            x[i] -= self.upper[i] * x[i + 1]
        x[: self.at] /= self.down[: self.at]
        x[self.at + 1 :] /= self.up[self.at + 1 :]
        x[self.at] /= self.middle
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.lower[i] * x[i + 1]
        for i in range(self.at, n - 1):
            x[i + 1] -= self.upper[i] * x[i]
        return x


def right_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of a bidiagonal matrix, a column for each squared singular value.

    ``values`` fall.  Vectors of values that lie close together are made orthogonal one after the
    other; one that adds nothing to those before it, as with equal values, is found again by
    inverse iteration from a vector orthogonal to them.
    """
    a, b = np.abs(np.asarray(diagonal, float)), np.abs(np.asarray(off, float))
    signs = np.cumprod(np.concatenate([[1.0], np.where(diagonal[:-1] * off < 0, -1.0, 1.0)]))
    scale = max(float(values[0]), float((a * a).max(initial=0))) if len(values) else 0.0
    tiny = max(scale, np.finfo(float).tiny / EPS) * EPS * EPS
    result = np.zeros((len(a), len(values)))
    start = 0
    pick = np.random.default_rng(1)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > _CLOSE * values[k - 1]:
            start = k
        factors = _Twisted(a, b, float(value), tiny)
        z = factors.vector()
        before = result[:, start:k]
        left = _orthogonal(z, before)
        tries = 0
        while np.linalg.norm(left) < 0.5:
            tries += 1
            if tries > 50:
                raise ArithmeticError("no further vector for a repeated singular value")
            # a little beside the value, so that the rounding of no vector found already outgrows
            # all others; what is left must be large, or rounding is what is left
            factors = _Twisted(a, b, float(value) * (1 + 8 * tries * EPS), tiny)
            left = _orthogonal(pick.standard_normal(len(a)), before)
            for _ in range(3):
                z = factors.solve(left / np.linalg.norm(left))
                left = _orthogonal(z / np.linalg.norm(z), before)
        result[:, k] = left / np.linalg.norm(left)
    return result * signs[:, None]


def _orthogonal(z: np.ndarray, to: np.ndarray) -> np.ndarray:
    for _ in range(2 if to.shape[1] else 0):
        z = z - to @ (to.T @ z)
    return z


def right_singular(r: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of ``r``, falling, and its right singular vectors as columns.

    ``most`` of them at most, and only those that rounding alone cannot make.
    """
    scale = float(np.abs(r).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    diagonal, off, v = bidiagonalise(r / scale)
    squares = squared_singular_values(diagonal, off)
    squares = squares[np.sqrt(squares) > len(diagonal) * EPS * math.sqrt(squares[0])][:most]
    return scale * np.sqrt(squares), v @ right_vectors(diagonal, off, squares)
