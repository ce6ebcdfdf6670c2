"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, bisection on Sturm
counts, inverse iteration with reorthogonalisation of clusters.

The matrix is d x d for d vector components, whatever the number of vectors."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
CLUSTER = 1e-3    # eigenvalues closer than this share of the norm are made orthogonal to each other
STEPS = 6         # solves of one inverse iteration


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, unit reflectors) of Q' A Q with Q the product of the reflections."""
    a = np.array(matrix, dtype=float)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        v = np.zeros(d)
        v[k + 1:] = a[k + 1:, k]
        length = np.linalg.norm(v)
        if length > 0.0:
            v[k + 1] += length if v[k + 1] >= 0 else -length
            v /= np.linalg.norm(v)
            p = a @ v
            w = p - (v @ p) * v
            a -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every value of ``at`` the number of eigenvalues below it: negative pivots of T - at."""
    least = max(float((off * off).max(initial=0.0)), 1.0) * np.finfo(float).tiny
    count, pivot = np.zeros(len(at), dtype=int), np.ones(len(at))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` largest eigenvalues, falling, each bisected to the last bits."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low = np.full(many, float((diagonal - reach).min()))
    high = np.full(many, float((diagonal + reach).max()))
    spread = max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - 2 * EPS * spread, high + 2 * EPS * spread
    wanted = d - np.arange(many)  # the j-th largest has d - j values at or below it
    for _ in range(120):
        middle = low + (high - low) / 2
        below = sturm_counts(diagonal, off, middle) >= wanted
        high, low = np.where(below, middle, high), np.where(below, low, middle)
        if np.all(high - low <= EPS * np.maximum(np.abs(low), np.abs(high))):
            break
    return low + (high - low) / 2


def factor(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """Row-pivoted elimination of T - shift: (steps, pivots, first and second upper diagonals)."""
    d = len(diagonal)
    pivot, upper, second = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    steps = []
    for i in range(d - 1):
        below, right = off[i], upper[i + 1]
        swap = abs(below) > abs(pivot[i])
        if swap:
            rate = pivot[i] / below
            pivot[i], upper[i], pivot[i + 1], second[i], upper[i + 1] = (
                below, pivot[i + 1], upper[i] - rate * pivot[i + 1], right, -rate * right)
        else:
            if abs(pivot[i]) < least:
                pivot[i] = least
            rate = below / pivot[i]
            pivot[i + 1] -= rate * upper[i]
        steps.append((swap, rate))
    if abs(pivot[-1]) < least:
        pivot[-1] = least
    return steps, pivot, upper, second


def solve(factors, right: np.ndarray) -> np.ndarray:
    steps, pivot, upper, second = factors
    x, d = right.copy(), len(right)
    for i, (swap, rate) in enumerate(steps):
        if swap:
            x[i], x[i + 1] = x[i + 1], x[i] - rate * x[i + 1]
        else:
            x[i + 1] -= rate * x[i]
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            x[i] -= upper[i] * x[i + 1]
        if i + 2 < d:
            x[i] -= second[i] * x[i + 2]
        x[i] /= pivot[i]
        if abs(x[i]) > 1e150:  # only the direction counts
            x /= abs(x[i])
    return x


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one row per value (falling)."""
    d = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    least, random = EPS * norm, np.random.default_rng(0)
    out, first, shift = np.zeros((len(values), d)), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # equal values get shifts that differ, so their solves do not repeat one vector
        shift = min(value, shift - 4 * EPS * norm) if j > first else value
        factors = factor(diagonal, off, shift, least)
        x = random.standard_normal(d)
        for _ in range(STEPS):
            x = solve(factors, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[first:j].T @ (out[first:j] @ x)
            if np.linalg.norm(x) < 1e-6:  # the cluster held the whole direction: begin anew
                x = random.standard_normal(d)
        out[j] = x / np.linalg.norm(x)
    return out


def leading_eigenpairs(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, falling; unit vectors as rows, largest entry positive) of a symmetric matrix."""
    d = len(matrix)
    many = min(many, d)
    if many == 0 or not np.any(matrix):
        return np.zeros(many), np.eye(many, d)
    diagonal, off, reflectors = tridiagonal(matrix)
    vectors = vectors_of(diagonal, off, leading_values(diagonal, off, many))
    for v in reversed(reflectors):
        vectors -= 2.0 * np.outer(vectors @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    values = np.einsum("ij,jk,ik->i", vectors, matrix, vectors)  # Rayleigh quotients: second order in the vectors' error
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[order]
    largest = vectors[np.arange(many), np.abs(vectors).argmax(axis=1)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]
