"""The small solver against dense ones that share nothing with it."""

import numpy as np
import pytest

from wattlake.llm.bidiagonal import bidiagonalise, right_singular, squared_singular_values


def spectra():
    pick = np.random.default_rng(5)
    turn = np.linalg.qr(pick.normal(size=(24, 24)))[0]
    frame = np.linalg.qr(pick.normal(size=(90, 24)))[0]

    def with_values(values):
        return frame @ np.diag(values) @ turn

    return {
        "random": pick.normal(size=(90, 24)),
        "falling": pick.normal(size=(90, 24)) * np.logspace(0, -8, 24),
        "rising": pick.normal(size=(90, 24)) * np.logspace(-8, 0, 24),
        "identity": np.eye(24),
        "equal": with_values(np.full(24, 3.0)),
        "groups": with_values([5.0] * 8 + [2.0] * 8 + list(np.linspace(1, 1 + 1e-9, 8))),
        "tight": with_values(1 + 1e-5 * np.arange(24)),
        "one row": pick.normal(size=(1, 6)),
        "one column": pick.normal(size=(9, 1)),
        "huge": with_values(np.logspace(150, 140, 24)),
    }


@pytest.mark.parametrize("name", list(spectra()))
def test_singular_values_and_vectors(name):
    rows = spectra()[name]
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((max(0, r.shape[1] - len(r)), r.shape[1]))])
    values, vectors = right_singular(r)
    expected = np.linalg.svd(rows, compute_uv=False)[: len(values)]
    assert np.abs(values - expected).max() < 1e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11
    scaled = r / expected[0]
    assert np.abs(scaled.T @ (scaled @ vectors) - vectors * (values / expected[0]) ** 2).max() < 1e-13


def test_small_values_are_as_exact_as_large_ones():
    diagonal, off = np.logspace(0, -12, 13), np.logspace(-1, -13, 13)[:-1]
    found = np.sqrt(squared_singular_values(diagonal, off))
    # the product of the values is that of the diagonal, which no loss in the small ones leaves
    assert np.prod(found) == pytest.approx(np.prod(diagonal), rel=1e-13)


def test_dependent_columns_leave_fewer_directions():
    pick = np.random.default_rng(2)
    rows = pick.normal(size=(50, 3)) @ pick.normal(size=(3, 10))
    values, vectors = right_singular(np.linalg.qr(rows, mode="r"))
    assert len(values) == 3 and vectors.shape == (10, 3)
    assert len(right_singular(np.linalg.qr(rows, mode="r"), 2)[0]) == 2
    assert right_singular(np.zeros((4, 4)))[1].shape == (4, 0)


def test_householder_keeps_the_matrix():
    r = np.triu(np.random.default_rng(4).normal(size=(12, 12)))
    diagonal, off, v = bidiagonalise(r)
    b = np.diag(diagonal) + np.diag(off, 1)
    assert np.abs(v.T @ v - np.eye(12)).max() < 1e-14
    assert np.abs(v @ b.T @ b @ v.T - r.T @ r).max() < 1e-13
