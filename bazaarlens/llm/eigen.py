"""Leading eigenvectors of a symmetric matrix that is known by its products only (Jacobi-Davidson)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Residuals, against the greatest eigenvalue, at which a vector counts as exact in double precision.
TOLERANCE = 512 * np.finfo(float).eps
#: Ritz vectors that are kept beside the wanted ones, basis vectors per wanted one before a restart, steps of the inner solver, outer rounds.
GUARD, WIDEST, INNER, MOST_ROUNDS = 8, 4, 8, 200
#: An inner solution is good enough once its residual has fallen by this.
INNER_FALL = 0.05

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Basis of what ``new`` adds to the ``others``, which are orthonormal."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        for other in others:
            new = new - other @ (other.T @ new)
        kept = np.linalg.norm(new, axis=0) > 1e-12
        new = new[:, kept]
        if not new.shape[1]:
            return new
        q, r = np.linalg.qr(new)
        new = q[:, np.abs(np.diag(r)) > 1e-12 * np.abs(np.diag(r)).max()]
    return new


def _minres(product: Product, shifts: np.ndarray, right: np.ndarray, without: np.ndarray) -> np.ndarray:
    """Approximate solutions of P (A - shift) P t = right for every column; P leaves out the span of ``without``.

    Minimal residuals over Lanczos vectors. All columns take each step together, so that it costs one product.
    """
    project = lambda x: x - without @ (without.T @ x)
    k = right.shape[1]
    start = project(right)
    norm = np.linalg.norm(start, axis=0)
    safe = lambda x: np.where(x > 0, x, 1.0)
    vectors, before = [start / safe(norm)], np.zeros_like(start)
    bands = np.zeros((k, INNER + 1, INNER))
    beta = np.zeros(k)
    solved = np.zeros((INNER, k))
    for step in range(INNER):
        image = project(product(vectors[step])) - vectors[step] * shifts
        alpha = np.einsum("dk,dk->k", vectors[step], image)
        image = project(image - vectors[step] * alpha - before * beta)
        before = vectors[step]
        if step:
            bands[:, step - 1, step] = beta
        bands[:, step, step] = alpha
        beta = np.linalg.norm(image, axis=0)
        bands[:, step + 1, step] = beta
        vectors.append(image / safe(beta))
        left = np.zeros(k)
        for c in range(k):
            target = np.zeros(step + 2)
            target[0] = norm[c]
            own = bands[c, : step + 2, : step + 1]
            y = np.linalg.lstsq(own, target, rcond=None)[0]
            solved[: step + 1, c] = y
            left[c] = np.linalg.norm(own @ y - target)
        if (left <= INNER_FALL * norm).all():
            break
    return sum(v * y for v, y in zip(vectors, solved))


def leading_eigenpairs(product: Product, dims: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix of ``dims`` rows.

    ``product`` takes a block of columns to the matrix times it; every call serves all vectors
    that are still sought. Rayleigh-Ritz values of a growing basis give approximations; those whose residual has reached
    double precision are locked and projected out; each of the others is corrected by an approximate
    solution of its projected equation. The basis shrinks to its best part when it gets too wide.
    Of either sign, the one whose entry of greatest size is positive is returned.
    """
    wanted = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, wanted + GUARD))))
    image = product(basis)
    for _ in range(MOST_ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        sought = wanted - locked.shape[1]
        rest = image[:, :sought] - basis[:, :sought] * theta[:sought]
        scale = np.abs(np.concatenate((values, theta))).max(initial=0.0)
        exact = np.linalg.norm(rest, axis=0) <= TOLERANCE * scale
        if exact.any():
            done = np.flatnonzero(exact)
            locked, values = np.column_stack((locked, basis[:, done])), np.append(values, theta[done])
            keep = np.ones(basis.shape[1], bool)
            keep[done] = False
            basis, image, theta = basis[:, keep], image[:, keep], theta[keep]
            rest = rest[:, ~exact]
            sought -= len(done)
        if not sought:
            order = np.argsort(-values, kind="stable")
            locked, values = locked[:, order], values[order]
            most = np.abs(locked).argmax(axis=0)
            return values, locked * np.where(locked[most, np.arange(wanted)] < 0, -1.0, 1.0)
        if basis.shape[1] > WIDEST * wanted:
            basis, image = basis[:, : sought + GUARD], image[:, : sought + GUARD]
        near = np.column_stack((locked, basis[:, :sought]))
        if basis.shape[1] + locked.shape[1] < dims:
            step = _minres(product, theta[:sought], -rest, near)
        else:
            step = rest  # the basis spans everything: only rounding is left to mend
        new = _orthonormal(step, locked, basis)
        if not new.shape[1]:
            # Nothing to add: products of the rotated basis anew, without the rounding gathered so far.
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        basis, image = np.column_stack((basis, new)), np.column_stack((image, product(new)))
    raise RuntimeError("eigenvectors did not converge")
