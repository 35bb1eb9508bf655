"""Limited-memory BFGS (Nocedal 1980) over an objective whose every evaluation is a distributed job."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


@dataclass
class Minimum:
    point: np.ndarray
    value: float
    gradient: np.ndarray
    objective: list[float]  # after each iteration
    converged: bool


def _direction(gradient: np.ndarray, pairs: deque) -> np.ndarray:
    """Two-loop recursion: minus the inverse Hessian estimate of the kept ``(step, change of the gradient)`` pairs,
    times the gradient, without forming a matrix."""
    q, alphas = gradient.copy(), []
    for s, y, curvature in reversed(pairs):
        alpha = float(s @ q) / curvature
        alphas.append(alpha)
        q -= alpha * y
    if pairs:
        _, y, curvature = pairs[-1]
        q *= curvature / float(y @ y)
    for (s, y, curvature), alpha in zip(pairs, reversed(alphas)):
        q += (alpha - float(y @ q) / curvature) * s
    return -q


def _line_search(evaluate, point, value, step, slope):
    """A step length by bisection whose value falls enough (Armijo) and whose slope has flattened (weak Wolfe), so the
    change of the gradient shows positive curvature: ``(length, value, gradient)``, or None if rounding leaves none."""
    low, high, length, found = 0.0, np.inf, 1.0, None
    for _ in range(50):
        trial, gradient = evaluate(point + length * step)
        if trial > value + 1e-4 * length * slope + 1e-13 * abs(value):  # the last term: rounding
            high = length
        else:
            found = (length, trial, gradient)
            if float(gradient @ step) >= 0.9 * slope:
                return found
            low = length
        length = 2 * low if high == np.inf else (low + high) / 2
    return found


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, tol: float = 1e-3, max_iter: int = 500,
             history: int = 20) -> Minimum:
    """Minimum of a smooth function from its value and gradient, until no gradient component exceeds ``tol``.

    Memory is ``2 * history`` vectors; most iterations take one evaluation (the full step).
    """
    point = start
    value, gradient = evaluate(point)
    pairs: deque = deque(maxlen=history)
    objective: list[float] = []
    while np.abs(gradient).max(initial=0.0) > tol and len(objective) < max_iter:
        step = _direction(gradient, pairs)
        found = _line_search(evaluate, point, value, step, float(gradient @ step))
        if found is None:
            if not pairs:
                break
            pairs.clear()  # the history misleads: start over from the gradient
            continue
        length, value, new = found
        s, y = length * step, new - gradient
        if float(s @ y) > 1e-14:
            pairs.append((s, y, float(s @ y)))
        point, gradient = point + s, new
        objective.append(value)
    return Minimum(point, value, gradient, objective, bool(np.abs(gradient).max(initial=0.0) <= tol))
