"""Forecasters: what a user registers to be scored and trained."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

LOSSES = ("mse", "mae")


@dataclass(frozen=True)
class ModelSpec:
    """Shape and functions of a forecaster with a flat parameter vector.

    ``predict(params, x)`` maps ``(p,), (n, look_back)`` to ``(n, outputs)``; ``gradient(params, x, y)`` gives
    the gradient of the mean loss over the rows. Both are None for the linear model, which runs as column
    expressions.
    """

    name: str
    look_back: int
    outputs: int = 1
    loss: str = "mse"
    init: tuple[float, ...] = ()
    predict: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
    gradient: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None

    def __post_init__(self):
        if self.loss not in LOSSES:
            raise ValueError(f"loss must be one of {LOSSES}")
        if (self.predict is None) != (self.gradient is None):
            raise ValueError("give both predict and gradient, or neither")

    @property
    def linear(self) -> bool:
        return self.predict is None

    @property
    def size(self) -> int:
        return self.outputs * (self.look_back + 1) if self.linear else len(self.init)


_REGISTERED: dict[str, ModelSpec] = {}


def register_model(
    name: str,
    predict_fn: Callable,
    gradient_fn: Callable,
    init: list[float],
    look_back: int,
    outputs: int = 1,
    loss: str = "mse",
) -> ModelSpec:
    """Register a user's forecaster under ``name`` and return its spec."""
    spec = ModelSpec(name, look_back, outputs, loss, tuple(float(v) for v in init), predict_fn, gradient_fn)
    _REGISTERED[name] = spec
    return spec


def registered_model(name: str) -> ModelSpec:
    return _REGISTERED[name]


def linear_model(look_back: int, outputs: int = 1, loss: str = "mse", init: list[float] | None = None) -> ModelSpec:
    """Each output is a weighted sum of the window plus a bias; starts as the window's mean."""
    mean = ([1.0 / look_back] * look_back + [0.0]) * outputs
    return ModelSpec("linear", look_back, outputs, loss, tuple(init or mean))


def mlp_model(look_back: int, hidden: int, outputs: int = 1, loss: str = "mse", seed: int = 0) -> ModelSpec:
    """One hidden tanh layer."""
    shapes = [(look_back, hidden), (hidden,), (hidden, outputs), (outputs,)]
    sizes = [int(np.prod(s)) for s in shapes]
    rng = np.random.default_rng(seed)
    init = np.concatenate([rng.normal(0, 0.1, n) for n in sizes])

    def layers(params):
        return [part.reshape(s) for part, s in zip(np.split(params, np.cumsum(sizes)[:-1]), shapes)]

    def predict(params, x):
        w1, b1, w2, b2 = layers(params)
        return np.tanh(x @ w1 + b1) @ w2 + b2

    def gradient(params, x, y):
        w1, b1, w2, b2 = layers(params)
        inner = np.tanh(x @ w1 + b1)
        miss = inner @ w2 + b2 - y
        out = (2 * miss if loss == "mse" else np.sign(miss)) / miss.size
        back = (out @ w2.T) * (1 - inner**2)
        return np.concatenate([(x.T @ back).ravel(), back.sum(0), (inner.T @ out).ravel(), out.sum(0)])

    return register_model(f"mlp{hidden}", predict, gradient, list(init), look_back, outputs, loss)
