"""What boosting minimises: gradients and second derivatives per row, starting margins, and responses.

Every objective works on margins, the sums of leaf values. `gradient` gives the first derivative of the loss and a positive
weight in place of the second one; a leaf's value is minus the ratio of their sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Exponents beyond this are cut, so that no sum overflows.
MOST = 50.0
#: Weights in place of second derivatives are at least this.
LEAST_WEIGHT = 1e-6


def _exp(x):
    return np.exp(np.clip(x, -MOST, MOST))


def sigmoid(m):
    return 1.0 / (1.0 + _exp(-m))


def softmax(m: np.ndarray) -> np.ndarray:
    """Row by row, over the last axis."""
    e = np.exp(m - m.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Facts:
    """What the starting margin may depend on: weighted label sums, counted over all rows."""

    mean: float
    spread: float
    least: float
    most: float


@dataclass(frozen=True)
class Objective:
    """Functions of (labels, margins) over numpy arrays; `start` is the margin before the first tree."""

    loss: Callable
    gradient: Callable
    start: Callable[[Facts], float] = lambda f: f.mean
    respond: Callable = lambda m: m
    metric: str = "rmse"
    root: bool = False  # the metric is the root of twice the mean loss
    least_label: float | None = None  # labels below are an error
    over_zero: bool = False  # labels have to be above `least_label`


def _log_mean(f: Facts) -> float:
    return float(np.log(max(f.mean, 1e-12)))


def _logit_mean(f: Facts) -> float:
    p = min(max(f.mean, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _log_loss(y, m):
    return np.logaddexp(0.0, m) - y * m


def _logistic(y, m):
    p = sigmoid(m)
    return p - y, np.maximum(p * (1 - p), LEAST_WEIGHT)


def _hinge(y, m):
    sign = 2 * y - 1
    return np.where(m * sign < 1, -sign, 0.0), np.ones_like(m)


def _squared_log(y, m):
    safe = np.maximum(m, -1 + 1e-6)
    gap = np.log1p(safe) - np.log1p(y)
    return gap / (safe + 1), np.maximum((1 - gap) / (safe + 1) ** 2, LEAST_WEIGHT)


def _pinball(alpha: float, spread: float) -> Objective:
    # the loss has no second derivative: a weight of one over the labels' spread gives steps of their size
    weight = 1.0 / max(spread, 1e-12)
    return Objective(
        loss=lambda y, m: np.where(y >= m, alpha * (y - m), (1 - alpha) * (m - y)),
        gradient=lambda y, m: (np.where(y > m, -alpha, np.where(y < m, 1 - alpha, 0.0)), np.full_like(m, weight)),
        metric="mae" if alpha == 0.5 else "quantile")


def _huber(delta: float) -> Objective:
    return Objective(
        loss=lambda y, m: np.where(abs(m - y) <= delta, (m - y) ** 2 / 2, delta * (abs(m - y) - delta / 2)),
        gradient=lambda y, m: (np.clip(m - y, -delta, delta), np.ones_like(m)), metric="huber")


def _pseudo_huber(delta: float) -> Objective:
    root = lambda z: np.sqrt(1 + (z / delta) ** 2)
    return Objective(
        loss=lambda y, m: delta**2 * (root(m - y) - 1),
        gradient=lambda y, m: ((m - y) / root(m - y), root(m - y) ** -3.0), metric="mphe")


def _fair(c: float) -> Objective:
    return Objective(
        loss=lambda y, m: c * c * (abs(m - y) / c - np.log1p(abs(m - y) / c)),
        gradient=lambda y, m: (c * (m - y) / (abs(m - y) + c), (c / (abs(m - y) + c)) ** 2), metric="fair")


def _tweedie(power: float) -> Objective:
    a, b = 1 - power, 2 - power
    return Objective(
        loss=lambda y, m: -y * _exp(a * m) / a + _exp(b * m) / b,
        gradient=lambda y, m: (
            -y * _exp(a * m) + _exp(b * m), np.maximum(-y * a * _exp(a * m) + b * _exp(b * m), LEAST_WEIGHT)),
        start=_log_mean, respond=_exp, metric="tweedie", least_label=0.0)


_SQUARED = Objective(
    loss=lambda y, m: (m - y) ** 2 / 2, gradient=lambda y, m: (m - y, np.ones_like(m)), metric="rmse", root=True)
_POISSON = Objective(
    loss=lambda y, m: _exp(m) - y * m, gradient=lambda y, m: (_exp(m) - y, np.maximum(_exp(m), LEAST_WEIGHT)),
    start=_log_mean, respond=_exp, metric="poisson", least_label=0.0)
_GAMMA = Objective(
    loss=lambda y, m: y * _exp(-m) + m, gradient=lambda y, m: (1 - y * _exp(-m), np.maximum(y * _exp(-m), LEAST_WEIGHT)),
    start=_log_mean, respond=_exp, metric="gamma", least_label=0.0, over_zero=True)
_LOG = Objective(loss=_log_loss, gradient=_logistic, start=_logit_mean, respond=sigmoid, metric="logloss", least_label=0.0)
_RAW = Objective(loss=_log_loss, gradient=_logistic, start=_logit_mean, metric="logloss", least_label=0.0)
_HINGE = Objective(
    loss=lambda y, m: np.maximum(0.0, 1 - m * (2 * y - 1)), gradient=_hinge, start=lambda f: 0.0,
    respond=lambda m: (m > 0).astype(float), metric="hinge", least_label=0.0)
_SQUARED_LOG = Objective(
    loss=lambda y, m: (np.log1p(np.maximum(m, -1 + 1e-6)) - np.log1p(y)) ** 2 / 2, gradient=_squared_log,
    start=lambda f: max(f.mean, 0.0), metric="rmsle", root=True,
    least_label=0.0)

#: The names under which the usual trainers know each of them.
_NAMES = {
    "logistic": ("binary:logistic", "binary", "reg:logistic", "cross_entropy"), "raw": ("binary:logitraw",), "hinge": ("binary:hinge",),
    "softmax": ("multi:softmax", "multi:softprob", "multiclass"),
    "squared": ("reg:squarederror", "regression", "regression_l2", "l2", "mse", "rmse"),
    "absolute": ("reg:absoluteerror", "regression_l1", "l1"), "quantile": ("reg:quantileerror", "quantile"),
    "pseudo_huber": ("reg:pseudohubererror",), "huber": ("huber",), "fair": ("fair",), "squared_log": ("reg:squaredlogerror",),
    "poisson": ("count:poisson", "poisson"), "gamma": ("reg:gamma", "gamma"), "tweedie": ("reg:tweedie", "tweedie"),
}
KINDS = {name: kind for kind, names in _NAMES.items() for name in names}


def objective(name: str, facts: Facts, alpha: float = 0.5, power: float = 1.5, delta: float = 1.0) -> Objective:
    """The objective of a name; `alpha` is the quantile, `power` Tweedie's, `delta` where robust losses bend."""
    kind = KINDS[name]
    if kind in ("absolute", "quantile"):
        return _pinball(0.5 if kind == "absolute" else alpha, facts.spread)
    made = {"pseudo_huber": lambda: _pseudo_huber(delta), "huber": lambda: _huber(delta), "fair": lambda: _fair(delta),
            "tweedie": lambda: _tweedie(power)}
    if kind in made:
        return made[kind]()
    return {"logistic": _LOG, "raw": _RAW, "hinge": _HINGE, "squared": _SQUARED, "poisson": _POISSON, "gamma": _GAMMA,
            "squared_log": _SQUARED_LOG}[kind]


def metric_of(name: str) -> str:
    return objective(name, Facts(0.0, 1.0, 0.0, 0.0)).metric
