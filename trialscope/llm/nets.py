"""Small networks in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    """Adam steps on a dictionary of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = 1e-2) -> None:
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(w) for k, w in weights.items()}
        self.v = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, slopes: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, g in slopes.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.weights[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


class TwoLayers:
    """Standardised inputs, one hidden layer of rectified units, ``outputs`` logits."""

    def __init__(self, x: np.ndarray, hidden: int, seed: int, outputs: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        n = x.shape[1]
        self.w = {
            "a": (rng.standard_normal((n, hidden)) * (2 / n) ** 0.5).astype("f4"),
            "b": np.zeros(hidden, "f4"),
            "c": (rng.standard_normal((hidden, outputs)) * (1 / hidden) ** 0.5).astype("f4"),
            "d": np.zeros(outputs, "f4"),
        }

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((x - self.middle) / self.scale, -8, 8)
        return x, np.maximum(x @ self.w["a"] + self.w["b"], 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = self._hidden(x)[1] @ self.w["c"] + self.w["d"]
        return out[:, 0] if out.shape[1] == 1 else out

    def fit(
        self, x: np.ndarray, y: np.ndarray, epochs: int, rate: float = 5e-3, batch: int = 128,
        decay: float = 1e-3, seed: int = 5,
    ) -> None:
        """Logistic loss for one output (y in 0..1), softmax loss for several (y: rows of shares)."""
        rng, adam, w = np.random.default_rng(seed), Adam(self.w, rate), self.w
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                at = order[i : i + batch]
                inputs, hidden = self._hidden(x[at])
                out = hidden @ w["c"] + w["d"]
                if out.shape[1] == 1:
                    slope = (sigmoid(out) - y[at, None]) / len(at)
                else:
                    p = np.exp(out - out.max(axis=1, keepdims=True))
                    slope = (p / p.sum(axis=1, keepdims=True) - y[at]) / len(at)
                slope = slope.astype("f4")
                back = (slope @ w["c"].T) * (hidden > 0)
                adam.step({
                    "a": inputs.T @ back + decay * w["a"],
                    "b": back.sum(axis=0),
                    "c": hidden.T @ slope + decay * w["c"],
                    "d": slope.sum(axis=0),
                })


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes held-out labels likeliest."""
    if not len(labels):
        return 1.0
    sign = np.where(labels > 0.5, 1.0, -1.0)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    return float(min(grid, key=lambda t: np.logaddexp(0, -sign * logits / t).mean()))
