"""Follow-the-regularised-leader (proximal) updates for sparse linear models, in numpy."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Multinomial (or, with one output, logistic) regression over hashed features.

    Each coordinate has its own rate alpha / (beta + sqrt(sum of squared
    gradients)); l1 makes weights exactly zero, l2 shrinks the rest.
    """

    def __init__(self, n_features: int, n_outputs: int, alpha=0.3, beta=1.0, l1=1e-3, l2=1e-3):
        self.z = np.zeros((n_features, n_outputs))
        self.n = np.zeros((n_features, n_outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, ids=slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def step(self, ids: np.ndarray, x: np.ndarray, target: np.ndarray) -> None:
        """One example: distinct feature ids, their values, the wanted output vector."""
        w = self.weights(ids)
        out = x @ w
        if len(out) == 1:
            p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
        else:
            p = np.exp(out - out.max())
            p /= p.sum()
        g = x[:, None] * (p - target)[None, :]
        n = self.n[ids]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[ids] += g - sigma * w
        self.n[ids] = n + g * g
