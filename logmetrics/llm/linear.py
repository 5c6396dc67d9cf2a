"""Logistic regression on sparse rows."""

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(
    owner: np.ndarray, column: np.ndarray, value: np.ndarray, labels: np.ndarray, width: int, penalty: float, steps: int = 60
) -> tuple[np.ndarray, float]:
    """Weights and bias, by Newton steps with conjugate gradients, halved until the loss falls.

    Entry i puts ``value[i]`` into row ``owner[i]``, column ``column[i]``. Labels lie
    between 0 and 1 and need not be whole. The bias is not penalised.
    """
    y, n = labels.astype(float), len(labels)

    def times(w):
        return np.bincount(owner, weights=value * w[column], minlength=n)

    def back(v):
        return np.bincount(column, weights=value * v[owner], minlength=width)

    def loss(z, w):
        return float(np.logaddexp(0, z).sum() - y @ z + penalty / 2 * (w @ w))

    w, b = np.zeros(width), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    z = times(w) + b
    now = loss(z, w)
    for _ in range(steps):
        p = sigmoid(z)
        g, gb, d = back(p - y) + penalty * w, float((p - y).sum()), np.maximum(p * (1 - p), 1e-6)
        step, sb, res, rb = np.zeros(width), 0.0, g.copy(), gb
        way, wb, norm = res.copy(), rb, float(res @ res + rb * rb)
        first = norm
        for _ in range(40):
            if norm <= 1e-4 * first or norm == 0:
                break
            t = d * (times(way) + wb)
            h, hb = back(t) + penalty * way, float(t.sum()) + 1e-6 * wb
            a = norm / float(way @ h + wb * hb)
            step, sb, res, rb = step + a * way, sb + a * wb, res - a * h, rb - a * hb
            new = float(res @ res + rb * rb)
            way, wb, norm = res + new / norm * way, rb + new / norm * wb, new
        move, size = times(step) + sb, 1.0
        while (new := loss(z - size * move, w - size * step)) > now and size > 1e-6:
            size /= 2
        done = now - new < 1e-7 * max(1.0, now)
        if new <= now:
            w, b, z, now = w - size * step, b - size * sb, z - size * move, new
        if done:
            break
    return w, b
