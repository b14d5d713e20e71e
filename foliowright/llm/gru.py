"""A gated recurrent unit in numpy, forwards and by backpropagation through time.

Arrays are features first, so that a step works on long contiguous rows: projected
inputs are (time, 3 * hidden, batch), states (time, hidden, batch). The gates' rows are
update, reset, candidate.
"""

from __future__ import annotations

import numpy as np


def _squash(a: np.ndarray) -> None:
    """The logistic function, in place."""
    a *= 0.5
    np.tanh(a, out=a)
    a *= 0.5
    a += 0.5


def run(project, steps, u: np.ndarray, batch: int, keep: list | None = None, holds: np.ndarray | None = None) -> np.ndarray:
    """States after each step; project(t) gives the inputs at t, a fresh array.

    Steps are taken in the order given; with keep, what backward() needs is appended.
    holds (time, batch): 0 where a row has no input; its state is then zero.
    """
    hidden = u.shape[1]
    h = np.zeros((hidden, batch), u.dtype)
    out = np.empty((len(steps), hidden, batch), u.dtype)
    for t in steps:
        x = project(t)
        rec = u @ h
        gates = x[: 2 * hidden]
        gates += rec[: 2 * hidden]
        _squash(gates)
        z, r = gates[:hidden], gates[hidden:]
        n = x[2 * hidden :]
        last = rec[2 * hidden :]
        if keep is not None:
            last = last.copy()
            n += r * last
        else:
            last *= r
            n += last
        np.tanh(n, out=n)
        new = out[t]
        np.subtract(h, n, out=new)
        new *= z
        new += n
        if holds is not None:
            new *= holds[t]
        if keep is not None:
            keep.append((t, h, z, r, n, last))
        h = new
    return out


def backward(dout: np.ndarray, keep: list, u: np.ndarray, holds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs (time, 3 * hidden, batch) and of u."""
    hidden = u.shape[1]
    dx = np.empty((dout.shape[0], 3 * hidden, dout.shape[2]), u.dtype)
    du = np.zeros_like(u)
    dh = np.zeros(dout.shape[1:], u.dtype)
    for t, h, z, r, n, last in reversed(keep):
        d = dout[t] + dh
        if holds is not None:
            d *= holds[t]
        g = dx[t]
        dn = d * (1 - z) * (1 - n * n)
        g[:hidden] = d * (h - n) * z * (1 - z)
        g[hidden : 2 * hidden] = dn * last * r * (1 - r)
        g[2 * hidden :] = dn * r  # for the recurrent part first
        du += g @ h.T
        dh = d * z + u.T @ g
        g[2 * hidden :] = dn
    return dx, du


class Adam:
    def __init__(self, params: dict, rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: dict, grads: dict) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = 1.0 / max(1.0, norm)
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            step = self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            params[k] -= step.astype(params[k].dtype)
