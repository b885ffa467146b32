"""What a task computes on one block of rows: outputs and gradients, in NumPy.

A kernel names the shapes and the number type of its parameters, starts them, and gives
``forward`` and ``backward`` on views of one flat vector. Sharding, rounds and averaging are Spark's
business (``shards``).
"""

from __future__ import annotations

import math
import sys
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

# The classes travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Shapes = list[tuple[str, tuple[int, ...]]]

ADAM_DECAY = (0.9, 0.999)
ADAM_EPS = 1e-8


def views(flat: np.ndarray, shapes: Shapes) -> list[np.ndarray]:
    out, start = [], 0
    for _, shape in shapes:
        size = math.prod(shape)
        out.append(flat[start : start + size].reshape(shape))
        start += size
    return out


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class GatedCells(NamedTuple):
    """Stacked gated cells under a linear head.

    With sequences of length one and zero initial state, an LSTM cell (Hochreiter &
    Schmidhuber, 1997) reduces to ``h = s(o) * tanh(s(i) * tanh(g))``: forget gate and
    recurrent weights multiply zeros.
    """

    cells: int = 2
    hidden: int = 64
    dtype: str = "float32"

    def shapes(self, inputs: int) -> Shapes:
        """Gates are stacked as input, cell, output."""
        out, width = [], inputs
        for cell in range(self.cells):
            out.append((f"cell{cell}.weight", (width, 3 * self.hidden)))
            out.append((f"cell{cell}.bias", (3 * self.hidden,)))
            width = self.hidden
        return [*out, ("head.weight", (self.hidden, 1)), ("head.bias", (1,))]

    def start(self, inputs: int, seed: int) -> np.ndarray:
        size = sum(math.prod(shape) for _, shape in self.shapes(inputs))
        bound = 1 / math.sqrt(self.hidden)
        return np.random.default_rng(seed).uniform(-bound, bound, size)

    def forward(self, params, x):
        """Outputs and what ``backward`` needs."""
        trace, width = [], self.hidden
        for weight, bias in zip(params[:-2:2], params[1:-2:2]):
            z = x @ weight + bias
            i, g, o = _sigmoid(z[:, :width]), np.tanh(z[:, width:-width]), _sigmoid(z[:, -width:])
            c = np.tanh(i * g)
            trace.append((x, weight, i, g, o, c))
            x = o * c
        return (x @ params[-2] + params[-1])[:, 0], (trace, x)

    def backward(self, params, cache, d_out, grads) -> None:
        """Gradient of the loss into ``grads``, given its derivative by the outputs."""
        (trace, top), width = cache, self.hidden
        grads[-2][:] = top.T @ d_out[:, None]
        grads[-1][:] = d_out.sum()
        d_h = d_out[:, None] @ params[-2].T
        for layer in reversed(range(len(trace))):
            x, weight, i, g, o, c = trace[layer]
            d_ig = d_h * o * (1 - c * c)
            d_z = np.empty((len(x), 3 * width), x.dtype)
            d_z[:, :width] = d_ig * g * i * (1 - i)
            d_z[:, width:-width] = d_ig * i * (1 - g * g)
            d_z[:, -width:] = d_h * c * o * (1 - o)
            np.matmul(x.T, d_z, out=grads[2 * layer])
            grads[2 * layer + 1][:] = d_z.sum(axis=0)
            if layer:
                d_h = d_z @ weight.T


class RecurrentCells(NamedTuple):
    """Stacked LSTM cells (Hochreiter & Schmidhuber, 1997) over ``steps`` rows, under a linear head.

    An input row holds ``steps`` times the features and a flag that is 0 for steps before the
    first row, where the states stay zero. The head reads the last step; gradients go back through
    all ``steps`` (back-propagation through time, truncated there). The parameters of
    ``GatedCells`` come first, so with one step the net is that one.
    """

    cells: int = 2
    hidden: int = 64
    steps: int = 5
    dtype: str = "float32"

    def shapes(self, inputs: int) -> Shapes:
        """Gates are stacked as input, cell, output; recurrent weights end with the forget gate's."""
        width = inputs // self.steps - 1
        out = GatedCells(self.cells, self.hidden).shapes(width)
        for cell in range(self.cells):
            out.append((f"cell{cell}.forget.weight", (width, self.hidden)))
            out.append((f"cell{cell}.forget.bias", (self.hidden,)))
            out.append((f"cell{cell}.recurrent", (self.hidden, 4 * self.hidden)))
            width = self.hidden
        return out

    def start(self, inputs: int, seed: int) -> np.ndarray:
        size = sum(math.prod(shape) for _, shape in self.shapes(inputs))
        bound = 1 / math.sqrt(self.hidden)
        return np.random.default_rng(seed).uniform(-bound, bound, size)

    def _of(self, params, cell):
        own = 2 * self.cells + 2 + 3 * cell
        return params[2 * cell], params[2 * cell + 1], *params[own : own + 3]

    def forward(self, params, x):
        """Outputs and what ``backward`` needs."""
        x = x.reshape(len(x), self.steps, -1)
        given, x = x[:, :, -1:], x[:, :, :-1]
        trace, width = [], self.hidden
        for cell in range(self.cells):
            weight, bias, f_weight, f_bias, recurrent = self._of(params, cell)
            z = x @ np.hstack([weight, f_weight]) + np.concatenate([bias, f_bias])
            h = c = np.zeros((len(x), width), z.dtype)
            hs, steps = np.empty((len(x), self.steps, width), z.dtype), []
            for t in range(self.steps):
                before, z_t = (h, c), z[:, t] + h @ recurrent
                i, o = _sigmoid(z_t[:, :width]), _sigmoid(z_t[:, 2 * width : 3 * width])
                g, f = np.tanh(z_t[:, width : 2 * width]), _sigmoid(z_t[:, 3 * width :])
                c = f * c + i * g
                top = np.tanh(c)
                h, c = o * top * given[:, t], c * given[:, t]
                hs[:, t] = h
                steps.append((*before, i, g, o, f, top))
            trace.append((x, steps))
            x = hs
        head, head_bias = params[2 * self.cells : 2 * self.cells + 2]
        return (x[:, -1] @ head + head_bias)[:, 0], (trace, x[:, -1], given)

    def backward(self, params, cache, d_out, grads) -> None:
        """Gradient of the loss into ``grads``, given its derivative by the outputs."""
        (trace, top, given), width = cache, self.hidden
        n_gated = 2 * self.cells
        grads[n_gated][:] = top.T @ d_out[:, None]
        grads[n_gated + 1][:] = d_out.sum()
        d_hs = np.zeros((len(top), self.steps, width), top.dtype)
        d_hs[:, -1] = d_out[:, None] @ params[n_gated].T
        for cell in reversed(range(self.cells)):
            x, steps = trace[cell]
            weight, _, f_weight, _, recurrent = self._of(params, cell)
            g_weight, g_bias, gf_weight, gf_bias, g_recurrent = self._of(grads, cell)
            g_recurrent[:] = 0
            d_z = np.empty((len(x), self.steps, 4 * width), top.dtype)
            d_h = d_c = np.zeros_like(top)
            for t in reversed(range(self.steps)):
                h, c, i, g, o, f, tanh_c = steps[t]
                d_h = (d_hs[:, t] + d_h) * given[:, t]
                d_c = d_c * given[:, t] + d_h * o * (1 - tanh_c * tanh_c)
                d = d_z[:, t]
                d[:, :width] = d_c * g * i * (1 - i)
                d[:, width : 2 * width] = d_c * i * (1 - g * g)
                d[:, 2 * width : 3 * width] = d_h * tanh_c * o * (1 - o)
                d[:, 3 * width :] = d_c * c * f * (1 - f)
                g_recurrent += h.T @ d
                d_h, d_c = d @ recurrent.T, d_c * f
            flat, d_flat = x.reshape(-1, x.shape[2]), d_z.reshape(-1, 4 * width)
            both = flat.T @ d_flat
            g_weight[:], gf_weight[:] = both[:, : 3 * width], both[:, 3 * width :]
            sums = d_flat.sum(axis=0)
            g_bias[:], gf_bias[:] = sums[: 3 * width], sums[3 * width :]
            if cell:
                d_hs = d_z @ np.hstack([weight, f_weight]).T


class FactorPairs(NamedTuple):
    """Factorization machine (Rendle, 2010): linear terms plus factored products of pairs."""

    factors: int = 8
    start_sd: float = 0.01
    dtype: str = "float64"

    def shapes(self, inputs: int) -> Shapes:
        return [("bias", (1,)), ("linear", (inputs,)), ("factors", (inputs, self.factors))]

    def start(self, inputs: int, seed: int) -> np.ndarray:
        pairs = np.random.default_rng(seed).normal(0, self.start_sd, inputs * self.factors)
        return np.concatenate([np.zeros(1 + inputs), pairs])

    def forward(self, params, x):
        bias, linear, factors = params
        sums = x @ factors
        pairs = 0.5 * ((sums * sums).sum(axis=1) - (x * x) @ (factors * factors).sum(axis=1))
        return bias + x @ linear + pairs, (x, sums)

    def backward(self, params, cache, d_out, grads) -> None:
        x, sums = cache
        grads[0][:] = d_out.sum()
        grads[1][:] = x.T @ d_out
        own = (x * x).T @ d_out
        grads[2][:] = x.T @ (sums * d_out[:, None]) - params[2] * own[:, None]


def products(x: np.ndarray) -> np.ndarray:
    """One, the inputs, and the products of different inputs, pair by pair."""
    i, j = np.triu_indices(x.shape[1], 1)
    return np.column_stack([np.ones(len(x)), x, x[:, i] * x[:, j]])


def train_on_moments(kernel, moments, n, inputs, lr, epochs, seed):
    """Full-batch Adam on the mean squared error of a factorization machine, from sums.

    ``moments`` are the sums over rows of the products of (``products`` of the inputs, target)
    with themselves. An output is linear in the products, with weights (bias, linear, v_i v_j),
    so the error and its derivative by these weights are matrix products. Returns the
    parameters and the mean squared error at the start of each epoch.
    """
    i, j = np.triu_indices(inputs, 1)
    size = 1 + inputs + len(i)
    sums = np.asarray(moments, dtype=float).reshape(size + 1, size + 1) / n
    gram, cross, target = sums[:size, :size], sums[:size, size], sums[size, size]
    theta = kernel.start(inputs, seed)
    shapes = kernel.shapes(inputs)
    m, v, losses = np.zeros_like(theta), np.zeros_like(theta), []
    for step in range(1, epochs + 1):
        bias, linear, factors = views(theta, shapes)
        w = np.concatenate([bias, linear, (factors[i] * factors[j]).sum(axis=1)])
        fitted = gram @ w
        losses.append(max(0.0, float(w @ fitted - 2 * w @ cross + target)))
        slope = 2 * (fitted - cross)
        pairs = np.zeros((inputs, inputs))
        pairs[i, j] = pairs[j, i] = slope[1 + inputs :]
        grad = np.concatenate([slope[: 1 + inputs], (pairs @ factors).ravel()])
        m = ADAM_DECAY[0] * m + (1 - ADAM_DECAY[0]) * grad
        v = ADAM_DECAY[1] * v + (1 - ADAM_DECAY[1]) * grad * grad
        spread = np.sqrt(v) / math.sqrt(1 - ADAM_DECAY[1] ** step) + ADAM_EPS
        theta = theta - lr / (1 - ADAM_DECAY[0] ** step) * m / spread
    return theta, losses
