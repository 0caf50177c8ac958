"""NumPy forward pass of a two-block multi-scale convolutional scorer."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

# Branch widths of the two blocks, dense width, outputs, slope.
WIDE = 27
REDUCED = {"one": 16, "three_in": 64, "three": 16, "five_in": 64, "five": 16, "pool": 32}
DENSE, OUTPUTS, LEAK = 64, 2, 0.01

Params = Mapping[str, np.ndarray]


def shapes(features: int = 18, length: int = 30) -> dict[str, tuple[int, ...]]:
    """Weight shapes, (out, in, kernel) for convolutions, (out, in) for dense."""
    mid, r = 4 * WIDE, REDUCED
    flat = (r["one"] + r["three"] + r["five"] + r["pool"]) * length
    return {
        "a_one": (WIDE, features, 1), "a_three": (WIDE, features, 3),
        "a_five": (WIDE, features, 5), "a_pool": (WIDE, features, 3),
        "b_one": (r["one"], mid, 1),
        "b_three_in": (r["three_in"], mid, 1), "b_three": (r["three"], r["three_in"], 3),
        "b_five_in": (r["five_in"], mid, 1), "b_five": (r["five"], r["five_in"], 5),
        "b_pool": (r["pool"], mid, 1),
        "dense": (DENSE, flat), "head": (OUTPUTS, DENSE)}


def seeded_params(seed: int = 0, features: int = 18, length: int = 30) -> dict[str, np.ndarray]:
    """Deterministic weights for tests and demonstrations."""
    rng = np.random.default_rng(seed)
    out: dict[str, np.ndarray] = {}
    for name, shape in shapes(features, length).items():
        scale = 1.0 / np.sqrt(np.prod(shape[1:]))
        out[name] = rng.uniform(-scale, scale, shape)
        out[f"{name}_bias"] = rng.uniform(-scale, scale, shape[0])
    return out


def _leaky(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x, LEAK * x)


def _conv(x: np.ndarray, p: Params, name: str) -> np.ndarray:
    """Same-length convolution of (batch, channels, time), then activation."""
    kernel = p[name]
    pad = kernel.shape[2] // 2
    padded = np.pad(x, ((0, 0), (0, 0), (pad, pad)))
    taps = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape[2], axis=2)
    y = np.einsum("bctk,ock->bot", taps, kernel, optimize=True)
    return _leaky(y + p[f"{name}_bias"][None, :, None])


def _max3(x: np.ndarray) -> np.ndarray:
    padded = np.pad(x, ((0, 0), (0, 0), (1, 1)), constant_values=-np.inf)
    return np.lib.stride_tricks.sliding_window_view(padded, 3, axis=2).max(axis=3)


def forward(windows: np.ndarray, p: Params) -> np.ndarray:
    """(batch, steps, features) to (batch, 2), both outputs positive."""
    want = p["a_one"].shape[1]
    if windows.shape[2] != want:
        raise ValueError(f"scorer expects {want} features, got {windows.shape[2]}")
    x = windows.transpose(0, 2, 1)
    x = np.concatenate([_conv(x, p, "a_one"), _conv(x, p, "a_three"), _conv(x, p, "a_five"),
                        _conv(_max3(x), p, "a_pool")], axis=1)
    x = np.concatenate([_conv(x, p, "b_one"), _conv(_conv(x, p, "b_three_in"), p, "b_three"),
                        _conv(_conv(x, p, "b_five_in"), p, "b_five"),
                        _conv(_max3(x), p, "b_pool")], axis=1)
    dense = _leaky(x.reshape(len(x), -1) @ p["dense"].T + p["dense_bias"])
    y = dense @ p["head"].T + p["head_bias"]
    y = np.maximum(y, 0) + np.log1p(np.exp(-np.abs(y)))
    return np.where(y > 1e-9, y, 1e-9)


def conv_scorer(params: Params):
    """A scorer of batches of windows with the given weights."""
    frozen = {k: np.asarray(v) for k, v in params.items()}
    return lambda batch: forward(batch, frozen)
