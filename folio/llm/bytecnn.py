"""A byte convolutional network in numpy: byte embedding, filters of several
widths, max pooling over positions, softmax layer.  Shared by the language
and quality operators.

All widths run as one product: the windows under the widest filter are
unrolled once and narrower filters have zero rows.
"""

from __future__ import annotations

import numpy as np

PAD = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
DIM = 8
BATCH = 64


def windows(data: np.ndarray, offs: np.ndarray, length: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``length`` bytes every ``stride`` bytes over every whole
    text (the last ones padded; an empty text has one window of padding),
    the text each belongs to, and the bytes of text in it."""
    size = np.diff(offs)
    count = np.maximum(1, -(-np.maximum(0, size - length) // stride) + 1)
    owner = np.arange(len(size)).repeat(count)
    start = (np.arange(len(owner)) - (np.cumsum(count) - count)[owner]) * stride
    filled = np.minimum(length, size[owner] - start)
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    x = view[np.minimum(offs[:-1][owner] + start, len(data))].astype(np.int16)
    short = np.flatnonzero(filled < length)
    x[short] = np.where(np.arange(length)[None, :] < filled[short, None], x[short], PAD)
    return x, owner, np.maximum(filled, 1)


def init(classes: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest, DIM, total), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS:(i + 1) * FILTERS] = 1
    mask = mask.reshape(widest * DIM, total)
    scale = 1 / np.sqrt(np.repeat(WIDTHS, FILTERS) * DIM)
    emb = rng.normal(0, 1, (257, DIM)).astype(np.float32)
    emb[PAD] = 0
    return {"emb": emb, "w": (rng.normal(0, 1, mask.shape) * scale * mask).astype(np.float32),
            "b": np.zeros(total, np.float32), "v": (rng.normal(0, 1, (total, classes)) / np.sqrt(total)).astype(np.float32),
            "c": np.zeros(classes, np.float32), "mask": mask}


def _patches(m: dict, x: np.ndarray) -> np.ndarray:
    widest = max(WIDTHS)
    e = m["emb"][x]
    n = x.shape[1] - widest + 1
    out = np.empty((len(x), n, widest, DIM), np.float32)
    for j in range(widest):
        out[:, :, j] = e[:, j:j + n]
    return out.reshape(len(x), n, widest * DIM)


def pooled(m: dict, x: np.ndarray) -> np.ndarray:
    """Max-pooled filter responses of every window."""
    out = np.empty((len(x), m["w"].shape[1]), np.float32)
    for i in range(0, len(x), 16):
        p = _patches(m, x[i:i + 16])
        out[i:i + 16] = (p.reshape(-1, p.shape[2]) @ m["w"]).reshape(len(p), p.shape[1], -1).max(axis=1)
    return np.maximum(out + m["b"], 0)


def logits(m: dict, x: np.ndarray) -> np.ndarray:
    return pooled(m, x) @ m["v"] + m["c"]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, classes: int, steps: int, seed: int = 11, rate: float = 4e-3) -> dict[str, np.ndarray]:
    """Cross-entropy by Adam; the gradient passes through the positions that
    max pooling chose.  Deterministic for given windows and seed."""
    m = init(classes, seed)
    rng = np.random.default_rng(seed + 1)
    names = ("emb", "w", "b", "v", "c")
    first = {k: np.zeros_like(m[k]) for k in names}
    second = {k: np.zeros_like(m[k]) for k in names}
    step = 0
    widest = max(WIDTHS)
    while step < steps:
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            at = order[i:i + BATCH]
            xb, yb = x[at], y[at]
            n = len(xb)
            p = _patches(m, xb)
            r = (p.reshape(-1, p.shape[2]) @ m["w"]).reshape(n, p.shape[1], -1)
            best = r.argmax(axis=1)
            top = np.take_along_axis(r, best[:, None, :], 1)[:, 0] + m["b"]
            h = np.maximum(top, 0)
            g = softmax(h @ m["v"] + m["c"])
            g[np.arange(n), yb] -= 1
            g /= n
            gh = (g @ m["v"].T) * (top > 0)
            chosen = p[np.arange(n)[:, None], best]
            grads = {"v": h.T @ g, "c": g.sum(0), "b": gh.sum(0), "w": np.einsum("nfk,nf->kf", chosen, gh) * m["mask"]}
            ge = (gh[:, :, None] * m["w"].T[None]).reshape(n, -1, widest, DIM)
            spots = xb[np.arange(n)[:, None, None], best[:, :, None] + np.arange(widest)]
            grads["emb"] = np.zeros_like(m["emb"])
            np.add.at(grads["emb"], spots.ravel(), ge.reshape(-1, DIM))
            grads["emb"][PAD] = 0
            step += 1
            lr = rate * max(0.05, 1 - step / steps)
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
                m[k] -= (lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            if step == steps:
                break
    return m
