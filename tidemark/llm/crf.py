"""A linear-chain conditional random field with two states, in numpy.

Many sequences are laid end to end; the step into the first item of a sequence forgets what came
before, so the whole stream is one chain. The recursions run over fixed-size lanes side by side:
products of 2 x 2 matrices per lane, a scan over lanes, then the vectors inside every lane. Memory
is a few arrays as long as the stream.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANE = 64


@dataclass
class Chain:
    """Log weights of transitions (from, to) and of the first state."""

    trans: np.ndarray
    start: np.ndarray


def _scan(m: np.ndarray) -> np.ndarray:
    """Exclusive running product of (n, 2, 2) matrices, rescaled; entry i is the product of those before i."""
    out, step = m.copy(), 1
    while step < len(out):
        new = out.copy()
        new[step:] = out[:-step] @ out[step:]
        out = new / new.max(axis=(1, 2), keepdims=True)
        step *= 2
    return np.concatenate([np.eye(2)[None], out[:-1]])


def _steps(emit: np.ndarray, first: np.ndarray, chain: Chain) -> np.ndarray:
    """Step matrices as (LANE, lanes, 2, 2), padded with steps that start an empty sequence."""
    n = len(emit)
    lanes = -(-n // LANE)
    e, f = np.zeros(lanes * LANE), np.ones(lanes * LANE, bool)
    e[:n], f[:n] = emit, first
    top = np.maximum(e, 0.0)
    node = np.stack([np.exp(-top), np.exp(e - top)], axis=-1)
    weight = np.where(f[:, None, None], np.exp(chain.start)[None, None, :], np.exp(chain.trans)[None])
    return (weight * node[:, None, :]).reshape(lanes, LANE, 2, 2).transpose(1, 0, 2, 3)


def marginals(emit: np.ndarray, first: np.ndarray, chain: Chain, pairs: bool = False):
    """Probability of state 1 for every item; with ``pairs`` also expected transition and start counts.

    ``emit``: log weight of state 1 against state 0. ``first``: marks the first item of each sequence.
    """
    n = len(emit)
    if not n:
        return (np.zeros(0), np.zeros((2, 2)), np.zeros(2)) if pairs else np.zeros(0)
    a = _steps(np.clip(np.asarray(emit, float), -500, 500), np.asarray(first, bool), chain)
    lanes = a.shape[1]
    product = np.broadcast_to(np.eye(2), (lanes, 2, 2))
    for step in a:
        product = product @ step
        product = product / product.max(axis=(1, 2), keepdims=True)
    alpha = _scan(product).sum(axis=1)
    turned = product[::-1].transpose(0, 2, 1)
    beta = _scan(turned).sum(axis=1)[::-1]
    forward, before = np.empty((LANE, lanes, 2)), np.empty((LANE, lanes, 2))
    alpha = alpha / alpha.sum(axis=1, keepdims=True)
    for k in range(LANE):
        before[k] = alpha
        alpha = alpha[:, 0, None] * a[k, :, 0, :] + alpha[:, 1, None] * a[k, :, 1, :]
        alpha = alpha / alpha.sum(axis=1, keepdims=True)
        forward[k] = alpha
    backward = np.empty((LANE, lanes, 2))
    beta = beta / beta.sum(axis=1, keepdims=True)
    for k in range(LANE - 1, -1, -1):
        backward[k] = beta
        beta = a[k, :, :, 0] * beta[:, 0, None] + a[k, :, :, 1] * beta[:, 1, None]
        beta = beta / beta.sum(axis=1, keepdims=True)
    both = forward * backward
    p = (both[..., 1] / both.sum(axis=-1)).T.reshape(-1)[:n]
    if not pairs:
        return p
    joint = before[..., :, None] * a * backward[..., None, :]
    joint = joint / joint.sum(axis=(2, 3), keepdims=True)
    joint = joint.transpose(1, 0, 2, 3).reshape(-1, 2, 2)[:n]
    inner = ~np.asarray(first, bool)
    return p, joint[inner].sum(axis=0), joint[~inner].sum(axis=(0, 1))


def fit(features: np.ndarray, n_weights: int, first: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None, rounds: int = 150, rate: float = 0.1, l2: float = 1e-3):
    """Weights of indicator features and the chain, by gradient ascent with momentum on the mean log-likelihood.

    ``features``: (items, slots) indices below ``n_weights``; an item's log weight is the sum of its
    slots' weights. Weight 0 is the bias that every item should carry.
    """
    n = len(labels)
    w, trans, start = np.zeros(n_weights), np.zeros((2, 2)), np.zeros(2)
    y, first = np.asarray(labels, int), np.asarray(first, bool)
    seen, opened = np.zeros((2, 2)), np.bincount(y[first], minlength=2).astype(float)
    inner = np.flatnonzero(~first)
    np.add.at(seen, (y[inner - 1], y[inner]), 1.0)
    flat, slots = features.reshape(-1), features.shape[1]
    state = [np.zeros(n_weights + 6), np.zeros(n_weights + 6)]
    for t in range(1, rounds + 1):
        p, moved, begun = marginals(w[features].sum(axis=1), first, Chain(trans, start), pairs=True)
        gap = (y - p) / n
        grad = np.concatenate([np.bincount(flat, np.repeat(gap, slots), n_weights) - l2 * w, ((seen - moved) / n).ravel() - l2 * trans.ravel(), (opened - begun) / n - l2 * start])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = rate * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-9)
        w, trans, start = w + move[:n_weights], trans + move[n_weights : n_weights + 4].reshape(2, 2), start + move[n_weights + 4 :]
    return w, Chain(trans, start)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w
