"""A two-state linear-chain conditional random field over sparse binary features."""

from __future__ import annotations

import numpy as np


class ChainCRF:
    """States 0 and 1; ``weights[f, s]`` per feature, ``step[s, t]`` between neighbours and
    ``first[s]`` at the start."""

    def __init__(self, features: list[str]):
        self.index = {f: i for i, f in enumerate(features)}
        self.weights = np.zeros((len(features), 2))
        self.step = np.zeros((2, 2))
        self.first = np.zeros(2)

    def emissions(self, items: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(items), 2))
        get, w = self.index.get, self.weights
        for i, names in enumerate(items):
            out[i] = w[[k for k in map(get, names) if k is not None]].sum(axis=0)
        return out

    def decode(self, items: list[list[str]]) -> list[int]:
        """The best state sequence (Viterbi)."""
        if not items:
            return []
        e = self.emissions(items).tolist()
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = (x + y for x, y in zip(self.first.tolist(), e[0]))
        back = []
        for x, y in e[1:]:
            from_a, from_b = b + s10 <= a + s00, b + s11 <= a + s01
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + s00 if from_a else b + s10) + x, (a + s01 if from_b else b + s11) + y
        state = 0 if a >= b else 1
        out = [state]
        for choice in reversed(back):
            state = choice[state]
            out.append(state)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], penalty: float = 0.02, rounds: int = 200, rate: float = 0.1) -> ChainCRF:
    """Maximum conditional likelihood with an L2 penalty: full-batch gradients from the
    forward-backward pass over all pages at once, steps by Adam."""
    model = ChainCRF(sorted({f for items, _ in pages for names in items for f in names}))
    longest = max(len(items) for items, _ in pages)
    n = len(pages)
    mask = np.zeros((n, longest), bool)
    gold = np.zeros((n, longest), int)
    feature, owner = [], []
    for p, (items, labels) in enumerate(pages):
        mask[p, : len(items)] = True
        gold[p, : len(items)] = labels
        for i, names in enumerate(items):
            feature += [model.index[f] for f in names]
            owner += [p * longest + i] * len(names)
    feature, owner = np.array(feature), np.array(owner)
    blocks = int(mask.sum())
    wanted = np.stack([np.bincount(feature, (gold.ravel()[owner] == s), len(model.index)) for s in (0, 1)], axis=1)
    both = mask[:, 1:]
    gold_step = np.zeros((2, 2))
    np.add.at(gold_step, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    gold_first = np.bincount(gold[:, 0], minlength=2).astype(float)

    params = [model.weights, model.step, model.first]
    moment = [[np.zeros_like(x), np.zeros_like(x)] for x in params]
    log_sum = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for t in range(1, rounds + 1):
        e = np.stack([np.bincount(owner, model.weights[feature, s], n * longest) for s in (0, 1)], axis=1).reshape(n, longest, 2)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = model.first + e[:, 0]
        for i in range(1, longest):
            nxt = log_sum(alpha[:, i - 1, :, None] + model.step, 1) + e[:, i]
            alpha[:, i] = np.where(mask[:, i, None], nxt, alpha[:, i - 1])
        total = log_sum(alpha[:, -1], 1)
        for i in range(longest - 2, -1, -1):
            back = log_sum(model.step + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(mask[:, i + 1, None], back, 0.0)
        p = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + model.step + (e + beta)[:, 1:, None, :] - total[:, None, None, None])[both].sum(axis=0)
        got = np.stack([np.bincount(feature, p.reshape(-1, 2)[owner, s], len(model.index)) for s in (0, 1)], axis=1)
        grads = [(wanted - got) / blocks, (gold_step - pair) / blocks, (gold_first - p[:, 0].sum(axis=0)) / blocks]
        for x, g, m in zip(params, grads, moment):
            g = g - penalty / blocks * x
            m[0][:] = 0.9 * m[0] + 0.1 * g
            m[1][:] = 0.999 * m[1] + 0.001 * g * g
            x += rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)
    return model
