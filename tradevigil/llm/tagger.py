"""A character tagger in numpy: two LSTMs, one per direction, under a linear-chain CRF.

All windows have one length; what a text lacks is padding, tagged as outside. Tags are
outside, and begin and inside of each kind of span. A window may start inside a span.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EMBEDDED = 12
HIDDEN = 24
EPOCHS = 7
BATCH = 64
STEP = 0.02
CLIP = 5.0
NEVER = -1e4  # added to the score of a tag pair that cannot be

Weights = dict[str, np.ndarray]


def allowed(kinds: int) -> np.ndarray:
    """0 where one tag may follow another, NEVER where not: inside only after its own kind."""
    tags = 1 + 2 * kinds
    table = np.zeros((tags, tags))
    for inside in range(2, tags, 2):
        table[:, inside] = NEVER
        table[[inside - 1, inside], inside] = 0
    return table


def fresh(symbols: int, kinds: int, seed: int = 0, embedded: int = EMBEDDED, hidden: int = HIDDEN, dtype=np.float32) -> Weights:
    rng, tags = np.random.default_rng(seed), 1 + 2 * kinds

    def drawn(*shape):
        return (rng.normal(0, 1 / np.sqrt(shape[0]), shape)).astype(dtype)

    weights = {"embed": drawn(symbols, embedded), "out": drawn(2 * hidden, tags), "out_b": np.zeros(tags, dtype)}
    for way in ("ahead", "back"):
        weights[f"{way}_x"], weights[f"{way}_h"] = drawn(embedded, 4 * hidden), drawn(hidden, 4 * hidden)
        weights[f"{way}_b"] = np.zeros(4 * hidden, dtype)
        weights[f"{way}_b"][hidden : 2 * hidden] = 1  # remember at first
    return weights | {"pair": np.zeros((tags, tags), dtype), "start": np.zeros(tags, dtype)}


# ---- the two LSTMs -----------------------------------------------------------------


@dataclass
class _Pass:
    x: np.ndarray
    gates: np.ndarray  # in, forget and out gate, candidate: time, batch, 4 x hidden
    cell: np.ndarray
    h: np.ndarray


def _run(x: np.ndarray, w: Weights, way: str) -> _Pass:
    time, batch, _ = x.shape
    recur = w[f"{way}_h"]
    n = len(recur)
    gates = x @ w[f"{way}_x"] + w[f"{way}_b"]
    cell, h = np.zeros((time, batch, n), x.dtype), np.zeros((time, batch, n), x.dtype)
    c = before = np.zeros((batch, n), x.dtype)
    for t in range(time):
        a = gates[t]
        a += before @ recur
        a[:, : 3 * n] = 0.5 + 0.5 * np.tanh(0.5 * a[:, : 3 * n])
        a[:, 3 * n :] = np.tanh(a[:, 3 * n :])
        c = cell[t] = a[:, n : 2 * n] * c + a[:, :n] * a[:, 3 * n :]
        before = h[t] = a[:, 2 * n : 3 * n] * np.tanh(c)
    return _Pass(x, gates, cell, h)


def _run_back(p: _Pass, into_h: np.ndarray, w: Weights, way: str, grads: Weights) -> np.ndarray:
    """Adds the weights' gradients; returns the gradient of the input."""
    recur = w[f"{way}_h"]
    n = len(recur)
    change = np.zeros_like(p.gates)
    dh, dc = np.zeros_like(p.h[0]), np.zeros_like(p.h[0])
    none = np.zeros_like(p.h[0])
    for t in range(len(p.x) - 1, -1, -1):
        i, f, o, g = (p.gates[t][:, k * n : (k + 1) * n] for k in range(4))
        bent = np.tanh(p.cell[t])
        dh = dh + into_h[t]
        dc = dc + dh * o * (1 - bent * bent)
        d = change[t]
        d[:, :n] = dc * g * i * (1 - i)
        d[:, n : 2 * n] = dc * (p.cell[t - 1] if t else none) * f * (1 - f)
        d[:, 2 * n : 3 * n] = dh * bent * o * (1 - o)
        d[:, 3 * n :] = dc * i * (1 - g * g)
        dh, dc = d @ recur.T, dc * f
    flat = change.reshape(-1, 4 * n)
    grads[f"{way}_x"] = p.x.reshape(-1, p.x.shape[2]).T @ flat
    grads[f"{way}_b"] = flat.sum(axis=0)
    grads[f"{way}_h"] = p.h[:-1].reshape(-1, n).T @ change[1:].reshape(-1, 4 * n)
    return change @ w[f"{way}_x"].T


def _emissions(codes: np.ndarray, w: Weights) -> tuple[np.ndarray, _Pass, _Pass]:
    """Tag scores, time first, of windows given as rows of symbol codes."""
    x = w["embed"][codes.T]
    ahead, back = _run(x, w, "ahead"), _run(np.ascontiguousarray(x[::-1]), w, "back")
    both = np.concatenate([ahead.h, back.h[::-1]], axis=2)
    return both @ w["out"] + w["out_b"], ahead, back


# ---- the CRF -----------------------------------------------------------------------


def _lse(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def _sums(scores: np.ndarray, pair: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums over all taggings up to and after each place, and over whole windows."""
    ahead, after = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = start + scores[0]
    for t in range(1, len(scores)):
        ahead[t] = scores[t] + _lse(ahead[t - 1][:, :, None] + pair, 1)
    for t in range(len(scores) - 2, -1, -1):
        after[t] = _lse(pair + (scores[t + 1] + after[t + 1])[:, None, :], 2)
    return ahead, after, _lse(ahead[-1], 1)


def _pairs(w: Weights) -> np.ndarray:
    return (w["pair"] + allowed((len(w["start"]) - 1) // 2)).astype(w["pair"].dtype)


def loss_and_gradients(codes: np.ndarray, tags: np.ndarray, w: Weights) -> tuple[float, Weights]:
    """Mean negative log likelihood of the taggings of the windows, and its gradients."""
    scores, ahead_pass, back_pass = _emissions(codes, w)
    pair, y = _pairs(w), tags.T
    time, batch = y.shape
    ahead, after, whole = _sums(scores, pair, w["start"])
    told = np.take_along_axis(scores, y[:, :, None], 2)[:, :, 0].sum(axis=0) + w["start"][y[0]] + pair[y[:-1], y[1:]].sum(axis=0)
    loss = float((whole - told).mean())

    share = np.exp(ahead + after - whole[:, None])
    known = np.zeros_like(scores)
    np.put_along_axis(known, y[:, :, None], 1, 2)
    d = (share - known) / batch
    joint = np.exp(ahead[:-1][:, :, :, None] + pair + (scores[1:] + after[1:])[:, :, None, :] - whole[:, None, None])
    counts = np.zeros_like(pair)
    np.add.at(counts, (y[:-1].ravel(), y[1:].ravel()), 1)
    grads = {"pair": (joint.sum(axis=(0, 1)) - counts) / batch, "start": d[0].sum(axis=0)}

    both = np.concatenate([ahead_pass.h, back_pass.h[::-1]], axis=2)
    tags_n = scores.shape[2]
    grads["out"] = both.reshape(-1, both.shape[2]).T @ d.reshape(-1, tags_n)
    grads["out_b"] = d.sum(axis=(0, 1))
    into = d @ w["out"].T
    n = into.shape[2] // 2
    dx = _run_back(ahead_pass, into[:, :, :n], w, "ahead", grads)
    dx = dx + _run_back(back_pass, into[::-1, :, n:], w, "back", grads)[::-1]
    grads["embed"] = np.zeros_like(w["embed"])
    np.add.at(grads["embed"], codes.T.ravel(), dx.reshape(time * batch, -1))
    return loss, grads


def train(codes: np.ndarray, tags: np.ndarray, symbols: int, kinds: int, epochs: int = EPOCHS, seed: int = 0) -> Weights:
    """Weights after `epochs` passes of Adam over the windows, in an order drawn from `seed`."""
    w = fresh(symbols, kinds, seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    rng, turn, turns = np.random.default_rng(seed), 0, epochs * -(-len(codes) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for low in range(0, len(codes), BATCH):
            part = order[low : low + BATCH]
            _, grads = loss_and_gradients(codes[part], tags[part], w)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate, turn = STEP * (1 - 0.9 * turn / turns), turn + 1
            for k, g in grads.items():
                g = g * min(1.0, CLIP / (norm + 1e-12))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)).astype(w[k].dtype)
    return w


def decode(codes: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Per window the best tagging as a whole, and the probability of each of its tags."""
    scores, _, _ = _emissions(codes, w)
    pair = _pairs(w)
    best, came = w["start"] + scores[0], []
    for t in range(1, len(scores)):
        ways = best[:, :, None] + pair
        came.append(ways.argmax(axis=1))
        best = scores[t] + ways.max(axis=1)
    path = [best.argmax(axis=1)]
    for back in reversed(came):
        path.append(back[np.arange(len(codes)), path[-1]])
    tags = np.array(path[::-1])
    ahead, after, whole = _sums(scores, pair, w["start"])
    share = np.exp(ahead + after - whole[:, None])
    return tags.T, np.take_along_axis(share, tags[:, :, None], 2)[:, :, 0].T
