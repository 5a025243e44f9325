"""A character-level bidirectional LSTM with a CRF on top, in numpy: training and inference.

Arrays of windows are (batch, time); every step works on the whole batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

# Printable ASCII has a symbol of its own each; then white space, other letters, the rest, padding.
WHITE, LETTER, OTHER, PAD = 95, 96, 97, 98
SYMBOLS = 99
BLOCK = 512  # windows that the network runs over at once


def symbols(text: str) -> np.ndarray:
    """Symbol numbers of a text's characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 32, OTHER)
    out[(codes < 32) | (codes == 0xA0)] = WHITE
    out[codes >= 0xC0] = LETTER
    return out


@dataclass
class Network:
    """Weights: input (direction, symbol) and recurrent of both directions, emissions, transitions."""

    inp: np.ndarray
    rec: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    @classmethod
    def fresh(cls, hidden: int, tags: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def small(*shape):
            return (rng.standard_normal(shape) * 0.15).astype(np.float32)

        inp = small(2 * SYMBOLS, 4 * hidden)
        inp[:, hidden:2 * hidden] += 1  # forget gates start open
        return cls(
            inp, small(2, hidden, 4 * hidden), small(2 * hidden, tags),
            np.zeros(tags, np.float32), small(tags, tags), small(tags),
        )

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _both_ways(win: np.ndarray) -> np.ndarray:
    """Rows of the input weights, (time, direction, batch); the second direction runs backwards."""
    return np.stack([win.T, win[:, ::-1].T + SYMBOLS], axis=1)


def _run(at: np.ndarray, net: Network, keep: bool):
    """Hidden states (time, direction, batch, hidden), and what the backward pass needs."""
    time, _, batch = at.shape
    hidden = net.rec.shape[1]
    h = np.zeros((2, batch, hidden), np.float32)
    c = np.zeros_like(h)
    states = np.empty((time, 2, batch, hidden), np.float32)
    trace = []
    for t in range(time):
        z = net.inp[at[t]] + h @ net.rec
        gates = _sigmoid(z[..., :3 * hidden])
        i, f, o = gates[..., :hidden], gates[..., hidden:2 * hidden], gates[..., 2 * hidden:]
        g = np.tanh(z[..., 3 * hidden:])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        if keep:
            trace.append((h, c, gates, g, tc))
        h, c = o * tc, c_new
        states[t] = h
    return states, trace


def _back(at: np.ndarray, net: Network, trace: list, d_states: np.ndarray):
    """Gradients of the input and of the recurrent weights."""
    time, _, batch = at.shape
    hidden = net.rec.shape[1]
    d_rec = np.zeros_like(net.rec)
    d_gates = np.empty((time, 2, batch, 4 * hidden), np.float32)
    rec_t = net.rec.transpose(0, 2, 1)
    dh = np.zeros_like(d_states[0])
    dc = np.zeros_like(dh)
    for t in range(time - 1, -1, -1):
        h, c, gates, g, tc = trace[t]
        i, f, o = gates[..., :hidden], gates[..., hidden:2 * hidden], gates[..., 2 * hidden:]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = d_gates[t]
        dz[..., :3 * hidden] = np.concatenate([dc * g, dc * c, dh * tc], axis=2)
        dz[..., :3 * hidden] *= gates * (1 - gates)
        dz[..., 3 * hidden:] = dc * i * (1 - g * g)
        d_rec += h.transpose(0, 2, 1) @ dz
        dh, dc = dz @ rec_t, dc * f
    one_hot = (at.reshape(-1, 1) == np.arange(2 * SYMBOLS)).astype(np.float32)
    return one_hot.T @ d_gates.reshape(-1, 4 * hidden), d_rec


def _emissions(net: Network, win: np.ndarray, keep: bool = False):
    at = _both_ways(win)
    states, trace = _run(at, net, keep)
    both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
    return both @ net.out + net.bias, both, at, trace


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _forward_backward(net: Network, e: np.ndarray):
    time, batch, tags = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = net.start + e[0]
    for t in range(1, time):
        alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + net.trans, 1) + e[t]
    for t in range(time - 2, -1, -1):
        beta[t] = _logsumexp(net.trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _logsumexp(alpha[-1], 1)


def _marginals(net: Network, e: np.ndarray) -> np.ndarray:
    """The probability of each tag at each place: forwards and backwards as `_forward_backward`, but in
    probabilities that are scaled to sum 1 at each place."""
    trans = np.exp((net.trans - net.trans.max()).astype(np.float64))
    here = np.exp((e - e.max(axis=2, keepdims=True)).astype(np.float64))
    here[0] *= np.exp((net.start - net.start.max()).astype(np.float64))
    ahead, both = np.ones(e.shape[1:]), np.empty_like(here)
    reached = here[0]
    for t in range(len(e)):
        reached = here[t] if t == 0 else (reached @ trans) * here[t]
        reached /= reached.sum(axis=1, keepdims=True)
        both[t] = reached
    for t in range(len(e) - 2, -1, -1):
        ahead = (ahead * here[t + 1]) @ trans.T
        ahead /= ahead.sum(axis=1, keepdims=True)
        both[t] *= ahead
    return both / both.sum(axis=2, keepdims=True)


def decode(net: Network, win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of each window, and the probability of each of them at its place."""
    return _best(net, _emissions(net, win)[0])


def _best(net: Network, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    time, batch, tags = e.shape
    best = net.start + e[0]
    back = np.empty((time, batch, tags), np.int8)
    for t in range(1, time):
        paths = best[:, :, None] + net.trans
        back[t] = paths.argmax(axis=1)
        best = paths.max(axis=1) + e[t]
    found = np.empty((batch, time), np.int64)
    found[:, -1] = best.argmax(axis=1)
    rows = np.arange(batch)
    for t in range(time - 1, 0, -1):
        found[:, t - 1] = back[t][rows, found[:, t]]
    sure = _marginals(net, e)[np.arange(time)[:, None], rows[None, :], found.T].T
    return found, sure


def tagged(net: Network, win: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows whose best tags are not all 0: their numbers, and what `decode` gives for them.

    The network runs over every window; best tags are looked for where `_leaves` cannot rule out that
    they have another one than 0. Few windows of a block are left, so those of all blocks are decoded
    at once.
    """
    rows, left = [], []
    for at in range(0, len(win), BLOCK):
        e = _inferred(net, win[at:at + BLOCK])
        own = np.flatnonzero(_leaves(net, e))
        rows.append(own + at)
        left.append(e[:, own])
    if not sum(map(len, rows)):
        none = np.zeros((0, win.shape[1]))
        return np.zeros(0, np.int64), none.astype(np.int64), none.astype(np.float32)
    found = np.concatenate(rows)
    tags, sure = _best(net, np.ascontiguousarray(np.concatenate(left, axis=1)))
    kept = tags.any(axis=1)
    return found[kept], tags[kept], sure[kept]


def _inferred(net: Network, win: np.ndarray) -> np.ndarray:
    """The emissions of `_emissions` in as few passes as it takes. All gates are one tanh, a sigmoid being
    half of a tanh and a half: the halves are put into the weights, so `h` is twice the state. Under it
    lies a row of ones, by which the bias comes with the product. The windows lie along the last axis,
    where a gate is one block, and arrays are used again."""
    hidden, (batch, time), tags = net.rec.shape[1], win.shape, net.out.shape[1]
    half = np.float32(0.5)
    scale = np.ones(4 * hidden, np.float32)
    scale[:3 * hidden] = half
    inp = net.inp * scale
    rec = np.ascontiguousarray((net.rec * scale * half).transpose(0, 2, 1))
    outward = np.zeros((2, tags, hidden + 1), np.float32)
    outward[:, :, :hidden] = (net.out * half).reshape(2, hidden, tags).transpose(0, 2, 1)
    outward[0, :, hidden] = net.bias
    at = _both_ways(win)
    out, part = np.empty((time, tags, batch), np.float32), np.empty((2, tags, batch), np.float32)
    state, c = np.ones((2, hidden + 1, batch), np.float32), np.zeros((2, hidden, batch), np.float32)
    h = state[:, :hidden]
    h[:] = 0
    x, z = np.empty((2, batch, 4 * hidden), np.float32), np.empty((2, 4 * hidden, batch), np.float32)
    across, squashed = x.transpose(0, 2, 1), np.empty_like(c)
    i, f, o, g = (z[:, n * hidden:(n + 1) * hidden] for n in range(4))
    for t in range(time):
        inp.take(at[t], 0, x, "clip")
        np.matmul(rec, h, out=z)
        z += across
        np.tanh(z, out=z)
        f *= c
        f += c
        i *= g
        i += g
        np.add(f, i, out=c)
        c *= half
        np.tanh(c, out=squashed)
        np.multiply(o, squashed, out=h)
        h += squashed
        # the direction that comes second to a place is added to the other
        for way, place in enumerate((t, time - 1 - t)):
            first = 2 * t < time - 1 or (2 * t == time - 1 and way == 0)
            np.matmul(outward[way], state[way], out=out[place] if first else part[way])
            if not first:
                out[place] += part[way]
    return out.transpose(0, 2, 1)


def _leaves(net: Network, e: np.ndarray) -> np.ndarray:
    """Whether some path with another tag than 0 may score as high as the one of zeros.

    A path leaves 0 for runs of other tags. A run gains at most its largest emissions over those of 0
    and the largest transitions into it, inside it and out of it over the one from 0 to 0, so where no
    run of any place and length can gain, the path of zeros is the best one. A small margin is left for
    rounding.
    """
    gain = e[:, :, 1:].max(axis=2) - e[:, :, 0]
    stay = net.trans[0, 0]
    into, inside, leave = (
        float(part.max() - stay) for part in (net.trans[0, 1:], net.trans[1:, 1:], net.trans[1:, 0])
    )
    run = float(net.start[1:].max() - net.start[0]) + gain[0]
    most = np.full_like(run, -np.inf)  # of the runs that end before the last place
    for part in gain[1:]:
        np.maximum(most, run, out=most)
        run += inside
        np.maximum(run, into, out=run)
        run += part
    most = np.maximum(most + leave, run)
    return most > -1e-3


def train(
    win: np.ndarray, tags: np.ndarray, n_tags: int, hidden: int, epochs: int, batch: int,
    rate: float = 0.02, seed: int = 7,
) -> Network:
    """Fit by Adam on the negative log-likelihood of the CRF. The same input gives the same net."""
    net = Network.fresh(hidden, n_tags, seed)
    first = {n: np.zeros_like(getattr(net, n)) for n in net.names()}
    second = {n: np.zeros_like(getattr(net, n)) for n in net.names()}
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = rng.permutation(len(win))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            step += 1
            for name, grad in _gradients(net, win[rows], tags[rows]).items():
                grad = np.clip(grad, -1, 1)
                first[name] += 0.1 * (grad - first[name])
                second[name] += 0.01 * (grad * grad - second[name])
                move = (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6
                )
                setattr(net, name, (getattr(net, name) - pace * move).astype(np.float32))
    return net


def _gradients(net: Network, win: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    e, both, at, trace = _emissions(net, win, keep=True)
    time, batch, n = e.shape
    alpha, beta, total = _forward_backward(net, e)
    d_e = np.exp(alpha + beta - total[None, :, None])
    d_start = d_e[0].copy()
    joint = alpha[:-1, :, :, None] + net.trans + (e + beta)[1:, :, None, :]
    d_trans = np.exp(joint - total[None, :, None, None]).sum(axis=(0, 1))
    rows = np.arange(batch)
    d_e[np.arange(time)[:, None], rows[None, :], tags.T] -= 1
    d_start[rows, tags[:, 0]] -= 1
    np.subtract.at(d_trans, (tags[:, :-1], tags[:, 1:]), 1)
    d_e /= batch
    flat, hidden = d_e.reshape(-1, n), net.rec.shape[1]
    d_both = d_e @ net.out.T
    d_states = np.stack([d_both[:, :, :hidden], d_both[::-1, :, hidden:]], axis=1)
    d_inp, d_rec = _back(at, net, trace, d_states)
    return {
        "inp": d_inp, "rec": d_rec, "out": both.reshape(-1, 2 * hidden).T @ flat,
        "bias": flat.sum(axis=0), "trans": d_trans / batch, "start": d_start.sum(axis=0) / batch,
    }
