"""A gated recurrent language model in numpy: training by truncated backpropagation, class-factored output, carried state.

The probability of a token is that of its class given the state, times that of the
token within its class given the state.  Classes hold ``CLASS`` words each, by rank of
frequency; all words beyond the vocabulary are the last class, and whoever holds the
corpus counts tells the share of a word in it.  Output biases start at the logarithms of
the counts, so an untrained model is the unigram model.

Texts are lists of vocabulary places, several laid end to end with their offsets.
They walk side by side, longest first, a window of steps at a time; the state at the
end of a window is where the next begins, to the end of the text.
"""

from __future__ import annotations

import numpy as np

CLASS = 32
EMBED = 16
STATE = 16
#: Steps that a gradient goes back, and texts that walk side by side in training.
TRUNCATED = 24
SIDE_BY_SIDE = 64
RATE = 0.01
CLIP = 1.0
#: Tokens of one window in scoring, which needs no gradients.
WINDOW = 1 << 14

Weights = dict[str, np.ndarray]


def fresh(counts: np.ndarray, rare: float) -> Weights:
    """Weights before training, for words of these ``counts``, by place, and the count of all words beyond."""
    words = len(counts)
    classes = -(-words // CLASS)
    draw = np.random.default_rng(7)
    small = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    within = np.full((classes, CLASS), -1e9, dtype=np.float32)
    within.ravel()[:words] = np.log(counts + 0.1)
    mass = [counts[c * CLASS : (c + 1) * CLASS].sum() for c in range(classes)]
    return {
        "embed": small(words + 1, EMBED),
        "into": small(EMBED, 3 * STATE),
        "into_bias": np.zeros(3 * STATE, dtype=np.float32),
        "back": small(STATE, 3 * STATE),
        "kind": 0.1 * small(STATE, classes + 1),
        "kind_bias": np.log(np.array([*mass, rare], dtype=np.float64) + 0.1).astype(np.float32),
        "word": 0.1 * small(classes, STATE, CLASS),
        "word_bias": within,
    }


def packed(weights: Weights) -> bytes:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)]).astype(np.float32).tobytes()


def unpacked(flat: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _views(flat: np.ndarray, like: Weights) -> Weights:
    """The stretches of ``flat`` that hold the weights, in their order."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: flat[end - v.size : end].reshape(v.shape) for (k, v), end in zip(like.items(), ends)}


def _apart(gates: np.ndarray) -> np.ndarray:
    """Columns of the three gates as three tables, each of them in one piece."""
    return np.ascontiguousarray(gates.reshape(len(gates), 3, STATE).transpose(1, 0, 2))


def _walk(w: Weights, x: np.ndarray, h: np.ndarray, active: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple[np.ndarray, ...] | None]:
    """What ``_steps`` gives, from inputs (steps, texts, 3 * STATE)."""
    return _steps(w, x.reshape(*x.shape[:2], 3, STATE).transpose(2, 0, 1, 3).copy(), h, active, keep)


def _steps(w: Weights, x: np.ndarray, h: np.ndarray, active: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple[np.ndarray, ...] | None]:
    """States after every step (steps, texts, STATE) from inputs ``x`` (3, steps, texts, STATE), which are overwritten; ``h`` is moved on.

    ``active`` texts take part in a step, never more than in the one before.  With ``keep`` come what a gradient
    needs: both gates and the share of the state, the proposals, and the states before every step.
    """
    steps, width, kind = x.shape[1], x.shape[2], np.result_type(x, h)
    states = np.zeros((steps + 1, width, STATE), dtype=kind)
    states[0] = h
    made = np.zeros((3, steps if keep else 1, width, STATE), dtype=kind)
    proposed = np.zeros((steps if keep else 1, width, STATE), dtype=kind)
    # A sigmoid is the hyperbolic tangent of half its argument; halving is exact, so it is done once for all steps.
    back = _apart(w["back"])
    back[:2] *= 0.5
    x[:2] *= 0.5
    for t in range(steps):
        a, k = active[t], t if keep else 0
        before, after, n = states[t, :a], states[t + 1, :a], proposed[k, :a]
        g = made[:, k, :a]
        np.matmul(before, back, out=g)
        gates = g[:2]
        gates += x[:2, t, :a]
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5
        np.multiply(g[0], g[2], out=n)
        n += x[2, t, :a]
        np.tanh(n, out=n)
        np.subtract(before, n, out=after)
        after *= g[1]
        after += n
    h[:] = states[(active[:, None] > np.arange(width)).sum(axis=0), np.arange(width)]
    return states[1:], (made, proposed, states[:-1]) if keep else None


def _softmax(x: np.ndarray) -> np.ndarray:
    """Of ``x``, which is overwritten."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _chosen(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax of each row at one place; ``x`` is overwritten."""
    x -= x.max(axis=1, keepdims=True)
    value = x[np.arange(len(at)), at]
    np.exp(x, out=x)
    return value - np.log(x.sum(axis=1))


def _sorted(places: np.ndarray, most: int) -> np.ndarray:
    """The stable order of ``places``, none above ``most``; numbers of two bytes are sorted without comparing."""
    return np.argsort(places.astype(np.uint16) if most < 1 << 16 else places, kind="stable")


def _by_class(target: np.ndarray, classes: int):
    """The class of each target, and the targets of each class of words that has some."""
    kind = np.minimum(target // CLASS, classes).astype(np.int64)
    order = _sorted(kind, classes)
    ends = np.searchsorted(kind[order], np.arange(classes + 1))
    return kind, [(c, order[ends[c] : ends[c + 1]]) for c in range(classes) if ends[c + 1] > ends[c]]


def _log_probability(w: Weights, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The natural logarithm of the probability of each target; of a word beyond the vocabulary that of its class."""
    classes = len(w["word"])
    kind, members = _by_class(np.where(target == len(w["embed"]) - 1, classes * CLASS, target), classes)
    told = _chosen(states @ w["kind"] + w["kind_bias"], kind).astype(np.float64)
    for c, some in members:
        told[some] += _chosen(states[some] @ w["word"][c] + w["word_bias"][c], target[some] - c * CLASS)
    return told


def _laid_out(tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: int, steps: int, start: int):
    """(input places, target places, active texts) of a window of texts sorted from long to short."""
    place = at + np.arange(steps)[:, None]
    valid = place < sizes[None, :]
    target = tokens[np.where(valid, starts[None, :] + place, starts[None, :])]
    before = tokens[np.where(valid, starts[None, :] + np.maximum(place - 1, 0), starts[None, :])]
    before = np.where(place == 0, start, before)
    return before, target, valid.sum(axis=1), valid


def score(w: Weights, tokens: np.ndarray, offsets: np.ndarray, start: int) -> np.ndarray:
    """The natural logarithm of the probability of each text, from its first token to its last; ``start`` goes before the first."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = offsets[:-1][order], sizes[order]
    into = w["embed"] @ w["into"] + w["into_bias"]
    total, h, at = np.zeros(len(sizes)), np.zeros((len(sizes), STATE), dtype=np.float32), 0
    while at < (sizes[0] if len(sizes) else 0):
        width = int((sizes > at).sum())
        steps = int(min(max(16, WINDOW // width), 1024, sizes[0] - at))
        before, target, active, valid = _laid_out(tokens, starts[:width], sizes[:width], at, steps, start)
        states, _ = _walk(w, into[before], h[:width], active, keep=False)
        told = np.zeros(valid.shape)
        told[valid] = _log_probability(w, states[valid], target[valid])
        total[:width] += told.sum(axis=0)
        at += steps
    out = np.zeros(len(total))
    out[order] = total
    return out


def _gradients(w: Weights, before: np.ndarray, target: np.ndarray, h: np.ndarray, active: np.ndarray, valid: np.ndarray, g: Weights | None = None) -> Weights:
    """Gradients of the mean loss of one window, put into ``g``, zeros, if given; ``h`` is moved on."""
    steps, width = before.shape
    embedded = w["embed"][before]
    x = np.matmul(embedded.reshape(-1, EMBED), _apart(w["into"])).reshape(3, steps, width, STATE)
    x += w["into_bias"].reshape(3, 1, 1, STATE)
    states, kept = _steps(w, x, h, active, keep=True)
    s, t = states[valid], target[valid]
    m, classes = len(t), len(w["word"])
    kind, members = _by_class(np.where(t == len(w["embed"]) - 1, classes * CLASS, t), classes)
    d = _softmax(s @ w["kind"] + w["kind_bias"])
    d[np.arange(m), kind] -= 1
    d /= m
    g = {k: np.zeros_like(v) for k, v in w.items()} if g is None else g
    g["kind"][:], g["kind_bias"][:] = s.T @ d, d.sum(axis=0)
    ds = d @ w["kind"].T
    # Laid out by class once, so that each class is a stretch of them.
    order = np.concatenate([some for _, some in members]) if members else np.zeros(0, dtype=np.int64)
    ends = np.cumsum([len(some) for _, some in members])
    parts = [(c, slice(end - len(some), end)) for (c, some), end in zip(members, ends)]
    laid, place, dlaid = s[order], t[order] - kind[order] * CLASS, np.empty((len(order), STATE), dtype=np.float32)
    e = np.empty((len(order), CLASS), dtype=np.float32)
    for c, those in parts:
        np.matmul(laid[those], w["word"][c], out=e[those])
    e += w["word_bias"][kind[order]]
    _softmax(e)
    e[np.arange(len(order)), place] -= 1
    e /= m
    for c, those in parts:
        np.matmul(laid[those].T, e[those], out=g["word"][c])
        np.add.reduce(e[those], axis=0, out=g["word_bias"][c])
        np.matmul(e[those], w["word"][c].T, out=dlaid[those])
    ds[order] += dlaid
    out = np.zeros((steps, width, STATE), dtype=np.float32)
    out[valid] = ds
    dx, dg = (np.zeros((steps, width, 3 * STATE), dtype=np.float32) for _ in range(2))
    dh, moved = np.zeros((width, STATE), dtype=np.float32), np.empty((width, STATE), dtype=np.float32)
    made, n, held = kept
    r, z, hn = made
    by_n, by_r, by_z, turned = (1 - z) * (1 - n * n), hn * r * (1 - r), (held - n) * z * (1 - z), w["back"].T.copy()
    for i in range(steps - 1, -1, -1):
        a = active[i]
        back, here, dn, turn = dh[:a], dg[i, :a], dx[i, :a, 2 * STATE :], moved[:a]
        back += out[i, :a]
        np.multiply(back, by_n[i, :a], out=dn)
        np.multiply(dn, by_r[i, :a], out=here[:, :STATE])
        np.multiply(back, by_z[i, :a], out=here[:, STATE : 2 * STATE])
        np.multiply(dn, r[i, :a], out=here[:, 2 * STATE :])
        back *= z[i, :a]
        np.matmul(here, turned, out=turn)
        back += turn
    dx[..., : 2 * STATE] = dg[..., : 2 * STATE]
    flat_x = dx.reshape(-1, 3 * STATE)
    g["back"][:] = held.reshape(-1, STATE).T @ dg.reshape(-1, 3 * STATE)
    g["into"][:] = embedded.reshape(-1, EMBED).T @ flat_x
    g["into_bias"][:] = flat_x.sum(axis=0)
    de, ids = flat_x @ w["into"].T, before.ravel()
    order = _sorted(ids, len(w["embed"]))
    ids = ids[order]
    firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    g["embed"][ids[firsts]] = np.add.reduceat(de[order], firsts, axis=0)
    return g


class Trainer:
    """Adam over windows of texts, from given weights."""

    def __init__(self, weights: Weights, seed: int):
        # Weights and moments lie in one piece each, so that a step is a few passes over all of them.
        self.flat = np.concatenate([v.ravel() for v in weights.values()])
        self.w = _views(self.flat, weights)
        self.m, self.v, self.slope, self.squares = (np.zeros_like(self.flat) for _ in range(4))
        self.g, self.by_kind = _views(self.slope, weights), [*_views(self.squares, weights).values()]
        self.steps, self.tokens, self.draw = 0, 0, np.random.default_rng(seed)

    def _step(self) -> None:
        self.steps += 1
        np.multiply(self.slope, self.slope, out=self.squares)
        size = np.sqrt(sum(float(v.sum()) for v in self.by_kind))
        scale = min(1.0, CLIP / (size + 1e-9))
        rate = RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        clipped = self.slope if scale == 1.0 else scale * self.slope
        change = clipped - self.m
        change *= 0.1
        self.m += change
        np.square(clipped, out=change)
        change -= self.v
        change *= 0.01
        self.v += change
        root = np.sqrt(self.v)
        root += 1e-6
        move = rate * self.m
        move /= root
        self.flat -= move.astype(np.float32)

    def learn(self, tokens: np.ndarray, offsets: np.ndarray, start: int) -> None:
        """One pass over some texts, those of like length side by side."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        groups = [order[i : i + SIDE_BY_SIDE] for i in range(0, len(order), SIDE_BY_SIDE)]
        for i in self.draw.permutation(len(groups)):
            starts, held = offsets[:-1][groups[i]], sizes[groups[i]]
            h = np.zeros((len(held), STATE), dtype=np.float32)
            for at in range(0, int(held[0]), TRUNCATED):
                width = int((held > at).sum())
                steps = int(min(TRUNCATED, held[0] - at))
                before, target, active, valid = _laid_out(tokens, starts[:width], held[:width], at, steps, start)
                self.slope[:] = 0
                _gradients(self.w, before, target, h[:width], active, valid, self.g)
                self._step()
                self.tokens += int(valid.sum())
