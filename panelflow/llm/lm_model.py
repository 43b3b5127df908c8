"""A small causal self-attention model in numpy.

One attention layer over windows of subword ids predicts the class of the next id; the id
within the class follows the corpus' pair counts.  With ``B`` the smoothed pair distribution,

    p(id | window) = p(class of id | window) * B(id | previous id) / B(class of id | previous id)

and the class logits start from ``log B(class | previous id)``, so attention learns what the
previous id alone does not tell.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH, HIDDEN, CLASSES = 16, 32, 32
WINDOW, CONTEXT = 32, 4
SMOOTHING = 20.0

Params = dict[str, np.ndarray]


def begin(ids: int) -> Params:
    rng = np.random.default_rng(11)
    shapes = {
        "id": (ids, WIDTH), "place": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH),
        "up": (WIDTH, HIDDEN), "bias": (HIDDEN,), "out": (HIDDEN, CLASSES),
    }
    return {n: (np.zeros(s) if n in ("out", "bias") else rng.normal(0, 0.3 if n in ("id", "place") else WIDTH**-0.5, s)).astype(np.float32) for n, s in shapes.items()}


def flat(params: Params) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in sorted(params)])


def shaped(values: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for n in sorted(like):
        out[n] = values[at : at + like[n].size].reshape(like[n].shape).astype(np.float32)
        at += like[n].size
    return out


@dataclass
class Pairs:
    """Smoothed pair distribution; ``log_id`` is empty where pairs are too many for a table."""

    log_id: np.ndarray  # log B(id | previous)
    log_class: np.ndarray  # log B(class | previous)
    classes: np.ndarray  # class of each id


def pair_tables(counts: np.ndarray, starts: np.ndarray) -> Pairs:
    """``counts[previous, id]`` with a last row for text starts; ``starts``: how often ids occur."""
    overall = (starts + 0.1) / (starts + 0.1).sum()
    b = (counts + SMOOTHING * overall) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
    classes = _classes(b, starts)
    members = np.zeros((len(starts), CLASSES))
    members[np.arange(len(starts)), classes] = 1
    return Pairs(np.log(b).astype(np.float32), np.log(b @ members + 1e-30).astype(np.float32), classes)


def _classes(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids grouped by what follows and precedes them (k-means on square roots of shares)."""
    n = len(starts)
    if n <= CLASSES:
        return np.arange(n)
    before = b[:n].T * starts
    x = np.concatenate([np.sqrt(b[:n]), np.sqrt(before / np.maximum(before.sum(axis=1, keepdims=True), 1e-12))], axis=1)
    centres = x[np.argsort(-starts)[:CLASSES]]
    for _ in range(12):
        near = np.argmax(x @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        many = np.bincount(near, minlength=CLASSES)[:, None]
        centres = np.where(many, sums / np.maximum(many, 1), centres)
    return near


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, first place, first scored place)`` of windows that score each place once."""
    step = WINDOW - CONTEXT
    many = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // step)), 0)
    text = np.repeat(np.arange(len(lengths)), many)
    number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first = number * step
    return text, first, np.where(number > 0, first + CONTEXT, 0)


_PAST = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))
# Attention scores above this count as this, so that no maximum has to be taken first.
_HIGHEST = np.float32(40)


def _attended(params: Params, previous: np.ndarray) -> dict:
    """What leads to the hidden layer ``u``, for windows of previous ids; places in rows."""
    n = len(previous)
    x = (params["id"][previous] + params["place"]).reshape(-1, WIDTH)
    q = (x @ (params["q"] * np.float32(WIDTH**-0.5))).reshape(n, WINDOW, WIDTH)
    k, v = ((x @ params[name]).reshape(n, WINDOW, WIDTH) for name in "kv")
    raw = q @ k.transpose(0, 2, 1)
    a = np.minimum(raw, _HIGHEST)
    np.exp(a, out=a)
    a *= _PAST
    total = a.sum(axis=2, keepdims=True)
    mixed = ((a @ v) / total).reshape(-1, WIDTH)
    h = x + mixed @ params["o"]
    u = h @ params["up"]
    u += params["bias"]
    np.maximum(u, 0, out=u)
    return {"x": x, "q": q, "k": k, "v": v, "raw": raw, "a": a, "total": total, "mixed": mixed, "h": h, "u": u}


def class_scores(params: Params, previous: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray, dict]:
    """Class logits and their log-sums, a row for each place of each window."""
    s = _attended(params, previous)
    z = s["u"] @ params["out"]
    z += pairs.log_class[previous.ravel()]
    np.minimum(z, _HIGHEST, out=z)
    return z, np.log(np.exp(z).sum(axis=1)), s


def gradients(params: Params, previous: np.ndarray, wanted: np.ndarray, scored: np.ndarray, pairs: Pairs) -> tuple[float, Params]:
    """Mean loss over scored places and its gradients; ``wanted`` are classes."""
    z, logsum, s = class_scores(params, previous, pairs)
    rows, want, weight = np.arange(len(z)), wanted.ravel(), scored.ravel() / np.float32(max(int(scored.sum()), 1))
    loss = float(((logsum - z[rows, want]) * weight).sum())
    dz = np.exp(z - logsum[:, None])
    dz[rows, want] -= 1
    dz *= weight[:, None]
    g: Params = {"out": s["u"].T @ dz}
    du = (dz @ params["out"].T) * (s["u"] > 0)
    g["up"], g["bias"] = s["h"].T @ du, du.sum(axis=0)
    dh = du @ params["up"].T
    g["o"] = s["mixed"].T @ dh
    dm = (dh @ params["o"].T).reshape(s["v"].shape)
    a = s["a"] / s["total"]
    da = dm @ s["v"].transpose(0, 2, 1)
    dv = (a.transpose(0, 2, 1) @ dm).reshape(-1, WIDTH)
    da = a * (da - (da * a).sum(axis=2, keepdims=True)) * (s["raw"] < _HIGHEST)
    dq = (da @ s["k"]).reshape(-1, WIDTH) * np.float32(WIDTH**-0.5)
    dk = (da.transpose(0, 2, 1) @ s["q"]).reshape(-1, WIDTH)
    g["q"], g["k"], g["v"] = s["x"].T @ dq, s["x"].T @ dk, s["x"].T @ dv
    dx = dh + dq @ params["q"].T + dk @ params["k"].T + dv @ params["v"].T
    g["place"] = dx.reshape(-1, WINDOW, WIDTH).sum(axis=0)
    ids, back = np.unique(previous.ravel(), return_inverse=True)
    g["id"] = np.zeros_like(params["id"])
    g["id"][ids] = np.stack([np.bincount(back, weights=dx[:, c], minlength=len(ids)) for c in range(WIDTH)], axis=1)
    return loss, g


class Adam:
    """Adam steps on a copy of the parameters."""

    def __init__(self, params: Params, rate: float = 0.01):
        self.params = {n: p.copy() for n, p in params.items()}
        self.rate, self.t = rate, 0
        self.m, self.v = ({n: np.zeros_like(p) for n, p in params.items()} for _ in range(2))

    def step(self, grads: Params) -> None:
        self.t += 1
        for n, g in grads.items():
            self.m[n] += 0.1 * (g - self.m[n])
            self.v[n] += 0.01 * (g * g - self.v[n])
            self.params[n] -= (self.rate / (1 - 0.9**self.t)) * self.m[n] / (np.sqrt(self.v[n] / (1 - 0.99**self.t)) + 1e-8)


def text_windows(texts: list[np.ndarray], start_id: int, share: int = 1, seen: int = 0) -> tuple:
    """``(windows in all, owner, previous, wanted, scored)`` for texts of listed ids.

    ``previous`` begins with ``start_id``.  Only every ``share``-th window is returned, counted
    on from ``seen``.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    flat_ids = np.concatenate([np.zeros(1, np.int32), *texts]).astype(np.int32)  # a place before the first
    begins = np.cumsum(lengths) - lengths + 1
    text, first, scored_from = windows(lengths)
    many = len(text)
    if share > 1:
        text, first, scored_from = (x[(-seen) % share :: share] for x in (text, first, scored_from))
    place = first.astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
    inside = place < lengths[text].astype(np.int32)[:, None]
    at = begins[text].astype(np.int32)[:, None] + place
    at *= inside
    wanted = flat_ids[at]
    previous = flat_ids[np.maximum(at - 1, 0)]
    previous[place == 0] = start_id
    inside &= place >= scored_from.astype(np.int32)[:, None]
    return many, text, previous, wanted, inside


def score_texts(params: Params, pairs: Pairs, texts: list[np.ndarray], start_id: int, most: int = 256) -> np.ndarray:
    """``sum(log p(class | window) - log B(class | previous))`` of each text; every place is scored in exactly one window.

    The caller adds ``log B(id | previous)``, for which pair counts are needed.
    """
    _, owner, previous, wanted, scored = text_windows(texts, start_id)
    total = np.zeros(len(texts))
    for a in range(0, len(owner), most):
        prev, want = previous[a : a + most], wanted[a : a + most].ravel()
        z, logsum, _ = class_scores(params, prev, pairs)
        classes = pairs.classes[want]
        logp = z[np.arange(len(z)), classes] - logsum - pairs.log_class[prev.ravel(), classes]
        logp *= scored[a : a + most].ravel()
        total += np.bincount(owner[a : a + most], weights=logp.reshape(-1, WINDOW).sum(axis=1, dtype=float), minlength=len(texts))
    return total
