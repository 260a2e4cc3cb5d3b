"""A character tagger in numpy: bidirectional LSTM scores with transitions of a CRF.

Small by design (a few thousand numbers), so it is trained on the driver from a bounded
set of labelled spans and travels to the tasks with the function that uses it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Four kinds that patterns find too, then two that only their surroundings give away:
#: keys and passwords, and e-mail addresses written out (``name at host dot com``).
KINDS = ("email", "ip", "card", "phone", "secret", "address")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW = 96
EXAMPLE = 96
STEP = 48
#: Characters 32 to 126, line feed and tab, any other letter, any other character, padding.
SYMBOLS = 100
PAD = 0
_OTHER, _LETTER = 1, 2


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(codes >= 0xC0, _LETTER, _OTHER).astype(np.int64)
    plain = (codes >= 32) & (codes <= 126)
    out[plain] = codes[plain] - 32 + 3
    out[(codes == 10) | (codes == 9)] = 98
    return out


def tags_of(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        k = KINDS.index(kind)
        tags[start:end] = 2 + 2 * k
        tags[start] = 1 + 2 * k
    return tags


def spans_of(tags: np.ndarray) -> list[tuple[str, int, int]]:
    out, at = [], 0
    while at < len(tags):
        if tags[at] and tags[at] % 2:
            end = at + 1
            while end < len(tags) and tags[end] == tags[at] + 1:
                end += 1
            out.append((KINDS[(tags[at] - 1) // 2], at, end))
            at = end
        else:
            at += 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _lstm(p: dict, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of all steps, and what the gradient needs of them. ``x`` is steps, directions, rows,
    embedding; both directions run side by side, the second over the reversed text."""
    w, u, b = p["w"], p["u"], p["b"]
    size = u.shape[1]
    h = np.zeros((2, x.shape[2], size), x.dtype)
    c, states, kept = h.copy(), [], []
    inputs = x @ w + b[:, None, :]
    for step in inputs:
        z = step + h @ u
        gates = _sigmoid(z[..., :3 * size])
        i, f, o = gates[..., :size], gates[..., size:2 * size], gates[..., 2 * size:]
        g = np.tanh(z[..., 3 * size:])
        before, h_before = c, h
        c = f * c + i * g
        t = np.tanh(c)
        h = o * t
        states.append(h)
        if keep:
            kept.append((i, f, o, g, before, h_before, t))
    return np.stack(states), kept


def _lstm_back(p: dict, x: np.ndarray, kept: list, dh_all: np.ndarray, grad: dict) -> np.ndarray:
    u = p["u"]
    back = u.transpose(0, 2, 1)
    dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
    dz_all = np.zeros((*dh_all.shape[:3], u.shape[2]), dh_all.dtype)
    for s in range(len(kept) - 1, -1, -1):
        i, f, o, g, before, h_before, t = kept[s]
        dh = dh + dh_all[s]
        dc = dc + dh * o * (1 - t * t)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * t * o * (1 - o),
                             dc * i * (1 - g * g)], 2)
        dz_all[s] = dz
        grad["u"] += h_before.transpose(0, 2, 1) @ dz
        dh, dc = dz @ back, dc * f
    grad["w"] += (x.transpose(0, 1, 3, 2) @ dz_all).sum(0)
    grad["b"] += dz_all.sum((0, 2))
    return dz_all @ p["w"].transpose(0, 2, 1)


@dataclass
class Tagger:
    p: dict[str, np.ndarray]

    def _scores(self, rows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        x = self.p["embed"][rows.T]
        x = np.stack([x, x[::-1]], 1)
        states, kept = _lstm(self.p, x, keep)
        both = np.concatenate([states[:, 0], states[::-1, 1]], 2)
        return both @ self.p["out"] + self.p["bias"], (x, both, kept)

    def decode(self, rows: np.ndarray) -> np.ndarray:
        """Best tags of each row of symbols."""
        scores, _ = self._scores(rows)
        move = self.p["move"]
        best, came = scores[0] + self.p["begin"], []
        for s in scores[1:]:
            paths = best[:, :, None] + move
            came.append(paths.argmax(1))
            best = paths.max(1) + s
        tags = [best.argmax(1)]
        for c in reversed(came):
            tags.append(c[np.arange(len(c)), tags[-1]])
        return np.stack(tags[::-1], 1)

    def loss(self, rows: np.ndarray, tags: np.ndarray, grad: dict) -> float:
        """Mean negative log likelihood, with its gradient added to ``grad``."""
        scores, (x, both, kept) = self._scores(rows, True)
        move, begin = self.p["move"], self.p["begin"]
        steps, n, _ = scores.shape
        ahead = [scores[0] + begin]
        for s in scores[1:]:
            ahead.append(_log_sum(ahead[-1][:, :, None] + move, 1) + s)
        total = _log_sum(ahead[-1], 1)
        behind = [np.zeros_like(ahead[0])]
        for s in scores[:0:-1]:
            behind.append(_log_sum(move + (s + behind[-1])[:, None, :], 2))
        behind = behind[::-1]
        tags, lane = tags.T, np.arange(n)
        gold = begin[tags[0]] + scores[0][lane, tags[0]]
        d = np.exp(np.stack(ahead) + np.stack(behind) - total[None, :, None])
        grad["begin"] += (d[0].sum(0) - np.bincount(tags[0], minlength=TAGS)) / n
        for s in range(steps):
            if s:
                gold = gold + move[tags[s - 1], tags[s]] + scores[s][lane, tags[s]]
                pair = np.exp(ahead[s - 1][:, :, None] + move + (scores[s] + behind[s])[:, None, :]
                              - total[:, None, None])
                grad["move"] += pair.sum(0) / n
                np.subtract.at(grad["move"], (tags[s - 1], tags[s]), 1 / n)
            d[s][lane, tags[s]] -= 1
        d = (d / n).astype(both.dtype)
        flat = d.reshape(-1, TAGS)
        grad["out"] += both.reshape(-1, both.shape[2]).T @ flat
        grad["bias"] += flat.sum(0)
        dh = d @ self.p["out"].T
        size = self.p["u"].shape[1]
        dx = _lstm_back(self.p, x, kept, np.stack([dh[..., :size], dh[::-1, :, size:]], 1), grad)
        dx = dx[:, 0] + dx[::-1, 1]
        np.add.at(grad["embed"], rows.T.ravel(), dx.reshape(-1, dx.shape[2]))
        return float((total - gold).mean())


def new_tagger(embedding: int = 14, hidden: int = 20, seed: int = 7) -> Tagger:
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    # Kinds of characters are told apart from the start; what they mean is learned.
    embed = rng.standard_normal((SYMBOLS, embedding)).astype(np.float32) * 0.1
    kinds = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "@", ".", "-", " ", "+", "()", ",;:!?", "=\"'", "[]_")
    for k, kind in enumerate(kinds[:embedding]):
        embed[[ord(c) - 32 + 3 for c in kind], k] = 2
    p = {"embed": embed,
         "out": draw(2 * hidden, TAGS), "bias": np.zeros(TAGS, np.float32),
         "move": np.zeros((TAGS, TAGS), np.float32), "begin": np.zeros(TAGS, np.float32)}
    forget = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
    p |= {"w": np.stack([draw(embedding, 4 * hidden) for _ in range(2)]),
          "u": np.stack([draw(hidden, 4 * hidden) for _ in range(2)]), "b": np.stack([forget, forget])}
    for tag in range(2, TAGS, 2):  # an inside tag follows its own begin or inside
        p["begin"][tag] = -1e4
        p["move"][:, tag] = -1e4
        p["move"][[tag - 1, tag], tag] = 0
    return Tagger(p)


def train(
    examples: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 14, batch: int = 24,
    rate: float = 0.03, seed: int = 7,
) -> Tagger:
    """Fit on texts of at most ``EXAMPLE`` characters with their labelled spans (Adam)."""
    rows = np.full((len(examples), EXAMPLE), PAD, np.int64)
    tags = np.zeros((len(examples), EXAMPLE), np.int64)
    for k, (text, spans) in enumerate(examples):
        known = symbols(text[:EXAMPLE])
        rows[k, :len(known)] = known
        tags[k] = tags_of(EXAMPLE, [x for x in spans if x[2] <= EXAMPLE])
    model = new_tagger(seed=seed)
    fixed = model.p["move"] < -1e3
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    rng, t = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part, t = order[at:at + batch], t + 1
            grad = {k: np.zeros_like(x) for k, x in model.p.items()}
            model.loss(rows[part], tags[part], grad)
            grad["move"][fixed] = 0
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step = rate * (1 - epoch / epochs) * min(1.0, 5 / (norm + 1e-9))
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                model.p[k] -= (step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return model
