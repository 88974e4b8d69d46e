"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Arrays are laid out (units, windows), so that each gate is one block of memory.
An input character picks a column of a table, which stands for its embedding and
the input weights at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Codes: ASCII as it is, all other characters 128; a line break pads.
SYMBOLS, BREAK = 129, 10


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((points > 127) | (points == 0), 128, points).astype(np.uint8)


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid.  All bounds here are cheap ones; they learn as well."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _slope(gate: np.ndarray) -> np.ndarray:
    return 0.25 * ((gate > 0) & (gate < 1))


@dataclass
class Tagger:
    tags: int
    hidden: int = 12
    seed: int = 11
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng, h = np.random.default_rng(self.seed), self.hidden
        for side in "fb":
            self.p[f"in_{side}"] = rng.normal(0, 0.3, (4 * h, SYMBOLS))
            self.p[f"in_{side}"][h : 2 * h] += 1.0  # forget gates start open
            self.p[f"rec_{side}"] = rng.normal(0, 1 / np.sqrt(h), (4 * h, h))
            self.p[f"out_{side}"] = rng.normal(0, 0.3, (self.tags, h))
        self.p["bias"] = np.zeros((self.tags, 1))
        self.p["move"] = np.zeros((self.tags, self.tags))

    # -- learning -------------------------------------------------------------

    def _run(self, side: str, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """x: (steps, windows).  What each step needs again on the way back."""
        h_units, table, rec = self.hidden, self.p[f"in_{side}"], self.p[f"rec_{side}"]
        h = c = np.zeros((h_units, x.shape[1]))
        kept = []
        for at in x if side == "f" else x[::-1]:
            z = table[:, at] + rec @ h
            i, f, o = (_gate(z[k * h_units : (k + 1) * h_units]) for k in range(3))
            g = np.clip(z[3 * h_units :], -1, 1)
            old_c, old_h = c, h
            c = f * c + i * g
            t = 1 / (1 + np.abs(c))
            h = o * c * t
            kept.append((at, i, f, o, g, old_c, old_h, c, t, h))
        return kept

    def _back(self, side: str, kept: list[tuple[np.ndarray, ...]], d_out: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        h_units, rec = self.hidden, self.p[f"rec_{side}"]
        steps = d_out if side == "f" else d_out[::-1]
        dh = dc = np.zeros_like(kept[0][9])
        for (at, i, f, o, g, old_c, old_h, c, t, h), de in zip(reversed(kept), steps[::-1], strict=True):
            grad[f"out_{side}"] += de @ h.T
            dh = dh + self.p[f"out_{side}"].T @ de
            dc = dc + dh * o * t * t
            dz = np.concatenate([dc * g * _slope(i), dc * old_c * _slope(f), dh * c * t * _slope(o), dc * i * (np.abs(g) < 1)])
            grad[f"rec_{side}"] += dz @ old_h.T
            one_hot = np.zeros((SYMBOLS, len(at)))
            one_hot[at, np.arange(len(at))] = 1
            grad[f"in_{side}"] += dz @ one_hot.T
            dh, dc = rec.T @ dz, dc * f
        assert h_units == dh.shape[0]

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags ``y`` and its gradient; x and y: (steps, windows)."""
        steps, n = x.shape
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        forward, backward = self._run("f", x), self._run("b", x)[::-1]
        e = np.stack([self.p["out_f"] @ a[9] + self.p["out_b"] @ b[9] + self.p["bias"] for a, b in zip(forward, backward, strict=True)])
        move = self.p["move"][:, :, None]
        logsum = lambda z, axis: np.log(np.exp(z - z.max(axis, keepdims=True)).sum(axis)) + z.max(axis)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = logsum(alpha[t - 1][:, None] + move, 0) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = logsum(move + (e[t + 1] + beta[t + 1])[None], 1)
        z = logsum(alpha[-1], 0)
        d = np.exp(alpha + beta - z)
        rows, cols = np.arange(steps)[:, None], np.arange(n)[None]
        total = z - e[rows, y, cols].sum(0) - self.p["move"][y[:-1], y[1:]].sum(0)
        d[rows, y, cols] -= 1
        for t in range(1, steps):
            grad["move"] += np.exp(alpha[t - 1][:, None] + move + (e[t] + beta[t])[None] - z).sum(2)
        np.add.at(grad["move"], (y[:-1], y[1:]), -1)
        grad["bias"] = d.sum((0, 2))[:, None]
        self._back("f", forward, d, grad)
        self._back("b", backward[::-1], d, grad)
        return float(total.mean()), {k: v / n for k, v in grad.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, *, epochs: int = 3, batch: int = 64, rate: float = 0.02) -> list[float]:
        """Adam with clipped gradients; x and y: (steps, windows)."""
        rng = np.random.default_rng(self.seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        losses, t, rounds = [], 0, epochs * -(-x.shape[1] // batch)
        for _ in range(epochs):
            order = rng.permutation(x.shape[1])
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                value, grad = self.loss(x[:, part], y[:, part])
                losses.append(value)
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                t += 1
                step = rate * (1 - 0.9 * t / rounds)
                for k, g in grad.items():
                    g = g * min(1, 5 / (size + 1e-9))
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return losses

    # -- use ------------------------------------------------------------------

    def ready(self) -> Reader:
        return Reader(self)


class Reader:
    """The trained weights in single precision, the gates' line folded into them."""

    #: Characters that a window decides on, and that it sees beside them on each side.
    CORE, MARGIN, BATCH = 240, 16, 1024

    def __init__(self, tagger: Tagger):
        h = self.hidden = tagger.hidden
        slope, level = np.ones((4 * h, 1)), np.zeros((4 * h, 1))
        slope[: 3 * h], slope[3 * h :], level[:] = 0.25, 0.5, 0.5
        # A row for each character: whole rows are gathered fastest.
        self.table = [np.ascontiguousarray((tagger.p[f"in_{s}"] * slope + level).T, np.float32) for s in "fb"]
        self.rec = [(tagger.p[f"rec_{s}"] * slope).astype(np.float32) for s in "fb"]
        self.out = [tagger.p[f"out_{s}"].astype(np.float32) for s in "fb"]
        self.bias = tagger.p["bias"].astype(np.float32)
        self.move = tagger.p["move"].astype(np.float32)

    def _side(self, k: int, x: np.ndarray) -> np.ndarray:
        h_units, n = self.hidden, x.shape[1]
        h, c = np.zeros((2, h_units, n), np.float32)
        out = np.empty((len(x), len(self.out[k]), n), np.float32)
        order = range(len(x)) if k == 0 else range(len(x) - 1, -1, -1)
        for t in order:
            z = self.rec[k] @ h
            z += np.take(self.table[k], x[t], axis=0, mode="clip").T
            np.clip(z, 0, 1, out=z)
            new = z[3 * h_units :]
            new *= 2
            new -= 1
            c = z[h_units : 2 * h_units] * c
            c += z[:h_units] * new
            h = np.abs(c)
            h += 1
            np.divide(c, h, out=h)
            h *= z[2 * h_units : 3 * h_units]
            np.matmul(self.out[k], h, out=out[t])
        return out

    def emissions(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """(tags, characters) for each text, each character from the window that centres on it."""
        core, margin = self.CORE, self.MARGIN
        counts = [-(-len(t) // core) for t in texts]
        windows = np.zeros((sum(counts), core + 2 * margin), np.uint8)
        at = 0
        for t, n in zip(texts, counts, strict=True):
            if not n:
                continue
            padded = np.full(n * core + 2 * margin, BREAK, np.uint8)
            padded[margin : margin + len(t)] = t
            windows[at : at + n] = np.lib.stride_tricks.sliding_window_view(padded, core + 2 * margin)[::core]
            at += n
        parts = []
        for i in range(0, len(windows), self.BATCH):
            x = windows[i : i + self.BATCH].T.astype(np.intp)
            e = self._side(0, x)
            e += self._side(1, x)
            e += self.bias
            parts.append(e[margin : margin + core].transpose(1, 2, 0).reshape(len(self.bias), -1))
        flat = np.concatenate(parts, 1) if parts else np.zeros((len(self.bias), 0), np.float32)
        out, at = [], 0
        for t, n in zip(texts, counts, strict=True):
            out.append(flat[:, at : at + len(t)])
            at += n * core
        return out

    def spans(self, emissions: list[np.ndarray], gap: int = 48) -> list[list[tuple[int, int, int, float]]]:
        """(start, end, tag, mean lead over no tag) by the best path over each text's windows joined.

        Before and after a text there is no tag.  A place is idle if its best tag trails
        no tag by more than the moves can make up for, and by ``least`` besides.  The
        best path begins and ends no span at an idle place, and leaves no tag on ``gap``
        idle places in a row: carrying a tag over them costs more than ending it and
        beginning anew.  So only what lies between such gaps is decoded, with no tag
        on either side, and the path is that over the whole text.  Nor is it decoded
        where all gains of its places together don't pay for beginning and ending a span.
        """
        inside, idle = float(self.move[1:, 1:].max()), float(self.move[0, 0])
        into, out = self.move[0, 1:], self.move[1:, 0]
        slack = max(0.0, float(np.ptp(into)), float(np.ptp(out)), float(into.max() + out.max()) - idle - inside)
        least = max(0.0, inside + idle - float(into.min() + out.min())) / gap
        makes_up = np.float32(slack + least + 1e-3)
        ends_cost = inside + idle - float(into.max() + out.max()) - 1e-3
        found: list[list[tuple[int, int, int, float]]] = [[] for _ in emissions]
        stretches = []
        for k, e in enumerate(emissions):
            best = e[1]
            for row in e[2:]:
                best = np.maximum(best, row)
            gain = best - e[0] + np.float32(inside - idle)
            active = np.flatnonzero(gain > -makes_up)
            if not len(active):
                continue
            cuts = np.flatnonzero(np.diff(active) > gap)
            starts, ends = active[np.append(0, cuts + 1)], active[np.append(cuts, len(active) - 1)]
            # Idle places gain nothing, so a stretch's gains are those of its active ones.
            gains = np.add.reduceat(np.maximum(gain[active], 0), np.append(0, cuts + 1), dtype=float)
            stretches += [(k, s, t + 1) for s, t, g in zip(starts, ends, gains, strict=True) if g > ends_cost]
        stretches.sort(key=lambda s: s[2] - s[1])
        for i in range(0, len(stretches), 256):
            part = stretches[i : i + 256]
            steps = max(t - s for _, s, t in part)
            grid = np.full((steps, len(part), self.move.shape[0]), -1e6, np.float32)
            grid[:, :, 0] = 0
            for j, (k, s, t) in enumerate(part):
                grid[: t - s, j] = emissions[k][:, s:t].T
            for j, path in enumerate(self._best(grid)):
                k, s, t = part[j]
                edges = np.flatnonzero(np.diff(path[: t - s], prepend=0, append=0))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    if tag := int(path[a]):
                        e = emissions[k][:, s + a : s + b]
                        found[k].append((int(s + a), int(s + b), tag, float((e[tag] - e[0]).mean())))
        return [sorted(f) for f in found]

    def _best(self, e: np.ndarray) -> np.ndarray:
        score, back = e[0] + self.move[0], []
        for row in e[1:]:
            all_moves = score[:, :, None] + self.move[None]
            back.append(all_moves.argmax(1))
            score = all_moves.max(1) + row
        path = [(score + self.move[:, 0]).argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(b)), path[-1]])
        return np.array(path[::-1]).T
