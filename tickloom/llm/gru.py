"""A bidirectional gated recurrent network over bytes in numpy: a label for every position, trained by backpropagation through time.

Gates are piecewise linear (clipped to 0..1, the candidate to -1..1), which keeps long texts cheap. Long texts are cut into
segments that are run in step; both directions begin CONTEXT bytes outside of a segment, so that its states are settled.
"""

from __future__ import annotations

import numpy as np

HIDDEN, SEGMENT, CONTEXT, TOGETHER = 12, 256, 16, 2048
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Byte that pads segments.
PAD = 0


class BiGru:
    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.h = labels, hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[f"u{d}"] = rng.normal(0, 0.3 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
            self.p[f"c{d}"] = np.concatenate([np.full(2 * hidden, 0.5), np.zeros(hidden)]).astype(np.float32)
        self.p["w"] = rng.normal(0, 0.2, (2 * hidden, len(labels))).astype(np.float32)
        self.p["o"] = np.zeros(len(labels), np.float32)

    def _states(self, x: np.ndarray, d: str, live: np.ndarray | None = None, keep: list | None = None) -> np.ndarray:
        """States (steps, texts, hidden) of one direction over x (steps, texts); live: how many texts go on at each step."""
        h, steps = self.h, len(x)
        table, u = self.p[f"x{d}"] + self.p[f"c{d}"], self.p[f"u{d}"]
        out, s = np.zeros((steps, x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            n = x.shape[1] if live is None else live[t]
            now = s[:n]
            a, g = table.take(x[t, :n], 0), now @ u
            gates = a[:, : 2 * h] + g[:, : 2 * h]
            open_ = np.clip(gates, 0, 1)
            r, z = open_[:, :h], open_[:, h:]
            pre = a[:, 2 * h :] + r * g[:, 2 * h :]
            c = np.clip(pre, -1, 1)
            new = c + z * (now - c)
            if keep is not None:
                keep.append((t, now.copy(), g[:, 2 * h :], gates, r, z, pre, c))
            s[:n] = new
            out[t, :n] = new
        return out

    def _softmax(self, hf: np.ndarray, hb: np.ndarray) -> np.ndarray:
        y = hf @ self.p["w"][: self.h] + hb @ self.p["w"][self.h :] + self.p["o"]
        y -= y.max(-1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(-1, keepdims=True)
        return y

    def positions(self, x: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities (steps, texts, labels)."""
        return self._softmax(self._states(x, "f", live), self._states(x, "b", live))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients; y: a label for each text; weight (steps, texts) of the positions."""
        keep: dict[str, list] = {"f": [], "b": []}
        hs = {d: self._states(x, d, None, keep[d]) for d in "fb"}
        prob, total = self._softmax(hs["f"], hs["b"]), max(weight.sum(), 1)
        own = prob[:, np.arange(len(y)), y]
        loss = float(-(np.log(own + 1e-9) * weight).sum() / total)
        delta = prob
        delta[:, np.arange(len(y)), y] -= 1
        delta *= (weight / total)[:, :, None]
        flat, h = delta.reshape(-1, delta.shape[2]), self.h
        grad = {"w": np.concatenate([hs[d].reshape(-1, h).T @ flat for d in "fb"]), "o": flat.sum(0)}
        for i, d in enumerate("fb"):
            back, u = delta @ self.p["w"][i * h : (i + 1) * h].T, self.p[f"u{d}"]
            gx, gu, carry = np.zeros((256, 3 * h), np.float32), np.zeros_like(u), np.zeros((x.shape[1], h), np.float32)
            for t, before, g, gates, r, z, pre, c in reversed(keep[d]):
                dh = back[t] + carry
                dpre = dh * (1 - z) * (np.abs(pre) < 1)
                dgates = np.concatenate([dpre * g, dh * (before - c)], 1) * ((gates > 0) & (gates < 1))
                dg = np.concatenate([dgates, dpre * r], 1)
                gu += before.T @ dg
                np.add.at(gx, x[t], np.concatenate([dgates, dpre], 1))
                carry = dh * z + dg @ u.T
            grad |= {f"x{d}": gx, f"u{d}": gu, f"c{d}": gx.sum(0)}
        return loss, grad

    def train(self, texts: list[bytes], y: np.ndarray, steps: int = 300, size: int = 160, width: int = 40, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over random windows of the texts, drawn evenly by label."""
        rng, m, v, losses = np.random.default_rng(seed), {}, {}, []
        by = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        for i in range(1, steps + 1):
            rows = np.array([rng.choice(by[k]) for k in rng.integers(0, len(by), size)])
            x = np.full((width, size), PAD, np.uint8)
            for j, r in enumerate(rows):
                at = rng.integers(0, max(1, len(texts[r]) - width))
                part = np.frombuffer(texts[r][at : at + width], np.uint8)
                x[: len(part), j] = part
            loss, grad = self.gradients(x, y[rows], (x != PAD).astype(np.float32) * (0.1 + 0.9 * LETTER[x]))
            losses.append(loss)
            scale = min(1.0, 1.0 / (np.sqrt(sum(float((g**2).sum()) for g in grad.values())) + 1e-9))
            now = rate * min(1.0, 2 * (1 - i / (steps + 1)))
            for k, g in grad.items():
                g = g * scale
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-6)).astype(np.float32)
        return losses

    def label(self, texts: list[bytes], runs: bool = False) -> list[tuple[np.ndarray, np.ndarray, list | None]]:
        """For each text: mean label probabilities over its letters (over all bytes if it has none), how often each label is
        the likeliest of a position, and with runs the labelled byte ranges (start, end, label)."""
        owner, start, begin, size, inner = [], [], [], [], []
        for i, t in enumerate(texts):
            at = np.arange(0, max(len(t), 1), SEGMENT)
            owner.append(np.full(len(at), i))
            start.append(at)
            begin.append(np.maximum(at - CONTEXT, 0))
            size.append(np.minimum(len(t), at + SEGMENT + CONTEXT) - begin[-1])
            inner.append(np.minimum(len(t) - at, SEGMENT))
        owner, start, begin, size, inner = (np.concatenate(x) if x else np.empty(0, int) for x in (owner, start, begin, size, inner))
        order = np.argsort(-size, kind="stable")
        k = len(self.labels)
        sums, votes, marks = np.zeros((len(texts), k + 1)), np.zeros((len(texts), k), np.int64), [[] for _ in texts]
        for a in range(0, len(order), TOGETHER):
            own = order[a : a + TOGETHER]
            n = size[own]
            x = np.zeros((max(int(n[0]), 1), len(own)), np.uint8)
            for j, s in enumerate(own):
                x[: n[j], j] = np.frombuffer(texts[owner[s]], np.uint8, n[j], begin[s])
            live = np.searchsorted(-n, -np.arange(len(x)), side="left")
            prob = self.positions(x, live)
            lead, place = start[own] - begin[own], np.arange(len(x))[:, None]
            there = (place >= lead) & (place < lead + inner[own])
            best = prob.argmax(2)
            weight = np.where(LETTER[x], 1.0, 1e-6).astype(np.float32) * there
            np.add.at(sums, owner[own], np.concatenate([np.einsum("tbk,tb->bk", prob, weight), weight.sum(0)[:, None]], 1))
            np.add.at(votes, owner[own], np.stack([((best == c) & there & LETTER[x]).sum(0) for c in range(k)], 1))
            if runs:
                for j, s in enumerate(own):
                    b = best[lead[j] : lead[j] + inner[s], j]
                    cut = np.flatnonzero(np.diff(b)) + 1
                    marks[owner[s]] += [(int(start[s] + p), int(start[s] + q), int(b[p])) for p, q in zip([0, *cut], [*cut, len(b)], strict=True) if q > p]
        mean = sums[:, :k] / np.maximum(sums[:, k:], 1e-12)
        return [(mean[i], votes[i], sorted(marks[i]) if runs else None) for i in range(len(texts))]
