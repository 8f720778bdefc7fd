"""Segmentation lattices of many words at once: log-space forward and backward sums over all ways to cut a word into pieces.

Words of one length (in characters) form a matrix; a hashed trie of the vocabulary gives the pieces at every place of all
of them in one step per piece length. A character that is no piece is spelled by its UTF-8 byte pieces. Very long words
go in stretches, whose sums carry over: memory beside a stretch is a number for each character.
"""

from __future__ import annotations

import numpy as np

#: Words handled at once; fewer of very long ones.
TOGETHER = 20_000
#: Characters of a stretch of a word that is longer.
STRETCH = 16_384
START = "▁"


class Vocabulary:
    """Pieces, byte pieces and prior log probabilities of a sentencepiece model."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        byte = [i for i in ids if sp.is_byte(i)]
        score = np.array([sp.get_score(i) for i in plain])
        self.pieces = [sp.id_to_piece(i) for i in plain]
        self.n, self.first_byte = len(plain) + 256, len(plain)
        self.prior = np.full(self.n, np.nan)
        if score.min(initial=0) < -1000:  # scores are ranks, as of merges: Zipf's law makes them probabilities
            self.prior[: len(plain)] = 1 / (10.0 - score)
        else:
            self.prior[: len(plain)] = np.exp(score)
        self.prior[self.first_byte :] = self.prior[: len(plain)].sum() / 100 / 256 if len(byte) == 256 or not byte else np.nan
        self.prior /= self.prior.sum()
        self._trie()

    def _trie(self) -> None:
        chars = sorted({c for p in self.pieces for c in p})
        self.chars = np.zeros(0x110000, np.int32)
        self.chars[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        step = {c: i + 1 for i, c in enumerate(chars)}
        self.width, nodes, ends, self.longest = len(chars) + 1, {}, {}, 1
        for i, p in enumerate(self.pieces):
            at = 0
            for c in p:
                at = nodes.setdefault(at * self.width + step[c], len(nodes) + 1)
            ends[at] = i
            self.longest = max(self.longest, len(p))
        self.ends = np.full(len(nodes) + 1, -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        key, value = np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int32)
        size = 1 << int(np.ceil(np.log2(4 * len(key) + 16)))
        self.mask, self.keys, self.values = size - 1, np.full(size, -1, np.int64), np.zeros(size, np.int32)
        slot, left = self._slot(key), np.arange(len(key))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]] = key[left[free]]
            self.values[slot[left[free]]] = value[left[free]]
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(30)).astype(np.int64) & self.mask

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie's next states; -1 where there is none."""
        key = state.astype(np.int64) * self.width + char
        slot, out = self._slot(key), np.full(len(key), -1, np.int32)
        left = np.flatnonzero((state >= 0) & (char > 0))
        for _ in range(self.probes):
            found = self.keys[slot[left]]
            hit = found == key[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
        return out


def _groups(words: list[str]):
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        for i in range(0, len(rows), each := max(1, min(TOGETHER, 600_000 // int(n)))):
            yield int(n), rows[i : i + each]


class Lattice:
    """Edges of words of equal length: piece[l][:, i] begins at i and has l + 1 characters, -1 for none; spelled marks byte spellings."""

    def __init__(self, v: Vocabulary, words: list[str], logp: np.ndarray):
        self.v, n = v, len(words[0])
        self.code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
        char = v.chars[self.code]
        state, self.piece, self.score = np.zeros(char.shape, np.int32), [], []
        for size in range(min(v.longest, n)):
            wide = n - size
            state = v.step(state[:, :wide].ravel(), char[:, size:].ravel()).reshape(-1, wide)
            if (state < 0).all():
                break
            piece = np.where(state >= 0, v.ends[state], -1)
            self.piece.append(piece)
            self.score.append(np.where(piece >= 0, logp[piece], -np.inf))
        if not self.piece:
            self.piece, self.score = [np.full(char.shape, -1, np.int32)], [np.full(char.shape, -np.inf)]
        self.spelled = self.piece[0] < 0
        if self.spelled.any():
            codes, at = np.unique(self.code[self.spelled], return_inverse=True)
            self.score[0] = self.score[0].copy()
            self.score[0][self.spelled] = np.array([logp[self.bytes_of(c)].sum() for c in codes])[at]
        self.n = n

    def bytes_of(self, code: int) -> list[int]:
        return [self.v.first_byte + b for b in chr(code).encode("utf-8", "surrogatepass")]

    def forward(self, known: np.ndarray | None = None) -> np.ndarray:
        """Log sums (words, n + 1) over all segmentations of each prefix. known: those of the first places."""
        a = np.full((len(self.code), self.n + 1), -np.inf)
        known = np.zeros((len(self.code), 1)) if known is None else known
        a[:, : known.shape[1]] = known
        for j in range(known.shape[1], self.n + 1):
            a[:, j] = _logsum([a[:, j - 1 - m] + self.score[m][:, j - 1 - m] for m in range(min(j, len(self.score)))])
        return a

    def backward(self, known: np.ndarray | None = None) -> np.ndarray:
        """Log sums over all segmentations of what follows each place. known: those of the last places."""
        b = np.full((len(self.code), self.n + 1), -np.inf)
        known = np.zeros((len(self.code), 1)) if known is None else known
        b[:, self.n + 1 - known.shape[1] :] = known
        for i in range(self.n - known.shape[1], -1, -1):
            b[:, i] = _logsum([b[:, i + 1 + m] + self.score[m][:, i] for m in range(min(self.n - i, len(self.score)))])
        return b

    def expected(self, weight: np.ndarray) -> np.ndarray:
        """How often each piece is expected, over words that come weight times."""
        a = self.forward()
        return self.counted(a, self.backward(), a[:, -1:], weight, self.n)

    def counted(self, a: np.ndarray, b: np.ndarray, total: np.ndarray, weight: np.ndarray, upto: int) -> np.ndarray:
        """Expected pieces that begin before the place upto, given the sums before and after each place and those of whole words."""
        out = np.zeros(self.v.n)
        for m, (piece, score) in enumerate(zip(self.piece, self.score, strict=True)):
            wide = min(upto, self.n - m)
            post = np.exp(a[:, :wide] + score[:, :wide] + b[:, m + 1 : m + 1 + wide] - total) * weight[:, None]
            used = piece[:, :wide] >= 0
            out += np.bincount(piece[:, :wide][used], post[used], self.v.n)
            if m == 0 and (spelled := self.spelled[:, :wide]).any():
                codes, at = np.unique(self.code[:, :wide][spelled], return_inverse=True)
                for c, w in zip(codes, np.bincount(at, post[spelled]), strict=True):
                    np.add.at(out, self.bytes_of(c), w)
        return out


class LongWord:
    """One word in stretches."""

    def __init__(self, v: Vocabulary, word: str, logp: np.ndarray, stretch: int | None = None):
        self.v, self.word, self.logp, self.stretch = v, word, logp, max(stretch or STRETCH, v.longest)
        self.starts = range(0, len(word), self.stretch)

    def forward(self) -> np.ndarray:
        """Log sums over all segmentations of each prefix."""
        a = np.zeros(len(self.word) + 1)
        for s in self.starts:
            begin, end = max(0, s - self.v.longest), min(len(self.word), s + self.stretch)
            a[begin : end + 1] = Lattice(self.v, [self.word[begin:end]], self.logp).forward(a[None, begin : s + 1])[0]
        return a

    def expected(self, weight: float) -> np.ndarray:
        a, out, after = self.forward(), np.zeros(self.v.n), np.zeros((1, 1))
        for s in reversed(self.starts):
            end = min(len(self.word), s + self.stretch)
            stop = min(len(self.word), end + self.v.longest)
            own = Lattice(self.v, [self.word[s:stop]], self.logp)
            b = own.backward(after[:, : stop - end + 1])
            out += own.counted(a[None, s : stop + 1], b, a[None, -1:], np.array([weight]), end - s)
            after = b[:, : self.v.longest + 1]
        return out


def _logsum(terms: list[np.ndarray]) -> np.ndarray:
    x = np.stack(terms)
    top = x.max(0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - safe).sum(0))


def marginals(v: Vocabulary, logp: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log probability of each word, summed over all segmentations; words begin with START."""
    out = np.zeros(len(words))
    for n, rows in _groups(words):
        if n > STRETCH:
            out[rows] = [LongWord(v, words[i], logp).forward()[-1] for i in rows]
        else:
            out[rows] = Lattice(v, [words[i] for i in rows], logp).forward()[:, -1]
    return out


def expectations(v: Vocabulary, logp: np.ndarray, words: list[str], weight: np.ndarray) -> np.ndarray:
    out = np.zeros(v.n)
    for n, rows in _groups(words):
        if n > STRETCH:
            out += sum(LongWord(v, words[i], logp).expected(weight[i]) for i in rows)
        else:
            out += Lattice(v, [words[i] for i in rows], logp).expected(weight[rows])
    return out
