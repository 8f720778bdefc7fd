"""What tokenizing functions share: texts cut where no token reaches over, and a bounded memory of what was made of words."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence

from .tokens import CUT, _uneven

#: Bytes of words and results that a worker keeps, what an entry takes besides, and the marks of words met once.
CACHE_BYTES, ENTRY_BYTES, MARKS = 48 << 20, 250, 1 << 22
#: Bytes of texts that go to a library at once.
LOT_BYTES = 128 << 10


def cut(text: str) -> list[str]:
    """Splits where a single space stands between characters that aren't white space, without it. No token of a byte-level
    or sentence-piece vocabulary reaches over such a place from the left, as their tokens hold spaces in front only."""
    return CUT.split(text) if _uneven(text) else text.split(" ")


def lots(texts: Sequence[str | bytes], most: int = LOT_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about the same bytes: as many as fit, one at least."""
    begin = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield begin, i
            begin, held = i, 0
        held += len(t) + 16
    if begin < len(texts):
        yield begin, len(texts)


class Memo:
    """Results of words that come again are kept, up to so many bytes; then all are dropped and gathered anew.

    make: from a list of distinct words to a list of their results, none of them None."""

    def __init__(self, make: Callable[[list], list], most: int = CACHE_BYTES):
        self.make, self.most = make, most
        self.known: dict[Hashable, object] = {}
        self.met, self.held = bytearray(MARKS), 0

    def of(self, words: list) -> list:
        if self.held > self.most:
            self.known, self.held = {}, 0
        out = list(map(self.known.get, words))
        missed = [i for i, x in enumerate(out) if x is None]
        new = list(dict.fromkeys(words[i] for i in missed))
        found = dict(zip(new, self.make(new), strict=True))
        for i in missed:
            out[i] = found[words[i]]
        marks, last = self.met, MARKS - 1
        for word, own in found.items():
            at = hash(word) & last
            if marks[at]:
                self.known[word] = own
                self.held += len(word) + ENTRY_BYTES
            else:
                marks[at] = 1
        return out
