"""FLAC streams in numpy: frames of a batch are coded and decoded in step, one array operation for all of them.

Encoder: mono, 8 bits, blocks of 192 samples; constant, verbatim, fixed (order 0-2) and linear-prediction (order 4)
subframes with Rice residuals. Decoder: mono streams of 8 or 16 bits, any block size, fixed and linear predictors of
any order, Rice partitions of both kinds with escapes, wasted bits; CRC-8 of headers, CRC-16 of frames and the MD5 of
the samples are verified. Frames are found by their sync codes, header checksums and running numbers.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np

BLOCK, RATE = 192, 8000
#: Frames coded in step; bounds the memory for any length of text.
SLICE = 8192
LPC_ORDER, LPC_SHIFT = 4, 6
# Fixed values of the format: block size codes and the coefficients of its fixed predictors.
BLOCK_CODES = {1: 192, **{n: 576 << (n - 2) for n in range(2, 6)}, **{n: 256 << (n - 8) for n in range(8, 16)}}
FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


class FlacError(ValueError):
    pass


def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask, out = 1 << (bits - 1), (1 << bits) - 1, []
    for c in range(256):
        c <<= bits - 8
        for _ in range(8):
            c = ((c << 1) ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, np.int32)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc(data: np.ndarray, start: np.ndarray, length: np.ndarray, bits: int) -> np.ndarray:
    """Checksums of many byte ranges, in step. Longest first, so that ended ranges fall away."""
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    crc, t = np.zeros(len(start), np.int32), CRC16 if bits == 16 else CRC8
    live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
    for i, n in enumerate(live):
        c = crc[:n]
        crc[:n] = ((c << 8) & 0xFFFF) ^ t[(c >> 8) ^ data[start[:n] + i]] if bits == 16 else t[c ^ data[start[:n] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _lpc(x: np.ndarray) -> np.ndarray:
    """Quantized coefficients (frames, order) by the Levinson-Durbin recursion."""
    r = np.stack([np.einsum("ij,ij->i", x[:, : BLOCK - lag], x[:, lag:]) for lag in range(LPC_ORDER + 1)], 1).astype(np.float64)
    err, a = r[:, 0] * 1.0001 + 1e-9, np.zeros((len(x), LPC_ORDER))
    for i in range(LPC_ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / err
        a[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a[:, i] = k
        err = np.maximum(err * (1 - k * k), 1e-9)
    return np.clip(np.rint(a * (1 << LPC_SHIFT)), -128, 127).astype(np.int32)


def _frames(x: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coded frames of (frames, BLOCK) signed samples: their bytes, and each frame's length."""
    n = len(x)
    q = _lpc(x.astype(np.float32))
    guess = sum(q[:, i : i + 1] * x[:, LPC_ORDER - 1 - i : BLOCK - 1 - i] for i in range(LPC_ORDER)) >> LPC_SHIFT
    kinds = [(x, 0), (np.diff(x), 1), (np.diff(x, 2), 2), (x[:, LPC_ORDER:] - guess, LPC_ORDER)]
    cost, ks, us = [], [], []
    for res, order in kinds:
        u = (res << 1) ^ (res >> 31)
        k = np.clip(np.log2(np.maximum(u.mean(1) * 0.7, 1)), 0, 14).astype(np.int32)
        cost.append((u >> k[:, None]).sum(1) + res.shape[1] * (k + 1) + 8 * order + 18 + (9 + 8 * LPC_ORDER) * (order == LPC_ORDER))
        ks.append(k)
        us.append(u)
    best = np.argmin(cost, 0)
    kind = np.where((x == x[:, :1]).all(1), 5, np.where(np.min(cost, 0) >= 8 + 8 * BLOCK, 4, best))
    length = np.where(kind == 5, 16, np.where(kind == 4, 8 + 8 * BLOCK, np.min(cost, 0))).astype(np.int64)
    digits = 1 + (number >= 0x80) + (number >= 0x800) + (number >= 0x10000) + (number >= 0x200000)
    size = 4 + digits + 1 + (length + 7) // 8 + 2
    at = np.cumsum(size) - size
    bits = np.zeros(int(size.sum()) * 8, np.uint8)

    def put(rows: np.ndarray, value: np.ndarray, width, zeros: np.ndarray | int = 0) -> None:
        ends = (8 * (at[rows] + 5 + digits[rows]))[:, None] + np.cumsum(np.broadcast_to(np.asarray(width) + zeros, value.shape), 1)
        for j in range(int(value.max(initial=0)).bit_length()):
            bits[ends[(value >> j) & 1 == 1] - 1 - j] = 1

    for k in range(6):
        rows = np.flatnonzero(kind == k)
        if not len(rows):
            continue
        s = x[rows] & 0xFF
        if k >= 4:
            put(rows, np.concatenate([np.full((len(rows), 1), 2 if k == 4 else 0), s if k == 4 else s[:, :1]], 1), 8)
            continue
        order, u, p = kinds[k][1], us[k][rows], ks[k][rows][:, None]
        head, width = [np.full((len(rows), 1), (8 + order if order < LPC_ORDER else 31 + order) << 1), s[:, :order]], [8] * (1 + order)
        if order == LPC_ORDER:
            head += [np.full((len(rows), 1), 7), np.full((len(rows), 1), LPC_SHIFT), q[rows] & 0xFF]
            width += [4, 5] + [8] * order
        head.append(p)
        value = np.concatenate([*head, (1 << p) | (u & ((1 << p) - 1))], 1)
        zeros = np.concatenate([np.zeros((len(rows), len(width) + 1), np.int32), u >> p], 1)
        widths = np.concatenate([np.broadcast_to(np.array([*width, 10], np.int32), (len(rows), len(width) + 1)), np.broadcast_to(p + 1, u.shape)], 1)
        put(rows, value, widths, zeros)
    out = np.packbits(bits)
    for i, b in enumerate((0xFF, 0xF8, 0x14, 0x02)):
        out[at + i] = b
    for d in range(1, 6):
        rows = np.flatnonzero(digits == d)
        for i in range(d if len(rows) else 0):
            part = number[rows] >> (6 * (d - 1 - i))
            out[at[rows] + 4 + i] = (part & 0x3F) | 0x80 if i else (part if d == 1 else part | ((0xF00 >> d) & 0xFF))
    out[at + 4 + digits] = _crc(out, at, 4 + digits, 8)
    crc = _crc(out, at, size - 2, 16)
    out[at + size - 2], out[at + size - 1] = crc >> 8, crc & 0xFF
    return out, size


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of unsigned 8-bit samples; each payload is a positive multiple of BLOCK bytes."""
    count = np.array([len(p) // BLOCK for p in payloads], np.int64)
    data = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, BLOCK)
    first = np.cumsum(count) - count
    number = np.arange(len(data)) - np.repeat(first, count)
    parts, sizes = [], []
    for i in range(0, len(data), SLICE):
        got, size = _frames(data[i : i + SLICE].astype(np.int32) - 128, number[i : i + SLICE])
        parts.append(got.tobytes())
        sizes.append(size)
    body, size = b"".join(parts), np.concatenate(sizes)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = []
    for p, a, c in zip(payloads, first, count, strict=True):
        own = size[a : a + c]
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        info = struct.pack(">HH", BLOCK, BLOCK) + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big") + ((RATE << 44) | (7 << 36) | len(p)).to_bytes(8, "big") + hashlib.md5(signed).digest()
        out.append(b"fLaC\x80\x00\x00\x22" + info + body[ends[a] : ends[a + c]])
    return out


class _Bits:
    """Positions into one byte array, one for each frame, read in step."""

    def __init__(self, data: np.ndarray, pos: np.ndarray):
        pad = np.concatenate([data, np.zeros(16, np.uint8)])
        self.words = np.zeros(len(data) + 8, np.uint64)
        for i in range(8):
            self.words |= pad[i : i + len(self.words)].astype(np.uint64) << np.uint64(56 - 8 * i)
        self.pos = pos

    def peek(self, pos: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(pos >> 3, len(self.words) - 1)] << (pos & 7).astype(np.uint64)

    def read(self, n) -> np.ndarray:
        """n bits, 0 to 32, of each; n may differ by frame."""
        n = np.asarray(n)
        got = (self.peek(self.pos) >> np.uint64(1) >> (63 - n).astype(np.uint64)).astype(np.int64)
        self.pos = self.pos + n
        return got

    def signed(self, n) -> np.ndarray:
        got, n = self.read(n), np.asarray(n)
        return np.where(got >> np.maximum(n - 1, 0) & 1, got - (np.int64(1) << n), got)

    def unary(self) -> np.ndarray:
        got, pos = np.zeros(len(self.pos), np.int64), self.pos
        top = 8 * len(self.words)
        while True:
            x = self.peek(pos) >> np.uint64(11)
            lead = 53 - np.frexp(x.astype(np.float64))[1]
            got, pos = got + lead, pos + lead
            if x.all() or (pos >= top).any():
                break
        self.pos = pos + 1
        return got


def _subframes(data: np.ndarray, bit: np.ndarray, block: int, depth: int, stats: dict) -> tuple[np.ndarray, np.ndarray]:
    """Samples (block, frames) of the mono subframes that begin at the bits; and the bits where they end."""
    head = _Bits(data, bit)
    kind = head.read(8)
    if (kind >> 7).any():
        raise FlacError("bad subframe header")
    out, ends = np.zeros((block, len(bit)), np.int64), np.zeros(len(bit), np.int64)
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        b, t = head, int(k) >> 1
        b.pos = bit[rows] + 8
        wasted = b.unary() + 1 if k & 1 else np.zeros(len(rows), np.int64)
        bps = depth - wasted
        s = np.zeros((block, len(rows)), np.int64)
        if t == 0:
            s[:] = b.signed(bps)
        elif t == 1:
            for i in range(block):
                s[i] = b.signed(bps)
        elif 8 <= t <= 12 or t >= 32:
            order = t - 8 if t < 32 else t - 31
            for i in range(order):
                s[i] = b.signed(bps)
            if t < 32:
                shift, coef = 0, FIXED[order]
            else:
                precision = b.read(4) + 1
                shift = b.signed(5)
                if (precision == 16).any() or (shift < 0).any():
                    raise FlacError("bad predictor")
                coef = [b.signed(precision) for _ in range(order)]
            _residuals(b, s, order, block)
            for i in range(order, block):
                if order:
                    s[i] += sum(c * s[i - 1 - j] for j, c in enumerate(coef)) >> shift
        else:
            raise FlacError("reserved subframe type")
        name = "constant" if t == 0 else "verbatim" if t == 1 else "fixed" if t < 32 else "lpc"
        stats.setdefault(name, []).append(rows)
        out[:, rows], ends[rows] = s << wasted, b.pos
    return out, ends


def _residuals(b: _Bits, s: np.ndarray, order: int, block: int) -> None:
    """Adds Rice-coded residuals to s[order:]. Frames with another coding method or partition order are read on their own."""
    start = b.pos
    head = b.read(6)
    ends = np.zeros(len(start), np.int64)
    for h in np.unique(head):
        rows = np.flatnonzero(head == h)
        method, parts = int(h) >> 4, 1 << (int(h) & 15)
        if method > 1 or block % parts or block // parts < order:
            raise FlacError("bad residual coding")
        b.pos = start[rows] + 6
        width, got = 4 + method, np.zeros((block - order, len(rows)), np.int64)
        i = 0
        for p in range(parts):
            k = b.read(width)
            escaped = k == (1 << width) - 1
            plain = not escaped.any()
            if not plain:
                at = b.pos
                raw = b.read(5)
                b.pos = np.where(escaped, b.pos, at)
            for _ in range(block // parts - (order if p == 0 else 0)):
                if plain:
                    u = b.unary() << k
                    u |= b.read(k)
                    got[i] = (u >> 1) ^ -(u & 1)
                else:
                    at = b.pos
                    direct = b.signed(np.where(escaped, raw, 0))
                    after = b.pos
                    b.pos = at
                    kk = np.where(escaped, 0, k)
                    u = b.unary() << kk
                    u |= b.read(kk)
                    got[i] = np.where(escaped, np.where(raw > 0, direct, 0), (u >> 1) ^ -(u & 1))
                    b.pos = np.where(escaped, after, b.pos)
                i += 1
        s[order:, rows], ends[rows] = got, b.pos
    b.pos = ends


def _info(stream: bytes) -> tuple[int, int, int, bytes]:
    """Where the frames begin, bits a sample, samples, MD5."""
    if stream[:4] != b"fLaC":
        raise FlacError("no FLAC stream")
    at, info = 4, None
    while True:
        last, kind, size = stream[at] >> 7, stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        if kind == 0:
            info = stream[at + 4 : at + 4 + size]
        at += 4 + size
        if last:
            break
    x = int.from_bytes(info[10:18], "big")
    if (x >> 41) & 7:
        raise FlacError("just mono streams are read")
    return at, ((x >> 36) & 31) + 1, x & ((1 << 36) - 1), info[18:34]


def _headers(data: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidate frames: place, number, block size, header length; sync code, fields and CRC-8 fit."""
    at = np.flatnonzero((data[:-1] == 0xFF) & (data[1:] == 0xF8))
    at = at[at + 6 < len(data)]
    pad = np.concatenate([data, np.zeros(24, np.uint8)]).astype(np.int64)
    code, lead = pad[at + 2] >> 4, pad[at + 4]
    digits = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, np.where(lead < 0xF8, 4, np.where(lead < 0xFC, 5, 6)))))
    number = np.where(lead < 0x80, lead, lead & ((1 << np.maximum(7 - digits, 0)) - 1))
    for i in range(1, 6):
        number = np.where(digits > i, (number << 6) | (pad[at + 4 + np.minimum(i, digits - 1)] & 0x3F), number)
    more = np.where(code == 6, 1, np.where(code == 7, 2, 0))
    rate = pad[at + 2] & 15
    rates = np.where(rate == 12, 1, np.where((rate == 13) | (rate == 14), 2, 0))
    after = at + 4 + digits
    block = np.array([BLOCK_CODES.get(c, 0) for c in range(16)])[code]
    block = np.where(code == 6, pad[after] + 1, np.where(code == 7, (pad[after] << 8 | pad[after + 1]) + 1, block))
    size = 4 + digits + more + rates
    ok = (block > 0) & (pad[at + 3] & 0xF1 == 0) & (rate != 15)
    ok &= _crc(pad, at, np.where(ok, size, 0), 8) == pad[at + size]
    return at[ok], number[ok], block[ok], size[ok] + 1


def _pick(data: np.ndarray, at: np.ndarray, number: np.ndarray, end: int) -> list[int]:
    """Of candidates, those whose numbers run 0, 1, 2, ... with right CRC-16; needed where samples look like a header."""
    chosen, want, i = [], 0, 0
    while i < len(at):
        if number[i] == want:
            stops = [*(j for j in range(i + 1, len(at)) if number[j] == want + 1), len(at)]
            good = next((j for j in stops if _crc(data, np.array([at[i]]), np.array([(at[j] if j < len(at) else end) - at[i]]), 16)[0] == 0), None)
            if good is not None:
                chosen.append(i)
                want, i = want + 1, good
                continue
        i += 1
    return chosen


def _reserved(data: np.ndarray, bit: int, block: int, depth: int) -> bool:
    try:
        _subframes(data, np.array([bit]), block, depth, {})
    except FlacError:
        return True
    return False


def decode(streams: list[bytes]) -> list[dict]:
    """For each stream {pcm, bps, blocks, kinds} or {error}; blocks: (first sample, samples, byte offset, bytes)."""
    out: list[dict] = [{} for _ in streams]
    good = []
    for i, s in enumerate(streams):
        try:
            good.append((i, *_info(s)))
        except (FlacError, IndexError, TypeError, ValueError) as e:
            out[i] = {"error": str(e) or "truncated"}
    size = np.array([len(streams[g[0]]) for g in good], np.int64)
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(streams[g[0]] for g in good), np.uint8)
    at, number, block, head = _headers(data, base) if len(data) > 8 else (np.empty(0, np.int64),) * 4
    owner = np.searchsorted(base, at, side="right") - 1
    lo, hi = np.searchsorted(owner, np.arange(len(good))), np.searchsorted(owner, np.arange(len(good)), side="right")
    use, of = [], []
    for j, (i, begin, bps, total, _) in enumerate(good):
        own = np.arange(lo[j], hi[j])
        own = own[at[own] >= base[j] + begin]
        if len(own) == 0 or (number[own] != np.arange(len(own))).any() or block[own].sum() < total or block[own][:-1].sum() >= max(total, 1):
            own = own[_pick(data, at[own], number[own], base[j] + size[j])]
        if block[own].sum() < total or bps not in (8, 16):
            out[i] = {"error": "frames are missing" if bps in (8, 16) else "just 8 and 16 bits a sample are read"}
            continue
        use.append(own)
        of.append(np.full(len(own), j))
    if not use:
        return out
    use, of = np.concatenate(use), np.concatenate(of)
    last = np.append(of[1:] != of[:-1], True)
    stop = np.where(last, (base + size)[of], np.append(at[use][1:], 0))
    start, depth = at[use], np.array([g[2] for g in good])[of]
    samples: list[np.ndarray | None] = [None] * len(use)
    kinds = np.empty(len(use), object)
    bad = np.zeros(len(use), bool)
    for a in range(0, len(use), SLICE):
        rows = np.arange(a, min(a + SLICE, len(use)))
        bad[rows] |= _crc(data, start[rows], stop[rows] - start[rows], 16) != 0
        rows = rows[~bad[rows]]
        for b, d in {(int(b), int(d)) for b, d in zip(block[use[rows]], depth[rows], strict=True)}:
            same = rows[(block[use[rows]] == b) & (depth[rows] == d)]
            lo_, stats = int(start[same].min()), {}
            part, bits = data[lo_ : int(stop[same].max())], 8 * (start[same] + head[use[same]] - lo_)
            try:
                got, _ = _subframes(part, bits, b, d, stats)
            except FlacError:  # of frames with right checksums, those that use reserved values
                bad[same] = [_reserved(part, x, b, d) for x in bits]
                same, bits, stats = same[~bad[same]], bits[~bad[same]], {}
                got, _ = _subframes(part, bits, b, d, stats)
            for name, r in stats.items():
                kinds[same[np.concatenate(r)]] = name
            got = (got + 128).astype(np.uint8).T if d == 8 else got.astype("<i2").T
            for r, x in zip(same, np.ascontiguousarray(got), strict=True):
                samples[r] = x
    ends = np.flatnonzero(last) + 1
    for a, z in zip(np.append(0, ends[:-1]), ends, strict=True):
        i, _, bps, total, md5 = good[of[a]]
        if bad[a:z].any():
            out[i] = {"error": "checksum"}
            continue
        pcm = b"".join(x.tobytes() for x in samples[a:z])[: total * bps // 8]
        raw = (np.frombuffer(pcm, np.uint8) ^ 0x80).tobytes() if bps == 8 else pcm
        if any(md5) and hashlib.md5(raw).digest() != md5:
            out[i] = {"error": "md5"}
            continue
        first = np.cumsum(block[use[a:z]]) - block[use[a:z]]
        n = np.minimum(block[use[a:z]], total - first)
        out[i] = {"pcm": pcm, "bps": bps, "kinds": kinds[a:z], "blocks": list(zip(first.tolist(), n.tolist(), (start[a:z] - base[of[a]]).tolist(), (stop[a:z] - start[a:z]).tolist(), strict=True))}
    return out
