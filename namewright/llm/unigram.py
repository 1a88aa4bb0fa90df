"""A unigram piece vocabulary: SentencePiece model file, exact Viterbi and its tie rule.

Scores are the file's, taken as exact integers, none below ``FLOOR`` (the file marks runs of spaces with -1e9, at
which single precision would blur all other scores).  The best path to a position keeps the
first of equal candidates in order of start, so among ties the longest last piece wins;
this is the rule of SentencePiece's unigram encoder.  A character that no piece covers costs
ten more than the lowest score and is spelled by its UTF-8 byte pieces.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

SPACE = "▁"
#: Runs of the space mark, then what follows; a newline by itself.
SEGMENT = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
#: Distinct segments that a worker remembers.
MEMO = 100_000
#: Longer segments are worked out afresh each time.
MEMO_CHARS = 64
LOW = -(1 << 60)
FLOOR = -(1 << 16)


def wire(data: bytes) -> Iterator[tuple[int, int, object]]:
    """Fields of a protocol buffer message: number, wire type, value."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value: object = number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            value = data[at : at + size]
            at += size
        yield key >> 3, kind, value


def roll(h, points):
    """The hash of a text with one more character."""
    import numpy as np

    return (h + points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def finish(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Unigram:
    """Vocabulary with ``ids``, ``scores`` and the longest piece; shared by encoders and counters."""

    def __init__(self, model_path: str):
        with open(model_path, "rb") as f:
            data = f.read()
        self.names: list[str] = []
        self.score: dict[str, int] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        for field, _, value in wire(data):
            if field != 1:
                continue
            piece = {k: v for k, _, v in wire(value)}
            name, kind = piece[1].decode(), piece.get(3, 1)
            if kind == 1:
                self.id[name] = len(self.names)
                self.score[name] = max(FLOOR, int(struct.unpack("<f", piece.get(2, b"\0" * 4))[0]))
            elif kind == 6:
                self.byte[int(name[3:5], 16)] = len(self.names)
            self.names.append(name)
        self.longest = max(map(len, self.score))
        self.unknown = min(self.score.values()) - 10
        #: No piece crosses from another character to the space mark or holds a newline, so texts fall apart there.
        self.splits = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.score)
        self.memo: dict[str, tuple[int, bytes]] = {}
        self._table = None

    def normal(self, text: str) -> str:
        """The text as pieces see it: a space in front, spaces as marks."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def segments(self, text: str) -> list[str]:
        return SEGMENT.findall(text) if self.splits else [text]

    def forward(self, text: str, begin: list[int], upto: int) -> tuple[list[int], list[int]]:
        """Best scores and start of the last piece for each position of ``text``.

        ``begin[i]`` is the score of being at position i already (``LOW``: not possible); starts of such
        positions are -1.  Pieces start before ``upto`` and may end after it.
        """
        n, score, longest, unknown = len(text), self.score, self.longest, self.unknown
        best = begin + [LOW] * (n + 1 - len(begin))
        last = [-1] * (n + 1)
        for i in range(upto):
            here = best[i]
            if here == LOW:
                continue
            single = False
            for j in range(i + 1, min(i + longest, n) + 1):
                s = score.get(text[i:j])
                if s is not None:
                    if j == i + 1:
                        single = True
                    if here + s > best[j]:
                        best[j], last[j] = here + s, i
            if not single and here + unknown > best[i + 1]:
                best[i + 1], last[i + 1] = here + unknown, i
        return best, last

    def backward(self, text: str) -> list[int]:
        """Best score from each position of ``text`` to its end, over pieces that do not reach beyond it."""
        n, score, longest = len(text), self.score, self.longest
        best = [LOW] * n + [0]
        for i in range(n - 1, -1, -1):
            top = self.unknown + best[i + 1] if text[i] not in score else LOW
            for j in range(i + 1, min(i + longest, n) + 1):
                s = score.get(text[i:j])
                if s is not None and s + best[j] > top:
                    top = s + best[j]
            best[i] = top
        return best

    def spell(self, text: str, last: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the best path that ends at ``end``, and the position at which it begins."""
        out: list[int] = []
        while last[end] >= 0:
            piece = text[last[end] : end]
            known = self.id.get(piece)
            out += [known] if known is not None else [self.byte[b] for b in reversed(piece.encode())]
            end = last[end]
        return out[::-1], end

    def encode_segment(self, segment: str) -> tuple[int, bytes]:
        """Score and ids (little-endian uint32) of a text on its own."""
        if (hit := self.memo.get(segment)) is not None:
            return hit
        best, last = self.forward(segment, [0], len(segment))
        ids, _ = self.spell(segment, last, len(segment))
        out = best[-1], struct.pack(f"<{len(ids)}I", *ids)
        if len(segment) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[segment] = out
        return out

    def encode(self, text: str) -> tuple[int, bytes]:
        """Score and ids of a normalised text."""
        parts = [self.encode_segment(s) for s in self.segments(text)]
        return sum(p[0] for p in parts), b"".join([p[1] for p in parts])

    def hash_table(self):
        """Sorted hashes of the pieces, their ids and scores, and which leading bits of a hash occur."""
        if self._table is None:
            import numpy as np

            by_size: dict[int, list[str]] = {}
            for piece in self.score:
                by_size.setdefault(len(piece), []).append(piece)
            keys, ids, scores = [], [], []
            for size, pieces in by_size.items():
                points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).reshape(-1, size)
                rolled = np.zeros(len(pieces), np.uint64)
                for k in range(size):
                    rolled = roll(rolled, points[:, k])
                keys.append(finish(rolled))
                ids += [self.id[p] for p in pieces]
                scores += [self.score[p] for p in pieces]
            key = np.concatenate(keys)
            order = np.argsort(key)
            occurs = np.zeros(1 << 20, bool)
            occurs[key >> np.uint64(44)] = True
            if len(np.unique(key)) != len(key):
                raise ValueError("piece hashes collide")
            self._table = key[order], np.array(ids, np.int64)[order], np.array(scores, np.int64)[order], occurs
        return self._table

    def encode_many(self, segments: list[str], widest: int = 40, cells: int = 1 << 19):
        """Scores, ids end to end (uint32) and bounds of the ids of each of many texts: Viterbi over all texts of a
        length at once.  Longer texts, and those with unknown characters, are encoded one by one.
        """
        import numpy as np

        keys, piece_ids, piece_scores, occurs = self.hash_table()
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        start = np.cumsum(size) - size
        score, count = np.zeros(len(segments), np.int64), np.zeros(len(segments), np.int64)
        done: list[tuple] = []  # (texts, ids, which of the ids count)
        single: list[int] = np.flatnonzero(size > widest).tolist()
        for n in np.unique(size[size <= widest]).tolist():
            rows = np.flatnonzero(size == n)
            for at in range(0, len(rows) if n else 0, max(1, cells // n)):
                part = rows[at : at + max(1, cells // n)]
                text = points[start[part][:, None] + np.arange(n)]
                best = np.full((len(part), n + 1), LOW, np.int64)
                best[:, 0] = 0
                width, pick = np.zeros((len(part), n + 1), np.int8), np.zeros((len(part), n + 1), np.int64)
                rolled, pieces = np.zeros(text.shape, np.uint64), []
                for k in range(1, min(self.longest, n) + 1):
                    rolled = roll(rolled[:, : n - k + 1], text[:, k - 1 :])
                    key = finish(rolled)
                    maybe = np.flatnonzero(occurs[key >> np.uint64(44)].ravel())
                    wanted = key.ravel()[maybe]
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    hit = keys[place] == wanted
                    found = np.full(key.size, -1, np.int32)
                    found[maybe[hit]] = place[hit]
                    pieces.append(found.reshape(key.shape))
                for j in range(1, n + 1):
                    for k in range(min(self.longest, j), 0, -1):
                        piece = pieces[k - 1][:, j - k]
                        gain = np.where(piece >= 0, piece_scores[piece], self.unknown if k == 1 else LOW)
                        value = best[:, j - k] + gain
                        better = value > best[:, j]
                        best[better, j] = value[better]
                        width[better, j] = k
                        pick[better, j] = np.where(piece[better] >= 0, piece_ids[piece[better]], -1)
                ids, here, line = np.full((len(part), n), -2, np.int64), np.full(len(part), n), np.arange(len(part))
                for step in range(n - 1, -1, -1):
                    live = here > 0
                    ids[live, step] = pick[line[live], here[live]]
                    here = here - width[line, here]
                strange = (ids == -1).any(axis=1)
                single += part[strange].tolist()
                part, ids = part[~strange], ids[~strange]
                score[part] = best[~strange, n]
                used = ids >= 0
                count[part] = used.sum(axis=1)
                done.append((part, ids[used]))
        spelled = []
        for i in single:
            score[i], raw = self.encode_segment(segments[i])
            spelled.append(np.frombuffer(raw, "<u4"))
            count[i] = len(spelled[-1])
        bounds = np.append(0, np.cumsum(count))
        flat = np.zeros(bounds[-1], "<u4")
        for part, ids in done:
            c = count[part]
            flat[np.repeat(bounds[part] - (np.cumsum(c) - c), c) + np.arange(len(ids))] = ids
        for i, ids in zip(single, spelled, strict=True):
            flat[bounds[i] : bounds[i + 1]] = ids
        return score, flat, bounds

    def encode_texts(self, texts: list[str]):
        """Score and ids (little-endian uint32) of each normalised text."""
        import numpy as np

        codes: dict[str, int] = {}
        order, owner = [], []
        for text in texts:
            parts = self.segments(text)
            order += [codes.setdefault(s, len(codes)) for s in parts]
            owner.append(len(order))
        score, flat, bounds = self.encode_many(list(codes))
        code = np.array(order, np.int64)
        count = (bounds[1:] - bounds[:-1])[code]
        ends = np.cumsum(count)
        ids = flat[np.repeat(bounds[code] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        sums, stops = np.append(0, np.cumsum(score[code])), np.append(0, ends)
        at = np.append(0, np.array(owner, np.int64))
        return [(int(sums[b] - sums[a]), ids[stops[a] : stops[b]].tobytes()) for a, b in zip(at, at[1:], strict=False)]

    def as_library_model(self, model_path: str) -> bytes:
        """The model file with these scores and its type set to unigram: for checks against the library."""
        with open(model_path, "rb") as f:
            data = f.read()

        def number(value: int) -> bytes:
            out = b""
            while value > 127:
                out, value = out + bytes([value & 127 | 128]), value >> 7
            return out + bytes([value])

        def field(k: int, kind: int, value: object) -> bytes:
            head = number(k << 3 | kind)
            return head + (number(value) if kind == 0 else value if kind in (1, 5) else number(len(value)) + value)

        out = b""
        for k, kind, value in wire(data):
            if k == 1:
                value = b"".join(field(a, b, struct.pack("<f", max(FLOOR, struct.unpack("<f", c)[0])) if a == 2 else c) for a, b, c in wire(value))
            elif k == 2:
                value = b"".join(field(a, b, 1 if a == 3 else c) for a, b, c in wire(value))
            out += field(k, kind, value)
        return out


_loaded: dict[str, Unigram] = {}


def load(model_path: str) -> Unigram:
    """The vocabulary of a file, read once by each worker."""
    if model_path not in _loaded:
        _loaded[model_path] = Unigram(model_path)
    return _loaded[model_path]
