"""Operator 10, SentencePiece encoding and decoding: a max-plus parallel scan.

The model is a BPE vocabulary.  A sequence of pieces is the encoding of a
text exactly if no merge would have crossed a border between neighbours, so
encoding is a path problem: a state is the piece that ends at (or reaches
over) a place of the text, a step to the next piece has the piece's score
if the two may stand side by side and minus infinity if not, and the best
path, the only one above minus infinity, is the encoding.

* Places that no merge crosses (before a space; next to characters of no
  longer piece) have one state.  The path between two of them depends on the
  characters between alone, so it is solved once per distinct stretch, for
  all stretches of a batch together, one column of characters at a time.
* Giant texts are split into chunks, at such a place if there is one near.
  Every chunk gives its transfer matrix from the states at its left end to
  those at its right end; the matrices of a text are combined associatively
  in the (max, +) algebra, the best states at the borders are chosen from
  the products, and each chunk is then traced back by itself.

Runs of spaces have pieces of equal rank, which merge from the left; they
are encoded by that rule once a stretch is known to leave its space alone.

Decoding joins the pieces, turns byte pieces into UTF-8 and drops the space
that encoding puts in front.  The round trip is exact for texts without the
character U+2581, which the model cannot tell from a space.

Defined cases: null and empty texts have no pieces and decode to the empty
text; characters outside the vocabulary become byte pieces; very long texts are
chunked; of paths with equal totals the first found stays; repeated rows
are encoded each; other columns are kept; empty tables give empty results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.llm.common import fresh_name, map_rows, materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65_536               # characters of a chunk; longer texts are giants
PART_BYTES = 500_000         # of text that is encoded at once
NEAR = 1_024                 # how far back a chunk may end to end at a free place
LONG = 48                    # characters up to which stretches are solved together
SPACE = "▁"
FREE = (0, -1)               # the one state at a free place
_A = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a BPE model with byte fallback, and what the path problem needs of them."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        normal, byte = pb.ModelProto.SentencePiece.NORMAL, pb.ModelProto.SentencePiece.BYTE
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == normal}
        self.bytes = [self.ids.get("", 0)] * 256
        self.decoded = [b""] * len(self.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == byte:
                self.bytes[int(p.piece[1:-1], 16)] = i
                self.decoded[i] = bytes([int(p.piece[1:-1], 16)])
            elif p.type == normal:
                self.decoded[i] = p.piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids))
        inner = {p: i for p, i in self.ids.items() if len(p) > 1 and p.strip(SPACE)}
        self.joining = {c for p in inner for c in p}
        # the last merge of every piece: its halves and rank; single characters have rank -1
        n = len(self.pieces)
        self.left, self.right, self.rank = [-1] * n, [-1] * n, [-1.0] * n
        self.whole = [len(p) == 1 for p in self.pieces]          # can the piece be an encoding's piece?
        pairs: dict[tuple[int, int], float] = {}
        for p, i in inner.items():
            halves = self._last_merge(p)
            if halves:
                self.left[i], self.right[i] = halves
                self.rank[i] = -self.scores[i]
                self.whole[i] = True
        for p, i in inner.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = -self.scores[i]
        self.pairs = pairs

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """Halves of the last merge when ``piece`` is encoded alone; None if it is not one piece then."""
        parts = list(piece)
        halves = None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return None
            halves = parts[at], parts[at + 1]
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return (self.ids[halves[0]], self.ids[halves[1]]) if halves[0] in self.ids and halves[1] in self.ids else None

    def char(self, c: str) -> list[int]:
        """Piece of a character, or its bytes' pieces."""
        i = self.ids.get(c)
        return [i] if i is not None else [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]


def _mix(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ (c.astype(np.uint64) + np.uint64(1))) * _A
        return x ^ (x >> np.uint64(29))


def as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Encoder:
    """Solves stretches; remembers them up to a bound."""

    LIMIT = 250_000

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known: dict[str, bytes] = {}
        joining = re.escape("".join(sorted(v.joining - {SPACE})))
        self.unit = re.compile(f"{SPACE}*[{joining}]+|{SPACE}+|[^{SPACE}{joining}]", re.S)
        self.runs: dict[int, list[int]] = {}
        self.pair_memo: dict[tuple[int, int], bool] = {}
        # beginnings of pieces by hash; the piece that ends there, or -1
        starts: dict[int, int] = {}
        by_len: dict[int, list[tuple[str, int]]] = {}
        for p in v.ids:
            if len(p) == 1 or p.strip(SPACE):
                for k in range(1, len(p) + 1):
                    by_len.setdefault(k, []).append((p[:k], -1))
                by_len[len(p)].append((p, v.ids[p] if v.whole[v.ids[p]] else -1))
        for k, some in by_len.items():
            cps = np.frombuffer("".join(s for s, _ in some).encode("utf-32-le"), np.uint32).reshape(-1, k)
            h = np.zeros(len(some), np.uint64)
            for j in range(k):
                h = _mix(h, cps[:, j])
            for key, (_, i) in zip(h.tolist(), some):
                starts[key] = max(starts.get(key, -1), i)
        self.start_keys = np.array(sorted(starts), np.uint64)
        self.start_piece = np.array([starts[k] for k in self.start_keys.tolist()], np.int64)
        n = len(v.pieces)
        keys = sorted((a * n + b, r) for (a, b), r in v.pairs.items())
        self.pair_keys = np.array([k for k, _ in keys], np.int64)
        self.pair_rank = np.array([r for _, r in keys])
        self.left, self.right, self.rank = np.array(v.left), np.array(v.right), np.array(v.rank)
        self.score = np.array(v.scores)

    # ---- which pieces may stand side by side ---------------------------------
    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Would BPE keep the border between pieces ``a`` and ``b``?

        The merges that made the two pieces are undone, the latest first.  At
        every stage the two pieces at the border must not have merged before
        the next merge that took one of them.
        """
        n = len(self.v.pieces)
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        next_a, next_b = np.full(len(a), np.inf), np.full(len(a), np.inf)
        while len(live):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_rank[at], np.inf)
            # the pair is left of the right piece's merges: at equal rank it comes before them
            bad = np.isfinite(rank) & (rank < next_a) & (rank <= next_b)
            ok[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            next_a, next_b = np.where(undo_a, ra, next_a)[go], np.where(undo_a, next_b, rb)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            live = live[go]
        return ok

    def follows(self, a: int, b: int) -> bool:
        memo = self.pair_memo.get((a, b))
        if memo is None:
            if len(self.pair_memo) > self.LIMIT:
                self.pair_memo.clear()
            memo = self.pair_memo[a, b] = bool(self.may_follow(np.array([a]), np.array([b]))[0])
        return memo

    # ---- stretches between free places ----------------------------------------
    def solve(self, stretches: list[str]) -> list[bytes]:
        """Paths of stretches of joining characters, all of them one column at a time, as int32 ids."""
        sizes = np.array([len(t) for t in stretches])
        n, width = len(stretches), int(sizes.max())
        cps = np.zeros((n, width), np.uint32)
        flat = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        row = np.repeat(np.arange(n), sizes)
        cps[row, np.arange(len(flat)) - starts[row]] = flat
        last = np.full((n, width + 1), -1, np.int32)         # the piece that ends at a place
        begin = np.zeros((n, width + 1), np.int16)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0.0
        pieces = len(self.v.pieces)
        for s in range(width):
            rows = np.flatnonzero((best[:, s] > -np.inf) & (sizes > s))
            h = np.zeros(len(rows), np.uint64)
            for e in range(s + 1, min(width, s + self.v.longest) + 1):
                if e > s + 1:
                    inside = sizes[rows] >= e
                    rows, h = rows[inside], h[inside]
                h = _mix(h, cps[rows, e - 1])
                at = np.searchsorted(self.start_keys, h)
                at[at == len(self.start_keys)] = 0
                live = self.start_keys[at] == h
                rows, h, at = rows[live], h[live], at[live]
                if not len(rows):
                    break
                piece = self.start_piece[at]
                use = piece >= 0
                r, p = rows[use], piece[use]
                if s and len(r):
                    pair, inv = np.unique(last[r, s].astype(np.int64) * pieces + p, return_inverse=True)
                    fine = self.may_follow(pair // pieces, pair % pieces)[inv]
                    r, p = r[fine], p[fine]
                total = best[r, s] + self.score[p]
                better = total > best[r, e]
                r, p = r[better], p[better]
                best[r, e], last[r, e], begin[r, e] = total[better], p, s
        # trace all paths back together: first their lengths, then their pieces
        solved = best[np.arange(n), sizes] > -np.inf
        steps = []
        rows = np.flatnonzero(solved)
        ends = sizes[rows]
        count = np.zeros(n, np.int64)
        while len(rows):
            steps.append((rows, last[rows, ends]))
            count[rows] += 1
            ends = begin[rows, ends].astype(np.int64)
            more = ends > 0
            rows, ends = rows[more], ends[more]
        upto = np.cumsum(count)
        flat_ids = np.zeros(int(upto[-1]), np.int32)
        for k, (rows, ids) in enumerate(steps):
            flat_ids[upto[rows] - 1 - k] = ids
        raw = flat_ids.tobytes()
        cuts = [0, *(4 * upto).tolist()]
        return [raw[a:b] if ok else as_bytes(self.solve_long(t))     # a character has no piece of its own
                for a, b, ok, t in zip(cuts, cuts[1:], solved.tolist(), stretches)]

    def solve_long(self, stretch: str) -> list[int]:
        """Path of one stretch of any length."""
        nodes = Segment(self, stretch, 0, len(stretch), [FREE], True).nodes()
        return self.ids_of(trace(nodes, FREE, len(stretch), None), stretch)

    def ids_of(self, path: list[tuple[int, int, int | None]], text: str) -> list[int]:
        out: list[int] = []
        for i, j, p in path:
            out += [p] if p is not None else self.v.char(text[i:j])
        return out

    def run(self, k: int) -> list[int]:
        """Pieces of a run of ``k`` spaces: equal ranks merge from the left."""
        known = self.runs.get(k)
        if known is None:
            parts = [1] * k
            while True:
                for i in range(len(parts) - 1):
                    if SPACE * (parts[i] + parts[i + 1]) in self.v.ids:
                        parts[i: i + 2] = [parts[i] + parts[i + 1]]
                        break
                else:
                    break
            known = [self.v.ids[SPACE * p] for p in parts]
            if k <= 10_000:
                self.runs[k] = known
        return known

    def learn(self, units: list[str]) -> None:
        """Solve units that are not known yet."""
        plain, spaced = [], []
        for u in units:
            if u[0] != SPACE:
                if u[0] in self.v.joining:
                    plain.append(u)
                else:
                    self.known[u] = as_bytes(self.v.char(u))
            elif u[1:2] != SPACE and u[1:]:
                plain.append(u)
            else:
                spaced.append(u)
        cores = {SPACE + u.lstrip(SPACE) for u in spaced} - {SPACE}
        plain = sorted({*plain, *cores}, key=len)
        short = [c for c in plain if len(c) <= LONG]
        for k in range(0, len(short), 50_000):
            part = short[k: k + 50_000]
            self.known.update(zip(part, self.solve(part)))
        self.known.update((c, as_bytes(self.solve_long(c))) for c in plain[len(short):])
        for u in spaced:
            core = u.lstrip(SPACE)
            self.known[u] = as_bytes(self.with_spaces(
                len(u) - len(core), np.frombuffer(self.known[SPACE + core], np.int32).tolist() if core else []))

    def with_spaces(self, n: int, ids: list[int]) -> list[int]:
        """Path of ``n`` spaces and a stretch that was solved with one of them."""
        if ids and n > 1:
            return self.run(n) + ids[1:] if ids[0] == self.v.ids[SPACE] else self.run(n - 1) + ids
        return ids or self.run(n)

    def units(self, texts: list[str]) -> list[list[str]]:
        """Units of normalised texts, all of them known afterwards."""
        out = [self.unit.findall(t) for t in texts]
        if len(self.known) > self.LIMIT:
            self.known.clear()
        missing = {u for us in out for u in us}.difference(self.known)
        if missing:
            self.learn(list(missing))
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids of whole texts."""
        units = self.units([normal(t) for t in texts])
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, us)), np.int32) for us in units]


def normal(text: str | None) -> str:
    """The model's form of a text: a space in front, spaces as U+2581."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    """Text of piece ids."""
    raw = b"".join(map(v.decoded.__getitem__, ids.tolist()))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass" if b"\xed" in raw else "replace")


# ---- giant texts ---------------------------------------------------------------
class Segment:
    """Paths through ``text[start:end]``, part of one stretch; the text may reach over both ends.

    ``entry``: states at the left end, as (where the piece ends, piece) or
    FREE; ``free_end``: no merge crosses the right end.
    """

    def __init__(self, enc: Encoder, text: str, start: int, end: int, entry: list[tuple[int, int]], free_end: bool):
        self.enc, self.text, self.start, self.end = enc, text, start, end
        self.entry, self.free_end = entry, free_end

    def nodes(self) -> dict[int, dict]:
        """By place and state: for each entry the best total and the state before."""
        v, text, follows = self.enc.v, self.text, self.enc.follows
        at: dict[int, dict] = {}
        for s in self.entry:
            at.setdefault(self.start if s == FREE else s[0], {})[s] = {s: (0.0, None)}
        out: dict[int, dict] = {}
        for i in range(self.start, self.end):
            here = at.pop(i, None)
            if not here:
                continue
            out[i] = here
            steps = [(j, v.ids[text[i:j]]) for j in range(i + 1, min(i + v.longest, len(text)) + 1)
                     if v.whole[v.ids.get(text[i:j], 0)]]
            if not steps or steps[0][0] != i + 1:
                steps.append((i + 1, None))
            for j, p in steps:
                if self.free_end and j > self.end:
                    continue
                score = v.scores[p] if p is not None else 0.0
                for state, totals in here.items():
                    if state == FREE or state[1] is None or p is None or follows(state[1], p):
                        best = at.setdefault(j, {}).setdefault((j, p), {})
                        for entry, (total, _) in totals.items():
                            if entry not in best or total + score > best[entry][0]:
                                best[entry] = (total + score, (i, state))
        out.update(at)
        return out

    def matrix(self, nodes: dict[int, dict]) -> dict:
        """Transfer matrix: entry state to exit state."""
        m: dict = {}
        for place, states in nodes.items():
            if place >= self.end:
                for state, totals in states.items():
                    for entry, (total, _) in totals.items():
                        row = m.setdefault(entry, {})
                        leave = FREE if self.free_end else state
                        row[leave] = max(row.get(leave, -np.inf), total)
        return m


def combine(a: dict, b: dict) -> dict:
    """Product of two transfer matrices in the (max, +) algebra."""
    out: dict = {}
    for i, row in a.items():
        for k, x in row.items():
            for j, y in b.get(k, {}).items():
                if x + y > out.setdefault(i, {}).get(j, -np.inf):
                    out[i][j] = x + y
    return out


def trace(nodes: dict[int, dict], entry: tuple, place: int, state: tuple | None) -> list[tuple[int, int, int | None]]:
    """Pieces (start, end, piece) on the best path from ``entry`` to ``state`` (None: any) at ``place``."""
    if state is None:
        state = max((s for s, totals in nodes[place].items() if entry in totals),
                    key=lambda s: nodes[place][s][entry][0])
    path: list = []
    while (back := nodes[place][state][entry][1]) is not None:
        path.append((back[0], place, state[1]))
        place, state = back
    return path[::-1]


class Splitter:
    """Cuts normalised texts into chunks."""

    def __init__(self, joining: set[str], longest: int, chunk: int = CHUNK, near: int = NEAR):
        self.joining, self.longest, self.chunk, self.near = joining, longest, chunk, near

    def free(self, text: str, q: int) -> bool:
        """Does no merge cross the place between characters q-1 and q?"""
        if q <= 0 or q >= len(text):
            return True
        x, y = text[q - 1], text[q]
        if y == SPACE:
            return x != SPACE
        return y not in self.joining or (x != SPACE and x not in self.joining)

    def cut(self, text: str, start: int) -> int:
        """End of the chunk that begins at ``start``: a free place if one is near."""
        q = min(start + self.chunk, len(text))
        for k in range(q, max(q - self.near, start), -1):
            if self.free(text, k):
                return k
        if text[q - 1] != SPACE:
            return q
        first = q                                     # in a run of spaces: before it, or behind it
        while first > start and text[first - 1] == SPACE:
            first -= 1
        if first > start:
            return first
        while q < len(text) and text[q] == SPACE:
            q += 1
        return min(q + 1, len(text))

    def chunks(self, text: str) -> Iterator[tuple[int, int, int, str]]:
        """(start, end, offset of the slice, slice reaching over both ends)."""
        start = 0
        while start < len(text):
            end = self.cut(text, start)
            low = max(0, start - self.longest)
            yield start, end, low, text[low: end + self.longest]
            start = end


class Chunk:
    """A chunk of a giant text: its transfer matrix, and its pieces for chosen border states."""

    def __init__(self, enc: Encoder, split: Splitter, start: int, end: int, low: int, text: str, total: int):
        self.enc, self.text, self.low = enc, text, low
        a, b = start - low, end - low
        self.left_free = start == 0 or split.free(text, a)
        self.right_free = end == total or split.free(text, b)
        head_end = a
        if not self.left_free:
            head_end = next((q for q in range(a + 1, b) if split.free(text, q)), b)
        tail_start = b
        if not self.right_free:
            tail_start = next((q for q in range(b - 1, a - 1, -1) if (q > a or self.left_free)
                               and split.free(text, q)), -1)
        self.through = not self.left_free and not self.right_free and (tail_start < 0 or head_end == b)
        self.a, self.b, self.head_end, self.tail_start = a, b, head_end, tail_start
        self.spaces = 0
        if self.through:
            self.segments = [Segment(enc, text, a, b, self.entries(a), False)]
            return
        self.segments = []
        if not self.left_free:
            self.segments.append(Segment(enc, text, a, head_end, self.entries(a), True))
        if not self.right_free:
            core = tail_start                         # the stretch keeps one space of those before it
            while text[core] == SPACE:
                core += 1
            self.spaces = core - tail_start
            self.segments.append(Segment(enc, text, core - 1 if self.spaces else core, b, [FREE], False))

    def entries(self, a: int) -> list[tuple[int, int]]:
        """All states at the left end: pieces that end there or reach over it."""
        v, text = self.enc.v, self.text
        return [(j, v.ids[text[i:j]]) for i in range(max(0, a - v.longest), a)
                for j in range(a, min(i + v.longest, len(text)) + 1) if v.whole[v.ids.get(text[i:j], 0)]]

    def shift(self, state: tuple, by: int) -> tuple:
        return state if state == FREE else (state[0] + by, state[1])

    def matrix(self) -> dict:
        """Transfer matrix of the chunk, with places of the whole text."""
        out: dict | None = None
        for seg in self.segments:
            m = seg.matrix(seg.nodes())
            out = m if out is None else combine(out, m)
        if out is None:                               # free at both ends: one path
            out = {FREE: {FREE: 0.0}}
        return {self.shift(i, self.low): {self.shift(j, self.low): x for j, x in row.items()} for i, row in out.items()}

    def pieces(self, entry: tuple, leave: tuple) -> np.ndarray:
        """Ids of the pieces that start in the chunk."""
        entry, leave = self.shift(entry, -self.low), self.shift(leave, -self.low)
        enc, text = self.enc, self.text
        if self.through:
            nodes = self.segments[0].nodes()
            return np.array(enc.ids_of(trace(nodes, entry, leave[0], leave), text), np.int32)
        out: list[np.ndarray] = []
        segments = list(self.segments)
        at = self.a
        if not self.left_free:
            seg = segments.pop(0)
            out.append(np.array(enc.ids_of(trace(seg.nodes(), entry, seg.end, None), text), np.int32))
            at = seg.end
        stop = self.b if self.right_free else self.tail_start
        units = enc.units([text[at:stop]])[0]
        out.append(np.frombuffer(b"".join(map(enc.known.__getitem__, units)), np.int32))
        if not self.right_free:
            ids = enc.ids_of(trace(segments[0].nodes(), FREE, leave[0], leave), text)
            out.append(np.array(enc.with_spaces(self.spaces, ids), np.int32))
        return np.concatenate(out)


def choose(matrices: list[dict]) -> list[tuple[tuple, tuple]]:
    """Entry and exit state of each chunk on the best path of a text."""
    reach = [{FREE: {FREE: 0.0}}]
    for m in matrices:
        reach.append(combine(reach[-1], m))
    out: list[tuple[tuple, tuple]] = []
    leave: tuple = FREE
    for m, before in zip(reversed(matrices), reversed(reach[:-1])):
        row = before[FREE]
        entry = max((s for s in row if leave in m.get(s, {})), key=lambda s: row[s] + m[s][leave])
        out.append((entry, leave))
        leave = entry
    return out[::-1]


def _dump(m: dict) -> list[list]:
    return [[i[0], i[1], j[0], j[1], x] for i, row in m.items() for j, x in row.items()]


def _load(rows: list[list]) -> dict:
    m: dict = {}
    for a, p, b, q, x in rows:
        m.setdefault((a, p), {})[b, q] = x
    return m


def _giant_ids(giants: DataFrame, v: Vocabulary, chunk: int, near: int) -> DataFrame:
    """``rid, ids`` of giant texts (``rid, text``): split, matrices, choice, trace."""
    split = Splitter(v.joining, v.longest, chunk, near)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for rid, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = normal(t.as_py())
            rows += [(rid, k, len(text), *c) for k, c in enumerate(split.chunks(text))]
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                          ["rid", "k", "total", "start", "end", "low", "slice"])

    spread = F.xxhash64("rid", "k")
    chunks = materialize(map_rows(giants.select("rid", "text"), cut,
                                  "rid long, k long, total long, start long, end long, low long, slice string")
                         .repartition(spread), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(v)
        for batch in batches:
            out = []
            for rid, k, total, start, end, low, text in zip(*(c.to_pylist() for c in batch.columns)):
                m = Chunk(enc, split, start, end, low, text, total).matrix()
                out.append((rid, k, json.dumps(_dump(m))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["rid", "k", "m"])

    def pick(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("k", "m"))))
        states = choose([_load(json.loads(m)) for _, m in rows])
        rid = table.column("rid")[0].as_py()
        return pa.table({"rid": pa.array([rid] * len(rows), pa.int64()), "k": pa.array([k for k, _ in rows], pa.int64()),
                         "states": pa.array([json.dumps(s) for s in states], pa.string())})

    chosen = (chunks.select("rid", "k", "total", "start", "end", "low", "slice")
              .mapInArrow(matrices, "rid long, k long, m string")
              .groupBy("rid").applyInArrow(pick, "rid long, k long, states string"))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(v)
        for batch in batches:
            out = []
            for rid, k, total, start, end, low, text, states in zip(*(c.to_pylist() for c in batch.columns)):
                entry, leave = (tuple(s) for s in json.loads(states))
                out.append((rid, k, Chunk(enc, split, start, end, low, text, total).pieces(entry, leave)))
            if out:
                rid, k, ids = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(k), pa.array(ids, pa.list_(pa.int32()))],
                                                 ["rid", "k", "ids"])

    traced = chunks.join(chosen, ["rid", "k"]).select(
        "rid", "k", "total", "start", "end", "low", "slice", "states").mapInArrow(
        back, "rid long, k long, ids array<int>")
    return traced.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts")).select(
        "rid", F.flatten(F.transform("parts", lambda x: x.getField("ids"))).alias("ids"))


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``PART_BYTES`` of text: the units of a part are all held at once."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes, dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        before = upto[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(upto, before + PART_BYTES, side="right")))
        yield batch.slice(row, end - row)
        row = end


def round_trip(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK, near: int = NEAR) -> DataFrame:
    """``docs`` with ``ids`` (the encoding of ``text``) and ``decoded`` (its decoding)."""
    v = Vocabulary(model)
    ids_name, text_name, rid = (fresh_name(docs, n) for n in ("ids", "decoded", "rid"))
    at, width = docs.columns.index("text"), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_name, T.ArrayType(T.IntegerType())),
                           T.StructField(text_name, T.StringType())])

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(v)
        for batch in batches:
            for part in _parts(batch, at):
                ids = enc.encode(part.column(at).to_pylist())
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                texts = pa.array([decode(v, i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, lists, texts],
                                                 [*part.schema.names, ids_name, text_name])

    long = F.coalesce(F.length("text") > F.lit(chunk), F.lit(False))
    done = docs.where(~long).mapInArrow(small, schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = pa.array(np.arange(n, n + batch.num_rows))
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, rid])

    giants = materialize(docs.where(long).mapInArrow(
        number, T.StructType([*docs.schema.fields, T.StructField(rid, T.LongType())])), "giants")
    ids = _giant_ids(giants.select(F.col(rid).alias("rid"), "text"), v, chunk, near)

    def decoding(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [decode(v, np.array(x.as_py(), np.int64)) for x in batch.column(width)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                          [*batch.schema.names, text_name])

    joined = giants.join(ids.withColumnRenamed("rid", rid).withColumnRenamed("ids", ids_name), rid).select(
        *docs.columns, ids_name)
    return done.unionByName(map_rows(joined, decoding, schema))


def query(spark: SparkSession, docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: its pieces, how many, and whether they decode to the text."""
    out = round_trip(docs.select("doc_id", "text"), model)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
                      (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))
