"""Token counts by a compiled finite-state machine.

A byte-level BPE vocabulary becomes a deterministic transducer over bytes. Each
transition carries a signed number: how many tokens more (or fewer, when a merge
swallows some) the text has with this byte than without it. The sum along a path
is the token count of the text, so nothing is pending at its end.

A state stands for all texts with the same future. It is named by the mode of the
open piece (letters, digits, others, white space, begun contraction), by the longest
end of that piece that can still begin a longer token, and by the tokens that end
at each place inside it with their relative counts. There are finitely many such
names; the machine is compiled as texts ask for them, and a full table is
started anew, so memory is bounded whatever the texts are.

Texts are cut into chunks that run side by side. The state map of a chunk is
constant from its first reset on (white space after something else leads every state
to the same one), so it is kept as: bytes before the reset, end state, count. Each
chunk's entry state is its predecessor's end state, and only the bytes before its reset
are run from there. A chunk without a reset has no map: it is walked once its
predecessor's end is known. A stretch of more than STRETCH bytes without a reset (Chinese, one unbroken run) would so
be walked one chunk after the other, and random characters compile a state for nearly every byte. Both go
to the tokenizer library instead: such a stretch stands alone between two resets, and a part of a
batch that asks for more than BUDGET new states is counted by the library as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfmark.llm.common import BASE, joined_bytes, slices

# Fixed value: the splitting pattern of the byte-level vocabulary.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
BEGUN = tuple(sorted({c[:k] for c in CONTRACTIONS for k in range(1, len(c))}))
LETTER, NUMBER = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
CHUNK = 512
#: Bytes without a reset that are still walked: eight turns at most.
STRETCH = 8 * CHUNK
#: New states that one part of a batch may compile. Prose asks for some 16,000 in two megabytes, and less later on.
BUDGET = 40_000


class TooManyStates(Exception):
    """A part of a batch asks for more new states than are worth compiling."""


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes, and the bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """The machine of one vocabulary file. `limit` bounds the compiled states."""

    def __init__(self, path: str, limit: int = 350_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in self.ranks}
        self.specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.stems = {t[:k] for t in self.parts for k in range(1, len(t))}
        self.longest = max(map(len, self.parts))
        self.limit = limit
        self.path, self._library = path, None
        self.left = BUDGET
        self._edges: tuple[dict, dict] = ({}, {})
        self._restart()

    def _restart(self) -> None:
        """Forget all compiled states but the starting one."""
        self.shift = 64 - 20
        self.keys, self.next, self.delta = np.full(1 << 20, -1), np.zeros(1 << 20, np.int32), np.zeros(1 << 20, np.int16)
        self.filled = 0
        self.known: dict[tuple, int] = {}
        self.states: list[tuple[bytes, tuple, bytes]] = []
        self._kept: dict[tuple[bytes, bytes], bool] = {}
        self.fresh: dict[bytes, int] = {}
        self.start = self._state(b"", ((b"", 0),), b"")

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts of a token at its right (1) or left (0) edge, and the rank of the merge that takes each in."""
        if (done := self._edges[side].get(token)) is None:
            done, part, taken = [], token, 1 << 60
            while part:
                done.append((part, taken))
                if len(part) == 1:
                    break
                taken, part = self.ranks[self.parts[part]], self.parts[part][side]
            self._edges[side][token] = done
        return done

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border of two tokens, so that both stay as they are."""
        if (done := self._kept.get((left, right))) is None:
            done = True
            for a, a_taken in self._edge(left, 1):
                for b, b_taken in self._edge(right, 0):
                    rank = self.ranks.get((a, b))
                    if rank is not None and rank < a_taken and rank <= b_taken:
                        done = False
            if len(self._kept) > 400_000:
                self._kept.clear()
            self._kept[left, right] = done
        return done

    def _trail(self, piece: bytes, trail: tuple) -> tuple:
        """`trail` carried on to the end of `piece`.

        The tokens of a beginning of the piece, without the last one, are those of a
        shorter beginning; so the last token is the one that ends here and stays
        apart from the last token before it.
        """
        for end in range(len(trail), len(piece) + 1):
            for k in range(min(end, self.longest), 0, -1):
                token = piece[end - k : end]
                if k == 1 or token in self.parts:
                    before, n = trail[end - k]
                    if not before or self._stay_apart(before, token):
                        trail = (*trail, (token, n + 1))
                        break
        return trail

    def encode(self, piece: bytes) -> int:
        """Tokens of one piece."""
        return self._trail(piece, ((b"", 0),))[-1][1]

    def _mode(self, text: str) -> str:
        if not text:
            return ""
        if text in BEGUN:
            return text
        last = text[-1]
        if last.isspace():
            return "w" + (last if len(text) == 1 else " *"[last != " "])
        if last.isascii():
            return "l" if last.isalpha() else "n" if last.isdigit() else "o"
        return "l" if LETTER.match(last) else "n" if NUMBER.match(last) else "o"

    def _state(self, piece: bytes, trail: tuple, cut_char: bytes) -> int:
        """The number of the state of an open piece; `trail` has (last token, count) at each byte of it."""
        mode = self._mode(piece.decode())
        depth = next((d for d in range(min(len(piece), self.longest), 0, -1) if piece[-d:] in self.stems), 0)
        if mode in BEGUN and mode:
            depth = len(piece)
        end, here = len(piece), trail[-1][1]
        open_at = [k for k in range(depth, -1, -1) if k == 0 or piece[end - k :] in self.stems or mode in BEGUN]
        if mode.startswith("w"):  # what stands without the last character counts, too
            open_at = sorted({*open_at, *range(min(end, 4) + 1)}, reverse=True)
        name = (mode, cut_char, piece[end - depth :], tuple((trail[end - k][0], trail[end - k][1] - here) for k in open_at))
        if (number := self.known.get(name)) is None:
            number = self.known[name] = len(self.states)
            self.states.append((piece, trail, cut_char))
        return number

    def _put(self, key: int, target: int, more: int) -> None:
        """Store a transition in the hash table (open addressing)."""
        if 3 * self.filled > len(self.keys):
            old = self.keys, self.next, self.delta
            self.shift -= 1
            self.keys, self.next, self.delta = (np.full(2 * len(x), -1, x.dtype) for x in old)
            self.filled = 0
            for k, t, m in zip(*(x[old[0] >= 0].tolist() for x in old)):
                self._put(k, t, m)
        slot = self._place(key)
        while self.keys[slot] >= 0:
            slot = (slot + 1) % len(self.keys)
        self.keys[slot], self.next[slot], self.delta[slot] = key, target, more
        self.filled += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * BASE) >> np.uint64(self.shift)).astype(np.int64)

    def _place(self, key: int) -> int:
        """As `_slot`, of one key."""
        return (key * int(BASE) & (1 << 64) - 1) >> self.shift

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the transitions; -1 where one is not compiled yet."""
        slot = self._slot(keys)
        wrong = np.flatnonzero(self.keys[slot] != keys)
        while len(wrong):
            free = self.keys[slot[wrong]] < 0
            slot[wrong[free]] = -1
            wrong = wrong[~free]
            slot[wrong] = (slot[wrong] + 1) % len(self.keys)
            wrong = wrong[self.keys[slot[wrong]] != keys[wrong]]
        return slot

    def compile(self, key: int) -> None:
        """Add the transition of state `key` // 256 by byte `key` % 256."""
        piece, trail, cut_char = self.states[key >> 8]
        raw = cut_char + bytes([key & 255])
        word = not cut_char and piece[-1:].isalpha() and piece[:1] != b"'"
        if word and raw.isascii() and not raw.isalpha():  # a word ends, and a piece of one token begins
            if raw not in self.fresh:
                then, _ = self.follow(np.array([self.start]), np.array([raw[0]]))
                self.fresh[raw] = int(then[0])
            self._put(key, self.fresh[raw], 1)
            return
        if not cut_char and raw.isalpha() and (word or piece in (b"", b" ")):
            rest = piece + raw  # one letter more, by far the commonest case
            carried = self._trail(rest, trail)
            self._put(key, self._state(rest, carried, b""), carried[-1][1] - trail[-1][1])
            return
        try:
            char = raw.decode()
        except UnicodeDecodeError:  # inside a character: nothing counts yet
            self._put(key, self._state(piece, trail, raw), 0)
            return
        text = piece.decode()
        before = sum(self.encode(p.encode()) for p in PATTERN.findall(text))
        pieces = PATTERN.findall(text + char)
        more = sum(self.encode(p.encode()) for p in pieces) - before
        if text + char in BEGUN:
            rest = (text + char).encode()
        elif len(pieces) == 1 and pieces[0] in CONTRACTIONS:
            rest = b""
        else:
            rest = pieces[-1].encode()
        carried = trail if rest.startswith(piece) and len(rest) > len(piece) else ((b"", 0),)
        self._put(key, self._state(rest, self._trail(rest, carried), b""), more)

    def follow(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and token counts of the transitions."""
        keys = state.astype(np.int64) * 256 + byte
        at = self._find(keys)
        if (at < 0).any():
            missing = np.unique(keys[at < 0]).tolist()
            self.left -= len(missing)
            if self.left < 0:
                raise TooManyStates
            for key in missing:
                self.compile(key)
            at = self._find(keys)
        return self.next[at], self.delta[at]

    def walk(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Run all stretches side by side; `states` is changed to the end states. Returns the counts."""
        order = np.argsort(-lengths, kind="stable")
        begin, length, state = begins[order], lengths[order], states[order].astype(np.int64)
        count = np.zeros(len(order), np.int64)
        active = len(order)
        for step in range(int(length[0]) if len(length) else 0):
            while active and length[active - 1] <= step:
                active -= 1
            then, more = self.follow(state[:active], data[begin[:active] + step])
            count[:active] += more
            state[:active] = then
        states[order] = state
        back = np.empty_like(count)
        back[order] = count
        return back

    def library(self, raw: bytes) -> int:
        """Tokens of a text as the tokenizer library counts them."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return len(self._library.encode(raw.decode(), add_special_tokens=False).ids)

    @staticmethod
    def resets(data: np.ndarray) -> np.ndarray:
        """Whether each byte is white space after a visible ASCII character: what is before it counts by itself."""
        space = (data == 32) | ((data >= 9) & (data <= 13))
        reset = np.zeros(len(data), bool)
        reset[1:] = space[1:] & ~space[:-1] & (data[:-1] > 32) & (data[:-1] < 127)
        return reset

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text data[offsets[i]:offsets[i + 1]]: stretches without a reset by the library, the rest by the machine."""
        if len(self.states) > self.limit:
            self._restart()
        edges = np.unique(np.concatenate((offsets, np.flatnonzero(self.resets(data)))))
        long = np.flatnonzero(np.diff(edges) > STRETCH)
        apart = np.zeros(len(offsets) - 1, np.int64)
        if len(long):
            keep = np.ones(len(data), bool)
            for lo, hi in zip(edges[long].tolist(), edges[long + 1].tolist()):
                apart[np.searchsorted(offsets, lo, side="right") - 1] += self.library(data[lo:hi].tobytes())
                keep[lo:hi] = False
            offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
            data = data[keep]
        self.left = BUDGET
        try:
            return apart + self.machine_count(data, offsets)
        except TooManyStates:
            raw = data.tobytes()
            return apart + np.array([self.library(raw[lo:hi]) for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.int64)

    def machine_count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text, by the machine alone."""
        lengths = np.diff(offsets)
        per_text = np.maximum(1, -(-lengths // CHUNK))
        owner = np.repeat(np.arange(len(lengths)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = offsets[:-1][owner] + nth * CHUNK
        end = np.minimum(begin + CHUNK, offsets[1:][owner])
        # The first reset of each chunk.
        reset = self.resets(data)
        places = np.append(np.flatnonzero(reset), len(data) + 1)
        first = places[np.searchsorted(places, np.where(nth > 0, begin, end))]
        closed = (first < end) | (nth == 0)
        body = np.where(nth == 0, begin, np.where(closed, first + 1, end))
        states = np.full(len(owner), self.start)
        entered = closed & (nth > 0)
        states[entered], _ = self.follow(states[entered], data[first[entered]])
        counts = self.walk(data, body, end - body, states)
        counts[entered] += 1
        # In turns: a chunk may be entered once its predecessor's end state is known.
        head_end = np.where(nth == 0, begin, np.where(closed, np.minimum(first, end), end))
        known, waiting = closed.copy(), np.flatnonzero(nth > 0)
        while len(waiting):
            ready = waiting[known[waiting - 1]]
            entry = states[ready - 1].copy()
            counts[ready] += self.walk(data, begin[ready], head_end[ready] - begin[ready], entry)
            opened = ~closed[ready]
            states[ready[opened]] = entry[opened]
            known[ready] = True
            done = np.zeros(len(owner), bool)
            done[ready] = True
            waiting = waiting[~done[waiting]]
        return np.bincount(owner, counts, len(lengths)).astype(np.int64)

    def count_texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and tokens of each text. A special string inside a text is one token."""
        data, offsets = joined_bytes(column)
        n_bytes = np.diff(offsets)
        extra = np.zeros(len(n_bytes), np.int64)
        texts = column.to_pylist() if any(s.encode() in data.tobytes() for s in self.specials) else []
        if texts:
            split = regex.compile("|".join(map(regex.escape, self.specials)))
            parts = [split.split(t or "") for t in texts]
            extra = np.array([len(p) - 1 for p in parts])
            flat = pa.array([x for p in parts for x in p], pa.large_string())
            counts = self.count(*joined_bytes(flat))
            ends = np.cumsum([len(p) for p in parts])
            return n_bytes, np.array([counts[e - len(p) : e].sum() for e, p in zip(ends, parts)]) + extra
        return n_bytes, self.count(data, offsets)


@lru_cache(maxsize=2)
def machine(path: str) -> Transducer:
    """One machine for each worker process and vocabulary."""
    return Transducer(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text: (id, n_bytes, n_tokens, over_limit).

    A null or empty text has none. Repeated rows stay repeated, a null id stays null,
    other columns are dropped before any work, and an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n_bytes, n_tokens = machine(vocabulary).count_texts(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_tokens > limit)],
                    [id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    lean = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return lean.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
