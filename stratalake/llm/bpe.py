"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A sequence of tokens is what the merges make of its bytes exactly when every two neighbours are:
no merge across their border comes before the merges that use up one of its sides. So a
nondeterministic transducer suffices, which walks the trie of tokens and may emit a token whose
border with the one before holds. It is made deterministic lazily: a state is the set of (tokens
not yet emitted, trie node) that the bytes so far allow, and what all of them begin with is emitted.
"""

from __future__ import annotations

import base64
import itertools
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import BYTE_LEVEL, in_batches, kept, plain_words, raw, schema_of, slices, unsure

NEVER = 1 << 40
MAX_WORDS, MAX_STATES = 300_000, 200_000  # remembered by a worker


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Ranks of byte strings, and how each token comes about."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.piece = {i: p for p, i in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._good: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for a byte or a token that no merge gives."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.piece[token]]
            whole = len(parts) == 1
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], NEVER), i))
                if self.rank.get(parts[at] + parts[at + 1], NEVER) >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = len(parts) == 2 and all(p in self.rank for p in parts)
            self._halves[token] = (self.rank[parts[0]], self.rank[parts[1]]) if made and not whole else None
        return self._halves[token]

    def made(self, token: int) -> bool:
        return len(self.piece[token]) == 1 or self.halves(token) is not None

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens.

        Back in time from the finished pair: the younger of the two tokens at the border is taken
        apart, until both are bytes. Each pair met so must not have merged while it stood.
        """
        key = left << 32 | right
        if key in self._good:
            return self._good[key]
        until_left = until_right = NEVER
        good, rank, piece, known = True, self.rank, self.piece, self._halves
        while True:
            merged = rank.get(piece[left] + piece[right])
            # at equal rank the leftmost merge comes first
            if merged is not None and merged < until_left and merged <= until_right:
                good = False
                break
            a = known[left] if left in known else self.halves(left)
            b = known[right] if right in known else self.halves(right)
            if a is None and b is None:
                break
            if b is None or (a is not None and left > right):
                until_left, left = left, a[1]
            else:
                until_right, right = right, b[0]
        if len(self._good) >= 1 << 18:
            self._good.clear()
        self._good[key] = good
        return good


class _State:
    """The ways open after some bytes: pairs of (tokens not yet emitted, trie node).

    No two of them have begun their node at the same byte; they come in the order of these bytes. So only the
    first one may have no tokens, and only the last one may stand at the root: there the bytes so far end.
    """

    __slots__ = ("end", "next", "open")

    def __init__(self, open_: tuple):
        self.open = open_
        # byte -> (state, out), or [tokens whose border with the last emitted one decides, {answers: (state, out)}]
        self.next: dict[int, tuple | list] = {}
        self.end = open_[-1][0] if open_[-1][1] == 0 else ()


class Transducer:
    """Bytes to tokens. The last emitted token is kept in a register, so that states are few; they are
    made when first met. Beyond ``max_states`` the younger half is forgotten: frequent words meet theirs first."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.merges = Merges(ranks)
        self.max_states = max_states
        self.child: dict[int, int] = {}  # node << 8 | byte -> node; few bytes a node
        self.token = array("i", [-1])
        self.inner = bytearray(1)  # whether a node has children
        for piece, token in ranks.items():
            node = 0
            for b in piece:
                to = self.child.get(node << 8 | b)
                if to is None:
                    to = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                    self.inner[node] = 1
                    self.inner.append(0)
                node = to
            self.token[node] = token if self.merges.made(token) else -1
        self.states: dict[tuple, _State] = {}
        self.start = self._state((((), 0),))

    def _forget(self) -> None:
        self.states = dict(itertools.islice(self.states.items(), max(1, self.max_states // 2)))
        stay = set(map(id, self.states.values()))
        for state in self.states.values():
            ways = {}
            for byte, to in state.next.items():
                if type(to) is list:
                    to[1] = {answers: way for answers, way in to[1].items() if id(way[0]) in stay}
                if to[1] if type(to) is list else id(to[0]) in stay:
                    ways[byte] = to
            state.next = ways

    def _state(self, open_: tuple) -> _State:
        if open_ not in self.states:
            self.states[open_] = _State(open_)
        return self.states[open_]

    def _step(self, state: _State, byte: int, asked: tuple[int, ...], answers: int) -> tuple[_State, tuple[int, ...]]:
        """The state after ``byte`` and what is emitted: what all ways now begin with.

        Bytes have one sequence of tokens only, so after a way that ends here no other border is tried.
        """
        ways, ended = [], None
        child, inner, ends = self.child, self.inner, self.token
        for way in state.open:
            to = child.get(way[1] << 8 | byte)
            if to is None:
                continue
            pending = way[0]
            if inner[to]:
                ways.append((pending, to))
            token = ends[to]
            if token >= 0 and ended is None and (
                self.merges.neighbours(pending[-1], token) if pending else answers >> asked.index(token) & 1
            ):
                ended = (*pending, token)
        if ended is not None:
            ways.append((ended, 0))
        first, n = ways[0][0], 0
        while n < len(first) and all(len(p) > n and p[n] == first[n] for p, _ in ways):
            n += 1
        return self._state(tuple([(p[n:], node) for p, node in ways] if n else ways)), first[:n]

    def _first(self, state: _State, byte: int) -> tuple | list:
        pending, node = state.open[0]
        token = -1 if pending else self.token[self.child.get(node << 8 | byte, 0)]
        state.next[byte] = made = [(token,), {}] if token >= 0 else self._step(state, byte, (), 0)
        return made

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self._forget()
        state, out, last, neighbours = self.start, [], -1, self.merges.neighbours
        for b in piece:
            to = state.next.get(b) or self._first(state, b)
            if type(to) is list:
                asked, table = to
                answers = 0
                for i, token in enumerate(asked):
                    if last < 0 or neighbours(last, token):
                        answers |= 1 << i
                to = table.get(answers)
                if to is None:
                    to = table[answers] = self._step(state, b, asked, answers)
            state = to[0]
            if to[1]:
                out += to[1]
                last = out[-1]
        return out + list(state.end)


class Encoder(dict):
    """Texts to tokens: the pattern cuts a text, the transducer encodes each match.

    Results of short matches are remembered as packed numbers, up to ``max_words``: in two halves, of which the
    older one goes, but for the words met again, when the younger one is full.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_words: int = MAX_WORDS, max_states: int = MAX_STATES):
        super().__init__()
        cut = regex.compile(pattern).findall
        self.cut = (lambda text: cut(text) if unsure(text) else plain_words(text)) if pattern == BYTE_LEVEL else cut
        self.machine = Transducer(ranks, max_states)
        self.max_words = max_words
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = struct.pack(f"<{len(ids)}i", *ids) if (ids := self.machine.encode(word.encode())) else b""
        if len(word) <= 64:
            if 2 * len(self) >= self.max_words:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.cut(text))), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        return "".join(decode_stream(ids.tolist(), self.machine.merges.piece.__getitem__))


def _second_bytes(lead: int) -> tuple[int, int]:
    """What may follow a leading byte: no overlong forms, no surrogates, nothing beyond U+10FFFF."""
    return {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))


class Utf8Machine:
    """Bytes to text piece by piece. The state is the begun character; bad bytes become U+FFFD."""

    def __init__(self) -> None:
        self.begun = b""

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        cut = len(data) - self._open_tail(data)
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _open_tail(data: bytes) -> int:
        """How many last bytes begin a character that is not complete."""
        for n in range(1, min(3, len(data)) + 1):
            lead = data[-n]
            if lead < 0x80:
                return 0
            if lead >= 0xC0:
                need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
                low, high = _second_bytes(lead)
                return n if n < need and (n == 1 or low <= data[1 - n] <= high) else 0
        return 0


def decode_stream(ids: Iterable[int], piece: Callable[[int], bytes], chunk: int = 4096) -> Iterator[str]:
    """Text as the tokens come in, ``chunk`` tokens at a time."""
    machine, ids = Utf8Machine(), iter(ids)
    while some := list(itertools.islice(ids, chunk)):
        yield machine.feed(b"".join(map(piece, some)))
    if rest := machine.close():
        yield rest


def _encoder(ranks_path: str, pattern: str, max_words: int, max_states: int) -> Encoder:
    """One per Python worker, for all tasks of the operator: about 35 MB, and a kilobyte a state and word at most."""
    return kept(
        ("bpe", ranks_path, pattern, max_words, max_states),
        lambda: Encoder(read_ranks(ranks_path), pattern, max_words, max_states),
    )


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of tokens).

    Null counts as empty, and empty texts have no tokens; repeated rows are encoded alike; other
    columns are not read. Bytes that are not UTF-8 count as U+FFFD. ``ranks_path`` is read on each worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern, MAX_WORDS, MAX_STATES)
        for batch in slices(batches, 1, keep=True):
            ids = [encoder.encode(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], [id_col, "ids"])

    return in_batches(docs.select(id_col, raw(text_col).alias("__text")), run, schema_of(docs, id_col, "ids array<int>"))


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``tokens``: id, ids, text. Null or no tokens give an empty text; an id outside
    the ranks is an error, bytes that are not UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {i: p for p, i in read_ranks(ranks_path).items()}.__getitem__
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                ids = part.column(1)
                flat, ends = ids.flatten().to_numpy().tolist(), np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_pylist()])
                texts = ["".join(decode_stream(flat[a:b], piece)) for a, b in itertools.pairwise(ends.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], [id_col, "ids", "text"])

    return tokens.select(id_col, F.col(ids_col).alias("ids")).mapInArrow(
        run, schema_of(tokens, id_col, "ids array<int>, text string")
    )


def round_trip(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
    max_states: int = MAX_STATES,
) -> DataFrame:
    """``encode`` and ``decode`` one after the other in one pass: id, ids, text (decoded from the ids).

    One Python worker a core instead of two, and rows as in both: null counts as empty, bytes that are not
    UTF-8 come back as U+FFFD. ``max_words`` and ``max_states`` bound what a worker remembers, not what it encodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern, max_words, max_states)
        for batch in slices(batches, 1, 2 << 20, keep=True):
            ids = [encoder.encode(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            texts = pa.array(map(encoder.decode, ids), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), texts], [id_col, "ids", "text"])

    return in_batches(docs.select(id_col, raw(text_col).alias("__text")), run, schema_of(docs, id_col, "ids array<int>, text string"))
