"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

Encoding. Each match of the split pattern is read byte by byte. A prefix has the
last token of its own encoding. With one more byte, the last token is the one
token that ends there and that stays apart from the last token of the prefix
before it (the pair encodes to itself). Only places from which the bytes since
then begin some longer token can matter later: these, with their last tokens, are
the state, so prefixes with one future share a state. States and steps follow from
the merges alone; they are built when first met and kept in a table of bounded
size. Tokens on which the paths from all live places agree are emitted: the
lookahead is bounded by the longest token. A piece that is itself a token is that
token.

Decoding. Ids become bytes; a UTF-8 state machine tells after each token whether
a character is still open, and text is emitted up to the last whole character.

Defined results: null and empty texts have no ids and decode to the empty text.
Special tokens in a text are ordinary text. Every row is encoded alone, so
repeated rows and ties are equal rows. Other columns are never read.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.text import documents, read_table, slices

#: States, pairs of tokens and encoded pieces that a task keeps before it starts afresh: some 200 MB when full.
MAX_STATES, MAX_PAIRS, MAX_PIECES = 200_000, 400_000, 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class State:
    """What later bytes can reach: ``live`` holds (distance back, last token there) of each place from
    which the bytes since then begin a longer token; ``tail`` is the bytes since the furthest."""

    __slots__ = ("tail", "live", "size", "rank", "steps")

    def __init__(self, tail: bytes, live: tuple, rank: int = -1):
        self.tail, self.live, self.steps = tail, live, {}
        self.size, self.rank = len(live[-1][1]), rank  # of the last token


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.reach = ranks, max(map(len, ranks))
        self.begun = {t[:k] for t in ranks for k in range(1, len(t))}
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[tuple, State] = {}
        self.forget()

    def forget(self) -> None:
        """Start afresh. Steps lead from state to state and back: cut, they free all states at once."""
        for state in self.states.values():
            state.steps.clear()
        self.root = State(b"", ((0, b""),))
        self.states = {(b"", self.root.live): self.root}

    def merged(self, piece: bytes) -> list[bytes]:
        """Plain merges, for the short strings of two tokens."""
        rank, never = self.ranks.get, 1 << 62
        parts = [piece[i: i + 1] for i in range(len(piece))]
        pairs = [rank(x + y, never) for x, y in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == never:
                break
            i = pairs.index(best)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], never)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], never)
        return parts

    def stay_apart(self, left: bytes, right: bytes) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) >= MAX_PAIRS:
                self.apart.clear()
            both = left + right
            known = self.apart[left, right] = both not in self.ranks and self.merged(both) == [left, right]
        return known

    def step(self, state: State, byte: int) -> State:
        """The state after one more byte."""
        tail, ranks, begun, last, live = state.tail + bytes((byte,)), self.ranks, self.begun, None, []
        end = len(tail) - 1
        for back, left in state.live:
            token = tail[end - back:]
            if last is None and token in ranks and (not left or self.stay_apart(left, token)):
                last = token
            if token in begun:
                live.append((back + 1, left))
        live = (*live, (0, last))
        key = (tail[len(tail) - live[0][0]:], live)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(*key, ranks[last])
        state.steps[byte] = found
        return found

    def ids(self, piece: bytes) -> list[int]:
        """Token ids of a piece."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(piece) > 8 * self.reach:
            return [self.ranks[t] for t in self.stream(piece)]
        if len(self.states) > MAX_STATES:
            self.forget()
        state, path = self.root, []
        for byte in piece:
            state = state.steps.get(byte) or self.step(state, byte)
            path.append(state)
        out, end = [], len(piece)
        while end:
            state = path[end - 1]
            out.append(state.rank)
            end -= state.size
        out.reverse()
        return out

    def stream(self, piece: bytes) -> Iterator[bytes]:
        """Tokens of a piece, each emitted once later bytes cannot change it."""
        if piece in self.ranks:
            yield piece
            return
        if len(self.states) > MAX_STATES:
            self.forget()
        state, sizes, done = self.root, [], 0
        for at, byte in enumerate(piece):
            state = state.steps.get(byte) or self.step(state, byte)
            sizes.append(state.size)
            if at - done >= 8 * self.reach:
                agreed = set(self.path(sizes, at + 1, done))
                for back, _ in state.live:
                    agreed &= set(self.path(sizes, at + 1 - back, done))
                for end in sorted(agreed - {done}):
                    yield piece[done:end]
                    done = end
        ends, end = [], len(piece)
        while end > done:
            ends.append(end)
            end -= sizes[end - 1]
        for end in reversed(ends):
            yield piece[done:end]
            done = end

    @staticmethod
    def path(sizes: list[int], end: int, done: int) -> Iterator[int]:
        """Token ends from ``end`` back to ``done``."""
        while end > done:
            yield end
            end -= sizes[end - 1]
        yield done


class Utf8Machine:
    """State after each byte: continuation bytes due and the range of the next; None is the start."""

    def __init__(self):
        self.state = None

    @staticmethod
    def step(state, byte: int):
        if state is None:
            if byte < 0x80:
                return None
            for low, high, due, first, last in ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF),
                                                (0xED, 0xED, 2, 0x80, 0x9F), (0xE1, 0xEF, 2, 0x80, 0xBF),
                                                (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F),
                                                (0xF1, 0xF3, 3, 0x80, 0xBF)):
                if low <= byte <= high:
                    return due, first, last
            raise ValueError(f"byte {byte:#x} begins no character")
        due, first, last = state
        if not first <= byte <= last:
            raise ValueError(f"byte {byte:#x} does not continue the character")
        return (due - 1, 0x80, 0xBF) if due > 1 else None

    def feed(self, data: bytes) -> None:
        for byte in data:
            self.state = self.step(self.state, byte)


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.closed = np.zeros(len(self.bytes_of), dtype=bool)  # tokens of whole characters
        for token, i in ranks.items():
            try:
                token.decode()
                self.closed[i] = True
            except UnicodeDecodeError:
                pass

    def stream(self, ids: np.ndarray, size: int = 1 << 14) -> Iterator[bytes]:
        """Decoded text in parts of whole characters, from ``size`` ids at a time."""
        machine, held = Utf8Machine(), b""
        for at in range(0, len(ids), size):
            part = ids[at: at + size]
            tokens = [self.bytes_of[i] for i in part.tolist()]
            for i in np.flatnonzero(~self.closed[part]):
                machine.feed(tokens[i])
            data = held + b"".join(tokens)
            cut = len(data) - (self.open_bytes(data) if machine.state is not None else 0)
            held = data[cut:]
            yield data[:cut]
        if machine.state is not None:
            raise ValueError("the ids end inside a character")

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """Bytes at the end of ``data`` since its last lead byte: the open character."""
        back = 1
        while data[-back] < 0xC0:
            back += 1
        return back


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, find = Transducer(load_ranks(ranks_path)), regex.compile(pattern).findall
        known: dict[str, bytes] = {}  # ids of each piece met, as int32

        def ids_of(pieces: list[str]) -> bytes:
            for piece in set(pieces).difference(known):
                known[piece] = pack("<%di" % len(out := machine.ids(piece.encode())), *out)
            return b"".join(map(known.__getitem__, pieces))

        gc.disable()  # forget() frees the states; walking them over and over is a third of the work
        try:
            for b in slices(batches, 2000):
                parts = []
                for text in b.column("text").to_pylist():
                    if len(known) >= MAX_PIECES:
                        known.clear()
                    parts.append(ids_of(find(text or "")))
                ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in parts]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists], ["doc_id", "ids"])
        finally:
            machine.forget()
            gc.enable()

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the decoded text beside the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load_ranks(ranks_path))
        for b in slices(batches, 2000):
            lists = b.column("ids")
            flat, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            texts = [b"".join(decoder.stream(flat[i:j])) for i, j in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists, pa.array(texts, pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    out = decode(encode(docs, ranks_path, pattern), ranks_path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read_table(spark, sf_dir, "documents"),
                   public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
