"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

Encoding. The text gets a space in front, spaces become U+2581, and every
character is a symbol: the id of its piece, or a number of its own where no piece
is that character. Two neighbours that no piece holds side by side can never be
merged into one, so the text is cut there into words, and equal words of a chunk
are encoded once (``merges``: flat symbol arrays, the least pair rank of each word,
leftmost merges at once, compaction until no pair remains). What is left
without a piece becomes the byte pieces of its UTF-8.

Decoding. Ids become the bytes of their pieces, U+2581 becomes a space, the space in
front goes, byte pieces join to characters; a byte that belongs to none is U+FFFD.

Models: BPE with byte fallback and the identity normaliser, without user-defined or
unused pieces; any other is refused, never encoded differently.

Memory: a task holds one Arrow batch of texts and the arrays of one chunk, about
``CHUNK`` characters. A longer text is encoded in parts, cut between words.

Defined results: null and empty texts have no ids and decode to the empty text;
strings of control pieces in a text are ordinary text. Rows are encoded one by one,
so repeated rows and ties give equal rows; null doc_ids stay null. An empty table
gives none. Other columns, whatever their names, are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.merges import Merges, ragged_take
from towerlens.llm.text import documents, read_table

#: Characters encoded at once.
CHUNK = 1 << 20

SPACE = 0x2581
#: Symbols of characters without a piece begin here: OTHER + code point.
OTHER = 1 << 24


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffers message."""
    at = 0

    def varint() -> int:
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
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at: at + size]
        at += size


class Model:
    """Pieces, merge table and cuts of a model file."""

    def __init__(self, data: bytes):
        self.text: list[str] = []
        score: list[float] = []
        kind: list[int] = []
        # Numbers of the file format: 1 piece (1 text, 2 score, 3 type), 2 trainer (3 model type, 35 byte
        # fallback), 3 normaliser (1 name, 2 rules, 3 space in front, 4 fewer spaces, 5 escaped spaces).
        trainer, normal = {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                self.text.append(piece[1].decode())
                score.append(float(np.frombuffer(piece.get(2, bytes(4)), dtype="<f4")[0]))
                kind.append(piece.get(3, 1))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        # Types: 1 normal, 2 unknown, 3 control, 6 byte. The first two defaults of the format are true.
        if (trainer.get(3), trainer.get(35)) != (2, 1) or set(kind) - {1, 2, 3, 6} or kind.count(6) != 256:
            raise ValueError("not a BPE model with byte fallback and plain pieces")
        if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("the model's normaliser is not the identity with a space in front")
        ids = {t: i for i, (t, k) in enumerate(zip(self.text, kind)) if k == 1}
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i, (t, k) in enumerate(zip(self.text, kind)):
            if k == 6:
                self.byte_id[int(t[3:5], 16)] = i
        order = {s: r for r, s in enumerate(sorted({score[i] for i in ids.values()}, reverse=True))}

        def symbol(t: str) -> int | None:
            return ids.get(t, OTHER + ord(t) if len(t) == 1 else None)

        pairs, beside = {}, set()
        for t, i in ids.items():
            beside.update(zip(t, t[1:]))
            for cut in range(1, len(t)):
                left, right = symbol(t[:cut]), symbol(t[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = order[score[i]], i
        self.merges = Merges(pairs)
        self.symbol = np.arange(OTHER, OTHER + 0x110000, dtype=np.int32)
        for t, i in ids.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        chars = sorted({c for pair in beside for c in pair})
        self.group = np.zeros(0x110000, dtype=np.int16)  # 0: a character of no longer piece
        self.group[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.held = np.zeros((len(chars) + 1,) * 2, dtype=bool)
        at = np.array([[ord(a), ord(b)] for a, b in beside]).reshape(-1, 2)
        self.held[self.group[at[:, 0]], self.group[at[:, 1]]] = True
        # decoding
        self.is_byte, self.is_control = np.array(kind) == 6, np.array(kind) == 3
        out = [bytes([int(t[3:5], 16)]) if k == 6 else t.replace(chr(SPACE), " ").encode() if k == 1
               else b"" if k == 3 else " ⁇ ".encode() for t, k in zip(self.text, kind)]
        self.bytes = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.ends = np.append(0, np.cumsum([len(x) for x in out]))

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character."""
        group = self.group[points]
        out = np.ones(len(points), dtype=bool)
        out[1:] = ~self.held[group[:-1], group[1:]]
        return out

    def encode_words(self, points: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and n+1 ends; words begin at flagged characters, equal ones are encoded once."""
        start = np.append(np.flatnonzero(begins), len(points)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start) - 1, [None, pa.py_buffer(start * 4), pa.py_buffer(points)]).dictionary_encode()
        distinct = words.dictionary
        ends = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[: len(distinct) + 1] // 4
        symbols = self.symbol[np.frombuffer(distinct.buffers()[2], dtype=np.uint32)[: ends[-1]]]
        ids, ends = self.spelled(*self.merges.run(symbols, ends))
        ids, size = ragged_take(ids, ends, words.indices.to_numpy())
        return ids, np.append(0, np.cumsum(size))

    def spelled(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become byte pieces."""
        other = np.flatnonzero(symbols >= OTHER)
        if not len(other):
            return symbols, ends
        raw = [chr(p).encode() for p in (symbols[other] - OTHER).tolist()]
        size = np.ones(len(symbols), dtype=np.int64)
        size[other] = [len(x) for x in raw]
        after = np.append(0, np.cumsum(size))
        out = np.repeat(symbols, size)
        out[np.repeat(symbols >= OTHER, size)] = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return out, after[ends]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and n+1 ends."""
        done, size, at = [], np.zeros(len(texts), dtype=np.int64), 0
        while at < len(texts):
            end, total = at, 0
            while end < len(texts) and (end == at or total + len(texts[end]) <= CHUNK):
                total += len(texts[end])
                end += 1
            if end == at + 1:
                for points in self.parts(texts[at]):
                    ids, _ = self.encode_words(points, self.cuts(points))
                    done.append(ids)
                    size[at] += len(ids)
            else:
                part = [" " + t if t else "" for t in texts[at:end]]
                first = np.append(0, np.cumsum([len(t) for t in part]))
                points = self.points("".join(part))
                begins = self.cuts(points)
                begins[first[:-1][np.diff(first) > 0]] = True
                ids, ends = self.encode_words(points, begins)
                done.append(ids)
                size[at:end] = np.diff(ends[np.append(0, np.cumsum(begins))[first]])
            at = end
        return np.concatenate(done or [np.zeros(0, np.int32)]), np.append(0, np.cumsum(size))

    @staticmethod
    def points(text: str) -> np.ndarray:
        out = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).copy()
        out[out == 32] = SPACE
        return out

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """A text's characters, in parts that end between words."""
        at, size, lead = 0, CHUNK, " " if text else ""
        while at < len(text):
            points = self.points(lead + text[at: at + size])
            if at + size >= len(text):
                yield points
                return
            begin = np.flatnonzero(self.cuts(points))[-1]
            if not begin:  # one word so far
                size *= 2
                continue
            yield points[:begin]
            at, size, lead = at + int(begin) - len(lead), CHUNK, ""

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 of the text of each list of ids."""
        flat, size = ragged_take(self.bytes, self.ends, ids)
        at = np.append(0, np.cumsum(size))
        data, out = flat.tobytes(), []
        some_bytes = np.append(0, np.cumsum(self.is_byte[ids]))
        for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
            text = data[at[i]: at[j]]
            if text[:1] == b" " and self.leads(ids[i:j]):
                text = text[1:]
            if some_bytes[i] < some_bytes[j]:
                try:
                    text.decode()
                except UnicodeDecodeError:
                    text = self.mended(ids[i:j].tolist())
            out.append(text)
        return out

    def leads(self, ids: Iterable[int]) -> bool:
        """Whether the first piece, control pieces aside, begins with the space in front."""
        return next((self.text[i][:1] == chr(SPACE) for i in map(int, ids) if not self.is_control[i]), False)

    def mended(self, ids: list[int]) -> bytes:
        """The text of ids whose byte pieces are not all characters: U+FFFD for each byte of none."""
        out, run, lead = [], bytearray(), self.leads(ids)

        def close() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at: at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    size = 1
                at += size
            run.clear()

        for i in ids:
            raw = self.bytes[self.ends[i]: self.ends[i + 1]].tobytes()
            if self.is_byte[i]:
                run += raw
                continue
            close()
            out.append(raw.decode())
        close()
        return "".join(out)[lead:].encode()


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver: tasks get its bytes, not its place."""
    with open(path, "rb") as f:
        return f.read()


def batches_of(batches: Iterator[pa.RecordBatch], size: int = 8 * CHUNK) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with about ``size`` bytes of text, one row at least, and their texts."""
    for b in batches:
        column = b.column("text").cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(b) + 1]
        at = 0
        while at < len(b):
            end = min(max(int(np.searchsorted(ends, ends[at] + size, side="right")) - 1, at + 1), len(b))
            yield b.slice(at, end - at), [t or "" for t in column.slice(at, end - at).to_pylist()]
            at = end


def as_lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids): the piece ids of every text."""
    data = read_file(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(data)
        for b, texts in batches_of(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), as_lists(*model.encode(texts))], ["doc_id", "ids"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the decoded text beside the ids. Null ids count as none."""
    data = read_file(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(data)
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.slice(at, 1000)
                lists = part.column("ids")
                ends = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
                texts = model.decode(lists.flatten().to_numpy(), ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array([t.decode() for t in texts], pa.string())],
                    ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    out = decode(encode(docs, model_path), model_path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
