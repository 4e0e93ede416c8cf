"""Suffix-array dedup: bytes of repeated 100-byte strings, later occurrences removed.

Sorting every suffix would move a hundred times the corpus, so the suffix array
is sparse: it holds the suffixes at seeds (of the 24-byte strings in each
100-byte window the one of least hash, about 3 in 100 bytes). Equal windows have
equal seeds at equal places, so each match of 100 bytes meets at a seed suffix.

1. Texts: each distinct text is kept once (compressed), for its least doc_id. A
   copy of it is an earlier text throughout: all of a copy's windows go.
2. Seeds are shuffled by hash; those met once are dropped.
3. Suffixes at the others go, with the bytes before them that their windows
   reach, to buckets: splitters sampled over all of them range-partition them by
   the whole suffix (100 bytes at most), ties by a hash of their place, so a
   leading string that many documents share spans as many buckets as it needs.
   A task sorts ``SORT_BYTES`` at once, cut between leading strings of 24 bytes
   where it can be.
4. A bucket sorts its suffixes by multikey quicksort, eight bytes a digit, and
   takes the common prefix of neighbours. A window that begins l bytes before
   its seed is equal to another one where the l bytes before agree (64-bit hash)
   and the suffixes share 100 - l bytes (an interval of the suffix array).
   All but the earliest of equal windows are removed.
5. An interval that touches a cut may go on behind it. Its least occurrence for
   each l and bytes before is given out under a hash of the window, one row for
   each part; of the rows that agree all but the earliest are removed.

Copies of a text are folded before the shuffle, as are equal pieces inside a
batch, so a passage that a third of the corpus holds costs the buckets a row for
each batch and context, in parts of bounded size. All steps read the one shuffle
of the texts.

Defined results: null counts as the empty text. Repeated rows (doc_id and text)
are one document, neither is earlier; rows equal in doc_id alone are ordered by
a hash of their text. A null doc_id is less than others. Other columns are never
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from towerlens.llm.text import (BYTE_CODE, NO_DOC_ID, RADIX, Prefix, chunks, distinct_texts, documents, held_places,
                                joined, known_locally, mix, powers, read_table, repeated, same_value, slices,
                                sliding_argmin, text_keys, unpacked, utf8)

WINDOW = 100
SEED = 24
#: Bytes of pieces that a bucket sorts at once (and those of one Arrow batch more).
SORT_BYTES = 4 << 20


def byte_seeds(raw: np.ndarray, offs: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Starts of windows inside a row, the place of the seed of each, row of each start, and seed hashes."""
    grams = Prefix(BYTE_CODE[raw]).windows(seed)
    sizes = np.diff(offs)
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - window + 1, 0))
    first = np.cumsum(np.maximum(sizes - window + 1, 0)) - np.maximum(sizes - window + 1, 0)
    starts = np.arange(len(row)) - first[row] + offs[row]
    if not len(starts):
        return starts, starts, row, grams
    place = sliding_argmin((grams >> np.uint64(32)).astype(np.uint32), window - seed + 1)
    return starts, place[starts].astype(np.int64), row, grams


def seeds(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """(anchor, known, h1, pos): the seeds of all texts, pre-aggregated by batch."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            raw, offs = joined(unpacked(b.column("z").to_pylist()))
            keys = b.column("h1").to_numpy()
            for i, j in chunks(raw, offs):
                own = offs[i: j + 1] - offs[i]
                _, place, row, grams = byte_seeds(raw[offs[i]: offs[j]], own, window, seed)
                new = np.ones(len(place), dtype=bool)
                new[1:] = place[1:] != place[:-1]
                place, row = place[new], row[new]
                pos = place - own[row]
                key, known = known_locally(grams[place], keys[i + row].view(np.uint64) + mix(pos.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(known), pa.array(keys[i + row]),
                     pa.array(pos.astype(np.int32))], ["anchor", "known", "h1", "pos"])

    return texts.mapInArrow(find, "anchor long, known boolean, h1 long NOT NULL, pos int")


PIECE = pa.schema([("lead", pa.binary()), ("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int32()),
                   ("left", pa.int32()), ("n", pa.int32()), ("piece", pa.binary())])


def pieces(held: DataFrame, window: int, seed: int) -> DataFrame:
    """One row for each repeated seed: the bytes of all windows that have it as theirs.

    ``first`` is the start of the first window, ``left`` its distance from the seed,
    ``n`` the number of windows. A piece met before in the batch comes without
    bytes and with a random ``lead``: all its windows are later occurrences.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            all_ids, all_h1, all_h2 = (b.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
            texts, offs_all = joined(unpacked(b.column("z").to_pylist()))
            for i, j in chunks(texts, offs_all):
                raw, offs = texts[offs_all[i]: offs_all[j]], offs_all[i: j + 1] - offs_all[i]
                starts, place, row, _ = byte_seeds(raw, offs, window, seed)
                wanted = held_places(b.column("places").slice(i, j - i), offs, len(raw))
                begins = np.ones(len(place), dtype=bool)
                begins[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(begins)
                count = np.diff(np.append(at, len(place)))
                keep = wanted[place[at]]
                at, count = at[keep], count[keep]
                if not len(at):
                    continue
                begin, seat, row = starts[at], place[at], row[at]
                end = begin + count - 1 + window
                prefix = Prefix(BYTE_CODE[raw])
                same = prefix.slices(begin, end) + mix((seat - begin).astype(np.uint64) * RADIX + (end - begin).astype(np.uint64))
                doc, h1, h2, pos = all_ids[i + row], all_h1[i + row], all_h2[i + row], begin - offs[row]
                order = np.lexsort((pos, h1, doc, same))
                later = np.zeros(len(order), dtype=bool)
                later[order[1:]] = same[order[1:]] == same[order[:-1]]
                leads, blobs = [], []
                data = raw.tobytes()
                spread = mix(h1.view(np.uint64) + mix(pos.astype(np.uint64)))
                for x, y, gone, s in zip(begin.tolist(), end.tolist(), later.tolist(), spread.tolist()):
                    leads.append(s.to_bytes(8, "big") if gone else None)
                    blobs.append(None if gone else data[x:y])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leads, pa.binary()), pa.array(doc), pa.array(h1), pa.array(h2), pa.array(pos.astype(np.int32)),
                     pa.array((seat - begin).astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(blobs, pa.binary())], schema=PIECE)

    return held.mapInArrow(
        find, "lead binary, doc_id long, h1 long, h2 long, first int, left int, n int, piece binary")


def multikey_order(digits: np.ndarray) -> np.ndarray:
    """Order of rows by their columns: sort by one digit, then only the ties by the next."""
    order = np.argsort(digits[:, 0], kind="stable")
    tied = np.arange(len(order))
    group = np.cumsum(np.concatenate(([0], digits[order[1:], 0] != digits[order[:-1], 0]))) if len(order) else order
    for c in range(1, digits.shape[1]):
        size = np.bincount(group)
        more = size[group] > 1
        tied, group = tied[more], group[more]
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((digits[rows, c], group))
        rows = rows[inner]
        order[tied] = rows
        new = np.concatenate(([False], (digits[rows[1:], c] != digits[rows[:-1], c]) | (group[1:] != group[:-1])))
        group = np.cumsum(new)
    return order


def padded(data: np.ndarray, begin: np.ndarray, length: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of ``length`` bytes from ``begin`` on, in steps, filled with zeros to ``width``."""
    col = np.arange(width)
    inside = col < length[:, None]
    return np.where(inside, data[np.where(inside, begin[:, None] + step * col, 0)], 0).astype(np.uint8)


def later_windows(rows: pa.RecordBatch, window: int, goes_on: tuple[bool, bool] = (False, False)
                  ) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(h1, h2, begin, end) of the windows that an earlier equal one precedes, and (h1, h2, begin, doc_id, g1, g2)
    of the earliest ones that may have equal windows before or after these rows, where the suffixes go on.
    """
    data, offs = utf8(rows.column("piece"))
    doc, h1, h2, first, left, n = (rows.column(c).to_numpy().astype(np.int64)
                                   for c in ("doc_id", "h1", "h2", "first", "left", "n"))
    reach = int(left.max()) + 1
    seat = offs[:-1] + left
    right = offs[1:] - seat
    width = -(-window // 8) * 8
    suffix = padded(data, seat, right, width)
    order = multikey_order(suffix.view(">u8").astype(np.uint64))
    ordered = suffix[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), width)))
    before = padded(data, seat - 1, left, max(reach - 1, 1), -1)
    codes = BYTE_CODE[before] * powers(RADIX, before.shape[1])
    sums = np.concatenate((np.zeros((len(seat), 1), np.uint64), np.cumsum(codes, axis=1, dtype=np.uint64)), axis=1)
    # occurrences in the order in which the earliest of equal windows stays
    seats = first + left
    rank = np.empty(len(seat), dtype=np.int64)
    rank[np.lexsort((seats, h2, h1, doc))] = np.arange(len(seat))
    gone = np.zeros((len(seat), reach + 1), dtype=bool)  # by distance from the seed
    low = left - n + 1
    # all suffixes of the first and the last interval begin as the first and the last suffix do
    ends = np.cumsum(BYTE_CODE[ordered[[0, -1], :window]] * powers(RADIX, window), axis=1, dtype=np.uint64)
    parts = [tuple(np.zeros(0, np.int64) for _ in range(6))]
    for l in range(reach):
        interval = np.cumsum(common < window - l)  # the first one is 1
        has = (low[order] <= l) & (left[order] >= l)
        who, interval, last = order[has], interval[has], interval[-1]
        if not len(who):
            continue
        same = mix(sums[who, l] + mix(interval.astype(np.uint64)))
        inner = np.lexsort((rank[who], same))
        s, r = same[inner], rank[who][inner]
        head = np.concatenate(([True], s[1:] != s[:-1]))
        least = r[np.flatnonzero(head)][np.cumsum(head) - 1]
        gone[who[inner], l] = r > least
        first_, last_ = goes_on[0] & (interval == 1), goes_on[1] & (interval == last)
        given = inner[head & (first_ | last_)[inner]]
        if len(given):
            x = who[given]
            tail = ends[np.where(first_[given], 0, 1), window - l - 1]
            parts.append((h1[x], h2[x], seats[x] - l, doc[x], mix(sums[x, l] + mix(np.full(len(x), l, np.uint64))).view(np.int64),
                          mix(tail).view(np.int64)))
    edge = np.diff(np.concatenate((np.zeros((len(seat), 1), np.int8), gone.astype(np.int8)), axis=1), axis=1)
    who, nearest = np.nonzero(edge == 1)
    _, past = np.nonzero(edge == -1)
    marks = [h1[who], h2[who], seats[who] - (past - 1), seats[who] - nearest + window]
    return marks, [np.concatenate(x) for x in zip(*parts)]


MARK = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()),
                  ("doc_id", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64())])


def sort_buckets(found: DataFrame, window: int, seed: int) -> DataFrame:
    """(h1, h2, begin, end, doc_id, g1, g2): spans of later occurrences, and windows to compare by ``g1`` and ``g2``."""

    def batch(cols: list, names: list[str]) -> pa.RecordBatch:
        given = dict(zip(names, cols))
        return pa.RecordBatch.from_arrays(
            [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(len(cols[0]), f.type) for f in MARK],
            schema=MARK)

    def spans(rows: pa.Table, goes_on: tuple[bool, bool]) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks().to_batches()[0]
        blank = np.asarray(rows.column("piece").is_null())
        folded = rows.filter(pa.array(blank))
        if len(folded):
            h1, h2, begin, n = (folded.column(c).to_numpy() for c in ("h1", "h2", "first", "n"))
            yield batch([h1, h2, begin, begin + n - 1 + window], ["h1", "h2", "begin", "end"])
        rest = rows.filter(pa.array(~blank))
        if len(rest):
            marks, parts = later_windows(rest, window, goes_on)
            yield batch(marks, ["h1", "h2", "begin", "end"])
            if len(parts[0]):
                yield batch([*parts, parts[2] + window], ["h1", "h2", "begin", "doc_id", "g1", "g2", "end"])

    def lead(rows: pa.Table, at: int) -> bytes:
        piece, left = rows["piece"][at].as_py(), rows["left"][at].as_py()
        return rows["lead"][at].as_py() if piece is None else piece[left: left + seed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, before = [], 0, True  # whether the first suffixes may go on in what was read before
        for b in batches:
            if not len(b):
                continue
            held.append(b)
            size += b.column("piece").nbytes
            if size < SORT_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            last, cut, low = lead(rows, len(rows) - 1), len(rows), 0
            while low < cut:  # leads are sorted: find where the last one begins
                mid = (low + cut) // 2
                if lead(rows, mid) < last:
                    low = mid + 1
                else:
                    cut = mid
            # one lead alone is cut here, all others where the last one begins
            yield from spans(rows.slice(0, cut or len(rows)), (before, not cut))
            held, before = rows.slice(cut).to_batches() if cut else [], not cut
            size = sum(x.column("piece").nbytes for x in held)
        if held:
            yield from spans(pa.Table.from_batches(held), (before, True))

    suffix = F.coalesce("lead", F.substring("piece", F.col("left") + 1, F.lit(window)))
    dealt = found.repartitionByRange(suffix, F.xxhash64("h1", "first")).sortWithinPartitions(suffix)
    return dealt.mapInArrow(run, "h1 long, h2 long, begin int, end int, doc_id long, g1 long, g2 long")


def later_spans(found: DataFrame, window: int, seed: int) -> DataFrame:
    """(h1, h2, begin, end): spans of all later occurrences, those across buckets included."""
    marks = sort_buckets(found, window, seed)
    # sure spans are alone or stay beside each other; one flow of both kinds, so that buckets are sorted once
    own = Window.partitionBy("sure", F.coalesce("g1", "h1"), F.coalesce("g2", "begin"))
    nth = F.row_number().over(own.orderBy("doc_id", "h1", "h2", "begin"))
    marks = marks.withColumn("sure", F.col("g1").isNull()).withColumn("nth", nth)
    return marks.where("sure OR nth > 1").select("h1", "h2", "begin", "end")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def suffix_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): bytes left of each document, and the byte spans removed."""
    docs = documents(docs)
    texts = distinct_texts(docs)
    places = repeated(seeds(texts, window, seed), "anchor").groupBy("h1").agg(F.collect_set("pos").alias("places"))
    found = pieces(texts.join(places, "h1"), window, seed)
    marks = later_spans(found, window, seed).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "begin", "end")
    marks = marks.repartition("k1").groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("marks"))
    # only h1 is a join key and no column is left out, so that all steps share the shuffle of the texts
    marked = texts.join(marks, (F.col("h1") == F.col("k1")) & same_value("h2", "k2"), "left")
    # rows come to the texts, so that no text moves again
    cut_from = text_keys(docs).join(marked, (F.col("r1") == F.col("h1")) & same_value("r2", "h2"))
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            own = b.column("row_id").fill_null(NO_DOC_ID).to_numpy() == b.column("doc_id").to_numpy()
            for text, first, marks in zip(unpacked(b.column("z").to_pylist()), own, b.column("marks").to_pylist()):
                if first:
                    runs = merged([(m["begin"], m["end"]) for m in marks or []])
                else:  # a copy's windows all occur earlier; a text shorter than a window has none
                    runs = [(0, len(text))] if len(text) >= window else []
                ends = [0, *(e for _, e in runs)]
                left = b"".join(text[x:y] for x, y in zip(ends, [*(r[0] for r in runs), len(text)]))
                rows.append((len(text), len(text) - len(left), [{"begin": x, "end": y} for x, y in runs], left))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), span, pa.binary())))],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return cut_from.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
