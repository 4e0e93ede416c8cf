"""N-gram Jaccard join: a size-aware heavy-light self-join of shingle sets.

Sets of at most ``boundary()`` shingles are light: two sets of sizes n <= m link
when they share c = ceil(3 (n + m) / 7) shingles, so each emits its subsets of c
shingles, and equal subsets are links with nothing left to verify. The boundary
is the largest size whose subsets cost less than the scan of inverted lists.
Larger sets are heavy: the prefix of a set (its first n - ceil(3 n / 4) + 1
shingles in one order for all sets) goes to inverted lists, and a linked pair
meets in one of them. The order puts frequent shingles last, so a passage that many
documents share is seldom in a prefix; every document is counted, in a fixed number
of hash buckets. The order decides the work, never the result.

Documents with equal sets are one set (64-bit signature). Sets that meet in a list
become candidates if sizes and prefix positions allow a link and their MinHash
sketches (64 values) agree in ``SKETCH_LEAST`` places; a pair that links has each
place equal with probability 0.75 or more, and fails that with less than 2e-13,
the order of a hash collision. A list gives out no more candidates than connect
its sets. Components of candidates are groups; inside a group every set is
compared exactly with all that it is not yet linked to, by scanning the group's
inverted lists, so a group of near copies gives out one link for each set and not
all pairs. A group of more than ``BLOCK`` sets is cut into blocks by hash, no task
holds more than two blocks, and links come in rounds: inside blocks; then each
block with the ``PIVOTS`` sets of the group that linked most; then pairs of blocks,
but only where one holds sets outside the group's largest cluster.

Defined results: null texts, empty texts and texts without words have an empty
set, link with nothing and are their own component. Repeated rows have equal
sets. A text of fewer than five words has one shingle, the whole sequence. A
null doc_id is greater than others. Other columns are never read; ``keep_rows``
carries them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from towerlens.llm.components import components, written
from towerlens.llm.text import (
    Prefix, Words, chunks, documents, joined, mix, read_table, slices, unpacked, utf8, whole_row,
)
from towerlens.session import new_run_dir

SHINGLE = 5
#: Buckets in which shingles are counted for their order, and slices of buckets that are summed apart.
ORDER_BUCKETS, ORDER_SLICES = 1 << 19, 32
#: Share of the buckets that the order puts last, and the least count of one of them.
ORDER_SHARE, ORDER_LEAST = 1 / 8, 4
#: MinHash values of a sketch, and how many must agree for a candidate.
SKETCH, SKETCH_LEAST = 64, 18
#: Sets of a group that one block holds.
BLOCK = 2048
#: Sets of a large group that all of its blocks are compared with.
PIVOTS = 64


def need(n, m):
    """Shared shingles from which sets of sizes n and m link: 100 i >= 75 (n + m - i)."""
    return -((n + m) * -3 // 7)


def prefix_size(n):
    return n - -(n * -3 // 4) + 1


def light_cost(n: int) -> int:
    """Subsets that a set of n shingles emits."""
    partners = range(ceil(3 * n / 4), 4 * n // 3 + 1)
    return sum(comb(n, need(n, m)) for m in partners)


def boundary() -> int:
    """Largest size up to which subsets cost less than a prefix in lists and a verification of the set."""
    size = 1
    while light_cost(size + 1) <= 8 * prefix_size(size + 1):
        size += 1
    return size


def shingles(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, by row and hash."""
    words = Words(raw, offs, lower=True)
    prefix = Prefix(words.hashes())
    starts = np.flatnonzero(words.room() >= SHINGLE)
    row, code = words.row[starts], prefix.windows(SHINGLE)[starts]
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    if len(short):
        whole = mix(prefix.slices(words.first[short], words.first[short + 1]) + words.count[short].astype(np.uint64))
        row, code = np.concatenate((row, short)), np.concatenate((code, whole))
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return row[new], code[new]


def signatures(row: np.ndarray, code: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and signature of the set of each row."""
    size = np.bincount(row, minlength=rows)
    total = np.zeros(len(row) + 1, np.uint64)
    np.cumsum(mix(code ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    ends = np.cumsum(size)
    return size, mix(total[ends] - total[ends - size] + size.astype(np.uint64)).view(np.int64)


def bucket_of(code: np.ndarray) -> np.ndarray:
    return (code & np.uint64(ORDER_BUCKETS - 1)).astype(np.int64)


class Measured:
    """What one pass over all documents tells: their sets, and how often shingles occur.

    ``sets``: (doc_id, n, sig), size and signature of each document's set. ``loads``: (slice, loads),
    by task and slice of the buckets how many documents hold shingles of each bucket, as int64 bytes;
    a task gives out its sums once, so they grow with the tasks and not with the shingles.
    """

    def __init__(self, docs: DataFrame):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(ORDER_BUCKETS, np.int64)
            for b in batches:
                raw, offs = utf8(b.column("text"))
                for i, j in chunks(raw, offs):
                    row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                    size, sig = signatures(row, code, j - i)
                    total += np.bincount(bucket_of(code), minlength=ORDER_BUCKETS)
                    yield given([b.column("doc_id").slice(i, j - i), pa.array(size), pa.array(sig), None, None], j - i)
            if total.any():
                squeeze = zstandard.ZstdCompressor(level=3).compress
                loads = [squeeze(x.tobytes()) for x in total.reshape(ORDER_SLICES, -1)]
                yield given([None, None, None, pa.array(np.arange(ORDER_SLICES, dtype=np.int32)), pa.array(loads, pa.binary())],
                            ORDER_SLICES)

        def given(cols: list[pa.Array | None], n: int) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.nulls(n, kind) if c is None else c for c, kind in zip(cols, kinds)],
                                              ["doc_id", "n", "sig", "slice", "loads"])

        folder = new_run_dir(docs.sparkSession, "op8_jaccard")
        docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sig long, slice int, loads binary").write.parquet(folder)
        both = docs.sparkSession.read.parquet(folder)
        self.sets = both.where("slice IS NULL").select("doc_id", "n", "sig")
        self.loads = both.where("slice IS NOT NULL").select("slice", "loads")


def order_levels(loads: DataFrame) -> np.ndarray:
    """Place of each bucket in the order of shingles: 0, or a step more each time that its load doubles.

    The driver gets the sums of the buckets, a fixed number.
    """
    size = ORDER_BUCKETS // ORDER_SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(size, np.int64)
        for b in slices(batches):
            for k, z in zip(b.column("slice").to_pylist(), b.column("loads").to_pylist()):
                if k != at and at is not None:
                    yield given(at, total)
                    total = np.zeros(size, np.int64)
                at = k
                total += np.frombuffer(unpacked([z])[0], np.int64)
        if at is not None:
            yield given(at, total)

    def given(k: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          ["slice", "loads"])

    sums = loads.repartition("slice").sortWithinPartitions("slice").mapInArrow(add, "slice int, loads binary")
    total = np.zeros((ORDER_SLICES, size), np.int64)
    for r in sums.collect():
        total[r.slice] = np.frombuffer(r.loads, np.int64)
    total = total.ravel()
    bar = max(ORDER_LEAST, int(np.quantile(total, 1 - ORDER_SHARE)) + 1)
    return np.where(total < bar, 0, 1 + np.log2(np.maximum(total, bar) / bar)).astype(np.uint8)


def postings(docs: DataFrame, heavy: bool, levels: np.ndarray | None = None) -> DataFrame:
    """(role, n, sig, token, pos): prefix shingles of heavy sets (role 0), or subsets of light ones.

    A subset that the smaller of two sizes emits has role 1, of the larger one role 2. Columns
    that a set's entries have alike come first, so that they compress as one in the shuffle.
    """
    light, reach = boundary(), 4 * boundary() // 3

    def subsets(code: np.ndarray) -> Iterator[tuple[int, int]]:
        n, values = len(code), code.tolist()
        for m in range(ceil(3 * n / 4), 4 * n // 3 + 1):
            low, high = min(n, m), max(n, m)
            if low > light:
                continue
            c = need(n, m)
            for chosen in combinations(values, c):
                key = (low * 1_000_003 + high) * 0x9E3779B97F4A7C15
                for x in chosen:
                    key = (key ^ x) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
                    key ^= key >> 29
                yield key, 1 if n == low else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            met = np.zeros(0, np.int64)
            for i, j in chunks(raw, offs):
                row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                size, sig = signatures(row, code, j - i)
                # copies in a batch are one set
                _, once = np.unique(sig, return_index=True)
                fresh = np.zeros(j - i, dtype=bool)
                fresh[once] = ~np.isin(sig[once], met)
                met = np.union1d(met, sig)
                first = np.cumsum(size) - size
                if not heavy:
                    extra = [(k, role, size[r], r) for r in np.flatnonzero(fresh & (size > 0) & (size <= reach))
                             for k, role in subsets(code[first[r]: first[r] + size[r]])]
                    if extra:
                        token, role, n, row_ = zip(*extra)
                        yield entries(np.array(token, np.uint64).view(np.int64), role, n, [0] * len(n), sig[list(row_)])
                    continue
                # stable: by hash among equals
                code_ = code if levels is None else code[np.lexsort((levels[bucket_of(code)], row))]
                pos = np.arange(len(row)) - first[row]
                inside = (pos < prefix_size(size)[row]) & fresh[row] & (size[row] > light)
                yield entries(code_[inside].view(np.int64), np.zeros(inside.sum()), size[row[inside]], pos[inside],
                              sig[row[inside]])

    def entries(token, role, n, pos, sig) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(role, np.int8)), pa.array(np.asarray(n, np.int32)), pa.array(sig),
             pa.array(token), pa.array(np.asarray(pos, np.int32))], ["role", "n", "sig", "token", "pos"])

    return docs.select("text").mapInArrow(run, "role byte, n int, sig long, token long, pos int")


def scan_lists(posted: DataFrame) -> DataFrame:
    """Entries of lists that hold two sets or more; in those of subsets with the ``lead`` of the list.

    (token, role, n, pos, sig, lead): lists are read in order of role and size; only the last
    entry and the lead at hand are carried from batch to batch, so a list may have any length.
    """
    names = ["token", "role", "n", "pos", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # last entry of the batch before: its columns, class, lead, and whether it was given out
        for b in batches:
            if not len(b):
                continue
            cols = [b.column(c).to_numpy() for c in names]
            if carried is not None:
                cols = [np.concatenate(([old], new)).astype(new.dtype) for old, new in zip(carried[0], cols)]
            token, role, n, _, sig = cols
            edge = np.ones(len(token), dtype=bool)
            edge[1:] = token[1:] != token[:-1]
            lead_at = np.maximum.accumulate(np.where(edge, np.arange(len(token)), 0))
            lead, lead_role = sig[lead_at], role[lead_at]
            if carried is not None:
                first = lead_at == 0
                lead[first], lead_role[first] = carried[1], carried[2]
            # a list whose first entry is not a subset of the smaller size links nothing
            lead = np.where(lead_role != 1, sig, lead)
            again = np.zeros(len(token), dtype=bool)
            again[1:] = (token[1:] == token[:-1]) & (sig[1:] == sig[:-1])  # the same set from two batches
            near = np.zeros(len(token), dtype=bool)
            alike = (token[1:] == token[:-1]) & ~again[1:]
            near[1:] |= alike
            near[:-1] |= alike
            # copies between two sets: what is near one of them is near the other
            run_id = np.cumsum(~again) - 1
            near = np.bincount(run_id, near, minlength=run_id[-1] + 1)[run_id] > 0
            if carried is not None and carried[3]:
                near |= (run_id == 0)
            out = near & ~again
            if carried is not None and carried[3]:
                out[0] = False  # given out with the batch before
            given = bool(near[-1])
            yield pa.RecordBatch.from_arrays([*(pa.array(c[out]) for c in cols), pa.array(lead[out])], [*names, "lead"])
            carried = ([c[-1] for c in cols], lead[-1], lead_role[-1], given)

    dealt = posted.repartition("token").sortWithinPartitions("token", "role", "n", "sig")
    return dealt.mapInArrow(run, "token long, role byte, n int, pos int, sig long, lead long")


def sketches(docs: DataFrame) -> DataFrame:
    """(sig, sketch): a byte of each of ``SKETCH`` MinHash values of every set above the light ones."""
    rng = np.random.default_rng(8)
    factor = rng.integers(0, 1 << 31, SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(0, 1 << 32, SKETCH, dtype=np.uint32)
    light = boundary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            for i, j in chunks(raw, offs):
                row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                size, sig = signatures(row, code, j - i)
                heavy = np.flatnonzero(size > light)
                if not len(heavy):
                    continue
                code = (code[(size > light)[row]] >> np.uint64(20)).astype(np.uint32)
                first = np.cumsum(size[heavy]) - size[heavy]
                out = np.empty((len(heavy), SKETCH), dtype=np.uint8)
                for k in range(SKETCH):
                    least = np.minimum.reduceat(code * factor[k] + add[k], first)
                    out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[heavy]), pa.array([r.tobytes() for r in out], pa.binary())], ["sig", "sketch"])

    return docs.select("text").mapInArrow(run, "sig long, sketch binary").groupBy("sig").agg(
        F.first("sketch").alias("sketch"))


class Forest:
    """Which of some nodes are connected."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def join(self, a: int, b: int) -> bool:
        while self.parent[a] != a:
            a = self.parent[a]
        while self.parent[b] != b:
            b = self.parent[b]
        self.parent[max(a, b)] = min(a, b)
        return a != b


def near_in_lists(token: np.ndarray, n: np.ndarray, pos: np.ndarray, sig: np.ndarray, sketch: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs that connect what is connected in whole lists, in order of token and n."""
    known, node = np.unique(sig, return_inverse=True)
    forest, a, b = Forest(len(known)), [], []
    edge = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
    end = np.repeat(edge[1:], np.diff(edge))  # of the list of each entry
    i, step = np.arange(len(token)), 0
    while True:
        step += 1
        # partners of i are the next entries, up to 4/3 of its size
        i = i[i + step < end[i]]
        i = i[3 * n[i + step] <= 4 * n[i]]
        if not len(i):
            return np.array(a, np.int64), np.array(b, np.int64)
        roots = forest.roots()
        # a list whose sets are all connected has no more to give
        of_list = roots[node]
        apart = np.minimum.reduceat(of_list, edge[:-1]) != np.maximum.reduceat(of_list, edge[:-1])
        i = i[np.repeat(apart, np.diff(edge))[i]]
        x = i[roots[node[i]] != roots[node[i + step]]]
        y = x + step
        ok = 1 + np.minimum(n[x] - 1 - pos[x], n[y] - 1 - pos[y]) >= need(n[x], n[y])
        x, y = x[ok], y[ok]
        ok = (sketch[x] == sketch[y]).sum(axis=1) >= SKETCH_LEAST
        for u, v in zip(x[ok].tolist(), y[ok].tolist()):
            if forest.join(node[u], node[v]):
                a.append(sig[u])
                b.append(sig[v])


def candidates(lists: DataFrame) -> DataFrame:
    """(a, b) from entries (token, n, pos, sig, sketch), dealt and sorted by token and n; a pair may repeat."""
    names = ["token", "n", "pos", "sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not len(b):
                continue
            cols = [b.column(c).to_numpy().astype(np.int64) for c in names]
            cols.append(np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH))
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last list may go on
            held = [c[cut:] for c in cols]
            if cut:
                yield given([c[:cut] for c in cols])
        if held is not None:
            yield given(held)

    def given(cols: list[np.ndarray]) -> pa.RecordBatch:
        x, y = near_in_lists(*cols)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return lists.mapInArrow(run, "a long, b long")


def texts_by_set(docs: DataFrame) -> DataFrame:
    """(sig, z): one text for each distinct set above the light ones, as a zstd blob."""
    light = boundary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            raw, offs = utf8(b.column("text"))
            data = raw.tobytes()
            for i, j in chunks(raw, offs):
                row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                size, sig = signatures(row, code, j - i)
                heavy = np.flatnonzero(size > light)
                blobs = [squeeze(data[offs[i + r]: offs[i + r + 1]]) for r in heavy]
                yield pa.RecordBatch.from_arrays([pa.array(sig[heavy]), pa.array(blobs, pa.binary())], ["sig", "z"])

    return docs.select("text").mapInArrow(run, "sig long, z binary").groupBy("sig").agg(F.first("z").alias("z"))


def linked_in_group(held: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is connected among the sets: each new set is reached once.

    From a set, the inverted lists of the sets not reached yet give all overlaps; the
    lists are built again when half of these sets are reached.
    """
    n = np.array([len(x) for x in held])
    _, token = np.unique(np.concatenate(held), return_inverse=True)
    token = np.split(token, np.cumsum(n)[:-1])
    open_, links = np.ones(len(n), dtype=bool), []

    def lists() -> tuple[np.ndarray, np.ndarray, int]:
        left = np.flatnonzero(open_)
        flat = np.concatenate([token[k] for k in left])
        order = np.argsort(flat, kind="stable")
        bounds = np.searchsorted(flat[order], np.arange(sum_tokens + 1))
        return np.repeat(left, n[left])[order], bounds, len(left)

    sum_tokens = max(int(t.max()) for t in token) + 1
    entries, bounds, built = lists()
    for seed in range(len(n)):
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue and open_.any():
            if 2 * open_.sum() <= built:
                entries, bounds, built = lists()
            x = queue.pop()
            begin, size = bounds[token[x]], bounds[token[x] + 1] - bounds[token[x]]
            at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            shared = np.bincount(entries[at], minlength=len(n))
            for y in np.flatnonzero(open_ & (100 * shared >= 75 * (n[x] + n - shared))).tolist():
                links.append((x, y))
                open_[y] = False
                queue.append(y)
    return links


def verified(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between sets of a group (node, label) that connect all that is linked.

    Groups of up to ``BLOCK`` sets are done after the first round. Only whether a
    group is left reaches the driver.
    """
    q = groups.groupBy("label").agg(F.count(F.lit(1)).alias("q"))
    blocks = groups.join(q, "label").withColumn("blocks", F.ceil(F.col("q") / BLOCK).cast("long"))
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    blocks = written(blocks.select("node", "label", "blocks", "own"))
    links = written(compared(blocks.select("node", "label", F.col("own").alias("low"), F.col("own").alias("high")), texts))
    large = blocks.where("blocks > 1")
    if large.isEmpty():
        return links

    # the sets that reached most others: the best of each block, then of the group
    reached = links.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    best = large.join(reached, "node")
    for keys in (("label", "own"), ("label",)):
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "node")
        best = best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= (4 if len(keys) > 1 else PIVOTS))
    everywhere = best.withColumn("own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = large.select("node", "label", "own").unionByName(everywhere.select("node", "label", "own")).distinct()
    met = written(met.select("node", "label", F.col("own").alias("low"), F.col("own").alias("high")))
    links = written(links.unionByName(compared(met, texts)))

    cluster = components(links, "a", "b").select("node", F.col("label").alias("root"))
    state = large.select("node", "label").join(cluster, "node", "left").withColumn("root", F.coalesce("root", "node"))
    state = written(state)
    sizes = state.groupBy("label", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("label").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("q"))
    main = main.select("label", F.col("m.root").alias("main"), F.col("m.n").alias("n_main"), (F.col("q") - F.col("m.n")).alias("n_rest"))
    left = state.join(main.where("n_rest > 0"), "label")
    if left.isEmpty():
        return links
    # sets outside the main cluster meet all, those inside meet only the ones outside
    left = left.withColumn("rest", F.ceil(F.col("n_rest") / BLOCK).cast("long"))
    left = left.withColumn("mains", F.ceil(F.col("n_main") / BLOCK).cast("long")).withColumn("inside", F.expr("root = main"))
    ticket = F.xxhash64("node")
    left = left.withColumn("own", F.when(F.col("inside"), F.col("rest") + F.pmod(ticket, "mains")).otherwise(F.pmod(ticket, "rest")))
    past = F.when(F.col("inside"), F.col("rest")).otherwise(F.col("rest") + F.col("mains"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), past - 1)))
    paired = left.select("node", "label", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return links.unionByName(compared(written(paired), texts))


def compared(paired: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between sets (node, label, low, high) that have the last three alike."""
    work = paired.withColumnRenamed("node", "sig").join(texts, "sig")
    work = work.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sigs, blobs = None, [], []
        for b in slices(batches, 2000):
            for key, sig, z in zip(zip(*(b.column(c).to_pylist() for c in ("label", "low", "high"))),
                                   b.column("sig").to_pylist(), b.column("z").to_pylist()):
                if key != at:
                    if len(sigs) > 1:
                        yield links_of(sigs, blobs)
                    at, sigs, blobs = key, [], []
                sigs.append(sig)
                blobs.append(z)
        if len(sigs) > 1:
            yield links_of(sigs, blobs)

    def links_of(sigs: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        held: list[np.ndarray] = []
        raw, offs = joined(unpacked(blobs))
        for i, j in chunks(raw, offs):
            row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
            held += np.split(code, np.cumsum(np.bincount(row, minlength=j - i))[:-1])
        links = linked_in_group(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([sigs[p[k]] for p in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return work.mapInArrow(run, "a long, b long")


def labelled_sets(docs: DataFrame, measured: Measured) -> DataFrame:
    """(sig, least, label): the least doc_id of each set that isn't empty, and the component of the set."""
    subsets = scan_lists(postings(docs, heavy=False))
    sure = subsets.where("lead <> sig").select(F.col("lead").alias("a"), F.col("sig").alias("b"))
    lists = scan_lists(postings(docs, True, order_levels(measured.loads)))
    entries = lists.select("token", "n", "pos", "sig").join(sketches(docs), "sig")
    near = candidates(entries.repartition("token").sortWithinPartitions("token", "n", "sig"))
    links = verified(components(near, "a", "b"), texts_by_set(docs))
    label = components(sure.unionByName(links), "a", "b")
    rep = measured.sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    rep = rep.join(label.withColumnRenamed("node", "sig"), "sig", "left")
    return rep.withColumn("label", F.coalesce("label", "sig"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that links lead to, itself included."""
    docs = documents(docs)
    measured = Measured(docs)
    rep = labelled_sets(docs, measured)
    least = rep.groupBy("label").agg(F.min("least").alias("component_id"))
    by_sig = rep.join(least, "label").select("sig", "component_id")
    return measured.sets.join(by_sig, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one of each group, that of least doc_id (null last).

    Of several sets with this doc_id the one of least signature stays, of repeated
    rows any one. Rows without words are in no group and stay. Whole rows are shuffled
    once, by signature and doc_id: that brings repeated rows together too, and those of
    one chunk are one before.
    """
    whole = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    own = isinstance(docs.schema["text"].dataType, T.StringType)  # then it is not sent twice
    if not own:
        whole = whole.withColumn("text", F.col("row.text").cast("string"))
    at = docs.columns.index("text")
    schema = T.StructType([whole.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n", "sig", "doc_id"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column(0).field(at) if own else b.column(2))
            ids = b.column(1)
            for i, j in chunks(raw, offs):
                row, code = shingles(raw[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                size, sig = signatures(row, code, j - i)
                id_ = ids.slice(i, j - i)
                same = np.column_stack((sig, id_.fill_null(0).to_numpy(), id_.is_null().to_numpy(zero_copy_only=False)))
                fresh = size == 0
                fresh[np.unique(same, axis=0, return_index=True)[1]] = True
                out = pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(size), pa.array(sig), id_],
                                                 ["row", "n", "sig", "doc_id"])
                yield out if fresh.all() else out.filter(pa.array(fresh))

    # a null doc_id in two columns, so that the join and the grouping have the same plain keys
    key = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    rows = whole.mapInArrow(run, schema).select("row", "n", "sig", *key)
    texts = documents(docs)
    first = labelled_sets(texts, Measured(texts)).groupBy("label").agg(
        F.min(F.struct(F.col("least").isNull(), "least", "sig")).alias("f"))
    first = first.select(F.col("f.sig").alias("sig"), F.col("f.least").alias("doc_id")).select("sig", *key)
    stays = rows.where("n > 0").join(first, ["sig", "id", "no_id"])
    one = stays.groupBy("sig", "id", "no_id").agg(F.first("row").alias("row")).select("row")
    return one.unionByName(rows.where("n = 0").select("row")).select("row.*")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
