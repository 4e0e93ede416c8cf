"""SentencePiece pieces, the alignment of two tokenizers, and the merge rounds they share."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from towerlens.llm import merges, op12_pieces, op13_align
from towerlens.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def piece_library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_library():
    out = pytest.importorskip("tokenizers").Tokenizer.from_file(BYTES)
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def model():
    return op12_pieces.Model(op12_pieces.read_file(PIECES))


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(7)
    parts = [" ", "  ", "▁", "a", "the", "é", "🙂", "\0", "\n", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "字",
             "ゼ", "�", "́", "xxxxx", "10", "\x1c", " ", " " * 40, "==", "'ll", "//", "__", ")."]
    out = ["".join(pick.choice(parts) for _ in range(pick.randrange(50))) for _ in range(2000)]
    return out + ["a" * 3000, " " * 2000, "".join(pick.choice("abdeiorst") for _ in range(2000)), "", " ", "▁"]


def split(ids, ends):
    return [ids[i:j].tolist() for i, j in zip(ends[:-1], ends[1:])]


def greedy(pairs, word):
    """One pair at a time: least rank, leftmost."""
    while True:
        best = min(((pairs[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in pairs), default=None)
        if best is None:
            return word
        i = best[1]
        word = word[:i] + [pairs[word[i], word[i + 1]][1]] + word[i + 2:]


@pytest.mark.parametrize("seed", range(8))
def test_rounds_equal_single_merges_for_any_table(seed, monkeypatch):
    """Also for tables in which a merge makes a pair of its own or a lower rank."""
    pick = random.Random(seed)
    pairs = {}
    for made in range(4, 40):
        left, right = pick.randrange(made), pick.randrange(made)
        pairs.setdefault((left, right), (pick.randrange(6 if seed % 2 else 60), made))
    table = merges.Merges(pairs)
    words = [[pick.randrange(4) for _ in range(pick.randrange(1, 30))] for _ in range(300)]
    ends = np.append(0, np.cumsum([len(w) for w in words]))
    flat = np.array([s for w in words for s in w])
    want = [greedy(pairs, w) for w in words]
    assert split(*table.run(flat, ends)) == want
    monkeypatch.setattr(merges, "LONG", 5)
    assert split(*table.run(flat, ends)) == want


def test_pieces_match_the_library(model, piece_library, odd_texts, monkeypatch):
    want = [piece_library.encode(t) for t in odd_texts]
    ids, ends = model.encode(odd_texts)
    assert split(ids, ends) == want
    assert [t.decode() for t in model.decode(ids, ends)] == [piece_library.decode(w) for w in want]
    monkeypatch.setattr(op12_pieces, "CHUNK", 64)  # texts in parts
    assert split(*model.encode(odd_texts[:300] + [" ".join(odd_texts[:200])])) == want[:300] + [
        piece_library.encode(" ".join(odd_texts[:200]))]


def test_any_ids_decode_as_the_library_does(model, piece_library):
    pick = random.Random(3)
    lists = [[pick.choice([pick.randrange(32000), pick.randrange(259)]) for _ in range(pick.randrange(8))] for _ in range(3000)]
    ends = np.append(0, np.cumsum([len(x) for x in lists]))
    out = model.decode(np.array([i for x in lists for i in x], dtype=np.int32), ends)
    assert [t.decode() for t in out] == [piece_library.decode(x) for x in lists]


def test_other_models_are_refused():
    data = op12_pieces.read_file(PIECES)
    with pytest.raises(ValueError):
        op12_pieces.Model(data + b"\x1a\x02\x20\x01")  # a normaliser that removes spaces


def piece_rows(docs, library):
    out = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        out.append((r.doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids))))
    return sorted(out, key=str)


def test_op12_rows(spark, sf_small, awkward, no_documents, piece_library):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for table in (docs, awkward, no_documents):
        got = op12_pieces.digests(table, PIECES)
        assert sorted(map(tuple, got.collect()), key=str) == piece_rows(table, piece_library)
    got = QUERIES["op12_sentencepiece"](spark, sf_small)
    assert sorted(map(tuple, got.collect()), key=str) == piece_rows(docs, piece_library)


def plain_alignment(docs, byte_library, piece_library):
    """Rows of the alignment by sets of ends and by comparing every pair of ranges that can meet."""
    pairs_of, rows = [], []
    decode = {c: b for b, c in byte_chars().items()}
    for r in docs.collect():
        text, pairs, row = r.text or "", [], (r.doc_id, 0, 0, 0, 0, "")
        if text:
            a = byte_library.encode(" " + text, add_special_tokens=False)
            a, tokens = a.ids, a.tokens
            b = piece_library.encode(text)
            raw_a = [bytes(decode[c] for c in t) for t in tokens]
            raw_b = [bytes([int(t[3:5], 16)]) if piece_library.is_byte(i) else t.replace("▁", " ").encode()
                     for i, t in zip(b, map(piece_library.id_to_piece, b))]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                ends_a, ends_b = (np.cumsum([len(t) for t in x]).tolist() for x in (raw_a, raw_b))
                first = 0
                for i, end in enumerate(ends_a):
                    begin = end - len(raw_a[i])
                    while ends_b[first] <= begin:
                        first += 1
                    j = first
                    while j < len(b) and ends_b[j] - len(raw_b[j]) < end:
                        pairs.append((a[i], b[j]))
                        j += 1
                groups, i, j = [], 0, 0
                for cut in sorted(set(ends_a) & set(ends_b)):
                    k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
                    groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                    i, j = k, m
                row = (r.doc_id, len(a), len(b), len(groups), len(pairs), ";".join(groups))
        rows.append(row)
        pairs_of.append(pairs)
    count, best = {}, {}
    for pairs in pairs_of:
        for p in set(pairs):
            count[p] = count.get(p, 0) + 1
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    return sorted([(*row[:5], sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs), row[5])
                   for row, pairs in zip(rows, pairs_of)], key=str)


def byte_chars():
    """The characters that stand for bytes in the JSON file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}


@pytest.mark.parametrize("chunk", [1 << 23, 5000])
def test_op13_rows(spark, sf_small, awkward, no_documents, byte_library, piece_library, chunk, monkeypatch):
    monkeypatch.setattr(op13_align, "CHUNK", chunk)
    monkeypatch.setattr(op13_align, "PART", max(chunk // 8, 1000))
    marked = spark.createDataFrame([(1, "a ▁ b"), (2, "plain <|endoftext|> </s> text"), (None, "plain text"),
                                    (None, "plain text"), (3, " "), (4, "naïve 字🙂 " * 40)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for table in (docs, awkward, marked, no_documents):
        got = op13_align.align(table, BYTES, P.PATTERN, PIECES)
        assert sorted(map(tuple, got.collect()), key=str) == plain_alignment(table, byte_library, piece_library)


def test_op13_query_hashes_the_groups(spark, sf_small, byte_library, piece_library):
    want = plain_alignment(spark.read.parquet(f"{sf_small}/documents.parquet"), byte_library, piece_library)
    got = QUERIES["op13_token_alignment"](spark, sf_small)
    assert got.columns[-1] == "groups_sha256"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(*r[:-1], brute.sha(r[-1]) if r[-1] else "") for r in want], key=str)


def test_op13_rows_of_chunks_are_small(spark, piece_library, byte_library, tmp_path, monkeypatch):
    monkeypatch.setattr(op13_align, "HELD", 50, raising=False)
    # Texts of their own letters: the pairs of a chunk, and those of the long documents, are many times HELD.
    pick = random.Random(5)
    texts = [" ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randrange(2, 9))) for _ in range(n))
             for n in (400, 3, 700, 1, 400)]
    table = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, ""), (4, None), (1, texts[0]),
                                   (5, texts[3]), (6, texts[4])], "doc_id long, text string").coalesce(1)
    op13_align.aligned_chunks(table, BYTES, P.PATTERN, PIECES).write.parquet(f"{tmp_path}/chunks")
    chunks = spark.read.parquet(f"{tmp_path}/chunks")
    lists = [f.name for f in chunks.schema if f.dataType.typeName() == "array"]
    widest = chunks.select([F.max(F.size(c)) for c in lists]).first()
    assert chunks.select("chunk").distinct().count() == 1 and max(widest) == 50
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = op13_align.align(table, BYTES, P.PATTERN, PIECES)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == kept
    assert sorted(map(tuple, got.collect()), key=str) == plain_alignment(table, byte_library, piece_library)


@pytest.mark.parametrize("seed", range(30))
def test_diagonal_runs_find_all_common_ends(seed):
    pick = random.Random(seed)
    n = pick.randrange(1, 400)
    a, b = (sorted({n, *(x for x in range(1, n) if pick.random() < share)}) for share in (pick.random(), pick.random()))
    if seed % 3 == 0:  # long one-to-one stretches
        b = sorted({*a} ^ {x for x in range(1, n) if pick.random() < 0.01})
    runs, odd, _ = op13_align.diagonal_runs(a, b)
    ends = sorted([a[i + k] for i, _, size in runs for k in range(size)] + [a[e - 1] for _, e, _, _ in odd])
    assert ends == sorted(set(a) & set(b))
    assert all(a[i + k] == b[j + k] for i, j, size in runs for k in range(size))
    found = op13_align.Aligned(np.array(a), np.array(b))
    starts = [[0, *x[:-1]] for x in (a, b)]
    assert sorted(zip(found.left.tolist(), found.right.tolist())) == [
        (i, j) for i in range(len(a)) for j in range(len(b)) if max(starts[0][i], starts[1][j]) < min(a[i], b[j])]
    x, y = np.arange(len(a)), np.arange(len(b))
    spelled = "".join(op13_align.spellings(len(a), len(b))[k] for k in found.in_order(x, y, len(a), len(b)))
    cuts = [(a.index(c) + 1, b.index(c) + 1) for c in ends]
    assert spelled == "".join(",".join(map(str, range(i, k))) + "|" + ",".join(map(str, range(j, m))) + ";"
                              for (i, j), (k, m) in zip([(0, 0), *cuts], cuts))
