"""Encoders, packing, token files and SentencePiece against the libraries."""

import hashlib
import random
import time
import zlib
from functools import lru_cache

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from feedlab.llm import chunks as C
from feedlab.llm import packing as P
from feedlab.llm import sentencepiece_stream as S
from feedlab.llm import token_files as T
from feedlab.session import scratch_path

PARTS = [" ", "  ", "   ", "\n", " \n", "\n ", "\t", "a", "É", "bc", "'s", "don't", "12", "3", ".", "!!", "x1", "日本", "́",
         "<|endoftext|>", "</s>", "Σ", "ΑΣ", "\x1c", "\x85", " ", "　", "👍🏽", "Word,", "b\nc.", "b.\nTo", "İ", "ß!",
         "ﬁ", "▁", "\x00", "the", "ing", " " * 17, "==", "strength"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def rows():
    rng = random.Random(9)
    out = [(1, None), (2, ""), (3, " "), (4, "word " * 30_000), (5, "same text"), (5, "same text"), (None, "no id")]
    return out + [(10 + i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randint(1, 700)))) for i in range(200)]


def table(spark, data):
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    return df.select("*", *[F.lit(1).alias(c) for c in ("ids", "start", "tokens", "shard", "offset", "n_tokens")])


@pytest.mark.parametrize("name,keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_ids_equal_the_library(name, keeps_space):
    encode = C.encoder(C.tokenizer_path(name), keeps_space)
    texts = random_texts(6000, 4) + ["plain words here, and Ölüm.", "a" * 3000, " lead", "trail ", "<|endoftext|>",
                                     "a <|endoftext|><|startoftext|> b<|ENDOFTEXT|>", "<|endoftext", "x <|startoftext|>"]
    assert sum("<|endoftext|>" in t for t in texts) > 100
    for t in texts:
        assert encode(t) == library_ids(name, t), repr(t)


def test_marks_after_a_letter_are_added_to_known_chunks(monkeypatch):
    monkeypatch.setattr(C, "MEMO_SPACED", 3)
    encode = C.SpaceKeepingEncoder(C.tokenizer_path("byte_bpe_50k.json"))
    whole, calls = encode.whole, []
    monkeypatch.setattr(encode, "whole", lambda t: calls.append(t) or whole(t))
    text = "so don't, don't. don't!! (Éa), (Éa) x1, x1' ab'', ab' 'cd. d'e_ ABC- abc; Ö... ß) 12, 12. b\nc, b\nc. 3\nto"
    assert encode(text) == library_ids("byte_bpe_50k.json", text)
    assert calls.count(" don't") == 1 and not any(" don't" in c and c != " don't" for c in calls), calls
    assert sum(not w.isalpha() for w in encode.chunks) == 3


@lru_cache
def library_tokenizer(name):
    """As the library loads its file, without a setting."""
    return tokenizers.Tokenizer.from_file(C.tokenizer_path(name))


def library_ids(name, text, *end):
    ids = library_tokenizer(name).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, *end], dtype="<u4").tobytes() if not end else np.array([*ids, *end], dtype="<u4")


def check_pieces(got, data, end=0):
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    ids = {}
    for d, t in data:
        ids.setdefault(d, []).append(library_ids("byte_bpe_50k.json", t, end))
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        # a repeated document is packed once per row: its pieces repeat as sets
        copies = len(ids[d])
        at = sum(p.length for p in pieces)
        assert at == copies * len(ids[d][0])
        for p in pieces:
            part = ids[d][0][p.start:p.start + p.length]
            assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
            assert p.doc_tokens == len(ids[d][0])
        if copies == 1:
            edges = sorted((p.start, p.start + p.length) for p in pieces)
            assert [a for a, _ in edges] == [0, *[b for _, b in edges[:-1]]]
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 1024
    return windows


def test_packing_is_whole_gapless_and_tight(spark):
    data = rows()
    windows = check_pieces(P.pack_documents(table(spark, data)).collect(), data)
    used = sum(n for w in windows.values() for _, n in w)
    assert 1024 * (len(windows) - 1) - used < 0.02 * used


def test_packing_merges_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(P, "MERGE_FAN_IN", 2)
    data = [(i, "few words " * (i % 5)) for i in range(60)]
    windows = check_pieces(P.pack_documents(table(spark, data).repartition(9)).collect(), data)
    total = sum(n for w in windows.values() for _, n in w)
    assert len(windows) == -(-total // 1024)


def test_packing_keeps_the_one_window_left_by_several_tasks(spark, monkeypatch):
    # three half windows in two merge tasks: whichever meet end exactly full, and one stays open
    monkeypatch.setattr(P, "MERGE_FAN_IN", 2)
    data = [(i, "word " * 511) for i in range(3)]
    assert len(library_ids("byte_bpe_50k.json", data[0][1].strip(), 0)) == 512
    data = [(i, t.strip()) for i, t in data]
    df = spark.createDataFrame(data, "doc_id long, text string").repartitionByRange(3, "doc_id")
    got = P.pack_documents(df).collect()
    assert len(check_pieces(got, data)) == 2
    assert sorted((r.doc_id, r.length) for r in got) == [(0, 512), (1, 512), (2, 512)]


def test_packer_keeps_few_windows_open():
    rng = random.Random(1)
    packer, closed, total = P.OnlinePacker(100, 8, 4), [], 0
    for i in range(4000):
        n = rng.randint(1, 260)
        total += n
        closed += packer.add(P.Piece(i, 0, b"\0\0\0\0" * n, n))
        assert len(packer.open) <= 8 and len(packer.pieces) <= 8
    closed += packer.finish()
    sizes = [sum(map(len, w)) for w in closed] + [sum(map(len, packer.last()))]
    assert sum(sizes) == total and max(sizes) <= 100
    assert sum(100 - s for s in sizes[:-1]) < 0.03 * total


def test_a_long_document_is_cut_without_copies():
    ids = b"\0\0\0\0" * 3_000_000
    packer = P.OnlinePacker(1024, 4, 8)
    began = time.process_time()
    windows = list(packer.add(P.Piece(1, 0, ids, 3_000_000)))
    assert time.process_time() - began < 1             # a copy of the rest per window would be 18 GB
    assert [w[0].start for w in windows] == list(range(0, 3_000_000 - 1023, 1024))


def test_packing_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_token_files_round_trip(spark):
    data = rows()
    path = scratch_path(spark, "token-test")
    T.write_token_files(table(spark, data), path, files=5)
    got = sorted(T.token_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in data), key=lambda d: -1 if d is None else d)
    at, text = 0, dict(data)
    for r in got:
        ids = library_ids("word_bpe_49k.json", text[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    meta = sorted(T.read_metadata(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in meta] == [(r.doc_id, r.start, r.n_tokens) for r in got]
    some = {r.doc_id: r.tokens for r in T.read_tokens(spark, path, [10, 11]).collect()}
    assert some == {d: library_ids("word_bpe_49k.json", text[d], 1).tolist() for d in (10, 11)}


def test_token_files_are_dictionary_encoded_with_page_indexes(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    T.write_token_files(table(spark, rows()), path, files=2)
    seen = False
    for f in tmp_path.glob("tokens/part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            tokens = next(v for k, v in cols.items() if k.startswith("tokens"))
            if meta.row_group(g).num_rows > 5:
                seen = True
                assert any("DICTIONARY" in e for e in tokens.encodings)
                assert "DELTA_BINARY_PACKED" in cols["doc_id"].encodings
                assert cols["doc_id"].has_column_index and cols["doc_id"].has_offset_index
    assert seen


def test_token_metadata_scan_reads_no_tokens(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    T.write_token_files(table(spark, rows()), path, files=2)
    plan = T.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan


def test_an_id_with_many_rows_goes_over_several_files(spark):
    data = [(7, f"text {i % 50}") for i in range(3000)] + [(i, "other") for i in range(5)]
    path = scratch_path(spark, "token-test")
    T.write_token_files(table(spark, data), path, files=6)
    got = sorted(T.token_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(d for d, _ in data)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    per_file = spark.read.parquet(path).groupBy("shard").count().collect()
    assert len(per_file) >= 5 and max(r["count"] for r in per_file) < 1200


def test_token_files_empty_table(spark):
    path = scratch_path(spark, "token-test")
    T.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path)
    assert T.token_index(spark, path).collect() == []


# --- SentencePiece ------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=C.tokenizer_path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(library):
    encode = S.piece_encoder(C.tokenizer_path("piece_bpe_32k.model"))
    texts = random_texts(4000, 6) + [" " * i for i in range(60)] + [" " * i + "日x" for i in range(40)] + ["a" * 300, "=" * 333]
    for t in texts:
        ids = np.frombuffer(encode(t), dtype="<u4").tolist()
        assert ids == library.encode(t), repr(t)
    ids = [library.encode(t) for t in texts]
    flat = np.array([i for x in ids for i in x], dtype=np.int64)
    assert encode.decode_all(flat, np.cumsum([len(x) for x in ids])) == [library.decode(x) for x in ids]


def test_stream_holds_a_bounded_window(library):
    m = S.piece_encoder(C.tokenizer_path("piece_bpe_32k.model")).m
    v, pieces, held = S.StreamingViterbi(m), [], 0
    text = "▁" + "thequickbrownfoxjumpsoverthelazydog" * 300
    for at in range(0, len(text), 50):
        pieces += v.feed(text[at:at + 50])
        held = max(held, len(v.text))
    pieces += v.finish()
    assert [i for p in pieces for i in m.piece_ids(p)] == library.encode(text[1:])
    assert held <= 8 * m.longest + 50


def test_encode_and_decode_tables(spark, library):
    data = rows()
    enc = S.encode_pieces(table(spark, data))
    got = {r.doc_id: r for r in enc.collect()}
    for d, t in data:
        assert got[d].ids == library.encode(t or "") and got[d].n_tokens == len(got[d].ids)
    back = {r.doc_id: r.text for r in S.decode_pieces(enc).collect()}
    assert back == {d: t or "" for d, t in data}
    assert S.encode_pieces(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_decode_edges(spark, library):
    """Null and empty lists, repeated rows, a long list, clashing names, an empty table."""
    long = library.encode("word " * 40_000)
    data = [(1, None, 7), (2, [], 8), (3, [5, 9000], 9), (3, [5, 9000], 9), (None, long, 1)]
    df = spark.createDataFrame(data, "doc_id long, ids array<int>, extra int").withColumn("text", F.lit("clash"))
    want = sorted(((d, None if i is None else library.decode(i), x) for d, i, x in data), key=str)
    assert sorted(map(tuple, S.decode_pieces(df, carry=("extra",)).collect()), key=str) == want
    assert S.decode_pieces(df.limit(0), carry=("extra",)).collect() == []
    with pytest.raises(ValueError):
        S.decode_pieces(df, carry=("text",))


def test_query_decodes_the_whole_table(spark, library, tmp_path):
    from feedlab.llm.queries import QUERIES
    data = rows()
    table(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, tuple(r.ids), r.n_tokens, r.decoded_sha256) for r in QUERIES["op2_sentencepiece"](spark, str(tmp_path)).collect()}
    ids = [library.encode(t or "") for _, t in data]
    assert got == {(d, tuple(i), len(i), hashlib.sha256((t or "").encode()).hexdigest()) for (d, t), i in zip(data, ids)}
