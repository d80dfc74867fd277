"""Token-id files and WARC archives: exact round trips."""

import base64
import hashlib
import io
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ALL_IDS, no_docs, odd_docs

from hazeframe.llm import idfiles, warc
from hazeframe.llm.queries import op4_warc, op8_token_ids, tokenizer_path
from hazeframe.llm.tokens import Encoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PIECES = st.sampled_from(["a", "bc", " ", "  ", "\n", "\t", "\r\n", "É", "é", "ß", " ", " ", "\x1c", "\x85", "日本",
                          "12", "'s", "'ll", "<|endoftext|>", ".", "!?", "᠎", "​", "the", "Σ", "😀"])


@pytest.mark.parametrize("name", FILES)
def test_pieces_encode_like_whole_texts(name):
    import pyarrow as pa

    enc = Encoder(tokenizer_path(name))

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=1, max_size=5))
    def check(texts):
        ids, ends = enc.encode(pa.array([*texts, None]))
        want = [e.ids for e in enc.tokenizer.encode_batch([*texts, ""], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want

    check()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=80).map(lambda x: [*x, 0]), min_size=1, max_size=8), st.integers(2, 4))
def test_block_round_trip(docs, least):
    ids = np.concatenate([np.array(d, np.uint32) for d in docs])
    ends = np.cumsum([len(d) for d in docs])
    old, idfiles.repair.__defaults__ = idfiles.repair.__defaults__, (3, 50, least)
    try:
        block = idfiles.Block(idfiles.block_bytes([None, *range(len(docs) - 1)], ids, ends))
    finally:
        idfiles.repair.__defaults__ = old
    assert block.doc_ids == [None, *range(len(docs) - 1)]
    for i, d in enumerate(docs):
        assert block.ids(i, i + 1).tolist() == d
        for lo in range(0, len(d), 7):
            assert block.ids_at(i, lo, 5).tolist() == d[lo:lo + 5]


def frequent_pairs(seq, last, least):
    pair, n = np.unique(((seq[:-1] << 32) | seq[1:])[~last[:-1]], return_counts=True)
    return pair[n >= least]


class Counting:
    """A tokenizer that counts the texts it is handed."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **kwargs):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **kwargs)


def test_new_pieces_share_texts_and_known_ones_stay(monkeypatch):
    """Ids are those of whole texts, though few texts are encoded, also when the store is full
    and when pieces are long, look alike or hold an added token."""
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    plain, enc.tokenizer = enc.tokenizer, Counting(enc.tokenizer)
    texts = [" ".join(f"w{i}x{i * 7919 % 1000}" for i in range(k * 3000, k * 3000 + 3000)) for k in range(4)]
    odd = ["a <|endoftext|> b, <|endoftext|>c", "é è Ü! \u00d7 a\x00b a\x00 a", "x" * 23 + " " + "x" * 24 + " " + "x" * 200, "", "日本 語 the end."]

    def check():
        ids, offsets = enc.encode(pa.array([*texts, *odd]))
        for i, text in enumerate([*texts, *odd]):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids

    check()
    assert enc.tokenizer.texts < 200  # of 12,000 distinct pieces
    enc.tokenizer.texts = 0
    check()
    assert enc.tokenizer.texts < 20
    kept = enc.known
    assert sum(x.nbytes for x in (kept.hashes, kept.number, kept.keys, kept.used, kept.ids, kept.ends)) < 100 * len(kept.keys)
    monkeypatch.setattr("hazeframe.llm.tokens.KEPT_PIECES", 1000)
    enc.encode(pa.array([" ".join(f"y{i}" for i in range(500))]))
    assert len(kept.keys) <= 1000
    check()
    check()


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(6)
    text = rng.integers(1, 3000, 400)
    docs = [np.append(text, 0) if k % 2 else np.append(rng.zipf(1.3, 300) % 500 + 1, 0) for k in range(200)]
    ids, ends = np.concatenate(docs).astype(np.uint32), np.cumsum([len(d) for d in docs])
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    for per_round in (20, 5000):
        seq, flags, rules = idfiles.repair(ids, last, int(ids.max()) + 1, per_round=per_round)
        assert not len(frequent_pairs(seq, flags, idfiles.LEAST_PAIRS))
        # a text that a block holds a hundred times is one symbol
        symbol_ends = np.append(0, np.flatnonzero(flags) + 1)
        assert max(np.diff(symbol_ends)[1::2]) == 1
    block = idfiles.Block(idfiles.block_bytes(list(range(len(docs))), ids, ends))
    assert all(block.ids(i, i + 1).tolist() == d.tolist() for i, d in enumerate(docs))


def test_block_refuses_damage():
    data = idfiles.block_bytes([1], np.array([4, 5, 4, 5, 0], np.uint32), np.array([5]))
    for bad in (b"x" + data[1:], data[:-1], data + b"\0"):
        with pytest.raises(ValueError):
            idfiles.Block(bad)


def test_id_query_against_the_tokenizer(spark, duck):
    from tokenizers import Tokenizer

    plain, at, want = Tokenizer.from_file(tokenizer_path(FILES[0])), 0, []
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = op8_token_ids(spark, SMALL).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_id_files_with_odd_rows_and_small_blocks(spark):
    manifest = idfiles.write_ids(odd_docs(spark), tokenizer_path(FILES[0]), block_ids=50)
    assert manifest.count() > 2
    rows = idfiles.read_ids(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == ALL_IDS
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert idfiles.read_ids(idfiles.write_ids(no_docs(spark), tokenizer_path(FILES[0]))).count() == 0


def plain_pages(rows):
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = largest.get(html or "")
        revisit = to is not None and (page is None or page < to)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def read_back(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=repr)


def test_warc_query_against_plain_version(spark, duck):
    rows = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    assert read_back(op4_warc(spark, SMALL)) == plain_pages(rows)


def test_warc_odd_rows(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "http://b", None), (4, "http://c", ""), (5, "u", "é" * 300_000),
            (None, "n", "same"), (None, None, "alone"), (6, "twice", "t"), (6, "twice", "t"), (7, "x", "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, payload string, path string")
    manifest = warc.write_archives(pages, archive_bytes=10)
    read = warc.read_archives(manifest)
    assert read_back(read) == plain_pages(rows)
    held = {r["page_id"]: bytes(r["payload"]).decode() for r in read.where("record_type = 'response'").collect()}
    assert held[5] == "é" * 300_000 and held[2] == "same" and held[7] == "\r\n\r\n"
    assert read.where("page_id = 1").first()["target_uri"] == "http://a/%0D%0AX:%20y"
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_reader_checks():
    import zstandard as zstd

    good = warc.record_bytes(1, "http://a", b"payload", None, "2024-01-01T00:00:00Z")
    assert warc.http_payload(warc.parse_record(good)) == (b"payload", 7)
    for bad in (good[:-1], good.replace(b"payload", b"paXload"), good.replace(b"WARC/1.1", b"WARC/9.9"),
                good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"WARC-Type: response", b"WARC-Type response")):
        with pytest.raises(ValueError):
            warc.http_payload(warc.parse_record(bad))
    words = zstd.ZstdCompressionDict(good * 4, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    pack = zstd.ZstdCompressor(dict_data=words).compress
    for held in (words.as_bytes(), zstd.ZstdCompressor().compress(words.as_bytes())):
        lead = struct.pack("<II", warc.SKIPPABLE, len(held)) + held
        whole = lead + pack(good) + pack(good)
        for chunk in (7, 1 << 20):
            assert list(warc.read_records(io.BytesIO(whole), chunk)) == [good, good]
        for cut in (whole[:-3], whole[:20], b"", whole[8:]):
            with pytest.raises((ValueError, zstd.ZstdError)):
                list(warc.read_records(io.BytesIO(cut)))
