"""BPE against the library, packing against its rules, FLAC round trips."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tracewell.llm import bpe, media, packing
from tracewell.llm.queries import pack_documents

TEXTS = ["", " ", "a", "It's  the\n\n end ", "naïve Ünïcode 漢字 🎉🎉", "<|endoftext|>x<|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30, "thntreor erwhsh*** && 12 345 6789", "<|endof"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary())
    t.no_padding()
    t.no_truncation()
    return t


def _random_texts(n):
    rng = random.Random(1)
    parts = ["the", "er", "ing", " ", "  ", "\n", "\t", "é", "漢", "9", "##", "'s", "'LL", "qx", " ", " ", "<|endoftext|>", "aaaa"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_encoder_equals_the_library(library):
    c = bpe.codec(bpe.vocabulary())
    for t in TEXTS + _random_texts(2000):
        want = library.encode(t, add_special_tokens=False).ids
        got = c.encode(t)
        assert got.tolist() == want, t
        assert c.decode(got) == library.decode(want, skip_special_tokens=False) == t


def test_every_token_is_its_own_encoding():
    c = bpe.codec(bpe.vocabulary())
    merged = [i for i in c._parts if i % 37 == 0]
    for i in merged:
        del c._by_bytes[c.tokens[i]]  # so that the tokens are found by backtracking
    try:
        assert all(c.piece(c.tokens[i]) == [i] for i in merged)
    finally:
        c._by_bytes.update({c.tokens[i]: i for i in merged})


def test_long_runs(library):
    c = bpe.codec(bpe.vocabulary())
    for t in ("x" + " " * 1_000_000 + "y", "\n" * 300_000, "ab" * 200_000, "\t \u00a0" * 100_000 + "z"):
        got = c.encode(t)
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids and c.decode(got) == t
        assert packing.encode(t, bpe.vocabulary()).tolist() == got.tolist()


def test_both_encoders_are_the_same(library):
    texts = [*TEXTS, *_random_texts(500), "a" + " " * 9_990 + "b", "a" + " \n" * 9_990 + "b", "z" * 300_000]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert packing.encode(t, bpe.vocabulary()).tolist() == want


def test_round_trip_query(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None, "a", "a"])]
    out = {r["doc_id"]: r for r in bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), bpe.vocabulary()).collect()}
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    ids = bpe.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), bpe.vocabulary())
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(ids, bpe.vocabulary()).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), bpe.vocabulary()).count() == 0


@pytest.mark.parametrize("capacity", [10, 50, 100])
def test_bins_hold_every_item_once(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 300)))
        places, bins = packing.pack_lengths(counts, capacity)
        inside, dealt = {}, Counter()
        for i, (length, rank, first, offset) in enumerate(places.tolist()):
            end = places[i + 1][1] if i + 1 < len(places) and places[i + 1][0] == length else counts[length]
            for r in range(rank, end):
                inside.setdefault(first + r - rank, []).append((offset, length))
                dealt[length] += 1
        assert dealt == counts and sorted(inside) == list(range(bins))
        for items in inside.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= capacity and sum(3 * n > capacity for _, n in items) <= 2
        total = sum(k * v for k, v in counts.items())
        assert -(-total // capacity) <= bins <= 1.5 * total / capacity + 1


def test_pack_query(spark, library):
    texts = [*TEXTS, None, "x" + " " * 1_000_000 + "y", "word " * 5000, "word " * 5000, "b " * 2047, "c " * 2048] + _random_texts(60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pack_documents(docs.withColumn("offset", docs["doc_id"])).collect()
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(-(-len(ids) // 2048)))
        at = 0
        for p in parts:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids) and all(p["length"] == 2048 for p in parts[1:])
    for items in by_bin.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack_documents(docs.limit(0)).count() == 0


def _payloads():
    rng = np.random.default_rng(0)
    raw = [b"", b"a", b"x" * 192, b"x" * 1000, rng.integers(0, 256, 5000, dtype=np.uint8).tobytes(), bytes(range(256)) * 9, (128 + 100 * np.sin(np.arange(4000) / 9)).astype(np.uint8).tobytes(), bytes([0, 255]) * 3000, b"The quick brown fox. " * 3000]
    return [media.pad(r) for r in raw]


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_flac_round_trip_and_seek(order):
    payloads = _payloads()
    streams = media.encode(payloads, order)
    assert media.decode(streams) == payloads and media.encode(payloads, order) == streams
    for s, p in zip(streams, payloads):
        for sample in (0, len(p) // 2, len(p) - 1):
            assert media.seek(s, sample) == p[sample // 192 * 192 :][:192]


def test_flac_errors_are_found():
    s = bytearray(media.encode([media.pad(b"The quick brown fox. " * 50)])[0])
    for at in (len(s) // 2, len(s) - 1, len(s) - 300):
        bad = bytearray(s)
        bad[at] ^= 8
        with pytest.raises(ValueError):
            media.decode([bytes(bad)])


def test_flac_rice_partitions_and_escapes():
    """A frame written bit by bit: order 1, two partitions, the first escaped with 5 bits."""
    x = np.cumsum(np.concatenate([[3], np.tile([1, -2, 4, -3], 48)[:191]]))
    res = np.diff(x)
    bits = f"{0:08b}"[:0] + f"{0x12:08b}" + f"{int(x[0]) & 255:08b}" + "00" + "0001" + "1111" + "00101" + "".join(f"{int(r) & 31:05b}" for r in res[:95]) + "0001"
    for r in res[95:].tolist():
        u = 2 * r if r >= 0 else -2 * r - 1
        bits += "0" * (u >> 1) + "1" + str(u & 1)
    bits += "0" * (-len(bits) % 8)
    body = np.frombuffer(bytes([0xFF, 0xF8, 0x14, 0x02, 0]), np.uint8)
    head = bytes([*body, int(media._crcs(body, np.array([0]), np.array([5]), media._CRC8, 8)[0])])
    frame = head + int(bits, 2).to_bytes(len(bits) // 8, "big")
    crc = int(media._crcs(np.frombuffer(frame, np.uint8), np.array([0]), np.array([len(frame)]), media._CRC16, 16)[0])
    buf = np.frombuffer(frame + crc.to_bytes(2, "big"), np.uint8)
    got = media.decode_frames(buf, np.array([0]), np.array([len(buf)]), np.array([6]))
    assert (got[0] == x).all()


def test_flac_query(spark):
    rows = [(1, "abc é", "z"), (2, None, "z"), (3, "", "z"), (4, "abc é", "z"), (5, "long " * 9000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, feature string")
    out = {r["doc_id"]: r for r in media.digest(docs, 2).collect()}
    for i, t, _ in rows:
        p = media.pad((t or "").encode())
        assert out[i]["payload_sha256"] == hashlib.sha256(p).hexdigest() and out[i]["tail_crc32"] == zlib.crc32(p[-16:])
        assert out[i]["n_bytes"] == len((t or "").encode()) and out[i]["payload_bytes"] == len(p)
    assert {k: v for k, v in out[1].asDict().items() if k != "doc_id"} == {k: v for k, v in out[4].asDict().items() if k != "doc_id"}
    blocks = media.pcm_blocks(docs).where("doc_id = 5").orderBy("block").collect()
    assert [b["sample_offset"] for b in blocks] == list(range(0, 45120, 192))
    assert media.digest(docs.limit(0)).count() == 0
