from __future__ import annotations

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from tillwatch.llm import bpe
from tillwatch.llm.common import table
from tillwatch.llm.queries import op3_byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
EDGES = [
    None, "", " ", "  a", "a  b", "a \n b\n\n c ", "\u00a0x\u2003y", "x\x1cy\x1fz", "don't we'LL 'S",
    "ñandú Straße 東京 مرحبا 🙂🙂", "1234567890 ½ Ⅷ", "a" * 3000, "-_" * 900, "<|endoftext|> ok",
    "word " * 30_000, "\t\t\tend\r\n", "x" * 399 + "y", "é" * 401,
]


def plain(doc_id, text):
    ids = ENCODING.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_equals_the_library(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text").collect()
    assert rows(op3_byte_bpe(spark, sf)) == sorted((plain(*r) for r in documents), key=repr)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def edge(spark):
    data = [(i, t, [i], "x") for i, t in enumerate(EDGES)] + [(None, "a b", [1], "y"), (3, "  a", [1], "y")]
    return spark.createDataFrame(data, "doc_id long, text string, ids array<long>, bytes string")


def test_edges(vocabulary, edge):
    got = rows(vocabulary.round_trip(edge))
    assert got == sorted((plain(r["doc_id"], r["text"]) for r in edge.collect()), key=repr)


def test_small_segments_and_memory(vocabulary, edge, monkeypatch):
    # The functions run in workers, so the bounds are checked on the pieces directly.
    monkeypatch.setattr(bpe, "SEGMENT", 7)
    for text in EDGES:
        parts = list(bpe.segments(text or ""))
        assert "".join(parts) == (text or "")
        assert sum((ENCODING.encode_ordinary(p) for p in parts), []) == ENCODING.encode_ordinary(text or "")
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    coder = bpe.Coder(open(PATH, "rb").read(), P.PATTERN)
    for text in ("the quick brown fox jumps", "over the lazy dog again"):
        ids, = coder.encode([text])
        assert ids == b"".join(x.to_bytes(4, "little") for x in ENCODING.encode_ordinary(text))
        assert coder.decode([ids, b""]) == [text.encode(), b""]


def test_encode_and_decode_columns(vocabulary, edge):
    encoded = vocabulary.encode(edge)
    assert encoded.columns == ["doc_id", "text", "bytes", "ids"]
    for r in vocabulary.decode(encoded).collect():
        assert r["ids"] == ENCODING.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == (r["text"] or "").encode()


def test_empty_table(vocabulary, edge):
    assert vocabulary.round_trip(edge.limit(0)).count() == 0


CODER = []


@given(st.lists(st.text(max_size=60), max_size=5))
@settings(max_examples=60, deadline=None)
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    coder = CODER[0] if CODER else CODER.append(bpe.Coder(open(PATH, "rb").read(), P.PATTERN)) or CODER[0]
    for text, ids in zip(texts, coder.encode(texts)):
        assert [int(i) for i in coder.named(ids).split()] == ENCODING.encode_ordinary(text)
