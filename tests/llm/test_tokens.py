"""Byte-pair encoding and token counts against another library and against plain counting."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from riskloom.llm import bpe, token_counts
from riskloom.llm.queries import VOCABULARY, vocabulary

from .conftest import LONG


@pytest.fixture(scope="module")
def own():
    return vocabulary()


@pytest.fixture(scope="module")
def other():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(own):
    assert [own.whole.find(t) for t in own.tokens] == list(range(len(own.tokens)))
    assert sorted(own.whole.key_at) == list(range(len(own.tokens)))


@pytest.mark.parametrize("seed", range(3))
def test_encode_like_the_library(own, other, seed):
    rng = random.Random(seed)
    alphabet = "abcdefghij ABC  \n\t'sdlt.,!0123éß你　​\U0001f600\x00\x1c\x85"
    coder = bpe.Coder(own)
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(120)))
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_long_pretokens(own, other):
    coder = bpe.Coder(own)
    for text in ("a" * 5000, "ab" * 3000, "你" * 2000, LONG, " " * 4000):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == other.encode_ordinary(text)


def test_documents(spark, odd, none, own, other):
    rows = bpe.round_trip_digests(odd, own, with_ids=True).collect()
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in odd.collect())
    assert len(rows) == len(texts)
    for (key, text), r in zip(texts, sorted(rows, key=lambda r: (r["doc_id"] or -1, r["n_tokens"]))):
        ids = np.array(other.encode_ordinary(text), "<u4")
        assert (key, len(ids), ids.tolist()) == (r["doc_id"] or -1, r["n_tokens"], r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip_digests(none, own).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(odd, own), own).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted(t.encode() for _, t in texts)


def test_token_counts(spark, odd, none, own, other):
    lengths = sorted(len(other.encode_ordinary(r["text"] or "")) for r in odd.collect())
    sums = token_counts.suffix_sums(token_counts.length_histogram(odd, own))
    for r in sums.collect():
        limit = r["n_tokens"]
        assert r["docs"] == lengths.count(limit) and r["tokens"] == limit * r["docs"]
        assert r["docs_longer"] == sum(x > limit for x in lengths)
        assert r["tokens_kept"] == sum(min(x, limit) for x in lengths)
        assert r["tokens_lost"] == sum(max(0, x - limit) for x in lengths)
        assert r["quantile"] == pytest.approx(sum(x <= limit for x in lengths) / len(lengths))
    assert {r["n_tokens"] for r in sums.collect()} == set(lengths)
    for limit in (0, 1, 2, 5, 1024, 10**6):
        assert tuple(token_counts.at_limit(sums, limit).first()) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    assert token_counts.quantile(sums, 0.5).first()[0] == lengths[(len(lengths) - 1) // 2]
    empty = token_counts.suffix_sums(token_counts.length_histogram(none, own))
    assert empty.count() == 0 and tuple(token_counts.at_limit(empty, 5).first()) == (0, 0)
