"""Rank-queue BPE against the public library, and exact round trips."""
import hashlib
import random

import pytest
from llm_cases import clash, documents, frame

from ontime_spark.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def pair():
    path, pattern = bpe.vocabulary()
    ranks = bpe.load_ranks(path)
    assert pattern == bpe.PATTERN
    return bpe.Encoder(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(pair):
    own, ref = pair
    rng = random.Random(1)
    texts = ["".join(rng.choice("aab b\n\tthe 123éñ中👍'sn_²½\x1c\x1f\x85\xa0ªº ing") for _ in range(rng.randint(0, 80)))
             for _ in range(1500)]
    texts += ["", " ", "<|endoftext|>", "a" * 5000, "ab" * 3000, "é" * 2000, " \n" * 500, "0123456789" * 300, "=-" * 900]
    for text, ids in zip(texts, own.encode_texts(texts)):
        assert [int(x) for x in ids.split()] == ref.encode_ordinary(text)
        assert own.decode_bytes(ids) == text.encode()


def test_own_queue_and_shared_queue_agree(pair):
    own, _ = pair
    rng = random.Random(2)
    pieces = ["".join(rng.choice("ab the") for _ in range(rng.randint(1, 40))).encode() for _ in range(400)]
    ids, counts = bpe.merge_many(pieces, own.pairs, own.byte_ids)
    at = 0
    for p, n in zip(pieces, counts.tolist()):
        assert ids[at:at + n].tolist() == bpe.merge(p, own.ranks)
        at += n


def test_full_memory_changes_nothing(pair, monkeypatch):
    own, ref = pair
    monkeypatch.setattr(bpe, "MEMORY", len(own.known) + 3)
    texts = [f"word{i} thing{i} unseen{i}" for i in range(50)] * 2
    assert [[int(x) for x in s.split()] for s in own.encode_texts(texts)] == [ref.encode_ordinary(t) for t in texts]


def test_documents(spark, pair):
    _, ref = pair
    rows = documents()
    out = bpe.digest_columns(clash(frame(spark, rows))).collect()
    want = []
    for d, text in rows:
        ids = ref.encode_ordinary(text or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert bpe.digest_columns(frame(spark, [])).count() == 0


def test_ids_and_bytes_columns(spark):
    rows = documents()
    done, r = bpe.encode(frame(spark, rows))
    back, b = bpe.decode(done.select("doc_id", "text", f"{r}.ids"))
    for x in back.collect():
        assert bytes(x[b].bytes) == (x.text or "").encode()
