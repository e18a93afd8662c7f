import random

import public_tokenizers as P
import pytest
import tiktoken

import brute
from parcorpus.llm import bpe
from parcorpus.llm.queries import QUERIES, token_digests

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    raw = bpe.read_ranks(P.path(request.param))
    ranks = bpe.parse_ranks(raw)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Encoder(ranks, P.PATTERN), own.encode_ordinary


def test_random_texts(both):
    enc, want = both
    rng = random.Random(5)
    kinds = ["ab", "abcde", "the onein ", " \n\t\x85\xa0", "éüñßàçö", "日本語中文字", "0123456789", "!?.,'s't're<|>", "ａ١२é"]
    tokens = list(enc.ranks)
    for k in range(4000):
        kind = rng.choice(kinds)
        t = "".join(rng.choice(kind) for _ in range(rng.randint(0, 60)))
        if k % 3 == 0:
            t = "".join(rng.choice(tokens).decode("utf8", "ignore") for _ in range(8))
        assert enc.encode(t) == want(t), repr(t)
    for t in ("a" * 30000, " " * 5000, "ab" * 9000, "é" * 4000, "xyzw" * 3000, "<|endoftext|>"):
        assert enc.encode(t) == want(t)


def test_every_basic_character(both):
    enc, want = both
    t = "".join(f"a{c} b{c}{c} " for c in map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)]))
    assert enc.encode(t) == want(t)
    latin = "".join(f"a{c} b{c}{c} " for c in map(chr, range(1, 256)))
    assert enc.encode(latin) == want(latin)


def test_dead_ends_and_memo_limits(both, monkeypatch):
    enc, want = both
    monkeypatch.setattr(bpe, "WORD_MEMO", 3)
    monkeypatch.setattr(bpe, "PAIR_MEMO", 3)
    for t in ("one two three four five six seven", "zzzzqqq aaabbb unbelievablyness"):
        assert enc.encode(t) == want(t)


def test_query_matches_tiktoken(spark):
    ranks = bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_byte_bpe"](spark, SF).collect():
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(own.decode_bytes(ids)))


def test_edges(spark):
    rows = [(1, None, 9), (2, "", 9), (2, "", 9), (None, "x" * 300000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded_sha256"]) for r in token_digests(df).collect())
    empty = brute.sha(b"")
    assert [g[1] for g in got][1:] == [0, 0, 0] and {g[2] for g in got[1:]} == {empty}
    assert got[0][2] == brute.sha(b"x" * 300000)
    assert token_digests(df.limit(0)).count() == 0
    raw = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    bad = spark.createDataFrame([([10 ** 7],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, raw).collect()
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), raw).first()["decoded"] is None
