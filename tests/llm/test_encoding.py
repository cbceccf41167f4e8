import random

import pytest

from quaymark.llm import encoding

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return encoding.load_ranks(encoding.vocabulary_path("byte_bpe_50k"))


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("public", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "Hello world", "it's  3.5\n\n\tpercent <|endoftext|>", "基金持有EQVBQ共331股。", "กองทุนถือ EQVBQ", "😂📉📉", "é  x", "aaaaaaaaaaaaaaaa", "\r\n \x00"]


def test_ids_equal_the_public_encoder(ranks, public):
    encoder = encoding.Encoder(ranks, remember=50)
    rng = random.Random(1)
    alphabet = "abc dé\n'0基ก😂."
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(300)]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == public.encode_ordinary(text)
        assert b"".join(public.decode_single_token_bytes(i) for i in ids).decode() == text


def test_both_ways_of_merging_agree(ranks):
    rng = random.Random(2)
    for n in (1, 2, 3, 50, 159, 160, 161, 700):
        for _ in range(20):
            word = bytes(rng.choice(b"aehinorst\xe5\x9f\xba") for _ in range(n))
            assert encoding.merge_short(word, ranks) == encoding.merge_long(word, ranks)


def test_very_long_word(ranks, public):
    word = "ab" * 100_000
    assert encoding.Encoder(ranks).encode(word)[:5] == public.encode_ordinary(word[:2000])[:5]


def test_table(spark, public):
    rows = [(1, "Hello world", 5), (2, None, 5), (3, "", 5), (1, "Hello world", 5), (4, " x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in encoding.encode(df).collect())
    assert got == sorted((i, public.encode_ordinary(t) if t else []) for i, t, _ in rows)
    assert encoding.encode(df.limit(0)).count() == 0
