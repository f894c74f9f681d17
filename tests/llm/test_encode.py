import os
import random

import pytest
from pyspark.sql import functions as F

from fjordmill.llm import encode

pytestmark = pytest.mark.skipif(not os.path.exists(encode.TOKENIZERS), reason="no tokenizer files")
PIECES = ["hej ", "  ", "don't", "'ll", "\n\n", "\t", " æøå", "東京", "👩‍👩‍👧", "123", "<|endoftext|>", "x" * 50, " a", "!?", "  "]


def test_tree_equals_plain():
    enc = encode.encoder()
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))
        want = enc.encode_ordinary(text)
        assert encode.encode_tree(enc, text, leaf=rng.choice([1, 2, 7, 30])) == want
        assert enc.decode(want) == text


def test_join_is_associative():
    enc = encode.encoder()
    rng = random.Random(4)
    for _ in range(100):
        parts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(12))) for _ in range(3)]
        a, b, c = parts
        ids = [enc.encode_ordinary(p) for p in parts]
        left = encode.join_encoded(enc, a + b, encode.join_encoded(enc, a, ids[0], b, ids[1]), c, ids[2])
        right = encode.join_encoded(enc, a, ids[0], b + c, encode.join_encoded(enc, b, ids[1], c, ids[2]))
        assert left == right == enc.encode_ordinary(a + b + c)


def test_same_as_the_other_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{encode.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    text = "Hej <|endoftext|> verden's  æøå\n\n 東京 12345"
    assert encode.encoder().encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids


def test_frames(spark):
    long = "ord og flere ord " * 900
    rows = [(1, "", "a"), (2, None, "b"), (3, long, "c"), (4, "hej", "d"), (4, "hej", "d"), (5, "   ", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("part", F.lit(1))
    got = encode.encode_texts(df, split_chars=1000, leaf=100).collect()
    ids = {r["doc_id"]: r["ids"] for r in got}
    assert len(got) == 6 and ids[1] == [] and ids[2] is None
    assert ids[3] == encode.encoder().encode_ordinary(long) and encode.encoder().decode(ids[5]) == "   "
    assert {r["doc_id"]: r["n_tokens"] for r in encode.count_tokens(df).collect()}[3] == len(ids[3])
    assert encode.encode_texts(df.limit(0)).count() == 0


def test_repeated_ids_and_decoding(spark):
    """Long rows of one id stay apart; decoding gives the texts back."""
    from fjordmill.llm.encode import count_tokens, decode_texts, encode_texts, encoder

    texts = ["abc def " * 40, "ghi jkl, " * 50, "", None, "日本語の文。" * 60, "kort", "x" * 300, " \n\t " * 80]
    df = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    enc = encoder()
    encoded = encode_texts(df, split_chars=64, leaf=16)
    got = [r["ids"] for r in encoded.collect()]
    want = [None if t is None else enc.encode_ordinary(t) for t in texts]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sorted(str(r["text"]) for r in decode_texts(encoded, leaf=4).collect()) == sorted(map(str, texts))
    assert sorted(r["n_tokens"] for r in count_tokens(df, split_chars=64, leaf=16).collect()) == sorted(len(w or []) for w in want)
