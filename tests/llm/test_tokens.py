import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from riskloom.llm import byte_bpe, token_counts

PIECES = public_tokenizers.path(token_counts.VOCABULARY)
RANKS = public_tokenizers.path(byte_bpe.VOCABULARY)
ALPHABET = list("ab  ▁\n\t<>sx0Aé漢字日本的一是在🙂\x00'\x85\xa0\x1c") + ["the", "  ", "   ", "==", "'ll", " the", "</s>"]
FIXED = ["", " ", "  ", " a", "a ", "▁", "   a  b ", "aaaa" * 300, "    " * 200, "漢字" * 400, "=-" * 500, "ha" * 3000, "a\n  b", "a \nb", "a\n ", "plain words. Again, plain words."]


def texts(n=3000):
    rng = random.Random(1)
    return FIXED + ["".join(rng.choices(ALPHABET, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_piece_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES)
    assert counter.count(texts()) == [len(x) for x in model.encode(texts(), num_threads=1)]


def test_byte_ids_equal_the_library_and_decode(library):
    coder = byte_bpe.ByteEncoder(RANKS, public_tokenizers.PATTERN)
    got = coder.encode(texts())
    assert got == [np.array(library.encode_ordinary(t), dtype="<u4").tobytes() for t in texts()]
    assert [coder.decode(x) for x in got] == [t.encode() for t in texts()]


def test_columns(shared, library):
    rows = [(i, t, "x") for i, t in enumerate(FIXED)] + [(0, FIXED[0], "x"), (None, None, None)]
    df = shared.createDataFrame(rows, "doc_id long, text string, known string").repartition(3)
    counted = token_counts.count_tokens(df, PIECES)
    assert counted.columns == ["doc_id", "text", "known", "n_tokens"]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in counted.collect():
        assert r.n_tokens == len(model.encode(r.text or ""))
    coded = byte_bpe.encode_texts(byte_bpe.encode_digests(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    for r in byte_bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN).collect():
        want = library.encode_ordinary(r.text or "")
        assert r.ids == want and bytes(r.decoded) == (r.text or "").encode()
        assert r.tokens.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
    with pytest.raises(ValueError):
        token_counts.count_tokens(df, PIECES, out="KNOWN")
    assert token_counts.count_tokens(df.limit(0), PIECES).count() == 0


def test_an_encoder_that_travels_to_two_tasks_is_built_once():
    from pyspark import cloudpickle

    sent = cloudpickle.dumps(byte_bpe.encoder)
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    one, two = (cloudpickle.loads(sent)(path, public_tokenizers.PATTERN) for _ in range(2))
    assert one is two
    other = cloudpickle.loads(cloudpickle.dumps(byte_bpe.encoder))(path, r"\s+|\S+")
    assert other is not one and other.pattern.pattern == r"\s+|\S+"
