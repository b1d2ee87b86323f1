import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from rollmatch.llm.bpe import Decoder, Encoder, Transducer, Vocabulary, decode_documents, encode_documents
from rollmatch.llm.catalog import tokenizer_file
from tests.llm.conftest import ODD

FILE = tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, encoding="utf-8") as f:
        return Vocabulary(json.load(f))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_equals_the_library(library, vocabulary):
    encode, decode, rng = Encoder(vocabulary), Decoder(vocabulary), random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "'s", "É", "日", "\x1c", "\x85", "\xa0", "½", "_", "1", "23", "!", "...", "there,", " word.", "<|endoftext|>",
            "<|end", "😀", "̀", "\r\n", "\t", "​", "　", "ß", "\U0001fae9"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        expected = library.encode(t, add_special_tokens=False).ids
        assert ids(encode(t)) == expected, repr(t)
        assert decode(encode(t)) == library.decode(expected, skip_special_tokens=False)


def test_transducer_equals_the_library(library, vocabulary):
    encode, rng = Encoder(vocabulary, short=0), random.Random(8)
    for t in ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 300))) for _ in range(150)] + ["a" * 3000, "=" * 2000, "xy" * 1500, "é" * 500]:
        assert ids(encode(t)) == library.encode(t, add_special_tokens=False).ids


def test_transducer_memory_and_feeding(vocabulary):
    data = b"streaming" * 900
    stream, out = Transducer(vocabulary), []
    for i in range(0, len(data), 7):
        out += stream.feed(data[i:i + 7])
        assert len(stream.last) <= 3 * vocabulary.max_token and len(stream.window) <= vocabulary.max_token
    assert b"".join([*out, *stream.close()]) == data
    assert vocabulary.sufficient_lookahead >= vocabulary.max_token


def test_decoder_replaces_malformed_bytes(library, vocabulary):
    for tokens in ([130, 131], [222], [50256, 220, 222, 64]):
        packed = b"".join(i.to_bytes(4, "little") for i in tokens)
        assert Decoder(vocabulary)(packed) == Decoder(vocabulary)(packed) == library.decode(tokens, skip_special_tokens=False)


def test_small_cache_gives_the_same_ids(vocabulary, library):
    encode = Encoder(vocabulary, cache_size=4)
    t = " ".join(f"word{i % 9}, other{i % 5}." for i in range(200))
    assert ids(encode(t)) == library.encode(t, add_special_tokens=False).ids


def test_rows_round_trip(docs, library):
    coded = encode_documents(docs(ODD), FILE)
    out = decode_documents(coded, FILE).collect()
    texts = {i: t or "" for i, t, _ in ODD}
    assert len(out) == len(ODD)
    for r in out:
        assert r["text"] == texts[r["doc_id"]] and r["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids)
    assert {r["text"] for r in encode_documents(docs(ODD), FILE, decoded=True).collect()} == set(texts.values())
    assert encode_documents(docs([]), FILE).count() == 0
