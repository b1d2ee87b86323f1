import random

import pytest
import sentencepiece

from rollmatch.llm import tokens
from rollmatch.llm.catalog import tokenizer_file
from rollmatch.llm.tokens import Lengths, PreTokens, count_tokens
from tests.llm.conftest import ODD

FILE = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def test_pretokens_add_up(sp):
    rng, bits = random.Random(3), ["a", "the", " ", "  ", "\n", "▁", "é", "ﬁ", "<s>", "</s>", "<unk>", "日", "0", "!", "\t", " the", " "]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert sum(map(Lengths({}, sp, 1000).__getitem__, PreTokens.split(t))) == len(sp.encode(t)), repr(t)


def test_counts_equal_the_library(docs, sp):
    out = {r["doc_id"]: r for r in count_tokens(docs(ODD), FILE, limit=100).collect()}
    for i, t, _ in ODD:
        n = len(sp.encode(t or ""))
        assert (out[i]["n_bytes"], out[i]["n_tokens"], out[i]["over_limit"]) == (len((t or "").encode()), n, n > 100)
    assert count_tokens(docs([]), FILE).count() == 0


def test_tiny_tables_give_the_same_counts(docs, sp):
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(200))) for i in range(20)]
    out = count_tokens(docs(rows), FILE, table_size=3, per_task=2, cache_size=5).collect()
    assert all(r["n_tokens"] == len(sp.encode(rows[r["doc_id"]][1])) for r in out)
    cache = Lengths({}, sp, 2)
    assert [cache[w] for w in ("aa", "bb", "cc", "aa")] == [len(sp.encode(w)) for w in ("aa", "bb", "cc", "aa")] and len(cache) <= 2


def test_the_summed_tables_lie_in_few_files(docs, sp, files_written):
    rows = [(i, " ".join(f"w{j}" for j in range(100))) for i in range(20)]
    seen = files_written(tokens)
    out = count_tokens(docs(rows), FILE).collect()
    assert {r["n_tokens"] for r in out} == {len(sp.encode(rows[0][1]))}
    assert seen == [("pretokens", 1)]
