import random
import re
import time
from collections import Counter

from rollmatch.llm.langid import _WORD, Parser, SuffixAutomaton, identify_languages, in_learned_language, labelled_sample, shares
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def longest_matches(text, words):
    """Brute force: greedy longest substrings of any word."""
    n = i = 0
    while i < len(text):
        k = i
        while k < len(text) and any(text[i:k + 1] in w for w in words):
            k += 1
        i, n = max(k, i + 1), n + 1
    return n


def test_automaton_holds_exactly_the_substrings():
    rng = random.Random(4)
    for _ in range(60):
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 8))]
        a = SuffixAutomaton()
        for w in words:
            a.add(w)
        assert len(a.size) <= 2 * sum(map(len, words)) + 1
        for _ in range(40):
            t = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
            assert a.phrases(t) == longest_matches(t, words), (words, t)


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    out = [r for r in identify_languages(df).collect() if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in out)
    assert len(out) > 20 and right / len(out) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_odd_rows_and_nothing_learned(docs):
    out = Counter((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in identify_languages(docs(ODD)).collect())
    assert all(out[(i, "und", False)] == 1 for i in (1, 2, 3))
    unlabelled = docs([(i, "some words here", None) for i in range(1, 9)])
    assert {r["lang_pred"] for r in identify_languages(unlabelled).collect()} == {"und"}
    assert identify_languages(docs([])).count() == 0


def test_rows_in_learned_languages_pass_unchanged(docs):
    rows = [(i, f"the house and the garden {i}", "en") for i in range(20)] + [(100, "12 34 ..", "en"), (101, "漢字仮名交文漢字仮名交文", None), (102, None, "en")]
    df = docs(rows).withColumnRenamed("source", "found")
    kept = in_learned_language(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(20))


def test_every_language_with_a_usable_row_is_learned(docs):
    english = [(i, f"the house and the garden number {i}", "en") for i in range(1, 120)]
    # a language of books only; one whose labelled rows are mostly NULL or letterless; one whose rows share an id
    greek = "το σπίτι και ο κήπος είναι εδώ σήμερα "
    books = [(i, "12. " + greek * 2000 + str(i), "el") for i in range(200, 300)]
    russian = [(i, None if i % 2 else f"{i} -- ..", "ru") for i in range(300, 700)] + [(701, "дом и большой сад стоят у реки", "ru"), (702, "дом и сад у реки", "ru")]
    hebrew = [(801, "12 34", "he")] * 100 + [(801, "הבית והגן הגדול ליד הנהר", "he")]
    rows = english + books + russian + hebrew
    out = {(r["doc_id"], r["lang_pred"]) for r in identify_languages(docs(rows)).collect()}
    assert {(200, "el"), (299, "el"), (701, "ru"), (801, "he"), (5, "en")} <= out
    kept = {r["doc_id"] for r in in_learned_language(docs(rows)).collect()}
    assert {200, 299, 701, 801, 5} <= kept
    sample = labelled_sample(docs(rows), "doc_id", "text", "lang", 5, 64, 60_000)
    assert set(sample) == {"en", "el", "ru", "he"} and all(sum(map(len, x)) <= 60_000 and len(x) <= 64 for x in sample.values())
    words = set(greek.split())
    assert len(sample["el"]) == 64 and {w for t in sample["el"] for w in t.split() if not w.isdigit()} == words


def test_shares():
    assert shares([5, 5, 100], 40) == 30 and shares([100], 60) == 60 and shares([1, 2], 60) == 60 and shares([100, 100], 60) == 30


def test_numbers_are_no_letters(docs):
    learned = [(i, f"the house and the garden number {i}", "en") for i in range(40)]
    out = {r["doc_id"]: r["lang_pred"] for r in identify_languages(docs([*learned, (100, "²½ Ⅷ ① ٣", None), (101, "²½ the house", None)])).collect()}
    assert out[100] == "und" and out[101] == "en"


def test_numbers_split_words():
    parser = Parser({"aa": ["abc abd xyz"], "bb": ["bcd bce"]}, 1000)
    for text in ("ab²cd", "Ⅳ abc½", "²", "xyz ①②", "İab ßé a𐄇b", "3abc_abd4 é²é"):
        words = _WORD.findall(text.lower())
        want = [sum(map(len, _WORD.findall(text))), *(sum(a.phrases(f" {w} ") for w in words) for a in parser.automata)]
        assert parser.letters_and_phrases(text) == want, text


def test_a_letter_costs_as_much_as_a_plain_pattern():
    parser = Parser({"aa": ["abc abd xyz"], "bb": ["bcd bce"]}, 1000)

    def seconds(f, text):
        took = []
        for _ in range(5):
            began = time.process_time()
            f(text)
            took.append(time.process_time() - began)
        return min(took)

    # all words are in the cache: what is left is finding them once
    text = "abcdefgh abc abdefghijk " * 20_000
    assert seconds(parser, text) < 8 * seconds(re.compile(r"[^\W\d_]+").findall, text)
