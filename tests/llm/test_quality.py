import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rollmatch.llm.quality import RULES, measures, quality_verdicts
from tests.llm.conftest import ODD

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def got(df):
    return {r["doc_id"]: tuple(r[n] for n in NAMES) for r in measures(df).collect()}


def test_counts_equal_brute_force_on_odd_rows(docs):
    out = got(docs(ODD))
    assert all(out[i] == brute(t) for i, t, _ in ODD)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="ab é*|\n\t\x0b\x1c ", max_size=80), min_size=1, max_size=30))
def test_counts_equal_brute_force(docs, texts):
    out = got(docs(list(enumerate(texts))))
    assert all(out[i] == brute(t) for i, t in enumerate(texts))


def test_verdicts(docs):
    prose = " ".join(f"the wordy{i} of text{i}" for i in range(40))
    rows = [(1, prose), (2, prose.upper()), (3, " ".join(f"{w}***" for w in prose.split())), (4, "too short"),
            (5, "again and again " * 60), (6, "\n".join([f"line {i} the of words here" for i in range(10)] * 3)), (7, None)]
    out = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_verdicts(docs(rows)).collect()}
    assert out[1] == (False, True)
    assert out[2] == (False, False) and out[3] == (False, False)
    assert out[4] == (True, False) and out[5] == (True, False) and out[6] == (True, False) and out[7] == (True, False)


def test_no_python_and_no_shuffle_in_the_plan(docs):
    plan = quality_verdicts(docs([(1, "a")])).select("*")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_empty_table_and_clashing_columns(docs):
    assert quality_verdicts(docs([])).count() == 0
    df = docs([(1, "a b c")]).withColumnsRenamed({"lang": "kept", "source": "n_words"})
    assert quality_verdicts(df).first()["n_words"] == 3
    assert len({r.measure for r in RULES}) == len(RULES)
