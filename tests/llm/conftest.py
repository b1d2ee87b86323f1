import pytest

from tests.conftest import spark  # noqa: F401

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    """docs(rows): a documents frame from (doc_id, text[, lang]) tuples."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC)
    return build


@pytest.fixture
def files_written(spark, monkeypatch):  # noqa: F811
    """files_written(module): a list that gets (tag, files) of each table the module writes from now on, while shuffles have
    40 partitions that are not coalesced."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)

    def watch(module):
        seen, plain = [], module.written

        def written(df, tag):
            out = plain(df, tag)
            seen.append((tag, len(out.inputFiles())))
            return out

        monkeypatch.setattr(module, "written", written)
        return seen

    yield watch
    for k, v in before.items():
        spark.conf.set(k, v)


#: NULLs, empty, white space only, one very long text, repeated rows, a NULL id.
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ODD = [(1, None, None), (2, "", "en"), (3, " \t\n\r ", "en"), (4, LONG, "en"), (5, "one two three", "en"), (5, "one two three", "en"),
       (None, "no id here at all", "en"), (6, "x" * 5000, "de"), (7, "Füße ünd Straßen über Öl", "de")]
