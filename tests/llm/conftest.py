import pytest

#: doc_id, text, lang, source, n_chars and columns whose names clash with results.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, n_words string, component_id string, kept string, spans string, tie long, row_key long, label string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) pairs."""
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "x", "y", "z", "q", 5, 6, "l") for i, t in rows], SCHEMA).repartition(3)

    return make


EDGE_TEXTS = [None, "", " \n\t ", "a", "one two three four", "ß Ä é　日本 \U0001f600", "word " * 3000, "x" * 70000, "same line\nsame line\nsame line", "same line\nsame line\nsame line", "\r\n\x00\x0b\x0c<|endoftext|>\x85", "A.B,c;D e@f.g 1.2.3.4"]


@pytest.fixture(scope="session")
def edge_rows():
    return list(enumerate(EDGE_TEXTS)) + [(3, "a"), (3, "a"), (None, "no id"), (None, None)]
