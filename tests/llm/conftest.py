import pytest

# Columns that the operators might use names of, beside those of documents.
CLASHING = ["fp", "key", "row", "size", "slot", "hash", "id", "n", "words", "score"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, "
          + ", ".join(f"`{name}` string" for name in CLASHING))


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with clashing columns."""

    def build(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "web", None, *(["x"] * len(CLASHING)))
                for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, ties, repeated rows, and a long text."""
    prose = " ".join(f"word{i % 700}" for i in range(20_000))
    return [
        (1, None, None), (2, "", "a"), (3, " \n\t ", "b"), (4, "one", "a"), (5, "one", "a"),
        (6, "one two", None), (6, "one two", None), (None, "no id here", "b"),
        (None, "no id here", "b"), (None, None, None), (7, prose, "a"),
        (8, "Größe ÉTÉ 日本 😀 é́", "b"), (9, "\x00 nul\x1c x", "c"),
    ]


@pytest.fixture(scope="session")
def test_documents(spark, data_directory):
    return spark.read.parquet(f"{data_directory}/documents.parquet")
