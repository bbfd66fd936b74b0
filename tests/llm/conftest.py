import pytest

#: Texts that every operator has to take: null, empty, blank, short, ties, copies, beyond ASCII, long.
EDGE_TEXTS = [
    None,
    "",
    "  \n\t ",
    "a",
    "Hello, World!",
    "hello,\tworld!",
    "é ß 日本 😀 ▁ \\ </s>",
    "one two three four five six",
    "one two three four five six",
    "One  two three\nfour five six ",
    "x" * 3000,
    "word " * 4000,
    " ".join(f"w{i}" for i in range(900)),
    " ".join(f"w{i}" for i in range(899)) + " other",
]


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Rows with nulls in every column, a repeated row, and columns whose names operators use themselves."""
    rows = [(i, text, "en", None if i % 4 == 0 else f"src{i % 3}", len(text or "")) for i, text in enumerate(EDGE_TEXTS)]
    rows += [rows[7], (None, "no id", None, None, None), (None, None, "de", "src1", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = "score size node key digest ids _id _key _size _range row best spans n cluster".split()
    for name in clash:
        table = table.withColumn(name, table["lang"])
    return table.repartition(3)


@pytest.fixture(scope="session")
def no_documents(edge_documents):
    return edge_documents.limit(0)
