import pytest


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The session, with a shared folder of its own where none is set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def documents(shared):
    """Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
    base = " ".join(f"alpha{i}" for i in range(60))
    rows = [
        (1, base, "en"), (2, base, "en"), (3, base.replace("alpha59", "other"), "en"), (4, None, "en"), (5, "", None),
        (6, " \t\n ", "fr"), (7, long, "en"), (8, "one two", "de"), (8, "one two", "de"), (9, "One TWO", None),
        (None, base, "en"), (None, None, None), (10, "é ü ß 日本 😀 " * 5, "fr"), (11, "x\ny\nz\nx\ny\nz\n" * 3, "en"),
    ]
    frame = shared.createDataFrame(rows, "doc_id long, text string, lang string")
    # names that operators use for columns of their own
    for name in ("row", "score", "n_words", "component_id", "node", "start", "kept", "found", "n_lines", "class"):
        frame = frame.selectExpr("*", f"'own' AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
