import pytest

#: A text longer than a batch row usually is, with repeated words and lines.
LONG = "\n".join(f"line {i} of a very long text that goes on and on for {i % 7} words" for i in range(6000))

PASSAGE = "This passage of well over forty code points stands in many of the documents."

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.\n" + PASSAGE, "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog again and again.\n  " + PASSAGE.upper() + "\t", "en", "b"),
    (3, PASSAGE + "\n" + PASSAGE + "\nanother line", "de", "a"),
    (4, "Café Ünïcode “quotes” and 你好 世界 😀 end\n" + PASSAGE, "fr", None),
    (5, PASSAGE, None, "c"),
    (6, PASSAGE + "\n", "en", "a"),
    (7, "", "en", "a"),
    (8, None, "en", None),
    (9, "   \n\t \x0b", "en", "b"),
    (10, "word", "es", "b"),
    (11, "word", "es", "b"),
    (11, "word", "es", "b"),
    (12, LONG, "en", "a"),
    (13, LONG + " tail", "en", "b"),
    (None, "a row without an id\n" + PASSAGE, "en", "a"),
    (14, "<|endoftext|> it's <s> \x00 \u200b\u00a0x  y", "en", "d"),
    (15, "a" * 30000, "en", "d"),
]

#: Names that operators use inside or in their results.
CLASH = ["_id", "_hash", "_row", "key", "shard", "component_id", "_text", "start"]


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and long texts, repeated rows and extra columns with clashing names."""
    from pricelens.llm.common import prepare

    prepare(spark)
    rows = [(*r, len(r[1] or ""), *[f"{c}{i}" for c in CLASH]) for i, r in enumerate(ROWS)]
    rows[11] = rows[10]  # a whole row twice
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(messy):
    return messy.where("false").coalesce(1)


@pytest.fixture(scope="session")
def small_docs(spark):
    from pricelens.llm.common import prepare

    prepare(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
