"""Small tables with every awkward case, shared by the operator tests."""

import pytest

from medallion.llm.common import ship_code

LONG = " ".join(f"word{i % 997}" for i in range(60_000))
LICENSE = "Released under the MIT License."
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "src0"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "src0"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "src0"),  # a repeated row
    (3, None, "en", "src1"),
    (4, "", None, None),
    (5, " \t\r\n\n ", "de", "src1"),
    (6, LONG, "en", "src0"),
    (7, f"Some text. {LICENSE} GNU  General\nPublic-License, cc by!", "fr", "src2"),
    (None, "a row without an id but with some words in it for good measure", "en", "src2"),
    (8, "Été à la mer — naïve café, 東京 ÉTÉ K<|im_end|> <|endoftext|> \x00 ok", "xx", "src3"),
    (9, "same same same same same same same same same same same same", "en", "src3"),
    (10, "one two", "en", "src3"),
    (10, "another text with the same id", "es", "src3"),
]
CLASHING = ["score", "shard", "kept", "node", "label", "words", "row", "ids", "topic", "fold", "component_id", "__topic", "__kept", "__weight", "__c_lang", "__id", "__own", "__row", "part", "bucket"]


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship_code(spark)
    return spark


@pytest.fixture(scope="session")
def odd_documents(llm_spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose
    names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    rows = [(*r, len(r[1] or ""), *["x"] * len(CLASHING)) for r in ROWS]
    return llm_spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


@pytest.fixture(scope="session")
def sample_documents(llm_spark):
    return llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
