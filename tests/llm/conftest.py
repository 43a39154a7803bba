from pathlib import Path

import pytest
from pyspark.sql import functions as F

from heliovent.llm.queries import importable

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that every operator must take: nulls, empty, white, very long, repeated, few words, foreign letters."""
    passage = "the quick brown fox jumps over the lazy dog while seven wizards watch from a distant hill and say nothing at all about it "
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    return [
        (900_001, None, "en", "a", None),
        (900_002, "", "en", None, 0),
        (900_003, " \n\t \x0b ", None, "a", 6),
        (900_004, "one two", "en", "a", 7),
        (900_005, "one two", None, "a", 7),
        (900_006, passage * 3, "en", "a", 400),
        (900_006, passage * 3, "en", "a", 400),
        (900_007, passage * 3 + "tail of another kind", "en", "a", 400),
        (None, passage * 3, "en", "a", 400),
        (None, "a row without a number " * 4, "en", "a", 90),
        (900_008, long, "en", "a", len(long)),
        (900_009, "x" * 50_000, "en", "a", 50_000),
        (900_010, "日本語のテキスト 1234 ÀÉß naïve ▁ <|endoftext|> I'm we'll DON'T\r\nnew\x1cline", None, None, None),
        (900_011, "12345 67890 !!! ... 42", "de", "a", 22),
        (900_012, "A\nA\nA\n b \n b \nC d e f g h A\n", "en", "a", 30),
        (900_013, "Released under the MIT License.\nmail me: jo [at] example [dot] org or a@b.co", "en", "a", 80),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    importable(spark)
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def docs(spark, odd):
    """All of the smallest table of documents and the odd rows, with further columns whose names operators use as well."""
    table = spark.read.parquet(f"{DATA}/documents.parquet").select(*odd.columns)
    more = {"block_id": "x", "row": 1, "kept": None, "label": 2.5, "rep": "r", "held_out": "no", "task": 3, "rank": "q", "component": 0}
    return table.union(odd).withColumns({k: F.lit(v).cast("string") if v is None else F.lit(v) for k, v in more.items()}).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")


def sorted_rows(frame, *names):
    got = [tuple(r[n] for n in names) for r in frame.collect()]
    return sorted(got, key=repr)


assert Path(DATA).is_dir()
