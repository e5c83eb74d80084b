"""Tables that every operator must stand: nulls, empty and long texts, repeated rows, extra columns
with names that operators use themselves."""

import random

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, label string, "
           "key string, drops string, drops_of long, keep_id long, k1 long, n_tokens long, node string, r int, id long")
WORDS = "the of and stone river carries morning light over quiet hills while old bridges keep their slow promise to every traveller".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randint(0, 99)) if r.random() < 0.1 else "") for _ in range(n))


def edge_rows() -> list[tuple]:
    long_line = prose(1, 60)
    rows = [(1, None), (2, ""), (3, "\n"), (4, " \t "), (5, prose(2, 200)), (6, prose(2, 200)), (6, prose(2, 200)),
            (7, prose(3, 30_000)), (8, "x" * 20_000), (9, "one"), (10, "é漢字 \U0001f44d\U0001f3fd <|endoftext|> naïve ½ \x85 end"),
            (None, prose(2, 200)), (None, None), (11, long_line + "\n" + prose(4, 50)), (12, prose(5, 50) + "\n" + long_line),
            (13, long_line.upper()), (14, "  " + long_line + "\t"), (15, long_line + "\n" + long_line), (16, long_line),
            (-5, "password = abcdef0123456789"), (1 << 40, prose(6, 300))]
    return [(i, t, None, "src0", None, 1.5, "x", "k", None, 7, None, 3, None, "n", 1, 2) for i, t in rows]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="module")
def more_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def by_id(df) -> list:
    return sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, str(r)))


def texts_of(df) -> list[tuple]:
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
