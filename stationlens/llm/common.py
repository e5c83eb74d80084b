"""Helpers the operators share.

Conventions of every operator of this subpackage:

* only the named columns are read (``doc_id``, ``text``, ``vec_id``, ``embedding``), so extra
  columns, also ones called like a result or a helper column, have no influence;
* a null text is the empty text; rows with a null id keep their row in per-row results;
* a row is a document: repeated rows give repeated result rows, with equal values;
* an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import atexit
import os
import pathlib
import re
import shutil
import tempfile
import unicodedata
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LATIN1 = [chr(c) for c in range(256)]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once in an application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = pathlib.Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix=f"{here.name}-code-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, True)
    at = os.path.join(folder, f"{here.name}_llm.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in (here / "__init__.py", here / "session.py", *sorted((here / "llm").glob("*.py"))):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(at)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id long, text string never null, more...) of a documents table."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]],
             rows: int = 512) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows: ``make()`` runs once in a task and
    returns a function from a dict of column lists to a dict of result column lists. Slicing
    bounds the Python objects alive at a time whatever Spark's Arrow batch size is."""
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's decimal text mod 4 is 2 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def char_class(prefixes: str) -> str:
    """Latin-1 characters whose Unicode category starts with one of ``prefixes``, escaped for
    a character class."""
    return "".join(re.escape(c) for c in LATIN1 if unicodedata.category(c)[0] in prefixes)


#: White_Space property inside Latin-1 (what the tokenizer libraries take for \s).
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
LETTERS, NUMBERS = char_class("L"), char_class("N")
BEYOND_LATIN1 = re.compile("[^\x00-\xff]")


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Rows whose hashed key falls below ``fraction``: the same rows in every run and retry."""
    if fraction >= 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(fraction * (1 << 30)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label double) of about ``bound`` labelled rows that are not held out: a
    hash sample of the ids, so a retry sees the same rows. Rows labelled several times take the
    majority (ties: 0); null ids and labels take no part."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg(F.col(label).cast("double")) > 0.5).cast("double").alias("label"))
             .where(~held_out()))
    n = known.count()
    fraction = 1.0 if n <= bound else bound / n
    return (hash_sample(texts(docs).where(F.col("doc_id").isNotNull() & ~held_out()), "doc_id", fraction)
            .join(hash_sample(known, "doc_id", fraction), "doc_id"))


def newton_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression (mean loss), by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) / len(y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60.0, 60.0)))
