"""What the corpus operators share: reading, row keys, Arrow passes and components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.session import materialize

# White space is 0x09-0x0D and 0x20, and only A-Z is lower-cased.  Both are
# what bytes.split() and bytes.lower() do, so texts travel to Python as bytes.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


# Set only where the session has no value of its own: Arrow batches are cut by bytes, so that
# workers hold a few megabytes of text however long the texts are.
DEFAULTS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Set the defaults, and send this library to the executors once for each application.

    Tasks unpickle functions by module name, and workers need not have the library's folder
    on their path.
    """
    context = spark.sparkContext
    for key, value in DEFAULTS.items():
        if context.getConf().get(key) is None:
            spark.conf.set(key, value)
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="brookmart-code-"), "brookmart_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """64 bits that tell rows apart by id and text; full copies of a row share them."""
    return F.xxhash64(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")))


def arrow_pass(df: DataFrame, function: Callable[[pa.RecordBatch], dict | None],
               schema: str, most_bytes: int = 8 << 20) -> DataFrame:
    """Apply `function` to Arrow batches of about `most_bytes` or less; it returns the columns
    of its result by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most_bytes):
                out = function(piece)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about `most_bytes`, one row at least."""
    rows = batch.num_rows
    if rows == 0:
        return
    step = max(1, min(rows, int(rows * most_bytes / max(batch.nbytes, 1))))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def ints(column: pa.Array) -> np.ndarray:
    """A column of integers without nulls as numpy."""
    return column.to_numpy(zero_copy_only=False)


def count_threshold(counts: DataFrame, most: int) -> int:
    """A count `n` (column of `counts`) that at most `most` rows reach, and if more than
    `most` rows have one count, none.  Counts are told apart by quarters of a power of two."""
    level = F.floor(F.log2("n") * 4)
    rows = counts.groupBy(level.alias("level")).count().collect()     # under 256 levels
    total, least = 0, None
    for row in sorted(rows, reverse=True):
        total += row[1]
        if total > most:
            break
        least = row[0]
    return 1 << 62 if least is None else int(np.ceil(2 ** (least / 4) - 1e-9))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node of every linked node: `links(a, b)` -> `(node, root)`.

    Large-star and small-star rounds over stored tables: each round replaces edges by
    edges to the smallest neighbour, so a hub's edges are spread over its neighbours.
    Nodes are longs and never null.  Nothing but two figures a round reaches the driver.
    An empty `links` gives an empty result.
    """
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        edges = materialize(small, name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
