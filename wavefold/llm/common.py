"""Helpers shared by the corpus operators.

Operators select the columns they need by name and rename them to the fixed
names below, so extra or clashing input columns never reach a join.
"""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id and the text, under fixed names, and ``more``; a null text is empty."""
    return docs.select(
        *more,
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage at a place that survives lost executors; the folder comes from
    ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that are worth a partition of their own, where rows are short.
PARTITION_ROWS = 100_000


def gathered(df: DataFrame, rows: int, each: int = PARTITION_ROWS) -> DataFrame:
    """``df``, of about so many short rows, in as many partitions as they fill (all cores get one at least).

    Every partition that is stored or checkpointed is a file, and every file costs an executor time and a
    process; without this a handful of rows would be as many files as the session has shuffle partitions.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def worker_state(key: str, build: Callable[[], object]) -> object:
    """One object per Python worker process, built at first use.

    Functions reach the workers pickled by value, so their own module globals
    start afresh with every task; this lives beside them in ``sys.modules``. A
    worker holds one such object: stages of a pipeline follow each other in the same
    workers, and what an earlier one has built would only take memory.
    """
    home = sys.modules.setdefault("_wavefold_llm_worker", types.ModuleType("_wavefold_llm_worker"))
    if home.__dict__.get("key") != key:
        home.key = home.value = None
        home.value = build()
        home.key = key
    return home.value


def drop_worker_state() -> None:
    """Called by functions that build nothing to keep: what an earlier stage has left is freed."""
    home = sys.modules.get("_wavefold_llm_worker")
    if home is not None and home.__dict__.get("value") is not None:
        home.key = home.value = None
        gc.collect()
        pa.default_memory_pool().release_unused()


#: Bytes of an Arrow batch that are turned into Python objects at once.
SLICE_BYTES = 4_000_000


def slices(batches: Iterator) -> Iterator:
    """The rows of Arrow batches in slices of about SLICE_BYTES (a longer row is a slice of its own)."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """For every slice of the Arrow batches: the named columns as Python lists."""
    for batch in slices(batches):
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


class Memo:
    """A bounded memory in two halves: the half in use, and the one before it.

    When the half in use is full it becomes the older one; what is asked for
    again is moved over, so frequent keys stay. ``known`` is stable: look keys up
    there first, then in ``older``, and ``put`` what was found or made.
    """

    def __init__(self, size: int):
        self.half = size // 2
        self.known: dict = {}
        self.older: dict = {}

    def put(self, key, value) -> None:
        self._turn()
        self.known[key] = value

    def update(self, found: dict) -> None:
        self._turn()
        self.known.update(found)

    def _turn(self) -> None:
        if len(self.known) >= self.half:
            self.older = self.known.copy()
            self.known.clear()
