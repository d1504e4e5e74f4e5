"""Incremental loading: files that arrive are read as a stream and upserted by key, micro-batch by micro-batch.

State lives in tables, not in the stream. A batch writes only its own rows, to a folder named by its number, so a batch
that is run again changes nothing and its cost does not grow with the table. Reading takes of each key the last row in
the table's order, of equal ones that of the last batch; now and then the batches are folded into a base. Without an
order a late row (a renewal or a re-extraction) is just the newer row of its key; with one, an old row that arrives late
replaces nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.operators.records import pick_last


class UpsertTable:
    """A table by key kept as ``root``/base=<n> and ``root``/delta=<n>; only complete folders count.

    The table is the highest base and the deltas after it, of each key the last row in ``order`` (columns of the rows,
    nulls first), then the one of the highest number. Every
    ``compact_every`` deltas they are written as a new base; folders before the last base are dropped.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], compact_every: int = 50, order: list[Column] | None = None):
        self.order = order or []
        self.spark, self.root, self.keys, self.compact_every = spark, root.rstrip("/"), keys, compact_every
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self, kind: str) -> list[int]:
        path = self._path(self.root)
        if not self._fs.exists(path):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(path)]
        done = [n for n in names if n.startswith(f"{kind}=") and self._fs.exists(self._path(f"{self.root}/{n}/_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in done)

    def read(self) -> DataFrame | None:
        """The table; None before the first batch."""
        bases = self.numbers("base")
        base = bases[-1] if bases else -1
        parts = [f"{self.root}/base={base}"] if bases else []
        parts += [f"{self.root}/delta={n}" for n in self.numbers("delta") if n > base]
        if not parts:
            return None
        out = None
        for i, part in enumerate(parts):
            rows = self.spark.read.parquet(part).withColumn("_batch", F.lit(i))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        columns = [c for c in out.columns if c != "_batch"]
        return pick_last(out, self.keys, [*self.order, F.col("_batch")], columns).select(*columns)

    def write(self, df: DataFrame, number: int) -> None:
        """Batch ``number``'s rows, unique by key; written again they replace themselves."""
        if (bases := self.numbers("base")) and bases[-1] >= number:
            return  # already folded
        df.write.mode("overwrite").parquet(f"{self.root}/delta={number}")
        last = bases[-1] if bases else -1
        if sum(n > last for n in self.numbers("delta")) >= self.compact_every:
            self.compact(number)

    def drop(self) -> None:
        """Removes the table's folder."""
        self._fs.delete(self._path(self.root), True)

    def compact(self, number: int) -> None:
        """Folds everything up to ``number`` into a base, then drops what the base before it replaced."""
        before = self.numbers("base")
        self.read().write.mode("overwrite").parquet(f"{self.root}/base={number}")
        # Readers that started on the last base may still use it and its deltas.
        keep_from = before[-1] if before else -1
        for kind in ("base", "delta"):
            for n in self.numbers(kind):
                if n < keep_from or (kind == "delta" and n <= keep_from):
                    self._fs.delete(self._path(f"{self.root}/{kind}={n}"), True)


def upsert_batches(keys: list[str], order: list[Column], good: Column, accepted: UpsertTable, review: UpsertTable, after: Callable[[DataFrame], None] | None = None):
    """The function for ``foreachBatch``: of each key in a batch the last row in ``order``; rows that pass ``good`` go
    to ``accepted``, others to ``review``; ``after`` rebuilds what depends on the table, its failure stops nothing."""

    def run(batch: DataFrame, number: int) -> None:
        last = pick_last(batch, keys, order, batch.columns).select(*batch.columns).persist()
        passes = F.coalesce(good, F.lit(False))
        for target, rows in ((accepted, last.where(passes)), (review, last.where(~passes))):
            target.write(rows, number)
        last.unpersist()
        if after is not None:
            try:
                after(accepted.read())
            except Exception:  # noqa: BLE001  a dependent table must not stop the inbox
                logging.getLogger(__name__).exception("dependent table not rebuilt")

    return run


def run_once(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes what has arrived, then stops; what was processed before is not read again."""
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def watch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 60):
    """Starts the query that looks for new files every ``seconds``; the caller stops it."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def arrivals(spark: SparkSession, folder: str, schema: str, glob: str, kind: str = "parquet", files: int = 10) -> DataFrame:
    """Files of ``folder`` as a stream, at most ``files`` a batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", glob)
    return (reader.option("multiLine", True) if kind == "json" else reader).format(kind).load(folder)
