"""Bounded training samples and the models fitted on them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


# Parts in which a label's rows are ranked before the best of all parts are.
PARTS = 64


def per_label(rows: DataFrame, label: str, key: str, limit: int) -> DataFrame:
    """For every label the ``limit`` rows with the smallest hash of ``key``. Only label and
    key are ranked, first in ``PARTS`` parts of a label, so that one task ranks what the parts have
    left: ``PARTS * limit`` rows a label at most, however many there are."""
    order = [F.xxhash64(key), F.col(key)]
    dealt = rows.select(label, key).withColumn("_part", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(PARTS)))
    for by in ([label, "_part"], [label]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        dealt = dealt.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")
    return dealt.drop("_part")


def fit(rows: DataFrame, train: Callable[[pa.Table], object]):
    """``train`` run over ``rows`` (a bounded sample) in one task; the model it returns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if found:
            model = pickle.dumps(train(pa.Table.from_batches(found)))
            yield pa.record_batch({"model": pa.array([model], pa.binary())})

    got = rows.coalesce(1).mapInArrow(task, "model binary").collect()
    return pickle.loads(bytes(got[0].model)) if got else None
