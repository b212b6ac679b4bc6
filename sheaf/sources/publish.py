"""Jobs with several outputs, published together (rows K3, K5).

A run writes its outputs into a hidden folder beside the final one. When all are complete it
adds a manifest with their files and renames the folder, so a reader sees the whole run or
none of it; where a rename is no single step, the manifest tells whether all has arrived.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from sheaf.session import file_system
from sheaf.sources.sinks import run_path

MANIFEST = "manifest.json"
OWNER = "_OWNER"


class Publication:
    """One run: ``path`` (``<base>_<epoch millis>``, free when the run began) and the hidden
    folder its outputs are written to."""

    def __init__(self, spark: SparkSession, base: str, millis: int | None = None):
        self.spark = spark
        millis = int(time.time() * 1000) if millis is None else millis
        while True:
            self.path = run_path(base, millis)
            folder, name = os.path.split(self.path)
            self.staged = os.path.join(folder, f"_staged_{name}")
            if self._reserved():
                return
            millis += 1

    def _reserved(self) -> bool:
        """Whether this run is the first to take its number: one creator of a file wins."""
        fs, owner = file_system(self.spark, os.path.join(self.staged, OWNER))
        try:
            fs.create(owner, False).close()
        except Py4JJavaError as e:
            if not fs.exists(owner):
                raise e
            return False
        if not fs.exists(file_system(self.spark, self.path)[1]):
            return True
        fs.delete(owner.getParent(), True)  # published between the two looks
        return False

    def output(self, name: str) -> str:
        """Where the run writes output ``name``."""
        return os.path.join(self.staged, name)

    def publish(self) -> str:
        """Add the manifest and make the run visible."""
        fs, staged = file_system(self.spark, self.staged)
        outputs = {x.getPath().getName(): _files(fs, x.getPath()) for x in fs.listStatus(staged) if x.isDirectory()}
        text = json.dumps(outputs, sort_keys=True).encode()
        out = fs.create(file_system(self.spark, os.path.join(self.staged, MANIFEST))[1], True)
        try:
            out.write(text)
        finally:
            out.close()
        fs.delete(file_system(self.spark, os.path.join(self.staged, OWNER))[1], False)
        if not fs.rename(staged, file_system(self.spark, self.path)[1]):
            raise OSError(f"{self.staged} could not be renamed to {self.path}")
        return self.path

    def discard(self) -> None:
        fs, staged = file_system(self.spark, self.staged)
        fs.delete(staged, True)


def _files(fs, folder) -> dict[str, int]:
    """Names and sizes of the data files of one output."""
    found = {x.getPath().getName(): x.getLen() for x in fs.listStatus(folder) if x.isFile()}
    return {name: size for name, size in found.items() if not name.startswith(("_", "."))}


@contextmanager
def publication(spark: SparkSession, base: str) -> Iterator[Publication]:
    """A run that is published at the end of the block, or discarded after an error."""
    run = Publication(spark, base)
    try:
        yield run
        run.publish()
    except BaseException:
        run.discard()
        raise


def published(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The outputs of the run at ``path`` with their folders; None unless its manifest and
    every file that it names are there."""
    fs, manifest = file_system(spark, os.path.join(path, MANIFEST))
    if not fs.exists(manifest):
        return None
    named = json.loads(spark.read.text(manifest.toString(), wholetext=True).first().value)
    for output, files in named.items():
        folder = file_system(spark, os.path.join(path, output))[1]
        if not fs.exists(folder) or _files(fs, folder) != files:
            return None
    return {output: os.path.join(path, output) for output in named}
