"""The record of what each batch landed in a lake: small JSON-lines files beside its data.

A lake with a record is laid out ``year=/month=/batch=``; every batch has a name of
its own and writes only partitions of that name. Under ``_landed`` (hidden from
readers of the lake) lie, per batch, ``NAME.open`` before its first write and
``NAME.json`` after its last: one line per route, month and batch with row counts
and the first and last day. A batch with no ``.json`` is not part of the lake yet;
when it is written again, the months named in ``.open`` tell what to clear first.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketflow.session import delete_path, list_names, path_exists, write_text

LANDED = T.StructType([T.StructField(n, t, True) for n, t in (
    ("batch", T.StringType()), ("route", T.StringType()), ("reason", T.StringType()), ("year", T.IntegerType()),
    ("month", T.IntegerType()), ("n_rows", T.LongType()), ("first_day", T.DateType()), ("last_day", T.DateType()))])

REJECTS, UNMATCHED = "_rejects", "_unmatched"


class LandedLog:
    def __init__(self, spark: SparkSession, lake_path: str):
        self.spark, self.lake = spark, lake_path.rstrip("/")
        self.root = f"{self.lake}/_landed"

    def exists(self) -> bool:
        return path_exists(self.spark, self.root)

    def _names(self, ending: str) -> set[str]:
        return {n[:-len(ending)] for n in list_names(self.spark, self.root) if n.endswith(ending)}

    def done(self) -> set[str]:
        """Names of the batches that are part of the lake (one short name a batch)."""
        return self._names(".json")

    def is_done(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self.root}/{batch}.json")

    def unfinished(self) -> set[str]:
        return self._names(".open") - self.done()

    def begin(self, batch: str, lines: list[dict]) -> None:
        """Clears what an earlier try of the batch left behind and notes what this one will write."""
        note = f"{self.root}/{batch}.open"
        if path_exists(self.spark, note):
            months = self.spark.read.schema(LANDED).json(note).select("year", "month").distinct().collect()
            for m in months:  # a batch's own months
                delete_path(self.spark, f"{self.lake}/year={m['year']}/month={m['month']}/batch={batch}")
        for side in (REJECTS, UNMATCHED):
            delete_path(self.spark, f"{self.lake}/{side}/batch={batch}")
        write_text(self.spark, note, "".join(json.dumps(x) + "\n" for x in lines))

    def finish(self, batch: str, lines: list[dict]) -> None:
        write_text(self.spark, f"{self.root}/{batch}.json", "".join(json.dumps(x) + "\n" for x in lines))
        delete_path(self.spark, f"{self.root}/{batch}.open")

    def read(self, batches: set[str] | None = None) -> DataFrame:
        """The lines of all finished batches, or of those named: only their files are read."""
        names = self.done() if batches is None else batches & self.done()
        if not names:
            return self.spark.createDataFrame([], LANDED)
        files = [f"{self.root}/*.json"] if batches is None else [f"{self.root}/{n}.json" for n in sorted(names)]
        return self.spark.read.schema(LANDED).json(files)
