"""What the tables of a build stage were made from."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "stage string, input string, parameters string, complete boolean"
_SUM = "decimal(38,0)"


def content_digest(rows: DataFrame) -> str:
    """A digest of schema and rows, whatever their order and partitioning; repeated rows count.

    One scan, one row per partition shuffled. Two sums over differently seeded
    64-bit hashes: meant to notice changes, not to withstand an attacker.
    """
    columns = sorted(rows.columns)
    # A null leaves a hash as it was, so which values are null is hashed too.
    values = [F.col(f"`{c}`") for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]
    totals = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(F.lit(1), *values).cast(_SUM)).alias("one"),
        F.sum(F.xxhash64(F.lit(2), *values).cast(_SUM)).alias("two"),
    ).first()
    types = [(c, rows.schema[c].dataType.simpleString()) for c in columns]
    return hashlib.sha256(json.dumps([types, *map(str, totals)]).encode()).hexdigest()


class Manifest:
    """The record of one stage, a table of one row under the build's root."""

    def __init__(self, spark: SparkSession, root: str, stage: str):
        self.spark, self.stage, self.path = spark, stage, f"{root}/manifest/{stage}"
        self.input: str | None = None
        self.parameters: dict[str, Any] = {}
        try:
            row = spark.read.schema(_SCHEMA).json(self.path).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        if row is not None and row["complete"]:
            self.input, self.parameters = row["input"], json.loads(row["parameters"])

    def matches(self, input_digest: str, parameters: dict[str, Any]) -> bool:
        """The stage ended, on this input and with these parameters."""
        return self.input == input_digest and self.parameters == _plain(parameters)

    def begin(self) -> None:
        """From here on the stage's tables may be half written."""
        self._write(None, {}, False)

    def end(self, input_digest: str, parameters: dict[str, Any]) -> None:
        self._write(input_digest, parameters, True)

    def _write(self, input_digest: str | None, parameters: dict[str, Any], complete: bool) -> None:
        row = (self.stage, input_digest, json.dumps(_plain(parameters), sort_keys=True), complete)
        self.spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("overwrite").json(self.path)


def _plain(parameters: dict[str, Any]) -> dict[str, Any]:
    """Parameters as JSON holds them: tuples and ranges as lists."""
    return json.loads(json.dumps(parameters, default=list))
