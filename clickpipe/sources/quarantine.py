"""Accepted and rejected rows of a scan, both kept and counted.

A row is rejected where a value can't be read as its declared type or a needed one
is missing.  ``quarantine`` reads the input once and writes one table with two
partitions: accepted rows in the declared types, rejected ones with each faulty
column and its raw value.  Later runs add to the same folder, so rejects accumulate
per ``batch``; what a batch wrote is never changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

REASONS = ("malformed", "missing")


@dataclass
class Quarantine:
    """The two outputs of a quarantined scan, read from what it wrote."""

    accepted: DataFrame
    rejected: DataFrame

    def reasons(self) -> DataFrame:
        """One row for each faulty value: the row's raw columns as they were read, the
        column at fault, its raw value and the reason."""
        raw = [F.col(f"raw.`{c}`").alias(c) for c in self.rejected.schema["raw"].dataType.names]
        return self.rejected.select("batch", *raw, F.explode("faults").alias("f")).select(
            "batch", *[F.col(f"`{c.name}`").alias(f"raw_{c.name}") for c in self.rejected.schema["raw"].dataType.fields],
            F.col("f.column").alias("column"), F.col("f.value").alias("value"), F.col("f.reason").alias("reason"))

    def counts(self) -> DataFrame:
        """Rows in all, accepted and rejected by batch, in one pass over both outputs."""
        both = self.accepted.select("batch", F.lit(1).alias("a")).unionByName(self.rejected.select("batch", F.lit(0).alias("a")))
        return both.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a") == 1).alias("n_accepted"),
                                         F.count_if(F.col("a") == 0).alias("n_rejected"))


def _judged(raw: DataFrame, schema: StructType) -> DataFrame:
    """``raw`` (struct of texts), ``row`` (declared types) and ``faults`` of every row."""
    values = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    faults = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`").cast("string")
        reason = F.when(text.isNotNull() & values[f.name].isNull(), F.lit(REASONS[0]))
        if not f.nullable:
            reason = F.when(text.isNull(), F.lit(REASONS[1])).otherwise(reason)
        faults.append(F.struct(F.lit(f.name).alias("column"), text.alias("value"), reason.alias("reason")))
    return raw.select(F.struct(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in schema.fields]).alias("raw"),
                      F.struct(*[v.alias(c) for c, v in values.items()]).alias("row"),
                      F.filter(F.array(*faults), lambda x: x["reason"].isNotNull()).alias("faults"))


def quarantine(raw: DataFrame, schema: StructType, path: str, batch: str = "0") -> Quarantine:
    """Writes the rows of ``raw`` to ``path``, split by acceptance, and returns both parts
    of all batches there.  Columns that the schema doesn't name are left out."""
    judged = _judged(raw, schema)
    ok = F.size("faults") == 0
    rows = judged.select(F.when(ok, F.col("row")).alias("row"), F.when(~ok, F.col("raw")).alias("raw"), F.when(~ok, F.col("faults")).alias("faults"),
                         F.lit(batch).alias("batch"), F.when(ok, "accepted").otherwise("rejected").alias("status"))
    rows.write.mode("append").partitionBy("status", "batch").parquet(path)
    return read_quarantine(raw.sparkSession, schema, path)


def read_quarantine(spark, schema: StructType, path: str) -> Quarantine:
    """Both parts of all batches under ``path``."""
    fault = StructType([StructField(c, StringType()) for c in ("column", "value", "reason")])
    nullable = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    written = (StructType().add("row", nullable).add("raw", texts).add("faults", ArrayType(fault))
               .add("batch", StringType()).add("status", StringType()))
    found = spark.read.schema(written).parquet(path)
    accepted = found.filter("status = 'accepted'").select(*[F.col(f"row.`{c}`").alias(c) for c in schema.names], "batch")
    return Quarantine(accepted, found.filter("status = 'rejected'").select("raw", "faults", "batch"))
