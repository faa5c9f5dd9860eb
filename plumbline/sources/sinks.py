"""Sinks over Parquet folders: strict append, append once, period replacement, keyed upsert in buckets, snapshot, run log.

One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.keys import differs
from plumbline.sources.landing import exists


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


#: What Spark names the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folders(spark: SparkSession, path: str, column: str) -> dict[str | None, object]:
    """The partitions of a folder that Spark wrote by ``column``: the text that names each, None for no value, and its own folder."""
    fs, at = _fs(spark, path)
    parts = [(status.getPath().getName().partition("="), status.getPath()) for status in fs.listStatus(at)] if fs.exists(at) else []
    return {None if value == NO_VALUE else unquote(value): own for (key, _, value), own in parts if unquote(key).lower() == column.lower()}


def _moved(fs, source, target) -> None:
    """Put a folder in place of another."""
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"not moved: {source} to {target}")


def append(df: DataFrame, path: str) -> None:
    """Append rows whose columns and types are the table's; anything else raises before a row is written."""
    spark = df.sparkSession
    if exists(spark, path):
        have = [(f.name, f.dataType) for f in spark.read.parquet(path).schema]
        new = [(f.name, f.dataType) for f in df.schema]
        if have != new:
            raise ValueError(f"schema differs from the table's: {new} against {have}")
    df.write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, source: str, batch: int | str) -> None:
    """Append a batch under its source's name and its own; the same batch again takes the place of itself.

    A run that died while or after writing can be repeated: rows of one (source, batch) stand in a folder of their own,
    which a repeat overwrites. Schemas are compared as in ``append``. The table has two more columns, ``_source`` and ``_batch``.
    """
    spark = df.sparkSession
    if exists(spark, path):
        have = {f.name: f.dataType for f in spark.read.parquet(path).drop("_source", "_batch").schema}
        new = {f.name: f.dataType for f in df.schema}
        if have and have != new:
            raise ValueError(f"schema differs from the table's: {new} against {have}")
    df.write.mode("overwrite").parquet(f"{path}/_source={quote(str(source), safe='')}/_batch={quote(str(batch), safe='')}")


def replace_periods(df: DataFrame, path: str, column: str, periods: Sequence) -> None:
    """Put ``df`` in place of exactly the listed periods of a table partitioned by ``column``.

    Periods are compared as the text that names their folder, whatever the column's type; an empty text names none and raises.
    No listed period: nothing happens. A row of another period raises before the table is touched. A listed
    period without a row ends up empty; it goes after the new rows are in place. Columns or types that aren't the
    table's raise before anything is written. The rows are made and written once, by period beside the table, whose folders
    they then replace: the driver plans and keeps one query a replacement.
    """
    if not periods:
        return
    spark, asked = df.sparkSession, {str(p) for p in periods}
    if "" in asked:
        raise ValueError("an empty period names no folder")
    if exists(spark, path):
        have, new = ({f.name: f.dataType for f in x.schema if f.name != column} for x in (spark.read.parquet(path), df))
        if have and have != new:
            raise ValueError(f"schema differs from the table's: {new} against {have}")
    path = path.rstrip("/")
    fs, at = _fs(spark, path)
    try:
        df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(f"{path}.batch")
        filled = _folders(spark, f"{path}.batch", column)
        if filled.keys() - asked:
            batch = spark.read.schema(df.schema).parquet(f"{path}.batch")
            stray = batch.filter(~F.coalesce(F.col(column).cast("string").isin(*asked), F.lit(False))).first()
            raise ValueError(f"a row lies outside the replaced periods: {stray.asDict()}")
        fs.mkdirs(at)
        for own in filled.values():
            _moved(fs, own, _fs(spark, f"{path}/{own.getName()}")[1])
    finally:
        fs.delete(_fs(spark, f"{path}.batch")[1], True)
    for value, own in _folders(spark, path, column).items():
        if value in asked - filled.keys():
            fs.delete(own, True)


def upsert_actions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both tables' rows by key with ``action``: insert, update (some attribute differs), or keep; nothing is deleted.

    Null keys are keys like any other. A column that only the old table has keeps its values, one that
    only the new one has is null in rows that aren't updated.
    """
    names = [c for c in new.columns if c not in keys]
    others = [c for c in old.columns if c not in keys and c not in names]
    kinds = {f.name: f.dataType for f in new.schema}
    before = [F.col(n) if n in old.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names]
    left = old.select(*(F.col(k).alias(f"_old_{k}") for k in keys), F.struct(*before, F.lit(True).alias("_row")).alias("_old"), F.struct(*others, F.lit(True).alias("_row")).alias("_rest"), F.lit(True).alias("_had"))
    right = new.select(*(F.col(k).alias(f"_new_{k}") for k in keys), F.struct(*names, F.lit(True).alias("_row")).alias("_new"), F.lit(True).alias("_has"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}"))
    rows = left.join(right, on, "full_outer")
    action = F.when(F.col("_had").isNull(), "insert").when(F.col("_has").isNotNull() & differs(F.col("_old"), F.col("_new")), "update").otherwise("keep")
    values = [F.when(F.col("_has").isNotNull(), F.col("_new")[n]).otherwise(F.col("_old")[n]).alias(n) for n in names]
    return rows.select(*(F.coalesce(f"_new_{k}", f"_old_{k}").alias(k) for k in keys), *values, *(F.col("_rest")[n].alias(n) for n in others), action.alias("action"))


#: Buckets of a new table, and the start of the name of the column that says how many it has.
BUCKETS, BUCKET = 64, "_bucket_of_"


def _bucketed(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.withColumn(f"{BUCKET}{n}", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))


def _bucket_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if c.startswith(BUCKET)), None)


def upserted(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``upsert`` keeps, without its bucket column; a column that came later is null in older rows."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    bucket = _bucket_column(rows)
    return rows.drop(bucket) if bucket else rows


def _applied(spark: SparkSession, path: str, schema=None) -> dict[str, int]:
    """Replace those buckets of a table whose staged rows have a change, then forget the stage."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    staged = reader.parquet(f"{path}.staged")
    bucket = _bucket_column(staged)
    counted = staged.groupBy(bucket, "action").count().collect()  # three a bucket at most
    changed = sorted({r[bucket] for r in counted if r["action"] != "keep"})
    if changed:
        staged.filter(F.col(bucket).isin(changed)).drop("action").hint("rebalance", F.col(bucket)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)
    fs, at = _fs(spark, f"{path}.staged")
    fs.delete(at, True)
    return {a: sum(r["count"] for r in counted if r["action"] == a) for a in ("insert", "update")}


def upsert(new: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> dict[str, int]:
    """Apply ``upsert_actions`` to a table and count them. Unchanged input writes nothing; a first load must have rows.

    The table is partitioned by a hash of the key, in ``buckets`` when it is made. Only the buckets of the batch's keys are
    read, merged once into a stage beside the table, and only those with an insert or update are replaced; files of others
    stay as they are. The batch is written beside the table first, by bucket, so that costly rows are made once; a new table is
    that batch, moved into its place. A stage that is whole is applied again by the next call if a run ended before it was forgotten. A key
    that the batch holds twice raises. Read the table by ``upserted``.
    """
    spark, path = new.sparkSession, path.rstrip("/")
    fs, stage = _fs(spark, f"{path}.staged")
    if fs.exists(stage):
        _applied(spark, path) if exists(spark, f"{path}.staged/_SUCCESS") else fs.delete(stage, True)
    table, n = None, buckets
    if exists(spark, path):
        table = spark.read.option("mergeSchema", True).parquet(path)
        bucket = _bucket_column(table)
        if bucket is None:
            raise ValueError(f"no bucket column in {path}: not a table that upsert made")
        n, kinds = int(bucket.removeprefix(BUCKET)), dict(table.dtypes)
        new = new.withColumns({k: F.col(k).cast(kinds[k]) for k in keys})
    bucket = f"{BUCKET}{n}"
    new = _bucketed(new, keys, n)
    try:
        new.hint("rebalance", F.col(bucket)).write.mode("overwrite").partitionBy(bucket).parquet(f"{path}.batch")  # what the batch is made from is read once
        batch = spark.read.schema(new.schema).parquet(f"{path}.batch")
        counted = batch.groupBy(*keys).count()
        total = counted.agg(F.sum("count").alias("rows"), F.count_if(F.col("count") > 1).alias("repeated")).first()
        if total["repeated"]:
            repeated = counted.filter("count > 1").limit(3).collect()
            raise ValueError(f"keys repeated in the batch: {[r.asDict() for r in repeated]}")
        met = sorted(int(b) for b in _folders(spark, f"{path}.batch", bucket))  # as many as there are buckets
        if table is None:
            if not met:
                raise ValueError("a table can't be created from an empty batch")
            _moved(fs, _fs(spark, f"{path}.batch")[1], _fs(spark, path)[1])
            return {"insert": total["rows"], "update": 0}
        if not met:
            return {"insert": 0, "update": 0}
        merged = _bucketed(upsert_actions(table.filter(F.col(bucket).isin(met)).drop(bucket), batch.drop(bucket), keys), keys, n)
        merged.hint("rebalance", F.col(bucket)).write.partitionBy(bucket).parquet(f"{path}.staged")
        return _applied(spark, path, merged.schema)
    finally:
        _fs(spark, path)[0].delete(_fs(spark, f"{path}.batch")[1], True)


def kept(df: DataFrame, path: str) -> DataFrame:
    """Rows written once, for all their readers; the next run's take their place."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot(df: DataFrame, path: str) -> dict[str, int]:
    """One file of a small, finished table, and its rows and bytes."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length")).first()[0]
    return {"rows": spark.read.parquet(path).count(), "bytes": int(size or 0)}


class RunLog:
    """Metrics of a run, one record a step; a step is recorded once, zeros included."""

    def __init__(self, prefix: str = "", steps: dict[str, dict[str, int]] | None = None) -> None:
        self.prefix, self.steps = prefix, {} if steps is None else steps

    def part(self, prefix: str) -> RunLog:
        """The same record for one part of a run, whose steps begin with ``prefix``."""
        return RunLog(self.prefix + prefix, self.steps)

    def note(self, step: str, **metrics: int) -> None:
        step = self.prefix + step
        if step in self.steps:
            raise ValueError(f"step recorded twice: {step}")
        self.steps[step] = metrics

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(s, m, int(v)) for s, ms in self.steps.items() for m, v in ms.items()]
        return spark.createDataFrame(rows, "step string, metric string, value long")


class Store:
    """Tables of the three layers as Parquet folders below one path."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return upserted(self.spark, self.path(layer, table))

    def has(self, layer: str, table: str) -> bool:
        return exists(self.spark, self.path(layer, table))

    def kept(self, layer: str, table: str, rows: DataFrame) -> DataFrame:
        return kept(rows, self.path(layer, table))
