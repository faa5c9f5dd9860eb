"""Landing scans: manifests, Parquet, CSV and JSON feeds, all text, with lineage."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources.files import described

# What the bytes 0x80 to 0x9F mean in code page 1252; five of them mean nothing.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
CP1252_UNDEFINED = "\x81\x8d\x8f\x90\x9d"
_CP1252_GAP = r"[\x{0081}\x{008D}\x{008F}\x{0090}\x{009D}]"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column as text: nothing is inferred, so nothing is cast."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def exists(spark: SparkSession, path: str) -> bool:
    """True if a path exists in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def manifest(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of a JSON-lines manifest; blank lines are passed over and a missing file is an empty state."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json(path)
    return rows.dropna(how="all")


def endings(path: str) -> set[str]:
    """What a manifest may call a file: its path, or the end of it from some folder on."""
    parts = path.lstrip("/").split("/")
    return {"/".join(parts[i:]) for i in range(len(parts))}


#: Files up to which their lineage is sent to every task; that of more is met by a shuffle.
SENT = 10_000


def parquet_landing(spark: SparkSession, paths: Sequence[str], manifest: DataFrame, file: str = "file", lineage: Sequence[str] = ("period", "attempt", "sha256")) -> DataFrame:
    """Landed Parquet files with the manifest's lineage columns, each file finding its own row of the manifest.

    The manifest names a file by its whole path or by the end of it, from some folder on. A file that no row names, or that
    more than one names, raises, as does a name that fits two of the files: no row goes without its lineage, and none
    with another's. Files and names meet once, and give the driver, which holds the list of files, one small row a file.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("_uri"), "path")
    known = manifest.select(F.col(file).alias("_name"), *(F.col(c).alias(f"_{c}") for c in lineage))
    tail = lambda c: F.element_at(F.split(c, "/"), -1)
    ends = (F.col("path") == F.col("_name")) | F.col("path").endswith(F.concat(F.lit("/"), F.regexp_replace("_name", "^/+", "")))
    met = files.join(known, (tail(F.col("path")) == tail(F.col("_name"))) & ends, "left").select("_uri", "path", "_name", *(f"_{c}" for c in lineage))
    own = met.collect()
    named: dict[str, set[str]] = {}
    for r in own:
        if r["_name"] is not None:
            named.setdefault(r["_name"], set()).add(r["_uri"])
    rows = Counter((r["_uri"], r["path"]) for r in own)
    unnamed = {(r["_uri"], r["path"]): 0 for r in own if r["_name"] is None}
    counted = [(path, unnamed.get((uri, path), n)) for (uri, path), n in rows.items()]
    for wrong, what in (([x for x in counted if x[1] != 1], "files with no row of the manifest, or several"), ([(x, len(u)) for x, u in named.items() if len(u) > 1], "names that fit several files")):
        if wrong:
            raise ValueError(f"{what}: {', '.join(f'{x} ({n})' for x, n in sorted(wrong)[:3])}")
    told = spark.createDataFrame(own, met.schema).select("_uri", *(f"_{c}" for c in lineage))
    return spark.read.parquet(*paths).withColumn("_uri", F.col("_metadata.file_path")).join(F.broadcast(told) if len(own) <= SENT else told, "_uri").drop("_uri")


def csv_landing(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV as text with an empty cell as empty text, not null."""
    rows = spark.read.schema(text_schema(columns)).option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').csv(paths if isinstance(paths, str) else list(paths))
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


def json_series(spark: SparkSession, path: str | Sequence[str], names: dict[str, str] | None = None) -> DataFrame:
    """One row per observation of nested series JSON: period, value, freq, unit, all text.

    ``names`` says what a feed calls the list of series, its frequency, unit and observations, and an observation's period and
    value; defaults are those of the CPI feed. Only the first series counts; none, or none observed, gives no row.
    """
    call = {"series": "Series", "freq": "FREQ", "unit": "UNIT", "observations": "OBSERVATIONS", "period": "TIME_PERIOD", "value": "OBS_VALUE"} | (names or {})
    schema = "`{series}` array<struct<`{freq}` string, `{unit}` string, `{observations}` array<struct<`{period}` string, `{value}` string>>>>".format(**call)
    rows = spark.read.schema(schema).option("multiLine", True).json(path if isinstance(path, str) else list(path))
    first = rows.select(F.get(call["series"], F.lit(0)).alias("s")).filter("s is not null")
    seen = first.select(F.col("s")[call["freq"]].alias("freq"), F.col("s")[call["unit"]].alias("unit"), F.explode(F.col("s")[call["observations"]]).alias("o"))
    return seen.select(F.col("o")[call["period"]].alias("period"), F.col("o")[call["value"]].alias("value"), "freq", "unit")


def encodings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, encoding, header)`` per file of any size: utf-8 if the whole file is, else cp1252 if every byte means something there, else null; header: the first line's bytes."""
    return described(spark, paths, _CP1252_GAP)


def from_cp1252(column: str):
    """Text that was read as latin-1, its C1 characters as code page 1252 means them."""
    return F.translate(column, CP1252_BYTES, CP1252)


MISFIT = "_misfit"


def checked_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], misfits: bool = False) -> DataFrame:
    """The named columns of CSV files, each file read as what it is encoded in, with an ``encoding`` column.

    Columns are found by each file's own header, wherever they stand; others are dropped and a missing
    one raises. Quoted values may hold line feeds, a header's may not; byte-order marks and CRLF are absorbed. The driver
    sees one small row per file, and files of one encoding and header are read together. A file that
    is neither utf-8 nor cp1252 raises. A record with too few or too many fields raises when it is read; with ``misfits`` it
    comes with the fields it has, and the column ``_misfit`` tells it, so that a gate can count such records.
    """
    kinds: dict[tuple[str, bytes], list[str]] = {}
    for r in encodings(spark, paths).collect():
        if r.encoding is None:
            raise ValueError(f"neither utf-8 nor cp1252: {r.path}")
        kinds.setdefault((r.encoding, bytes(r.header)), []).append(r.path)
    out = None
    for (name, raw), own in sorted(kinds.items()):
        header = next(csv.reader([raw.decode("utf-8-sig" if name == "utf-8" else name)]), [])
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"columns missing from {own[0]}: {missing}")
        places = [f"c{i}" for i in range(len(header))]
        rows = spark.read.schema(text_schema([*places, MISFIT])).option("header", True).option("encoding", "UTF-8" if name == "utf-8" else "ISO-8859-1").option("multiLine", True).option("escape", '"').option("columnNameOfCorruptRecord", MISFIT).csv(own)
        value = from_cp1252 if name == "cp1252" else F.col
        bad = F.col(MISFIT).isNotNull()
        told = bad if misfits else F.when(bad, F.raise_error(F.concat(F.lit("fields too few or too many: "), F.left(F.col(MISFIT), F.lit(200))))).otherwise(False)
        tidy = [F.regexp_replace(F.coalesce(value(places[header.index(c)]), F.lit("")), "\r$", "").alias(c) for c in columns]
        part = rows.select(*tidy, F.lit(name).alias("encoding"), told.cast("boolean").alias(MISFIT))
        part = part if misfits else part.filter(~F.col(MISFIT)).drop(MISFIT)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], text_schema([*columns, "encoding"]))


def cut(df: DataFrame, contract: Sequence[str], category: str, wanted: Sequence[str]) -> DataFrame:
    """Rows of the wanted categories with the declared columns: others are dropped, a missing one raises."""
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the feed: {missing}")
    return df.filter(F.col(category).isin(*wanted)).select(*contract)


def distinct_entities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct tuples of the full feed, so that a cut of rows doesn't bias the dimension."""
    return df.select(*columns).distinct()


def ordered(df: DataFrame) -> DataFrame:
    """Rows in an order that depends on their values alone."""
    return df.orderBy(*df.columns)


def placed(df: DataFrame, name: str = "place") -> DataFrame:
    """An ordered table with each row's place, from 0: rows are numbered in their task, and tasks by one small row each."""
    ids = F.monotonically_increasing_id()
    rows = df.withColumn("_id", ids).withColumn("_task", F.shiftright("_id", 33)).withColumn("_inner", F.col("_id") - F.shiftleft("_task", 33))
    sizes = rows.groupBy("_task").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(sizes.select("_task", before.alias("_before"))), "_task").select((F.col("_inner") + F.col("_before")).alias(name), *df.columns)


def audited(df: DataFrame, run_id: str, lineage: dict[str, str] | None = None) -> DataFrame:
    """Typed lineage columns and the load's time and run."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in (lineage or {}).items()}).withColumns({"_ingest_ts": F.current_timestamp(), "_run_id": F.lit(run_id)})
