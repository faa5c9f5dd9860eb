"""Registered queries of whole landings: files that Spark writes from the tables, read back through manifests, codecs, streams and layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import periods
from plumbline.functions.keys import key
from plumbline.plans import bindings as B
from plumbline.plans import layers
from plumbline.plans.queries import registered
from plumbline.sources import files, landing, sinks
from plumbline.streaming.landing import stream_landing

MANIFEST = "file string, period string, attempt long, sha256 string, rows long"


def manifest_of(spark: SparkSession, folder: str, by: str, attempt: int) -> DataFrame:
    """Manifest rows of the Parquet files below ``folder``, which is partitioned by ``by``: each named from that partition on."""
    rows = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count("*").alias("rows"))
    name = F.array_join(F.slice(F.split("path", "/"), -2, 2), "/")
    told = files.listed(spark, f"{folder}/{by}=*/*.parquet").join(rows, "uri")
    return told.select(name.alias("file"), F.regexp_extract("path", f"{by}=([^/]+)/", 1).alias("period"), F.lit(attempt).cast("long").alias("attempt"), F.sha2(name, 256).alias("sha256"), "rows")


# ---- manifests, appends, streams


@registered("select cast(year(o_orderdate) as varchar) as period, 1::bigint as attempt, count(*) as orders, cast(sum(o_orderkey) as bigint) as keys, 1::bigint as runs, 1::bigint as has_lineage from orders group by 1")
def landed_batches(spark, sf_dir):
    """A manifest of JSON lines with blank ones between them, its files landed with their own lineage and appended in two runs."""
    path = B.scratch(spark, "landed")
    orders = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), F.year("o_orderdate").alias("year"))
    orders.write.partitionBy("year").parquet(f"{path}/files")
    manifest_of(spark, f"{path}/files", "year", 1).select(F.concat(F.to_json(F.struct("file", "period", "attempt", "sha256", "rows")), F.lit("\n")).alias("line")).write.text(f"{path}/manifest")
    known = landing.manifest(spark, f"{path}/manifest", MANIFEST)
    listed = [(r.path, r.path.split("year=")[1][:4]) for r in files.listed(spark, f"{path}/files/year=*/*.parquet").select("path").collect()]  # one row a file
    for run, own in (("r1", lambda year: year < "1995"), ("r2", lambda year: year >= "1995")):
        wanted = [p for p, year in listed if own(year)]
        if wanted:
            rows = landing.parquet_landing(spark, wanted, known)
            sinks.append(landing.audited(rows, run, {"_attempt": "bigint"}), f"{path}/lake/bronze/orders")
    table = sinks.Store(spark, f"{path}/lake").read("bronze", "orders")
    own = F.coalesce(F.min((F.length("_sha256") == 64).cast("long")), F.lit(0).cast("long"))
    return table.groupBy(F.col("_period").alias("period"), F.col("_attempt").alias("attempt")).agg(F.count("*").alias("orders"), F.sum(F.col("o_orderkey").cast("long")).alias("keys"), F.count_distinct("_run_id").alias("runs"), own.alias("has_lineage"))


@registered("select o_orderkey, o_custkey, o_orderstatus from orders")
def streamed_batches(spark, sf_dir):
    """Files that come in two waves and are landed by a stream run three times: each file's rows once."""
    path = B.scratch(spark, "stream")
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    schema = ", ".join(f"{n} {t}" for n, t in orders.dtypes)
    for wave in (0, 1, None):
        if wave is not None:
            orders.filter(F.col("o_orderkey") % 2 == wave).write.mode("append").parquet(f"{path}/source")
        stream_landing(spark, f"{path}/source", schema, f"{path}/table", f"{path}/checkpoint", "r").awaitTermination()
    return spark.read.parquet(f"{path}/table").select(orders.columns)


# ---- text, code pages, nested JSON


@registered("select cast(c_custkey as varchar) c_custkey, case when c_custkey%3=0 then '' else c_mktsegment end as segment, case when c_custkey%5=0 then 'says \"a, b\"'||chr(10)||'and c' else '' end as remark from customer")
def landed_text(spark, sf_dir):
    """CSV as text: nulls and empty cells come as empty text, quotes, commas and line feeds stay."""
    path = B.scratch(spark, "text")
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    remark = F.when(F.col("c_custkey") % 5 == 0, 'says "a, b"\nand c').otherwise("")
    B.table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"), remark.alias("remark")).write.option("header", True).option("escape", '"').csv(path)
    return landing.csv_landing(spark, path, ["c_custkey", "segment", "remark"])


@registered("select cast(c_custkey as varchar) c_custkey, 'Peña “'||cast(c_custkey as varchar)||'” 5€' as name, case c_custkey%2 when 0 then 'utf-8' else 'cp1252' end as encoding from customer")
def landed_codepages(spark, sf_dir):
    """Files of two encodings in one landing, told apart by their bytes; each value says the same."""
    path = B.scratch(spark, "codepages")
    name = F.concat(F.lit("Peña “"), F.col("c_custkey").cast("string"), F.lit("” 5€"))
    rows = B.table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))
    rows.filter("c_custkey % 2 = 0").write.option("header", True).csv(f"{path}/a")
    page = rows.filter("c_custkey % 2 = 1").withColumn("name", F.translate("name", landing.CP1252, landing.CP1252_BYTES))
    page.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/b")
    return landing.checked_csv(spark, [f"{path}/*/*.csv"], ["c_custkey", "name"])


@registered("select cast(c_custkey as varchar) c_custkey, case when c_custkey%7=1 then '' else c_name end as c_name, c_custkey%7 in (1,2) as misfit from customer")
def misfit_records(spark, sf_dir):
    """Records with a field too few or too many, told from whole ones and kept with the fields they have."""
    path = B.scratch(spark, "misfits")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 7 != 1, F.col("c_name")), F.when(F.col("c_custkey") % 7 == 2, F.lit("one more")))
    B.table(spark, sf_dir, "customer").select(line.alias("c_custkey,c_name")).write.option("header", True).option("sep", "|").csv(path)
    rows = landing.checked_csv(spark, [f"{path}/*.csv"], ["c_custkey", "c_name"], misfits=True)
    return rows.select("c_custkey", "c_name", F.col(landing.MISFIT).alias("misfit"))


@registered("select strftime(o_orderdate, '%Y/%m')||'/01' as period, cast(count(*) as varchar) as value, '15' as freq, '1051' as unit from orders group by 1")
def nested_series(spark, sf_dir):
    """A file of nested series a year, whose second series doesn't count; one row an observation."""
    path = B.scratch(spark, "series")
    month = F.concat(F.date_format("o_orderdate", "yyyy/MM"), F.lit("/01"))
    seen = B.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), month.alias("TIME_PERIOD")).agg(F.count("*").cast("string").alias("OBS_VALUE"))
    years = seen.groupBy("year").agg(F.collect_list(F.struct("TIME_PERIOD", "OBS_VALUE")).alias("OBSERVATIONS"))  # twelve a year at most
    one = lambda freq: F.struct(F.lit(freq).alias("FREQ"), F.lit("1051").alias("UNIT"), "OBSERVATIONS")
    whole = years.select("year", F.to_json(F.struct(F.array(one("15"), one("16")).alias("Series"))).alias("json"))
    whole.repartition("year").write.partitionBy("year").text(path)
    return landing.json_series(spark, f"{path}/year=*")


# ---- snapshot, record of a run, keys


@registered("select n_nationkey, n_name, (select count(*) from nation) as rows, 1 as files from nation")
def exported_snapshot(spark, sf_dir):
    """A small table exported twice to one file of one place, with the rows it was said to have."""
    path = B.scratch(spark, "snapshot")
    nations = B.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.snapshot(nations.limit(3), path)
    told = sinks.snapshot(nations, path)
    held = spark.read.parquet(path)
    return held.select("n_nationkey", "n_name", F.lit(told["rows"]).cast("long").alias("rows"), F.lit(len(held.inputFiles())).alias("files"))


@registered("select 'landing' step, 'orders' metric, count(*) as value from orders union all select 'landing', 'rejected', 0 union all select 'index', 'items', count(distinct p_brand) from part")
def run_record(spark, sf_dir):
    """One record a step of a run, zeros included."""
    log = sinks.RunLog()
    orders = B.table(spark, sf_dir, "orders")
    log.note("landing", orders=orders.count(), rejected=orders.filter("o_orderkey is null").count())
    log.note("index", items=B.table(spark, sf_dir, "part").select("p_brand").distinct().count())
    return log.frame(spark)


@registered("select p_brand, p_type, count(*) as pieces, count(distinct p_size) as sizes from part join lineitem on l_partkey=p_partkey group by 1,2")
def keyed_star(spark, sf_dir):
    """Facts that hold a surrogate key only, met with the dimension by it; a key that stood for two members would show in the counts."""
    part = B.table(spark, sf_dir, "part").withColumn("item_id", key("p_brand", "p_type"))
    dim = part.select("item_id", "p_brand", "p_type").distinct()
    facts = B.table(spark, sf_dir, "lineitem").join(part.select("p_partkey", "item_id", "p_size"), F.col("l_partkey") == F.col("p_partkey")).select("item_id", "p_size")
    counted = facts.groupBy("item_id").agg(F.count("*").alias("pieces"), F.count_distinct("p_size").alias("sizes"))
    return counted.join(dim, "item_id").select("p_brand", "p_type", "pieces", "sizes")


# ---- the layers


SPEC = layers.FeedSpec(outlet=("shop",), outlet_attributes=("chain", "state"), item=("sku",), item_attributes=("maker",), price="price", words={"otlet": "outlet"}, excluded=("gone",))

#: Half-years of shipment as consecutive periods of one calendar, the first half of 1992 being 2000-01_q1.
HALVES = "select l_suppkey outlet, p_brand sku, cast(48000+(year(l_shipdate)-1992)*2+(month(l_shipdate)>6)::int as int) ord, cast(l_extendedprice as decimal(10,2)) price from lineitem join part on p_partkey=l_partkey"
HALF_LABEL = "lpad(cast(ord//24 as varchar),4,'0')||'-'||lpad(cast(ord%24//2+1 as varchar),2,'0')||'_q'||cast(ord%2+1 as varchar)"


@registered(f", h as ({HALVES}), c as (select outlet, sku, ord, avg(price) price, count(*) observations, min(price) price_min, max(price) price_max from h group by 1,2,3) select 'outlet '||cast(outlet as varchar) as shop, 'chain '||cast(chain as varchar) as chain, state, sku, substr(sku,7,1) as maker, {HALF_LABEL} as label, cast(cast(price as decimal(10,4)) as double) price, observations, cast(price_min as double) price_min, cast(price_max as double) price_max from c join outs using (outlet)", "outs")
def gold_star(spark, sf_dir):
    """The whole way of a feed: landed text by period, gated cells, the star; then every third period corrected by a second attempt."""
    path, log = B.scratch(spark, "layers"), sinks.RunLog()
    outlets = B.outlets(spark, sf_dir).select("outlet", F.concat(F.lit("chain "), "chain").alias("chain"), "state")
    half = (48000 + (F.year("l_shipdate") - 1992) * 2 + (F.month("l_shipdate") > 6).cast("int")).cast("int")
    lines = B.table(spark, sf_dir, "lineitem").join(B.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("ord", half)
    feed = lines.join(outlets, F.col("l_suppkey") == F.col("outlet"))
    said = F.concat(F.when(F.col("outlet") % 4 == 0, "otlet ").otherwise("outlet "), F.col("outlet").cast("string"))
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    rows = feed.select(said.alias("shop"), "chain", "state", F.col("p_brand").alias("sku"), F.substring("p_brand", 7, 1).alias("maker"), price.alias("price"), periods.label_of_ordinal(F.col("ord")).alias("period"), "ord")
    late = F.col("ord") % 3 == 1
    one = lambda attempt, value: F.struct(F.lit(attempt).alias("attempt"), value.cast("string").alias("price"))
    price = F.col("price")
    attempts = F.when(late, F.array(one(1, price * 2), one(2, price))).otherwise(F.array(one(1, price)))
    files_of = rows.withColumn("told", F.explode(attempts)).withColumns({"price": F.col("told.price"), "attempt": F.col("told.attempt")}).drop("told", "ord")
    files_of.repartition("attempt", "period").write.partitionBy("attempt", "period").parquet(f"{path}/files")
    store, paths = sinks.Store(spark, f"{path}/lake"), []
    for attempt in (1, 2):
        own = manifest_of(spark, f"{path}/files/attempt={attempt}", "period", attempt).withColumn("file", F.concat(F.lit(f"attempt={attempt}/"), "file"))
        own.coalesce(1).write.mode("append").json(f"{path}/manifest")  # one row a file
        told = landing.manifest(spark, f"{path}/manifest", MANIFEST)
        paths += [r.path for r in files.listed(spark, f"{path}/files/attempt={attempt}/period=*/*.parquet").select("path").collect()]  # one row a file
        layers.run_bronze(store, "prices", paths, told, f"r{attempt}", log.part(f"{attempt}."))
        labels = layers.run_silver(store, "prices", SPEC, "", log.part(f"{attempt}."))
        layers.run_gold(store, labels, 20, log.part(f"{attempt}."), ["item", "chain", "state"])
    shops = store.read("gold", "outlets").select("outlet", "shop", "chain", "state")
    items, calendar = store.read("gold", "items").select("item", "sku", "maker"), store.read("gold", "calendar").select("period_id", "label")
    star = store.read("gold", "prices").drop("label").join(shops, "outlet").join(items, "item").join(calendar, "period_id")
    numbers = [F.col(c).cast("double").alias(c) for c in ("price", "price_min", "price_max")]
    return star.select("shop", "chain", "state", "sku", "maker", "label", "observations", *numbers)
