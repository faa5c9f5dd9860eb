"""The sample star schema seen as a panel, and the same views as SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import periods
from plumbline.operators import panel as P

SPEC = P.PanelSpec(outlet=("l_suppkey",), item=("p_brand",), price="l_extendedprice", attempt="l_linenumber")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("ord", periods.ordinal_of_date(F.col("l_shipdate")))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = lines(spark, sf_dir).join(items, F.col("l_partkey") == F.col("p_partkey"))
    return SPEC.of(rows.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(10,2)")))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cells(feed(spark, sf_dir))


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    rows = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(F.col("s_suppkey").alias("outlet"), (F.col("s_suppkey") % 10).alias("chain"), F.col("n_name").alias("municipality"), F.col("r_name").alias("state"))


CHANNELS = {"AMERICA": "a", "EUROPE": "b", "ASIA": "b"}


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(month, wage)``: months counted from year 0."""
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy((F.year(date) * 12 + F.month(date) - 1).alias("month")).agg(F.avg("o_totalprice").alias("wage"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).groupBy("ord").agg(F.avg("l_quantity").alias("deflator"))
    return rows.withColumns({"label": periods.label_of_ordinal(F.col("ord")), "month": F.floor(F.col("ord") / 2).cast("int")})


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; a local session without one uses a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows that a query reads several times, made once."""
    path = scratch(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


ORD = "cast(year({0})*24+(month({0})-1)*2+case when day({0})>15 then 1 else 0 end as int)"
SQL = {
    "lines": f"select *, {ORD.format('l_shipdate')} ord from lineitem",
    "panel": "select l_suppkey outlet, p_brand item, ord, cast(l_extendedprice as decimal(10,2)) price, cast(l_linenumber as bigint) attempt from lines join part on p_partkey=l_partkey",
    "cells": "select outlet, item, ord, cast(avg(price) as decimal(10,4)) price, count(price) observations, min(price) price_min, max(price) price_max, max(attempt) attempt from panel group by 1,2,3",
    "links": "select a.outlet, a.item, a.ord, ln(cast(a.price as double)/cast(z.price as double)) log_rel from cells a join cells z on a.outlet=z.outlet and a.item=z.item and a.ord=z.ord+1",
    "outs": "select s_suppkey outlet, s_suppkey % 10 chain, n_name municipality, r_name state from supplier left join nation on n_nationkey=s_nationkey left join region on r_regionkey=n_regionkey",
    "wages": "select cast(year(o_orderdate)*12+month(o_orderdate)-1 as int) as month, avg(o_totalprice) wage from orders group by 1",
    "cal": "select ord, avg(l_quantity) deflator, cast(floor(ord/2) as int) as month, lpad(cast(cast(floor(ord/24) as int) as varchar),4,'0')||'-'||lpad(cast(cast(floor((ord%24)/2) as int)+1 as varchar),2,'0')||'_q'||cast(ord%2+1 as varchar) label from lines group by 1",
}
NEEDS = {"panel": ["lines"], "cells": ["panel"], "links": ["cells"], "cal": ["lines"]}


def with_views(names: str, query: str) -> str:
    """``query`` after the named views and those they are made from."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in order) + ("" if query.lstrip().startswith(",") else "\n") + query
