"""Further registered queries: periods, dimensions, evidence of gates, and tables written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import numbers, periods, text
from plumbline.operators import dims, gates, levels
from plumbline.plans import bindings as B
from plumbline.plans.queries import registered, rounded
from plumbline.sources import landing, sinks

# ---- periods

MONTHS = "select distinct cast(date_trunc('month', o_orderdate) as date) m from orders"


@registered("select strftime(x.m, '%Y-%m')||h.half as label from (select unnest(generate_series((select min(m) from d), (select max(m) from d), interval 1 month)) m from (select 1)) x, (values ('_q1'), ('_q2')) h(half)".replace("select strftime", f"with d as ({MONTHS}) select strftime", 1))
def period_enumeration(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyy-MM")
    first, last = B.table(spark, sf_dir, "orders").agg(F.min(month), F.max(month)).first()
    return periods.between(spark, first, last)


@registered("select strftime(o_orderdate, '%Y-%m')||case when day(o_orderdate)>15 then '_q2' else '_q1' end as label, count(*) n from orders group by 1")
def date_labels(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").groupBy(periods.label_of(F.col("o_orderdate")).alias("label")).agg(F.count("*").alias("n"))


CPI_TEXT = "strftime(o_orderdate, '%Y/%m')||'/0'||cast(o_custkey%4 as varchar)"


@registered(f"select {CPI_TEXT} as period, case when o_custkey%4 in (1,2) then strftime(o_orderdate, '%Y-%m')||'_q'||cast(o_custkey%4 as varchar) end as label, count(*) n from orders group by 1,2")
def cpi_labels(spark, sf_dir):
    """Halves 0 and 3 don't exist: their label is null."""
    period = F.concat(F.date_format("o_orderdate", "yyyy/MM"), F.lit("/0"), (F.col("o_custkey") % 4).cast("string"))
    rows = B.table(spark, sf_dir, "orders").select(period.alias("period"))
    return rows.groupBy("period", periods.label_of_cpi(F.col("period")).alias("label")).agg(F.count("*").alias("n"))


@registered(f"select {CPI_TEXT} as period from orders where o_custkey%4 not in (1,2) group by 1")
def gate_malformed_periods(spark, sf_dir):
    period = F.concat(F.date_format("o_orderdate", "yyyy/MM"), F.lit("/0"), (F.col("o_custkey") % 4).cast("string"))
    return gates.malformed(B.table(spark, sf_dir, "orders").select(period.alias("period")), "period", periods.CPI_PATTERN)


@registered("select make_date(cast(year(o_orderdate) as int), cast(month(o_orderdate) as int), 1) as month_start, count(*) n from orders group by 1")
def month_dates(spark, sf_dir):
    start = periods.month_start(F.year("o_orderdate"), F.month("o_orderdate"))
    return B.table(spark, sf_dir, "orders").groupBy(start.alias("month_start")).agg(F.count("*").alias("n"))


@registered("select o_custkey, cast(min(o_orderkey) as varchar)||'.00% a +'||cast(max(o_orderkey) as varchar)||'.00%' as text from orders group by 1".replace("cast(min", "'+'||cast(min", 1))
def interval_texts(spark, sf_dir):
    ends = B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    return ends.select("o_custkey", numbers.interval_text(F.col("low") + 100.0, F.col("high") + 100.0).alias("text"))


# ---- dimensions

@registered("select cast(date_trunc('month', o_orderdate) as date) month_start, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(year(o_orderdate)*12+month(o_orderdate)-1 as int) month_number from orders group by all")
def month_calendar(spark, sf_dir):
    return dims.months(B.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))).drop("month_id")


@registered("select outlet, municipality, state, concat_ws(', ', municipality, state) map_key from outs", "outs")
def outlet_map_key(spark, sf_dir):
    """Outlet dimension: one row per outlet with the text by which a map finds it."""
    dim = dims.outlets(B.outlets(spark, sf_dir), ["outlet"], ["municipality", "state"])
    return dims.map_key(dim, ["municipality", "state"]).drop("outlet_id")


@registered("select p_brand, max(p_type) p_type, max(p_size) p_size from part group by 1")
def collapsed_items(spark, sf_dir):
    return dims.collapse(B.table(spark, sf_dir, "part"), ["p_brand"], ["p_type", "p_size"], "item_id").drop("item_id")


@registered("select p_partkey, p_brand from part where p_partkey in (select l_partkey from lineitem where l_extendedprice > 50000)")
def reachable_items(spark, sf_dir):
    priced = B.table(spark, sf_dir, "lineitem").filter("l_extendedprice > 50000").select(F.col("l_partkey").alias("p_partkey"))
    return gates.reachable(B.table(spark, sf_dir, "part").select("p_partkey", "p_brand"), priced, "p_partkey")


# ---- gates

@registered("select p_partkey, p_name, p_size from part where p_name in (select p_name from part group by 1 having min(p_size) <> max(p_size))")
def gate_conflicting_rows(spark, sf_dir):
    return gates.conflicting_rows(B.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), ["p_name"], "p_size")


@registered("select o_orderstatus, o_orderpriority from orders where not (o_orderstatus is not distinct from 'F' and o_orderpriority is not distinct from '1-URGENT') group by all")
def gate_other_series(spark, sf_dir):
    return gates.other_series(B.table(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


@registered("select count(distinct (p_brand, p_size)) n from part having count(distinct (p_brand, p_size)) > 20")
def gate_too_many_keys(spark, sf_dir):
    return gates.too_many(B.table(spark, sf_dir, "part"), ["p_brand", "p_size"], 20)


@registered("select a.label from (values ('1992-01_q1'), ('2999-01_q1'), ('2999-01_q2')) a(label) where a.label not in (select label from cal)", "cal")
def gate_unknown_labels(spark, sf_dir):
    return gates.unknown_periods(spark, ["1992-01_q1", "2999-01_q1", "2999-01_q2"], B.calendar(spark, sf_dir))


# ---- wages, texts

@registered(", u as (select ord, wage/p as units from (select ord, avg(cast(price as double)) p from cells group by 1) left join cal using (ord) left join wages using (month)) select round(arg_min_null(units, ord),6) at_opening, round(arg_max_null(units, ord),6) at_close from u", "cells cal wages")
def wage_units_at_ends(spark, sf_dir):
    return rounded(levels.units_at_ends(B.cells(spark, sf_dir), B.calendar(spark, sf_dir), B.months(spark, sf_dir)))


@registered("select c_custkey, case c_mktsegment when 'BUILDING' then 'house' else lower(c_mktsegment) end as segment from customer")
def replaced_values(spark, sf_dir):
    """Whole values of one column replaced after folding and repair."""
    rows = B.table(spark, sf_dir, "customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    return text.canonical(rows, ["segment"], {}, {"segment": {"building": "house"}})


# ---- tables written and read again

@registered("select c_custkey, case when c_custkey%3=0 then c_acctbal+1 else c_acctbal end as balance, case when c_custkey%3=0 then null else c_mktsegment end as segment, case when c_custkey%3=0 then 'new' end as origin from customer")
def upserted_table(spark, sf_dir):
    """A table after an upsert whose batch lacks a column and brings another."""
    path = B.scratch(spark, "upsert")
    old = B.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"))
    sinks.upsert(old, path, ["c_custkey"])
    batch = old.filter("c_custkey % 3 = 0").select("c_custkey", (F.col("balance") + 1).alias("balance"), F.lit("new").alias("origin"))
    sinks.upsert(batch, path, ["c_custkey"])
    return sinks.upserted(spark, path).select("c_custkey", "balance", "segment", "origin")


@registered("select o_orderkey, cast(year(o_orderdate) as int) as year from orders where year(o_orderdate) <> 1995 and (year(o_orderdate) <> 1994 or o_orderkey%2=0)")
def replaced_years(spark, sf_dir):
    """A table partitioned by a whole number, two periods replaced: one by half of its rows, one by none."""
    path = B.scratch(spark, "years")
    rows = B.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    rows.write.partitionBy("year").parquet(path)
    sinks.replace_periods(rows.filter("year = 1994 and o_orderkey % 2 = 0"), path, "year", ["1994", "1995"])
    return spark.read.parquet(path).select("o_orderkey", "year")


@registered("select cast(c_custkey as varchar) c_custkey, c_name, 'utf-8' as encoding from customer")
def landed_csv(spark, sf_dir):
    """Files landed by header: columns in another order than the contract's, and one too many."""
    path = B.scratch(spark, "landing")
    B.table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_custkey").write.option("header", True).csv(path)
    return landing.checked_csv(spark, [f"{path}/*.csv"], ["c_custkey", "c_name"])
