"""Registered queries of the operators that go beyond one plain aggregation: cuts, selectors, read-outs, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import asof, bootstrap, cuts, dims, index, kept_index, levels
from plumbline.operators import panel as P
from plumbline.plans import bindings as B
from plumbline.plans.queries import DRAWN, registered, rounded
from plumbline.sources import files, landing, state

# ---- one scan, many cuts

CHANNEL_SQL = "case state when 'AMERICA' then 'a' when 'EUROPE' then 'b' when 'ASIA' then 'b' end"
CUTS = ["item", "chain", "channel", "state"]
UNPIVOTED = " union all ".join(f"select '{c}' cut, cast({c} as varchar) as value, * from {{t}}" for c in CUTS) + " union all select 'total', null, * from {t}"
CUT_SQL = f""",
lk as (select links.*, chain, state, {CHANNEL_SQL} channel from links join outs using (outlet)), ck as (select cells.*, chain, state, {CHANNEL_SQL} channel from cells left join outs using (outlet)),
lx as ({UNPIVOTED.format(t="lk")}), cx as ({UNPIVOTED.format(t="ck")}),
st as (select cut, value, ord, avg(log_rel) m, count(distinct outlet) n from lx group by all),
g as (select cut, value, c.ord, priced from (select cut, value, max((ord=(select min(ord) from cells))::int) priced from cx group by all) x cross join (select distinct ord from cells) c),
j as (select g.*, m, n from g left join st on st.cut=g.cut and st.value is not distinct from g.value and st.ord=g.ord)
select cut, value, ord, n matched, round(case when ord=(select min(ord) from cells) then case when priced=1 then 100.0 end
  when count(n) over w/sum(1/cast(n as double)) over w >= 8 and min(n) over w >= 2 then exp(sum(m) over w)*100 end, 6) as "index"
from j window w as (partition by cut, value order by ord rows unbounded preceding)"""


@registered(CUT_SQL, "links outs")
def index_by_cuts(spark, sf_dir):
    """The chained index by item, chain, channel and state and in total, from one pass over the links."""
    outlets = B.outlets(spark, sf_dir).withColumn("channel", P.mapped(F.col("state"), B.CHANNELS))
    cells = B.cells(spark, sf_dir)
    numbers = cuts.dense(outlets, ["outlet"], "number")
    made = cuts.chained_indices(P.star(P.links(cells), outlets, "outlet"), P.star(cells, outlets, "outlet"), numbers, CUTS, 8, 2)
    return rounded(made)


@registered(f", ck as (select cells.*, {CHANNEL_SQL} channel from cells left join outs using (outlet)) select channel, item, round(avg(cast(price as double)),6) mean_price, round(median(cast(price as double)),6) median_price, round(quantile_cont(cast(price as double),0.9)/quantile_cont(cast(price as double),0.1),6) p90_p10, count(distinct outlet) outlets from ck where channel is not null group by 1,2 having count(distinct outlet)>=3", "cells outs")
def sliced_levels(spark, sf_dir):
    """Price levels by channel and item: no blank channel, and no group seen in fewer than three outlets."""
    outlets = B.outlets(spark, sf_dir).withColumn("channel", P.mapped(F.col("state"), B.CHANNELS))
    rows = P.members(P.star(B.cells(spark, sf_dir), outlets, "outlet"), ["channel"])
    return rounded(levels.price_levels(rows, ["channel", "item"], 3))


# ---- recalculation, read-outs, landing cuts


@registered("select distinct label from cal where label in ('1996-01_q1', '1997-05_q2', '1998-12_q1')", "cal")
def recalculation_by_list(spark, sf_dir):
    known = B.calendar(spark, sf_dir).select("label")
    return state.selected(" 1997-05_q2, 1996-01_q1,,1998-12_q1 ", known.limit(0), known)


@registered("select distinct label from cal where ord not in (select distinct ord from lines where l_quantity > 45 and ord%7<>3)", "cal lines")
def recalculation_pending(spark, sf_dir):
    """Every seventh period, and others without a line of more than 45 pieces, count as pending: those that the other table doesn't have, by label alone."""
    calendar = B.calendar(spark, sf_dir).select("label", "ord")
    done = B.lines(spark, sf_dir).filter("l_quantity > 45 and ord % 7 <> 3").select("ord").distinct().join(calendar, "ord").select(F.col("label").alias("period"))
    return state.selected("", state.pending(calendar, done, {"label": "period"}), calendar)


@registered(DRAWN + ", p as (select item, count(*)/sum(1/cast(n as double))>=1.2 publish from (select item, ord, count(distinct outlet) n from links group by 1,2) group by 1), z as (select item, 100+arg_max(low, ord) low, 100+arg_max(high, ord) high from ci group by 1) select item, round(case when publish then low end,6) low, round(case when publish then high end,6) high, case when publish then printf('%+.2f%% a %+.2f%%', low-100, high-100) end as text from z left join p using (item)", "links")
def interval_read_out(spark, sf_dir):
    """The last interval of each published item, its logarithms read as if they were per cent."""
    links = B.kept(spark, P.links(B.cells(spark, sf_dir)), "links")
    publish = index.match_summary(links, ["item"], 1.2, 1).select("item", "publish")
    return rounded(bootstrap.read_out(bootstrap.interval(links, log=True).withColumns({"low": 100 + F.col("low"), "high": 100 + F.col("high")}), publish))


@registered("select l_orderkey, l_linenumber, l_shipmode_like from (select l_orderkey, l_linenumber, l_returnflag l_shipmode_like, l_linestatus from lineitem) where l_shipmode_like in ('A','R')")
def row_cut(spark, sf_dir):
    """Rows of two categories with the contract's columns; the feed's other columns go."""
    feed = B.table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "l_shipmode_like")
    return landing.cut(feed, ["l_orderkey", "l_linenumber", "l_shipmode_like"], "l_shipmode_like", ["A", "R"])


@registered("select distinct c_nationkey, c_mktsegment from customer")
def entity_cut(spark, sf_dir):
    return landing.distinct_entities(B.table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"])


@registered("select row_number() over (order by p_brand, p_type, p_size) - 1 as place, p_brand, p_type, p_size from (select distinct p_brand, p_type, p_size from part)")
def ordered_rows(spark, sf_dir):
    """Places by the deterministic sort of a table, from its columns alone."""
    rows = landing.ordered(landing.distinct_entities(B.table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"]))
    return landing.placed(rows)


@registered(CUT_SQL, "links outs")
def index_kept_up(spark, sf_dir):
    """The same index from a stored state, after every fifth period's prices were put right."""
    path = B.scratch(spark, "state")
    outlets = B.outlets(spark, sf_dir).withColumn("channel", P.mapped(F.col("state"), B.CHANNELS))
    cells = B.cells(spark, sf_dir).select("outlet", "item", "ord", "price")
    cells.write.partitionBy("ord").parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells").select("outlet", "item", F.col("ord").cast("int"), "price")
    periods = [r[0] for r in cells.select("ord").distinct().collect()]
    wrong = F.when(F.col("ord") % 5 == 0, (F.col("price") * 2).cast("decimal(10,4)")).otherwise(F.col("price"))
    kept_index.refresh(f"{path}/index", cells.withColumn("price", wrong), outlets, CUTS, periods)
    kept_index.refresh(f"{path}/index", cells, outlets, CUTS, [p for p in periods if p % 5 == 0])
    return rounded(kept_index.read(spark, f"{path}/index", 8, 2))


# ---- dates, dictionaries, files

WAGE_DATES = "select date_trunc('quarter', o_orderdate) since, round(avg(o_totalprice),6) wage from orders where o_orderkey%3=0 group by 1 having count(*)%2=0"


@registered(f"with w as ({WAGE_DATES}) select l_orderkey, l_linenumber, wage from lineitem asof left join w on l_shipdate>=w.since")
def wage_at_shipment(spark, sf_dir):
    """Each line with the wage that held when it was shipped; some quarters have none of their own."""
    since = F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz")
    wages = B.table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").groupBy(since.alias("since")).agg(F.round(F.avg("o_totalprice"), 6).alias("wage"), F.count("*").alias("n")).filter("n % 2 = 0")
    rows = B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return asof.as_of(rows, wages, "l_shipdate", "since", ["wage"]).drop("l_shipdate")


#: 191 invented entries: whole words of the sample's brands and segments, and words that no text has.
WORDS = {"AUTOMOBILE": "Automobile", "HOUSEHOLD": "Household", "BUILDING": "B?ilding", "PROMO": "Promo"} | {f"nowhere{chr(97 + i // 26)}{chr(97 + i % 26)}": f"n{i}" for i in range(187)}


@registered("select c_custkey, case c_mktsegment when 'AUTOMOBILE' then 'Automobile' when 'HOUSEHOLD' then 'Household' when 'BUILDING' then 'B?ilding' else c_mktsegment end||'/ nowhere? '||case c_custkey%2 when 0 then 'n30' else 'nowherebx' end as repaired from customer")
def dictionary_repair(spark, sf_dir):
    """Words replaced by a dictionary of 191 entries; a word that only begins like an entry stays."""
    said = F.concat("c_mktsegment", F.lit("/ nowhere? "), F.when(F.col("c_custkey") % 2 == 0, "nowherebe").otherwise("nowherebx"))
    return B.table(spark, sf_dir, "customer").select("c_custkey", text.repair_words(said, {k: v for k, v in WORDS.items() if k != "nowherebx"}).alias("repaired"))


CRC_SQL = "xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}, ''), lambda x: [ascii(x)::bigint,-1,-1,-1,-1,-1,-1,-1,-1]))), lambda a, i: case when i>=0 then xor(a,i) else xor(a>>1, 3988292384*(a&1)) end))"


@registered("with t as (select n_regionkey, string_agg(n_name||chr(10), '' order by n_name) s from nation group by 1) select n_regionkey, sha256(s) sha256, strlen(s) bytes, " + CRC_SQL.format("s") + " crc32 from t")
def file_seals(spark, sf_dir):
    """Size, SHA-256 and CRC of files written before: the names of each region's nations, one a line, in order."""
    path = B.scratch(spark, "seals")
    rows = B.table(spark, sf_dir, "nation").select("n_regionkey", "n_name")
    rows.repartition("n_regionkey").sortWithinPartitions("n_regionkey", "n_name").write.partitionBy("n_regionkey").text(path)
    found = files.fingerprints(spark, [f"{path}/*/*.txt"])
    region = F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int")
    return found.select(region.alias("n_regionkey"), "sha256", "bytes", "crc32")


@registered("select n_regionkey, cast(sum(strlen(n_name)+1) as bigint) bytes from nation where n_regionkey<3 group by 1")
def rewritten_files(spark, sf_dir):
    """Files that another run wrote anew with the same length, told from untouched ones by the CRC alone."""
    path, rows = B.scratch(spark, "rewritten"), B.table(spark, sf_dir, "nation")
    sums = []
    for run in range(2):
        name = F.when((F.col("n_regionkey") < 3) & F.lit(run == 1), F.reverse("n_name")).otherwise(F.col("n_name"))
        rows.select("n_regionkey", name.alias("name")).repartition("n_regionkey").sortWithinPartitions("n_regionkey", "name").write.partitionBy("n_regionkey").text(f"{path}/{run}")
        region = F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int")
        sums.append(files.checksums(spark, [f"{path}/{run}/*/*.txt"]).select(region.alias("period"), F.lit(1).alias("attempt"), "bytes", "crc32"))
    return state.rewritten(sums[0], sums[1].drop("attempt")).select(F.col("period").alias("n_regionkey"), "bytes")


# ---- dimensions and facts


@registered("select p_brand, max(p_size) p_size, coalesce(try_cast(regexp_extract(p_brand,'Brand#(\\d+)',1) as int),1) pieces, null::decimal(7,2) grams from part group by 1".replace("\\\\", "\\"))
def item_dimension(spark, sf_dir):
    made = dims.items(B.table(spark, sf_dir, "part").withColumn("text", F.concat(F.lit("pack of "), F.substring("p_brand", 7, 9), F.lit(" "))), ["p_brand"], ["p_size", "text"], "text")
    return made.select("p_brand", "p_size", "pieces", "grams")


@registered("select cast(date_trunc('month', o_orderdate) as date) month_start, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(max(o_custkey) as decimal(10,4)) nominal, cast(min(o_custkey) as decimal(10,2)) as real, cast(count(*) as decimal(10,2)) as index from orders group by all")
def wage_fact(spark, sf_dir):
    date = F.col("o_orderdate")
    text_rows = B.table(spark, sf_dir, "orders").groupBy(F.year(date).cast("string").alias("year"), F.month(date).cast("string").alias("month")).agg(F.max("o_custkey").cast("string").alias("nominal"), F.min("o_custkey").cast("string").alias("real"), F.count("*").cast("string").alias("index"))
    return dims.monthly_wages(text_rows).drop("month_id")


@registered("select strftime(o_orderdate, '%Y-%m')||'_q1' as label, cast(max(o_custkey) as decimal(12,6)) deflator from orders group by 1")
def cpi_fact(spark, sf_dir):
    seen = B.table(spark, sf_dir, "orders").groupBy(F.concat(F.date_format("o_orderdate", "yyyy/MM"), F.lit("/01")).alias("period")).agg(F.max("o_custkey").cast("string").alias("value"))
    return dims.half_monthly_cpi(seen).drop("period_id")
