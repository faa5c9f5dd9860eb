"""The registered queries, each with its DuckDB text. Doubles are rounded to six digits on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import numbers, periods, text
from plumbline.functions.keys import differs
from plumbline.operators import bootstrap, contrast, coverage, dims, gates, index, levels
from plumbline.operators import panel as P
from plumbline.plans import bindings as B
from plumbline.plans.bindings import with_views
from plumbline.sources import sinks, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None, views: str = ""):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_views(views, sql) if views else sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def linked(spark: SparkSession, sf_dir: str, attributes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links and cells, with outlet attributes if asked."""
    cells = B.cells(spark, sf_dir)
    links = P.links(cells)
    if not attributes:
        return links, cells
    outs = B.outlets(spark, sf_dir)
    return P.star(links, outs, "outlet"), P.star(cells, outs, "outlet")


# ---- cells, links, index

@registered("select * from cells", "cells")
def panel_cells(spark, sf_dir):
    return B.cells(spark, sf_dir)


@registered("select outlet, item, ord, round(log_rel,6) log_rel from links", "links")
def matched_links(spark, sf_dir):
    return rounded(linked(spark, sf_dir)[0])


@registered("select ord, round(avg(log_rel),6) mean_rel, count(distinct outlet) matched, count(*) cells from links group by 1", "links")
def link_summary(spark, sf_dir):
    return rounded(index.per_period(linked(spark, sf_dir)[0], []))


CHAIN = """,
stats as (select {by} ord, avg(log_rel) m, count(distinct outlet) n from lk group by all),
gr as (select {by} g.ord from (select distinct {by0} from ck) x cross join (select distinct ord from cells) g),
j as (select gr.*, m, n, (select min(ord) from cells) base, exists (select 1 from ck where ck.ord=(select min(ord) from cells) {same_c}) priced from gr left join stats on stats.ord=gr.ord {same_s})
select {by} ord, n matched, round(case when ord=base then case when priced then 100.0 end
  when count(n) over w/sum(1/cast(n as double)) over w >= {thr} and min(n) over w >= {floor} then exp(sum(m) over w)*100 end, 6) as "index"
from j window w as ({part} order by ord rows unbounded preceding)"""


def _chain_sql(by: str, thr: float, floor: int) -> str:
    views = ",\nlk as (select links.*, case state when 'AMERICA' then 'a' when 'EUROPE' then 'b' when 'ASIA' then 'b' end channel from links left join outs using (outlet)),\nck as (select cells.*, case state when 'AMERICA' then 'a' when 'EUROPE' then 'b' when 'ASIA' then 'b' end channel from cells left join outs using (outlet))"
    same = f"and {{0}}.{by} is not distinct from {{1}}.{by}" if by else ""
    return views + CHAIN.format(by=f"{by}," if by else "", by0=by or "1", same_c=same.format("ck", "gr"), same_s=same.format("stats", "gr"), thr=thr, floor=floor, part=f"partition by {by}" if by else "")


@registered(_chain_sql("", 30, 10), "links outs")
def chained_index(spark, sf_dir):
    links, cells = linked(spark, sf_dir)
    return rounded(index.chained_index(links, cells, cells.select("ord").distinct(), []))


@registered(_chain_sql("channel", 8, 2), "links outs")
def chained_index_by_channel(spark, sf_dir):
    links, cells = linked(spark, sf_dir, True)
    channel = P.mapped(F.col("state"), B.CHANNELS)
    links, cells = links.withColumn("channel", channel), cells.withColumn("channel", channel)
    return rounded(index.chained_index(links, cells, cells.select("ord").distinct(), ["channel"], 8, 2))


MATCH = "select {by}, count(*) n_links, min(n) least_match, round(median(n),6) median_match, round(count(*)/sum(1/cast(n as double)),6) effective_match, count(*) filter (n<30) thin_links, coalesce(count(*)/sum(1/cast(n as double))>=30 and min(n)>=10, false) publish from (select {by}, ord, count(distinct outlet) n from links join outs using (outlet) group by all) group by {by}"


@registered("select item, round(count(*)/sum(1/cast(n as double)),6) effective_match, min(n) least_match, round(case when count(*)/sum(1/cast(n as double))>=1.2 and min(n)>=1 then exp(sum(m))-1 end,6) change from (select item, ord, count(distinct outlet) n, avg(log_rel) m from links group by 1,2) group by 1", "links")
def chained_change_by_item(spark, sf_dir):
    return rounded(index.chained_change(linked(spark, sf_dir)[0], ["item"], 1.2, 1)).orderBy(F.desc_nulls_last("change"), "item")


@registered(MATCH.format(by="chain"), "links outs")
def effective_match_by_chain(spark, sf_dir):
    return rounded(index.match_summary(linked(spark, sf_dir, True)[0], ["chain"]))


@registered("select state, count(*) filter (n<30) thin_links, count(*) n_links from (select state, ord, count(distinct outlet) n from links left join outs using (outlet) group by all) group by 1", "links outs")
def links_under_threshold(spark, sf_dir):
    return index.match_summary(linked(spark, sf_dir, True)[0], ["state"]).select("state", "thin_links", "n_links")


@registered(", s as (select state, count(*)/sum(1/cast(n as double)) e, min(n) m from (select state, ord, count(distinct outlet) n from links left join outs using (outlet) group by all) group by 1) select state, cast(t.range as int) threshold, coalesce(e>=t.range and m>=2,false) publish from s, range(5,201,5) t", "links outs")
def threshold_scan(spark, sf_dir):
    return index.threshold_scan(linked(spark, sf_dir, True)[0], ["state"], 2)


INFLATION = ", i as (select ord, deflator/(select arg_min(deflator, ord) from cal)-1 inflation from cal)"


@registered(_chain_sql("", 30, 10).replace('select  ord, n matched, round(', ', x as (select ord, (').replace('end, 6) as "index"', 'end) idx').replace("rows unbounded preceding)", "rows unbounded preceding))") + INFLATION + ' select ord, round(idx,6) as "index", round(inflation,6) inflation, round((1+inflation)*100,6) deflator_index, round(idx/(1+inflation),6) real_index from x left join i using (ord)', "links outs cal")
def inflation_and_real_index(spark, sf_dir):
    links, cells = linked(spark, sf_dir)
    cal = B.calendar(spark, sf_dir)
    made = index.chained_index(links, cells, cal, [])
    return rounded(index.real_index(made, cal).drop("matched"))


@registered(INFLATION + ", c as (select item, exp(sum(m))-1 change from (select item, ord, avg(log_rel) m from links group by 1,2) group by 1) select item, round(change,6) change, round((1+change)/(1+(select arg_max(inflation, ord) from i))-1,6) real_change from c", "links cal")
def real_change_by_item(spark, sf_dir):
    nominal = index.chained_change(linked(spark, sf_dir)[0], ["item"], 0, 1).select("item", "change")
    last = index.inflation(B.calendar(spark, sf_dir)).agg(F.max_by("inflation", "ord").alias("inflation"))
    return rounded(nominal.crossJoin(F.broadcast(last)).select("item", "change", index.real_change(F.col("change"), F.col("inflation")).alias("real_change")))


@registered(""", e as (select min(ord) f, max(ord) l from cells), r as (select outlet,item,ord,cast(price as double) price from cells),
full_ as (select outlet from r group by 1 having count(distinct ord)=(select count(distinct ord) from r)),
p as (select outlet,item,max(price) filter (ord=f) a, max(price) filter (ord=l) b from r,e group by 1,2),
m as (select a.ord, sum(a.price)/sum(z.price) dutot, avg(a.price/z.price) carli from r a join r z on a.outlet=z.outlet and a.item=z.item and a.ord=z.ord+1 group by 1)
select 'simple mean' estimator, round(ln(avg(price) filter (ord=l)/avg(price) filter (ord=f)),6) log_change from r,e
union all select 'balanced panel', round(ln(avg(price) filter (ord=l)/avg(price) filter (ord=f)),6) from r,e where outlet in (select outlet from full_)
union all select 'endpoints', round(ln(exp(avg(ln(b/a)))),6) from p where a is not null and b is not null
union all select 'chained Dutot', round(ln(exp(sum(ln(dutot)))),6) from m
union all select 'chained Carli', round(ln(exp(sum(ln(carli)))),6) from m""", "cells")
def estimator_contrast(spark, sf_dir):
    cells = B.kept(spark, B.cells(spark, sf_dir).select("outlet", "item", "ord", "price"), "cells")
    return rounded(contrast.contrast(cells).select("estimator", F.log(1 + F.col("change")).alias("log_change")))


# ---- bootstrap

DRAWN = """, roster as (select item, outlet, row_number() over (partition by item order by outlet)-1 i from (select distinct item, outlet from links)),
sizes as (select item, count(*) n from roster group by 1),
a as (select *, xor(w>>22, w) a from (select *, (xor(s>>((s>>28)+4), s)*277803737)&4294967295 w from (select item, n, cast(r.range as int) rep, (((('0x'||substr(md5('20240101|'||item),1,8))::bigint+r.range)&4294967295)*747796405+2891336453)&4294967295 s from sizes, range(2000) r))),
b as (select *, xor(w>>22, w) b from (select *, (xor(s>>((s>>28)+4), s)*277803737)&4294967295 w from (select r.range draw, (((r.range+2654435769)&4294967295)*747796405+2891336453)&4294967295 s from range((select max(n) from sizes)) r))),
h as (select *, (xor(s>>((s>>28)+4), s)*277803737)&4294967295 w from (select item, n, rep, (xor(a,b)*747796405+2891336453)&4294967295 s from a join b on draw<n)),
draws as (select item, rep, (xor(w>>22, w)*n)>>32 i from h),
w as (select draws.item, rep, outlet, count(*) weight from draws join roster using (item, i) group by 1,2,3),
own as (select item, outlet, ord, sum(log_rel) s, count(*) c from links group by 1,2,3),
means as (select own.item, rep, ord, sum(weight*s)/sum(weight*c) m from own join w on own.item=w.item and own.outlet=w.outlet group by 1,2,3),
reps as (select item, rep, ord, sum(m) over (partition by item, rep order by ord rows unbounded preceding) v from means),
ci as (select item, ord, quantile_cont(v,0.025) low, quantile_cont(v,0.975) high, stddev(v) error, count(*) replicas from reps group by 1,2)"""


@registered(DRAWN + " select item, ord, round(low,6) low, round(high,6) high, round(error,6) error, replicas from ci", "links")
def bootstrap_ci(spark, sf_dir):
    links = B.kept(spark, linked(spark, sf_dir)[0], "links")
    return rounded(bootstrap.interval(links, log=True))


@registered(DRAWN + ", g as (select item, c.ord, c.ord=(select min(ord) from cells) based from (select distinct item from ci), (select distinct ord from cells) c) select item, g.ord, round(case when based then coalesce(low,0) else low end,6) low, round(case when based then coalesce(high,0) else high end,6) high, round(case when based then coalesce(error,0) else error end,6) error from g left join ci using (item, ord)", "links")
def bootstrap_ci_filled(spark, sf_dir):
    links = B.kept(spark, linked(spark, sf_dir)[0], "links")
    calendar = B.feed(spark, sf_dir).select("ord").distinct()  # the periods of the cells
    return rounded(bootstrap.filled(bootstrap.interval(links, log=True), calendar, (0.0, 0.0, 0.0)))


# ---- coverage, levels, wages

LEVELS_SQL = "select {by} 'outlet' as level, count(distinct outlet) n from {t} {g} union all select {by} 'chain', count(distinct chain) from {t} {g} union all select {by} 'municipality', count(distinct (state, municipality)) from {t} {g} union all select {by} 'state', count(distinct state) from {t} {g}"


@registered(", ck as (select * from cells left join outs using (outlet)), lk as (select * from links left join outs using (outlet)), so as (" + LEVELS_SQL.format(by="ord,", t="ck", g="group by ord") + "), sl as (" + LEVELS_SQL.format(by="ord,", t="lk", g="group by ord") + "), o as (" + LEVELS_SQL.format(by="", t="ck", g="") + "), l as (" + LEVELS_SQL.format(by="", t="lk", g="") + ") select o.level, o.n observed, l.n matched, round(c,6) coverage from o join l using (level) join (select level, median(cast(sl.n as double)/so.n) c from sl join so using (ord, level) group by 1) using (level)", "links outs")
def coverage_by_level(spark, sf_dir):
    return rounded(coverage.coverage(*linked(spark, sf_dir, True), B.outlets(spark, sf_dir)))


@registered("select count(*) filter (p=t) outlets, max(t) periods from (select outlet, count(distinct ord) p from cells group by 1), (select count(distinct ord) t from cells)", "cells")
def full_panel_outlets(spark, sf_dir):
    return coverage.full_panel_outlets(B.cells(spark, sf_dir))


@registered("select arg_max(label, ord) as label from cal", "cal")
def freshness_label(spark, sf_dir):
    return levels.freshness(B.calendar(spark, sf_dir))


@registered("select item, round(avg(cast(price as double)),6) mean_price, round(median(cast(price as double)),6) median_price, round(quantile_cont(cast(price as double),0.9)/quantile_cont(cast(price as double),0.1),6) p90_p10, count(distinct outlet) outlets from cells group by 1 having count(distinct outlet)>=5", "cells")
def price_levels(spark, sf_dir):
    return rounded(levels.price_levels(B.cells(spark, sf_dir), ["item"], 5))


@registered(", s as (select min(price) lo, max(price) hi from cells), b as (select cast(range as int) bin, 900.0::double+range*1000 centre from range(106)), c as (select cast(floor((cast(price as double)-900)/1000+0.5) as int) bin, count(*) n from cells group by 1) select bin, centre, case when centre+500>lo and centre-500<=hi then coalesce(n,0) end cells from b left join c using (bin), s", "cells")
def histogram_bins(spark, sf_dir):
    return levels.histogram(B.cells(spark, sf_dir), 900, 105900, 1000)


@registered(", e as (select min(ord) f, max(ord) l from cells) select chain, round(avg(cast(price as double)) filter (ord=f),6) opening, round(avg(cast(price as double)) filter (ord=l),6) closing, least(count(distinct outlet) filter (ord=f), count(distinct outlet) filter (ord=l)) outlets from cells left join outs using (outlet), e group by 1 having least(count(distinct outlet) filter (ord=f), count(distinct outlet) filter (ord=l))>=1", "cells outs")
def open_close_price_by_chain(spark, sf_dir):
    return rounded(levels.open_close(linked(spark, sf_dir, True)[1], ["chain"], 1)).orderBy(F.desc("opening"), "chain")


@registered("select ord, round(mean_price,6) mean_price, round(wage,6) wage, round(wage/mean_price,6) units from (select ord, avg(cast(price as double)) mean_price from cells group by 1) left join cal using (ord) left join wages using (month)", "cells cal wages")
def wage_units_per_day(spark, sf_dir):
    return rounded(levels.units_per_day(B.cells(spark, sf_dir), B.calendar(spark, sf_dir).select("ord", "month"), B.months(spark, sf_dir)))


@registered(", r as (select ord, wage from cal left join wages using (month)) select ord, round(wage/(select arg_min(wage,ord) from r)-1,6) wage_change, round(wage/(select arg_min(wage,ord) from r)*100,6) wage_index from r", "cal wages")
def wage_index(spark, sf_dir):
    return rounded(levels.wage_index(B.calendar(spark, sf_dir), B.months(spark, sf_dir)))


@registered("select round(avg(wage),6) wage from (select distinct month from cal) join wages using (month)", "cal wages")
def daily_wage(spark, sf_dir):
    return rounded(levels.daily_wage(B.months(spark, sf_dir), B.calendar(spark, sf_dir)))


@registered("select state, count(*) cells, round(sum(cast(price as double)),2) total from cells left join outs on outs.outlet=cells.outlet and chain<5 group by 1", "cells outs")
def star_unknown_member(spark, sf_dir):
    rows = P.star(B.cells(spark, sf_dir), B.outlets(spark, sf_dir).filter("chain < 5"), "outlet")
    return rows.groupBy("state").agg(F.count("*").alias("cells"), F.round(F.sum(F.col("price").cast("double")), 2).alias("total"))


# ---- batches

@registered("select ord, count(*) as rows, max(l_linenumber) attempt from lines join (select ord, max(l_linenumber) m from lines group by 1) using (ord) where l_linenumber=m group by 1", "lines")
def current_attempt(spark, sf_dir):
    rows = state.current(B.lines(spark, sf_dir), "ord", "l_linenumber")
    return rows.groupBy("ord").agg(F.count("*").alias("rows"), F.max("l_linenumber").alias("attempt"))


@registered("select distinct ord, l_linenumber attempt from lines where (ord, l_linenumber) not in (select ord, l_linenumber from lines where l_quantity=50)", "lines")
def pending_batches(spark, sf_dir):
    rows = B.lines(spark, sf_dir).select("ord", F.col("l_linenumber").alias("attempt"), "l_quantity")
    return state.pending(rows.select("ord", "attempt").distinct(), rows.filter("l_quantity = 50"), {"ord": "ord", "attempt": "attempt"})


@registered(", m as (select ord, arg_max(b, l_linenumber) old_bytes from (select ord, l_linenumber, count(*) b from lines group by 1,2) group by 1), c as (select ord, count(*) bytes from lines where l_returnflag<>'R' and l_linenumber=1 group by 1) select ord as period, old_bytes, bytes from c join m using (ord) where old_bytes<>bytes", "lines")
def rewritten_batches(spark, sf_dir):
    rows = B.lines(spark, sf_dir).withColumnRenamed("ord", "period")
    unknown = F.lit(None).cast("long").alias("crc32")
    manifest = rows.groupBy("period", F.col("l_linenumber").alias("attempt")).agg(F.count("*").alias("bytes")).select("*", unknown)
    now = rows.filter("l_returnflag <> 'R' and l_linenumber = 1").groupBy("period").agg(F.count("*").alias("bytes")).select("*", unknown)
    return state.rewritten(manifest, now)


@registered(", f as (select o_orderpriority file, year(o_orderdate) version, cast(count(*) as varchar) sha256 from orders group by 1,2), n as (select o_orderpriority file, cast(count(*) as varchar) sha256 from orders where year(o_orderdate)=1998 group by 1) select n.file, cast(last+1 as int) version, n.sha256 from n join (select file, max(version) last, arg_max(sha256, version) old from f group by 1) using (file) where old<>n.sha256".replace(", f as", "with f as", 1))
def version_registry(spark, sf_dir):
    rows = B.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("file"), F.year("o_orderdate").alias("version"))
    registry = rows.groupBy("file", "version").agg(F.count("*").cast("string").alias("sha256"))
    now = rows.filter("version = 1998").groupBy("file").agg(F.count("*").cast("string").alias("sha256"))
    return state.new_versions(registry, now)


@registered(", t as (select ord, count(*) as rows from lines where l_linestatus='O' group by 1), e as (select ord, count(*) expected from lines where l_returnflag='R' group by 1) select ord, rows, expected from t full join e using (ord) where rows is distinct from expected", "lines")
def reconcile_counts(spark, sf_dir):
    rows = B.lines(spark, sf_dir)
    expected = rows.filter("l_returnflag = 'R'").groupBy("ord").agg(F.count("*").alias("expected"))
    return state.unreconciled(rows.filter("l_linestatus = 'O'"), expected, ["ord"])


@registered("select o.outlet, o.item, coalesce(n.attempt,o.attempt) attempt, case when n.outlet is null or n.attempt=o.attempt then 'keep' else 'update' end as action from (select outlet,item,max(attempt) attempt from panel where ord<=(select (min(ord)+max(ord))//2 from panel) group by 1,2) o left join (select outlet,item,max(attempt) attempt from panel where ord>(select (min(ord)+max(ord))//2 from panel) group by 1,2) n using (outlet,item) union all select outlet,item,attempt,'insert' from (select outlet,item,max(attempt) attempt from panel where ord>(select (min(ord)+max(ord))//2 from panel) group by 1,2) where (outlet,item) not in (select outlet,item from panel where ord<=(select (min(ord)+max(ord))//2 from panel))", "panel")
def upsert_actions(spark, sf_dir):
    rows = B.feed(spark, sf_dir)
    cut = rows.agg(F.floor((F.min("ord") + F.max("ord")) / 2).alias("cut"))
    halves = rows.crossJoin(F.broadcast(cut))
    one = lambda cond: halves.filter(cond).groupBy("outlet", "item").agg(F.max("attempt").alias("attempt"))
    return sinks.upsert_actions(one("ord <= cut"), one("ord > cut"), ["outlet", "item"])


@registered("select y as year, l_linenumber attempt, count(*) as rows from (select *, cast(year(l_shipdate) as int) y from lineitem) where y<1998 or l_returnflag='N' group by 1,2")
def slice_replace_result(spark, sf_dir):
    rows = B.table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), F.col("l_linenumber").alias("attempt"), "l_returnflag")
    known = sorted(r[0] for r in rows.select("year").distinct().collect())
    late = [y for y in known if y >= 1998]
    count = lambda df: df.groupBy("year", "attempt").agg(F.count("*").alias("rows"))
    path = B.scratch(spark, "slices")
    sinks.replace_periods(count(rows), path, "year", known)
    sinks.replace_periods(count(rows.filter("l_returnflag = 'N'").filter(F.col("year").isin(late))), path, "year", late)
    return spark.read.schema("attempt int, rows long, year int").parquet(path).select("year", "attempt", "rows")


@registered(", b as (select distinct label, ord from cal where label like '%-06_q2') select distinct label from cal where ord in (select ord from b union all select ord-1 from b)", "cal")
def widened_batch(spark, sf_dir):
    cal = B.calendar(spark, sf_dir).select("label", "ord")
    return state.widened(cal.filter(F.col("label").endswith("-06_q2")), cal)


@registered("select label, cast(strptime(substr(label,1,7)||case when label like '%q2' then '-16' else '-01' end,'%Y-%m-%d') as date) as start, ord, cast(substr(label,1,4) as int) as year, cast(substr(label,6,2) as int) as month, round(deflator,6) deflator from cal", "cal")
def period_calendar(spark, sf_dir):
    cal = B.calendar(spark, sf_dir)
    return rounded(dims.half_months(cal, cal.select("label", "deflator")).select("label", "start", "ord", "year", "month", "deflator"))


@registered("with z as (select o_orderpriority zone_literal, case o_orderpriority when '5-LOW' then '4-NOT SPECIFIED' else o_orderpriority end as zone, cast(date_trunc('month',o_orderdate) as date) valid_from, round(sum(o_totalprice),2) wages from orders group by 1,2,3), v as (select valid_from, coalesce(cast(lead(valid_from) over (order by valid_from) - interval 1 day as date), date '9999-12-31') valid_to from (select distinct valid_from from z)) select z.zone, zone_literal, valid_from, valid_to, valid_to=date '9999-12-31' is_current, wages from z join v using (valid_from)")
def scd2_validity(spark, sf_dir):
    rows = B.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("zone"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("valid_from")).agg(F.round(F.sum("o_totalprice"), 2).alias("wages"))
    return dims.versioned(rows, {"5-LOW": "4-NOT SPECIFIED"}).select("zone", "zone_literal", "valid_from", "valid_to", "is_current", "wages")


# ---- gates

@registered("with z as (select distinct o_orderpriority as zone, cast(date_trunc('week',o_orderdate) as date) valid_from from orders where o_orderstatus='P'), v as (select valid_from, coalesce(cast(lead(valid_from) over (order by valid_from) - interval 1 day as date), date '9999-12-31') valid_to from (select distinct valid_from from z)), x as (select zone, valid_to, lead(valid_from) over (partition by zone order by valid_from) next_from from z join v using (valid_from)) select * from x where next_from is not null and valid_to <> next_from - interval 1 day")
def validity_gaps(spark, sf_dir):
    rows = B.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderpriority").alias("zone"), F.to_date(F.date_trunc("week", "o_orderdate")).alias("valid_from")).distinct()
    return gates.validity_gaps(dims.versioned(rows), "zone")


@registered(", o as (select distinct ord from lines where l_quantity=50 and l_discount=0.1 and l_returnflag='R'), x as (select ord, lead(ord) over (order by ord) next_ord from o) select * from x where next_ord-ord<>1", "lines")
def calendar_gaps(spark, sf_dir):
    return gates.calendar_gaps(B.lines(spark, sf_dir).filter("l_quantity = 50 and l_discount = 0.1 and l_returnflag = 'R'"))


@registered(", x as (select outlet, chain, municipality, state, case when state in ('AMERICA','EUROPE','ASIA') then state end as known from outs) select 'known' as column, count(*) filter (known is null) blanks from x having count(*) filter (known is null)>0 union all select 'state', count(*) filter (state is null or trim(state)='') from x having count(*) filter (state is null or trim(state)='')>0", "outs")
def gate_blank_counts(spark, sf_dir):
    outs = B.outlets(spark, sf_dir)
    return gates.blank_counts(outs.withColumn("known", F.when(F.col("state").isin(*B.CHANNELS), F.col("state"))), ["outlet", "chain", "state", "known"])


@registered("select p_brand, 'p_type' as attribute, string_agg(distinct p_type, '|' order by p_type) as values from part group by 1 having count(distinct p_type)>1 union all select p_brand, 'p_name', string_agg(distinct p_name, '|' order by p_name) from part group by 1 having count(distinct p_name)>1")
def gate_one_value_per_key(spark, sf_dir):
    return gates.several_values(B.table(spark, sf_dir, "part"), ["p_brand"], ["p_type", "p_name"]).withColumn("values", F.array_join("values", "|"))


@registered("select k as line_key, count(*) as count from (select l_orderkey||'|'||l_linenumber k from lineitem) group by 1 having count(*)>1")
def gate_key_unique(spark, sf_dir):
    rows = B.table(spark, sf_dir, "lineitem").select(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line_key"))
    return gates.repeated_keys(rows, "line_key")


@registered("select 'low discount' as rule, count(*) filter (not l_discount<0.1) violations from lineitem having count(*) filter (not l_discount<0.1)>0 union all select 'shipped', count(*) filter (l_shipdate is null) from lineitem having count(*) filter (l_shipdate is null)>0 union all select 'small', count(*) filter (not l_quantity<=40) from lineitem having count(*) filter (not l_quantity<=40)>0")
def gate_broken_rules(spark, sf_dir):
    return gates.broken(B.table(spark, sf_dir, "lineitem"), {"low discount": "l_discount < 0.1", "shipped": "l_shipdate is not null", "small": "l_quantity <= 40"})


@registered(r"select doc_id, 'text' as column, regexp_extract(text, '([^\x20-\x7EñÑ°¡ºª]|\?)', 1) as character, unicode(regexp_extract(text, '([^\x20-\x7EñÑ°¡ºª]|\?)', 1)) code from documents where regexp_matches(text, '[^\x20-\x7EñÑ°¡ºª]|\?')")
def gate_illegal_chars(spark, sf_dir):
    return gates.illegal_characters(B.table(spark, sf_dir, "documents"), ["doc_id"], ["text"])


@registered("select distinct p_brand from part where not regexp_matches(p_brand, '^Brand#1\\d?$') and not regexp_matches(p_brand, '^Brand#2$')".replace("\\\\", "\\"))
def gate_unknown_format(spark, sf_dir):
    return gates.unknown_format(B.table(spark, sf_dir, "part"), "p_brand", [r"^Brand#1\d?$", "^Brand#2$"])


@registered("select distinct r_name from region where r_name not in ('AMERICA','EUROPE','ASIA')")
def gate_vocabulary(spark, sf_dir):
    regions = B.table(spark, sf_dir, "region").select("r_name")
    return gates.outside_vocabulary(regions, "r_name", regions.filter(F.col("r_name").isin(*B.CHANNELS)))


@registered("select ord, label from cal left join wages using (month) where wage is null", "cal wages")
def gate_missing_deflator(spark, sf_dir):
    rows = B.calendar(spark, sf_dir).join(B.months(spark, sf_dir), "month", "left")
    return gates.uncovered(rows, "wage").select("ord", "label")


@registered("select count(*) filter (contains(text,'?') or contains(source,'?')) as rows from documents")
def lost_accents(spark, sf_dir):
    return gates.lost_accents(B.table(spark, sf_dir, "documents"), ["text", "source"])


# ---- text, files

@registered("select doc_id, md5(translate(text,'áéíóúüÁÉÍÓÚÜð´','aeiouuAEIOUUñ''')) folded from documents")
def accent_fold(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


@registered("select doc_id, md5(array_to_string(list_transform(regexp_extract_all(text, '([A-Za-zñÑ''?]+|[^A-Za-zñÑ''?]+)', 1), lambda w: case w when 'the' then 'THE' when 'el' then 'EL' when 'token' then 'Token' else w end), '')) repaired from documents")
def word_repair(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select("doc_id", F.md5(text.repair_words(F.col("text"), {"the": "THE", "el": "EL", "token": "Token"})).alias("repaired"))


@registered("select p_partkey, coalesce(try_cast(regexp_extract(p_brand,'(\\d+)',1) as int),1) pieces, try_cast(regexp_extract(p_brand,'(\\d+)',1) as decimal(7,2)) grams from part".replace("\\\\", "\\"))
def parse_attributes(spark, sf_dir):
    return B.table(spark, sf_dir, "part").select("p_partkey", text.pieces(F.col("p_brand"), r"(\d+)").alias("pieces"), text.grams(F.col("p_brand"), r"(\d+)").alias("grams"))


@registered("select k, count(*) n from (select cast(json_extract_string(props,'$.k') as int) k from events) group by 1")
def inline_json(spark, sf_dir):
    parsed = B.table(spark, sf_dir, "events").select(F.inline(F.array(F.from_json("props", "k int"))))
    return parsed.groupBy("k").agg(F.count("*").alias("n"))


@registered("select doc_id, sha256(text) sha256, cast(strlen(text) as bigint) bytes from documents")
def fingerprint_strings(spark, sf_dir):
    from plumbline.functions.keys import seal

    found = seal(F.col("text").cast("binary"))
    return B.table(spark, sf_dir, "documents").select("doc_id", *(found[n].alias(n) for n in ("sha256", "bytes")))


@registered("select l_suppkey outlet, count(*) lines, round(sum(l_extendedprice),2) total from lines where ord between (select max(ord)-23 from lines) and (select max(ord) from lines) and l_returnflag not in ('R') group by 1", "lines")
def restricted_lines(spark, sf_dir):
    rows = B.lines(spark, sf_dir).withColumn("label", periods.label_of_ordinal(F.col("ord")))
    last = rows.select("label", "ord").distinct().crossJoin(F.broadcast(rows.agg(F.max("ord").alias("last")))).filter("ord > last - 24")
    kept = state.restricted(state.without(rows, "l_returnflag", ["R"]), last, "label")
    return kept.groupBy(F.col("l_suppkey").alias("outlet")).agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@registered("select c_custkey, (o_custkey is not null) as ordered, round(case when n>0 then total/n end,6) mean_order from customer left join (select o_custkey, count(*) n, sum(o_totalprice) total from orders group by 1) on o_custkey=c_custkey")
def safe_division(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    rows = B.table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rounded(rows.select("c_custkey", differs(F.col("o_custkey"), F.lit(None)).alias("ordered"), numbers.divide(F.col("total"), F.col("n")).alias("mean_order")))
