"""Thinning, next purchase, ordinals, views of one table, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators.periods import split_by_period
from ledgerlens.operators.sequence import next_event, thin_recent
from ledgerlens.plans.extract import coerce_dates, join_views, label_next_purchase

from .registry import plain, query, select, table

SALES = """
select o_orderkey as sales_id, cast(o_custkey as string) as customer, o_orderdate as spa_date,
       cast(o_orderdate as date) as spa_stamp_date,
       case o_orderpriority when '1-URGENT' then 'Landed' when '2-HIGH' then 'High Rise'
            when '3-MEDIUM' then 'Commercial' when '4-NOT SPECIFIED' then 'RSKU'
            else 'Industrial' end as phase_property_type,
       nullif(o_totalprice, 0) as non_land_posted_selling_price,
       o_orderstatus as phase
from {orders}
"""
SALES_SQL = plain(SALES)

THIN_SQL = """
with recursive rows_in as ({rows}), anchors(k, a) as (
  select k, min(t) from rows_in group by k
  union all
  select x.k, min(r.t) from anchors x join rows_in r on r.k = x.k and r.t >= x.a + interval {reach} day
  group by x.k, x.a
)
select max(struct_pack(t := r.t, id := r.id)).id as id, x.k as k, max(r.t) as t
from anchors x join rows_in r on r.k = x.k and r.t >= x.a and r.t < x.a + interval {reach} day
group by x.k, x.a
"""
ORDER_ROWS = "select o_orderkey as id, o_custkey as k, o_orderdate as t from orders"
EVENT_ROWS = "select event_id as id, user_id as k, ts as t from events"


def _thin(df, days, **kwargs):
    return thin_recent(df, "k", "t", "id", days=days, **kwargs).select("id", "k", "t")


def _orders(spark, d):
    return table(spark, d, "orders").selectExpr("o_orderkey as id", "o_custkey as k", "o_orderdate as t")


@query("thin_recent", THIN_SQL.format(rows=ORDER_ROWS, reach=31))
def thin(spark, d):
    return _thin(_orders(spark, d), 30)


@query("thin_recent_split_keys", THIN_SQL.format(rows=ORDER_ROWS, reach=31))
def thin_split(spark, d):
    """Same result with the busiest customers taken by the way for hot keys."""
    return _thin(_orders(spark, d), 30, hot_rows=15)


@query("thin_recent_instants", THIN_SQL.format(rows=EVENT_ROWS, reach=3))
def thin_events(spark, d):
    """Instants within the day: whole days are floored."""
    events = table(spark, d, "events").selectExpr("event_id as id", "user_id as k", "ts as t")
    return _thin(events, 2)


@query("thin_recent_instants_split_keys", THIN_SQL.format(rows=EVENT_ROWS, reach=3))
def thin_events_split(spark, d):
    """Instants within the day, with the busiest users taken by the way for hot keys."""
    events = table(spark, d, "events").selectExpr("event_id as id", "user_id as k", "ts as t")
    return _thin(events, 2, hot_rows=40)


THIN_REPEATED_SQL = """
with recursive rows_in as (
  select o_orderkey as id, o_custkey as k, o_orderdate as t, l_linenumber as line, l_extendedprice as price
  from orders join lineitem on o_orderkey = l_orderkey
), anchors(k, a) as (
  select k, min(t) from rows_in group by k
  union all
  select x.k, min(r.t) from anchors x join rows_in r on r.k = x.k and r.t >= x.a + interval 31 day
  group by x.k, x.a
), kept as (
  select max(struct_pack(t := r.t, id := r.id, line := r.line, price := r.price)) as r, x.k
  from anchors x join rows_in r on r.k = x.k and r.t >= x.a and r.t < x.a + interval 31 day
  group by x.k, x.a
)
select k, r.t as t, r.id as id, r.line as line, r.price as price from kept
"""


def _lines(spark, d):
    return select(spark, d, """
        select o_orderkey as id, o_custkey as k, o_orderdate as t, l_linenumber as line, l_extendedprice as price
        from {orders} join {lineitem} on o_orderkey = l_orderkey
    """)


@query("thin_recent_repeated_ids", THIN_REPEATED_SQL)
def thin_repeated(spark, d):
    """Ids that repeat: of a run's last instant and id, the last in the order of the other columns."""
    return thin_recent(_lines(spark, d), "k", "t", "id")


@query("thin_recent_repeated_ids_split_keys", THIN_REPEATED_SQL)
def thin_repeated_split(spark, d):
    return thin_recent(_lines(spark, d), "k", "t", "id", hot_rows=60)


NEXT_SQL = f"""
with s as ({SALES_SQL}), n as (
  select *, lead(sales_id) over w as nid, lead(phase_property_type) over w as nkind,
         lead(non_land_posted_selling_price) over w as nprice,
         lead(spa_stamp_date) over w as nstamp, lead(spa_date) over w as ndate
  from s window w as (partition by customer order by spa_date, sales_id)
)
select sales_id, customer, cast(nid is not null as int) as label,
       coalesce(cast(nid as string), 'NOT APPLICABLE') as repeat_sales_id,
       case when nid is null then 'NOT APPLICABLE' else nkind end as repeat_phase_property_type,
       nprice as repeat_non_land_posted_selling_price,
       case when nid is null then date '2022-12-31' else nstamp end as repeat_spa_stamp_date,
       case when nid is null then date '2022-12-31' else cast(ndate as date) end as repeat_spa_date
from n
"""
NEXT_COLUMNS = [
    "sales_id", "customer", "label", "repeat_sales_id", "repeat_phase_property_type",
    "repeat_non_land_posted_selling_price", "repeat_spa_stamp_date", "repeat_spa_date",
]


@query("next_purchase", NEXT_SQL)
def next_purchase(spark, d):
    return label_next_purchase(select(spark, d, SALES), "customer").select(NEXT_COLUMNS)


@query("next_purchase_split_keys", NEXT_SQL)
def next_purchase_split(spark, d):
    """Same result with the busiest customers spread over slices."""
    return label_next_purchase(select(spark, d, SALES), "customer", hot_rows=14).select(NEXT_COLUMNS)


@query(
    "purchase_ordinal",
    """
select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as purchase_no,
       count(*) over (partition by o_custkey) as purchase_count
from orders
""",
)
def ordinal(spark, d):
    out = next_event(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey", {})
    return out.select("o_orderkey", "purchase_no", "purchase_count")


FLAGSHIP_SQL = f"""
with recursive s as ({SALES_SQL}), anchors(k, a) as (
  select customer, min(spa_date) from s group by customer
  union all
  select x.k, min(r.spa_date) from anchors x
  join s r on r.customer = x.k and r.spa_date >= x.a + interval 31 day group by x.k, x.a
), kept as (
  select max(struct_pack(t := r.spa_date, id := r.sales_id)).id as sales_id
  from anchors x join s r on r.customer = x.k and r.spa_date >= x.a and r.spa_date < x.a + interval 31 day
  group by x.k, x.a
), l as (
  select s.*, lead(sales_id) over (partition by customer order by spa_date, sales_id) as nid
  from s join kept using (sales_id)
)
select year(spa_date) as spa_year, phase_property_type, count(*) as purchases, count(nid) as repeats,
       cast(sum(cast(round(non_land_posted_selling_price * 100) as bigint)) as bigint) as cents
from l group by 1, 2
"""


@query("yearly_repeat_summary", FLAGSHIP_SQL)
def flagship(spark, d):
    """Thin, label the next purchase, and sum up by year and property type."""
    columns = ["sales_id", "customer", "spa_date", "phase_property_type", "non_land_posted_selling_price"]
    sales = thin_recent(
        select(spark, d, SALES).select(columns), "customer", "spa_date", "sales_id"
    )
    # a customer keeps one sale per run and runs start over 30 days apart: none is hot
    labelled = next_event(sales, "customer", "spa_date", "sales_id", {}, hot_rows=None)
    cents = F.round(F.col("non_land_posted_selling_price") * 100).cast("long")
    return labelled.groupBy(F.year("spa_date").cast("long").alias("spa_year"), "phase_property_type").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.count_if("has_next").alias("repeats"),
        F.sum(cents).alias("cents"),
    )


@query(
    "self_join_views",
    """
select a.l_orderkey, a.l_partkey, a.l_linenumber, b.l_extendedprice, b.l_discount
from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey
where a.l_returnflag = 'A' and a.l_linestatus = 'F' and b.l_returnflag = 'A' and b.l_linestatus = 'O'
""",
)
def views(spark, d):
    return join_views(
        table(spark, d, "lineitem"),
        "l_orderkey",
        {"l_returnflag": "A", "l_linestatus": "F"},
        ["l_partkey", "l_linenumber"],
        {"l_returnflag": "A", "l_linestatus": "O"},
        ["l_extendedprice", "l_discount"],
    )


def _tagged(train, evaluation):
    return train.withColumn("part", F.lit("train")).unionByName(
        evaluation.withColumn("part", F.lit("eval"))
    )


def _dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate")


@query(
    "period_split",
    """
select o_orderkey, o_orderdate, case when o_orderdate < timestamp '2000-03-01' then 'train' else 'eval' end as part
from orders where o_orderdate <= timestamp '2000-09-30'
""",
)
def period(spark, d):
    train, evaluation, _ = split_by_period(_dates(spark, d), "o_orderdate", "2000-03-01", "2000-09-30")
    return _tagged(train, evaluation)


@query(
    "period_split_fallback",
    """
with b as (select make_date(cast(year(max(o_orderdate)) - 1 as int), 1, 1) as s, max(o_orderdate) as e from orders)
select o_orderkey, o_orderdate, case when o_orderdate < s then 'train' else 'eval' end as part
from orders, b where o_orderdate <= e
""",
)
def period_fallback(spark, d):
    train, evaluation, _ = split_by_period(_dates(spark, d), "o_orderdate", "2024-01-01", "2024-07-31")
    return _tagged(train, evaluation)


@query(
    "period_split_back",
    """
select o_orderkey, o_orderdate,
       case when o_orderdate between timestamp '2000-03-01' and timestamp '2000-09-30' then 'eval' else 'train' end as part
from orders
""",
)
def period_back(spark, d):
    train, evaluation, _ = split_by_period(
        _dates(spark, d), "o_orderdate", "2000-03-01", "2000-09-30", after_end="train"
    )
    return _tagged(train, evaluation)


@query(
    "coerce_dates",
    """
select c_custkey, try_strptime(case when c_nationkey = 3 then c_name else
         '19' || lpad(cast(c_custkey % 90 + 10 as string), 2, '0') || '-' || lpad(cast(c_nationkey % 14 + 1 as string), 2, '0')
         || '-15' end, '%Y-%m-%d') as born
from customer
""",
)
def dates(spark, d):
    """Text that is no date, or a 13th month, becomes null."""
    text = """
    select c_custkey, case when c_nationkey = 3 then c_name else
      '19' || lpad(cast(c_custkey % 90 + 10 as string), 2, '0') || '-' || lpad(cast(c_nationkey % 14 + 1 as string), 2, '0')
      || '-15' end as born
    from {customer}
    """
    out = coerce_dates(select(spark, d, text), ["born"], "yyyy-MM-dd")
    return out.withColumn("born", F.col("born").cast("timestamp_ntz"))
