"""Hold-out labels, metrics, votes and other label work."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.columns import differs, not_in_keep_null
from ledgerlens.ml.purchase import one_hot_labels, soft_vote, type_rows
from ledgerlens.operators.periods import holdout_labels, split_by_period
from ledgerlens.operators.stats import (
    binary_metrics, class_report, class_weight_table, confusion, value_counts,
)
from ledgerlens.plans.extract import label_next_purchase
from ledgerlens.plans.settings import EXCLUDED_TYPES, PROPERTY_TYPES

from .registry import query, select, table
from .sequences import SALES, SALES_SQL

START, END = "2000-03-01", "2000-12-31"
HOLDOUT_SQL = f"""
with s as ({SALES_SQL}), e as (
  select customer, arg_max(phase_property_type, struct_pack(t := spa_date, id := sales_id)) as kind
  from s where spa_date between timestamp '{START}' and timestamp '{END}' group by customer
), l as (
  select *, row_number() over (partition by customer order by spa_date desc, sales_id desc) as rn
  from s where spa_date < timestamp '{START}'
)
"""


def _holdout(spark, d):
    train, evaluation, _ = split_by_period(select(spark, d, SALES), "spa_date", START, END)
    train = label_next_purchase(train, "customer")
    return holdout_labels(
        train, evaluation, "customer", "phase_property_type", ["spa_date", "sales_id"],
        exclude=EXCLUDED_TYPES,
    )


@query(
    "holdout_label",
    HOLDOUT_SQL
    + "select sales_id, customer, cast(customer in (select customer from e) as int) as label from l where rn = 1",
)
def holdout(spark, d):
    return _holdout(spark, d)[0].select("sales_id", "customer", "label")


@query(
    "holdout_next_type",
    HOLDOUT_SQL
    + """select sales_id, l.customer, e.kind as repeat_phase_property_type from l join e on l.customer = e.customer
         where rn = 1 and e.kind not in ('RSKU', 'Industrial')""",
)
def holdout_type(spark, d):
    return _holdout(spark, d)[1].select("sales_id", "customer", "repeat_phase_property_type")


KINDS = """
select o_orderkey, nullif(o_orderstatus, 'F') as status, nullif(o_orderpriority, '3-MEDIUM') as priority from {orders}
"""


@query(
    "not_in_keep_null",
    """select o_orderkey, nullif(o_orderpriority, '3-MEDIUM') as priority from orders
       where o_orderpriority not in ('1-URGENT', '5-LOW')""",
)
def keep_null(spark, d):
    rows = select(spark, d, KINDS).select("o_orderkey", "priority")
    return rows.where(not_in_keep_null(F.col("priority"), ["1-URGENT", "5-LOW"]))


@query(
    "differs_keep_null",
    """select o_orderkey, nullif(o_orderstatus, 'F') as status from orders where o_orderstatus <> 'O'""",
)
def differs_keep_null(spark, d):
    return select(spark, d, KINDS).select("o_orderkey", "status").where(differs(F.col("status"), "O"))


@query(
    "one_hot_labels",
    f"""
select sales_id, cast(phase_property_type = 'Landed' as int) as landed,
       cast(phase_property_type = 'High Rise' as int) as high_rise,
       cast(phase_property_type = 'Commercial' as int) as commercial
from ({SALES_SQL})
""",
)
def one_hot(spark, d):
    out = one_hot_labels(select(spark, d, SALES), "phase_property_type", PROPERTY_TYPES)
    return out.select("sales_id", *PROPERTY_TYPES)


@query(
    "type_rows",
    f"""
with n as (select sales_id, lead(phase_property_type) over (partition by customer order by spa_date, sales_id) as kind
           from ({SALES_SQL}))
select sales_id, kind as repeat_phase_property_type from n where kind not in ('RSKU', 'Industrial')
""",
)
def types(spark, d):
    """Rows the property-type models train on."""
    rows = type_rows(label_next_purchase(select(spark, d, SALES), "customer"))
    return rows.select("sales_id", "repeat_phase_property_type")


@query("value_counts", "select o_orderpriority, count(*) as n from orders group by 1")
def counts(spark, d):
    return value_counts(table(spark, d, "orders"), "o_orderpriority")


@query(
    "class_weights",
    """
with c as (select quality, count(*) as n from labels group by quality)
select quality, n, (select sum(n) from c) / ((select count(*) from c) * cast(n as double)) as weight from c
""",
)
def weights(spark, d):
    return class_weight_table(table(spark, d, "labels"), "quality")


CONFUSION_SQL = """
select count(*) filter (quality = 1 and toxic = 1) as tp, count(*) filter (quality = 0 and toxic = 0) as tn,
       count(*) filter (quality = 0 and toxic = 1) as fp, count(*) filter (quality = 1 and toxic = 0) as fn
from labels
"""


@query("confusion", CONFUSION_SQL)
def confusion_counts(spark, d):
    return confusion(table(spark, d, "labels"), "quality", "toxic")


@query(
    "binary_metrics",
    f"""
with c as ({CONFUSION_SQL})
select tp, tn, fp, fn, round((tp + tn) / (tp + tn + fp + fn), 4) as accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 4) as precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 4) as recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) as f1
from c
""",
)
def metrics(spark, d):
    return binary_metrics(table(spark, d, "labels"), "quality", "toxic")


@query(
    "class_report",
    """
with c as (select x as class, count(*) filter (quality = x and toxic = x) as hits,
                  count(*) filter (quality = x) as support, count(*) filter (toxic = x) as called
           from labels, (values (0), (1)) v(x) group by x),
m as (select cast(class as string) as class, coalesce(hits / nullif(called, 0), 0) as precision,
             coalesce(hits / nullif(support, 0), 0) as recall,
             coalesce(2 * hits / nullif(called + support, 0), 0) as f1, hits, support from c),
r as (
  select class, precision, recall, f1, support from m
  union all select 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) from m
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from m
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) from m)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support from r
""",
)
def report(spark, d):
    out = class_report(table(spark, d, "labels"), "quality", "toxic")
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "soft_vote",
    """
with p as (select l_orderkey, l_linenumber, l_partkey, l_discount * 10 as p1, l_tax * 12 as p2, l_quantity / 50 as p3 from lineitem)
select l_orderkey, l_linenumber, l_partkey, (p1 + p2 + p3) / 3 as probability,
       cast((p1 + p2 + p3) / 3 >= 0.6 as int) as "predicted label" from p
""",
)
def voted(spark, d):
    parts = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount * 10 as p1", "l_tax * 12 as p2",
        "l_quantity / 50 as p3",
    )
    return soft_vote(parts, ["p1", "p2", "p3"], 0.6).drop("p1", "p2", "p3")
