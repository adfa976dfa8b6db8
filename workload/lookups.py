"""Overrides, mappings, ranges and group values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.columns import within_tolerance
from ledgerlens.operators.lookup import (
    attach_range, duplicate_keys, flag_member, last_value_per_key, map_values, override_first,
    override_where, unmapped_values, upsert_mapping,
)
from ledgerlens.plans.features import GROUPS, completion, group_values, maturity, years_since_first

from .registry import plain, query, select, table

OVERRIDES = "select s_suppkey as c_custkey, nullif(s_name, 'Supplier#000000007') as name from {supplier}"
SEGMENTS = "select c_custkey, nullif(c_mktsegment, 'MACHINERY') as segment from {customer}"


@query(
    "override_where",
    f"""select c.c_custkey, case when segment = 'BUILDING' then o.name else segment end as segment
        from ({plain(SEGMENTS)}) c left join ({plain(OVERRIDES)}) o on c.c_custkey = o.c_custkey""",
)
def override_undefined(spark, d):
    """The override replaces one value only, and gives null where it has no row."""
    rows, lookup = select(spark, d, SEGMENTS), select(spark, d, OVERRIDES)
    return override_where(rows, lookup, "c_custkey", "segment", "name", F.col("segment") == "BUILDING")


@query(
    "override_first",
    f"""select c.c_custkey, coalesce(o.name, segment) as segment
        from ({plain(SEGMENTS)}) c left join ({plain(OVERRIDES)}) o on c.c_custkey = o.c_custkey""",
)
def override_wins(spark, d):
    return override_first(
        select(spark, d, SEGMENTS), select(spark, d, OVERRIDES), "c_custkey", "segment", "name"
    )


MAPPING = """
select n_name as raw, upper(n_name) as clean, cast(n_nationkey as double) as cnt, nullif(r_name, 'REGION_4') as target
from {nation} join {region} on n_regionkey = r_regionkey
"""
PLACES = """
select c_custkey, case when c_custkey % 11 = 0 then 'Elsewhere' when c_custkey % 13 = 0 then null
       else '  ' || lower(n_name) || ' ' end as place
from {customer} join {nation} on c_nationkey = n_nationkey
"""
MAP_SQL = f"""
with m as ({plain(MAPPING)}), p as (select *, upper(trim(place)) as k from ({plain(PLACES)}))
"""


@query(
    "map_values",
    MAP_SQL + "select c_custkey, place, coalesce(target, 'UNKNOWN') as grouped from p left join m on k = clean",
)
def mapped(spark, d):
    return map_values(
        select(spark, d, PLACES), "place", select(spark, d, MAPPING), "clean", "target", "grouped"
    )


@query(
    "unmapped_values",
    MAP_SQL + """select k as value, count(*) as n from p
                 where k is null or k not in (select clean from m where target is not null) group by k""",
)
def unmapped(spark, d):
    return unmapped_values(select(spark, d, PLACES), "place", select(spark, d, MAPPING), "clean", "target")


@query(
    "duplicate_keys",
    "select p_partkey, p_name from part where p_name in (select p_name from part group by p_name having count(*) > 1)",
)
def duplicates(spark, d):
    return duplicate_keys(table(spark, d, "part").select("p_partkey", "p_name"), "p_name")


# every grouped column, the mapping of its name, and whether that mapping's key is normalised
GROUPED = """
select c_custkey, case c_custkey % 3 when 0 then 'REG NO.' else 'NRIC NO.' end as derived_contact_identification_type,
  c_mktsegment as derived_contact_salutation, lower(n_name) as derived_nationality, c_mktsegment as derived_contact_occupation,
  n_name || ' ' as derived_financier_name, nullif(n_name, 'FRANCE') as derived_race, n_name as derived_contact_city,
  n_name as derived_contact_annual_income
from {customer} join {nation} on c_nationkey = n_nationkey
"""
KEYS = """
select n_name as raw, case when n_nationkey % 3 = 0 then lower(n_name) else n_name end as clean, 1.0e0 as cnt,
  case when n_nationkey % 5 = 0 then null else r_name end as target
from {nation} join {region} on n_regionkey = r_regionkey
union all select distinct c_mktsegment, ' ' || lower(c_mktsegment), 1.0e0, 'SEGMENT ' || c_mktsegment from {customer}
"""


def _grouped_sql() -> str:
    parts = []
    for column, _, target, normalised in GROUPS:
        key = "upper(trim(clean))" if normalised else "clean"
        value = f"coalesce((select min(target) from m where {key} = upper(trim({column}))), 'UNKNOWN')"
        if target == "group_derived_contact_annual_income":
            value = f"case when derived_contact_identification_type = 'REG NO.' then 'NOT APPLICABLE' else {value} end"
        parts.append(f"{value} as {target}")
    return f"with m as ({plain(KEYS)}), p as ({plain(GROUPED)}) select c_custkey, {', '.join(parts)} from p"


def _group(spark, d):
    return group_values(select(spark, d, GROUPED), {name: select(spark, d, KEYS) for _, name, _, _ in GROUPS})


@query("group_values", _grouped_sql())
def grouped_values(spark, d):
    """All seven groupings; keys are taken as they are but for the salutation, companies have no income."""
    return _group(spark, d)[0].select("c_custkey", *[target for _, _, target, _ in GROUPS])


@query(
    "group_report",
    f"with m as ({plain(KEYS)}), p as ({plain(GROUPED)}) " + " union all ".join(
        f"""select 'group' as stage, '{column}' as "column", 'no mapping target' as issue, upper(trim({column})) as value, count(*) as n
            from p where upper(trim({column})) is null or upper(trim({column})) not in
              (select {"upper(trim(clean))" if normalised else "clean"} from m where target is not null) group by 4"""
        for column, _, _, normalised in GROUPS
    ),
)
def group_report(spark, d):
    """Values without a target, of all columns in one pass."""
    return _group(spark, d)[1]


CHANGES = """
select '  ' || lower(s_name) || ' ' as clean, 'moved ' as target from {supplier}
union all select lower(n_name), 'new ' || n_name from {nation} where n_regionkey = 1
"""


@query(
    "upsert_mapping",
    f"""
with m as ({plain(MAPPING)}), c as (select upper(trim(clean)) as clean, upper(trim(target)) as target from ({plain(CHANGES)}))
select raw, clean, cnt, target from m where clean not in (select clean from c)
union all select null, clean, null, target from c
""",
)
def upsert(spark, d):
    return upsert_mapping(select(spark, d, MAPPING), select(spark, d, CHANGES), "clean", "target")


LIMITS = """
select p_brand as brand, p_type as kind, min(p_retailprice) as low, max(p_retailprice) as high
from {part} where p_size > 25 group by p_brand, p_type
"""
PRICED = """
select l_orderkey, l_linenumber, l_partkey, p_brand as brand, p_type as kind, l_extendedprice / l_quantity as unit
from {lineitem} join {part} on l_partkey = p_partkey
"""


@query(
    "range_validate",
    f"""
select l_orderkey, l_linenumber, l_partkey, r.low is not null as matched,
       coalesce(unit >= low * (1 - 0.2e0) and unit <= high * (1 + 0.2e0), false) as inside
from ({plain(PRICED)}) x left join ({plain(LIMITS)}) r on x.brand = r.brand and x.kind = r.kind
""",
)
def ranges(spark, d):
    out = attach_range(
        select(spark, d, PRICED), select(spark, d, LIMITS), ["brand", "kind"], ["low", "high"]
    )
    inside = within_tolerance(F.col("unit"), F.col("low"), F.col("high"))
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("_matched").alias("matched"),
        F.coalesce(inside, F.lit(False)).alias("inside"),
    )


PROJECT_SALES = """
select o_orderkey, case when c_nationkey % 7 = 3 then null else n_name end as project, o_orderstatus as phase,
       case when o_custkey % 5 = 0 then o_orderdate + interval '6' year
            when o_custkey % 5 = 1 then o_orderdate + interval '12' year else o_orderdate end as sold,
       case o_orderpriority when '1-URGENT' then 'LANDED' when '2-HIGH' then 'HIGH RISE'
            when '3-MEDIUM' then 'COMMERCIAL' when '4-NOT SPECIFIED' then 'RSKU' else 'OTHER' end as kind
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""


@query(
    "group_min_maturity",
    f"""
with s as ({plain(PROJECT_SALES)}), g as (select project, year(min(sold)) as y from s where project is not null group by project)
select o_orderkey, case when year(sold) - y < 5 then 'NEW' when year(sold) - y between 5 and 10 then 'DEVELOPING'
       else 'MATURED' end as maturity
from s left join g on s.project = g.project
""",
)
def township(spark, d):
    out = years_since_first(select(spark, d, PROJECT_SALES), "project", "sold", "years")
    return out.select("o_orderkey", maturity(F.col("years")).alias("maturity"))


@query(
    "completion_status",
    f"""
with s as ({plain(PROJECT_SALES)}), g as (select phase, year(min(sold)) as y from s group by phase)
select o_orderkey, case when kind in ('LANDED', 'RSKU') then case when year(sold) - y < 3 then 'IN PROGRESS' else 'COMPLETED' end
       when kind = 'HIGH RISE' then case when year(sold) - y < 4 then 'IN PROGRESS' else 'COMPLETED' end
       when kind in ('COMMERCIAL', 'INDUSTRIAL') then case when year(sold) - y < 2 then 'IN PROGRESS' else 'COMPLETED' end
       else 'UNKNOWN' end as status
from s join g on s.phase = g.phase
""",
)
def phase_status(spark, d):
    out = years_since_first(select(spark, d, PROJECT_SALES), "phase", "sold", "years")
    return out.select("o_orderkey", completion(F.col("kind"), F.col("years")).alias("status"))


@query(
    "flag_member",
    "select c_custkey, cast(c_custkey in (select o_custkey from orders where o_orderdate >= timestamp '2001-01-01') as int) as active from customer",
)
def member(spark, d):
    recent = table(spark, d, "orders").where("o_orderdate >= timestamp_ntz '2001-01-01'")
    customers = table(spark, d, "customer").select("c_custkey")
    return flag_member(customers, recent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "active")


@query(
    "last_value_per_key",
    """select o_custkey, arg_max(o_orderpriority, struct_pack(t := o_orderdate, id := o_orderkey)) as last_priority
       from orders group by o_custkey""",
)
def last_value(spark, d):
    return last_value_per_key(
        table(spark, d, "orders"), "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"], "last_priority"
    )
