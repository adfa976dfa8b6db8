"""Cleaning rules. One input view, stated once, feeds both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.columns import (
    at_least, is_sentinel, parity_value, ratio_band, safe_ratio, strip_upper, whole_days,
)
from ledgerlens.operators.quality import drop_nulls, drop_report, removed_report
from ledgerlens.operators.stats import distinct_values, mean_value, mode_value, null_counts
from ledgerlens.plans import clean as rules
from ledgerlens.plans.clean import clean_area
from ledgerlens.sources.tables import normalise_na

from .registry import plain, query, select, table

# The sentinels and area constants in the SQL of this module are those of the rules.
PEOPLE = """
select c_custkey,
  case c_custkey % 7 when 0 then 'Undefined' when 1 then ' nric no. ' when 2 then 'Passport' when 3 then 'REG NO'
       when 4 then 'Others' when 5 then 'Reg No.' end as id_text,
  case c_nationkey % 4 when 0 then 'Corporate' when 1 then 'Individual' when 2 then 'Undefined' end as purchaser,
  case c_custkey % 3 when 0 then 'REG NO.' when 1 then 'NRIC NO.' else 'PASSPORT' end as id_type,
  case c_mktsegment when 'BUILDING' then 'Male' when 'MACHINERY' then 'female' when 'FURNITURE' then 'Undefined'
       when 'HOUSEHOLD' then ' others ' end as gender,
  case c_nationkey % 5 when 0 then 'Female' when 1 then '-' when 2 then 'Not Applicable' when 3 then 'male' end as contact_gender,
  case when c_custkey % 4 = 0 then c_name || 'X' else c_name end as nric,
  case c_nationkey % 6 when 0 then 'Mr' when 1 then 'Dato' when 2 then 'Undefined' when 3 then '-' when 4 then 'Others' end as salutation,
  case when c_nationkey < 6 then 'Malaysia ' when c_nationkey < 10 then 'Undefined' when c_nationkey < 14 then 'others'
       when c_nationkey < 16 then null else n_name end as nation,
  case c_custkey % 5 when 0 then '-' when 1 then 'Others' when 2 then 'Singapore' when 3 then 'undefined ' else n_name end as contact_nation,
  case when c_custkey % 6 = 0 then null else cast(floor(c_acctbal / 100) as int) end as age,
  case when c_custkey % 4 = 1 then null else date '1950-06-01' + cast(c_custkey % 20000 as int) end as born,
  date '1999-03-01' as sold,
  case c_custkey % 4 when 0 then 'Loan' when 1 then 'Cash' when 2 then ' loan ' end as cash,
  case when c_nationkey % 3 = 0 then null else 'Bank ' || n_name end as bank,
  case c_nationkey % 5 when 0 then 'Chinese' when 1 then 'N/A' when 2 then 'Others' when 3 then 'undefined' end as race,
  case c_custkey % 4 when 0 then 'Indian' when 1 then 'N/A' when 2 then ' others' end as contact_race,
  case c_custkey % 3 when 0 then 'Others' when 1 then 'Malay' end as race_group,
  case c_custkey % 3 when 0 then 'Undefined' when 1 then 'Staff' end as staff,
  case c_nationkey % 4 when 0 then 'Not Applicable' when 1 then '-' when 2 then 'Undefined' else 'rm' || cast(c_nationkey as string) end as income
from {customer} join {nation} on c_nationkey = n_nationkey
"""
P = f"with p as ({plain(PEOPLE)}) "
c = F.col


def _people(spark, d):
    return select(spark, d, PEOPLE)


def _rule(name, expression, sql, out="derived"):
    @query(name, P + f"select c_custkey, {sql} as {out} from p")
    def run(spark, d):
        return _people(spark, d).select("c_custkey", expression().alias(out))

    return run


_rule(
    "id_type_rule",
    lambda: rules.id_type_rule(c("id_text"), c("purchaser"), c("nation")),
    """case when (case when id_text is null or upper(trim(id_text)) = 'OTHERS' then
         case when purchaser = 'Corporate' then 'REG NO.'
              when purchaser in ('Individual', 'Undefined') then
                case when upper(trim(nation)) = 'MALAYSIA' then 'NRIC NO.' else 'PASSPORT' end
              else upper(trim(id_text)) end
       else upper(trim(id_text)) end) = 'REG NO' then 'REG NO.'
       else (case when id_text is null or upper(trim(id_text)) = 'OTHERS' then
         case when purchaser = 'Corporate' then 'REG NO.'
              when purchaser in ('Individual', 'Undefined') then
                case when upper(trim(nation)) = 'MALAYSIA' then 'NRIC NO.' else 'PASSPORT' end
              else upper(trim(id_text)) end
       else upper(trim(id_text)) end) end""",
)
_rule(
    "salutation_rule",
    lambda: rules.salutation_rule(c("id_type"), c("salutation"), F.upper("gender")),
    """case when id_type = 'REG NO.' then 'NOT APPLICABLE'
            when (salutation is null or salutation in ('Not Applicable', 'Undefined', 'Others', '-'))
              and id_type in ('NRIC NO.', 'PASSPORT') and upper(gender) = 'MALE' then 'MR'
            when (salutation is null or salutation in ('Not Applicable', 'Undefined', 'Others', '-'))
              and id_type in ('NRIC NO.', 'PASSPORT') and upper(gender) = 'FEMALE' then 'MS'
            else upper(coalesce(salutation, 'nan')) end""",
)
_rule(
    "purchaser_rule",
    lambda: rules.purchaser_rule(strip_upper(c("id_text"))),
    """case when upper(trim(id_text)) in ('NRIC NO.', 'PASSPORT') then 'INDIVIDUAL'
            when upper(trim(id_text)) = 'REG NO.' then 'CORPORATE' end""",
)
_rule(
    "nationality_rule",
    lambda: F.coalesce(rules.nationality_rule(c("nation"), c("contact_nation")), F.lit("OTHERS")),
    """coalesce(case when upper(trim(nation)) in ('UNDEFINED', 'OTHERS')
          and upper(trim(contact_nation)) not in ('UNDEFINED', 'OTHERS', '-') then contact_nation else nation end, 'OTHERS')""",
)
CASH = "case when bank is null and upper(trim(cash)) = 'LOAN' then 'CASH' else upper(cash) end"
_rule("cash_rule", lambda: rules.cash_rule(c("cash"), c("bank")), CASH)
_rule(
    "financier_rule",
    lambda: rules.financier_rule(rules.cash_rule(c("cash"), c("bank")), c("bank")),
    f"case when ({CASH}) = 'CASH' then 'CASH' else coalesce(upper(bank), 'NOT APPLICABLE') end",
)
_rule(
    "race_rule",
    lambda: rules.race_rule(c("id_type"), c("race"), c("contact_race"), c("race_group")),
    """case when id_type = 'REG NO.' then 'NOT APPLICABLE' when race is null then 'OTHERS'
            when upper(trim(race)) not in ('N/A', 'OTHERS', 'UNDEFINED') then upper(race)
            when contact_race is null then 'OTHERS'
            when upper(trim(contact_race)) not in ('N/A', 'OTHERS', 'UNDEFINED') then upper(contact_race)
            when upper(trim(race_group)) not in ('N/A', 'OTHERS', 'UNDEFINED') then upper(race_group)
            else 'OTHERS' end""",
)
_rule(
    "staff_rule",
    lambda: rules.status_rule(c("id_type"), c("staff"), "Undefined", "Not Staff", fill_null=False),
    """case when id_type = 'REG NO.' then 'NOT APPLICABLE' when staff = 'Undefined' then 'NOT STAFF' else upper(staff) end""",
)
_rule(
    "lifestyle_rule",
    lambda: rules.status_rule(c("id_type"), c("staff"), "Undefined", "Non-Registered", fill_null=True),
    """case when id_type = 'REG NO.' then 'NOT APPLICABLE'
            when staff is null or staff = 'Undefined' then 'NON-REGISTERED' else upper(staff) end""",
)
_rule(
    "strip_upper_sentinel",
    lambda: F.when(is_sentinel(c("gender"), rules.NO_GENDER), None).otherwise(strip_upper(c("gender"))),
    """case when upper(trim(gender)) not in ('UNDEFINED', 'NOT APPLICABLE', 'OTHERS', '-') then upper(trim(gender)) end""",
)

MODE = "(select upper({c}) from (select {c}, count(*) as n from p where {c} is not null group by {c}) order by n desc, {c} limit 1)"


@query(
    "gender_rule",
    P + f"""
select c_custkey, case when id_type = 'REG NO.' then 'NOT APPLICABLE'
  when upper(trim(gender)) not in ('UNDEFINED', 'NOT APPLICABLE', 'OTHERS', '-') then upper(gender)
  when upper(trim(contact_gender)) not in ('UNDEFINED', 'NOT APPLICABLE', 'OTHERS', '-') then upper(contact_gender)
  when right(nric, 1) in ('1', '3', '5', '7', '9') then 'MALE'
  when right(nric, 1) in ('0', '2', '4', '6', '8') then 'FEMALE'
  else {MODE.format(c='gender')} end as derived
from p
""",
)
def gender(spark, d):
    p = _people(spark, d)
    rule = rules.gender_rule(
        c("id_type"), c("gender"), c("contact_gender"), c("nric"), mode_value(p, "gender")
    )
    return p.select("c_custkey", rule.alias("derived"))


@query(
    "marital_rule",
    P + f"""
select c_custkey, case when id_text = 'Reg No.' then 'NOT APPLICABLE'
  when id_type = 'REG NO.' then {MODE.format(c='salutation')}
  when upper(trim(salutation)) not in ('UNDEFINED', 'NOT APPLICABLE', 'OTHER', '-') then upper(salutation)
  when upper(trim(contact_gender)) not in ('UNDEFINED', 'NOT APPLICABLE', 'OTHER', '-') then upper(contact_gender)
  else {MODE.format(c='salutation')} end as derived
from p
""",
)
def marital(spark, d):
    """Ids that are neither person nor company take the mode."""
    p = _people(spark, d)
    kind = F.when(c("id_text") == "Reg No.", "REG NO.").when(c("id_type") == "REG NO.", "OTHER").otherwise(c("id_type"))
    rule = rules.marital_rule(kind, c("salutation"), c("contact_gender"), mode_value(p, "salutation"))
    return p.select("c_custkey", rule.alias("derived"))


@query(
    "age_rule",
    P + """, m as (select avg(age) as mean from p where id_type <> 'REG NO.'),
a as (select c_custkey, id_type, mean, case when born is not null then cast(year(sold) - year(born) as double)
        else coalesce(cast(age as double), mean) end as age from p, m)
select c_custkey, round(case when id_type = 'REG NO.' then -1 when age <= 0 then mean else age end, 4) as derived from a
""",
)
def age(spark, d):
    p = _people(spark, d)
    mean = mean_value(p, "age", c("id_type") != rules.COMPANY)
    rule = rules.age_rule(c("id_type"), c("sold"), c("born"), c("age"), mean)
    return p.select("c_custkey", F.round(rule, 4).alias("derived"))


@query(
    "income_rule",
    P + f"""
select c_custkey, case when income is null or income in ('Not Applicable', 'Undefined', '-')
  then {MODE.format(c='income')} else upper(income) end as derived from p
""",
)
def income(spark, d):
    p = _people(spark, d)
    return p.select("c_custkey", rules.income_rule(c("income"), mode_value(p, "income")).alias("derived"))


@query(
    "mode_value",
    P + "select salutation as value, count(*) as n from p where salutation is not null group by 1 order by n desc, 1 limit 1",
)
def mode(spark, d):
    p = _people(spark, d)
    value = mode_value(p, "salutation")
    return p.where(c("salutation") == value).groupBy(c("salutation").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "fill_zero",
    "select l_orderkey, l_linenumber, l_partkey, " + ", ".join(
        f"case when l_returnflag = 'A' or l_linenumber = {i} then 0 else l_extendedprice end as derived_{p}"
        for i, p in enumerate(rules.FILLED_PRICES, start=1)
    ) + " from lineitem",
)
def fill_zero(spark, d):
    """The price rule of the cleaning: null and NaN become 0."""
    prices = ", ".join(
        f"case when l_returnflag = 'A' then null when l_linenumber = {i} then cast('NaN' as double) else l_extendedprice end as {p}"
        for i, p in enumerate(rules.FILLED_PRICES, start=1)
    )
    rows = select(spark, d, f"select l_orderkey, l_linenumber, l_partkey, {prices} from {{lineitem}}")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[v.alias(n) for n, v in rules.filled_prices().items()])


@query(
    "upper_rules",
    """select c_custkey, upper(case when c_custkey % 40 = 0 then null else 'Bumi ' || c_mktsegment end) as derived_bumi_status,
              upper(c_mktsegment) as derived_contact_occupation, '\u00a0' || upper(c_name) as derived_build_type,
              upper(case c_custkey % 3 when 0 then 'Landed' when 1 then 'High Rise' end) as derived_phase_property_type
       from customer""",
)
def upper_rules(spark, d):
    """The rules that only change case; blanks of every kind go from an occupation alone."""
    rows = select(
        spark, d,
        """select c_custkey, case when c_custkey % 40 = 0 then null else 'Bumi ' || c_mktsegment end as customer_bumi_status,
                  '\u00a0\t' || lower(c_mktsegment) || '\u3000 ' as contact_occupation, '\u00a0' || c_name as build_type,
                  case c_custkey % 3 when 0 then 'Landed' when 1 then 'High Rise' end as phase_property_type
           from {customer}""",
    )
    return rows.select("c_custkey", *[v.alias(n) for n, v in rules.upper_columns().items()])


AMOUNTS = """
select l_orderkey, l_linenumber, l_partkey, case when l_tax = 0.02 then null when l_tax = 0.04 then -l_discount else l_discount end as rebate,
       case when l_linenumber = 1 then 0.0 else l_quantity / 20 end as price
from {lineitem}
"""
RATIO = """case when price = 0 then case when rebate > 0 then cast('infinity' as double) when rebate < 0 then cast('-infinity' as double) end
           else rebate / price end"""


@query(
    "ratio_safe",
    f"select l_orderkey, l_linenumber, l_partkey, {RATIO} as ratio from ({plain(AMOUNTS)})",
)
def ratio(spark, d):
    return select(spark, d, AMOUNTS).select(
        "l_orderkey", "l_linenumber", "l_partkey", safe_ratio(c("rebate"), c("price")).alias("ratio")
    )


@query(
    "ratio_band",
    f"""with r as (select l_orderkey, l_linenumber, l_partkey, {RATIO} as ratio from ({plain(AMOUNTS)}))
select l_orderkey, l_linenumber, l_partkey, case when ratio = 0 then 'NO REBATE' when ratio > 0 and ratio < 0.1 then '< 10% REBATE'
       when ratio >= 0.1 then '> 10% REBATE' end as band from r""",
)
def band(spark, d):
    return select(spark, d, AMOUNTS).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        ratio_band(safe_ratio(c("rebate"), c("price"))).alias("band"),
    )


CHECKED = ["id_text", "gender", "salutation", "nation", "bank"]


@query(
    "null_counts",
    P + " union all ".join(
        f"select '{x}' as \"column\", count(*) filter ({x} is null) as n_null from p" for x in CHECKED
    ),
)
def nulls(spark, d):
    return null_counts(_people(spark, d), CHECKED)


@query("drop_nulls", P + "select c_custkey from p where " + " and ".join(f"{x} is not null" for x in CHECKED))
def dropped(spark, d):
    return drop_nulls(_people(spark, d), CHECKED).select("c_custkey")


@query(
    "drop_report",
    P + "select 'clean' as stage, f as \"column\", 'null rows removed' as issue, cast(null as string) as value, count(*) as n from (select case "
    + " ".join(f"when {x} is null then '{x}'" for x in CHECKED) + " end as f from p) where f is not null group by f",
)
def report(spark, d):
    return drop_report(_people(spark, d), CHECKED, "clean")


@query(
    "normalise_na",
    """select c_custkey, case when c_nationkey % 3 in (0, 1) then null else 'NOT APPLICABLE' end as text,
              case when c_custkey % 2 = 0 then null else c_acctbal end as amount from customer""",
)
def tokens(spark, d):
    rows = select(
        spark, d,
        """select c_custkey, case c_nationkey % 3 when 0 then 'N/A' when 1 then 'null' else 'NOT APPLICABLE' end as text,
           case when c_custkey % 2 = 0 then cast('NaN' as double) else c_acctbal end as amount from {customer}""",
    )
    return normalise_na(rows)


AREA_RANGES = """
select p_brand as project_name, p_type as phase, split_part(p_name, ' ', 2) as build_type,
       min(p_retailprice) as min_area_transformed_to_sqft, max(p_retailprice) as max_area_transformed_to_sqft,
       sqrt(max(p_retailprice)) * 30 as mean_sqft,
       min(p_retailprice) / 10.7639e0 as min_area_transformed_to_sqm, max(p_retailprice) / 10.7639e0 as max_area_transformed_to_sqm
from {part} where p_size > 25 and split_part(p_name, ' ', 2) <> 'gear' group by 1, 2, 3
"""
AREAS = """
select l_orderkey, l_linenumber, l_partkey, p_brand as project_name, p_type as phase,
       ' ' || upper(split_part(p_name, ' ', 2)) as build_type,
       case when l_linenumber % 3 = 0 then null when l_linenumber % 3 = 1 then 0.0 else sqrt(l_extendedprice) * 4 end as built_up_area_sqft,
       case when l_returnflag = 'A' then null when l_returnflag = 'R' then sqrt(l_extendedprice) * 5 else sqrt(p_retailprice) * 3 end as built_up_area_sqm,
       case when l_linestatus = 'F' then sqrt(l_extendedprice) * 6 else 0.0 end as land_area_sqft,
       case when l_quantity > 25 then sqrt(l_extendedprice) * l_quantity / 4 end as land_area_sqm
from {lineitem} join {part} on l_partkey = p_partkey
"""
AREA_SQL = f"""
with r as (select *, upper(trim(build_type)) as b from ({plain(AREA_RANGES)})),
x as (select a.*, upper(trim(a.build_type)) as b, r.b is not null as matched, r.min_area_transformed_to_sqft as lo,
        r.max_area_transformed_to_sqft as hi, r.mean_sqft as mean, r.min_area_transformed_to_sqm as lom,
        r.max_area_transformed_to_sqm as him, built_up_area_sqft as s, built_up_area_sqm as m, land_area_sqft as ls, land_area_sqm as lm
      from ({plain(AREAS)}) a left join r
        on a.project_name = r.project_name and a.phase = r.phase and upper(trim(a.build_type)) = r.b),
y as (select *, case when matched then case
        when s > 0 then case when s >= lo * (1 - 0.2e0) and s <= hi * (1 + 0.2e0) then s else s * 0.092903e0 end
        when m > 0 then case when m >= lom * (1 - 0.2e0) and m <= him * (1 + 0.2e0) then m * 10.7639e0 else m end
        when mean > 0 then mean end end as v from x),
g as (select b, avg(v) as gm from y where matched group by b),
z as (select y.*, gm, case when matched then v when gm is not null then gm when s >= 250 then s
        when m > 0 then case when m <= 1000 then m * 10.7639e0 else m end
        when ls > 0 then case when ls >= 1000 then ls else ls * 10.7639e0 end
        when lm > 0 then case when lm >= 1500 then lm else lm * 0.092903e0 end end as a1
      from y left join g on y.b = g.b),
q as (select *, case when a1 is null or a1 = 0 then coalesce(gm, a1) else a1 end as a2 from z)
select l_orderkey, l_linenumber, l_partkey,
       round(case when a2 > 0 and a2 < 200 then coalesce(gm, a2 * 10.7639e0) else a2 end, 4) as area
from q
"""


@query("area_cascade", AREA_SQL)
def area(spark, d):
    out = clean_area(select(spark, d, AREAS), select(spark, d, AREA_RANGES), out="area")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("area", 4).alias("area"))


@query(
    "whole_days",
    """select o_orderkey, cast(floor(epoch(timestamp '2001-08-02 06:00:00' - o_orderdate) / 86400) as bigint) as days from orders""",
)
def days(spark, d):
    end = F.lit("2001-08-02 06:00:00").cast("timestamp_ntz")
    return table(spark, d, "orders").select("o_orderkey", whole_days(end, c("o_orderdate")).alias("days"))


@query("distinct_values", "select distinct o_orderpriority from orders")
def distinct(spark, d):
    return distinct_values(table(spark, d, "orders"), "o_orderpriority")


@query(
    "removed_report",
    P + """select 'x' as stage, cast(null as string) as "column", 'removed' as issue, cast(null as string) as value,
                  count(*) - count(nation) as n from p""",
)
def removed(spark, d):
    p = _people(spark, d)
    return removed_report(p, p.where("nation is not null"), "x", "removed")


@query(
    "parity_value",
    P + """select c_custkey, case when right(nric, 1) in ('1', '3', '5', '7', '9') then 'odd'
                  when right(nric, 1) in ('0', '2', '4', '6', '8') then 'even' end as parity from p""",
)
def parity(spark, d):
    return _people(spark, d).select("c_custkey", parity_value(c("nric"), "odd", "even").alias("parity"))


@query(
    "class_threshold",
    "select l_orderkey, l_linenumber, l_partkey, cast(l_discount >= 0.05 as int) as predicted from lineitem",
)
def threshold(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", at_least(c("l_discount"), 0.05).alias("predicted")
    )
