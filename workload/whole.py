"""The whole preparation on a sales table made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.ml.encode import FEATURES, encode, feature_names, fit_encoder
from ledgerlens.plans.prepare import prepare
from ledgerlens.plans.settings import Lookups, Preparation
from pyspark.ml.functions import vector_to_array

from .registry import plain, query, select

RAW = """
select o_orderkey as sales_id, cast(o_custkey as string) as contact_nric_masked,
  case when n_regionkey = 4 and c_custkey % 3 = 0 then 'Singapore' else 'Malaysia' end as project_country,
  case when o_orderstatus = 'P' and o_orderkey % 5 = 0 then 'Cancelled' else 'Sold' end as last_sales_status,
  v.date_type, o_orderdate as transaction_date, o_orderdate as commencement_date, o_orderdate as completion_date,
  o_orderdate + interval '3' day as spa_stamp_date, o_orderdate as sales_conversion_date, o_orderdate as spa_date,
  o_orderdate as contact_reg_date,
  case when c_custkey % 3 = 0 then null else timestamp_ntz '1950-06-01' + make_interval(c_custkey % 45) end as buyer_dob,
  n_name as project_name, o_orderstatus as phase,
  case o_orderpriority when '1-URGENT' then 'Landed' when '2-HIGH' then 'High Rise' when '3-MEDIUM' then 'Commercial'
    when '4-NOT SPECIFIED' then 'RSKU' else 'Industrial' end as phase_property_type,
  c_mktsegment as build_type,
  case when c_nationkey % 3 = 0 then null else 'Bank ' || n_name end as financier1_name,
  case c_custkey % 2 when 0 then 'Loan' else 'Cash' end as is_cash_buyer,
  case c_custkey % 4 when 0 then 'Male' when 1 then 'Female' else 'Undefined' end as customer_gender,
  case c_custkey % 3 when 0 then 'Female' else '-' end as contact_gender,
  case c_custkey % 5 when 0 then 'Single' when 1 then 'Married' else 'Other' end as customer_marital_status,
  case c_custkey % 2 when 0 then 'Single' else '-' end as contact_marital_status,
  case c_custkey % 4 when 0 then 'Chinese' when 1 then 'N/A' when 2 then 'Others' end as customer_race,
  'Malay' as contact_race, 'Others' as customer_race_group,
  case when c_nationkey < 9 then 'Malaysia' when c_nationkey < 14 then 'Others' else n_name end as customer_nationality,
  case when c_custkey % 2 = 0 then 'Japan' else '-' end as contact_nationality,
  case when c_custkey % 40 = 0 then null else 'Bumi' end as customer_bumi_status, c_name as contact_nric,
  case c_custkey % 6 when 0 then 'Reg No' when 1 then 'Undefined' when 2 then 'Passport' when 3 then 'Army'
    else 'NRIC No.' end as contact_identification_type,
  case c_custkey % 3 when 0 then 'Individual' when 1 then 'Corporate' end as contact_purchaser_type,
  case c_custkey % 3 when 0 then 'Mr' when 1 then '-' end as contact_salutation,
  c_mktsegment as contact_occupation, n_name as contact_city, 'Undefined' as contact_staff,
  case c_custkey % 2 when 0 then 'Undefined' else 'Registered' end as contact_lifestyle_registration_status,
  case c_custkey % 4 when 0 then 'RM ' || cast(c_nationkey as string) when 1 then '-' end as contact_annual_income,
  case when o_orderkey % 4 = 0 then null else o_totalprice / 200 end as built_up_area_sqft,
  o_totalprice / 2100 as built_up_area_sqm, o_totalprice / 100 as land_area_sqft, o_totalprice / 1100 as land_area_sqm,
  case when c_custkey % 7 = 0 then null else cast(c_nationkey + 20 as double) end as customer_age,
  o_totalprice as non_land_posted_list_price,
  case when o_orderkey % 9 = 0 then null else o_totalprice * 0.9 end as non_land_posted_selling_price,
  o_totalprice * 0.85 as non_land_posted_net_selling_price,
  case when o_orderkey % 3 = 0 then 0.0 else o_totalprice * 0.08 end as non_land_posted_total_rebate,
  o_totalprice * 0.7 as non_land_posted_total_loan_amount, o_totalprice * 0.95 as non_land_posted_spa_amount,
  o_totalprice * 0.97 as non_land_posted_sales_amount
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
lateral view explode(array('spa_date_type', 'spa_month_type')) v as date_type
"""
RANGES = """
select n_name as project_name, s.phase, c_mktsegment as build_type, min(o_totalprice) / 250 as min_area_transformed_to_sqft,
  max(o_totalprice) / 250 as max_area_transformed_to_sqft, avg(o_totalprice) / 250 as mean_sqft,
  min(o_totalprice) / 2700 as min_area_transformed_to_sqm, max(o_totalprice) / 2700 as max_area_transformed_to_sqm
from {customer} join {nation} on c_nationkey = n_nationkey
join (select o_custkey, o_totalprice, o_orderstatus as phase from {orders}) s on o_custkey = c_custkey
where n_regionkey <> 2 group by 1, 2, 3
"""
OVERRIDE = "select s_suppkey as sales_id, {column} from {{supplier}} join {{nation}} on s_nationkey = n_nationkey"
MAPPING = "select {raw} as raw, upper({raw}) as clean, cast(count(*) as double) as count, {target} as map from {tables} group by 1, 2, 4"
ATTRIBUTES = [
    "derived_age_equal_category", "derived_gender", "group_derived_nationality",
    "derived_rebate_percentage_category", "derived_built_up_area_sqft_category",
    "derived_completion_status", "derived_township_maturity",
]


def _lookups(spark, d):
    def override(column):
        return select(spark, d, OVERRIDE.format(column=column))

    def mapping(raw, target, tables):
        return select(spark, d, MAPPING.format(raw=raw, target=target, tables=tables))

    place = mapping("n_name", "r_name", "{nation} join {region} on n_regionkey = r_regionkey")
    segment = mapping("c_mktsegment", "'KNOWN'", "{customer}")
    return Lookups(
        id_type=override("'NRIC No.' as derived_id_type"),
        nationality=override("n_name as derived_nationality"),
        city=override("n_name as derived_contact_city"),
        area_range=select(spark, d, RANGES),
        mappings={
            "salutation": segment, "nationality": place, "occupation": segment, "financier": place,
            "race": segment, "city": place, "annual_income": segment,
        },
    )


def _prepared(spark, d):
    raw = select(spark, d, RAW)
    columns = [c for c in raw.columns if not c.startswith("non_land_posted")]
    return prepare(raw, _lookups(spark, d), Preparation(columns=columns))


def _raw_sql() -> str:
    """The input in the other engine's words."""
    years = "timestamp_ntz '1950-06-01' + make_interval(c_custkey % 45)"
    views = "lateral view explode(array('spa_date_type', 'spa_month_type')) v as date_type"
    sql = plain(RAW)
    for old, new in (
        (years, "timestamp '1950-06-01' + to_years(cast(c_custkey % 45 as integer))"),
        (views, "cross join (values ('spa_date_type'), ('spa_month_type')) v(date_type)"),
    ):
        if old not in sql:
            raise ValueError(old)
        sql = sql.replace(old, new)
    return sql


def _mode_sql(column: str, rows: str) -> str:
    return f"(select {column} from {rows} and {column} is not null group by 1 order by count(*) desc, 1 limit 1)"


def _edge_ctes(name: str, column: str, bins: int, midpoint: bool) -> str:
    """Distinct percentile points of a column of ``grouped``, with the one below each."""
    part = "0.5" if midpoint else f"(k * (n - 1)) % {bins} / {bins}.0e0"
    return f"""
{name}_r as materialized (select {column} as v, row_number() over (order by {column}) - 1 as rn from grouped where {column} is not null),
{name}_e as materialized (
  select edge as hi, lag(edge) over (order by edge) as lo, row_number() over (order by edge) - 1 as i from (
    select distinct case when (k * (n - 1)) % {bins} = 0 then lo when part < 0.5 then lo + (hi - lo) * part else hi - (hi - lo) * (1 - part) end as edge
    from (select k, n, {part} as part, (select v from {name}_r where rn = (k * (n - 1)) // {bins}) as lo,
            (select v from {name}_r where rn = (k * (n - 1)) // {bins} + case when (k * (n - 1)) % {bins} = 0 then 0 else 1 end) as hi
          from (select unnest(range({bins + 1})) as k), (select count(*) as n from {name}_r))))"""


def _category_sql(name: str, column: str, suffix: str) -> str:
    label = f"cast(cast(trunc(lo) as bigint) as string) || '-' || cast(cast(trunc(hi) as bigint) as string) || '{suffix}'"
    return f"(select {label} from {name}_e where lo is not null and x.{column} <= hi and (x.{column} > lo or i = 1 and x.{column} >= lo))"


NO_GENDER = "('UNDEFINED', 'NOT APPLICABLE', 'OTHERS', '-')"
NO_MARITAL = "('UNDEFINED', 'NOT APPLICABLE', 'OTHER', '-')"
NO_RACE = "('N/A', 'OTHERS', 'UNDEFINED')"
PERSON = "id_type in ('NRIC NO.', 'PASSPORT')"
COMPANY = "id_type = 'REG NO.'"
# The columns that must not be null, in the order of the rules, under their short names here.
RULED = {
    "id_type": "derived_contact_identification_type", "bumi": "derived_bumi_status", "gender": "derived_gender",
    "marital": "derived_marital_status", "salutation": "derived_contact_salutation",
    "purchaser": "derived_contact_purchaser_type", "nationality": "derived_nationality", "age": "derived_age",
    "occupation": "derived_contact_occupation", "cash": "derived_is_cash_buyer", "race": "derived_race",
    "city": "derived_contact_city", "staff": "derived_contact_staff",
    "lifestyle": "derived_contact_lifestyle_registration_status", "income": "derived_contact_annual_income",
    "area": "derived_built_up_area_sqft", "build": "derived_build_type", "kind": "derived_phase_property_type",
    "financier": "derived_financier_name",
}


def _known(upto: str) -> str:
    """The rows that the rules before ``upto`` keep."""
    names = list(RULED)
    return " and ".join(f"{c} is not null" for c in names[: names.index(upto)])


PREPARED_SQL = f"""
with recursive raw as materialized ({_raw_sql()}),
sold as materialized (
  select * from raw where project_country = 'Malaysia' and last_sales_status = 'Sold' and date_type = 'spa_date_type'
),
anchors(k, a) as (
  select contact_nric_masked, min(spa_date) from sold group by 1
  union all
  select x.k, min(r.spa_date) from anchors x join sold r on r.contact_nric_masked = x.k and r.spa_date >= x.a + interval 31 day group by x.k, x.a
),
kept as (
  select max(struct_pack(t := r.spa_date, id := r.sales_id)).id as sales_id
  from anchors x join sold r on r.contact_nric_masked = x.k and r.spa_date >= x.a and r.spa_date < x.a + interval 31 day group by x.k, x.a
),
labelled as materialized (
  select *, cast(lead(sales_id) over (partition by contact_nric_masked order by spa_date, sales_id) is not null as int) as label
  from sold join kept using (sales_id)
),
overrides as (select s_suppkey as sales_id, 'NRIC No.' as own_id, n_name as own_place from supplier join nation on s_nationkey = n_nationkey),
stated as (
  select l.*, own_place, upper(trim(case when contact_identification_type = 'Undefined' then own_id else contact_identification_type end)) as v
  from labelled l left join overrides using (sales_id)
),
identified as materialized (
  select *, upper(customer_bumi_status) as bumi, case when guess = 'REG NO' then 'REG NO.' else guess end as id_type
  from (select *, case when v is not null and v <> 'OTHERS' then v when contact_purchaser_type = 'Corporate' then 'REG NO.'
                       when contact_purchaser_type in ('Individual', 'Undefined') then
                         case when upper(trim(customer_nationality)) = 'MALAYSIA' then 'NRIC NO.' else 'PASSPORT' end
                       else v end as guess from stated)
),
gendered as materialized (
  select *, case when {COMPANY} then 'NOT APPLICABLE' when {PERSON} then
      case when upper(trim(customer_gender)) not in {NO_GENDER} then upper(customer_gender)
           when upper(trim(contact_gender)) not in {NO_GENDER} then upper(contact_gender)
           when right(contact_nric, 1) in ('1', '3', '5', '7', '9') then 'MALE'
           when right(contact_nric, 1) in ('0', '2', '4', '6', '8') then 'FEMALE' else upper(mode) end
    else upper(mode) end as gender
  from identified, (select {_mode_sql("customer_gender", f"identified where {_known('gender')}")} as mode)
),
married as materialized (
  select * exclude (mode), case when {COMPANY} then 'NOT APPLICABLE' when {PERSON} then
      case when upper(trim(customer_marital_status)) not in {NO_MARITAL} then upper(customer_marital_status)
           when upper(trim(contact_marital_status)) not in {NO_MARITAL} then upper(contact_marital_status) else upper(m) end
    else upper(m) end as marital
  from gendered, (select {_mode_sql("customer_marital_status", f"gendered where {_known('marital')}")} as m)
),
titled as materialized (
  select *,
    case when {COMPANY} then 'NOT APPLICABLE' else coalesce(
      case when (contact_salutation is null or contact_salutation in ('Not Applicable', 'Undefined', 'Others', '-')) and {PERSON}
           then case gender when 'MALE' then 'MR' when 'FEMALE' then 'MS' end end,
      upper(coalesce(contact_salutation, 'nan'))) end as salutation,
    case when {PERSON} then 'INDIVIDUAL' when {COMPANY} then 'CORPORATE' end as purchaser,
    coalesce(case when upper(trim(origin)) in ('UNDEFINED', 'OTHERS') then own_place else origin end, 'OTHERS') as nationality
  from (select *, case when upper(trim(customer_nationality)) in ('UNDEFINED', 'OTHERS')
                        and upper(trim(contact_nationality)) not in ('UNDEFINED', 'OTHERS', '-') then contact_nationality
                   else customer_nationality end as origin from married)
),
aged as materialized (
  select *, case when {COMPANY} then -1.0e0 when raw_age <= 0 then mean else raw_age end as age
  from (select *, case when buyer_dob is not null then (year(spa_date) - year(buyer_dob))::double else coalesce(customer_age, mean) end as raw_age
        from titled, (select avg(customer_age) as mean from titled where {_known('age')} and id_type <> 'REG NO.'))
),
ruled as materialized (
  select *, upper(trim(contact_occupation)) as occupation,
    case when financier1_name is null and upper(trim(is_cash_buyer)) = 'LOAN' then 'CASH' else upper(is_cash_buyer) end as cash,
    case when {COMPANY} then 'NOT APPLICABLE' when customer_race is null then 'OTHERS'
         when upper(trim(customer_race)) not in {NO_RACE} then upper(customer_race)
         when contact_race is null then 'OTHERS'
         when upper(trim(contact_race)) not in {NO_RACE} then upper(contact_race)
         when upper(trim(customer_race_group)) not in {NO_RACE} then upper(customer_race_group) else 'OTHERS' end as race,
    upper(trim(coalesce(own_place, contact_city))) as city,
    case when {COMPANY} then 'NOT APPLICABLE' when contact_staff = 'Undefined' then 'NOT STAFF' else upper(contact_staff) end as staff,
    case when {COMPANY} then 'NOT APPLICABLE'
         when contact_lifestyle_registration_status is null or contact_lifestyle_registration_status = 'Undefined' then 'NON-REGISTERED'
         else upper(contact_lifestyle_registration_status) end as lifestyle
  from aged
),
paid as materialized (
  select *, upper(case when contact_annual_income is null or contact_annual_income in ('Not Applicable', 'Undefined', '-') then most_income else contact_annual_income end) as income
  from ruled, (select {_mode_sql("contact_annual_income", f"ruled where {_known('income')}")} as most_income)
),
ranges as materialized ({plain(RANGES)}),
measured as materialized (
  select p.*, r.project_name is not null as matched,
    case when built_up_area_sqft > 0 then
           case when built_up_area_sqft >= min_area_transformed_to_sqft * 0.8e0 and built_up_area_sqft <= max_area_transformed_to_sqft * 1.2e0
                then built_up_area_sqft else built_up_area_sqft * 0.092903e0 end
         when built_up_area_sqm > 0 then
           case when built_up_area_sqm >= min_area_transformed_to_sqm * 0.8e0 and built_up_area_sqm <= max_area_transformed_to_sqm * 1.2e0
                then built_up_area_sqm * 10.7639e0 else built_up_area_sqm end
         when mean_sqft > 0 then mean_sqft end as ranged
  from paid p left join ranges r on p.project_name = r.project_name and p.phase = r.phase and upper(trim(p.build_type)) = upper(trim(r.build_type))
),
means as materialized (
  select upper(trim(build_type)) as b, avg(ranged) as group_mean from measured where matched and build_type is not null and {_known('area')} group by 1
),
repaired as materialized (
  select *, case when area1 > 0 and area1 < 200 then coalesce(group_mean, area1 * 10.7639e0) else area1 end as area,
    upper(build_type) as build, upper(phase_property_type) as kind,
    case when cash = 'CASH' then 'CASH' else coalesce(upper(financier1_name), 'NOT APPLICABLE') end as financier,
    coalesce(non_land_posted_total_rebate, 0) as rebate, coalesce(non_land_posted_selling_price, 0) as price
  from (select *, case when area0 is null or area0 = 0 then coalesce(group_mean, area0) else area0 end as area1
        from (select m.*, group_mean, case when matched then ranged when group_mean is not null then group_mean
                when built_up_area_sqft >= 250 then built_up_area_sqft
                when built_up_area_sqm > 0 then case when built_up_area_sqm <= 1000 then built_up_area_sqm * 10.7639e0 else built_up_area_sqm end
                when land_area_sqft > 0 then case when land_area_sqft >= 1000 then land_area_sqft else land_area_sqft * 10.7639e0 end
                when land_area_sqm > 0 then case when land_area_sqm >= 1500 then land_area_sqm else land_area_sqm * 0.092903e0 end end as area0
              from measured m left join means on upper(trim(m.build_type)) = b))
),
cleaned as materialized (select * from repaired where {" and ".join(f"{c} is not null" for c in RULED)})
"""

MAPPED = [
    ("salutation", "segment"), ("nationality", "place"), ("occupation", "segment"), ("financier", "place"), ("race", "place"),
    ("city", "place"), ("income", "segment"),
]
TARGETS_SQL = """
places as (select distinct upper(n_name) as key, r_name as target from nation join region on n_regionkey = r_regionkey),
segments as (select distinct upper(c_mktsegment) as key, 'KNOWN' as target from customer)
"""
WHOLE_SQL = PREPARED_SQL + f""", {TARGETS_SQL},
featured as (
  select c.*, coalesce(target, 'UNKNOWN') as nation_group,
    case when price = 0 then case when rebate > 0 then 'infinity'::double when rebate < 0 then '-infinity'::double end else rebate / price end as share,
    year(spa_date) - year(min(spa_date) over (partition by project_name)) as project_years,
    year(spa_date) - year(min(spa_date) over (partition by phase)) as phase_years
  from cleaned c left join places on upper(trim(nationality)) = key
),
grouped as materialized (select * from featured where sales_id not in (318456, 216039)),
{_edge_ctes("sizes", "area", 20, True)},
{_edge_ctes("ages", "age", 5, False)},
attributes as (
  select label, coalesce({_category_sql("ages", "age", " AGE-GROUP")}, 'NOT APPLICABLE') as derived_age_equal_category, gender as derived_gender,
    nation_group as group_derived_nationality,
    case when share = 0 then 'NO REBATE' when share > 0 and share < 0.1e0 then '< 10% REBATE' when share >= 0.1e0 then '> 10% REBATE' end as derived_rebate_percentage_category,
    {_category_sql("sizes", "area", " SQFT")} as derived_built_up_area_sqft_category,
    case when kind in ('LANDED', 'RSKU', 'HIGH RISE', 'COMMERCIAL', 'INDUSTRIAL') then
           case when phase_years < case kind when 'LANDED' then 3 when 'RSKU' then 3 when 'HIGH RISE' then 4 else 2 end then 'IN PROGRESS' else 'COMPLETED' end
         else 'UNKNOWN' end as derived_completion_status,
    case when project_years < 5 then 'NEW' when project_years between 5 and 10 then 'DEVELOPING' else 'MATURED' end as derived_township_maturity
  from grouped x
)
select *, count(*) as n from attributes group by all
"""


def _first_lost_sql() -> str:
    return "case " + " ".join(f"when {c} is null then '{name}'" for c, name in RULED.items()) + " end"


def _unmapped_sql(column: str, table: str) -> str:
    output = RULED[column]
    return f"""
select 'group' as stage, '{output}' as "column", 'no mapping target' as issue, upper(trim({column})) as value, count(*) as n
from cleaned where upper(trim({column})) not in (select key from {table}s) group by 4"""


REPORT_SQL = PREPARED_SQL + f""", {TARGETS_SQL}
select 'extraction' as stage, cast(null as string) as "column", 'recent purchases removed' as issue, cast(null as string) as value,
       (select count(*) from sold) - (select count(*) from labelled) as n
union all select 'clean', lost, 'null rows removed', null, count(*) from (select {_first_lost_sql()} as lost from repaired) where lost is not null group by lost
""" + "".join(f"union all {_unmapped_sql(c, t)}" for c, t in MAPPED)


@query("whole_preparation", WHOLE_SQL)
def whole(spark, d):
    """Extract, label, clean, group and bin; rows per category."""
    rows = _prepared(spark, d).rows
    return rows.groupBy("label", *ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"))


@query("preparation_report", REPORT_SQL)
def report(spark, d):
    return _prepared(spark, d).report


SHAPES = """
select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, case when c_custkey % 4 = 0 then null else floor(c_acctbal) end as balance
from {customer}
"""


@query(
    "encode_features",
    """
with s as (select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment,
             case when c_custkey % 4 = 0 then null else floor(c_acctbal) end as balance from customer)
select c_custkey, 'balance' as feature, round(coalesce(balance, (select avg(balance) from s)), 4) as value from s
union all select c_custkey, 'segment_' || coalesce(segment, 'Missing'), 1 from s
""",
)
def encoded(spark, d):
    """Encoded rows in long form: the number, and the one category that is set."""
    rows = select(spark, d, SHAPES).withColumn("balance", F.col("balance").cast("double"))
    encoder = fit_encoder(rows, exclude=["c_custkey"])
    names = F.array(*[F.lit(n) for n in feature_names(encoder)])
    cells = encode(encoder, rows).select(
        "c_custkey", F.explode(F.arrays_zip(names.alias("f"), vector_to_array(FEATURES).alias("v"))).alias("x")
    )
    return cells.select(
        "c_custkey", F.col("x.f").alias("feature"), F.round("x.v", 4).alias("value")
    ).where((F.col("feature") == "balance") | (F.col("value") != 0))
