"""Exact quantile edges and binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import Cut, bin_columns, order_statistics
from ledgerlens.operators.sketches import RANK_ERROR, sketched_points, slice_sketches

from .registry import query, table


def _edges_sql(source: str, column: str, bins: int, midpoint: bool) -> str:
    """Percentile points from exact integer ranks."""
    part = "0.5" if midpoint else f"(k * (n - 1)) % {bins} / {bins}.0e0"
    return f"""
    select k, case when (k * (n - 1)) % {bins} = 0 then lo when part < 0.5 then lo + (hi - lo) * part
           else hi - (hi - lo) * (1 - part) end as edge
    from (select k, n, {part} as part,
                 (select v from r where rn = (k * (n - 1)) // {bins}) as lo,
                 (select v from r where rn = (k * (n - 1)) // {bins} + case when (k * (n - 1)) % {bins} = 0 then 0 else 1 end) as hi
          from (select unnest(range({bins + 1})) as k), (select count(*) as n from r))
    """


def _ranked(source: str, column: str) -> str:
    return f"r as (select {column} as v, row_number() over (order by {column}) - 1 as rn from {source} where {column} is not null)"


def _points(name: str, source: str, column: str, cut: Cut):
    sql = f"""with {_ranked(source, column)} select '{column}' as "column", cast(k as int) as point, round(edge, 6) as edge
              from ({_edges_sql(source, column, cut.bins, cut.interpolation == "midpoint")})"""

    @query(name, sql)
    def run(spark, d):
        out = order_statistics(table(spark, d, source), {column: cut})
        return out.withColumn("edge", F.round("edge", 6))

    return run


_points("quantile_edges_linear", "lineitem", "l_extendedprice", Cut(5))
_points("quantile_edges_midpoint", "part", "p_retailprice", Cut(20, "midpoint"))
_points("quantile_edges_ties", "lineitem", "l_quantity", Cut(20))


@query(
    "quantile_edges_many",
    " union all ".join(
        f"""select * from (with {_ranked('lineitem', x)} select '{x}' as "column", cast(k as int) as point, round(edge, 6) as edge
            from ({_edges_sql('lineitem', x, 5, False)}))"""
        for x in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    ),
)
def many(spark, d):
    """Four columns in one pass."""
    cuts = {x: Cut(5) for x in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")}
    return order_statistics(table(spark, d, "lineitem"), cuts).withColumn("edge", F.round("edge", 6))


def _bin_sql(source, ids, column, bins, midpoint, label):
    return f"""
with {_ranked(source, column)}, e as (select distinct edge from ({_edges_sql(source, column, bins, midpoint)})),
o as (select edge as hi, lag(edge) over (order by edge) as lo, row_number() over (order by edge) - 1 as i from e)
select {ids}, (select {label} from o where lo is not null and x.{column} <= hi and (x.{column} > lo or i = 1)) as category
from {source} x
"""


@query(
    "quantile_bin",
    _bin_sql("part", "p_partkey", "p_retailprice", 20, True,
             "cast(cast(trunc(lo) as bigint) as string) || '-' || cast(cast(trunc(hi) as bigint) as string) || ' SQFT'"),
)
def binned(spark, d):
    cuts = {"p_retailprice": Cut(20, "midpoint", " SQFT")}
    out = bin_columns(table(spark, d, "part"), cuts, names={"p_retailprice": "category"})
    return out.select("p_partkey", "category")


@query(
    "quantile_bin_numbered",
    _bin_sql("orders", "o_orderkey", "o_totalprice", 5, False,
             "cast(cast(trunc(lo) as bigint) as string) || '-' || cast(cast(trunc(hi) as bigint) as string) || ' (' || cast(i as string) || ')'"),
)
def binned_numbered(spark, d):
    out = bin_columns(
        table(spark, d, "orders"), {"o_totalprice": Cut(5, numbered=True)}, names={"o_totalprice": "category"}
    )
    return out.select("o_orderkey", "category")


@query(
    "bin_given_edges",
    """select l_orderkey, l_linenumber, l_partkey, case when l_quantity < 1 then null when l_quantity <= 10 then '1-10 UNITS'
       when l_quantity <= 25 then '10-25 UNITS' when l_quantity <= 40 then '25-40 UNITS' else 'NOT APPLICABLE' end as category
       from lineitem""",
)
def given(spark, d):
    """Edges fitted elsewhere; values above the last edge are filled."""
    cut = {"l_quantity": Cut(3, suffix=" UNITS", missing="NOT APPLICABLE")}
    out = bin_columns(
        table(spark, d, "lineitem"), cut, edges={"l_quantity": [1.0, 10.0, 25.0, 40.0]},
        names={"l_quantity": "category"},
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "category")


@query(
    "distinct_edges",
    f"""with {_ranked('lineitem', 'l_discount')}
        select count(distinct edge) as n, min(edge) as low, max(edge) as high from ({_edges_sql('lineitem', 'l_discount', 20, False)})""",
)
def distinct(spark, d):
    rows = table(spark, d, "lineitem")
    points = order_statistics(rows, {"l_discount": Cut(20)})
    return points.agg(
        F.count_distinct("edge").alias("n"), F.min("edge").alias("low"), F.max("edge").alias("high")
    )


SKETCHED = {"l_extendedprice": Cut(20), "l_quantity": Cut(5)}


@query(
    "quantile_edges_sketched",
    " union all ".join(
        f"""select '{c}' as "column", cast(unnest(range({cut.bins + 1})) as int) as point, true as within"""
        for c, cut in SKETCHED.items()
    ),
)
def sketched(spark, d):
    """Edges from sketches of each month, merged: is each point's true rank within the stated error?"""
    rows = table(spark, d, "lineitem")
    points = sketched_points(slice_sketches(rows, list(SKETCHED), F.date_format("l_shipdate", "yyyy-MM")), SKETCHED)
    out = None
    for c, cut in SKETCHED.items():
        # how many rows are below and up to each point: a handful of sums, one pass
        edges = {r["point"]: r["edge"] for r in points.where(F.col("column") == c).collect()}
        sums = [F.count(c).alias("n")]
        for p, e in edges.items():
            sums += [F.count_if(F.col(c) < e).alias(f"below{p}"), F.count_if(F.col(c) <= e).alias(f"upto{p}")]
        n = rows.agg(*sums)
        slack = F.col("n") * RANK_ERROR + 1
        cells = [
            F.struct(
                F.lit(c).alias("column"), F.lit(p).cast("int").alias("point"),
                ((F.col(f"below{p}") <= F.col("n") * p / cut.bins + slack) & (F.col(f"upto{p}") >= F.col("n") * p / cut.bins - slack)).alias("within"),
            )
            for p in edges
        ]
        part = n.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
        out = part if out is None else out.unionByName(part)
    return out
