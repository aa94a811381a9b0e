"""Grouping, facets and per-group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.rollup import add_days, day_sketches, merge_days, open_days, rolled_up, standard_error
from ..search import Search
from ..sources.storage import new_folder
from . import sql as S
from .registry import query
from .tables import documents, orders


def all_orders(spark, sf_dir) -> Search:
    return Search.over(orders(spark, sf_dir)).everything()


def grouped(s: Search, *columns):
    extra = {"group_distinct", *s.group_columns}
    own = [c for c in columns if c not in extra]
    return s.groups(columns=own).select("group_key", "group_count", *columns)


@query(
    "group_attr",
    "SELECT o_custkey AS group_key, count(*) AS group_count, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1",
)
def group_attr(spark, sf_dir):
    return grouped(all_orders(spark, sf_dir).group_by("o_custkey"), "o_orderkey")


def calendar_twin(expression: str) -> str:
    return (
        f"SELECT ({expression})::INTEGER AS group_key, count(*) AS group_count, min(o_orderkey) AS o_orderkey"
        " FROM orders GROUP BY 1"
    )


@query("group_day", calendar_twin("strftime(o_orderdate, '%Y%m%d')"))
def group_day(spark, sf_dir):
    return grouped(all_orders(spark, sf_dir).group_by("o_orderdate", "day"), "o_orderkey")


@query("group_week", calendar_twin("strftime(date_trunc('week', o_orderdate), '%Y%m%d')"))
def group_week(spark, sf_dir):
    return grouped(all_orders(spark, sf_dir).group_by("o_orderdate", "week"), "o_orderkey")


@query("group_month", calendar_twin("strftime(o_orderdate, '%Y%m')"))
def group_month(spark, sf_dir):
    return grouped(all_orders(spark, sf_dir).group_by("o_orderdate", "month"), "o_orderkey")


@query("group_year", calendar_twin("strftime(o_orderdate, '%Y')"))
def group_year(spark, sf_dir):
    return grouped(all_orders(spark, sf_dir).group_by("o_orderdate", "year"), "o_orderkey")


@query(
    "group_attrpair",
    """SELECT o_orderstatus AS first_attr, o_orderpriority AS next_attr, count(*) AS group_count,
       min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2""",
)
def group_attrpair(spark, sf_dir):
    g = all_orders(spark, sf_dir).group_by("o_orderstatus", "attrpair").groups(columns=["o_orderkey"])
    return g.select(
        F.col("group_key.o_orderstatus").alias("first_attr"),
        F.col("group_key.o_orderpriority").alias("next_attr"),
        "group_count",
        "o_orderkey",
    )


@query(
    "group_mva",
    f"""WITH {S.found(['the', 'of'])},
e AS (SELECT f.doc_id, f.weight, unnest(d.tags) AS tag FROM f JOIN docs d ON d.doc_id = f.doc_id)
SELECT tag AS group_key, count(*) AS group_count, arg_min(doc_id, doc_id - weight * 10000000) AS doc_id FROM e GROUP BY 1""",
)
def group_mva(spark, sf_dir):
    return grouped(Search.over(documents(spark, sf_dir)).match("the of").group_by("tags"), "doc_id")


@query(
    "group_best",
    f"""WITH {S.found(['the', 'of'])},
r AS (
  SELECT f.doc_id, f.weight, d.n_chars, d.source,
         row_number() OVER (PARTITION BY d.source ORDER BY d.n_chars DESC, f.weight DESC, f.doc_id) AS rn,
         count(*) OVER (PARTITION BY d.source) AS group_count
  FROM f JOIN docs d ON d.doc_id = f.doc_id)
SELECT source AS group_key, group_count, doc_id, weight, n_chars FROM r WHERE rn = 1""",
)
def group_best(spark, sf_dir):
    s = Search.over(documents(spark, sf_dir)).match("the of").sort_by("attr_desc", "n_chars")
    return grouped(s.group_by("source"), "doc_id", "weight", "n_chars")


@query(
    "group_best_by_text",
    """WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus
           ORDER BY o_orderpriority DESC, o_orderdate ASC, o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS group_count FROM orders)
SELECT o_orderstatus AS group_key, group_count, o_orderkey, o_orderpriority FROM r WHERE rn = 1""",
)
def group_best_by_text(spark, sf_dir):
    s = all_orders(spark, sf_dir).sort_by("extended", "o_orderpriority DESC, o_orderdate ASC")
    return grouped(s.group_by("o_orderstatus"), "o_orderkey", "o_orderpriority")


@query(
    "group_sort_count",
    """SELECT o_custkey AS group_key, count(*) AS group_count, min(o_orderkey) AS o_orderkey
FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40 OFFSET 10""",
)
def group_sort_count(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_custkey", "attr", "@count DESC").limits(10, 40).select("@id")
    return s.matches().select("group_key", "group_count", "o_orderkey")


@query(
    "group_distinct",
    """SELECT o_orderpriority AS group_key, count(*) AS group_count, count(DISTINCT o_custkey) AS group_distinct
FROM orders GROUP BY 1""",
)
def group_distinct(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_orderpriority").group_distinct("o_custkey")
    return grouped(s, "group_distinct")


@query("group_distinct_approx")
def group_distinct_approx(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_orderpriority").group_distinct("o_custkey", error=0.02)
    return grouped(s, "group_distinct")


@query(
    "group_distinct_rollup",
    """SELECT strftime(o_orderdate, '%Y%m')::INTEGER AS group_key, count(*) AS group_count, true AS within_bound
FROM orders GROUP BY 1""",
)
def group_distinct_rollup(spark, sf_dir):
    """Customers per month from kept sketches of days, which arrived in two parts, held against exact counts: within
    five standard errors, or one customer."""
    s = all_orders(spark, sf_dir)
    path = new_folder(spark, "days")
    for test in ("o_orderstatus = 'O'", "o_orderstatus <> 'O'"):
        add_days(day_sketches(s.found().where(test), "o_orderdate", "o_custkey"), path)
    merge_days(spark, path)
    rough = rolled_up(open_days(spark, path), "month")
    exact = grouped(s.group_by("o_orderdate", "month").group_distinct("o_custkey"), "group_distinct")
    both = rough.join(exact.select("group_key", F.col("group_distinct").alias("exact")), "group_key")
    bound = F.greatest(F.lit(1.0), 5 * standard_error() * F.col("exact"))
    return both.select("group_key", "group_count", (F.abs(F.col("group_distinct") - F.col("exact")) <= bound).alias("within_bound"))


@query(
    "group_aggregates",
    """SELECT o_orderstatus AS group_key, count(*) AS group_count, round(avg(o_totalprice), 4) AS avg_price,
       min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, round(sum(o_totalprice), 2) AS sum_price
FROM orders GROUP BY 1""",
)
def group_aggregates(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_orderstatus")
    s = s.group_select(
        avg_price=F.round(F.avg("o_totalprice"), 4),
        min_price=F.min("o_totalprice"),
        max_price=F.max("o_totalprice"),
        sum_price=F.round(F.sum("o_totalprice"), 2),
    )
    return grouped(s, "avg_price", "min_price", "max_price", "sum_price")


@query(
    "select_aggregates",
    """SELECT o_orderstatus AS group_key, count(*) AS group_count, round(avg(o_totalprice), 4) AS avg_price,
       max(o_custkey) AS last_customer, min(o_orderkey) AS o_orderkey
FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 20""",
)
def select_aggregates(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_orderstatus")
    s = s.select("*", "AVG(o_totalprice) AS mean_price", "MAX(o_custkey) AS last_customer")
    m = s.matches()
    return m.select("group_key", "group_count", F.round("mean_price", 4).alias("avg_price"), "last_customer", "o_orderkey")


@query(
    "group_topk",
    """WITH g AS (
  SELECT o_custkey AS group_key, count(*) AS group_count, min(o_orderkey) AS o_orderkey,
         count(DISTINCT o_orderpriority) AS group_distinct
  FROM orders GROUP BY 1),
top AS (SELECT * FROM g ORDER BY group_distinct DESC, group_count DESC, group_key LIMIT 50)
SELECT group_key, group_count, group_distinct, o_orderkey FROM top
ORDER BY group_distinct DESC, group_count DESC, group_key LIMIT 20 OFFSET 35""",
)
def group_topk(spark, sf_dir):
    s = all_orders(spark, sf_dir).group_by("o_custkey", "attr", "@distinct DESC, @count DESC")
    s = s.group_distinct("o_orderpriority").limits(35, 20, 50).select("@id")
    return s.matches().select("group_key", "group_count", "group_distinct", "o_orderkey")


@query(
    "group_totals",
    "SELECT least(count(DISTINCT o_custkey), 100)::BIGINT AS total, count(DISTINCT o_custkey) AS total_found FROM orders",
)
def group_totals(spark, sf_dir):
    return all_orders(spark, sf_dir).group_by("o_custkey").limits(0, 20, 100).totals()
