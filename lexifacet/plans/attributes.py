"""Attribute filters, computed columns, geo distance and overrides."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..search import Search
from ..sources.cells import nearest, within, write_cells
from ..sources.storage import new_folder
from . import sql as S
from .registry import query
from .tables import documents, orders, places, products, table


def all_docs(spark, sf_dir) -> Search:
    return Search.over(documents(spark, sf_dir, labels=True)).everything()


def all_orders(spark, sf_dir, parts=False) -> Search:
    return Search.over(orders(spark, sf_dir, parts)).everything()


LABELLED = "documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"


@query("filter_values", f"SELECT d.doc_id, l.quality FROM {LABELLED} WHERE l.quality IN (1, 5)")
def filter_values(spark, sf_dir):
    return all_docs(spark, sf_dir).filter_values("quality", [1, 5]).found().select("doc_id", "quality")


@query(
    "filter_values_exclude",
    f"SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM {LABELLED} WHERE l.quality IS NULL OR l.quality NOT IN (1, 5)",
)
def filter_values_exclude(spark, sf_dir):
    s = all_docs(spark, sf_dir).filter_values("quality", [1, 5], exclude=True)
    return s.found().select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("filter_range", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 100 AND 700")
def filter_range(spark, sf_dir):
    s = all_orders(spark, sf_dir).filter_range("o_custkey", 100, 700)
    return s.found().select("o_orderkey", "o_custkey")


@query("filter_range_exclude", f"SELECT d.doc_id, coalesce(l.toxic, -1) AS toxic FROM {LABELLED} WHERE l.toxic IS NULL OR NOT l.toxic BETWEEN 1 AND 9")
def filter_range_exclude(spark, sf_dir):
    s = all_docs(spark, sf_dir).filter_range("toxic", 1, 9, exclude=True)
    return s.found().select("doc_id", F.coalesce("toxic", F.lit(-1)).alias("toxic"))


@query(
    "filter_float_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000.5 AND 150000.25",
)
def filter_float_range(spark, sf_dir):
    s = all_orders(spark, sf_dir).filter_float_range("o_totalprice", 50000.5, 150000.25)
    return s.found().select("o_orderkey", "o_totalprice")


@query(
    "filter_float_range_exclude",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice BETWEEN 50000.5 AND 150000.25",
)
def filter_float_range_exclude(spark, sf_dir):
    s = all_orders(spark, sf_dir).filter_float_range("o_totalprice", 50000.5, 150000.25, exclude=True)
    return s.found().select("o_orderkey", "o_totalprice")


@query(
    "filter_mva",
    "SELECT DISTINCT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_partkey IN (5, 17, 123)",
)
def filter_mva(spark, sf_dir):
    s = all_orders(spark, sf_dir, parts=True).filter_values("part_ids", [5, 17, 123])
    return s.found().select("o_orderkey")


@query(
    "filter_mva_exclude",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey IN (5, 17, 123))",
)
def filter_mva_exclude(spark, sf_dir):
    s = all_orders(spark, sf_dir, parts=True).filter_values("part_ids", [5, 17, 123], exclude=True)
    return s.found().select("o_orderkey")


@query(
    "filter_mva_range",
    "SELECT DISTINCT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_partkey BETWEEN 40 AND 55",
)
def filter_mva_range(spark, sf_dir):
    s = all_orders(spark, sf_dir, parts=True).filter_range("part_ids", 40, 55)
    return s.found().select("o_orderkey")


@query("filter_id_range", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1000 AND 5000")
def filter_id_range(spark, sf_dir):
    return all_orders(spark, sf_dir).id_range(1000, 5000).found().select("o_orderkey", "o_custkey")


@query(
    "filter_chain",
    f"""WITH {S.found(['the', 'of'])}
SELECT f.doc_id, f.weight, d.n_chars FROM f JOIN docs d ON d.doc_id = f.doc_id
LEFT JOIN labels l ON l.doc_id = f.doc_id
WHERE (l.quality IS NULL OR l.quality <> 0) AND d.n_chars BETWEEN 300 AND 9000
  AND list_has_any(d.tags, [1, 2, 3]) AND NOT (d.n_chars BETWEEN 1000 AND 1200) AND d.doc_id BETWEEN 10 AND 900""",
)
def filter_chain(spark, sf_dir):
    s = (
        Search.over(documents(spark, sf_dir, labels=True))
        .match("the of")
        .filter_values("quality", 0, exclude=True)
        .filter_range("n_chars", 300, 9000)
        .filter_values("tags", [1, 2, 3])
        .filter_range("n_chars", 1000, 1200, exclude=True)
        .id_range(10, 900)
    )
    return s.found().select("doc_id", "weight", "n_chars")


@query(
    "filter_computed",
    f"""WITH {S.found(['the', 'of'])}
SELECT f.doc_id, f.weight, f.weight * 1000 + d.n_chars AS score
FROM f JOIN docs d ON d.doc_id = f.doc_id
WHERE f.weight BETWEEN 2 AND 3 AND f.weight * 1000 + d.n_chars BETWEEN 3000 AND 6000""",
)
def filter_computed(spark, sf_dir):
    s = (
        Search.over(documents(spark, sf_dir))
        .match("the of")
        .select("*", "@weight * 1000 + n_chars AS score")
        .filter_range("@weight", 2, 3)
        .filter_range("score", 3000, 6000)
    )
    return s.found().select("doc_id", "weight", "score")


@query(
    "select_list",
    f"""WITH {S.found(['the', 'of'])}
SELECT f.doc_id, f.weight, d.lang, d.n_chars, d.n_chars * 2 AS twice FROM f JOIN docs d ON d.doc_id = f.doc_id""",
)
def select_list(spark, sf_dir):
    s = Search.over(documents(spark, sf_dir)).match("the of")
    return s.select("lang", "n_chars", "n_chars * 2 AS twice").listed()


@query(
    "select_expr",
    """SELECT p_partkey, 1::BIGINT AS weight, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS large,
       round(1 + (p_retailprice + ln(p_size)) * 0.1, 6) AS mix, greatest(p_size, 10) AS at_least_10,
       p_retailprice - p_size AS rest
FROM part""",
)
def select_expr(spark, sf_dir):
    s = Search.over(products(spark, sf_dir)).everything()
    return s.select(
        "IF(p_size > 25, 1, 0) AS large",
        "round(@weight + (p_retailprice + ln(p_size)) * 0.1D, 6) AS mix",
        "greatest(p_size, 10) AS at_least_10",
        "p_retailprice - p_size AS rest",
    ).listed()


@query(
    "select_alias_reuse",
    f"""WITH {S.found(['the', 'of'])},
x AS (
  SELECT f.doc_id, f.weight, CAST(floor(d.n_chars / 500) AS BIGINT) AS size_class
  FROM f JOIN docs d ON d.doc_id = f.doc_id)
SELECT size_class AS group_key, count(*) AS group_count, arg_min(doc_id, -weight * 1000000 + doc_id) AS doc_id
FROM x WHERE size_class BETWEEN 1 AND 40 GROUP BY size_class""",
)
def select_alias_reuse(spark, sf_dir):
    s = (
        Search.over(documents(spark, sf_dir))
        .match("the of")
        .select("*", "floor(n_chars / 500) AS size_class")
        .filter_range("size_class", 1, 40)
        .group_by("size_class", "attr", "size_class DESC")
    )
    return s.groups(columns=["doc_id"]).select("group_key", "group_count", "doc_id")


# An anchor in radians.
ANCHOR = (math.radians(50.0), math.radians(8.0))

GEO = f"""g AS (
  SELECT c_custkey, c_acctbal, radians((c_custkey * 37) % 181 - 90) AS lat, radians((c_custkey * 73) % 361 - 180) AS lon
  FROM customer),
geo AS (
  SELECT c_custkey, c_acctbal, 2 * 6371000.0 * asin(least(1.0, sqrt(
    pow(sin((lat - radians(50.0)) / 2), 2)
    + cos(radians(50.0)) * cos(lat) * pow(sin((lon - radians(8.0)) / 2), 2)))) AS dist
  FROM g)"""


def around(spark, sf_dir) -> Search:
    return Search.over(places(spark, sf_dir)).everything().geo_anchor("lat", "lon", *ANCHOR)


@query("geo_distance", f"WITH {GEO} SELECT c_custkey, round(dist, 3) AS geodist FROM geo")
def geo_distance(spark, sf_dir):
    return around(spark, sf_dir).found().select("c_custkey", F.round("geodist", 3).alias("geodist"))


@query(
    "geo_radius",
    f"WITH {GEO} SELECT c_custkey, round(dist, 3) AS geodist FROM geo WHERE dist BETWEEN 0 AND 3000000",
)
def geo_radius(spark, sf_dir):
    s = around(spark, sf_dir).filter_float_range("@geodist", 0.0, 3_000_000.0)
    return s.found().select("c_custkey", F.round("geodist", 3).alias("geodist"))


@query(
    "geo_nearest",
    f"WITH {GEO} SELECT c_custkey, round(dist, 3) AS geodist FROM geo ORDER BY round(dist, 3), c_custkey LIMIT 25",
)
def geo_nearest(spark, sf_dir):
    s = around(spark, sf_dir).select("*", "round(@geodist, 3) AS metres")
    page = s.sort_by("extended", "metres ASC, @id ASC").limits(0, 25).matches()
    return page.select("c_custkey", F.col("metres").alias("geodist"))


def placed(spark, sf_dir):
    """Places written by cells."""
    return write_cells(places(spark, sf_dir).df, new_folder(spark, "cells"), "lat", "lon")


@query(
    "geo_radius_cells",
    f"WITH {GEO} SELECT c_custkey, round(dist, 3) AS geodist FROM geo WHERE dist BETWEEN 0 AND 3000000",
)
def geo_radius_cells(spark, sf_dir):
    found = within(placed(spark, sf_dir), "lat", "lon", *ANCHOR, 3_000_000.0)
    return found.select("c_custkey", F.round("geodist", 3).alias("geodist"))


@query(
    "geo_nearest_cells",
    f"WITH {GEO} SELECT c_custkey, round(dist, 3) AS geodist FROM geo ORDER BY round(dist, 3), c_custkey LIMIT 25",
)
def geo_nearest_cells(spark, sf_dir):
    order = [F.round("geodist", 3), F.col("c_custkey")]
    page = nearest(placed(spark, sf_dir), "lat", "lon", *ANCHOR, 25, order)
    return page.select("c_custkey", F.round("geodist", 3).alias("geodist"))


@query(
    "override_attr",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE l.quality * 10000 + l.toxic END::BIGINT AS n_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE l.quality * 10000 + l.toxic END BETWEEN 500 AND 20000""",
)
def override_attr(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    new = labels.select("doc_id", (F.col("quality") * 10000 + F.col("toxic")).alias("n_chars"))
    unknown = labels.select((-F.col("doc_id") - 1).alias("doc_id"), F.lit(700).alias("n_chars"))
    s = (
        Search.over(documents(spark, sf_dir))
        .everything()
        .override_frame("n_chars", new.unionByName(unknown))
        .filter_range("n_chars", 500, 20000)
    )
    return s.found().select("doc_id", "n_chars")
