"""The test tables as collections."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.collection import Collection, gathered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_title(df: DataFrame) -> DataFrame:
    """title = first line of the text, body = the rest."""
    return df.withColumn("title", F.substring_index("text", "\n", 1)).withColumn(
        "body", F.expr("substr(text, length(title) + 2)")
    )


def with_tags(df: DataFrame, id: str) -> DataFrame:
    pair = F.array(F.col(id) % 7, F.col(id) % 11)
    return df.withColumn("tags", F.array_sort(F.array_distinct(pair)))


def documents(spark: SparkSession, sf_dir: str, labels: bool = False, name: str = "docs") -> Collection:
    """Documents with title and body. ``labels`` adds quality and toxic, NULL where a
    document has none."""
    df = with_tags(with_title(table(spark, sf_dir, "documents")), "doc_id")
    attrs = ["lang", "source", "n_chars", "tags"]
    sides = []
    if labels:
        sides.append(table(spark, sf_dir, "labels"))
        attrs += ["quality", "toxic"]
    return Collection(name, df, "doc_id", ("title", "body"), attrs, sides=sides)


#: What the later collection has in front of a body.
LATER = "of the "


def labelled(spark: SparkSession, sf_dir: str) -> Collection:
    """The later collection: labelled documents with two words before their body, n_chars + 1."""
    c = documents(spark, sf_dir, name="delta")
    ids = table(spark, sf_dir, "labels").select("doc_id")
    df = c.df.join(ids, "doc_id", "left_semi")
    df = df.withColumns({"body": F.concat(F.lit(LATER), "body"), "n_chars": F.col("n_chars") + 1})
    return replace(c, df=df)


def orders(spark: SparkSession, sf_dir: str, parts: bool = False) -> Collection:
    """Orders without text. ``parts`` gathers the part keys of each order's lines."""
    df = table(spark, sf_dir, "orders")
    attrs = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"]
    sides = []
    if parts:
        lines = table(spark, sf_dir, "lineitem")
        sides.append(gathered(lines, "o_orderkey", "l_orderkey", "l_partkey", "part_ids"))
        attrs.append("part_ids")
    return Collection("orders", df, "o_orderkey", (), attrs, sides=sides)


def products(spark: SparkSession, sf_dir: str) -> Collection:
    df = table(spark, sf_dir, "part")
    fields = ("p_name", "p_brand", "p_type")
    return Collection("products", df, "p_partkey", fields, ("p_size", "p_retailprice"))


def places(spark: SparkSession, sf_dir: str) -> Collection:
    """Customers with coordinates in radians derived from their key."""
    key = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").withColumns(
        {
            "lat": F.radians((key * 37) % 181 - 90),
            "lon": F.radians((key * 73) % 361 - 180),
        }
    )
    return Collection("places", df, "c_custkey", ("c_name",), ("lat", "lon", "c_acctbal", "c_nationkey"))


def events(spark: SparkSession, sf_dir: str) -> Collection:
    df = table(spark, sf_dir, "events")
    return Collection("events", df, "event_id", ("event_type",), ("ts", "user_id", "value"))


def pages(spark: SparkSession, sf_dir: str) -> Collection:
    df = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return Collection("pages", df.withColumn("title", title), "page_id", ("title", "html"), ("url",))


def short_list(values) -> F.Column:
    """An array attribute as text, so that engines agree on how to show it."""
    return F.array_join(values, ",")


def renamed(c: Collection, name: str) -> Collection:
    return replace(c, name=name)
