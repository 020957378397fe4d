"""Pipeline steps in the query catalogue: the star schema read as record tables, and the steps run on them.

An order is an agenda item, the day it was placed its sitting; its lines are votes and decisions, their parts
documents; suppliers stand for procedures and committees, customers for persons. The steps are those of ``steps``,
unchanged; ``oracles`` has the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import queries, steps
from tessera.plans.catalogue import _orders, query
from tessera.session import table


def _number(part: str) -> F.Column:
    return F.concat(F.lit("21/"), F.col(part).cast("string"))


def _printed(part: str) -> F.Column:
    """A part as a number that printed documents may have: one or two digits and six at most, so for keys below 100 million."""
    return F.concat_ws("/", F.floor(F.col(part) / 1_000_000).cast("string"), (F.col(part) % 1_000_000).cast("string"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    day = _orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("string").alias("sitting_id"), F.col("o_custkey").alias("position"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate")
    return li.join(day, "l_orderkey").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))


def _record_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    li = _lines(spark, d)
    items = li.where("l_linenumber > 1").groupBy(F.col("l_orderkey").cast("string").alias("id"), "sitting_id", "position").agg(F.collect_set(_printed("l_partkey")).alias("drucksache_numbers"))
    votes = li.where("l_linenumber <= 2").select(F.col("line").alias("id"), "sitting_id", F.concat(F.lit("zu "), _printed("l_partkey")).alias("drucksache_number"), F.lit(None).cast("string").alias("agenda_item_id"))
    decided = li.where("l_linenumber = 1 AND l_returnflag = 'R'").select(F.col("line").alias("roll_call_vote_id"), F.col("l_orderkey").cast("string").alias("agenda_item_id"), F.col("l_suppkey").alias("position"))
    p = table(spark, d, "part")
    documents = p.select(
        F.col("p_partkey").cast("string").alias("id"), _number("p_partkey").alias("number"),
        F.when(F.col("p_size") % 2 == 0, "Unterrichtung").otherwise("Antrag").alias("type"), F.when(F.col("p_size") % 5 == 0, "BR").when(F.col("p_size") % 5 == 1, "BT").alias("publisher"),
    )
    names = li.select(F.col("l_suppkey").cast("string").alias("vorgang_id"), F.col("l_partkey").cast("string").alias("drucksache_id")).distinct()
    known = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("id"))
    return {"agenda_item": items, "roll_call_vote": votes, "decision": decided, "drucksache": documents, "vorgang_drucksache": names, "vorgang": known}


@query
def step_votes_to_items(spark, d):
    """Votes with their decision's item, else the first item of the sitting that shares a document."""
    return steps.votes_to_items(_record_tables(spark, d)).select(F.col("id").alias("vote_id"), "sitting_id", "agenda_item_id")


@query
def step_procedures_of_numbers(spark, d):
    """P20: procedures of documents, without the other chamber's and without notices that several share."""
    return steps.procedures_of_numbers(_record_tables(spark, d))


@query
def step_referrals(spark, d):
    """Committees that an order's lines refer it to, leading if any line says so, the rest from the first line."""
    one = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.concat(F.lit("Ausschuss "), F.col("l_suppkey") % 7).alias("ausschuss"),
        F.concat(F.lit("A"), F.col("l_partkey").cast("string")).alias("ausschuss_kuerzel"), (F.col("l_returnflag") == "R").alias("federfuehrung"), F.concat(F.lit("Q"), F.col("l_quantity").cast("int")).alias("ueberweisungsart"),
    )
    r = _lines(spark, d).groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(F.min("sitting_id").alias("vorgang_id"), F.sort_array(F.collect_list(one)).alias("ueberweisung"))
    return steps.referrals(r)


@query
def step_retired(spark, d):
    """Placeholder customers without an urgent order and without a supplier of the same number."""
    persons = table(spark, d, "customer").select(F.concat(F.when(F.col("c_custkey") % 3 > 0, "pdf-").otherwise(""), F.col("c_custkey")).alias("id"), "c_name")
    used = lambda t, c, which="true": table(spark, d, t).where(which).select(F.concat(F.when(F.col(c) % 3 > 0, "pdf-").otherwise(""), F.col(c)).alias("person_id"))
    return steps.retired(persons, {"speech": used("orders", "o_custkey", "o_orderpriority LIKE '1%'"), "mandate": used("supplier", "s_suppkey")}).select("id", "c_name")


@query
def portraits_with_names(spark, d):
    """Q8: pictures (suppliers') with the names of persons (customers)."""
    person = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"))
    photo = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).cast("string").alias("person_id"), F.col("s_name").alias("image_url"))
    return queries.photos({"person": person, "person_photo": photo}).select("person_id", "image_url", "first_name", "last_name")
