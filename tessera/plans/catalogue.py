"""The query catalogue over the star-schema and event tables: every operator of the library in a runnable plan.

Each query takes (spark, sf_dir), reads its tables whole and returns a lazy DataFrame.
The equivalents in another dialect are in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import aggregates as A
from tessera.operators import checks, dedup, intervals, link, sequence, upsert
from tessera.operators.rounds import dealt
from tessera.session import TABLES, table

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}


def query(f: Query) -> Query:
    CATALOGUE[f.__name__] = f
    return f


def _moment(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _text(c: str | Column) -> Column:
    """A number that may be missing, as text: dialects and clients differ in how they carry such numbers."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _micros(a: Column, b: Column) -> Column:
    """Absolute distance of two moments in microseconds."""
    return F.abs(F.timestamp_diff("MICROSECOND", a, b))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("day", F.to_date("ts"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


# ---------------------------------------------------------------- canned queries on other tables


@query
def member_vs_cohort_majority(spark, d):
    """Q3: each user's own majority of a day against the cohort's, with the cohort's counts."""
    e = _events(spark, d).select("day", "user_id", (F.col("user_id") % 5).alias("cohort"), "event_type")
    # Counted once by user; the cohort's counts are sums of those, over a reused exchange.
    n = A.value_counts(e, ["day", "cohort", "user_id"], "event_type").withColumnRenamed("n", "events")
    own = A.majority(n, ["day", "cohort", "user_id"], "event_type", "own_type", weight="events")
    cohort = A.majority(n, ["day", "cohort"], "event_type", "majority_type", "counts", weight="events")
    return own.join(cohort, ["day", "cohort"]).withColumn("agrees", F.col("own_type") == F.col("majority_type"))


@query
def timeline_in_range(spark, d):
    """Q2: one segment's orders of a year, with their customer and, if known, nation."""
    o = _orders(spark, d).where(F.col("o_orderdate").between("1997-01-01", "1997-12-31"))
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    n = table(spark, d, "nation")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey, "left")
    return joined.select("o_orderkey", "o_orderdate", "c_name", "n_name", "o_totalprice").orderBy("o_orderdate", "o_orderkey")


@query
def authored_by_types(spark, d):
    """Q4: lines of listed part types in a range of days."""
    li = table(spark, d, "lineitem").withColumn("shipped", F.to_date("l_shipdate"))
    p = table(spark, d, "part").where(F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO"))
    joined = li.where(F.col("shipped").between("1998-01-01", "1998-06-30")).join(p, li.l_partkey == p.p_partkey)
    return joined.select("l_orderkey", "l_linenumber", "shipped", "p_name", "p_type").orderBy("shipped", "l_orderkey")


@query
def clean_corpus(spark, d):
    """Q5: one clean text a row, with its label if it has one."""
    t = table(spark, d, "documents").withColumn("clean", X.clean_text(F.col("text"))).where(F.length("clean") > 0)
    return t.join(table(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", "lang", F.length("clean").cast("long").alias("clean_chars"), F.md5(F.col("clean").cast("binary")).alias("clean_md5"), _text("quality").alias("quality")
    )


def _roles(spark, d) -> DataFrame:
    """First and last order of each customer and status as evidence; status P is only observed, F has one holder at a time."""
    seen = _orders(spark, d).groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderdate").alias("from_date"), F.max("o_orderdate").alias("to_date"))
    return seen.withColumn("role_id", F.concat_ws("-", "o_custkey", "o_orderstatus"))


@query
def roster_as_of(spark, d):
    """Q6: roles held on a day, sightings counting on until contradicted by a later role of the same customer."""
    held = intervals.held_on(
        _roles(spark, d), F.lit("1998-06-30").cast("date"), "role_id", "o_custkey", ["o_orderstatus"],
        F.lit(False), F.col("o_orderstatus") == "P", "from_date", "to_date",
    )
    rank = intervals.rank_of("o_orderstatus", ["F", "P", "O"])
    return held.withColumn("kind_rank", rank.cast("int")).orderBy("kind_rank", "from_date", "role_id")


@query
def stale_holders(spark, d):
    """Q7: customers whose last order lies over 90 days before the newest one."""
    o = _orders(spark, d)
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("to_date"))
    return intervals.stale(last, o.agg(F.max("o_orderdate").alias("newest")), "to_date", 90)


@query
def members_without_record(spark, d):
    """Q9: orders without any line, with the status of their customer's latest order."""
    o = _orders(spark, d)
    missing = checks.not_in(o, "o_orderkey", table(spark, d, "lineitem"), "l_orderkey")
    latest = o.groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("latest_status"))
    return missing.join(latest, "o_custkey").select("o_orderkey", "o_custkey", "latest_status")


@query
def decision_sheet(spark, d):
    """Q10: each order with its lines as one text in order, and totals only if it is finished."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        A.listing([F.col("l_linenumber"), F.col("l_partkey"), F.col("l_returnflag")], F.concat_ws(":", "l_linenumber", "l_partkey", "l_returnflag")).alias("lines"),
        F.count("*").alias("n"),
    )
    o = _orders(spark, d)
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "lines", _text(F.when(F.col("o_orderstatus") == "F", F.col("n"))).alias("n_if_finished")
    )


@query
def reconcile_two_sources(spark, d):
    """Q11: order status against the lines' statuses, both ways."""
    o, li = _orders(spark, d).select("o_orderkey", "o_orderstatus"), table(spark, d, "lineitem").select("l_orderkey", "l_linestatus")
    # Both sides are dealt once, by the number of lines, and met once.
    n = li.count()
    per = dealt(li, n, "l_orderkey").groupBy("l_orderkey").agg(F.min("l_linestatus").alias("low"), F.max("l_linestatus").alias("high"))
    said = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("P")
    both = dealt(o, n, "o_orderkey").join(per.hint("merge"), o.o_orderkey == per.l_orderkey, "left")
    told = both.withColumns({"kind": F.when(F.col("l_orderkey").isNull(), "missing").otherwise("result"), "line_status": F.when(F.col("l_orderkey").isNotNull(), said)})
    return told.where("kind = 'missing' OR line_status <> o_orderstatus").select("kind", "o_orderkey", "o_orderstatus", "line_status")


@query
def coverage_gaps(spark, d):
    """Q12: orders that neither of two sources carries, by month and cause."""
    li = table(spark, d, "lineitem")
    carried = li.where("l_returnflag = 'R'").select("l_orderkey").union(li.where("l_linestatus = 'F'").select("l_orderkey")).distinct()
    o = _orders(spark, d)
    cause = F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "P", "in_progress").otherwise("finished")
    gaps = o.join(carried, o.o_orderkey == carried.l_orderkey, "left_anti")
    return gaps.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), cause.alias("cause")).agg(
        F.count("*").alias("n_orders"), F.min("o_orderkey").alias("first_key")
    )


# ---------------------------------------------------------------- dedup, upsert, replace


@query
def latest_copy(spark, d):
    """The newest event of each user and type."""
    e = dedup.latest(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id")
    return e.select("user_id", "event_type", "event_id", _moment("ts").alias("at"), "value")


def _changes(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    urgent = o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("U1").alias("o_orderstatus"), F.lit(1).alias("seq"))
    again = o.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select("o_orderkey", F.lit("U2").alias("o_orderstatus"), F.lit(2).alias("seq"))
    new = o.where("o_orderpriority = '2-HIGH'").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(1).alias("seq"))
    return urgent.unionByName(again).unionByName(new)


@query
def upsert_image(spark, d):
    """K1: orders after a batch that changes one column, repeats keys and brings new ones."""
    base = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return upsert.upsert(base, _changes(spark, d), ["o_orderkey"], [F.col("seq").desc()]).withColumn("o_custkey", _text("o_custkey"))


@query
def replace_partition(spark, d):
    """K3: one year's orders replaced, the others as they were."""
    o = _orders(spark, d).select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus")
    again = o.where("year = 1996 AND o_orderstatus <> 'P'").withColumn("o_orderstatus", F.lit("R"))
    return upsert.replace_where(o, F.col("year") == 1996, again)


@query
def stale_rows_removed(spark, d):
    """K4: open orders go unless they have lines; a reference to a customer who never finished one becomes null."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    kept = upsert.drop_stale(o, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"], F.col("o_orderstatus") == "O")
    return upsert.null_dangling(kept, "o_custkey", o.where("o_orderstatus = 'F'").select("o_custkey"), "o_custkey").withColumn("o_custkey", _text("o_custkey"))


# ---------------------------------------------------------------- joins


@query
def positional_pairs(spark, d):
    """The k-th click with the k-th purchase of a user's day, where there are as many of both."""
    e = _events(spark, d)
    clicks = e.where("event_type = 'click'").withColumnRenamed("event_id", "click_id")
    bought = e.where("event_type = 'purchase'").withColumnRenamed("event_id", "purchase_id")
    return link.positional(clicks, bought, ["user_id", "day"], ["ts", "click_id"], ["ts", "purchase_id"], ["click_id"], ["purchase_id"])


@query
def nearest_pair(spark, d):
    """Each purchase with the user's click nearest in time."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    bought = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    clicks = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"))
    found = link.nearest(bought, clicks, ["user_id"], "ts", "click_id", _micros)
    return found.select("purchase_id", "user_id", "click_id", F.col("distance").alias("micros"))


@query
def tolerance_pairs(spark, d):
    """Suppliers of a nation whose balances differ by 500 at most."""
    s = table(spark, d, "supplier")
    a = s.select(F.col("s_nationkey"), F.col("s_suppkey").alias("a_key"), F.col("s_acctbal").alias("a_bal"))
    b = s.select(F.col("s_nationkey"), F.col("s_suppkey").alias("b_key"), F.col("s_acctbal").alias("b_bal"))
    pairs = link.within_tolerance(a, b, ["s_nationkey"], "a_bal", "b_bal", 500.0).where("a_key < b_key")
    return pairs.select("s_nationkey", "a_key", "b_key", F.abs(F.col("a_bal") - F.col("b_bal")).alias("difference"))


@query
def interval_cover(spark, d):
    """Lines shipped within their customer's active interval, open if an order is."""
    o = _orders(spark, d)
    active = intervals.combine(
        o.withColumns({"start": F.col("o_orderdate"), "end": F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))}), ["o_custkey"], "start", "end"
    )
    li = table(spark, d, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("shipped"))
    facts = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    return link.covering(facts, active, ["o_custkey"], "shipped", "start", "end").groupBy("o_custkey", "start", "end").agg(F.count("*").alias("n_lines"))


@query
def asof_last_event(spark, d):
    """The user's last click at or before each purchase."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    bought = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    clicks = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    # In buckets of a day, so that a user with a large share of all events is not one task's.
    found = link.asof_in_buckets(bought, clicks, ["user_id"], "ts", ["click_id", "click_ts"], F.to_date("ts")).where("click_id IS NOT NULL")
    return found.select("purchase_id", "user_id", "click_id", _micros(F.col("click_ts"), F.col("ts")).alias("micros"))


@query
def name_cascade(spark, d):
    """Parts looked up by name among economy parts, then all; a size decides between several; ambiguity gives null."""
    p = table(spark, d, "part").select(
        "p_partkey", "p_type", "p_size", F.split("p_name", " ")[1].alias("last"), F.split("p_name", " ")[0].alias("first")
    )
    economy = p.where("p_type = 'ECONOMY'")
    full = F.concat_ws("|", "last", "first")
    initial = F.concat_ws("|", "last", F.substring("first", 1, 1))
    steps = [(full, economy, full), (initial, economy, initial), (full, p, full), (initial, p, initial)]
    return link.cascade(p, "p_partkey", "p_size", steps, "p_partkey", "p_size").withColumns({c: _text(c) for c in ("matched_id", "step", "n_candidates")})


@query
def link_precedence(spark, d):
    """Part types of an order by its returned, else its finished, else all lines; one target or none."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    typed = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "p_type", "l_returnflag", "l_linestatus")
    ways = [("returned", typed.where("l_returnflag = 'R'")), ("finished", typed.where("l_linestatus = 'F'")), ("any", typed)]
    return link.by_precedence(ways, "l_orderkey", "p_type")


@query
def shared_doc_exclusion(spark, d):
    """Orders of parts that no more than 30 orders share."""
    return link.without_shared(table(spark, d, "lineitem"), "l_partkey", "l_orderkey", 30)


@query
def array_overlap_join(spark, d):
    """Numbers that a page's address shares with its own source."""
    p = table(spark, d, "pages")
    numbers = lambda c: F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0))
    both = p.select("page_id", F.array_distinct(numbers("url")).alias("a"), F.array_distinct(numbers("html")).alias("b")).where(F.arrays_overlap("a", "b"))
    shared = F.array_intersect("a", "b")
    return both.select("page_id", F.size(shared).cast("long").alias("n_shared"), F.array_join(F.sort_array(shared), ",").alias("shared"))


@query
def token_overlap(spark, d):
    """Documents that hold at least half of the longer words of a benchmark item."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{5,}"), F.lit(0)))
    t = table(spark, d, "documents").select("doc_id", words("text").alias("a"))
    i = table(spark, d, "benchmark").select("item_id", words("text").alias("b"))
    return link.token_overlap(t, i, "doc_id", "item_id", "a", "b", least=3, ratio=0.5)


@query
def semi_filter(spark, d):
    """Orders with a line of at least 49 pieces."""
    o = table(spark, d, "orders")
    big = table(spark, d, "lineitem").where("l_quantity >= 49")
    return o.join(big, o.o_orderkey == big.l_orderkey, "left_semi").select("o_orderkey", "o_custkey", "o_orderpriority")


@query
def dimension_lookup(spark, d):
    """Events with the last order that names their user as customer; a repeated key's last row counts."""
    last = table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_orderdate")
    users = table(spark, d, "events").select("user_id").distinct()
    return link.lookup(users, last, ["user_id"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("user_id", "o_orderkey")


@query
def self_join_replacement(spark, d):
    """Orders without lines with the same customer's next order that has some."""
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    lost, good = o.join(li, "o_orderkey", "left_anti"), o.join(li, "o_orderkey", "left_semi")
    later = good.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("replaced_by"))
    lost = lost.withColumnRenamed("o_orderkey", "lost_key")
    first = later.groupBy("o_custkey", "o_orderdate").agg(F.min("replaced_by").alias("replaced_by"))
    return link.asof(lost, first, ["o_custkey"], "o_orderdate", ["replaced_by"], forward=True).withColumn("replaced_by", _text("replaced_by"))


@query
def unreferenced_rows(spark, d):
    """Nations that neither a customer nor a supplier points to, and customers without a nation."""
    n, c, s = (table(spark, d, t) for t in ("nation", "customer", "supplier"))
    none = checks.unreferenced(n, "n_nationkey", [(c, "c_nationkey"), (s, "s_nationkey")])
    lost = checks.orphans(c, "c_nationkey", n, "n_nationkey")
    return none.agg(F.count("*").alias("n")).select(F.lit("unreferenced").alias("kind"), "n").unionByName(
        lost.agg(F.count("*").alias("n")).select(F.lit("orphans").alias("kind"), "n")
    )


# ---------------------------------------------------------------- aggregates and intervals


@query
def pivot_totals(spark, d):
    """A10: lines by flag, a column for each status, and exact money."""
    li = table(spark, d, "lineitem")
    counts = A.pivot_counts(li, ["l_returnflag"], "l_linestatus", ["F", "O"])
    money = li.groupBy("l_returnflag").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return counts.join(money, "l_returnflag")


@query
def distinct_counts(spark, d):
    """A3, A4: exact distinct counts, some under a condition."""
    return table(spark, d, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("n_big_users"),
        F.count_if(F.col("value") > 50).alias("n_big"),
    )


@query
def interval_combine(spark, d):
    """A customer's orders as one interval, open if one is open."""
    o = _orders(spark, d).withColumns({"from_date": F.col("o_orderdate"), "to_date": F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))})
    return intervals.combine(o, ["o_custkey"], "from_date", "to_date")


@query
def priority_merge(spark, d):
    """A nation's first name from customers, else suppliers; its balance the other way round."""
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.min("c_name").alias("name"), F.max("c_acctbal").alias("balance")).withColumn("source", F.lit("customer"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.min("s_name").alias("name"), F.max("s_acctbal").alias("balance")).withColumn("source", F.lit("supplier"))
    return intervals.merge_by_rank(c.unionByName(s), ["nation"], "source", ["customer", "supplier"], ["name"], ["supplier", "customer"], ["balance"])


@query
def successor_close(spark, d):
    """A day's open order of a nation is closed by the next finished order of another customer of it."""
    o, c = _orders(spark, d), table(spark, d, "customer")
    of = o.join(c, o.o_custkey == c.c_custkey).select("c_nationkey", "o_custkey", "o_orderdate", "o_orderstatus", "c_mktsegment")
    held = of.where("o_orderstatus = 'P'").groupBy("c_nationkey", "c_mktsegment", "o_custkey").agg(F.max("o_orderdate").alias("start")).withColumn("end", F.lit(None).cast("date"))
    later = of.where("o_orderstatus = 'F'").groupBy("c_nationkey", "c_mktsegment", "o_custkey").agg(F.max("o_orderdate").alias("start"))
    return intervals.close_by_successor(held, later, ["c_nationkey", "c_mktsegment"], "o_custkey", "start", "end").withColumn("successor", _text("successor"))


@query
def completeness_status(spark, d):
    """How far each order's lines are done."""
    o = table(spark, d, "orders")
    per = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("done"))
    n, done = F.coalesce("n", F.lit(0)), F.coalesce("done", F.lit(0))
    return o.join(per, o.o_orderkey == per.l_orderkey, "left").select("o_orderkey", A.completeness(n, done).alias("status"))


@query
def table_counts(spark, d):
    """Rows of every table."""
    return checks.table_counts({t: table(spark, d, t) for t in TABLES})


@query
def snapshot_diff(spark, d):
    """Orders by status and priority before 2000 against all but urgent ones of now."""
    o = _orders(spark, d).withColumn("bin", F.concat_ws("/", "o_orderstatus", "o_orderpriority"))
    count = lambda x: x.groupBy("bin").agg(F.count("*").alias("n"))
    return checks.snapshot_diff(count(o.where("o_orderdate < '2000-01-01'")), count(o.where("o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'O'")), "bin", "n").withColumns({c: _text(c) for c in ("n_before", "n_now")})


@query
def first_last_evidence(spark, d):
    """First and last day of each user and type, with the event that showed it first."""
    e = _events(spark, d)
    return e.groupBy("user_id", "event_type").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event")
    )


@query
def only_target(spark, d):
    """A customer's order priority if there was only ever one."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(A.only_value(F.col("o_orderpriority")).alias("priority"), F.count("*").alias("n"))


# ---------------------------------------------------------------- ordered rows


@query
def speaker_islands(spark, d):
    """Runs of one event type, numbered for each user."""
    e = sequence.islands(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return e.groupBy("user_id", "part", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query
def running_before(spark, d):
    """User turns before each turn of a conversation."""
    c = table(spark, d, "conversations")
    return sequence.count_before(c, ["conv_id"], ["turn"], F.col("role") == "user", "user_turns_before").select("conv_id", "turn", "role", "user_turns_before")


@query
def stream_interleave(spark, d):
    """A user's clicks and purchases of all days as one numbered stream, clicks first at a tie of days."""
    e = _events(spark, d).select("user_id", "day", "event_id", "event_type")
    w = sequence.interleaved([e.where(F.col("event_type") == t) for t in ("click", "purchase")], ["user_id"], ["day"], "n")
    return w.groupBy("user_id", "event_type").agg(F.min("n").cast("long").alias("first_at"), F.max("n").cast("long").alias("last_at"))


@query
def block_split(spark, d):
    """A user's events in blocks that a signup opens; users with one signup have none."""
    e = sequence.blocks(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup")
    return e.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.min("event_id").alias("low_id"), F.max("event_id").alias("high_id"))


@query
def last_n_context(spark, d):
    """Lengths of the last three texts of a conversation at each turn."""
    c = sequence.context(table(spark, d, "conversations"), ["conv_id"], ["turn"], F.length("text"), 3, "lengths")
    return c.select("conv_id", "turn", F.array_join(F.col("lengths").cast("array<string>"), ",").alias("lengths"))


@query
def carry_forward(spark, d):
    """The user's last signup at each event."""
    e = sequence.carried(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "last_signup")
    return e.select("event_id", "user_id", _text("last_signup").alias("last_signup"))


@query
def unique_suffix(spark, d):
    """Part names made unique by a suffix."""
    return dedup.suffixed(table(spark, d, "part"), "p_name", [F.col("p_partkey")], "unique_name").select("p_partkey", "unique_name")


@query
def first_interruption(spark, d):
    """W8, window part: the first event of a user's day whose type differs from the day's first."""
    e = _events(spark, d)
    opening = e.groupBy("user_id", "day").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("opening"))
    other = e.join(opening, ["user_id", "day"]).where("event_type <> opening")
    return other.groupBy("user_id", "day", "opening").agg(F.min_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("x")).select(
        "user_id", "day", "opening", F.col("x.event_id").alias("event_id"), F.col("x.event_type").alias("event_type")
    )


@query
def row_number_positions(spark, d):
    """Turns numbered, with the next turn's role."""
    c = sequence.positions(table(spark, d, "conversations"), ["conv_id"], ["turn"])
    return sequence.lookahead(c, ["conv_id"], ["turn"], "role", 1, "next_role").select("conv_id", "turn", "position", "role", "next_role")


@query
def lookback_window(spark, d):
    """From when on each event type has to be fetched anew."""
    return _events(spark, d).groupBy("event_type").agg(F.date_sub(F.max("day"), 14).alias("refetch_from"))


# ---------------------------------------------------------------- sorts, sets, scalars


@query
def numeric_key_sort(spark, d):
    """Parts by the number in their brand, not its text."""
    p = table(spark, d, "part")
    n = X.leading_int(F.split("p_brand", "#")[1])
    from pyspark.sql import Window

    brands = p.groupBy("p_brand").agg(F.count("*").alias("n_parts")).withColumn("brand_no", n)
    return brands.withColumn("place", F.row_number().over(Window.orderBy(F.col("brand_no").asc_nulls_first(), "p_brand"))).orderBy("place")


@query
def longest_match(spark, d):
    """The longest of a list of prefixes that a part's name starts with."""
    return table(spark, d, "part").select("p_partkey", X.longest_prefix(F.col("p_name"), PREFIXES).alias("prefix"))


PREFIXES = ("red", "red w", "small", "small r", "large", "blue", "green g", "b", "g")


@query
def enum_rank_sort(spark, d):
    """Customers of each segment by a rank that is not the alphabet's."""
    rank = intervals.rank_of("c_mktsegment", ["MACHINERY", "BUILDING", "HOUSEHOLD"])
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n")).withColumn("place", rank.cast("int")).orderBy("place", "c_mktsegment")


@query
def set_algebra(spark, d):
    """Customers who ordered in both of two years, and in the first only."""
    o = _orders(spark, d)
    of = lambda y: o.where(F.year("o_orderdate") == y).select("o_custkey")
    both = of(1996).intersect(of(1997)).withColumn("kind", F.lit("both"))
    only = of(1996).subtract(of(1997)).withColumn("kind", F.lit("only_1996"))
    return both.unionByName(only)


@query
def first_source_wins(spark, d):
    """U4: a nation's representative from suppliers, else from customers."""
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    return dedup.first_of_sources([s, c], ["nation"], [F.col("name")])


@query
def sentence_explode(spark, d):
    """Sentences of every document with their places."""
    t = table(spark, d, "documents")
    return t.select("doc_id", F.posexplode(F.split("text", r"[.!?]\s+")).alias("pos", "sentence")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), F.length("sentence").cast("long").alias("n_chars")
    )


@query
def html_text(spark, d):
    """Title and text of a page."""
    body = X.strip_tags(F.col("html"))
    return table(spark, d, "pages").select(
        "page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.length(body).cast("long").alias("n_chars"), F.md5(body.cast("binary")).alias("text_md5")
    )


@query
def json_props(spark, d):
    """A number out of a JSON text."""
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.count("k").alias("n_k"))


@query
def category_map(spark, d):
    """Codes to labels, unknown ones kept."""
    label = X.mapped(F.col("c_mktsegment"), {"BUILDING": "construction", "MACHINERY": "machines", "HOUSEHOLD": "homes"}, F.lower("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", label.alias("label"))


@query
def period_of_date(spark, d):
    """The period that each order falls in."""
    starts = [("1994-06-01", 12), ("1996-03-15", 13), ("1998-10-26", 14), ("2000-09-30", 15)]
    o = _orders(spark, d).withColumn("period", X.period_of(F.col("o_orderdate"), starts))
    return o.groupBy("period").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_day"))


@query
def normalized_names(spark, d):
    """Names in their form for matching."""
    return table(spark, d, "customer").select("c_custkey", X.normalize_name(F.concat(F.lit("Dr. "), F.col("c_name"), F.lit(" von "), F.lower("c_mktsegment"))).alias("name"))


@query
def case_insensitive_like(spark, d):
    """LIKE without regard to case."""
    return table(spark, d, "part").where(F.col("p_name").ilike("%RING%") & ~F.col("p_type").ilike("promo%")).select("p_partkey", "p_name", "p_type")


@query
def exists_flags(spark, d):
    """Of each customer's orders, how many have a returned line, and how many any; EXISTS as joins to distinct keys."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    flag = lambda cond, name: li.where(cond).select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn(name, F.lit(True))
    joined = o.join(flag("l_returnflag = 'R'", "_r"), "o_orderkey", "left").join(flag("true", "_any"), "o_orderkey", "left")
    return joined.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if("_r").alias("n_returned"), F.count_if("_any").alias("n_any"))


@query
def scalar_conversions(spark, d):
    """Decimal commas, page ranges and back, days out of seconds, days before."""
    o = _orders(spark, d)
    comma = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    pages = X.page_range(F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_custkey") % 3)
    return o.select(
        "o_orderkey",
        X.decimal_comma(comma).alias("price"),
        pages.alias("pages"),
        X.first_page(pages).alias("first_page"),
        X.unix_day(F.unix_date("o_orderdate").cast("long") * 86400 + 3600).alias("day"),
        F.date_sub("o_orderdate", 1).alias("day_before"),
        X.document_id(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("cited"),
    )


@query
def table_invariants(spark, d):
    """§1.3: repeated keys of every keyed table."""
    keys = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "part": ["p_partkey"], "supplier": ["s_suppkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}
    each = [checks.repeated_keys(table(spark, d, t), k).agg(F.count("*").alias("n_repeated")).select(F.lit(t).alias("table_name"), "n_repeated") for t, k in keys.items()]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out


@query
def first_and_last_wins(spark, d):
    """Of a day's events of a type, the first by time of each user's, and the last."""
    e = _events(spark, d)
    w = ["user_id", "day", "event_type"]
    first = dedup.best_row(e, w, [F.col("ts"), F.col("event_id")]).select(*w, F.col("event_id").alias("first_id"))
    last = dedup.latest(e, w, "ts", "event_id").select(*w, F.col("event_id").alias("last_id"))
    return first.join(last, w)


@query
def dates_in_text(spark, d):
    """Days out of numeric and of German dates in words, null where there is none."""
    o = _orders(spark, d)
    month = F.element_at(F.array(*(F.lit(m.capitalize()) for m in X.MONTHS)), F.month("o_orderdate"))
    words = F.concat(F.lit("Sitzung am "), F.dayofmonth("o_orderdate").cast("string"), F.lit(". "), month, F.lit(" "), F.year("o_orderdate").cast("string"), F.lit(" in Berlin"))
    numeric = F.date_format("o_orderdate", "dd.MM.yyyy")
    none = F.col("o_orderkey") % 5 == 0
    return o.select(
        "o_orderkey",
        X.iso_date(F.when(none, F.lit("")).otherwise(F.concat(F.lit(" "), numeric))).alias("numeric_day"),
        X.german_date(F.when(none, F.lit("ohne Datum")).otherwise(words)).alias("worded_day"),
        X.german_date(F.concat(F.lit("vom "), numeric, F.lit(" bis 3. Mai 1999"))).alias("first_day"),
    )


@query
def numbers_in_text(spark, d):
    """Document numbers found in a sentence; one of seven digits is none."""
    o = table(spark, d, "orders")
    number = F.concat((F.col("o_custkey") % 100).cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"))
    text = F.concat(F.lit("Drucksachen "), number, F.lit(", 3/7 und 12/1234567"))
    found = X.document_numbers(text)
    return o.select("o_orderkey", F.array_join(found, ",").alias("numbers"), F.size(found).alias("n_numbers"))


@query
def event_histogram(spark, d):
    """How many events of each type a day has."""
    return A.value_counts(_events(spark, d), ["day"], "event_type")


@query
def bare_column(spark, d):
    """Per customer the status that stands beside the earliest order, chosen openly rather than left to the engine."""
    earliest = F.struct("o_orderdate", "o_orderkey")
    return _orders(spark, d).groupBy("o_custkey").agg(F.count("*").alias("n"), F.min_by("o_orderstatus", earliest).alias("first_status"))


@query
def first_match_in_order(spark, d):
    """The first event of a user, in order, whose value passes 50; null if none does."""
    at = F.when(F.col("value") > 50, F.struct("ts", "event_id"))
    return _events(spark, d).groupBy("user_id").agg(_text(F.min_by("event_id", at)).alias("first_over"))


@query
def distinct_in_order(spark, d):
    """The return flags and the statuses of an order's lines without repetitions, as they first occur."""
    listed = lambda c: F.array_join(dedup.distinct_in_order(F.sort_array(F.collect_list(F.struct("l_linenumber", c)))[c]), ",")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(listed("l_returnflag").alias("flags"), listed("l_linestatus").alias("statuses"))


@query
def word_sets_and_prefixes(spark, d):
    """parts whose name has a word of a set, and those whose type begins with one of some words."""
    p = table(spark, d, "part")
    words = F.split(F.lower("p_name"), " ")
    begins = F.lit(False)
    for x in ("ECO", "PROMO"):
        begins = begins | F.startswith("p_type", F.lit(x))
    held = F.arrays_overlap(words, F.array(F.lit("ring"), F.lit("widget")))
    return p.select("p_partkey", held.alias("has_word"), begins.alias("begins"))


@query
def interruption_machine(spark, d):
    """Of a user's day, which types of events cut into the one that opened it, and from which event on."""
    e = _events(spark, d).withColumns({"speech": F.concat_ws("/", "user_id", "day"), "words": F.col("value").cast("int"), "announced": F.col("event_type") == "signup"})
    slim = e.select("speech", "ts", "event_type", "event_id", "words", "announced")
    return sequence.interruptions(slim, "speech", "ts", "event_type", "event_id", "words", "announced").select("speech", "event_id", "interruption", _text("interruption_start").alias("interruption_start"))


@query
def most_common_first(spark, d):
    """The quantity that a supplier sends most often, of equals the one sent first."""
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return A.most_common(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", order, "quantity")


def _set_on_pages(c: DataFrame) -> DataFrame:
    """Conversations as placed characters: twenty turns a page, a turn a line; half of the blanks are gaps, digits stand raised."""
    said = c.select(F.col("conv_id").alias("document"), (F.col("turn") / 20).cast("int").alias("page"), (F.col("turn") % 20).alias("slot"), "role", F.regexp_replace("text", "[ \t\r\n]+", " ").alias("text"))
    one = said.select("document", "page", "slot", "role", F.posexplode(F.split("text", "")).alias("k", "text"))
    digit = F.col("text").rlike("^[0-9]$")
    bottom = 90.0 + 30 * F.col("slot")
    return one.where("text != '' AND (text != ' ' OR k % 2 = 0)").select(
        "document", "page", "text", (60.0 + 5 * F.col("k")).alias("x0"), (65.0 + 5 * F.col("k")).alias("x1"),
        F.when(digit, bottom - 9.0).otherwise(bottom - 10.0).alias("top"), F.when(digit, bottom - 3.0).otherwise(bottom).alias("bottom"),
        F.when(digit, 6.0).otherwise(10.0).alias("size"), F.when(F.col("role") == "assistant", "Times-Bold").otherwise("Times").alias("font"),
        F.lit(True).alias("upright"), F.lit(595.0).alias("width"), F.lit(842.0).alias("height"),
    )


@query
def lines_of_characters(spark, d):
    """Conversations set on pages character by character, and put together again line by line."""
    from tessera.sources import layout

    said = table(spark, d, "conversations")
    # Characters of a page are nearly alike: by the bytes they are packed into, Spark would give a task too many to sort.
    # Their number is close enough from the lengths; so dealt by page, no later step moves them.
    n = said.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    found = layout.lines(dealt(_set_on_pages(said), n, *layout.PAGE))
    return found.select(F.col("document").alias("conv_id"), F.col("page").cast("long").alias("page"), "line", "bold", F.trim("text").alias("text"))


# ---------------------------------------------------------------- one step depends on the one before: no SQL


@query
def greedy_pairs(spark, d):
    """Suppliers of a nation paired off by growing difference of balances, each once."""
    from tessera.operators import assign

    pairs = tolerance_pairs(spark, d)
    return assign.greedy(pairs, ["s_nationkey"], "a_key", "b_key", "difference")


@query
def best_assignment(spark, d):
    """Of each conversation, the user's turns with the assistant's whose words overlap them most."""
    from tessera.operators import assign

    c = table(spark, d, "conversations").select("conv_id", "turn", "role", X.words(F.col("text"), 4).alias("w"))
    a = c.where("role = 'user'").select("conv_id", F.col("turn").alias("asked"), F.col("w").alias("wa"))
    b = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("answered"), F.col("w").alias("wb"))
    pairs = a.join(b, "conv_id").select("conv_id", "asked", "answered", X.overlap_ratio(F.col("wa"), F.col("wb")).alias("score"))
    return assign.best_assignment(pairs, ["conv_id"], "asked", "answered", "score")
