"""Builds the raw customer, complaint, behaviour and demographic tables from transactional sources.

The sources are the core tables (customer, nation, region), orders and line items, the event
stream and the conversation log. Orders and items are cut at ``as_of``, and the label looks past it; the event
table is taken whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions.scalar import clip
from ebbwatch.sources.storage import read_table, spread


@dataclass(frozen=True)
class Calendar:
    """Fixed dates of the snapshot: the cut-off and the starts of the look-back windows."""

    as_of: str = "2000-08-01"
    year_start: str = "1999-08-01"
    half_start: str = "2000-02-01"
    quarter_start: str = "2000-05-01"
    balance_scale: float = field(default=50.0)


DEFAULT_CALENDAR = Calendar()


def ntz(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def customer_key(key: Column | str) -> Column:
    """``CLI-`` and the key with at least seven digits; longer keys are kept whole."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit("CLI-"), F.lpad(text, F.greatest(F.length(text), F.lit(7)), F.lit("0")))


def cents(amount: str) -> Column:
    """Money as whole cents: integer sums do not depend on the order of addition."""
    return F.round(F.col(amount) * 100).cast("bigint")


def order_history(orders: DataFrame, cal: Calendar) -> DataFrame:
    """Everything the snapshot needs from orders, in one aggregation per customer."""
    day = F.col("o_orderdate")
    before = day < ntz(cal.as_of)
    half = before & (day >= ntz(cal.half_start))
    quarter = before & (day >= ntz(cal.quarter_start))
    amount = cents("o_totalprice")
    return orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.min(F.when(before, day)).alias("first_order"),
        F.max(F.when(before, day)).alias("last_order"),
        F.sum(F.when(before, amount)).alias("cents_all"),
        F.sum(F.when(half, amount)).alias("cents_half"),
        F.sum(F.when(quarter, amount)).alias("cents_quarter"),
        F.count_if(quarter).alias("orders_quarter"),
        F.count_if(half).alias("orders_half"),
        F.count_if(before & (F.col("o_orderstatus") == "F")).alias("orders_closed"),
        F.count_if(before).alias("orders_all"),
        F.count_if(~before).alias("orders_later"),
    )


def item_history(lineitem: DataFrame, orders: DataFrame, part: DataFrame, cal: Calendar) -> DataFrame:
    """Line-item facts per customer, from two joins that are each pruned by a date.

    Items and product types come from the orders of one year, shipped and returned items from the items of half a
    year; both date ranges reach the scans. The distinct product types are counted by grouping on (customer, type)
    first, so no set of a hot customer is ever collected.
    """
    ordered, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    in_year = (ordered >= ntz(cal.year_start)) & (ordered < ntz(cal.as_of))
    in_half = (ordered >= ntz(cal.half_start)) & (ordered < ntz(cal.as_of))
    in_quarter = (shipped >= ntz(cal.quarter_start)) & (shipped < ntz(cal.as_of))
    ship_half = (shipped >= ntz(cal.half_start)) & (shipped < ntz(cal.as_of))
    returned = F.col("l_returnflag") == "R"
    keys = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    types = part.select("p_partkey", "p_type")
    of_year = (
        lineitem.select("l_orderkey", "l_partkey")
        .join(keys.where(in_year), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(types, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy(F.col("o_custkey").alias("custkey"), "p_type")
        .agg(F.count_if(in_half).alias("items_half"))
    )
    shipped_items = (
        lineitem.select("l_orderkey", "l_shipdate", "l_returnflag")
        .where(ship_half)
        .join(keys.drop("o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(
            F.count_if(in_quarter).alias("shipped_quarter"),
            F.count_if(in_quarter & returned).alias("returned_quarter"),
            F.count_if(returned).alias("returned_half"),
        )
    )
    none = F.lit(0).cast("bigint")
    counters = ("items_half", "types_used", "shipped_quarter", "returned_quarter", "returned_half")
    both = of_year.select(
        "custkey", "items_half", F.when(F.col("p_type").isNotNull(), 1).otherwise(0).cast("bigint").alias("types_used"),
        *[none.alias(c) for c in counters[2:]],
    ).union(shipped_items.select("custkey", *[none.alias(c) for c in counters[:2]], *counters[2:]))
    return both.groupBy("custkey").agg(*[F.sum(c).alias(c) for c in counters])


def event_history(events: DataFrame) -> DataFrame:
    """Activity of a customer over all events given; the event table is not cut by date."""
    return events.groupBy(F.col("user_id").alias("custkey")).agg(
        F.count_if(F.col("event_type") != "error").alias("logins")
    )


def customer_facts(spark: SparkSession, folder: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """One row per customer with the joined histories (counters still null where there is no history).

    All three histories are hash-partitioned by customer, so the joins need one more shuffle only,
    that of the customer table. Nation and region are tiny and fixed; Catalyst broadcasts them by
    their size.
    """
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    orders = read_table(spark, folder, "orders")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    base = customer.join(places, customer.c_nationkey == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_nationkey"),
        F.col("c_acctbal"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("segment"),
    )
    items = item_history(read_table(spark, folder, "lineitem"), orders, read_table(spark, folder, "part"), cal)
    return (
        base.join(order_history(orders, cal), "custkey", "left")
        .join(items, "custkey", "left")
        .join(event_history(read_table(spark, folder, "events")), "custkey", "left")
    )


def _derived(cal: Calendar) -> dict[str, Column]:
    """Snapshot columns over the facts, before duplication of rows."""
    key = F.col("custkey")
    day = lambda c: F.datediff(ntz(cal.as_of).cast("date"), F.col(c).cast("date"))
    return {
        "customer_id": customer_key(key),
        "age": (F.lit(18) + (key * 37) % 63).cast("int"),
        "tenure_months": F.coalesce(F.floor(day("first_order") / 30), F.lit(0)).cast("int"),
        "region": F.col("region"),
        "segment": F.col("segment"),
        "avg_balance_6m": F.col("cents_half") / 100.0 * F.lit(cal.balance_scale) / 6.0,
        "monthly_transactions": F.coalesce("items_half", F.lit(0)).cast("int"),
        "app_logins_30d": F.col("logins").cast("int"),
        "n_products": F.coalesce("types_used", F.lit(0)).cast("int"),
        "clv_score": F.coalesce(F.col("cents_all") / 100.0, F.lit(0.0)) * 0.5,
        "n_complaints_3m": F.when(F.col("shipped_quarter") > 0, F.col("returned_quarter")).cast("int"),
        "nps_score": F.when(key % 10 != 0, (key * 7) % 11).cast("int"),
        "days_since_last_contact": day("last_order").cast("int"),
        "last_contact_date": F.col("last_order").cast("date"),
        "churn_label": F.when(
            key % 97 != 0, F.when(F.coalesce("orders_later", F.lit(0)) > 0, F.lit(0)).otherwise(F.lit(1))
        ).cast("int"),
        "ingestion_ts": ntz(cal.as_of),
    }


def customer_raw(spark: SparkSession, folder: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Raw customer table; every twentieth key also has an older copy, as a source with updates would."""
    facts = customer_facts(spark, folder, cal)
    copies = F.when(F.col("custkey") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    derived = _derived(cal)
    age_now, stamp_now = derived["age"], derived["ingestion_ts"]
    derived["age"] = (age_now + F.col("_copy")).cast("int")
    derived["ingestion_ts"] = F.when(
        F.col("_copy") == 0, stamp_now
    ).otherwise(stamp_now - F.expr("INTERVAL 1 DAY"))
    return facts.withColumn("_copy", F.explode(copies)).select(*[c.alias(n) for n, c in derived.items()])


def complaints(spark: SparkSession, folder: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Complaint texts: what the customer side of the conversation log says.

    A 60-bit hash of conversation and turn is the key of the complaint, whatever the number of turns.
    """
    turns = spread(read_table(spark, folder, "conversations").where(F.col("role") == "user"))
    cid = F.conv(F.substring(F.md5(F.concat_ws(":", "conv_id", "turn")), 1, 15), 16, 10).cast("bigint")
    channel = F.element_at(F.array(*[F.lit(c) for c in K.COMPLAINT_CHANNELS]), (cid % 4 + 1).cast("int"))
    return turns.select(
        cid.alias("complaint_id"),
        customer_key("conv_id").alias("customer_id"),
        F.col("text").alias("complaint_text"),
        F.date_sub(ntz(cal.as_of).cast("date"), (cid % 90 + 1).cast("int")).alias("complaint_date"),
        channel.alias("channel"),
    )


def half_up(value: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def percent_change(now: Column, before: Column) -> Column:
    """Whole percent change, 0 when there is nothing to compare with."""
    return F.when(before > 0, half_up((now - before) * 100.0 / before, 0)).otherwise(F.lit(0.0))


def behaviour(spark: SparkSession, folder: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Behaviour table of the network model: eight features and the label, one row per customer."""
    d = _derived(cal)
    recent = F.coalesce("cents_quarter", F.lit(0))
    earlier = F.coalesce("cents_half", F.lit(0)) - recent
    orders_recent = F.coalesce("orders_quarter", F.lit(0))
    orders_earlier = F.coalesce("orders_half", F.lit(0)) - orders_recent
    raw = {
        "dias_sin_app": F.coalesce(d["days_since_last_contact"], F.lit(180)).cast("double"),
        "var_saldo_pct": percent_change(recent, earlier),
        "var_transacciones_pct": percent_change(orders_recent, orders_earlier),
        "num_productos": clip(d["n_products"], 1, 6).cast("int"),
        "reclamos_6m": clip(F.coalesce("returned_half", F.lit(0)), 0, 10).cast("int"),
        "antiguedad_anos": half_up(d["tenure_months"] / 12.0, 1),
        "uso_tarjeta_credito": F.coalesce(
            F.when(F.col("orders_all") > 0, half_up(F.col("orders_closed") * 100.0 / F.col("orders_all"), 0)),
            F.lit(0.0),
        ),
        "score_satisfaccion": F.coalesce(d["nps_score"], F.lit(5)).cast("double"),
    }
    for name, low, high in K.BEHAVIOUR_CLIPS:
        raw[name] = clip(raw[name], low, high)
    return customer_facts(spark, folder, cal).select(
        d["customer_id"].alias("customer_id"),
        *[c.alias(n) for n, c in raw.items()],
        F.coalesce(d["churn_label"], F.lit(0)).cast("int").alias("churn"),
    )


def demographic(spark: SparkSession, folder: str, cal: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Demographic table of the text model: twelve features and the label."""
    d = _derived(cal)
    key = F.col("custkey")
    country = F.element_at(
        F.array(F.lit("España"), F.lit("Francia"), F.lit("Alemania")), (F.col("c_nationkey") % 3 + 1).cast("int")
    )
    return customer_facts(spark, folder, cal).select(
        d["customer_id"].alias("customer_id"),
        d["age"].alias("edad"),
        F.when(key % 2 == 0, F.lit("masculino")).otherwise(F.lit("femenino")).alias("genero"),
        country.alias("pais"),
        F.least(F.floor(d["tenure_months"] / 12), F.lit(10)).cast("int").alias("antiguedad_años"),
        (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 25.0).alias("saldo"),
        clip(d["n_products"], 1, 4).cast("int").alias("num_productos"),
        F.when(F.coalesce("orders_closed", F.lit(0)) > 0, 1).otherwise(0).alias("tiene_tarjeta"),
        F.when(d["days_since_last_contact"] <= 90, 1).otherwise(0).alias("miembro_activo"),
        (F.lit(15000) + (key * 7919) % 105001).cast("double").alias("salario_estimado"),
        F.least(F.coalesce("returned_half", F.lit(0)), F.lit(3)).cast("int").alias("quejas_recibidas"),
        F.when(F.coalesce("logins", F.lit(0)) > 0, 1).otherwise(0).alias("uso_app_movil"),
        (F.lit(300) + (key * 31) % 600).cast("int").alias("score_credito"),
        F.coalesce(d["churn_label"], F.lit(0)).cast("int").alias("churn"),
    )
