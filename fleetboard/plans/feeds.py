"""Transit-shaped DataFrames over the driver tables.

events    one vehicle position per row
lineitem  one trip update per row; its stop list (0 to 22 entries) is computed
          from the row itself, so building it needs no shuffle
orders, customer   trips lookup and route points
supplier           stops lookup
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetboard import schemas as S
from fleetboard.functions.timefn import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream. The glob lets one file be a source."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def since(column: str, seconds: int) -> Column:
    """Raw timestamp filter for event seconds > ``seconds``, which parquet can skip by."""
    first = datetime.fromtimestamp(seconds + 1, timezone.utc).replace(tzinfo=None)
    return F.col(column) >= F.lit(f"{first}").cast("timestamp_ntz")


# Added to the number of one trip in seven, which the lookup then does not have.
UNKNOWN_TRIPS = 1_000_000_000


def _trip_id(number: Column) -> Column:
    return F.when(number % 7 == 0, number + UNKNOWN_TRIPS).otherwise(number).cast("string")


def positions(events: DataFrame) -> DataFrame:
    """Vehicle position events; one in 17 is on no trip, one in seven on an unknown one."""
    trip_id = _trip_id(F.col("user_id") * 10 + F.dayofmonth("ts") % 10)
    nothing = F.lit(None).cast("string")
    trip = F.struct(
        trip_id.alias("tripId"),
        nothing.alias("startTime"),
        F.date_format("ts", "yyyyMMdd").alias("startDate"),
        F.col("event_type").alias("routeId"),
        nothing.alias("scheduleRelationship"),
        nothing.alias("directionId"),
    )
    position = F.struct(
        F.col("value").cast("float").alias("latitude"),
        (-F.col("value")).cast("float").alias("longitude"),
        (F.col("event_id") % 360).cast("float").alias("bearing"),
        F.lit(0).cast("float").alias("speed"),
    )
    user = F.col("user_id").cast("string")
    vehicle = F.struct(
        F.when(F.col("event_id") % 17 != 0, trip).alias("trip"),
        position.alias("position"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.struct(user.alias("id"), F.concat(F.lit("bus "), user).alias("label")).alias("vehicle"),
        F.col("event_type").alias("occupancyStatus"),
        (F.col("event_id") % 101).cast("int").alias("occupancyPercentage"),
    )
    return events.select(
        user.alias("id"), vehicle.alias("vehicle"), F.col("event_id").alias("seq")
    )


def _stop_lists(rows: DataFrame) -> DataFrame:
    """Add ``stopTimeUpdate``, ``n`` entries long, from columns of the row.

    Sequences are zipped rather than mapped, so that the lists are built in
    generated code.
    """
    n = F.col("n").cast("int")
    nothing = F.lit(None).cast("string")

    def steps(first: Column, step: Column) -> Column:
        # One more than needed, as a sequence cannot be empty.
        return F.sequence(first, first + step * F.col("n"), step).cast("array<string>")

    start = F.col("feed") - (F.col("l_suppkey") % 7) * 400
    delays = steps(F.col("l_partkey") % 121 - 60, F.lit(7).cast("bigint"))
    rows = rows.withColumns(
        {
            "time": steps(start, F.lit(60) + F.col("l_quantity").cast("bigint")),
            "delay": F.when(F.col("l_linenumber") % 3 == 0, F.array_repeat(nothing, n))
            .when(F.col("l_partkey") % 5 == 0, F.concat(F.array(nothing), F.slice(delays, 2, n)))
            .otherwise(delays),
            "uncertainty": F.array(nothing),
        }
    )
    rows = rows.withColumn("call", F.arrays_zip("delay", "time", "uncertainty"))
    ends = (F.col("l_returnflag") == "R") & (n > 0)
    no_call = F.array(F.lit(None).cast(S.CALL_TIME))
    rows = rows.withColumns(
        {
            "stopSequence": steps(F.lit(1).cast("bigint"), F.lit(1).cast("bigint")),
            "departure": F.when(ends, F.slice("call", 1, n - 1)).otherwise(F.col("call")),
            "arrival": F.when(
                ends, F.concat(F.array_repeat(F.lit(None).cast(S.CALL_TIME), n - 1), F.slice("call", n, 1))
            ).otherwise(no_call),
            "stopId": steps(F.col("l_suppkey"), F.lit(3).cast("bigint")),
            "scheduleRelationship": F.array(nothing),
        }
    )
    entries = F.arrays_zip(*[F.col(name) for name in S.STOP_TIME_UPDATE.names])
    return rows.withColumn("stopTimeUpdate", F.slice(entries, 1, n))


def feed_time() -> Column:
    """Feed time of a line item's update, hours after its ship date."""
    return (
        epoch_seconds(F.col("l_shipdate"))
        + F.col("l_linenumber").cast("bigint") * 3600
        + F.col("l_partkey") % 3600
    )


def trip_updates(lineitem: DataFrame) -> DataFrame:
    """Trip update events; a trip (order) has one update per line item."""
    nothing = F.lit(None).cast("string")
    rows = _stop_lists(lineitem.withColumns({"feed": feed_time(), "n": F.col("l_partkey") % 23}))
    trip_id = _trip_id(F.col("l_orderkey"))
    minute = F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0")
    trip = F.struct(
        trip_id.alias("tripId"),
        F.concat(
            F.lit("0"), F.col("l_linenumber").cast("string"), F.lit(":"), minute, F.lit(":00")
        ).alias("startTime"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("startDate"),
        nothing.alias("routeId"),
        nothing.alias("scheduleRelationship"),
        nothing.alias("directionId"),
    )
    vehicle = F.struct(nothing.alias("id"), nothing.alias("label"))
    return rows.select(
        trip_id.alias("id"),
        F.struct(
            trip.alias("trip"), "stopTimeUpdate", vehicle.alias("vehicle"), F.col("feed").alias("timestamp")
        ).alias("tripUpdate"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("seq"),
    )


def trip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips lookup, one trip per order."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_custkey").cast("string").alias("shape_id"),
        F.col("o_orderpriority").alias("route_short_name"),
        F.col("c_mktsegment").alias("trip_headsign"),
    )


def stop_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops lookup, one stop per supplier; trips call at further ones, too."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        F.col("s_nationkey").cast("string").alias("stop_lat"),
        (-F.col("s_nationkey")).cast("string").alias("stop_lon"),
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled calls; as in real files some sequence numbers repeat."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("bigint").alias("stop_sequence"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route points; a shape (customer) has one point per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("shape_id"),
        (F.col("o_orderkey") % 360 - 180).cast("double").alias("shape_pt_lon"),
        (F.col("o_orderkey") % 180 - 90).cast("double").alias("shape_pt_lat"),
        F.col("o_orderkey").alias("shape_pt_sequence"),
    )
