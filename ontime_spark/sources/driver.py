"""Adapter from the driver's TPC-H-style tables to the flight domain.

The test data has no flights, weather or ADS-B tables; these views derive them from
``lineitem orders customer supplier nation events`` with fixed arithmetic rules so that every
operator runs on data whose size grows with the scale factor. Airports are the 25 nations.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.session import wide_session

# The hub set of the driver mapping = the nations of regions AMERICA and EUROPE.
DRIVER_HUBS = (
    "NATION_1", "NATION_3", "NATION_6", "NATION_8", "NATION_11",
    "NATION_13", "NATION_16", "NATION_18", "NATION_21", "NATION_23",
)
# Airport of an event row: user_id modulo the number of nations.
N_AIRPORTS = 25


def balanced(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the session's parallelism.

    The driver's files are single Parquet row groups, one task per table however many cores
    there are; a round-robin exchange parallelises the row-local work before the first keyed
    shuffle. The same plan at every size: it is for these generated tables, real flight files
    (``sources.flights``) are read as they are split."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def table(spark: SparkSession, sf_dir: str, name: str, balance: bool = True) -> DataFrame:
    """A driver table; ``balance=False`` for join build sides, which gain nothing from it."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df if (not balance or name in SMALL_DIMENSIONS) else balanced(df)


# Fixed-size dimensions (25 and 5 rows): never worth a repartition.
SMALL_DIMENSIONS = ("nation", "region")


def _mod(c: Column, m: int) -> Column:
    return c % F.lit(m)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights: one row per shipped line item whose supplier and customer nations differ.

    Join plan: orders get their customer's nation first, both narrow, so that the wide line items
    cross the network once, by the order key. That join is always a sort-merge join: its exchange
    deals a file of one row group over the cores, too, and is split where a key is skewed. Supplier
    grows with the data and is left to AQE; nation is a fixed 25-row dimension and is broadcast.
    """
    spark = wide_session(spark)
    l = table(spark, sf_dir, "lineitem", balance=False).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders", balance=False).select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer", balance=False).select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier", balance=False).select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    so = F.broadcast(nation.toDF("so_nationkey", "origin"))
    de = F.broadcast(nation.toDF("de_nationkey", "dest"))

    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")
    j = (l.join(oc.hint("merge"), l.l_orderkey == oc.o_orderkey)
          .join(s, l.l_suppkey == s.s_suppkey)
          .where(F.col("s_nationkey") != F.col("c_nationkey"))
          .join(so, F.col("s_nationkey") == F.col("so_nationkey"))
          .join(de, F.col("c_nationkey") == F.col("de_nationkey")))

    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_linenumber"))

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    return j.select(
        ok.alias("l_orderkey"), ln.alias("l_linenumber"),
        F.col("l_shipdate").cast("date").alias("fl_date"),
        F.concat(F.lit("C"), _mod(sk, 10).cast("string")).alias("carrier"),
        "origin", "dest",
        ((5 + _mod(pk, 19)) * 100 + ln * 5).cast("int").alias("crs_dep_time"),
        F.when(_mod(ok, 97) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity") - 23.0
                    + F.when(_mod(pk, 19) >= 12, 6.0).otherwise(0.0)).alias("arr_delay"),
        flag((F.col("l_returnflag") == "R") & (ln == 7)).alias("cancelled"),
        (100 + 200 * F.abs(F.col("s_nationkey") - F.col("c_nationkey"))).cast("int")
        .alias("distance"),
        F.when(_mod(pk, 89) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_tax") * 500.0).alias("origin_wind_speed"),
        (_mod(ok * 7 + ln, 151).cast("double") / 10).alias("origin_visibility"),
        _mod(ok * 37 + pk, 30001).cast("int").alias("origin_ceiling"),
        flag(_mod(pk, 20) == 0).alias("origin_has_thunderstorm"),
        flag(_mod(pk, 13) == 0).alias("origin_has_snow"),
        flag(_mod(sk, 10) == 3).alias("origin_has_fog"),
        (10 + _mod(pk, 90)).cast("double").alias("origin_temp"),
        (_mod(ok, 50).cast("double") / 100).alias("origin_precip"),
        (F.col("l_discount") * 400.0).alias("dest_wind_speed"),
        (_mod(ok * 11 + ln * 3, 151).cast("double") / 10).alias("dest_visibility"),
        _mod(ok * 41 + pk * 3, 30001).cast("int").alias("dest_ceiling"),
        (10 + _mod(sk * 7, 90)).cast("double").alias("dest_temp"),
        (_mod(pk, 40).cast("double") / 100).alias("dest_precip"),
        flag(_mod(pk, 21) == 0).alias("dest_has_thunderstorm"),
        flag(_mod(pk, 17) == 0).alias("dest_has_snow"),
        flag(_mod(sk, 10) == 4).alias("dest_has_fog"),
        (_mod(pk * 31 + ok * 7, 1000).cast("double") / 1000).alias("p"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension (25 rows): iata, icao, k, lat, lon."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("iata"),
        F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("icao"),
        F.col("n_nationkey").alias("k"),
        (25 + F.col("n_nationkey")).cast("double").alias("lat"),
        (-120 + 2 * F.col("n_nationkey")).cast("double").alias("lon"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station inventory derived from supplier: shared ICAO codes, foreign and coordinate-less rows."""
    s = table(spark, sf_dir, "supplier")
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    return s.select(
        F.lpad((700000 + k).cast("string"), 6, "0").alias("USAF"),
        F.lpad(_mod(k * 13, 100000).cast("string"), 5, "0").alias("WBAN"),
        F.when(_mod(k, 11) == 0, "CA").otherwise("US").alias("CTRY"),
        F.when((_mod(k, 2) == 0) & (_mod(nk, 5) != 0),
               F.concat(F.lit("K"), nk.cast("string"))).alias("ICAO"),
        F.when(_mod(k, 17) == 0, F.lit(None).cast("double"))
         .otherwise(25 + _mod(k * 37, 2500).cast("double") / 100).alias("LAT"),
        (-120 + _mod(k * 53, 5000).cast("double") / 100).alias("LON"),
    )


def isd_lines(spark: SparkSession, sf_dir: str, layout: str = "public") -> DataFrame:
    """Fixed-width ISD lines (105 characters) built from events, in the public layout or in the
    legacy one, whose visibility ends in the first three characters of the temperature: a signed
    temperature leaves the three characters before it blank.

    One ``format_string`` keeps the generated code small, so the parser's projections can be
    compiled together with it in one stage."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    eid, uid = F.col("event_id"), F.col("user_id")

    def lp(c: Column, n: int) -> Column:
        return F.lpad(c.cast("string"), n, "0")

    wind = F.when(_mod(eid, 50) == 0, F.lit("9999")).otherwise(lp(_mod(eid, 400), 4))
    ceiling = F.when(_mod(eid, 7) == 0, F.lit("99999")).otherwise(lp(_mod(eid * 31, 9000), 5))
    vis = F.when(_mod(eid, 9) == 0, F.lit("999999")).otherwise(lp(_mod(eid * 53, 16000), 6))
    temp = (F.when(_mod(eid, 40) == 0, F.lit("+9999"))
             .when(_mod(eid, 3) == 0, F.concat(F.lit("-"), lp(_mod(eid, 200), 4)))
             .otherwise(F.concat(F.lit("+"), lp(_mod(eid, 350), 4))))
    head = (lp(700000 + uid, 6), lp(_mod(uid * 13, 100000), 5),
            lp(_mod(eid, 24) * 100 + _mod(eid, 60), 4), wind)
    if layout == "legacy":
        signed = (_mod(eid, 40) == 0) | (_mod(eid, 3) == 0)
        vis = F.when(signed, F.lit("   ")).otherwise(lp(_mod(eid * 53, 1000), 3))
        temp = F.when(signed, temp).otherwise(lp(_mod(eid, 350), 5))
        form = "18019%s10000019N%s1%s%s1+00121101321"
    else:
        form = "18019%s1%s19N%s1N9%s1+00121101321"
    line = F.format_string("0000%s%s20240115%s" + " " * 33 + form, *head, ceiling, vis, temp)
    return e.select(eid, line.alias("line"))


def isd_files(spark: SparkSession, sf_dir: str, layout: str = "public") -> str:
    """Land the generated ISD lines as gzip text files (the shape of downloaded station-year
    files) in the shared checkpoint folder; returns the folder for ``sources.isd.read_isd``."""
    from ontime_spark.session import scratch_path
    import uuid
    path = scratch_path(spark, f"isd-{uuid.uuid4().hex}")
    (isd_lines(spark, sf_dir, layout).select(F.col("line").alias("value"))
        .write.option("compression", "gzip").text(path))
    return path


def event_epoch(c: str = "ts") -> Column:
    """events.ts is TIMESTAMP_NTZ: read it as UTC wall-clock, then epoch seconds."""
    return F.unix_seconds(F.col(c).cast("timestamp"))


def adsb_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ADS-B flight records as JSON lines (the shape of the flights API), one per event."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    eid, uid = F.col("event_id"), F.col("user_id")
    first = event_epoch()
    rec = F.struct(
        F.lpad(F.lower(F.hex(uid)), 6, "0").alias("icao24"),
        F.concat(F.lit("C"), _mod(uid, 10).cast("string"), F.lpad(_mod(eid, 10000).cast("string"), 4, "0"))
         .alias("callsign"),
        F.concat(F.lit("K"), _mod(uid, N_AIRPORTS).cast("string")).alias("estDepartureAirport"),
        F.when(_mod(eid, 13) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("K"), _mod(eid, N_AIRPORTS).cast("string")))
         .alias("estArrivalAirport"),
        first.alias("firstSeen"),
        (first + 600 + _mod(eid, 7200)).alias("lastSeen"),
        _mod(eid * 7, 5000).cast("int").alias("estDepartureAirportHorizDistance"),
        _mod(eid * 3, 900).cast("int").alias("estDepartureAirportVertDistance"),
        _mod(eid * 11, 5000).cast("int").alias("estArrivalAirportHorizDistance"),
        _mod(eid * 5, 900).cast("int").alias("estArrivalAirportVertDistance"),
        _mod(eid, 4).cast("int").alias("departureAirportCandidatesCount"),
        _mod(eid, 3).cast("int").alias("arrivalAirportCandidatesCount"),
    )
    return e.select(F.to_json(rec).alias("value"))


def adsb_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft state snapshots: time, lat, lon per event."""
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    eid = F.col("event_id")
    return e.select(
        eid.alias("state_id"), event_epoch().alias("time"),
        (25 + _mod(eid * 37, 2500).cast("double") / 100).alias("lat"),
        (-120 + _mod(eid * 53, 5000).cast("double") / 100).alias("lon"),
    )
