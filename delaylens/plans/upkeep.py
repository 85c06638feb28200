"""The fact kept up to date day by day, without building it again.

Next to the fact (one partition per day) a store keeps three *carry tables*, one for each chain that
crosses days: the flights of an aircraft, the flights of an origin airport, the hours of an airport.
A carry table has one small row per group and day: the last rows of that day (``tail``) and the last
rows before it (``carry``). A day of the fact then follows from the flights and weather of that day
and the carries into it.

When days are corrected or arrive late, their tails are made again and carries are followed along the
later days of the touched groups. The frontier stops by itself: a day is changed only where what is
carried into it differs from what is stored. Changed days of the fact are written again, all others
stay as they are. A last row of each group on the day ``END`` holds what a coming day will carry, so a
new latest day reads no history at all, and an older one the narrow carry rows of later days only.

The fact is written before the carries: an update that was cut off finds the old carries, comes to
the same days, and can simply be repeated. Rows without a date form the day ``NO_DAY``.
"""

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.operators.running import chunk_keys, day_tails, rows_before
from delaylens.plans import fact
from delaylens.session import stored
from delaylens.sources.tables import replace_partitions, write_table

NO_DAY, END = datetime.date(1, 1, 1), datetime.date(9999, 12, 31)

#: Rows that each chain carries into a day.
DEPTHS = {"aircraft": 1, "origin": 6, "hour": 1}


def _lit(day):
    """A day as a literal, also where the client's date type cannot carry it."""
    return F.to_date(F.lit(day.isoformat()))


def _on(column, days):
    return column.isin([_lit(d) for d in days]) if days else F.lit(False)


def chain_tails(flights: DataFrame, weather: DataFrame) -> dict:
    """The (_g, _d, _tail) rows of every chain, from whole days of staged tables."""
    f = flights.withColumnsRenamed(fact.FACT_NAMES)
    delay, wind, late = fact.origin_payload()
    hours = chunk_keys(fact.airport_hour(f), "airport_id", "date_id")
    aircraft = chunk_keys(f, "tail_number", "date_id").select(
        "_g", "_d", *fact.DAY_ORDER, "arr_delay_minutes")
    origin = fact.origin_rows(f, fact.daily_weather(weather))
    rows = {
        "aircraft": (aircraft, fact.DAY_ORDER, ["arr_delay_minutes"]),
        "origin": (origin, fact.DAY_ORDER,
                   [delay.alias("delay"), wind.alias("wind"), late.alias("late")]),
        "hour": (hours, ["hour_id"], ["current_hour_delay_avg", "current_hour_flight_count"]),
    }
    return {name: day_tails(df, order, payload, DEPTHS[name])
            for name, (df, order, payload) in rows.items()}


def _ends(tails: DataFrame) -> DataFrame:
    """One row without flights on the last day for every group."""
    nothing = F.array().cast(tails.schema["_tail"].dataType)
    return tails.select("_g").distinct().select("_g", _lit(END).alias("_d"), nothing.alias("_tail"))


def _read(spark, path, schema=None):
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_fact(spark: SparkSession, store) -> DataFrame:
    return _read(spark, f"{store}/fact").select(*fact.FACT_COLUMNS)


def build(flights: DataFrame, weather: DataFrame, store) -> None:
    """The fact and its carry tables from all days."""
    carries = {}
    spark = flights.sparkSession
    for name, tails in chain_tails(flights, weather).items():
        path = f"{store}/{name}"
        rows = stored(tails, f"tails-{name}")
        every = rows.unionByName(_ends(rows))
        write_table(every.select("*", rows_before(DEPTHS[name]).alias("_carry")), path,
                    partition_by=["_d"])
        carries[name] = _carry(_read(spark, path))
    _write_fact(fact.build_fact(flights, weather, carries=carries), store, write_table)


def _carry(table):
    return table.select("_g", F.col("_d").cast("date").alias("_d"), "_carry")


def _write_fact(rows, store, write):
    day = F.coalesce(F.col("date_id"), _lit(NO_DAY))
    rows = rows.withColumn("day", day)
    if write is write_table:
        write(rows, f"{store}/fact", partition_by=["day"])
    else:
        write(rows, f"{store}/fact", "day")


def followed(old: DataFrame, tails: DataFrame, days, depth) -> DataFrame:
    """Rows of a carry table that new tails of ``days`` change: (_g, _d, _tail, _carry).

    All rows of ``days`` come back, and those of later days into which other rows are carried.
    Only groups met on these days, before or now, are looked at.
    """
    first, nothing = min(days), F.array().cast(old.schema["_tail"].dataType)
    later = old.where(F.col("_d") >= _lit(first))
    here = _on(F.col("_d"), days)
    groups = later.where(here).select("_g").unionByName(tails.select("_g")).distinct()
    known = later.join(groups, "_g", "left_semi")
    # what came before the first row that a group has had since: nothing there was changed
    base = known.groupBy("_g").agg(F.min_by("_carry", "_d").alias("_base"))
    fresh = tails.join(known.select("_g").distinct(), "_g", "left_anti")
    rows = (known.where(~here).withColumn("_new", F.lit(False))
            .unionByName(tails.unionByName(_ends(fresh)).withColumn("_new", F.lit(True)), True))
    into = F.slice(F.concat(rows_before(depth), F.coalesce("_base", nothing)), 1, depth)
    return (rows.join(base, "_g", "left").withColumn("_now", into)
            .where(F.col("_new") | ~F.col("_now").eqNullSafe(F.col("_carry")))
            .select("_g", "_d", "_tail", F.col("_now").alias("_carry")))


def refresh(flights: DataFrame, weather: DataFrame, store, days) -> list:
    """Bring the store up to date after ``days`` of flights or weather were replaced or added.

    ``flights`` and ``weather`` are the whole staged tables as they are now, best partitioned by day.
    Returns the days of the fact that were written again. A day without flights is an error, as its
    partition could not be replaced.
    """
    spark = flights.sparkSession
    days = sorted({NO_DAY if d is None else d for d in days})

    def of(table, column, wanted):
        return table.where(_on(F.coalesce(F.col(column), _lit(NO_DAY)), wanted))

    present = {r["d"] for r in of(flights, "flight_date", days).select(
        F.coalesce("flight_date", _lit(NO_DAY)).alias("d")).distinct().collect()}
    if set(days) - present:
        raise ValueError(f"no flights on {', '.join(map(str, sorted(set(days) - present)))}")

    tails = chain_tails(of(flights, "flight_date", days), of(weather, "date_id", days))
    old, changed = {}, {}
    for name, new in tails.items():
        old[name] = _read(spark, f"{store}/{name}").withColumn("_d", F.col("_d").cast("date"))
        changed[name] = stored(followed(old[name], stored(new, "tails"), days, DEPTHS[name]),
                               f"changed-{name}")
    found = [c.select("_d").distinct() for c in changed.values()]
    touched = sorted({r["_d"] for df in found for r in df.collect()})  # days of the calendar
    again = [d for d in touched if d != END]

    carries = {}
    for name, rows in changed.items():
        same = old[name].where(_on(F.col("_d"), [d for d in touched if d not in days])).join(
            rows, ["_g", "_d"], "left_anti")
        carries[name] = stored(same.unionByName(rows), f"carries-{name}")
    renewed = fact.build_fact(of(flights, "flight_date", again), of(weather, "date_id", again),
                              carries={n: _carry(c) for n, c in carries.items()})
    _write_fact(renewed, store, replace_partitions)
    for name, rows in carries.items():
        replace_partitions(rows, f"{store}/{name}", "_d")
    return again
