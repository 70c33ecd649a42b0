"""The two recursive queries, without unbounded recursion.

``spike_chain`` (post-meal hours of high glucose) has a closed form: the
recursion of the reference yields P_n = c_1 * ... * c_n rows at level n, so
duration = deepest level and the row average = sum(P_{n-1} S_n) / sum(P_n).
Running sums of log c over islands of consecutive hours give every hour the
log of its row count and its mean from there on; a meal looks up one hour.

``food_chain`` (meals leading up to a spike) counts chains by a dynamic program
over islands of meals that follow one another within the look-back.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions.time import micros_between, shift, trunc_hour, trunc_minute
from vitalis.operators import scan
from vitalis.operators.joins import interval_join


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def spike_chain(
    foodlog: DataFrame,
    dexcom: DataFrame,
    min_calorie: float = 300,
    min_glucose: float = 180,
) -> DataFrame:
    """O70 / a08: per (patient, meal day) the longest chain of consecutive
    elevated hours after a high-calorie meal and the mean glucose over the
    chain rows, exactly as the recursive CTE counts them."""
    meals = foodlog.where(F.col("calorie") > min_calorie).groupBy("patientid", "time_begin").agg(F.count(F.lit(1)).alias("m"))
    high = dexcom.where(F.col("glucosevalue") > min_glucose).select("patientid", "date_time", "glucosevalue")
    # level 1: readings in [t, t + 1h)
    l1 = interval_join(meals, high, "patientid", "time_begin", "date_time", timedelta(0), timedelta(hours=1), closed="left")
    l1 = l1.groupBy("patientid", "time_begin", "m").agg(
        F.count(F.lit(1)).cast("double").alias("c1"), F.sum("glucosevalue").cast("double").alias("s1")
    )
    # levels >= 2: whole hour bins, starting at trunc(t + 1h) + 1h
    bins = high.groupBy("patientid", trunc_hour("date_time").alias("hour")).agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.sum("glucosevalue").cast("double").alias("s")
    )
    hidx = F.floor(micros_between(_epoch(), F.col("hour")) / F.lit(3_600_000_000))
    # islands of consecutive hours: hour index minus row number is constant within an island
    bins = bins.withColumn("isl", hidx - F.row_number().over(Window.partitionBy("patientid").orderBy("hour")))
    # from an hour h on, its island yields D(h) = sum over k >= h of c_h ... c_k rows.  With L the running sum of log c and
    # M its end value, D(h) = exp(M - L(h) + log c_h) * sum over k >= h of exp(L(k) - M): no product overflows, and
    # what underflows weighs nothing.  The mean of these rows is the same sum weighted with s_k / c_k.
    forward = Window.partitionBy("patientid", "isl").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("patientid", "isl").orderBy(F.col("hour").desc()).rowsBetween(Window.unboundedPreceding, 0)
    island = Window.partitionBy("patientid", "isl")
    log_c = F.log("c")
    b = bins.withColumn("run", F.sum(log_c).over(forward)).withColumn("all", F.sum(log_c).over(island))
    b = b.withColumn("w", F.exp(F.col("run") - F.col("all")))
    tail = F.sum("w").over(onward)
    b = b.select(
        "patientid", F.col("hour").alias("start"), (F.col("all") - F.col("run") + log_c + F.log(tail)).alias("log_d"),
        (F.sum(F.col("w") * F.col("s") / F.col("c")).over(onward) / tail).alias("mean_d"), F.count(F.lit(1)).over(onward).cast("int").alias("hours"),
    )
    l1 = l1.withColumn("start", shift(trunc_hour(shift("time_begin", hours=1)), hours=1))
    r = l1.join(b, ["patientid", "start"], "left")
    # rows of a meal: c1 * (1 + D(start)); the share of them that lies behind the first hour
    rest = F.coalesce(1 / (1 + F.exp(-F.col("log_d"))), F.lit(0.0))
    log_rows = F.log("m") + F.log("c1") - F.log1p(-rest)
    # 1 - rest vanishes in doubles once D is huge: then log(1 + D) is log D
    log_rows = F.when(F.col("log_d") > 30, F.log("m") + F.log("c1") + F.col("log_d")).otherwise(log_rows)
    mean = F.col("s1") / F.col("c1") * (1 - rest) + F.coalesce(F.col("mean_d") * rest, F.lit(0.0))
    r = r.select("patientid", F.to_date("time_begin").alias("day"), log_rows.alias("lw"), mean.alias("mean"), (1 + F.coalesce("hours", F.lit(0))).alias("n"))
    top = r.groupBy("patientid", "day").agg(F.max("lw").alias("top"), F.max("n").alias("spike_duration"))
    weight = F.exp(F.col("lw") - F.col("top"))
    g = r.join(top, ["patientid", "day"]).groupBy("patientid", "day").agg(
        F.max("spike_duration").alias("spike_duration"), (F.sum(weight * F.col("mean")) / F.sum(weight)).alias("_avg")
    )
    return g


#: Path counts: whole numbers; a count beyond 38 digits is an arithmetic error (ANSI), never a wrong number.
_COUNT = "decimal(38,0)"
_WALK = f"array<struct<t:timestamp_ntz,paths:array<{_COUNT}>,ends:array<{_COUNT}>>>"


def _walked(times, start, lookback_us: int):
    """Paths from the meal time ``start`` back through ``times`` (descending structs of t and c, its number of meals): for each time,
    ``paths[d - 1]`` the number of chains of d meals that reach it, and ``ends`` these times its meals.  A time is reached
    from every later one at most the look-back away, one meal deeper."""
    none = F.array().cast(f"array<{_COUNT}>")
    one = F.array(F.lit(1).cast(_COUNT))
    first = F.array(F.struct(start.alias("t"), one.alias("paths"), one.alias("ends"))).cast(_WALK)

    def add(a, b):
        return F.zip_with(a, b, lambda x, y: (F.coalesce(x, F.lit(0).cast(_COUNT)) + F.coalesce(y, F.lit(0).cast(_COUNT))).cast(_COUNT))

    def step(done, at):
        near = F.filter(done, lambda d: micros_between(at["t"], d["t"]) <= lookback_us)
        paths = F.concat(F.array(F.lit(0).cast(_COUNT)), F.aggregate(near, none, lambda s, d: add(s, d["ends"])))
        ends = F.transform(paths, lambda n: (n * at["c"].cast(_COUNT)).cast(_COUNT))
        return F.concat(done, F.array(F.struct(at["t"].alias("t"), paths.alias("paths"), ends.alias("ends"))).cast(_WALK))

    return F.aggregate(F.filter(times, lambda x: x["t"] < start), first, step)


def food_chain_counts(
    dexcom: DataFrame,
    foodlog: DataFrame,
    min_glucose: float = 140,
    lookback: timedelta = timedelta(hours=2),
    anchor_key: tuple[str, ...] = ("food_time",),
) -> DataFrame:
    """O71 / a13 with counts: for each spike reading, the meal in the look-back window
    (one anchor per meal time, as DISTINCT ON (time_begin) does; the earliest
    spike, then the smallest food row, is kept), then every earlier meal
    within ``lookback`` of the previous one, recursively.  One row per anchor,
    meal and depth, with ``paths``: how many rows of the recursive query it stands for.

    One plan, no loop.  A chain cannot cross a pause longer than ``lookback``, so a patient's meal times (equal ones
    merged, with their number) are cut into islands there (``scan.sessions_from``); an anchor meets the times of
    its own island only, and a dynamic program over them, from the anchor back, counts the chains by depth.  Each of these
    times is in the result, so no anchor holds more than it puts out.  NULL times belong to no chain."""
    reach = int(lookback / timedelta(microseconds=1))
    spikes = dexcom.where(F.col("glucosevalue") > min_glucose).select("patientid", F.col("date_time").alias("spike_at"))
    food = foodlog.select("patientid", F.col("time_begin").alias("food_time"), "logged_food", "calorie", "sugar", "dietary_fiber")
    pairs = interval_join(spikes, food, "patientid", "spike_at", "food_time", -lookback, timedelta(0), closed="left")
    order = F.struct("spike_at", "patientid", "logged_food", "calorie", "sugar", "dietary_fiber")
    row = F.struct("patientid", "spike_at", "logged_food", "calorie", "sugar", "dietary_fiber")
    # as written the anchor is DISTINCT ON (time_begin) alone; ("patientid", "food_time") is the intended key
    anchors = pairs.groupBy(*anchor_key).agg(F.min_by(row, order).alias("r")).select(
        F.col("r.patientid").alias("patientid"), trunc_minute(F.col("r.spike_at")).alias("spike_time"), "food_time",
        F.col("r.logged_food").alias("logged_food"), F.col("r.calorie").alias("calorie"), F.col("r.sugar").alias("sugar"),
        F.col("r.dietary_fiber").alias("dietary_fiber"))
    merged = food.where("patientid IS NOT NULL AND food_time IS NOT NULL").groupBy("patientid", "food_time").agg(F.count("*").alias("c"))
    times = scan.sessions_from(merged, "patientid", "food_time", lambda a, b: micros_between(a, b) > reach, start="island").drop("previous_time")
    begun = anchors.groupBy("patientid", "food_time").agg(F.collect_list("spike_time").alias("spikes"))
    island = F.sort_array(F.collect_list(F.struct(F.col("food_time").alias("t"), "c", "spikes")), asc=False)
    islands = times.join(begun, ["patientid", "food_time"], "left").groupBy("patientid", "island").agg(island.alias("times"))
    starts = islands.select("patientid", "times", F.explode(F.filter("times", lambda x: x["spikes"].isNotNull())).alias("from"))
    walks = starts.select("patientid", "from.spikes", F.explode(_walked(F.col("times"), F.col("from.t"), reach)).alias("w")).select("patientid", F.explode("spikes").alias("spike_time"), "w")
    reached = walks.select("patientid", "spike_time", F.col("w.t").alias("food_time"), F.posexplode("w.paths").alias("d", "paths")).where("d > 0 AND paths > 0")
    deeper = reached.select("patientid", "spike_time", "food_time", (F.col("d") + 1).alias("depth"), "paths").join(food, ["patientid", "food_time"])
    columns = ["patientid", "spike_time", "food_time", "logged_food", "calorie", "sugar", "dietary_fiber", "depth", "paths"]
    own = anchors.withColumn("depth", F.lit(1)).withColumn("paths", F.lit(1).cast(_COUNT))
    # anchors of one spike minute and one meal at one depth are one row
    return own.select(columns).unionByName(deeper.select(columns)).groupBy(*columns[:-1]).agg(F.sum("paths").cast(_COUNT).alias("paths"))


def repeated(df: DataFrame, times: str, step: int = 10_000) -> DataFrame:
    """Each row as often as its column ``times`` says, without that column.  Copies are made in two steps, so that no row
    carries a list longer than ``step`` or times / step."""
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / step).cast("long"))))
    here = F.least(F.lit(step).cast("long"), (F.col(times) - F.col("_block") * step).cast("long"))
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), here))).drop("_copy", "_block", times)


def food_chain(
    dexcom: DataFrame,
    foodlog: DataFrame,
    min_glucose: float = 140,
    lookback: timedelta = timedelta(hours=2),
    anchor_key: tuple[str, ...] = ("food_time",),
) -> DataFrame:
    """O71 / a13: the rows of the recursive query, each path's meal on its own row (``food_chain_counts`` expanded)."""
    return repeated(food_chain_counts(dexcom, foodlog, min_glucose, lookback, anchor_key), "paths")


def spike_chain_contiguous(
    foodlog: DataFrame,
    dexcom: DataFrame,
    min_calorie: float = 300,
    min_glucose: float = 180,
) -> DataFrame:
    """a08 as intended: after a meal at t, hour k covers [t + (k-1)h, t + kh);
    the chain is the run of consecutive hours, from the first, that each hold
    a reading above ``min_glucose``.  Per (patient, meal day): the longest run
    and the plain mean of the distinct readings inside the runs.

    A run cannot cross two readings 2 h or more apart (a whole empty hour lies
    between them), so readings are cut into islands there.  Inside an island a
    run can only end at a gap of an hour or more, or with the island: a meal
    meets those few gaps, not the readings.  The runs of a day are merged to
    disjoint stretches before their readings are averaged.  The islands are used
    several times; their shuffle is the same subplan each time, which Spark runs
    once (reused exchanges)."""
    from vitalis.operators.windows import session_starts
    hour = F.lit(3_600_000_000)
    meals = foodlog.where(F.col("calorie") > min_calorie).select("patientid", "time_begin").distinct()
    high = dexcom.where(F.col("glucosevalue") > min_glucose).select("patientid", "date_time", "glucosevalue")
    tagged = session_starts(high, "patientid", "date_time", 120, inclusive=True).withColumnRenamed("session_start", "isl")
    # the island holding the first reading in [t, t + 1h)
    first = interval_join(meals, tagged.select("patientid", F.col("date_time").alias("_rt"), "isl"), "patientid", "time_begin", "_rt",
                          timedelta(0), timedelta(hours=1), closed="left").groupBy("patientid", "time_begin").agg(F.min("isl").alias("isl"))
    ends = tagged.groupBy("patientid", "isl").agg(F.max("date_time").alias("last"))
    gaps = tagged.where((F.col("date_time") != F.col("isl")) & (micros_between("previous_time", "date_time") >= hour))
    gaps = gaps.select("patientid", "isl", F.col("previous_time").alias("before"), F.col("date_time").alias("after"))

    def number(t):
        return F.floor(micros_between("time_begin", t) / hour)

    ended = (F.col("before") >= F.col("time_begin")) & (number("after") - number("before") >= 2)
    runs = first.join(ends, ["patientid", "isl"]).join(gaps, ["patientid", "isl"], "left").groupBy("patientid", "isl", "time_begin").agg(
        F.coalesce(F.min(F.when(ended, number("before"))), F.min(number("last"))).alias("k"))
    runs = runs.select("patientid", "isl", "time_begin", F.to_date("time_begin").alias("day"), (F.col("k") + 1).cast("int").alias("run"))
    dur = runs.groupBy("patientid", "day").agg(F.max("run").alias("spike_duration"))
    # the day's stretches of an island: a new one begins where no earlier one reaches
    w = Window.partitionBy("patientid", "day", "isl").orderBy("time_begin")
    s = runs.withColumn("stop", F.col("time_begin") + F.make_dt_interval(F.lit(0), F.col("run"), F.lit(0), F.lit(0)))
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("opens", F.when(reach.isNull() | (F.col("time_begin") >= reach), F.col("time_begin")))
    s = s.withColumn("start", F.last("opens", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.groupBy("patientid", "day", "isl", "start").agg(F.max("stop").alias("stop"))
    inside = s.join(tagged, ["patientid", "isl"]).where((F.col("date_time") >= F.col("start")) & (F.col("date_time") < F.col("stop")))
    avg = inside.groupBy("patientid", "day").agg(F.avg("glucosevalue").alias("_avg"))
    return dur.join(avg, ["patientid", "day"])
