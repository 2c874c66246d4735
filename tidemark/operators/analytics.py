"""Dashboard panels and log questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import BROWSER_RULES, OS_RULES, first_match, region_of
from tidemark.operators.ordered import running_sum
from tidemark.storage import materialize


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Share of rows per value of ``column``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_count"))
    total = counts.agg(F.sum("_count").cast("double")).scalar()
    return counts.select(column, (F.col("_count") / total).alias("share"))


def _plays_with_time(plays: DataFrame, time: DataFrame, parts: list[str]) -> DataFrame:
    """Plays per start time, with calendar parts. Counting first shrinks the join."""
    per_time = plays.groupBy("start_time").agg(F.count("songplay_id").alias("plays"))
    return per_time.join(time.select("start_time", *parts), "start_time", "left")


def trend(plays: DataFrame, time: DataFrame, grain: str = "day_of_month") -> DataFrame:
    """Plays per day. ``day_of_month`` merges months; ``date`` keeps them apart.

    Saturdays carry the weekend flag and the end of the weekend two days on.
    """
    if grain == "day_of_month":
        joined = _plays_with_time(plays, time, ["day", "weekday"]).withColumn("day", F.col("day").cast("int"))
        end = F.col("day") + 2
    elif grain == "date":
        joined = _plays_with_time(plays, time, ["weekday"]).withColumn("day", F.col("start_time").cast("date"))
        end = F.date_add("day", 2)
    else:
        raise ValueError("grain is 'day_of_month' or 'date'")
    days = joined.groupBy("day").agg(
        F.min("weekday").cast("int").alias("weekday"),
        F.sum("plays").alias("plays"),
    )
    saturday = F.coalesce(F.col("weekday") == 6, F.lit(False))
    return days.withColumn("is_weekend", saturday).withColumn("weekend_end", F.when(saturday, end))


def hourly(plays: DataFrame, time: DataFrame) -> DataFrame:
    """Plays per hour of the day."""
    joined = _plays_with_time(plays, time, ["hour"])
    return joined.groupBy(F.col("hour").cast("int").alias("hour")).agg(F.sum("plays").alias("plays"))


def plays_by_region(plays: DataFrame, lookup: DataFrame, region: Column | None = None) -> DataFrame:
    """Plays per region of the location, with the lookup's columns where it knows the region."""
    abbr = region_of(F.col("location")) if region is None else region
    counts = plays.groupBy(abbr.alias("abbr")).agg(F.count(abbr).alias("play_count"))
    return lookup.join(counts, "abbr", "right")


def all_regions(lookup: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Every row of the lookup, with its count or none."""
    return lookup.join(counts, key, "left")


def percent_rank_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """Percent rank over the whole frame, without moving its rows to one task.

    Ranks follow from a table of value counts: a value's rank is one more than
    the number of smaller values. ``df`` is read twice, so pass a stored frame.
    """
    values = materialize(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    # ascending with NULL last, as in a plain ordered window
    below = running_sum(values, [], [F.col(column).asc_nulls_last()], "_n", "_upto", stored=True)
    rows = values.agg(F.sum("_n")).scalar()
    ranks = below.select(
        F.col(column).alias("_value"),
        F.when(rows > 1, (F.col("_upto") - F.col("_n")) / (rows - 1).cast("double")).otherwise(F.lit(0.0)).alias(name),
    )
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_value")), "inner").drop("_value")


def user_play_counts(plays: DataFrame, users: DataFrame) -> DataFrame:
    """Plays and highest level per user known to both sides.

    Both sides are reduced before the join. A repeated user multiplies its
    plays, as joining first would.
    """
    counted = plays.groupBy("user_id").agg(F.count("songplay_id").alias("_plays"))
    levels = users.groupBy("user_id").agg(F.max("level").alias("level"), F.count(F.lit(1)).alias("_copies"))
    joined = counted.join(levels, "user_id")
    return joined.select("user_id", "level", (F.col("_plays") * F.col("_copies")).alias("playcount"))


def top_users(plays: DataFrame, users: DataFrame, cut: float = 0.75) -> DataFrame:
    """Users at or above the given percent rank by plays, most plays first."""
    counts = materialize(user_play_counts(plays, users), "user-plays")
    ranked = percent_rank_by(counts, "playcount", "prctile")
    return (
        ranked.filter(F.col("prctile") >= cut)
        .select("user_id", "level", "playcount", "prctile")
        .orderBy(F.desc("playcount"), "user_id")
    )


def label_matrix(df: DataFrame, labels: dict[str, Column], counted: str, name: str = "playcount") -> DataFrame:
    """Counts per combination of computed labels; NULL labels form groups."""
    return df.groupBy(*[c.alias(n) for n, c in labels.items()]).agg(F.count(counted).alias(name))


def agent_matrix(plays: DataFrame) -> DataFrame:
    """Plays per operating system and browser."""
    agent = F.col("user_agent")
    labels = {"os": first_match(agent, OS_RULES), "browser": first_match(agent, BROWSER_RULES)}
    return label_matrix(plays, labels, "songplay_id")


def box_summary(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Exact quartiles and whiskers (furthest values within 1.5 IQR) per category and column.

    Works on value counts, so a category of any size needs no task that holds
    its rows. Quartiles interpolate linearly between neighbouring ranks.
    """
    long = df.unpivot([by], columns, "measure", "value").filter(F.col("value").isNotNull())
    group = [by, "measure"]
    counts = materialize(long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    ranked = running_sum(counts, group, [F.col("value")], "_n", "_upto", stored=True)
    sizes = counts.groupBy(*group).agg(F.sum("_n").alias("_rows")).withColumnsRenamed({c: f"_g_{c}" for c in group})

    def same(prefix):
        return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in group]

    placed = ranked.join(sizes, same("_g_"))
    cuts = {"q1": 0.25, "median": 0.5, "q3": 0.75}

    def value_at(rank: Column) -> Column:
        first = F.col("_upto") - F.col("_n")
        return F.max(F.when((rank >= first) & (rank < F.col("_upto")), F.col("value")))

    picks = [F.max("_rows").alias("rows")]
    for name, share in cuts.items():
        rank = (F.col("_rows") - 1) * F.lit(share)
        picks += [
            value_at(F.floor(rank)).cast("double").alias(f"_{name}_low"),
            value_at(F.ceil(rank)).cast("double").alias(f"_{name}_high"),
            F.max(rank - F.floor(rank)).alias(f"_{name}_part"),
        ]
    quartiles = placed.groupBy(*group).agg(*picks)
    for name in cuts:
        low, high, part = (F.col(f"_{name}_{p}") for p in ("low", "high", "part"))
        quartiles = quartiles.withColumn(name, low + (high - low) * part).drop(
            f"_{name}_low", f"_{name}_high", f"_{name}_part"
        )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = (
        counts.join(quartiles.withColumnsRenamed({c: f"_q_{c}" for c in group}), same("_q_"))
        .filter(F.col("value").between(F.col("q1") - reach, F.col("q3") + reach))
    )
    return fenced.groupBy(*group, "rows", *cuts).agg(
        F.min("value").cast("double").alias("whisker_low"),
        F.max("value").cast("double").alias("whisker_high"),
    )


def never_visited(events: DataFrame, page: str, visitor: Column) -> DataFrame:
    """Values of ``page`` that no row satisfying ``visitor`` has."""
    return events.select(page).subtract(events.filter(visitor).select(page))


def distinct_members(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Number of distinct column combinations among rows satisfying ``condition``."""
    chosen = df.filter(condition).select(*columns).dropDuplicates()
    return chosen.agg(F.count(F.lit(1)).alias("members"))


def most_frequent(df: DataFrame, column: str, top: int = 1, weight: Column | None = None) -> DataFrame:
    """The ``top`` values by number of rows (or sum of ``weight``); equal counts in value order."""
    count = F.count(column) if weight is None else F.sum(weight)
    counts = df.groupBy(column).agg(count.alias("count"))
    return counts.orderBy(F.desc("count"), F.col(column).asc_nulls_last()).limit(top)


def visit_periods(
    events: DataFrame,
    key: str,
    order: str,
    item: Column,
    marker: Column,
) -> DataFrame:
    """Items per (key, time) with the number of markers at or after that time.

    Rows of one key and time are peers, so they are added up before the running
    sum; this also removes ties.
    """
    moments = events.filter(item | marker).groupBy(key, order).agg(
        F.count_if(item).alias("items"), F.count_if(marker).alias("markers")
    )
    return running_sum(moments, [key], [F.col(order).desc()], "markers", "period")


def count_between(
    events: DataFrame,
    key: str,
    order: str,
    item: Column,
    marker: Column,
) -> DataFrame:
    """Average number of items between markers, as is and rounded."""
    periods = visit_periods(events, key, order, item, marker).filter(F.col("items") > 0)
    counts = periods.groupBy(key, "period").agg(F.sum("items").alias("n"))
    return counts.agg(F.avg("n").alias("average"), F.round(F.avg("n")).cast("bigint").alias("average_rounded"))
