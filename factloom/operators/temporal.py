"""Dated facts: as-of values, interval links, islands, running states, ages, partial dates.

Ambiguity is never settled by picking: a link needs exactly one partner, a value needs agreement; otherwise the result is null and the count tells why.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import ranks
from factloom.sources.work import written


def as_of(index: DataFrame, facts: DataFrame, keys: list[str], index_id: str, index_time: str, fact_time: str, value: str, lookback_days: int, same_day_first: bool = True) -> DataFrame:
    """index with the value of the latest fact in [index_time - lookback_days, index_time]; null if the latest facts disagree.

    An equi-join on the keys and on buckets of lookback_days keeps candidates to two buckets of each key, however long a key's history
    is; one aggregation by index_id, without a window, takes the latest facts and tests their agreement.
    """
    days = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    span = max(1, lookback_days)
    left = index.withColumn("__b", F.floor(days(index_time) / span).cast("int")).withColumn("__bucket", F.explode(F.array(F.col("__b"), F.col("__b") - 1)))
    right = facts.select(*keys, F.col(fact_time).alias("__t"), F.col(value).alias("__v")).withColumn("__bucket", F.floor(days("__t") / span).cast("int"))
    near = (F.col("__t") <= F.col(index_time)) & (F.datediff(F.col(index_time), F.col("__t")) <= lookback_days)
    found = left.join(right, [*keys, "__bucket"]).where(near)
    order = F.to_date("__t") if same_day_first else F.col("__t")
    by_time = found.groupBy(index_id, order.alias("__at")).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    last = by_time.groupBy(index_id).agg(F.max("__at").alias("fact_date"), F.max_by(F.struct("__low", "__high"), "__at").alias("__s"))
    agreed = F.when(F.col("__s.__low") == F.col("__s.__high"), F.col("__s.__low"))
    return index.join(last.select(index_id, "fact_date", agreed.alias("value")), index_id, "left")


def facts_at(facts: DataFrame, index: DataFrame, entity: str, kind: str, value: str, time: str, index_time: str) -> DataFrame:
    """Per entity and kind: the unanimous value of facts up to the entity's index time (else null), the latest date, how many facts."""
    rows = facts.join(index.select(entity, index_time), entity).where(F.col(time) <= F.col(index_time))
    agg = rows.groupBy(entity, kind).agg(F.min(value).alias("__l"), F.max(value).alias("__h"), F.max(F.to_date(time)).alias("last_date"), F.count(F.lit(1)).alias("n_facts"))
    return agg.select(entity, kind, F.when(F.col("__l") == F.col("__h"), F.col("__l")).alias("value"), "last_date", "n_facts")


#: Seconds of the narrowest bucket, how much wider each level's are, levels, most buckets that an interval is put into.
_BUCKET, _WIDER, _LEVELS, _MOST = 86_400, 4, 10, 4


def link_in_interval(points: DataFrame, intervals: DataFrame, keys: list[str], point_id: str, point_time: str, interval_id: str, start: str, end: str) -> DataFrame:
    """points with the id of the only interval that holds their time (inclusive), else null, and the number of intervals.

    The range join is an equi-join on the keys and on buckets of time: an interval is put into the buckets it touches, on the first level where these are few,
    a point into its bucket on every level that an interval is on. So a point meets intervals near its time only, however long a key's history is.
    """
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    width = lambda k: _BUCKET * _WIDER**k
    first, last = (lambda k: F.floor(seconds(start) / width(k))), (lambda k: F.floor(seconds(end) / width(k)))
    level = F.lit(_LEVELS - 1)
    for k in range(_LEVELS - 2, -1, -1):
        level = F.when(last(k) - first(k) < _MOST, k).otherwise(level)
    touched = F.when(F.col("__level") == 0, F.sequence(first(0), last(0)))
    for k in range(1, _LEVELS):
        touched = touched.when(F.col("__level") == k, F.sequence(first(k), last(k)))
    levelled = written(intervals.where(F.col(start) <= F.col(end)).select(*keys, interval_id, start, end).withColumn("__level", level), "levelled")
    used = sorted(r[0] for r in levelled.select("__level").distinct().collect()) or [0]  # at most _LEVELS numbers
    right = levelled.withColumn("__bucket", F.explode(touched))
    own = F.array(*[F.struct(F.lit(k).alias("__level"), F.floor(seconds(point_time) / width(k)).alias("__bucket")) for k in used])
    left = points.select(*keys, point_id, point_time, F.explode(own).alias("__b")).select(*keys, point_id, point_time, "__b.*")
    rows = left.join(right, [*keys, "__level", "__bucket"]).where((F.col(point_time) >= F.col(start)) & (F.col(point_time) <= F.col(end)))
    found = rows.groupBy(point_id).agg(F.count(F.lit(1)).alias("n_intervals"), F.min(interval_id).alias("__i"))
    out = points.join(found, point_id, "left")
    return out.withColumn("n_intervals", F.coalesce("n_intervals", F.lit(0).cast("bigint"))).withColumn(interval_id, F.when(F.col("n_intervals") == 1, F.col("__i"))).drop("__i")


def islands(df: DataFrame, keys: list[str], time: str, gap_seconds: int, order: list[str], bucket_seconds: int = 7 * 86_400) -> DataFrame:
    """keys, island, start, end, n: runs of rows whose distance to the row before is at most gap_seconds, numbered from 1 inside a key.

    Time is cut into buckets, each of which is a window of its own; then only the first and last run of each bucket meet in a window of the key, where runs that
    go on in the next bucket become one. `order` only breaks ties of time, which don't change the runs.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = df.where(F.col(time).isNotNull()).select(*keys, time, *[c for c in order if c not in (*keys, time)], F.floor(micros(time) / (bucket_seconds * 1_000_000)).alias("__b"))
    w = Window.partitionBy(*keys, "__b").orderBy(time, *order)
    late = lambda c, before, w: F.coalesce(micros(c) - F.lag(micros(before)).over(w) > gap_seconds * 1_000_000, F.lit(True)).cast("int")
    marked = rows.withColumn("__new", late(time, time, w)).withColumn("__i", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy(*keys, "__b", "__i").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n"))
    last = runs.groupBy(*keys, "__b").agg(F.max("__i").alias("__k"), F.min("start").alias("__first"), F.max("end").alias("__end"))
    # how many runs of the key begin before each bucket: those of earlier buckets that aren't the going on of one before them
    by_bucket = Window.partitionBy(*keys).orderBy("__b")
    joined = 1 - late("__first", "__end", by_bucket)
    last = last.withColumn("__goes_on", joined).withColumn("__before", F.sum(F.col("__k") - F.col("__goes_on")).over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__k") + F.col("__goes_on"))
    last = last.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__b").alias("__b2"), "__goes_on", "__before")
    same = F.col("__b") == F.col("__b2")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    numbered = runs.join(last, same).withColumn("island", (F.col("__before") + F.col("__i") - F.col("__goes_on")).cast("bigint"))
    return numbered.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))


def running_changes(df: DataFrame, keys: list[str], order: list[str], state: Column) -> DataFrame:
    """Rows at which the cumulative state (a running aggregate expression over earlier rows) differs from that of the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("state", state.over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("__p", F.lag("state").over(w)).where(~F.col("state").eqNullSafe(F.col("__p"))).drop("__p")


def numbered(df: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """df with exam_order: 1, 2, ... by date, unknown dates last, ties by `tie`."""
    return ranks.row_numbers(df, [key], [F.col(date).asc_nulls_last(), F.col(tie).asc()], "exam_order")


def last_known(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Per key the last non-null value in order: one aggregation, no sort."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("last_value"), F.max(order[0]).alias("last_at"))


def age_exact(birth: Column, day: Column) -> Column:
    """Days / 365.2425; null if unknown or before birth."""
    return F.when(day >= birth, F.datediff(day, birth) / 365.2425)


def age_years(birth: Column, day: Column) -> Column:
    """Completed calendar years; null if unknown or before birth."""
    early = (F.month(day) < F.month(birth)) | ((F.month(day) == F.month(birth)) & (F.dayofmonth(day) < F.dayofmonth(birth)))
    return F.when(day >= birth, F.year(day) - F.year(birth) - early.cast("int"))


def strict_date(text: Column) -> Column:
    """yyyy-MM-dd exactly, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def any_date(text: Column) -> Column:
    """ISO, d.m.yyyy, d/m/yyyy, yyyymmdd or a spreadsheet day number, else null; years outside 1880..2100 are unknown."""
    t = F.trim(text)
    serial = F.when(t.rlike(r"^\d{5}(\.0+)?$"), F.date_add(F.lit("1899-12-30").cast("date"), F.regexp_extract(t, r"^(\d{5})", 1).try_cast("int")))
    got = F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(t, "d.M.yyyy")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "d/M/yyyy")),
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
        serial,
    )
    return F.when(F.year(got).between(1880, 2100), got)


def partial_date(text: Column) -> Column:
    """struct(year, month, day, precision) of the first day, month or year date in a text: d.m.yyyy, m/yyyy, yyyy."""
    part = lambda pattern, g: F.regexp_extract(text, pattern, g).try_cast("int")
    day, month, year = r"\b(\d{1,2})\.(\d{1,2})\.((?:19|20)\d{2})\b", r"\b(\d{1,2})/((?:19|20)\d{2})\b", r"\b((?:19|20)\d{2})\b"
    out = lambda y, m, d, p: F.struct(y.alias("year"), m.alias("month"), d.alias("day"), F.lit(p).alias("precision"))
    none = F.lit(None).cast("int")
    padded = F.concat_ws("-", F.regexp_extract(text, day, 3), F.lpad(F.regexp_extract(text, day, 2), 2, "0"), F.lpad(F.regexp_extract(text, day, 1), 2, "0"))
    valid = F.try_to_date(padded, "yyyy-MM-dd")
    return F.when(text.rlike(day) & valid.isNotNull(), out(part(day, 3), part(day, 2), part(day, 1), "day")).when(text.rlike(month) & part(month, 1).between(1, 12), out(part(month, 2), part(month, 1), none, "month")).when(text.rlike(year), out(part(year, 1), none, none, "year")).otherwise(out(none, none, none, "unknown"))


def compatible_dates(a: str, b: str) -> Column:
    """Whether two partial dates (columns <a>_year, <a>_month, <a>_day, ...) can be one date; an unknown part agrees with all."""
    same = lambda part: F.coalesce(F.col(f"{a}_{part}") == F.col(f"{b}_{part}"), F.lit(True))
    return same("year") & same("month") & same("day")


def compatible_pairs(dates: DataFrame, keys: list[str], year: str, month: str, day: str) -> DataFrame:
    """keys, year, the months and days (_a, _b) of two distinct partial dates of that year, whether they can be one date, and how many pairs of rows they stand for.

    Distinct dates of a year are a few hundred at most, so a key with many rows makes no more pairs than its calendar has."""
    per = dates.groupBy(*keys, year, month, day).agg(F.count(F.lit(1)).alias("__n"))
    side = lambda s: per.select(*keys, year, F.col(month).alias(f"{month}_{s}"), F.col(day).alias(f"{day}_{s}"), F.col("__n").alias(f"__n_{s}"))
    place = lambda s: F.struct(F.coalesce(f"{month}_{s}", F.lit(0)), F.coalesce(f"{day}_{s}", F.lit(0)))
    rows = side("a").join(side("b"), [*keys, year]).where(place("a") < place("b"))
    same = lambda c: F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(True))
    return rows.withColumn("compatible", same(month) & same(day)).withColumn("n_pairs", F.col("__n_a") * F.col("__n_b")).drop("__n_a", "__n_b")


def first_day(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Per key the earliest known day, the value its rows agree on (else null), and their number. Two aggregations, no join back."""
    days = df.where(F.col(time).isNotNull()).groupBy(*keys, F.to_date(time).alias("first_date")).agg(F.min(value).alias("l"), F.max(value).alias("h"), F.count(F.lit(1)).alias("n"))
    first = days.groupBy(*keys).agg(F.min_by(F.struct("first_date", "l", "h", "n"), "first_date").alias("d"))
    return first.select(*keys, "d.first_date", F.when(F.col("d.l") == F.col("d.h"), F.col("d.l")).alias("value"), F.col("d.n").alias("n"))


def dated_identities(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """keys, n_identities, dated: distinct days are identities and take in what is undated; without any day there is one undated identity."""
    return df.groupBy(*keys).agg(F.greatest(F.count_distinct(day), F.lit(1)).alias("n_identities"), (F.count(day) > 0).alias("dated"))
