"""Device features, checks, labelled join, split and EDA tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.functions.ranking import cumulative_before, log_bucket
from tvpulse.functions.time import micros_sum, minutes_to_micros
from tvpulse.operators.metrics import share_unpivot
from tvpulse.operators.quality import unique_grain
from tvpulse.schemas import FEATURE_COLUMNS, GENRES, SPLIT_SEED

BOX_FEATURES = ("DRAMA_SHARE", "ANIME_SHARE", "TOTAL_MINUTES", "ACTIVE_DAYS")
MEAN_FEATURES = ("DRAMA_SHARE", "VARIETY_SHARE", "ANIME_SHARE", "TOTAL_MINUTES", "ACTIVE_DAYS")


def device_features(daily: DataFrame) -> DataFrame:
    """M1: 12 features per device from the daily mart (one grouped pass).

    Minute totals are exact microsecond sums; shares and the mean use NULL-safe
    division, so a device with zero minutes gets NULL (caught by M2).

    The mart moves once, by device. There its rows are ordered by date and the
    first row of each date is marked, so that a distinct count does not shuffle
    all the sums per device and date, and again per device."""
    by_date = Window.partitionBy("DEVICE_ID").orderBy("VIEW_DATE")
    rows = daily.select("DEVICE_ID", "VIEW_DATE", "GENRE", "SESSION_COUNT", "VIEW_MINUTES",
                        F.lag("VIEW_DATE").over(by_date).alias("_date_before"))
    # a column of its own: rounded once a row, not once a genre
    rows = rows.withColumn("_micros", minutes_to_micros("VIEW_MINUTES"))
    new_date = F.col("VIEW_DATE").isNotNull() & ~F.col("VIEW_DATE").eqNullSafe(F.col("_date_before"))
    agg = rows.groupBy("DEVICE_ID").agg(
        micros_sum("_micros").alias("TOTAL_MINUTES"),
        F.sum("SESSION_COUNT").cast("double").alias("TOTAL_SESSIONS"),
        F.count(F.when(new_date, 1)).cast("double").alias("ACTIVE_DAYS"),
        *[micros_sum(F.when(F.col("GENRE") == g, F.col("_micros")).otherwise(F.lit(0).cast("decimal(28,0)"))).alias(g + "_MINUTES")
          for g in GENRES])
    total = F.nullif(F.col("TOTAL_MINUTES"), F.lit(0.0))
    return agg.select(
        "DEVICE_ID",
        *[(F.col(g + "_MINUTES") / total).alias(g + "_SHARE") for g in GENRES],
        "TOTAL_MINUTES", "TOTAL_SESSIONS", "ACTIVE_DAYS",
        (F.col("TOTAL_MINUTES") / F.nullif(F.col("TOTAL_SESSIONS"), F.lit(0.0))).alias("MEAN_MINUTES"))


def _finite(c: str):
    col = F.col(c)
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != F.lit(float("inf")))


def feature_checks(features: DataFrame, labels: DataFrame) -> DataFrame:
    """M2: rows violating one-row-per-device, non-NULL id, finite features,
    labels 0/1 and unique — as (CHECK_NAME, DEVICE_ID); empty = pass."""
    known = labels.filter(F.col("LABEL_AVAILABLE"))
    parts = [
        unique_grain(features, ["DEVICE_ID"]).select(F.lit("feature_device_unique").alias("CHECK_NAME"), "DEVICE_ID"),
        features.filter(F.col("DEVICE_ID").isNull()).select(F.lit("feature_device_not_null").alias("CHECK_NAME"),
                                                            "DEVICE_ID"),
        features.filter(~reduce(lambda a, b: a & b, [_finite(c) for c in FEATURE_COLUMNS]))
        .select(F.lit("feature_finite").alias("CHECK_NAME"), "DEVICE_ID"),
        known.filter(F.col("TARGET_F1").isNull() | ~F.col("TARGET_F1").isin(0, 1))
        .select(F.lit("label_binary").alias("CHECK_NAME"), "DEVICE_ID"),
        unique_grain(known, ["DEVICE_ID"]).select(F.lit("label_device_unique").alias("CHECK_NAME"), "DEVICE_ID"),
    ]
    return reduce(DataFrame.unionByName, parts)


def features_labeled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of labelled devices (inner join; M2 enforces one-to-one)."""
    known = labels.filter(F.col("LABEL_AVAILABLE")).select("DEVICE_ID", "TARGET_F1")
    return features.join(known, "DEVICE_ID")


def stratified_split(labeled: DataFrame, test_fraction: float = 0.2, seed: int = SPLIT_SEED,
                     label: str = "TARGET_F1") -> DataFrame:
    """M3: per label, the first round(fraction * n) devices in md5(id || seed)
    order (ties by id) are 'test', the rest 'train'. Exact ranks come from the
    bucketed prefix (first three hex digits of the hash), not a per-label sort."""
    h = F.md5(F.concat(F.col("DEVICE_ID"), F.lit(str(seed))))
    with_hash = labeled.withColumn("_h", h)
    ranked = cumulative_before(with_hash, [label], ["_h", "DEVICE_ID"],
                               F.conv(F.substring("_h", 1, 3), 16, 10).cast("bigint"))
    sizes = labeled.groupBy(label).agg(F.round(F.count(F.lit(1)) * F.lit(test_fraction)).cast("bigint")
                                       .alias("_n_test"))
    # one row per label value: size-bounded broadcast
    return (ranked.join(F.broadcast(sizes), label)
            .withColumn("SPLIT", F.when(F.col("_before") < F.col("_n_test"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_h", "_before", "_n_test"))


def eda_label_counts(train: DataFrame) -> DataFrame:
    """M4: training devices per label."""
    return train.groupBy("TARGET_F1").agg(F.count(F.lit(1)).alias("TV_COUNT"))


def _long(train: DataFrame, features) -> DataFrame:
    pairs = ", ".join(f"'{f}', `{f}`" for f in features)
    return train.select("TARGET_F1", F.expr(f"stack({len(features)}, {pairs}) AS (FEATURE, VALUE)"))


def eda_box_stats(train: DataFrame, features=BOX_FEATURES) -> DataFrame:
    """M5: exact quartiles (linear interpolation), whiskers at 1.5 IQR and
    outlier counts of four features per label.

    Values are first counted per distinct value, then ranked with the
    bucketed prefix; only the rows holding the needed ranks are kept."""
    long = _long(train, features).filter(F.col("VALUE").isNotNull())
    keys = ["TARGET_F1", "FEATURE"]
    counts = long.groupBy(*keys, "VALUE").agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = cumulative_before(counts, keys, ["VALUE"], log_bucket(F.col("VALUE")), F.col("_cnt"))
    sizes = counts.groupBy(*keys).agg(F.sum("_cnt").alias("N"))
    j = ranked.join(sizes, keys)
    picks = []
    for name, p in (("Q1", 0.25), ("MEDIAN", 0.5), ("Q3", 0.75)):
        pos = F.lit(p) * (F.col("N") - 1)
        for end, k in (("LO", F.floor(pos)), ("HI", F.ceil(pos))):
            covers = (F.col("_before") <= k) & (k < F.col("_before") + F.col("_cnt"))
            picks.append(F.max(F.when(covers, F.col("VALUE"))).alias(f"_{name}_{end}"))
    q = j.groupBy(*keys, "N").agg(*picks)
    for name, p in (("Q1", 0.25), ("MEDIAN", 0.5), ("Q3", 0.75)):
        pos = F.lit(p) * (F.col("N") - 1)
        lo, hi = F.col(f"_{name}_LO"), F.col(f"_{name}_HI")
        q = q.withColumn(name, lo + (pos - F.floor(pos)) * (hi - lo))
    iqr = F.col("Q3") - F.col("Q1")
    q = q.select(*keys, "N", "Q1", "MEDIAN", "Q3",
                 (F.col("Q1") - F.lit(1.5) * iqr).alias("_lf"), (F.col("Q3") + F.lit(1.5) * iqr).alias("_uf"))
    # one row per label x feature: size-bounded broadcast
    fenced = long.join(F.broadcast(q), keys)
    v = F.col("VALUE")
    return fenced.groupBy(*keys, "N", "Q1", "MEDIAN", "Q3").agg(
        F.min(F.when(v >= F.col("_lf"), v)).alias("LOWER_WHISKER"),
        F.max(F.when(v <= F.col("_uf"), v)).alias("UPPER_WHISKER"),
        F.count(F.when((v < F.col("_lf")) | (v > F.col("_uf")), 1)).alias("OUTLIERS"))


def eda_group_means(train: DataFrame, features=MEAN_FEATURES) -> DataFrame:
    """M6: mean of five features per label, rounded to 3 decimals."""
    return train.groupBy("TARGET_F1").agg(*[F.round(F.avg(f), 3).alias(f) for f in features])


def eda_genre_means(train: DataFrame) -> DataFrame:
    """M7: mean share of each genre per label, long form, suffix stripped."""
    wide = train.groupBy("TARGET_F1").agg(*[F.avg(g + "_SHARE").alias(g + "_SHARE") for g in GENRES])
    long = share_unpivot(wide, ["TARGET_F1"])
    return long.select("TARGET_F1", "GENRE", F.round("AVERAGE_SHARE", 9).alias("AVERAGE_SHARE"))


class FeatureCheckError(ValueError):
    """Features or labels failed M2; the model job does not train on them."""


def require_clean_features(features: DataFrame, labels: DataFrame) -> None:
    """Raise unless every M2 check is empty (only failing check names, at most
    five, reach the driver)."""
    failed = sorted(r.CHECK_NAME for r in feature_checks(features, labels).select("CHECK_NAME").distinct().collect())
    if failed:
        raise FeatureCheckError(f"feature/label checks failed: {failed}")
