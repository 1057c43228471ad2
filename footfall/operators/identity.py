"""Who did it: device-account scores, one global id per user, persistent dense numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.columns import blank_to_null
from footfall.plans.joins import left_join
from footfall.plans.scan import dense_rank_ids
from footfall.session import stored

# Fixed values of the score rule: points per session, and the factor for a day without contact.
POINTS_PER_SESSION = 100
IDLE_DECAY = 0.7


def daily_scores(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per (device, account): 100 points per distinct session, and the first time of the day."""
    return (
        events.select(
            blank_to_null("deviceid").alias("deviceid"), blank_to_null("account").alias("account"), "sessionid", ts
        )
        .where(F.col("deviceid").isNotNull())
        .groupBy("deviceid", "account")
        .agg(
            (F.countDistinct("sessionid") * POINTS_PER_SESSION).cast("double").alias("score"),
            F.min(ts).alias("min_time"),
        )
    )


def contact_counts(logs: DataFrame, clean: Column, ts: str = "timestamp") -> DataFrame:
    """(deviceid, account, clean, events, score, min_time): ``daily_scores`` of all raw rows, with their number.

    One scan of the logs gives the scores of the clean rows (``scores_of``) and how many rows were clean or not.
    """
    return (
        logs.select(blank_to_null("deviceid").alias("deviceid"), blank_to_null("account").alias("account"), clean.alias("clean"), "sessionid", ts)
        .groupBy("deviceid", "account", "clean")
        .agg(
            F.count(F.lit(1)).alias("events"),
            (F.countDistinct("sessionid") * POINTS_PER_SESSION).cast("double").alias("score"),
            F.min(ts).alias("min_time"),
        )
    )


def scores_of(counts: DataFrame) -> DataFrame:
    """The daily scores out of ``contact_counts``."""
    return counts.where(F.col("clean") & F.col("deviceid").isNotNull()).select("deviceid", "account", "score", "min_time")


def roll_scores(prev: DataFrame, cur: DataFrame, now_ms: Column | int, decay: float = IDLE_DECAY) -> DataFrame:
    """Relation table of the day from the one of the day before and today's scores.

    Both sides hold one row per (device, account), so a union and one grouping does the work of a
    null-safe full join. A device keeps an account-less row only while it has no account. The merged rows are
    stored: either table is read once.
    """
    before = prev.select(
        "deviceid", "account", "score", "first_time", "last_time",
        F.lit(None).cast("double").alias("new_score"), F.lit(None).cast("long").alias("new_time"),
    )
    today = cur.select(
        "deviceid", "account",
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("long").alias("first_time"), F.lit(None).cast("long").alias("last_time"),
        F.col("score").alias("new_score"), F.col("min_time").alias("new_time"),
    )
    merged = stored(
        before.unionByName(today)
        .withColumn("account", blank_to_null("account"))
        .groupBy("deviceid", "account")
        .agg(
            F.max("score").alias("old"),
            F.max("new_score").alias("new"),
            F.max("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
            F.max("new_time").alias("new_time"),
        ),
        "merged-scores",
    )
    rows = merged.select(
        "deviceid",
        "account",
        F.when(F.col("new").isNull(), F.col("old") * F.lit(decay))
        .otherwise(F.coalesce("old", F.lit(0.0)) + F.col("new"))
        .alias("score"),
        F.coalesce("first_time", "new_time").alias("first_time"),
        F.coalesce("new_time", "last_time").alias("last_time"),
    )
    known = rows.where(F.col("account").isNotNull())
    return known.unionByName(_anonymous(merged, now_ms))


def _decayed(score: Column, days: Column, decay: float) -> Column:
    """The score after so many idle days, multiplied day by day as the daily roll does."""
    return F.when(days > 0, F.aggregate(F.sequence(F.lit(1), days), score, lambda s, _: s * F.lit(decay))).otherwise(score)


def latest_contacts(contacts: DataFrame) -> DataFrame:
    """The last row of each (device, account) out of those written day by day."""
    last = F.max_by(F.struct("score", "first_time", "last_time", "since"), "since")
    return contacts.groupBy("deviceid", "account").agg(last.alias("_last")).select("deviceid", "account", "_last.*")


def step_scores(latest: DataFrame, cur: DataFrame, day: str, decay: float = IDLE_DECAY) -> DataFrame:
    """What a day adds to the relation: a row for each (device, account) met on it, and none for the others.

    ``latest`` holds the last row of each as of the day before, ``cur`` the scores of the day. ``scores_on`` gives the relation
    of any day from such rows, equal to what ``roll_scores`` makes of the whole table day by day.
    """
    today, idle = F.lit(day).cast("date"), F.datediff(F.date_sub(F.lit(day).cast("date"), 1), F.col("since"))
    before = latest.select(
        "deviceid", "account", _decayed(F.col("score"), idle, decay).alias("score"), "first_time", "last_time",
        F.lit(None).cast("double").alias("new_score"), F.lit(None).cast("long").alias("new_time"), F.lit(False).alias("_met"),
    )
    met = cur.select(
        "deviceid", blank_to_null("account").alias("account"), F.col("score").alias("new_score"), F.col("min_time").alias("new_time"), F.lit(True).alias("_met")
    )
    merged = before.unionByName(met, allowMissingColumns=True).groupBy("deviceid", "account").agg(
        F.max("score").alias("old"), F.max("new_score").alias("new"), F.max("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"), F.max("new_time").alias("new_time"), F.max("_met").alias("_met"),
    )
    return merged.where("_met").select(
        "deviceid", "account", (F.coalesce("old", F.lit(0.0)) + F.col("new")).alias("score"),
        F.coalesce("first_time", "new_time").alias("first_time"), F.coalesce("new_time", "last_time").alias("last_time"), today.alias("since"),
    )


def scores_on(latest: DataFrame, day: str, now_ms: Column | int, decay: float = IDLE_DECAY) -> DataFrame:
    """The relation of a day from the last rows of each (device, account) up to it; ``now_ms`` stamps devices without account."""
    idle = F.datediff(F.lit(day).cast("date"), F.col("since"))
    known = latest.where(F.col("account").isNotNull()).select(
        "deviceid", "account", _decayed(F.col("score"), idle, decay).alias("score"), "first_time", "last_time"
    )
    return known.unionByName(_anonymous(latest, now_ms))


def _anonymous(contacts: DataFrame, now_ms: Column | int) -> DataFrame:
    """One row without score for every device that has no account."""
    now = (now_ms if isinstance(now_ms, Column) else F.lit(now_ms)).cast("long")
    return (
        contacts.groupBy("deviceid")
        .agg(F.count("account").alias("_accounts"))
        .where(F.col("_accounts") == 0)
        .select("deviceid", F.lit(None).cast("string").alias("account"), F.lit(0.0).alias("score"), now.alias("first_time"), now.alias("last_time"))
    )


def best_account(relation: DataFrame) -> DataFrame:
    """The account with the highest score per device, the most recent one on a tie."""
    return (
        relation.where(F.col("account").isNotNull())
        .groupBy("deviceid")
        .agg(F.max_by("account", F.struct("score", "last_time", "account")).alias("best_account"))
    )


def resolve_guid(events: DataFrame, best: DataFrame) -> DataFrame:
    """Add ``guid``: the account, else the best account of the device, else the device."""
    return (
        left_join(events, best, {"deviceid": "deviceid"})
        .withColumn(
            "guid",
            F.coalesce(blank_to_null("account"), blank_to_null("best_account"), blank_to_null("deviceid")),
        )
        .drop("best_account")
    )


def flag_new(events: DataFrame, known: DataFrame, key: str = "guid") -> DataFrame:
    """Add ``newflag``: true when the user is not in the global table."""
    seen = known.select(key).distinct().withColumn("_seen", F.lit(True))
    return left_join(events, seen, {key: key}).withColumn("newflag", F.col("_seen").isNull()).drop("_seen")


def identify(events: DataFrame, best: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``guid`` and ``newflag``.

    Both follow from (deviceid, account), so they are worked out once per distinct pair, and the
    events are joined once with the result instead of once with every lookup table.
    """
    pairs = flag_new(resolve_guid(events.select("deviceid", "account").distinct(), best), known).select(
        F.col("deviceid").alias("_d"), F.col("account").alias("_a"), "guid", "newflag"
    )
    same = F.col("deviceid").eqNullSafe(F.col("_d")) & F.col("account").eqNullSafe(F.col("_a"))
    return events.join(pairs, same, "left").drop("_d", "_a")


def flag_new_by_contact(events: DataFrame, relation: DataFrame) -> DataFrame:
    """Add ``newflag`` by the older rule: neither the account nor the device was known the day before."""
    devices = relation.select("deviceid").distinct().withColumn("_dev", F.lit(True))
    accounts = (
        relation.select("account").where(F.col("account").isNotNull()).distinct().withColumn("_acc", F.lit(True))
    )
    return (
        left_join(left_join(events, devices, {"deviceid": "deviceid"}), accounts, {"account": "account"})
        .withColumn("newflag", F.col("_dev").isNull() & F.col("_acc").isNull())
        .drop("_dev", "_acc")
    )


def allocate_ids(guids: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """(id, guid) for the guids the table does not hold, numbered on from its highest id."""
    new = guids.select("guid").where(F.col("guid").isNotNull()).distinct()
    if table is None:
        return dense_rank_ids(new, "guid", "id")
    new = new.join(table.select("guid"), "guid", "left_anti")
    top = table.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long")).scalar()
    return dense_rank_ids(new, "guid", "id").withColumn("id", F.col("id") + top)


def daily_active(events: DataFrame) -> DataFrame:
    return events.select("guid", "dt").where(F.col("guid").isNotNull()).distinct()
