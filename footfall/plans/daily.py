"""The daily jobs: how the operators follow each other, and which tables they fill.

Every job takes the tables it needs as DataFrames; ``run_day`` wires them to a folder of day-partitioned
tables. Days are replaced as a whole, so a job can be repeated.
"""

from __future__ import annotations

from datetime import date, timedelta

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.functions.columns import millis_date
from footfall.operators import activity, cube, geo, identity, quality, sessions
from footfall.operators.clean import clean_events, extract_props, is_clean
from footfall.session import stored
from footfall.sources.tables import discard_day, publish_day, scan_day, stage_day, write_day

REQUIRED = ["properties", "eventid", "sessionid"]
ANY_OF = ["account", "deviceid"]


def detail(
    logs: DataFrame, relation: DataFrame, known: DataFrame, places: DataFrame, ranges: DataFrame, precision: int = 6
) -> DataFrame:
    """Cleaned events with session, place, user and new-visitor flag."""
    events = clean_events(logs, REQUIRED, ANY_OF)
    events = sessions.sessionize(events)
    events = geo.locate(events, places, ranges, precision)
    events = events.withColumn("location", F.concat_ws("|", "province", "city", "region"))
    events = identity.identify(events, identity.best_account(relation), known)
    return events.withColumn("dt", millis_date("timestamp"))


#: The tables whose rows the gates judge; none is published unless all gates pass.
GATED = ("device_account_contact", "event_app_detail", "user_guid_global")

#: Tables of which a day holds only what that day changed, and their columns.
CHANGES = {
    "device_account_contact": "deviceid string, account string, score double, first_time long, last_time long, since date",
    "user_range_closed": "first_dt date, guid string, range_start date, range_end date",
    "user_range_open": "first_dt date, guid string, range_start date, range_end date",
    "user_first_day": "guid string, first_dt date",
    "user_active_word": "guid string, since date, active_status long",
}
#: Every so many days the last contact of every (device, account) is written out, so that reading starts from there.
SNAPSHOT_DAYS = 30


def _table(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """All days of a table, or no rows where nothing was ever written."""
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as e:
        # A folder that holds nothing but what was once staged has no schema yet.
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], f"{schema or CHANGES[name]}, dt date")


def _up_to(spark: SparkSession, root: str, name: str, day: str, after: str | None = None) -> DataFrame:
    rows = _table(spark, root, name).where(F.col("dt") <= F.lit(day).cast("date"))
    return (rows.where(F.col("dt") > F.lit(after).cast("date")) if after else rows).drop("dt")


def contacts_on(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The last row of each (device, account) up to ``day``: the newest snapshot, and the days after it."""
    snapshots = _table(spark, root, "device_account_snapshot", CHANGES["device_account_contact"]).where(F.col("dt") <= F.lit(day).cast("date"))
    newest = snapshots.agg(F.max("dt").cast("string")).first()[0]
    later = _up_to(spark, root, "device_account_contact", day, newest)
    if newest:
        later = later.unionByName(snapshots.where(F.col("dt") == F.lit(newest).cast("date")).drop("dt"))
    return identity.latest_contacts(later)


def relation_on(spark: SparkSession, root: str, day: str, now_ms: int) -> DataFrame:
    """The device-account relation of any day that was run."""
    return identity.scores_on(contacts_on(spark, root, day), day, now_ms)


def ranges_on(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The active ranges of any day that was run: all closed until then, and those open on it."""
    opened = _table(spark, root, "user_range_open").where(F.col("dt") == F.lit(day).cast("date")).drop("dt")
    return _up_to(spark, root, "user_range_closed", day).unionByName(opened)


def status_on(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The activity words of any day that was run; only the folders of its window are read."""
    eve = (date.fromisoformat(day) - timedelta(days=activity.WINDOW_DAYS + 1)).isoformat()
    known = activity.first_days(_up_to(spark, root, "user_first_day", day))
    return activity.status_on(_up_to(spark, root, "user_active_word", day, eve), known, day)



def run_day(
    spark: SparkSession, root: str, day: str, places: DataFrame, ranges: DataFrame, now_ms: int,
    products: DataFrame | None = None, pages: DataFrame | None = None, gates: Mapping[str, float] | None = None,
) -> dict[str, float]:
    """One day from raw logs to reports under ``root``; needs ``ods_event_app_log`` with that day.

    Every step starts from tables already written, so nothing is computed twice or lost with an executor. A
    repeated run replaces the day; ids once given stay, those of later days included. A day whose eve is
    missing raises: ``run_days`` rolls over the gap. ``products`` (id, cat_name, brand_name) and ``pages``
    (id, lanmu_name) also give the share reports.

    Contacts, detail and ids are staged first and counted: raw rows while their scores are folded, the rest from a column of
    the staged tables. If a count is above its limit in ``gates`` (default ``quality.GATES``), nothing of the day is published and ``GateFailed`` is raised.
    Returns the value of every gate.
    """
    before = (date.fromisoformat(day) - timedelta(days=1)).isoformat()
    # The last table of a run: one row per day that is complete.
    runs = _table(spark, root, "run_of_day", "rows_read long")
    last = runs.where(F.col("dt") < F.lit(day).cast("date")).agg(F.max("dt").cast("string")).first()[0]
    if last is not None and last != before:
        raise ValueError(f"the tables end on {last}: run the days up to {before} first")

    logs = scan_day(spark, f"{root}/ods_event_app_log", day)
    counts = stored(identity.contact_counts(logs, is_clean(logs, REQUIRED, ANY_OF)), "contact-counts")
    scores = identity.scores_of(counts)
    known_contacts = contacts_on(spark, root, before)
    met = stage_day(identity.step_scores(known_contacts, scores, day), f"{root}/device_account_contact", day)
    relation = identity.scores_on(identity.latest_contacts(known_contacts.unionByName(met.drop("dt"))), day, now_ms)

    every = _table(spark, root, "user_guid_global", "id long, guid string")
    known = every.where(F.col("dt") < F.lit(day).cast("date")).select("id", "guid")
    rows = stage_day(detail(logs, relation, known, places, ranges), f"{root}/event_app_detail", day)
    # Ids of all days are taken, also those after this one.
    given = every.where(F.col("dt") == F.lit(day).cast("date")).select("id", "guid")
    fresh = identity.allocate_ids(rows.where("newflag"), every.select("id", "guid"))
    ids_now = stage_day(given.unionByName(fresh), f"{root}/user_guid_global", day)
    new_ids = ids_now.join(every.select("guid"), "guid", "left_anti")

    values = quality.gate_values(counts, rows, new_ids, relation)
    try:
        quality.hold_back(values, quality.GATES if gates is None else gates)
    except quality.GateFailed:
        for name in GATED:
            discard_day(spark, f"{root}/{name}", day)
        raise
    for name in GATED:
        publish_day(spark, f"{root}/{name}", day)

    rows = scan_day(spark, f"{root}/event_app_detail", day)
    write_day(geo.unresolved_points(rows), f"{root}/unresolved_points", day)
    write_day(identity.daily_active(rows), f"{root}/user_active_day", day)

    ids = spark.read.parquet(f"{root}/user_guid_global").select("id", "guid")
    dims = sessions.USER_DIMS
    write_day(sessions.session_agg(extract_props(rows, {"pageId": "page"})), f"{root}/app_flow_agg_session", day)
    per_session = scan_day(spark, f"{root}/app_flow_agg_session", day)
    write_day(sessions.user_traffic(per_session), f"{root}/app_flow_agg_user", day)
    per_user = scan_day(spark, f"{root}/app_flow_agg_user", day)
    write_day(cube.traffic_base(per_user, ids, dims), f"{root}/app_flow_overview_bitmap", day)
    base = scan_day(spark, f"{root}/app_flow_overview_bitmap", day)
    write_day(cube.traffic_cube(base, dims), f"{root}/app_flow_overview_cube", day)
    if products is not None and pages is not None:
        write_day(cube.share_base(rows, products, pages, ids), f"{root}/share_event_overview_bitmap", day)
        write_day(cube.share_cube(scan_day(spark, f"{root}/share_event_overview_bitmap", day)), f"{root}/share_event_overview_cube", day)

    active = scan_day(spark, f"{root}/user_active_day", day)
    opened = _table(spark, root, "user_range_open").where(F.col("dt") == F.lit(before).cast("date")).drop("dt")
    known_users = activity.first_days(_up_to(spark, root, "user_first_day", before))
    closed, opened, first = activity.step_ranges(opened, known_users, active, day)
    words = activity.step_status(_up_to(spark, root, "user_active_word", before), active, day)
    for name, changed in (("user_range_closed", closed), ("user_range_open", opened), ("user_first_day", first), ("user_active_word", words)):
        write_day(changed, f"{root}/{name}", day)
    write_day(activity.retention(scan_day(spark, f"{root}/user_range_open", day), day), f"{root}/user_retention", day)
    if date.fromisoformat(day).toordinal() % SNAPSHOT_DAYS == 0:
        write_day(contacts_on(spark, root, day), f"{root}/device_account_snapshot", day)
    write_day(spark.createDataFrame([(counts.agg(F.sum("events")).first()[0],)], "rows_read long"), f"{root}/run_of_day", day)
    return values


def run_days(spark: SparkSession, root: str, first: str, last: str, places: DataFrame, ranges: DataFrame, now_ms: int, **more) -> None:
    """``run_day`` for each day from ``first`` to ``last``; a day without logs rolls on with nobody active."""
    day, end = date.fromisoformat(first), date.fromisoformat(last)
    while day <= end:
        run_day(spark, root, day.isoformat(), places, ranges, now_ms, **more)
        day += timedelta(days=1)
