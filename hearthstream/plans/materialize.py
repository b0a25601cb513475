"""Messages to typed records: the whole path, once per batch or micro-batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hearthstream.operators import records as R
from hearthstream.operators.days import day_bitmap, outside_days
from hearthstream.operators.envelope import (
    MISSING_LSID,
    melt_fields,
    parse_body,
    with_header_columns,
)
from hearthstream.operators.keyed import absent_from, assign_ids, next_id_base
from hearthstream.operators.orphans import ORPHAN_KEYS, as_messages, replayable
from hearthstream.session import cut_lineage, observing
from hearthstream.sources.tables import Tables


NO_LSID = "no_lsid"
NO_DEVICE = "no_device"
NO_BODY = "no_body"
GOOD = "good"

REASONS = {NO_LSID: MISSING_LSID, NO_DEVICE: R.MISSING_DEVICE, NO_BODY: R.BAD_BODY}


def judge(messages: DataFrame, devices: DataFrame) -> DataFrame:
    """Messages with header columns, ``device_id``, ``body`` and a ``verdict``.

    A missing device number is tested before the device, the device before the
    body, so a message has exactly one fate.
    """
    looked_up = parse_body(R.with_device(with_header_columns(messages), devices))
    return looked_up.withColumn(
        "verdict",
        F.when(F.col("lsid") == 0, NO_LSID)
        .when(F.col("device_id").isNull(), NO_DEVICE)
        .when(F.col("parse_error"), NO_BODY)
        .otherwise(GOOD),
    )


def points_of(judged: DataFrame) -> DataFrame:
    """One row per field value of the good messages."""
    return R.melted_points(melt_fields(judged.where(F.col("verdict") == GOOD)))


def dead_letters(judged: DataFrame, replay: bool, now: Column) -> DataFrame:
    """Orphans: unknown devices and, in a replay, unreadable bodies.

    A streaming run only counts unreadable bodies.
    """
    kept = [NO_DEVICE, NO_BODY] if replay else [NO_DEVICE]
    reason = F.when(F.col("verdict") == NO_DEVICE, R.MISSING_DEVICE).otherwise(R.BAD_BODY)
    return R.as_orphans(judged.where(F.col("verdict").isin(kept)), reason, now)


def failed_messages(judged: DataFrame, replay: bool) -> DataFrame:
    """Messages that count as errors, with their reason."""
    failing = [NO_LSID, NO_BODY, NO_DEVICE] if replay else [NO_LSID, NO_BODY]
    reason = F.lit(None).cast("string")
    for verdict, text in REASONS.items():
        reason = F.when(F.col("verdict") == verdict, text).otherwise(reason)
    return judged.where(F.col("verdict").isin(failing)).select(
        "topic", "partition", "offset", "lsid", "record_ts", reason.alias("reason")
    )


def numbered_tags(fresh: DataFrame, tags: DataFrame, now: Column) -> DataFrame:
    """Complete tag rows, ids included, of the tags a batch introduces."""
    numbered = assign_ids(fresh, ["device_id", "tag_name"], next_id_base(tags))
    return numbered.withColumns({"created_at": now, "updated_at": now}).select(*tags.columns)


def routed_points(points: DataFrame, tags: DataFrame) -> DataFrame:
    return R.route_records(R.with_tag(points, tags))


def batch_tables(
    messages: DataFrame,
    devices: DataFrame,
    tags: DataFrame,
    catalog: DataFrame,
    replay: bool = True,
    now: Column | None = None,
) -> dict[str, DataFrame]:
    """The path without storage: what a first run over the messages would write.

    The points are staged and the new tags computed right away; the other frames are
    lazy and can be queried on their own.  No body is parsed again for records.
    """
    now = F.current_timestamp() if now is None else now
    judged = judge(messages, devices)
    points = cut_lineage(points_of(judged), "points")
    fresh = cut_lineage(R.new_tag_rows(R.first_seen_types(points), tags, catalog))
    all_tags = tags.unionByName(cut_lineage(numbered_tags(fresh, tags, now)))
    routed = routed_points(points, all_tags)
    return {
        "tags": all_tags,
        "routed": routed,
        "records": R.accepted_records(routed),
        "rejected": routed.where(F.col("kind") == "rejected"),
        "orphans": dead_letters(judged, replay, now),
        "errors": failed_messages(judged, replay),
    }


@dataclass
class Summary:
    """Counters of one materialized batch."""

    counts: dict[str, int] = field(default_factory=dict)

    def __getitem__(self, name: str) -> int:
        return int(self.counts.get(name) or 0)


def materialize(
    messages: DataFrame,
    tables: Tables,
    replay: bool = False,
    now: Column | None = None,
) -> Summary:
    """Write a batch of messages into the tables.

    One pass over the messages parses the bodies, counts, notes which days occur
    and stages the values as narrow rows.  New tags are found and records routed
    from the staged rows.  Dead letters cost another pass, over the messages
    without their fields, only when there are any.

    Order of writes: tags, records, orphans.  Each is idempotent, so a batch that
    fails half-way is simply run again.
    """
    spark = messages.sparkSession
    now = F.current_timestamp() if now is None else now
    if messages.isEmpty():
        return Summary()
    tags = tables.dimension("tags")
    catalog = tables.dimension("sensor_catalog")

    judged = judge(messages, tables.dimension("devices"))
    arrived, melted = Observation("arrived"), Observation("melted")
    observed = judged.observe(
        arrived,
        F.count(F.lit(1)).alias("messages"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in (NO_LSID, NO_DEVICE, NO_BODY)],
    )
    with observing(spark):
        points = cut_lineage(
            points_of(observed).observe(
                melted,
                day_bitmap(F.col("ts")).alias("days"),
                outside_days(F.col("ts")).alias("outside"),
            ),
            "points",
        )
        counts = dict(arrived.get)
        days, outside = melted.get["days"], melted.get["outside"] > 0
    fresh_tags = cut_lineage(R.new_tag_rows(R.first_seen_types(points), tags, catalog))
    new_tags = 0
    if not fresh_tags.isEmpty():
        known = tags.count()

        def with_fresh(stored: DataFrame) -> DataFrame:
            # Another writer may have added some of them since.
            missing = absent_from(fresh_tags, stored, ["device_id", "tag_name"])
            return stored.unionByName(numbered_tags(missing, stored, now))

        tags = tables.update_dimension("tags", with_fresh)
        new_tags = tags.count() - known

    before = tables.record_counts(tables.records_of_days(days, outside))
    accepted = R.accepted_records(routed_points(points, tags))
    tables.append_records(R.unrecorded(accepted, tables.records_of_days(days, outside)))
    after = tables.record_counts(tables.records_of_days(days, outside))

    if counts[NO_DEVICE] or (replay and counts[NO_BODY]):
        tables.append_orphans(dead_letters(judged, replay, now))

    # Unknown devices count as processed in a stream and as errors in a replay.
    errors = counts[NO_LSID] + counts[NO_BODY] + (counts[NO_DEVICE] if replay else 0)
    inserted = {k: after.get(k, 0) - before.get(k, 0) for k in ("numeric", "text", "null")}
    return Summary(
        {
            "messages": counts["messages"],
            "processed": counts["messages"] - errors,
            "errors": errors,
            "new_tags": new_tags,
            **inserted,
        }
    )


def replay_orphans(tables: Tables, now: Column | None = None) -> Summary:
    """Materialize pending orphans whose device is known by now, and mark the good ones.

    An orphan that fails again, whatever its stored reason, stays pending.
    """
    # Staged: the rows are read by several passes and appended to their own source.
    devices = tables.dimension("devices")
    ready = cut_lineage(replayable(tables.orphans(), devices))
    summary = materialize(as_messages(ready), tables, now=now)
    good = judge(as_messages(ready), devices).where(F.col("verdict") == GOOD)
    done = ready.join(good.select(*ORPHAN_KEYS).distinct(), ORPHAN_KEYS, "left_semi")
    tables.append_orphans(done.withColumn("reprocessed", F.lit(True)))
    return summary
