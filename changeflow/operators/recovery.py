"""Health of consumers and repair after lost history, feed gaps and replays."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.contracts import (
    CHANGE_TYPE,
    COMMIT_TIMESTAMP,
    COMMIT_VERSION,
    DATA_OPERATIONS,
    DELETE,
    INSERT,
    LAST_VERSION,
    POSTIMAGE,
    PREIMAGE,
)
from changeflow.operators.changes import union_changes
from changeflow.operators.scd import anti_new_keys
from changeflow.operators.state import (
    apply_changes_scd1,
    current_snapshot,
    empty_state,
    snapshot_as_of,
    snapshot_diff,
)
from changeflow.sources.commits import latest_version
from changeflow.sources.feed import changes_between

# Default lag limit in versions, and the share of retained history used up at which to alert.
MAX_LAG = 100
RETENTION_ALERT_PERCENT = 80

# Status codes in order of priority, with what to do.
ACTIONS = {
    "FEED_DISABLED": "Turn the feed on again, find the gap window, repair it from a snapshot diff.",
    "VERSION_LOST": "Take a full snapshot as the new baseline and move the watermark to its version.",
    "NEVER_READ": "Start a consumer, or take the source off the ledger.",
    "HIGH_LAG": "Run more often or keep history longer.",
    "OK": "None.",
}


def _ledger_per_source(commits: DataFrame, progress: DataFrame) -> DataFrame:
    """Facts about the commits of every source, of the ledger or of progress, relative to what was processed.

    A left join first, which adaptive execution can split on a source with very
    many commits; then an aggregate that combines on the map side.  A source nobody has read has no
    last version, and all its commits are unread.
    """
    version, last = F.col("version"), F.col("last_version")
    unread = version > F.coalesce(last, F.lit(0))
    data = F.col("operation").isin(*DATA_OPERATIONS)
    facts = (
        commits.join(progress, "source", "left")
        .groupBy("source")
        .agg(
            F.max("version").alias("current_version"),
            F.max_by("feed_enabled", "version").alias("enabled_now"),
            F.min(F.when(F.col("retained"), version)).alias("first_retained"),
            F.min_by("retained", F.when(unread, version)).alias("next_retained"),
            F.coalesce(F.max(unread & data & ~F.col("feed_enabled")), F.lit(False)).alias("gap_unread"),
        )
    )
    return progress.join(facts, "source", "full_outer").withColumn(
        "lag", F.col("current_version") - F.coalesce(F.col("last_version"), F.lit(0))
    )


def feed_health(commits: DataFrame, progress: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Status and all issues of every source at once.

    A consumer that is caught up has lost nothing.  HIGH_LAG means strictly more than
    the limit.  A source without any commit counts as disabled, and one that the ledger has and
    progress lacks as NEVER_READ.
    """
    caught_up = F.col("lag") <= 0
    disabled = F.coalesce(~F.col("enabled_now") | F.col("gap_unread"), F.lit(True))
    lost = F.coalesce(~caught_up & ~F.col("next_retained"), F.lit(False))
    late = F.coalesce(F.col("lag") > max_lag, F.lit(False))
    issues = F.array_compact(
        F.array(
            F.when(disabled, "FEED_DISABLED"),
            F.when(lost, "VERSION_LOST"),
            F.when(F.col("last_version").isNull(), "NEVER_READ"),
            F.when(late, "HIGH_LAG"),
        )
    )
    action = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    return (
        _ledger_per_source(commits, progress)
        .withColumn("issues", issues)
        .withColumn("status", F.coalesce(F.get("issues", F.lit(0)), F.lit("OK")))
        .select(
            "source",
            "last_version",
            "current_version",
            "lag",
            "status",
            F.concat_ws(",", "issues").alias("issues"),
            F.element_at(action, F.col("status")).alias("action"),
        )
    )


def processing_lag(commits: DataFrame, progress: DataFrame) -> DataFrame:
    """Versions behind per source, and the share of the retained history used up.

    100 percent means that the next version to read is the oldest retained one.
    """
    span = F.col("current_version") - F.col("first_retained") + 1
    used = F.expr("lag * 100 div (current_version - first_retained + 1)")
    return _ledger_per_source(commits, progress).select(
        "source",
        "last_version",
        "current_version",
        "lag",
        F.when(span > 0, used).alias("retention_used_percent"),
        F.when(span > 0, used > RETENTION_ALERT_PERCENT).alias("alert"),
    )


def guarded_batch(health: DataFrame, run: Callable[[], DataFrame]) -> DataFrame:
    """Run a batch only if every source is healthy; raise before any data is read.

    `health` has one row per source and at least one.  The error counts the unhealthy sources
    by their issues, of which there are a few combinations; its `unhealthy` holds all their rows.
    """
    unhealthy = health.where(F.col("status") != "OK")
    found = health.groupBy("status", "issues", "action").agg(
        F.count("*").alias("sources"), F.min(F.struct("source", "last_version")).alias("first")
    )
    groups = found.orderBy("status", "issues").collect()
    if not groups:
        raise UnhealthyError("no source was checked", unhealthy)
    bad = [r for r in groups if r["status"] != "OK"]
    if bad:
        lines = [
            f"{r['issues']}: {r['sources']} sources, {r['first']['source']} first "
            f"(last version {r['first']['last_version']}). {r['action']}"
            for r in bad
        ]
        raise UnhealthyError("the batch was stopped by the health check\n" + "\n".join(lines), unhealthy)
    return run()


class UnhealthyError(RuntimeError):
    """A batch that was not run, with the health rows of all sources that stopped it."""

    def __init__(self, text: str, unhealthy: DataFrame):
        super().__init__(text)
        self.unhealthy = unhealthy


@dataclass(frozen=True)
class Baseline:
    """A snapshot at one version, and the watermark that goes with it."""

    snapshot: DataFrame
    version: int

    def progress(self, source: str) -> DataFrame:
        return self.snapshot.sparkSession.createDataFrame(
            [(source, self.version)], "source string, last_version bigint"
        )


def rebaseline(
    feed: DataFrame, commits: DataFrame, keys: Sequence[str], source: str | None = None
) -> Baseline:
    """The table at its latest version as a new baseline after lost history.

    The version is read once and fixes the snapshot, so a commit in between is not
    applied twice.  Rows carry it; the next read starts one version later.
    """
    version = latest_version(commits, source)
    snapshot = snapshot_as_of(feed, version, keys)
    return Baseline(snapshot.withColumn(LAST_VERSION, F.lit(version).cast("bigint")), version)


def gap_repair(
    pre: DataFrame,
    post: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    gap: DataFrame,
    commits: DataFrame,
) -> DataFrame:
    """Change rows that stand for a gap, from the snapshots at its two ends.

    A gap of inserts alone gives the new rows as inserts.  Otherwise the difference
    of the snapshots gives the net change; the states between are lost.  All rows
    carry the last version of the gap and the mark `synthetic`.

    `gap` is one row of `gap_window`; several gaps need several pairs of snapshots and
    are refused.
    """
    windows = gap.limit(2).collect()
    if not windows:
        raise ValueError("there is no gap to repair")
    if len(windows) > 1:
        raise ValueError("there is more than one gap; repair each with the snapshots at its own ends")
    window, last = windows[0], windows[0]["last_version"]
    mine = commits.where(F.col("source").eqNullSafe(F.lit(window["source"])) & (F.col("version") == last))
    at = mine.agg(F.max("timestamp").alias("at"))
    stamp = [
        F.lit(last).cast("bigint").alias(COMMIT_VERSION),
        at.scalar().alias(COMMIT_TIMESTAMP),
        F.lit(True).alias("synthetic"),
    ]
    if window["insert_only"]:
        new = anti_new_keys(post, pre, keys)
        return new.select(*keys, *columns, F.lit(INSERT).alias(CHANGE_TYPE), *stamp)

    before = [F.col(f"{c}_before").alias(c) for c in columns]
    after = [F.col(f"{c}_after").alias(c) for c in columns]

    def image(kind: str, values: list[Column]) -> Column:
        return F.struct(*values, F.lit(kind).alias(CHANGE_TYPE))

    change = F.col("change")
    images = (
        F.when(change == "INSERT", F.array(image(INSERT, after)))
        .when(change == "DELETE", F.array(image(DELETE, before)))
        .otherwise(F.array(image(PREIMAGE, before), image(POSTIMAGE, after)))
    )
    return snapshot_diff(pre, post, keys, columns).select(*keys, F.inline(images)).select(
        *keys, *columns, CHANGE_TYPE, *stamp
    )


def split_by_version(feed: DataFrame, bounds: Sequence[int]) -> list[DataFrame]:
    """The feed in consecutive version ranges that end at the given versions."""
    parts, start = [], 0
    for end in bounds:
        parts.append(changes_between(feed, start, end))
        start = end + 1
    parts.append(changes_between(feed, start))
    return parts


def apply_batches(state: DataFrame, batches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Batch after batch onto a state."""
    return reduce(lambda held, batch: apply_changes_scd1(held, batch, keys), batches, state)


def _scattered(feed: DataFrame, keys: Sequence[str]) -> list[DataFrame]:
    """Two halves of the feed that cut across versions: of a delete and an insert in one version either may come first."""
    half = F.pmod(F.xxhash64(*keys, COMMIT_VERSION, CHANGE_TYPE), F.lit(2))
    return [feed.where(half == part) for part in (1, 0)]


def replay_check(feed: DataFrame, keys: Sequence[str], bounds: Sequence[int]) -> DataFrame:
    """State rows that backward, scattered or repeated delivery does not give; must be empty.

    Scattered delivery cuts every version in two by a hash of its rows, whatever their type.

    The three final states meet in one aggregate; `forward`, `backward` and `again`
    count the copies of a row in each.  Give a feed that is stored, it is read once
    per batch and delivery.
    """
    batches = split_by_version(feed, bounds)
    start = empty_state(feed.sparkSession, feed, keys)
    backward = apply_batches(start, batches[::-1], keys)
    deliveries = {
        "forward": apply_batches(start, batches, keys),
        "backward": backward,
        "again": apply_batches(start, [*_scattered(feed, keys), feed], keys),
    }
    marked = [
        state.withColumn("delivery", F.lit(name)) for name, state in deliveries.items()
    ]
    columns = deliveries["forward"].columns
    copies = [
        F.count(F.when(F.col("delivery") == name, 1)).alias(name) for name in deliveries
    ]
    return (
        union_changes(marked)
        .groupBy(*columns)
        .agg(*copies)
        .where((F.col("forward") != F.col("backward")) | (F.col("forward") != F.col("again")))
    )


def replayed_state(feed: DataFrame, keys: Sequence[str], bounds: Sequence[int]) -> DataFrame:
    """The live rows after backward delivery and one full repetition."""
    batches = split_by_version(feed, bounds)[::-1]
    start = empty_state(feed.sparkSession, feed, keys)
    return current_snapshot(apply_batches(start, [*batches, feed], keys))
