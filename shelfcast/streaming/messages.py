"""Change detection and JSON messages, for tables and for streams."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfcast.operators.skew import ordered

EVENT_ORDER = ["ts", "event_id"]
# A session without events for this long is forgotten; its next value counts as a change.
EXPIRY = timedelta(days=30)
STORE = "spark.sql.streaming.stateStore.providerClass"


# ---- changes -----------------------------------------------------------------

def changes_only(
    df: DataFrame, session: str = "user_id", value: str = "event_type", order=EVENT_ORDER,
    expiry: timedelta | None = None,
) -> DataFrame:
    """Rows whose value differs from the session's previous one (the first counts).

    With ``expiry``, a row later than that after the session's previous one counts as its first.
    """

    def mark(d: DataFrame, w) -> DataFrame:
        same = F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1)
        if expiry is not None:
            same &= F.lag(order[0]).over(w) >= F.col(order[0]) - _interval(expiry)
        return d.withColumn("_same", same)

    # A piece of a hot session starts with lead-in rows, so row 1 is the session's first.
    return ordered(df, [session], order, mark, 1).where(~F.col("_same")).drop("_same")


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(secs=F.lit(span.total_seconds()))


# The event time in milliseconds travels with every row of the stream.
MILLIS = "_ms"
# Sessions are dealt by hash to this many keys: Spark's cost of a key is that of hundreds of rows.
BUCKETS = 1024


class _Changes:
    """The sessions of one bucket: rows wait until the watermark has passed them, and then go by in order
    against their session's last value. A bucket's state is one value that comes and goes with its rows, so what a
    micro-batch costs beside its rows follows the buckets, not the sessions. A timeout ends the wait, and forgets
    sessions after ``expiry``."""

    def __init__(self, names: list[str], session: str, value: str, order: list[str], kinds: dict[str, str], expiry: timedelta):
        self.names, self.expiry = [*names, MILLIS], round(expiry.total_seconds() * 1000)
        self.session, self.value = names.index(session), names.index(value)
        self.places = [names.index(c) for c in order]
        self.whole = [kind in ("tinyint", "smallint", "int", "bigint") for kind in [*kinds.values(), "bigint"]]

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, last = pickle.loads(state.get[0]) if state.exists else ([], {})
        if not state.hasTimedOut:
            for frame in frames:
                # Columns by place: frames of this operator do not keep every name.
                frame = frame.iloc[:, : len(self.names)]
                frame = frame[frame.iloc[:, -1].notna()]
                waiting += [self._plain(row) for row in frame.itertuples(index=False, name=None)]
        # No row up to the watermark can come any more.
        now = state.getCurrentWatermarkMs()
        ready = sorted((row for row in waiting if row[-1] <= now), key=self._place)
        waiting = [row for row in waiting if row[-1] > now]
        changed = []
        for row in ready:
            before = last.get(row[self.session])
            if before is None or row[-1] - before[0] > self.expiry or row[self.value] != before[1]:
                changed.append(row)
            last[row[self.session]] = (row[-1], row[self.value])
        self._keep(state, waiting, {s: v for s, v in last.items() if v[0] + self.expiry > now})
        if changed:
            yield pd.DataFrame([row[:-1] for row in changed], columns=self.names[:-1])

    def _keep(self, state: GroupState, waiting: list[tuple], last: dict) -> None:
        """One timeout: when the next row is due, or the next session is to be forgotten."""
        if waiting or last:
            due = min([*(row[-1] for row in waiting), *(at + self.expiry for at, _ in last.values())])
            state.update((pickle.dumps((waiting, last)),))
            state.setTimeoutTimestamp(max(due - 1, 1))  # Spark calls once the watermark is beyond it
        elif state.exists:
            state.remove()

    def _place(self, row: tuple) -> tuple:
        return tuple((row[k] is not None, row[k]) for k in self.places)  # null first, as in a sort

    def _plain(self, row: tuple) -> tuple:
        """Values as the state keeps them; pandas has whole numbers with gaps as floats."""
        return tuple(
            None if pd.isna(x) else x.to_pydatetime() if isinstance(x, pd.Timestamp) else int(x) if whole else x
            for x, whole in zip(row, self.whole)
        )


def keep_state(spark: SparkSession) -> None:
    """The state store on local disk with a checkpointed log: sessions need not fit into memory."""
    if "RocksDB" not in spark.conf.get(STORE, ""):
        spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def changes_only_stream(
    events: DataFrame, session: str = "user_id", value: str = "event_type", order=EVENT_ORDER,
    delay: timedelta = timedelta(hours=1), expiry: timedelta = EXPIRY,
) -> DataFrame:
    """Streaming form of ``changes_only(..., expiry=expiry)``: the same rows, in any order of arrival.

    ``order[0]`` is the event time. A row may arrive up to ``delay`` after later ones: it waits in its
    bucket's state until the watermark has passed it, and goes by in order. Rows later than that are
    dropped and counted by Spark (``numRowsDroppedByWatermark``), as are rows without a time; nothing
    already given out changes. The sessions' rows of the last ``delay`` are the state, and their last
    values until ``expiry`` has passed without events. The last rows of a stream come out once a later
    event moves the watermark beyond them.
    """
    keep_state(events.sparkSession)
    schema = events.select(session, *order, value).schema
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    by = _Changes(schema.names, session, value, list(order), kinds, expiry)
    at = F.col(order[0]).cast("timestamp")
    bucket = F.pmod(F.xxhash64(session), F.lit(BUCKETS)).alias("_bucket")
    timed = events.select(*schema.names, F.unix_millis(at).alias(MILLIS), at.alias("_at"), bucket)
    waiting = timed.withWatermark("_at", f"{round(delay.total_seconds() * 1000)} milliseconds")
    return waiting.groupBy("_bucket").applyInPandasWithState(
        by, schema, "state binary", "append", GroupStateTimeout.EventTimeTimeout
    )


# ---- messages ----------------------------------------------------------------

def json_messages(
    df: DataFrame, text: str = "message", wanted: str = "clipboard", field: str = "text"
) -> DataFrame:
    """Messages of the wanted type with their text; malformed ones are ignored.

    Works on tables and on streams alike.
    """
    shape = f"type string, `{field}` string, _bad string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return (
        df.withColumn("_m", F.from_json(text, shape, options))
        .where(F.col("_m._bad").isNull() & (F.col("_m.type") == wanted))
        .withColumn(field, F.coalesce(F.col(f"_m.{field}"), F.lit("")))
        .drop("_m")
    )
