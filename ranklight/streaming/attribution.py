"""Live attribution of feedback to the latest prediction, with state per user and event-time timers.

Per user the state holds the latest prediction that the watermark has passed, and the rows after it
that may still be overtaken by late ones. A timer drops them when the watermark passes, so a
user's state is one prediction and the rows of the lateness, whatever the length of the log.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ranklight.streaming.live import LATENESS

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "user_id {user}, _row string, variant {variant}, _predicted_at long"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}

#: A waiting row: its time, the feedback as JSON (null for a prediction), the variant of a
#: prediction, and what was last said about a feedback row (null: nothing yet).
_Waiting = tuple[int, str | None, str | None, int | None, str | None]


class _Attribution(StatefulProcessor):
    def __init__(self, corrections: bool):
        self.corrections = corrections

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.passed = handle.getValueState("passed", "at long, variant string")
        self.waiting = handle.getListState(
            "waiting", "at long, row string, variant string, said_at long, said_variant string"
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new: list[_Waiting] = []
        for batch in rows:
            for at, row, variant in zip(batch["micros"], batch["given"], batch["shown"]):
                texts = (None if pd.isna(t) else t for t in (row, variant))
                new.append((int(at), *texts, None, None))
        # One timer for each batch; it takes all rows up to the latest of the batch.
        self.handle.registerTimer(max(r[0] for r in new) // 1000 + 1)
        said, _, kept = self._settled([*self._held(), *new], None)
        self.waiting.put(kept)
        if self.corrections and said:
            yield self._frame(key, said)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        said, passed, kept = self._settled(self._held(), limit)
        if passed is not None:
            self.passed.update(passed)
        if kept:
            self.waiting.put(kept)
        else:
            self.waiting.clear()
        if said:
            yield self._frame(key, said)

    def _held(self) -> list[_Waiting]:
        return [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []

    def _settled(self, rows: list[_Waiting], limit: int | None):
        """What to say, the last prediction up to ``limit``, and the rows that still wait.

        Without corrections only rows up to the limit are said; with them, rows whose
        answer is new or has changed.
        """
        passed = tuple(self.passed.get()) if self.passed.exists() else None
        newest, said, kept = passed, [], []
        # Of one moment, predictions come first and the largest variant is taken.
        for at, row, variant, *before in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[2] or "", r[1] or "")):
            final = limit is not None and at <= limit
            if row is None:
                newest = (at, variant)
                passed = newest if final else passed
                answer = before
            else:
                answer = list(newest) if newest else [-1, None]
                if (answer != before) if self.corrections else final:
                    said.append((row, answer[1], None if answer[0] == -1 else answer[0]))
            if not final:
                kept.append((at, row, variant, *answer))
        return said, passed, kept

    @staticmethod
    def _frame(key, said: list[tuple[str, str | None, int | None]]) -> pd.DataFrame:
        rows, variants, times = zip(*said)
        return pd.DataFrame(
            {
                "user_id": [key[0]] * len(said),
                "_row": rows,
                "variant": variants,
                "_predicted_at": pd.array(times, dtype="Int64"),
            }
        )

    def close(self) -> None:
        pass


def stream_attribute_feedback(
    predictions: DataFrame, feedback: DataFrame, lateness: str = LATENESS, corrections: bool = True
) -> DataFrame:
    """Every feedback row with ``variant`` and ``predicted_at`` of the user's latest prediction.

    The live form of the batch attribution: no prediction gives nulls, and any earlier one counts. With
    ``corrections`` a row is said when it comes and again when a late prediction changes it
    (write in update mode, read the latest row of a key); without, once, when the watermark
    passes it (append mode). Rows later than ``lateness`` and rows without a time are left out. Needs the state store on
    disk, which is set here.
    """
    spark = feedback.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    columns = feedback.columns
    user = feedback.schema["user_id"].dataType.simpleString()

    def side(rows: DataFrame, row, variant) -> DataFrame:
        timed = rows.filter(F.col("timestamp").isNotNull())
        return timed.select("user_id", F.col("timestamp").alias("event_time"), F.unix_micros("timestamp").alias("micros"), row, variant)

    nothing = F.lit(None).cast("string")
    shown = side(predictions, nothing.alias("given"), F.col("variant").alias("shown"))
    given = side(feedback, F.to_json(F.struct(*columns), _JSON).alias("given"), nothing.alias("shown"))
    events = shown.unionByName(given).withWatermark("event_time", lateness)
    found = events.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=_Attribution(corrections),
        outputStructType=_OUT.format(user=user, variant="string"),
        outputMode="Update" if corrections else "Append",
        timeMode="EventTime",
    )
    parsed = found.select(
        F.from_json("_row", feedback.schema, _JSON).alias("_given"),
        "variant",
        F.timestamp_micros("_predicted_at").alias("predicted_at"),
    )
    return parsed.select(*[F.col(f"_given.{c}").alias(c) for c in columns], "variant", "predicted_at")
