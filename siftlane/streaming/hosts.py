"""State by host in a stream: a token bucket that paces requests, and forgets hosts that have been quiet.

A host's bucket holds ``burst`` requests at most and gets one back in each ``interval``. A request that finds one goes, another waits, with
the time at which it could have gone. Times are counted in whole milliseconds of the events' own time, so a replay gives the same rows. A host's state is
two numbers; a timer drops it once the watermark has passed ``keep`` after its last request. A bucket that has been quiet for so long is full
again (``keep`` must be long enough for that), so forgetting changes no verdict.

Hosts are dealt to ``groups`` by a hash, and a group's buckets are one state with one timer: a batch costs a few calls for each group and a step for
each request, whatever the number of hosts. Millions of hosts want more groups, as a group's state is read and written whole.

Requests that come later than the watermark are left out by Spark. Within a batch a host's requests are taken in the order of their
times (of equal ones by id), across batches as they come; one that is older than the last of its host gets no tokens for the time between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

VERDICTS = "host string, id long, at timestamp, verdict string, left_ms long, free_at timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def spent(left: int, last: int | None, now: int, interval: int, burst: int) -> tuple[bool, int, int]:
    """Whether a request may go, and the bucket behind it: milliseconds of refill left, and the time they count from."""
    full = interval * burst
    left = full if last is None else min(full, left + max(0, now - last))
    goes = left >= interval
    return goes, left - interval if goes else left, now if last is None else max(now, last)


class Pacer(StatefulProcessor):
    """The buckets of a group of hosts, with a timer for the one that has been quiet longest."""

    def __init__(self, interval: int, burst: int, keep: int):
        self.interval, self.burst, self.keep = interval, burst, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getValueState("buckets", "hosts array<string>, lefts array<long>, lasts array<long>, due long")

    def held(self) -> tuple[dict[str, tuple[int, int]], int | None]:
        """Each host's bucket, and when the group's timer goes off."""
        if not self.buckets.exists():
            return {}, None
        hosts, lefts, lasts, due = self.buckets.get()
        return dict(zip(hosts, zip(lefts, lasts))), due

    def hold(self, own: dict[str, tuple[int, int]], due: int | None, watermark: int) -> None:
        """Keep the buckets of hosts that haven't been quiet for too long, and set the timer."""
        own = {h: x for h, x in own.items() if x[1] + self.keep > watermark}
        if not own:
            if due is not None and due > watermark:
                self.handle.deleteTimer(due)
            self.buckets.clear()
            return
        lefts, lasts = map(list, zip(*own.values()))
        now = min(lasts) + self.keep
        if now != due:
            if due is not None and due > watermark:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(now)
        self.buckets.update((list(own), lefts, lasts, now))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        own, due = self.held()
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["ms", "id"], kind="stable")
        verdicts, lefts, waits = [], [], []
        for host, ms in zip(frame["host"].tolist(), frame["ms"].tolist()):
            left, last = own.get(host, (0, None))
            goes, left, last = spent(left, last, ms, self.interval, self.burst)
            own[host] = left, last
            verdicts.append("go" if goes else "wait")
            lefts.append(left)
            waits.append(0 if goes else self.interval - left)
        self.hold(own, due, timerValues.getCurrentWatermarkInMs())
        free = frame["at"] + pd.to_timedelta(np.asarray(waits, np.int64), unit="ms")
        yield pd.DataFrame({"host": frame["host"], "id": frame["id"], "at": frame["at"], "verdict": verdicts, "left_ms": lefts, "free_at": free})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        own, due = self.held()
        self.hold(own, due, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame([], columns=[c.split(" ")[0] for c in VERDICTS.split(", ")])

    def close(self) -> None:
        pass


def paced(requests: DataFrame, *, host: str = "host", ident: str = "id", at: str = "ts", interval_s: int = 1, burst: int = 1, keep_s: int = 3600, late: str = "10 minutes", groups: int = 256) -> DataFrame:
    """(host, id, at, verdict, left_ms, free_at) of a stream's requests. Requests without a host or a time are left out. The session's state store must be
    the one that keeps more than one kind of state (``state_store``)."""
    if keep_s < interval_s * burst:
        raise ValueError("keep_s must be long enough for a bucket to be full again")
    own = requests.where(F.col(host).isNotNull() & F.col(at).isNotNull()).select(F.col(host).cast("string").alias("host"), F.col(ident).cast("long").alias("id"), F.col(at).cast("timestamp").alias("at"))
    own = own.withWatermark("at", late).withColumns({"ms": F.unix_millis("at"), "group": F.pmod(F.xxhash64("host"), F.lit(groups))})
    return own.groupBy("group").transformWithStateInPandas(Pacer(1000 * interval_s, burst, 1000 * keep_s), VERDICTS, "append", "eventTime")


def state_store(spark: SparkSession) -> None:
    """The state store that the pacer needs, for streams that are started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
