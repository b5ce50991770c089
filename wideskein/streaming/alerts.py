"""Alerts of a running stream of statuses, with the last status of every key as its state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

FAILED, RESOLVED = "FAILURE", "RESOLVED"


def alert_stream(statuses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, timestamp, status and known (the status before) of each status that alerts, as a stream.

    What alerts is a FAILURE where the key's status before is another or none, and a RESOLVED after a FAILURE: every such
    step, those within a batch too. Statuses count in order of (timestamp, status); one that comes when a later one of
    its key is known changes nothing, so neither late rows nor repeated ones overwrite a newer status. The state is one (time,
    status) a key, kept with the checkpoint: a batch that is done again starts from the state before it and gives the same rows.

    Rows without a timestamp or status are passed over; a null key is a key. What a task holds of a key is its times and
    statuses of one batch, which the source's trigger bounds.
    """
    fields = [statuses.schema[k] for k in keys]
    narrow = statuses.where("timestamp is not null and status is not null").select(*keys, F.unix_micros(F.col("timestamp").cast("timestamp")).alias("seen"), "status")
    out = StructType([*fields, StructField("seen", LongType()), StructField("status", StringType()), StructField("known", StringType())])
    kept = StructType([StructField("seen", LongType()), StructField("status", StringType())])
    names = out.fieldNames()

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = tuple(state.get) if state.exists else None
        seen, status = (np.concatenate(c) for c in zip(*((f["seen"].to_numpy(), f["status"].to_numpy()) for f in frames), strict=True))
        kinds, kind = np.unique(status, return_inverse=True)
        order = np.lexsort((kind, seen))
        seen, kind = seen[order], kind[order]
        new = np.append(True, (seen[1:] != seen[:-1]) | (kind[1:] != kind[:-1]))
        if last:
            new &= (seen > last[0]) | ((seen == last[0]) & (kinds > last[1])[kind])
        if not new.any():
            return
        seen, status = seen[new], kinds[kind[new]]
        known = np.append(np.array([last[1] if last else None], dtype=object), status[:-1])
        state.update((int(seen[-1]), str(status[-1])))
        alerts = np.flatnonzero(((status == FAILED) & (known != FAILED)) | ((status == RESOLVED) & (known == FAILED)))
        if len(alerts):
            own = {k: pd.Series([v] * len(alerts), dtype=None if v is not None else object) for k, v in zip(keys, key, strict=True)}
            yield pd.DataFrame({**own, "seen": seen[alerts], "status": status[alerts], "known": known[alerts]})[names]

    found = narrow.groupBy(*keys).applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.NoTimeout)
    return found.select(*keys, F.timestamp_micros("seen").alias("timestamp"), "status", "known")
