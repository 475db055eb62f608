"""Stream-static application of fitted statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run apply steps in order; works for batch and streaming frames alike."""
    for step in steps:
        df = step(df)
    return df


def score_stream(stream: DataFrame, steps: Sequence[Step], sink_path: str, checkpoint: str,
                 trigger_once: bool = True):
    """Write the transformed stream to parquet.  ``checkpoint`` must be on shared storage
    (the streaming query's offsets and commits live there, so a restarted driver resumes)."""
    out = apply_steps(stream, steps)
    w = out.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
