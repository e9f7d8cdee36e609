"""Epoch reports while training runs: a stream of metric events with the losses of each run as state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from examloom.operators.metrics import epoch_report_text

HELD_LOSSES = 100  # latest places of a run whose loss is kept
RUN_GROUPS = 1024  # of runs that one call handles together


def _reporter(names: list[str], held_losses: int):
    """State function of one group of runs: `names` are the run's column and the two columns of its order."""
    run, first, second = names

    def numbers(held: bytes, more, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(held, kind), more.to_numpy(kind)])

    def report(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs, counts, *held = state.get if state.exists else ([], [], b"", b"", b"")
        events = pd.concat(list(frames), ignore_index=True)
        new, names_of_new = pd.factorize(events[run], use_na_sentinel=False)
        place = {name: i for i, name in enumerate(runs)}
        names_of_new = [None if pd.isna(name) else name for name in names_of_new]
        code = np.array([place.setdefault(name, len(place)) for name in names_of_new], np.int64)[new]
        # Losses by run and place; of several at one place the largest.
        logged = events["loss"].notna().to_numpy()
        of = np.concatenate([np.repeat(np.arange(len(runs)), counts).astype(np.int64), code[logged]])
        a, b = (numbers(h, events.loc[logged, c], np.int64) for h, c in zip(held, (first, second)))
        loss = numbers(held[2], events.loc[logged, "loss"], np.float64)
        by = np.lexsort((loss, b, a, of))
        of, a, b, loss = of[by], a[by], b[by], loss[by]
        top = np.ones(len(of), bool)
        top[:-1] = (of[1:] != of[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        of, a, b, loss = of[top], a[top], b[top], loss[top]
        asked = events["event"].eq("evaluate").to_numpy()
        if asked.any():
            # The loss at the latest place that is not behind the evaluation's.
            rows, who, n = events[asked], code[asked], len(of)
            order = np.lexsort((np.arange(n + len(rows)) >= n, np.concatenate([b, rows[second].to_numpy(np.int64)]),
                                np.concatenate([a, rows[first].to_numpy(np.int64)]), np.concatenate([of, who])))
            latest = np.empty(len(order), np.int64)
            latest[order] = np.maximum.accumulate(np.where(order < n, order, -1))
            at = latest[n:]
            found = (at >= 0) & (np.append(of, -1)[at] == who)
            yield pd.DataFrame({
                run: rows[run], first: rows[first], second: rows[second], "epoch": rows["epoch_text"],
                "training_loss": np.where(found, np.append(loss, np.nan)[at], np.nan),
                "validation_loss": rows["eval_loss"], "accuracy": rows["eval_accuracy"]})
        counts = np.bincount(of, minlength=len(place))
        kept = np.arange(len(of)) >= (np.cumsum(counts) - held_losses)[of]
        state.update((list(place), np.minimum(counts, held_losses).tolist(),
                      a[kept].tobytes(), b[kept].tobytes(), loss[kept].tobytes()))

    return report


def stream_epoch_report(events: DataFrame, run: str = "run", order: tuple[str, str] = ("ts", "step"),
                        held_losses: int = HELD_LOSSES, groups: int = RUN_GROUPS) -> DataFrame:
    """One row per evaluation of a streaming log: run, the order, epoch, training_loss, validation_loss, accuracy.

    `events` has the columns of METRIC_LOG; `order` names a timestamp and a long, which together
    give an event's place in its run.  An evaluation is reported in the batch that
    brings it, with the loss logged last up to its place: whichever batch brought that, so the rows are those
    of `epoch_report` as long as no loss comes after an evaluation it stands before.  A late loss does not
    change rows that are out; it takes its place among the run's losses and counts for evaluations
    that come later.  Of several losses at one place the largest counts.  The state
    of a run is its losses at the latest `held_losses` places, a late evaluation before all
    of them has no training loss.  Only evaluations and losses reach the state; a run's events of one
    batch are handled together, so bound a batch by the source's options.
    """
    logged = F.when(F.col("event") == "log", F.col("loss"))
    nowhere = F.lit(-2**63)  # a missing place is before all others
    micros = F.unix_micros(F.col(order[0]).cast("timestamp"))
    rows = events.select(
        F.pmod(F.xxhash64(F.col(run).cast("string")), F.lit(groups)).alias("_group"), F.col(run).cast("string").alias(run),
        F.coalesce(micros, nowhere).alias(order[0]), F.coalesce(F.col(order[1]).cast("long"), nowhere).alias(order[1]),
        "event", F.coalesce(F.col("epoch").cast("int").cast("string"), F.lit("N/A")).alias("epoch_text"),
        logged.cast("double").alias("loss"), F.col("eval_loss").cast("double").alias("eval_loss"),
        F.col("eval_accuracy").cast("double").alias("eval_accuracy"),
    ).filter((F.col("event") == "evaluate") | F.col("loss").isNotNull())
    a, b = order
    out = rows.groupBy("_group").applyInPandasWithState(
        _reporter([run, a, b], held_losses),
        f"`{run}` string, `{a}` long, `{b}` long, epoch string, training_loss double, validation_loss double, accuracy double",
        "runs array<string>, counts array<bigint>, places binary, numbers binary, losses binary",
        "append", GroupStateTimeout.NoTimeout)
    return out.withColumn(a, F.timestamp_micros(F.nullif(a, nowhere))).withColumn(b, F.nullif(b, nowhere))


def append_epoch_reports(report: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start writing one text block per evaluation below `path` as evaluations come.

    A query started again with the same `checkpoint` goes on where the last one stopped;
    the file sink writes each batch once.  `trigger` as in `DataStreamWriter.trigger`.
    """
    writer = epoch_report_text(report).select("value").writeStream.format("text").outputMode("append") \
        .option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start(path)
