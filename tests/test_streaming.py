"""Epoch reports from a stream: batch by batch, over restarts, with late events."""

import random
from datetime import datetime, timedelta

from examloom.operators.metrics import epoch_report, epoch_report_text
from examloom.streaming.reports import append_epoch_reports, stream_epoch_report

LOG = ("run string, ts timestamp, step long, event string, epoch double, loss double, eval_loss double, "
       "eval_accuracy double")
START = datetime(2024, 1, 1)


def log(run, minute, step, loss):
    return (run, START + timedelta(minutes=minute), step, "log", None, loss, None, None)


def evaluation(run, minute, step, epoch=1.0):
    return (run, START + timedelta(minutes=minute), step, "evaluate", epoch, None, .5, .25)


class Feed:
    """A folder of files that a query reads one batch at a time, started anew for each."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        (folder / "in").mkdir()

    def take(self, *pieces):
        for rows in pieces:
            self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(self.folder / "in"))
        events = self.spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(self.folder / "in"))
        report = stream_epoch_report(events, **self.options)
        report.writeStream.format("parquet").option("checkpointLocation", str(self.folder / "state")).trigger(
            availableNow=True).start(str(self.folder / "out")).awaitTermination()
        return self.spark.read.parquet(str(self.folder / "out"))


def losses(df):
    return {(r["run"], r["step"]): r["training_loss"] for r in df.collect()}


def test_equal_to_the_batch_report(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        run = rng.choice(["a", "b", "c", None])
        minute = i // 3  # several events share a place
        rows.append(evaluation(run, minute, minute, rng.choice([None, 1.7])) if rng.random() < .3 else
                    log(run, minute, minute, rng.choice([None, float(i)])))
    cuts = [0, 60, 120, 210, 300]
    pieces = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    feed = Feed(spark, tmp_path)
    feed.take(pieces[0], pieces[1])
    feed.take(pieces[2])
    out = feed.take(pieces[3])
    expected = epoch_report(spark.createDataFrame(rows, LOG), order=("ts", "step"))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, expected.select(out.columns).collect()))
    assert out.count() == sum(r[3] == "evaluate" for r in rows)


def test_late_events(spark, tmp_path):
    feed = Feed(spark, tmp_path, held_losses=3)
    out = feed.take([log("a", 1, 1, 1.0), evaluation("a", 5, 5)])
    assert losses(out) == {("a", 5): 1.0}
    # A late loss leaves the row as it is and counts for what comes later.
    out = feed.take([log("a", 3, 3, 3.0), evaluation("a", 6, 6)])
    assert losses(out) == {("a", 5): 1.0, ("a", 6): 3.0}
    # An older one does not replace a newer one; a late evaluation takes the loss of its place.
    out = feed.take([log("a", 2, 2, 2.0), evaluation("a", 7, 7), evaluation("a", 2, 20)])
    assert losses(out) == {("a", 5): 1.0, ("a", 6): 3.0, ("a", 7): 3.0, ("a", 20): 2.0}
    # Places behind the last three are forgotten.
    out = feed.take([log("a", 8, 8, 8.0), log("a", 9, 9, 9.0)], [evaluation("a", 1, 30)])
    assert losses(out)[("a", 30)] is None


def test_evaluation_before_any_loss(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert losses(feed.take([evaluation("a", 1, 1)])) == {("a", 1): None}
    assert losses(feed.take([log("a", 0, 0, 4.0)], [evaluation("a", 2, 2)])) == {("a", 1): None, ("a", 2): 4.0}


def test_text_blocks_are_appended_once(spark, tmp_path):
    source = tmp_path / "in"
    rows = [[log("a", 1, 1, 1.0), evaluation("a", 2, 2)], [evaluation("a", 3, 3)]]
    for piece in rows:
        spark.createDataFrame(piece, LOG).coalesce(1).write.mode("append").parquet(str(source))
        report = stream_epoch_report(spark.readStream.schema(LOG).parquet(str(source)))
        append_epoch_reports(report, str(tmp_path / "out"), str(tmp_path / "state"), availableNow=True).awaitTermination()
    expected = epoch_report_text(epoch_report(spark.createDataFrame(sum(rows, []), LOG), order=("ts", "step")))
    read = spark.read.option("lineSep", "#" * 25 + "\n").text(str(tmp_path / "out"))
    assert sorted(r["value"] for r in read.collect()) == sorted(
        r["value"].removesuffix("#" * 25) for r in expected.collect())


def test_many_runs_in_one_call(spark, tmp_path):
    """Runs are handled in groups: no call of Python code for each of them, and each with its own losses."""
    pieces = [[row for i in range(60) for row in (log(f"r{i}", m, m, float(100 * i + m)), evaluation(f"r{i}", m, m + 1))]
              for m in (1, 2)]
    pieces.append([evaluation(f"r{i}", 3, 3) for i in range(61)])
    out = Feed(spark, tmp_path, groups=2, held_losses=1).take(*pieces)
    expected = {(f"r{i}", m + 1): float(100 * i + m) for i in range(60) for m in (1, 2)}
    rows = sorted((r["run"], r["step"], r["training_loss"] or -1.0) for r in out.collect())
    assert rows == sorted([(*k, v) for k, v in expected.items()]
                          + [(f"r{i}", 3, 100. * i + 2) for i in range(60)] + [("r60", 3, -1.0)])
