"""Sinks, reports, the streaming form of the publish log."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.plans import daily
from ledgerloom.plans.catalogue import publish_events
from ledgerloom.session import scratch_dir, shared_dir
from ledgerloom.sinks import snapshots, writers
from ledgerloom.sources import scan_documents, scan_table
from ledgerloom.streaming.feeds import append_available, publish_event_stream

SCHEMA = "sessions long, dates date"
TODAY = date(2024, 1, 3)


def history(spark):
    return spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], SCHEMA)


def stored(spark, target, bag):
    return bag(sinks.read_table(spark, target).select("sessions", "dates"))


def test_date_slice_into_empty_target_and_again(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    today = spark.createDataFrame([(5,), (6,)], "sessions long")
    for _ in range(2):
        sinks.write_date_slice(today, target, "dates", TODAY)
        assert stored(spark, target, bag) == [(5, TODAY), (6, TODAY)]


def test_date_slice_keeps_other_days_and_clears_its_own(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    sinks.replace_dates(history(spark), target, "dates")
    today = spark.createDataFrame([(5,)], "sessions long")
    sinks.write_date_slice(today, target, "dates", TODAY)
    expected = [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (5, TODAY)]
    assert stored(spark, target, bag) == expected
    assert bag(daily.with_slice_replaced(history(spark), today, "dates", TODAY)) == expected
    sinks.write_date_slice(today.where("sessions > 9"), target, "dates", TODAY)
    assert stored(spark, target, bag) == expected[:2]


def test_replace_dates_touches_only_its_dates(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    sinks.replace_dates(history(spark), target, "dates")
    sinks.replace_dates(spark.createDataFrame([(9, date(2024, 1, 2))], SCHEMA), target, "dates")
    assert stored(spark, target, bag) == [(1, date(2024, 1, 1)), (9, date(2024, 1, 2))]


def test_full_refresh_append_and_fan_out(spark, tmp_path, bag):
    one, two, three = (str(tmp_path / n) for n in "abc")
    df = spark.range(3)
    sinks.write_full_refresh(spark.range(100), one)
    sinks.write_full_refresh(df, one)
    sinks.write_append(df, one)
    assert bag(sinks.read_table(spark, one)) == [(0,), (0,), (1,), (1,), (2,), (2,)]
    sinks.write_fan_out(spark, df.withColumn("r", F.rand()), [two, three])
    assert bag(sinks.read_table(spark, two)) == bag(sinks.read_table(spark, three))


def test_copy_changes_format(spark, tmp_path, bag):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    sinks.write_folder(spark.range(3).withColumn("x", F.lit("é")), source)
    sinks.copy_table(spark, source, target, "parquet", "json", ["x"])
    assert bag(sinks.read_table(spark, target)) == [("é",)] * 3


@pytest.mark.parametrize("append, mode", [(False, "overwrite"), (True, "append")])
def test_database_writer_settings(append, mode):
    """No database may be started here; only the writer calls are checked."""
    df = MagicMock()
    sinks.write_jdbc(df, "jdbc:x", "t", append=append, user="u")
    df.write.format.assert_called_with("jdbc")
    df.write.format().mode.assert_called_with(mode)
    options = df.write.format().mode().options.call_args.kwargs
    assert options["dbtable"] == "t" and options["truncate"] == "true" and options["user"] == "u"


def test_report_is_one_ordered_text(spark, tmp_path):
    target = tmp_path / "r"
    df = spark.range(200).repartition(7).withColumn("x", F.lit('a,"b"'))
    sinks.write_report(df, ["№", "Имя"], str(target), ["id"])
    parts = sorted(p for p in target.iterdir() if p.name.startswith("part-"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines == ["№,Имя"] + [f'{i},"a,""b"""' for i in range(200)]
    with pytest.raises(ValueError):
        sinks.with_headers(spark.range(1), ["a", "b"])


def bad(spark):
    return spark.range(3).select(F.raise_error(F.lit("no good")).cast("long").alias("id"))


def test_failed_refresh_keeps_the_old_target(spark, tmp_path, bag):
    target = tmp_path / "t"
    sinks.write_full_refresh(spark.range(3), str(target))
    reader = sinks.read_table(spark, str(target))
    with pytest.raises(Exception, match="no good"):
        sinks.write_full_refresh(bad(spark), str(target))
    assert bag(sinks.read_table(spark, str(target))) == bag(reader) == [(0,), (1,), (2,)]
    assert len(list((target / "data").iterdir())) == 1


def test_failed_folder_keeps_the_old_one(spark, tmp_path, bag):
    target = tmp_path / "t"
    sinks.write_folder(spark.range(3), str(target))
    with pytest.raises(Exception, match="no good"):
        sinks.write_folder(bad(spark), str(target))
    assert bag(spark.read.parquet(str(target))) == [(0,), (1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("failing", [1, 2])
def test_failed_rename_puts_the_old_folder_back(spark, tmp_path, bag, monkeypatch, failing):
    target = tmp_path / "t"
    sinks.write_folder(spark.range(3), str(target))
    calls = []

    def rename(files, source, to):
        calls.append(to)
        if len(calls) == failing:
            raise OSError("no rename")
        assert files.rename(source, to)

    monkeypatch.setattr(writers, "_rename", rename)
    with pytest.raises(OSError):
        sinks.write_folder(spark.range(9), str(target))
    assert bag(spark.read.parquet(str(target))) == [(0,), (1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_reader_keeps_its_version(spark, tmp_path, bag):
    """A DataFrame made before a refresh shows the rows of that time, after the refresh too."""
    target = str(tmp_path / "t")
    assert sinks.write_full_refresh(spark.range(3), target) == 1
    before = sinks.read_table(spark, target)
    assert sinks.write_full_refresh(spark.range(5), target) == 2
    assert bag(before) == bag(sinks.read_table(spark, target, version=1)) == [(0,), (1,), (2,)]
    assert sinks.read_table(spark, target).count() == 5
    assert sinks.versions(spark, target) == [1, 2]


STEPS = ["store", "write", "publish"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("change", ["refresh", "slice", "append"])
def test_failure_at_each_step_leaves_the_table(spark, tmp_path, bag, monkeypatch, step, change):
    target = str(tmp_path / "t")
    sinks.replace_dates(history(spark), target, "dates")
    before = stored(spark, target, bag)
    folders = sorted(p.name for p in (tmp_path / "t/data").iterdir())

    def fails(*a, **b):
        raise OSError(f"no {step}")

    monkeypatch.setattr(snapshots if step == "store" else snapshots._Files, step, fails)
    rows = spark.createDataFrame([(7, date(2024, 1, 2))], SCHEMA)
    with pytest.raises(OSError):
        if change == "refresh":
            sinks.write_full_refresh(rows, target)
        elif change == "slice":
            sinks.write_date_slice(rows, target, "dates", date(2024, 1, 2))
        else:
            sinks.write_append(rows, target, batch="b")
    monkeypatch.undo()
    assert stored(spark, target, bag) == before
    assert sorted(p.name for p in (tmp_path / "t/data").iterdir()) == folders
    assert sinks.versions(spark, target) == [1]
    assert not [p for p in (tmp_path / "t/log").iterdir() if "draft" in p.name]


def test_writers_of_two_days_at_once_both_stand(spark, tmp_path, bag, monkeypatch):
    """The second writer publishes between the first one's look at the log and its own publication."""
    target = str(tmp_path / "t")
    sinks.replace_dates(history(spark), target, "dates")
    publish, raced = snapshots._Files.publish, []

    def late(files, inner, under):
        if not raced:
            raced.append(under)
            sinks.write_date_slice(spark.createDataFrame([(8,)], "sessions long"), target, "dates", date(2024, 1, 2))
        return publish(files, inner, under)

    monkeypatch.setattr(snapshots._Files, "publish", late)
    sinks.write_date_slice(spark.createDataFrame([(9,)], "sessions long"), target, "dates", date(2024, 1, 1))
    assert stored(spark, target, bag) == [(8, date(2024, 1, 2)), (9, date(2024, 1, 1))]
    assert sinks.versions(spark, target) == [1, 2, 3]


def test_many_writers_lose_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        for _ in pool.map(lambda i: sinks.write_append(spark.createDataFrame([(i,)], "id long"), target, batch=f"b{i % 9}"), range(12)):
            pass
    assert sorted(r.id % 9 for r in sinks.read_table(spark, target).collect()) == list(range(9))


def test_every_attempt_lost_is_a_conflict(spark, tmp_path, bag, monkeypatch):
    target = str(tmp_path / "t")
    sinks.write_full_refresh(spark.range(3), target)
    monkeypatch.setattr(snapshots._Files, "publish", lambda *a: False)
    monkeypatch.setattr(snapshots.time, "sleep", lambda s: None)
    with pytest.raises(snapshots.Conflict):
        sinks.write_full_refresh(spark.range(4), target)
    assert bag(sinks.read_table(spark, target)) == [(0,), (1,), (2,)]


def test_a_number_is_taken_once(spark, tmp_path):
    files = snapshots._Files(spark, str(tmp_path))
    files.write("log/a", "one")
    files.write("log/b", "two")
    assert files.publish("log/a", "log/1") and not files.publish("log/b", "log/1")
    assert files.read("log/1") == "one"


def test_a_batch_counts_once_and_columns_must_agree(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    for _ in range(3):
        sinks.write_append(spark.range(2), target, batch="a")
    sinks.write_append(spark.range(1), target, batch="b")
    sinks.write_append(spark.range(1), target)
    assert bag(sinks.read_table(spark, target)) == [(0,), (0,), (0,), (1,)]
    with pytest.raises(ValueError, match="columns"):
        sinks.write_append(spark.range(1).withColumn("x", F.lit(1)), target)
    assert sinks.read_table(spark, target).count() == 4


def test_fan_out_that_fails_changes_no_target(spark, tmp_path, bag, monkeypatch):
    targets = [str(tmp_path / n) for n in "abc"]
    for target in targets:
        sinks.write_full_refresh(spark.range(3), target)
    store, calls = snapshots.store, []

    def third_fails(*a, **b):
        calls.append(a)
        if len(calls) == 3:
            raise OSError("no store")
        return store(*a, **b)

    monkeypatch.setattr(snapshots, "store", third_fails)
    with pytest.raises(OSError):
        sinks.write_fan_out(spark, spark.range(9), targets)
    for target in targets:
        assert bag(sinks.read_table(spark, target)) == [(0,), (1,), (2,)]
    assert all(len(list((tmp_path / n / "data").iterdir())) == 1 for n in "abc")


def test_old_versions_expire(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    sinks.replace_dates(history(spark), target, "dates")
    for n in range(4):
        sinks.write_date_slice(spark.createDataFrame([(n,)], "sessions long"), target, "dates", date(2024, 1, 2))
    now = stored(spark, target, bag)
    assert sinks.expire(spark, target, keep=2) == [] and sinks.versions(spark, target) == [1, 2, 3, 4, 5]
    assert sinks.expire(spark, target, keep=2, grace_seconds=0) == [1, 2, 3]
    assert stored(spark, target, bag) == now
    assert bag(sinks.read_table(spark, target, version=4).select("sessions")) == [(1,), (2,)]
    # The first write's folder lost the day that was replaced, and kept the other.
    assert sum("dates=" in p.name for f in (tmp_path / "t/data").iterdir() for p in f.iterdir()) == 3


def test_slices_with_odd_names_and_pruning(spark, tmp_path, bag):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([("a/b c=1", 1), ("é%", 2), (None, 3)], "k string, v int")
    sinks.replace_dates(df, target, "k")
    sinks.replace_dates(spark.createDataFrame([("a/b c=1", 9)], "k string, v int"), target, "k")
    assert bag(sinks.read_table(spark, target)) == sorted([("a/b c=1", 9), ("é%", 2), (None, 3)], key=repr)
    assert bag(sinks.read_table(spark, target, slices=["é%"])) == [("é%", 2)]
    with pytest.raises(ValueError, match="not sliced"):
        sinks.write_date_slice(df.select("v"), target, "day", TODAY)


def test_copy_between_databases_settings():
    """No database may be started here; only the reader and writer calls are checked."""
    spark = MagicMock()
    sinks.copy_table(
        spark, None, None, "jdbc", "jdbc", ["a"], {"url": "jdbc:one", "dbtable": "s"}, {"url": "jdbc:two", "dbtable": "t"}
    )
    spark.read.format.assert_called_with("jdbc")
    spark.read.format().options.assert_called_with(url="jdbc:one", dbtable="s")
    df = spark.read.format().options().load().select()
    df.write.format().mode().options.assert_called_with(truncate="true", url="jdbc:two", dbtable="t")


def test_alert_text(spark):
    df = spark.createDataFrame([("o", None)], "a string, b int")
    alert = sinks.alert_rows(df, {"order": "a", "months": "b"}).first()
    assert alert["message"] == "order: o, months: none"


def test_documents_over_many_folders(spark, tmp_path, rows):
    for name in ("idx_a", "idx_b", "other"):
        sinks.write_folder(spark.sql(f"SELECT '{name}' AS _id"), str(tmp_path / name), "json")
    found = scan_documents(spark, str(tmp_path / "idx_*"), "_id string, gone string", origin="file")
    got = sorted((r["_id"], r["gone"], f"/{r['_id']}/" in r["file"]) for r in found.collect())
    assert got == [("idx_a", None, True), ("idx_b", None, True)]


def test_whole_table_scan(spark):
    assert len(scan_table(spark, "/root/testdata/sf0.001", "nation").columns) == 3


class Configured:
    """A session whose configuration names a shared folder."""

    def __init__(self, spark, folder):
        self.sparkContext = spark.sparkContext
        self.conf = {"spark.checkpoint.dir": folder}


def test_scratch_lies_in_the_configured_folder(spark):
    session = Configured(spark, "hdfs://shared/folder/")
    assert shared_dir(session) == "hdfs://shared/folder"
    assert scratch_dir(session, "x").startswith("hdfs://shared/folder/x-")
    assert scratch_dir(session, "x") != scratch_dir(session, "x")


def test_scratch_needs_the_setting_on_a_cluster():
    for master in ("spark://host:1", "local-cluster[2,1,1024]", "yarn"):
        session = MagicMock()
        session.sparkContext.master = master
        session.conf.get.return_value = None
        session.sparkContext.getCheckpointDir.return_value = None
        with pytest.raises(ValueError):
            shared_dir(session)


def test_publish_stream_reads_each_file_once(spark, tmp_path, bag):
    landed, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "event_dtime timestamp_ntz, merchant_id string, enabled_products string, disabled_products string"
    first = spark.createDataFrame([(datetime(2024, 1, 1), "m", '{a,"",b}', None)], schema)
    second = spark.createDataFrame([(datetime(2024, 1, 2), "m", None, "{c}")], schema)
    for part in (first, second):
        part.write.mode("append").parquet(landed)
        stream = publish_event_stream(spark, landed)
        append_available(stream, target, checkpoint).awaitTermination(60)
    assert bag(spark.read.parquet(target)) == bag(publish_events(first.unionByName(second)))
