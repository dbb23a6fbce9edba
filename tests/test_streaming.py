from __future__ import annotations

import json
import os
import uuid

import pytest

from faultline.functions.timeparts import flatten_window
from faultline.operators.risk import alerts_of_sums, risk_alerts
from faultline.plans.inputs import event_readings
from faultline.plans.queries import comparable
from faultline.columns import STREAM_COLUMNS
from faultline.sources.readers import read_stream
from faultline.streaming import alerts, messages, repair, upserts
from helpers import collect, readings


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_encode_then_parse_is_the_identity(spark):
    df = readings(spark, [(0, "a", True, 1.25, 1.04), (61, "a", False, 0.0, None), (62, "a", None, None, 1.0)])
    back = messages.parse_messages(messages.encode_messages(df))
    assert comparable(back.select("event_time", "secousse", "magnitude", "tension_entre_plaque")).collect() == (
        df.select(df.date.alias("event_time"), "secousse", "magnitude", "tension_entre_plaque").collect()
    )


def test_bytes_are_read_like_text(spark):
    text = '{"timestamp": "2024-01-01 13:44:00", "secousse": false, "magnitude": 0.0, "tension_entre_plaque": 1.04}'
    as_bytes = texts(spark, text).selectExpr("CAST(value AS BINARY) AS value")
    assert collect(messages.parse_messages(as_bytes)) == collect(messages.parse_messages(texts(spark, text)))


def test_unreadable_messages(spark):
    bad = [
        "no json",
        '{"timestamp": "2024-01-01 00:00:00", "magnitude": "1.5"}',
        '{"timestamp": "never", "magnitude": 1.0}',
    ]
    gap = '{"timestamp": "2024-01-01 00:00:00", "magnitude": NaN, "tension_entre_plaque": NaN}'
    rows = messages.parse_messages(texts(spark, *bad, gap)).collect()
    assert [r["event_time"] is None for r in rows] == [True, False, True, False]
    assert [r["magnitude"] for r in rows] == [None, None, 1.0, None]
    assert rows[3]["tension_entre_plaque"] is None
    assert {r[0] for r in messages.reject_messages(texts(spark, *bad, gap)).collect()} == set(bad)


def test_laps_do_not_share_windows(spark):
    df = readings(spark, [(0, "a", True, 1.0, 1.0), (90, "a", True, 1.0, 1.0)])
    sent = messages.parse_messages(messages.encode_messages(df, laps=3, lap_seconds=3600))
    assert sent.select("event_time").distinct().count() == 6


def message_file(folder, order, *times):
    """One file, and so one batch: readings at the given minutes and seconds of the day."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{order}.txt"
    lines = [
        json.dumps({"timestamp": f"2024-01-01 {t}", "secousse": True, "magnitude": 1.0, "tension_entre_plaque": 1.0})
        for t in times
    ]
    path.write_text("\n".join(lines))
    os.utime(path, (1_700_000_000 + order, 1_700_000_000 + order))


def run(spark, folder, tmp_path, mode, slide):
    """Counts per window start, as the sink received them."""
    name = f"alerts_{uuid.uuid4().hex}"
    source = read_stream(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"})
    stream = alerts.risk_stream(messages.parse_messages(source), slide=slide)
    alerts.start(
        stream, "memory", str(tmp_path / name), mode, {"availableNow": True}, name=name
    ).awaitTermination()
    rows = flatten_window(spark.table(name)).select("window_start", "nb_secousses").collect()
    return {r[0].strftime("%H:%M"): r[1] for r in rows}


@pytest.mark.parametrize("mode, first", [("complete", 2), ("append", 1), ("update", 1)])
def test_late_readings_by_mode(spark, tmp_path, mode, first):
    folder = tmp_path / "in"
    for i, t in enumerate(["00:00:30", "02:00:00", "03:00:00", "00:00:40", "04:00:00"]):
        message_file(folder, i, t)
    counts = run(spark, folder, tmp_path, mode, "5 minutes")
    assert counts["00:00"] == first
    assert ("04:00" in counts) == (mode != "append")


@pytest.mark.parametrize("mode", ["complete", "append", "update"])
def test_a_reading_one_batch_late_is_still_counted(spark, tmp_path, mode):
    folder = tmp_path / "in"
    for i, t in enumerate(["00:00:30", "02:00:00", "00:00:40", "03:00:00"]):
        message_file(folder, i, t)
    assert run(spark, folder, tmp_path, mode, "1 minute")["00:00"] == 2


def test_stream_equals_batch_over_several_files(spark, tmp_path, sf_dir):
    sent = messages.encode_messages(event_readings(spark, "/root/testdata/sf0.001"))
    folder = str(tmp_path / "messages")
    messages.write_messages(sent.repartition(3), "text", {"path": folder})
    name = f"alerts_{uuid.uuid4().hex}"
    stream = alerts.risk_stream(messages.parse_messages(read_stream(spark, "text", {"path": folder})))
    alerts.start(
        stream, "memory", str(tmp_path / "cp"), "complete", {"availableNow": True}, name=name
    ).awaitTermination()
    batch = risk_alerts(messages.parse_messages(sent), cols=STREAM_COLUMNS)
    got = collect(comparable(flatten_window(spark.table(name))), "window_start")
    assert got == collect(comparable(flatten_window(batch)), "window_start")


def test_console_sink_until_stopped(spark, tmp_path):
    message_file(tmp_path / "in", 0, "00:00:30")
    source = read_stream(spark, "text", {"path": str(tmp_path / "in")})
    query = alerts.start(
        alerts.risk_stream(messages.parse_messages(source)),
        "console",
        str(tmp_path / "cp"),
        "complete",
        options={"truncate": "false"},
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()


def test_a_restarted_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """A stopped query takes up its state again: the second run adds to the windows of the first."""
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for order, times in enumerate([("00:00:10", "00:00:20"), ("00:00:30", "02:00:00")]):
        message_file(folder, order, *times)
        source = read_stream(spark, "text", {"path": str(folder)})
        stream = alerts.risk_stream(messages.parse_messages(source), slide="5 minutes")
        alerts.start(
            flatten_window(stream), "parquet", checkpoint, trigger={"availableNow": True}, options={"path": out}
        ).awaitTermination()
    assert [r["nb_secousses"] for r in spark.read.parquet(out).collect()] == [3]


def test_a_stream_stopped_mid_way_gives_the_uninterrupted_result(spark, tmp_path):
    """State is kept by RocksDB with changelogs; three runs over four batches, one of which is cut off
    before it was committed and runs again, give what one run gives."""
    times = [("00:00:10", "00:00:20"), ("00:00:30", "00:07:00"), ("00:07:10", "00:21:00"), ("00:21:30", "02:00:00")]

    def go(folder, out, checkpoint):
        source = read_stream(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"})
        stream = flatten_window(alerts.risk_stream(messages.parse_messages(source), slide="5 minutes"))
        upserts.start_upserts(stream, out, checkpoint, "update", {"availableNow": True}).awaitTermination()
        return collect(upserts.read_upserts(spark, out, stream.schema, ["window_start", "window_end"]), "window_start")

    for order, some in enumerate(times):
        message_file(tmp_path / "whole", order, *some)
    expected = go(tmp_path / "whole", str(tmp_path / "once"), str(tmp_path / "cp1"))
    found = None
    for order, some in enumerate(times):
        message_file(tmp_path / "parts", order, *some)
        if order in (0, 2, 3):
            found = go(tmp_path / "parts", str(tmp_path / "parted"), str(tmp_path / "cp2"))
        if order == 2:
            # As after a crash: the last batch was stored, but its end was not noted.
            commits = sorted((tmp_path / "cp2/commits").glob("[0-9]*"), key=lambda p: int(p.name))
            commits[-1].unlink()
            (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert found == expected and sum(r[4] for r in found) == 8
    assert (tmp_path / "cp2/state/0/0").is_dir()
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    path = str(tmp_path / "rows")
    batches = [[(1, "a"), (2, "b")], [(2, "c"), (3, "d")], [(1, "e")]]

    def write(number):
        folder = upserts.batch_folder(path, number)
        spark.createDataFrame(batches[number], schema).write.mode("overwrite").parquet(folder)

    for number in (0, 1, 2, 2, 1):
        write(number)
    assert collect(upserts.read_upserts(spark, path, schema, ["k"]), "k") == [(1, "e"), (2, "c"), (3, "d")]


def test_late_messages_are_added_to_published_windows(spark, tmp_path):
    """On time, late for a published window, late for a window that had none, and not yet closed."""
    folder = tmp_path / "in"
    for i, some in enumerate([("00:00:30", "02:00:00"), ("03:00:00",), ("00:00:40", "00:30:00", "02:59:00"), ("04:00:00",)]):
        message_file(folder, i, *some)

    def run_both(one_by_one):
        base = tmp_path / str(one_by_one)
        limit = {"maxFilesPerTrigger": "1"} if one_by_one else {}
        source = messages.parse_messages(read_stream(spark, "text", {"path": str(folder), **limit}))
        # The published windows are always cut by file.
        cut = messages.parse_messages(read_stream(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"}))
        windows, now = repair.published_windows(cut), {"availableNow": True}
        alerts.start(windows, "parquet", f"{base}/wcp", "append", now, {"path": f"{base}/w"}).awaitTermination()
        repair.start_ledger(source, f"{base}/l", f"{base}/lcp", trigger=now).awaitTermination()
        published = spark.read.schema(windows.schema).parquet(f"{base}/w")
        ledger = repair.read_ledger(spark, f"{base}/l", source)
        late = repair.late_sums(published, ledger, repair.closed_until(ledger))
        return published, late, alerts_of_sums(repair.repaired(published, late))

    text = spark.read.text(str(folder))
    batch = flatten_window(risk_alerts(messages.parse_messages(text), cols=STREAM_COLUMNS))
    closed = batch.filter("window_end <= '2024-01-01 03:50:00'")
    for one_by_one in (True, False):
        published, late, found = run_both(one_by_one)
        assert collect(comparable(flatten_window(found)), "window_start") == collect(comparable(closed), "window_start")
        starts = {r[0].strftime("%H:%M"): r[1] for r in late.select("window.start", "n").collect()}
        assert starts["00:00"] == 1 and starts["00:30"] == 1 and published.count() < found.count()


def test_one_stream_feeds_the_table_and_the_messages(spark, tmp_path):
    message_file(tmp_path / "in", 0, "00:00:30", "00:01:10")
    message_file(tmp_path / "in", 1, "02:00:00")
    (tmp_path / "in" / "2.txt").write_text("no json")
    source = read_stream(spark, "text", {"path": str(tmp_path / "in"), "maxFilesPerTrigger": "1"})
    stream = alerts.risk_stream(messages.parse_messages(source))
    alerts.start_feed(
        stream, str(tmp_path / "table"), str(tmp_path / "cp"), "text", {"path": str(tmp_path / "out")}, "append",
        {"availableNow": True},
    ).awaitTermination()
    table = upserts.read_upserts(spark, str(tmp_path / "table"), stream.schema, ["window"])
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).select("value").collect()]
    assert len(sent) == table.count() == 6
    expected = {(r.window.start.strftime("%Y-%m-%d %H:%M:%S"), r.nb_secousses, r.alert_message) for r in table.collect()}
    assert {(x["window_start"], x["nb_secousses"], x["alert_message"]) for x in sent} == expected


@pytest.mark.parametrize("broken", [None, "rename", "remove"])
def test_compaction_changes_no_result(spark, tmp_path, monkeypatch, broken):
    """Also where it fails before or after the folder is replaced, and is called again."""
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    path = str(tmp_path / "rows")

    def write(number):
        rows = [(k, f"{k}-{number}") for k in range(number, number + 4)]
        folder = upserts.batch_folder(path, number)
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(folder)

    def found():
        return collect(upserts.read_upserts(spark, path, schema, ["k"]), "k")

    for number in range(6):
        write(number)
    expected = found()
    if broken:
        def fail(*arguments):
            raise OSError("lost")

        whole = getattr(upserts, broken)
        calls = []
        # The second removal comes after the folder was replaced.
        monkeypatch.setattr(upserts, broken, lambda *a: fail() if broken == "rename" or calls else calls.append(whole(*a)))
        with pytest.raises(OSError):
            upserts.compact(spark, path, schema, ["k"])
        monkeypatch.setattr(upserts, broken, whole)
    upserts.compact(spark, path, schema, ["k"])
    assert found() == expected
    write(5)
    assert found() == expected
    assert sorted(p.name for p in (tmp_path / "rows").iterdir()) == ["batch=4", "batch=5"]
