"""The jobs one after the other, from landed files to stored alerts."""

from __future__ import annotations

from faultline.jobs import main
from faultline.plans.inputs import event_texts
from faultline.schemas import RAW_CITY_READINGS
from faultline.sources.sinks import write_csv

SMALL = "/root/testdata/sf0.001"


def test_from_landed_files_to_alerts(spark, tmp_path):
    raw = event_texts(spark, SMALL).select(*RAW_CITY_READINGS.names)
    write_csv(raw, f"{tmp_path}/raw")

    def job(*arguments):
        main([a.replace("@", f"{tmp_path}/") for a in arguments], spark)

    def table(name):
        return spark.read.parquet(f"{tmp_path}/{name}")

    job("clean", "--source", "@raw", "--city", "--target", "@clean", "--rejects", "@rejects")
    assert table("clean").count() == raw.count()
    assert 0 < table("rejects").count() < raw.count()

    job("clean", "--source", "@raw", "--city", "--target", "@clean_csv", "--format", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/clean_csv").count() == raw.count()

    job("hourly", "--source", "@clean", "--target", "@hourly")
    timed = table("clean").filter("date IS NOT NULL").count()
    assert table("hourly").selectExpr("sum(nombre_observations)").first()[0] == timed

    job("hourly", "--source", "@clean_csv", "--source-format", "csv", "--city", "--target", "@same")
    assert table("same").exceptAll(table("hourly")).isEmpty()

    job("aggregate", "--source", "@clean", "--entity", "ville", "--target", "@report")
    assert table("report/agg_ville_heure").select("ville").distinct().count() == 5

    job("precursors", "--source", "@clean", "--entity", "ville", "--target", "@before")
    assert table("before/precurseurs").count() == raw.count()
    assert table("before/conditions").count() == 5

    job("replay", "--source", "@clean", "--format", "text", "--option", "path=@messages",
        "--laps", "2", "--lap-seconds", "5184000")
    job("watch", "--source-format", "text", "--source-option", "path=@messages", "--format", "parquet",
        "--option", "path=@alerts", "--checkpoint", "@checkpoint", "--once")
    assert table("alerts").count() > 0


def test_jobs_by_day_paced_and_mended(spark, tmp_path):
    def job(*arguments):
        main([a.replace("@", f"{tmp_path}/") for a in arguments], spark)

    def table(name):
        return spark.read.parquet(f"{tmp_path}/{name}")

    raw = event_texts(spark, SMALL).select(*RAW_CITY_READINGS.names)
    write_csv(raw, f"{tmp_path}/raw")
    job("clean", "--source", "@raw", "--city", "--target", "@clean")
    job("land", "--source", "@clean", "--target", "@days")
    for name in ("horaire", "precurseurs"):
        job("publish", "--source", "@days", "--target", f"@{name}", "--table", name)
        before = table(name).count()
        job("publish", "--source", "@days", "--target", f"@{name}", "--table", name,
            "--first", "2024-01-05", "--last", "2024-01-09")
        assert table(name).count() == before
    timed = table("clean").filter("date IS NOT NULL").count()
    assert table("horaire").selectExpr("sum(nombre_observations)").first()[0] == timed

    job("replay", "--source", "@clean", "--format", "text", "--option", "path=@messages", "--laps", "2",
        "--lap-seconds", "5184000", "--files-per-trigger", "2", "--checkpoint", "@replay-state")
    sent = spark.read.text(f"{tmp_path}/messages")
    assert sent.count() == 2 * table("clean").count()

    (tmp_path / "messages/lap=1/odd.txt").write_text("no json")
    job("watch", "--source-format", "text", "--source-option", "path=@messages", "--format", "text",
        "--option", "path=@sent", "--checkpoint", "@watch-state", "--table", "@alerts", "--rejects", "@rejects",
        "--ledger", "@ledger", "--once")
    assert spark.read.text(f"{tmp_path}/sent").count() == table("alerts").count() > 0
    assert "no json" in {r.value for r in spark.read.text(f"{tmp_path}/rejects").collect()}
    job("mend", "--source", "@ledger", "--target", "@mended")
    assert table("mended").count() == table("alerts").count()


def test_jobs_leave_no_scratch_behind(spark, tmp_path, monkeypatch):
    from faultline import session

    made, whole = [], session.scratch_dir
    monkeypatch.setattr(session, "scratch_dir", lambda *a: made.append(whole(*a)) or made[-1])
    raw = event_texts(spark, SMALL).select(*RAW_CITY_READINGS.names)
    write_csv(raw, f"{tmp_path}/raw")
    main(["clean", "--source", f"{tmp_path}/raw", "--city", "--target", f"{tmp_path}/clean"], spark)
    main(["precursors", "--source", f"{tmp_path}/clean", "--entity", "ville", "--target", f"{tmp_path}/out"], spark)
    assert made and not any(session.folder_names(spark, path) for path in made)
    assert (tmp_path / "out/precurseurs").is_dir()
