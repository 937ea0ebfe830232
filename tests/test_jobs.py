"""Jobs of the command line over text files."""

import json

import pytest

from tests.test_sources import LOG
from tidemill import __main__ as command
from tidemill import jobs
from tidemill.sinks.ledger import Ledger


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda name: spark)
    return lambda *arguments: command.main([str(a) for a in arguments])


def written(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(str(path)).collect())


def test_results_are_written_whole(spark, run, tmp_path):
    lines = [f"{i} M {150 + i}" for i in range(80)] + ["x F 171.5"]
    (tmp_path / "people").write_text("\n".join(lines) + "\n")
    assert run("people", tmp_path / "people", "--out", tmp_path / "out") == 0
    assert written(spark, tmp_path / "out" / "men_above_180") == [(49,)]
    assert written(spark, tmp_path / "out" / "by_gender") == [("F", 1), ("M", 80)]
    assert len(written(spark, tmp_path / "out" / "tallest")) == 50


def test_item_cf_writes_all_recommendations(spark, run, tmp_path):
    (tmp_path / "prefs").write_text("".join(f"{u},{i},1\n" for u in range(70) for i in (u % 5, (u + 1) % 5)))
    assert run("item-cf", tmp_path / "prefs", "--out", tmp_path / "out") == 0
    found = spark.read.parquet(str(tmp_path / "out" / "recommendations"))
    assert found.count() > 50 and found.select("user_id").distinct().count() == 70


def test_movie_check_names_watched_and_recommended(run, tmp_path, capsys, monkeypatch):
    ratings = [f"u{u},{m},{1 + (u + m) % 5}" for u in range(12) for m in range(8) if (u + m) % 3]
    (tmp_path / "ratings").write_text("\n".join(ratings) + "\n")
    (tmp_path / "movies").write_text("".join(f"{m},8.0,Movie {m}\n" for m in range(8)) + "3,8.0,Movie three\n")
    check = jobs.movies.check
    monkeypatch.setattr(jobs.movies, "check", lambda *a: check(*a, rank=2, iterations=3))
    assert run("movie-check", tmp_path / "ratings", tmp_path / "movies", "u1", "u2") == 0
    shown = capsys.readouterr().out
    assert "seen" in shown and "recommended" in shown and "Movie three" in shown and "u3" not in shown


def test_streams_over_a_folder(spark, run, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a").write_text("\n".join([*LOG, "broken"]) + "\n")
    for name in ("traffic-batches", "traffic-windows"):
        assert run(name, tmp_path / "log", tmp_path / name, tmp_path / f"{name}-c", "--once") == 0
    (batch,) = spark.read.parquet(str(tmp_path / "traffic-batches")).select("pv", "ips", "uv").collect()
    assert tuple(batch) == (6, 2, 5)


def test_hottest_searches_over_a_folder_take_the_files_time(spark, run, tmp_path):
    import os

    folder = tmp_path / "searches"
    folder.mkdir()
    deliveries = [(1_700_000_010, "a x\nb x\nc y\nd z\ne w\n"), (1_700_000_300, "f late\n")]
    for at, (time, lines) in enumerate(deliveries):
        (folder / str(at)).write_text(lines)
        os.utime(folder / str(at), (time, time))
        assert run("hottest-searches", folder, tmp_path / "hot", tmp_path / "hot-c", "--once") == 0
    found = spark.read.parquet(str(tmp_path / "hot"))
    assert found.select("window_start").distinct().count() == 3
    assert {(r.item, r.n, r.rank) for r in found.collect()} == {("x", 2, 1), ("w", 1, 2), ("y", 1, 3)}


def test_clicks_with_and_without_a_ledger(spark, run, tmp_path):
    (tmp_path / "clicks").mkdir()
    rows = [{"uid": u, "event_time": "0", "os_type": "A", "click_count": n} for u, n in (("a", 1), ("b", 2), ("a", 3))]
    (tmp_path / "clicks" / "1").write_text("".join(json.dumps(r) + "\n" for r in rows) + "broken\n")
    for checkpoint in ("c1", "c2"):  # the second one has lost all
        assert run("clicks-ledger", tmp_path / "clicks", tmp_path / "ledger", tmp_path / checkpoint, "--once") == 0
    totals = Ledger(spark, str(tmp_path / "ledger"), str(tmp_path / "c2")).totals()
    assert sorted(tuple(r) for r in totals.collect()) == [("a", 4), ("b", 2)]
    assert run("clicks", tmp_path / "clicks", tmp_path / "totals", tmp_path / "c3", "--once") == 0
    assert spark.read.parquet(str(tmp_path / "totals" / "rejects")).count() == 1


@pytest.mark.parametrize("arguments", [[], ["nothing"], ["people"], ["clicks", "folder"], ["movie-grid", "a", "b", "c"]])
def test_wrong_arguments_show_the_usage(run, arguments, capsys):
    assert run(*arguments) == 2
    assert "hottest-searches SOURCE OUT CHECKPOINT" in capsys.readouterr().err


def test_sources_by_address(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(jobs, "kafka_stream", lambda *a: asked.append(a[1:]))
    monkeypatch.setattr(jobs, "socket_stream", lambda *a: asked.append(a[1:]))
    jobs.messages(spark, "kafka://host:9092/clicks")
    jobs.messages(spark, "socket://host")
    assert asked == [(["host:9092"], ["clicks"]), ("host", 9999)]
    assert jobs.messages(spark, str(tmp_path)).columns == ["value", "timestamp"]
