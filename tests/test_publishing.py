"""Outputs belong to the run that writes them."""

import threading
from pathlib import Path

import pytest

from levelscope.jobs import correct, report
from levelscope.session import CLAIMS, COMPLETE, _Outputs, published, run_key
from tests.golden import PERIOD, base_rows, frame

SETTINGS = {"preset": "all_levels", **PERIOD}


def one_table(spark, path, mode, value):
    spark.range(1).selectExpr(f"{value} AS v").write.mode(mode).parquet(path)


def values(spark, path):
    return [r.v for r in spark.read.parquet(path).collect()]


def test_a_foreign_folder_is_refused_and_stays(spark, tmp_path):
    """What stands at the output's name is someone else's table."""
    frame(spark, base_rows()).write.parquet(str(tmp_path / "fixed"))
    theirs = tmp_path / "out" / "loss_report_csv"
    theirs.mkdir(parents=True)
    (theirs / "part-0.csv").write_text("theirs")
    with pytest.raises(ValueError, match="not written by this job"):
        report.run(spark, str(tmp_path / "fixed"), str(tmp_path / "out"), SETTINGS)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["loss_report_csv"]
    assert (theirs / "part-0.csv").read_text() == "theirs"


def test_stage_one_does_not_replace_a_table(spark, tmp_path):
    frame(spark, base_rows()).drop("mode_fixed", "first_clear_650_ts").write.parquet(str(tmp_path / "raw"))
    spark.range(5).write.parquet(str(tmp_path / "out/raw_fixed"))
    settings = {
        "source": {"path": str(tmp_path / "raw")}, "output_path": str(tmp_path / "out"),
        "correction": dict(app_id="harbour", history_start="2026-01-01", history_end="2026-04-01"),
    }
    with pytest.raises(ValueError, match="not written by this job"):
        correct.run(spark, settings)
    assert spark.read.parquet(str(tmp_path / "out/raw_fixed")).count() == 5
    assert not (tmp_path / "out/user_clear650_cutoffs").exists()


def test_an_own_broken_run_is_resumed(spark, tmp_path):
    root, run = str(tmp_path / "out"), run_key({"a": 1})
    with pytest.raises(RuntimeError, match="disk"), published(spark, root, run) as mode:
        assert mode == "errorifexists"
        one_table(spark, f"{root}/t", mode, 1)
        raise RuntimeError("disk")
    assert not (tmp_path / "out" / COMPLETE).exists()
    with published(spark, root, run) as mode:
        one_table(spark, f"{root}/t", mode, 2)
    assert values(spark, f"{root}/t") == [2] and (tmp_path / "out" / COMPLETE).exists()
    with pytest.raises(ValueError, match="complete"), published(spark, root, run):
        pass


def test_another_job_does_not_go_on_from_it(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(RuntimeError), published(spark, root, run_key({"a": 1})) as mode:
        one_table(spark, f"{root}/t", mode, 1)
        raise RuntimeError
    with pytest.raises(ValueError, match="another run"), published(spark, root, run_key({"a": 2}), take_over=True):
        pass
    assert values(spark, f"{root}/t") == [1]


def test_a_killed_run_is_only_taken_over_on_demand(spark, tmp_path):
    root, run = str(tmp_path / "out"), run_key({"a": 1})
    killed = _Outputs(spark, root, run)
    killed.claim(False)
    one_table(spark, f"{root}/t", "errorifexists", 1)
    with pytest.raises(ValueError, match="being written"), published(spark, root, run):
        pass
    with pytest.raises(ValueError, match="being written"), published(spark, root, run_key({"b": 1}), take_over=True):
        pass
    with published(spark, root, run, take_over=True) as mode:
        one_table(spark, f"{root}/t", mode, 2)
    assert values(spark, f"{root}/t") == [2]


def test_a_refused_run_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    first = _Outputs(spark, root, "one")
    first.claim(False)
    with pytest.raises(ValueError, match="being written"), published(spark, root, "two"):
        pass
    assert [p.stem for p in (tmp_path / "out" / CLAIMS).glob("*.open")] == [first.name]
    first.withdraw()
    assert not (tmp_path / "out").exists()


def test_two_claims_at_the_same_moment(spark, tmp_path):
    """Both have written their claim before either looks: neither goes on."""
    root = str(tmp_path / "out")
    one, two = (_Outputs(spark, root, name) for name in ("one", "two"))
    two.write_new(CLAIMS, f"{two.name}.open")
    with pytest.raises(ValueError, match="being written"):
        one.claim(False)


def test_of_many_writers_one_at_most_wins(spark, tmp_path):
    for turn in range(5):
        root, won, start = str(tmp_path / f"out{turn}"), [], threading.Barrier(6)

        def attempt():
            outputs = _Outputs(spark, root, "same")
            start.wait()
            try:
                outputs.claim(False)
                won.append(outputs.name)
            except ValueError:
                pass

        threads = [threading.Thread(target=attempt) for _ in range(6)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) <= 1
        assert len(list(Path(root, CLAIMS).glob("*"))) == len(won)


def test_runs_are_known_by_their_settings(spark):
    assert run_key({"a": 1, "b": 2}) == run_key({"b": 2, "a": 1}) != run_key({"a": 1, "b": 3})
