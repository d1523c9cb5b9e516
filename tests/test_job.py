import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import plain, plan
from ridemetrics import job
from ridemetrics.operators import storage
from ridemetrics.operators.storage import new_folder, scratch, store, write_result
from ridemetrics.plans import questions
from ridemetrics.plans.questions import QUESTIONS, Grouped, answers, prepare
from ridemetrics.schema import RENAMES
from ridemetrics.sources.events import hourly_facts
from ridemetrics.sources.hourly_csv import read_hourly_csv, standardize

REPO = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    """The small facts as the raw CSV, in time order, each date labelled once."""
    rows = hourly_facts(spark.read.parquet(f"{SF_SMALL}/events.parquet")).orderBy("ts").collect()
    lines, seen = [",".join(RENAMES)], None
    for r in rows:
        label = r.date.strftime("%d-%b-%y") if r.date != seen else ""
        seen = r.date
        lines.append(",".join(map(str, [label, r.hour, r.eyeballs, r.zeroes, r.completed_trips, r.requests, r.drivers])))
    path = tmp_path_factory.mktemp("raw") / "hourly.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def six_places(df):
    return plain(df.select([F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes]))


@pytest.mark.parametrize("text, ids", [("", list(range(1, 11))), (None, list(range(1, 11))), ("7", [7]), ("7, 3,7", [3, 7])])
def test_ids(text, ids):
    assert job.parse_ids(text) == ids


@pytest.mark.parametrize("text, error", [("x", ValueError), ("11", KeyError), ("3,0", KeyError)])
def test_wrong_ids_fail_before_any_work(text, error):
    with pytest.raises(error):
        job.run(None, "nowhere", "nowhere", text)


@pytest.mark.parametrize("ids", [None, "6", "2,3", "5"])
def test_answers_are_those_of_the_table(spark, raw_csv, tmp_path, folder, ids):
    written = job.run(spark, raw_csv, str(tmp_path), ids)
    facts = hourly_facts(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    assert [Path(p).name for p in written] == [f"question{i}" for i in job.parse_ids(ids)]
    for i in job.parse_ids(ids):
        assert six_places(spark.read.parquet(f"{tmp_path}/question{i}")) == six_places(QUESTIONS[i](prepare(facts, [i], folder)))


@pytest.mark.parametrize("ids", ["6", None])
def test_stored_tables_are_removed(spark, raw_csv, tmp_path, ids):
    job.run(spark, raw_csv, str(tmp_path / "out"), ids, scratch_root=(tmp_path / "scratch").as_uri())
    assert not [p for p in (tmp_path / "scratch").rglob("*.parquet")]


def test_scratch_holds_what_threads_store(spark, tmp_path):
    with scratch(spark, tmp_path.as_uri()) as folder:
        with ThreadPoolExecutor(2) as pool:
            stored = list(pool.map(lambda k: store(spark.range(k), folder, "t").count(), [1, 2, 3]))
        assert stored == [1, 2, 3]
        assert len(list(Path(folder.removeprefix("file:")).iterdir())) == 3
    assert not Path(folder.removeprefix("file:")).exists()


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
def test_a_shared_folder_is_needed(master):
    context = SimpleNamespace(master=master, applicationId="a", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_folder(session)
    assert new_folder(session, "hdfs:///x").startswith("hdfs:///x/ridemetrics/a/")


def test_sink_overwrites_and_partitions(spark, tmp_path):
    df = spark.range(6).withColumn("k", F.col("id") % 2)
    write_result(df, str(tmp_path), "t")
    path = write_result(df, f"{tmp_path}/", "t", ["k"])
    assert sorted(p.name for p in Path(path).glob("k=*")) == ["k=0", "k=1"]
    assert spark.read.parquet(path).count() == 6


def test_command_line(raw_csv, tmp_path):
    command = [sys.executable, "submit.py", "--path", raw_csv, "--out", str(tmp_path / "out"), "--question-id", "3", "--scratch", str(tmp_path / "scratch")]
    done = subprocess.run(command, cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert list((tmp_path / "out" / "question3").glob("*.parquet"))
    assert not (tmp_path / "out" / "question1").exists()


def test_a_write_that_fails_leaves_the_old_answer(spark, tmp_path):
    path = write_result(spark.range(5), str(tmp_path), "t")
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_result(bad, str(tmp_path), "t")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(5))
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    # The answer may be made from the one it replaces.
    write_result(spark.read.parquet(path).filter("id > 2"), str(tmp_path), "t")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]


def test_a_switch_that_fails_puts_the_old_answer_back(spark, tmp_path, monkeypatch):
    path = write_result(spark.range(5), str(tmp_path), "t")
    real = storage._switch
    monkeypatch.setattr(storage, "_switch", lambda spark, new, path, old: real(spark, f"{new}-missing", path, old))
    with pytest.raises(Exception):
        write_result(spark.range(9), str(tmp_path), "t")
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_one_scan_for_each_key(spark, raw_csv, folder, monkeypatch):
    """Ten questions read the table once per key of the grouped ones, and once each for the others."""
    table = prepare(standardize(read_hourly_csv(spark, raw_csv), folder), list(QUESTIONS), folder)
    stored = []
    monkeypatch.setattr(questions, "store", lambda df, *a: stored.append(plan(df)) or store(df, *a))
    found = answers(table, list(QUESTIONS), folder)
    assert [text.count("FileScan") for text in stored] == [1, 1]  # by hour, and as a whole
    read_again = {i for i, df in found.items() if set(df.inputFiles()) & set(table.inputFiles())}
    assert read_again == {1, 2, 6, 8}
    for i, df in found.items():
        assert six_places(df) == six_places(QUESTIONS[i](table)), i


def test_questions_with_one_key_do_not_share_a_name():
    """Else one question would be answered from another's sums."""
    grouped = [q for q in QUESTIONS.values() if isinstance(q, Grouped)]
    names = [(q.key, name) for q in grouped for name in q.needs()]
    assert len(names) == len(set(names))
