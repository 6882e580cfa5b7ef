import datetime as dt
from entitylake.functions.deid import deidentify
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import StructType

from entitylake.operators.pivot import pivot_explicit
from entitylake.sources.audit import audited_write
from entitylake.sources.documents import read_documents, split_quarantine
from entitylake.sources import scratch
from entitylake.sources.scratch import scratch_path, shared_folder, staged
from entitylake.sources.sinks import write_csv, write_groups, write_parquet
from entitylake.streaming.intake import append_available, document_stream, each_batch

SCHEMA = StructType().add("id", "long").add("v", "string")


def _land(folder, names, broken=()):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        text = json.dumps({"id": n, "v": f"x{n}"}, indent=2)
        with open(f"{folder}/doc{n}.json", "w") as out:
            out.write(text[:-5] if n in broken else text)


def _files(folder):
    return sorted(f for _, _, fs in os.walk(folder) for f in fs if f.endswith(".json"))


def _data_files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_multiline_modes(spark, tmp_path):
    folder = str(tmp_path / "in")
    _land(folder, [1, 2], broken=[2])
    files = [f"{folder}/doc{n}.json" for n in (1, 2)]
    assert read_documents(spark, files, SCHEMA, malformed="drop").count() == 1
    good, bad = split_quarantine(read_documents(spark, files, SCHEMA, malformed="quarantine"))
    assert [tuple(r) for r in good.collect()] == [(1, "x1")]
    (broken,) = bad.collect()
    assert '"id": 2' in broken._corrupt_record and broken.source_file.endswith("doc2.json")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, files, SCHEMA).collect()
    inferred = read_documents(spark, files[:1])
    assert inferred.dtypes == [("id", "bigint"), ("v", "string")]


def test_arrays_and_lines(spark, tmp_path):
    with open(tmp_path / "many.json", "w") as out:
        json.dump([{"id": 1}, {"id": 2}], out, indent=1)
    assert read_documents(spark, str(tmp_path / "many.json"), "id long").count() == 2
    with open(tmp_path / "lines.json", "w") as out:
        out.write('{"id": 1}\n{"id": \n{"id": 3}\n')
    lines = read_documents(spark, str(tmp_path / "lines.json"), "id long", "lines", "drop")
    assert sorted(r.id for r in lines.collect()) == [1, 3]
    for bad in ({"layout": "xml"}, {"malformed": "ignore"}):
        with pytest.raises(ValueError):
            read_documents(spark, "x", SCHEMA, **bad)


def test_target_files_and_append(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(100)
    write_parquet(rows, path, target_files=3)
    assert len(_data_files(path)) == 3
    write_parquet(rows, path)
    assert spark.read.parquet(path).count() == 200
    write_parquet(rows, path, mode="overwrite", target_files=1)
    assert spark.read.parquet(path).count() == 100 and len(_data_files(path)) == 1
    with pytest.raises(ValueError):
        write_parquet(rows, path, target_files=0)


def test_groups_skip_the_empty(spark, tmp_path):
    frames = {"a": spark.range(2), "b": spark.range(0), "c": spark.range(1)}
    probes = {"c": spark.range(0)}
    assert write_groups(frames, str(tmp_path), probes=probes) == ["a"]
    assert os.listdir(tmp_path) == ["a"]


def test_csv_has_no_index_column(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, 'a "b",c'), (2, None)], "k int, v string"), str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == [("1", 'a "b",c'), ("2", None)]


def test_audit_records_success_and_failure(spark, tmp_path):
    audit, target = str(tmp_path / "audit"), str(tmp_path / "t")
    source = spark.range(10)
    even = lambda df: df.where("id % 2 = 0")
    audited_write(source, even, target, audit, "job", "1", "src", "tgt")

    def broken(df):
        return df.select(F.raise_error(F.lit("boom")).alias("x"))

    with pytest.raises(Exception, match="boom"):
        audited_write(source, broken, target, audit, "job", "2")
    good, bad = spark.read.parquet(audit).orderBy("job_id").collect()
    assert (good.flag, good.src_rec_count, good.tgt_rec_count) == ("SUCCESS", 10, 5)
    assert (bad.flag, bad.src_rec_count, bad.src_obj_name) == ("FAIL", 0, "")
    assert "boom" in bad.error_message and bad.error_type


class _Uncountable:
    """A source whose count fails."""

    def __init__(self, df):
        self.sparkSession, self.df = df.sparkSession, df

    def count(self):
        raise RuntimeError("no count")


def test_nothing_is_stored_when_the_source_cannot_be_counted(spark, tmp_path):
    audit, target = str(tmp_path / "audit"), str(tmp_path / "t")
    source = spark.range(3)
    with pytest.raises(RuntimeError, match="no count"):
        audited_write(_Uncountable(source), lambda s: s.df, target, audit, "job", run_id="r1")
    assert not os.path.exists(target)
    audited_write(source, lambda df: df, target, audit, "job", run_id="r2")
    assert spark.read.parquet(target).count() == 3
    rows = spark.read.parquet(audit).orderBy("job_run_id").collect()
    assert [(r.job_run_id, r.flag, r.error_obj_name) for r in rows] == [
        ("r1", "FAIL", "count"), ("r2", "SUCCESS", "")
    ]
    assert rows[0].error_obj_loc.startswith("test_storage.py:")


def test_target_count_is_of_this_run_only(spark, tmp_path):
    audit, target = str(tmp_path / "audit"), str(tmp_path / "t")
    for job in ("1", "2"):
        audited_write(
            spark.range(4), lambda df: df.groupBy("id").count(), target, audit, "job", job,
            target_files=int(job),
        )
    assert [r.tgt_rec_count for r in spark.read.parquet(audit).collect()] == [4, 4]


class _Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, name, default=None):
        return self._settings.get(name, default)


def test_shared_folder():
    named = _Session(spark_checkpoint_dir="/shared/x/", spark_master="yarn")
    path = scratch_path(named, "t")
    assert path.startswith("/shared/x/run-") and "/t-" in path
    assert scratch_path(named, "t") != scratch_path(named, "t")
    local = _Session(spark_master="local[2]")
    assert os.path.isdir(shared_folder(local)) and shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="shared by the cluster"):
        shared_folder(_Session(spark_master="yarn"))


def test_staged_table_lies_in_the_shared_folder(spark):
    table = staged(spark.range(3), "numbers")
    assert table.count() == 3
    path = table.inputFiles()[0]
    assert f"{shared_folder(spark)}/run-" in path and "/numbers-" in path


def test_staged_tables_of_a_run_are_cleared(spark, monkeypatch):
    kept = staged(spark.range(3), "numbers")
    monkeypatch.setattr(scratch, "_RUN", "run-of-test")
    assert "run-of-test" in staged(spark.range(3), "numbers").inputFiles()[0]
    scratch.clear_scratch(spark)
    assert not os.path.exists(f"{shared_folder(spark)}/run-of-test") and kept.count() == 3


def test_a_session_without_a_master_is_not_taken_for_local():
    for other in (_Session(), _Session(spark_master="local-cluster[2,1,1024]")):
        with pytest.raises(ValueError, match="shared by the cluster"):
            shared_folder(other)


def test_intake_in_chunks_with_archive(spark, tmp_path):
    landing, archive, target, checkpoint = (str(tmp_path / n) for n in "latc")
    _land(landing, range(5))

    def run():
        docs = document_stream(spark, landing, SCHEMA, chunk_size=2, archive=archive)
        return append_available(docs, target, checkpoint)

    query = run()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4]
    assert len(_files(archive)) == 4 and len(_files(landing)) == 1
    run()
    assert spark.read.parquet(target).count() == 5
    _land(landing, [7])
    run()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4, 7]


def test_intake_drops_broken_files(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in "ltc")
    _land(landing, [1, 2, 3], broken=[2])
    append_available(document_stream(spark, landing, SCHEMA, malformed="drop"), target, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 3]


def test_batches_are_stored_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in "ltc")
    _land(landing, range(5))
    docs = document_stream(spark, landing, SCHEMA, chunk_size=2)

    def pivot(batch):
        long = batch.select(F.col("id").alias("k"), F.lit("V").alias("joined_column"), F.col("v").alias("value"))
        return pivot_explicit(long, ["V"], ["k"])

    each_batch(docs, pivot, target, checkpoint)
    back = spark.read.parquet(target)
    assert sorted((r.k, r.V) for r in back.collect()) == [(n, f"x{n}") for n in range(5)]
    assert back.select("batch").distinct().count() == 3
    # a stream with a new checkpoint counts its batches from 0 again
    each_batch(docs, pivot, target, str(tmp_path / "second"))
    again = spark.read.parquet(target)
    assert again.count() >= 5 and again.where(F.col("run") == back.first().run).count() == 5


def test_explicit_pivot_runs_on_a_stream(spark, tmp_path):
    landing = str(tmp_path / "l")
    _land(landing, range(3))
    docs = document_stream(spark, landing, SCHEMA)
    long = docs.select(F.lit("k").alias("k"), F.lit("V").alias("joined_column"), F.col("v").alias("value"))
    query = (
        pivot_explicit(long, ["V"], ["k"]).writeStream.format("memory").queryName("pivoted")
        .outputMode("complete").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("pivoted").collect()] == [("k", "x2")]


@pytest.mark.parametrize("malformed", ["fail", "quarantine"])
def test_intake_does_not_lose_broken_lines(spark, tmp_path, malformed):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"uri": "entities/1"}\n{"uri": \n')
    docs = document_stream(spark, str(landing), StructType.fromDDL("uri string"), layout="lines",
                           malformed=malformed)
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    if malformed == "fail":
        with pytest.raises(StreamingQueryException):
            append_available(docs, target, checkpoint)
        return
    append_available(docs, target, checkpoint)
    rows = spark.read.parquet(target).collect()
    assert {(r.uri, r["_corrupt_record"]) for r in rows} == {("entities/1", None), (None, '{"uri": ')}


def test_malformed_dates_give_null(spark):
    frame = spark.createDataFrame([("1990-02-28",), ("no date",), (None,)], "dob string")
    rows = deidentify(frame, birth_columns=["dob"], as_of=dt.date(2024, 2, 29)).collect()
    assert [(r.Age, r.YearOfBirth) for r in rows] == [(34, 1990), (None, None), (None, None)]
