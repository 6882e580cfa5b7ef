"""Manifests, and datasets kept up to date by batches."""

import random
import re
from collections import Counter

import pytest
from oracle import actual
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from entitylake.catalog.runs import forget_last_commit, streamed_entities
from entitylake.operators import upkeep
from entitylake.operators.upkeep import PivotState
from entitylake.plans.entity import entity_wide
from entitylake.samples.documents import crosswalk_documents, customer_documents
from entitylake.sources import scratch
from entitylake.sources.compaction import compact_landing, compacted_folders
from entitylake.sources.manifest import Manifest, publish
from entitylake.sources.scratch import staged
from entitylake.streaming import linked
from entitylake.streaming.archive import (
    ARCHIVED,
    MISSING,
    WAITING,
    archive_consumed,
    archive_state,
)
from entitylake.streaming.intake import append_available, document_stream
from entitylake.streaming.linked import EntityState

from conftest import DATA

NUMBERS = "n long"


def _numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], NUMBERS)


def test_readers_see_what_the_latest_commit_names(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "base"))
    schema = _numbers(spark).schema
    assert manifest.read() is None and manifest.dataset("a", schema).count() == 0
    folders = [manifest.folder("a") for _ in range(3)]
    for folder, value in zip(folders, (1, 2, 3)):
        _numbers(spark, value).write.parquet(manifest.absolute(folder))
    manifest.commit(4, {"a": folders[:1]}, {"rows": 1})
    manifest.commit(7, {"a": folders[:2]})
    assert manifest.versions() == [4, 7] and manifest.read(4).notes == {"rows": 1}
    assert sorted(r.n for r in manifest.dataset("a", schema).collect()) == [1, 2]
    assert [r.n for r in manifest.dataset("a", schema, manifest.read(4)).collect()] == [1]
    assert manifest.dataset("b", schema).count() == 0
    assert manifest.orphans() == [folders[2]]
    # a version stands as it was first committed
    assert manifest.commit(7, {"a": folders}).datasets == {"a": folders[:2]}
    assert manifest.read(5) is None


PATHS, NAMES = ["attributes.Name", "attributes.Segment"], ["Name", "Segment"]
REFERENCE = "attributes.ReferenceId"


def _state(tmp_path, **options):
    return EntityState(str(tmp_path / "entities"), PATHS, NAMES, REFERENCE, buckets=4, **options)


@pytest.fixture(scope="module")
def parts(spark):
    """Documents of which attributes and crosswalks are spread over six batches."""
    attributes = staged(customer_documents(spark, DATA), "attributes")
    crosswalks = staged(crosswalk_documents(spark, DATA), "crosswalks")
    pick = F.pmod(F.hash("uri"), F.lit(3))
    halves = [attributes.where(pick == i) for i in (0, 1)] + [crosswalks.where(pick != 0)]
    return [*halves, crosswalks.where(pick == 0), attributes.where(pick == 2), attributes.where(pick < 2)]


def _union(parts):
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _batch(parts):
    docs = _union(parts).dropDuplicates(["uri", "attributes", "crosswalks"])
    return entity_wide(docs, PATHS, NAMES, REFERENCE)


def test_entities_equal_the_batch_plan_after_every_batch(spark, tmp_path, parts):
    state = _state(tmp_path, compact_every=4)
    counts = []
    for number, part in enumerate(parts):
        state.store(part, "run", number)
        want = _batch(parts[: number + 1]).dropDuplicates()
        assert actual(state.current(spark).dropDuplicates()) == actual(want)
        counts.append(want.count())
    assert counts[-1] > counts[2] > counts[1]  # late crosswalks and late attributes both count


def test_a_batch_is_stored_once(spark, tmp_path, parts):
    state = _state(tmp_path)
    for number, part in enumerate(parts[:3]):
        state.store(part, "run", number)
    before, versions = actual(state.current(spark)), Manifest(spark, state.base).versions()
    state.store(parts[2], "run", 2)
    assert Manifest(spark, state.base).versions() == versions
    # the same files in a stream with a checkpoint of its own: facts are a set
    state.store(parts[2], "other", 0)
    assert actual(state.current(spark)) == before


def test_only_touched_entities_are_written(spark, tmp_path, parts):
    state = _state(tmp_path)
    state.store(_union(parts), "run", 0)
    one = _union(parts).where("crosswalks is not null").limit(1)
    commit = state.store(one, "run", 1)
    manifest = Manifest(spark, state.base)
    rows = spark.read.schema(linked.TOUCHED).parquet(manifest.absolute(commit.datasets["touched"][-1]))
    assert 0 < rows.count() < manifest.dataset("touched", linked.TOUCHED).count() / 2
    nothing = state.store(one.limit(0), "run", 2)
    assert nothing.datasets["entities"] == commit.datasets["entities"]


def test_a_failure_before_the_commit_leaves_the_last_state(spark, tmp_path, parts, monkeypatch):
    state = _state(tmp_path)
    state.store(parts[0], "run", 0)
    state.store(parts[2], "run", 1)
    before = actual(state.current(spark))
    monkeypatch.setattr(Manifest, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        state.store(parts[3], "run", 2)
    monkeypatch.undo()
    assert actual(state.current(spark)) == before and Manifest(spark, state.base).orphans()
    state.store(parts[3], "run", 2)
    want = _batch([parts[0], parts[2], parts[3]]).dropDuplicates()
    assert actual(state.current(spark).dropDuplicates()) == actual(want)


def test_published_datasets_appear_together(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "base"))
    first = publish(manifest, 1, {"a": _numbers(spark, 1, 2), "b": _numbers(spark, 3)})
    assert first.notes == {"rows": {"a": 2, "b": 1}}
    broken = _numbers(spark, 4).select(F.raise_error(F.lit("lost")).cast("long").alias("n"))
    with pytest.raises(PySparkException):
        publish(manifest, 2, {"a": _numbers(spark, 5), "b": broken})
    schema = broken.schema
    assert manifest.versions() == [1] and len(manifest.orphans()) >= 1
    assert sorted(r.n for r in manifest.dataset("a", schema).collect()) == [1, 2]
    publish(manifest, 2, {"a": _numbers(spark, 5)})
    publish(manifest, 2, {"a": _numbers(spark, 5, 6)})  # stands already
    assert [r.n for r in manifest.dataset("a", schema).collect()] == [5]
    assert [r.n for r in manifest.dataset("b", schema).collect()] == [3]
    assert sorted(r.n for r in manifest.dataset("a", schema, manifest.read(1)).collect()) == [1, 2]


def _pivoted(events):
    """The plain way: live values by key, then the largest per name."""
    counts = Counter()
    for key, name, value, change in events:
        label = (name or "").strip().lower()
        counts[key, label, value if label in ("a", "b") else None] += change
    out = {}
    for (key, label, value), count in counts.items():
        if count <= 0:
            continue
        row = out.setdefault(key, {"a": None, "b": None})
        if label in row and value is not None:
            row[label] = max(row[label] or "", value)
    return sorted(((k, r["a"], r["b"]) for k, r in out.items()), key=repr)


def test_pivot_with_withdrawals_equals_the_plain_way_after_every_batch(spark, tmp_path):
    rng = random.Random(3)
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["A", "b"], buckets=2, compact_every=3)
    said = []
    for number in range(5):
        batch = [
            (rng.choice(["x", "y", "z", None]), rng.choice(["a", " A ", "b", "other", None]),
             rng.choice(["1", "5", "9", "10", None]), rng.choice([1, 1, -1]))
            for _ in range(rng.choice([0, 12, 25]) if number else 20)
        ]
        said += batch
        frame = spark.createDataFrame(batch, "k string, name string, value string, change int")
        for _ in range(2):
            state.store(frame, number)
        assert sorted((tuple(r) for r in state.current(spark).collect()), key=repr) == _pivoted(said)


def test_names_of_the_state_are_refused_as_keys(tmp_path):
    with pytest.raises(ValueError):
        PivotState(str(tmp_path), ["value"], ["A"])


def test_archiver_moves_what_is_committed_and_can_be_run_again(spark, tmp_path):
    landing, checkpoint, archive = (str(tmp_path / n) for n in ("landing", "checkpoint", "archive"))
    docs = spark.createDataFrame([(f"entities/{i}",) for i in range(8)], "uri string")

    def states():
        found = archive_state(spark, landing, archive, checkpoint).collect()
        return sorted((r.batch, r.state) for r in found)

    def run():
        stream = document_stream(spark, landing, docs.schema, chunk_size=2, layout="lines")
        append_available(stream, str(tmp_path / "target"), checkpoint)

    assert archive_consumed(spark, landing, archive, checkpoint) == 0  # nothing has run yet
    docs.repartition(4, "uri").write.json(landing)
    count = len(list((tmp_path / "landing").glob("*.json")))
    run()
    batches = (count + 1) // 2
    assert [b for b, _ in states()] == sorted([i // 2 for i in range(count)])
    forget_last_commit(spark, checkpoint)
    assert archive_consumed(spark, landing, archive, checkpoint) == 2 * (batches - 1)
    run()
    assert {s for b, s in states() if b < batches - 1} == {ARCHIVED}
    assert {s for b, s in states() if b == batches - 1} == {WAITING}
    archive_consumed(spark, landing, archive, checkpoint)
    assert archive_consumed(spark, landing, archive, checkpoint) == 0
    assert {s for _, s in states()} == {ARCHIVED}
    assert sorted(r.uri for r in spark.read.json(archive).collect()) == sorted(r.uri for r in docs.collect())
    next((tmp_path / "archive").glob("*.json")).unlink()
    assert [s for _, s in states()].count(MISSING) == 1


def test_landing_files_are_taken_once_and_packed(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "base")
    landing.mkdir()

    def land(*numbers):
        for n in numbers:
            (landing / f"f{n:02}.json").write_text("".join(f'{{"n": {n}, "i": {i}}}\n' for i in range(50)))

    def rows():
        folders = compacted_folders(spark, base)
        found = spark.read.schema("n int, i int").json(folders).collect()
        return sorted((r.n, r.i) for r in found)

    (landing / "empty.json").write_text("")
    assert compact_landing(spark, str(landing), base) is None and compacted_folders(spark, base) == []
    land(*range(10))
    size = (landing / "f00.json").stat().st_size
    first = compact_landing(spark, str(landing), base, target_bytes=3 * size, page=100)
    assert first.notes == {"taken": 10, "bytes": 10 * size, "written": 4}
    files = list((tmp_path / "base" / first.datasets["documents"][0]).glob("part-*"))
    assert len(files) == 4
    assert compact_landing(spark, str(landing), base).version == first.version
    land(*range(10, 15))
    last = compact_landing(spark, str(landing), base, page=2)
    assert [Manifest(spark, base).read(v).notes["taken"] for v in (1, 2, 3)] == [2, 2, 1]
    assert last.version == 3 and rows() == [(n, i) for n in range(15) for i in range(50)]


def test_state_of_a_pivot_holds_keys_once_and_no_working_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_local_folder", lambda: str(tmp_path / "shared"))
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["a"], buckets=2)
    for number, change in enumerate((1, -1, 1)):
        rows = [(k, "a", str(number // 2), change) for k in ("x", None)]
        state.store(spark.createDataFrame(rows, "k string, name string, value string, change int"), number)
    assert sorted(tuple(r) for r in state.current(spark).fillna("-").collect()) == [("-", "1"), ("x", "1")]
    for name, columns in (("changes", state.changes), ("maxima", state.maxima)):
        folder = tmp_path / "pivot" / "data" / name
        assert sorted(spark.read.parquet(str(folder)).columns) == sorted([*columns.names, "_part"])
        assert "id" not in columns.names
    assert list((tmp_path / "shared").rglob("*.parquet")) == []


def test_links_of_entities_are_shuffled_once_and_may_be_repeated(spark, tmp_path):
    state = EntityState(str(tmp_path), ["attributes.Name"], ["Name"], "attributes.ReferenceId")
    docs = customer_documents(spark, DATA).unionByName(crosswalk_documents(spark, DATA))
    facts = staged(state.facts(docs), "facts")
    once = state.linked(facts)
    assert actual(state.linked(facts.unionByName(facts))) == actual(once) and once.count() > 0
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[uri#\d+, sourceid#", plan) is None


@pytest.mark.parametrize("crowded", [upkeep.CROWDED, 0])
def test_small_and_large_batches_on_a_pivot_equal_the_plain_way(spark, tmp_path, monkeypatch, crowded):
    monkeypatch.setattr(upkeep, "CROWDED", crowded)
    monkeypatch.setattr(upkeep, "PLACES", 8)
    rng = random.Random(7)
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["A", "b"], buckets=2, compact_every=6)
    said, plain = [], []
    for number, size in enumerate((90, 4, 5, 40, 3, 4, 3)):
        batch = [
            (rng.choice([f"k{i}" for i in range(40)] + [None]), rng.choice(["a", "A ", "b", "other", None]),
             rng.choice(["1", "5", "10", "", None]), rng.choice([1, 1, 1, -1, -1, 2]))
            for _ in range(size)
        ]
        said += batch
        frame = spark.createDataFrame(batch, "k string, name string, value string, change int")
        plain.append(state.store(frame, number).notes["plain"])
        assert sorted((tuple(r) for r in state.current(spark).collect()), key=repr) == _pivoted(said)
    assert plain == [True, False, False, True, False, True, False]


def test_a_pivot_stores_a_row_per_key_which_a_large_batch_replaces(spark, tmp_path):
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["a", "b"], buckets=2)
    rows = [(f"k{i}", name, str(i), 1) for i in range(30) for name in ("a", "b")]
    gone = [(k, name, value, -1) for k, name, value, _ in rows[:20]]
    few = [("k25", "a", "99", 1)]
    manifest, counts = Manifest(spark, state.base), []
    for number, batch in enumerate((rows, gone, few)):
        commit = state.store(spark.createDataFrame(batch, "k string, name string, value string, change int"), number)
        counts.append(manifest.dataset("maxima", state.maxima, commit).count())
    assert counts == [30, 20, 21]  # keys without a value go, a small batch writes its keys alone
    assert {r.k: r.a for r in state.current(spark).collect()} == {
        f"k{i}": "99" if i == 25 else str(i) for i in range(10, 30)
    }


def test_a_batch_meets_the_rows_of_a_pivot_in_one_shuffle(spark, tmp_path):
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["a", "b"], buckets=2)
    batch = spark.createDataFrame([("x", "a", "1", 1)], "k string, name string, value string, change int")
    commit = state.store(batch, 0)
    manifest = Manifest(spark, state.base)
    fresh = state._placed(manifest.dataset("changes", state.changes, commit))
    rows = state._rows(state._merged(manifest.dataset("maxima", state.maxima, commit), fresh), 1, True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange ", plan)) == 1
    assert "Exchange" not in state.current(spark)._jdf.queryExecution().executedPlan().toString()


def test_changes_of_a_pivot_are_neither_shuffled_nor_sorted_before_they_are_stored(spark, tmp_path):
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["a"], buckets=2, compact_every=2)
    batch = spark.createDataFrame([(f"k{i}", "a", "1", 1) for i in range(20)], "k string, name string, value string, change int")
    plan = state._said(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    folder = tmp_path / "pivot" / "data" / "changes"
    state.store(batch, 0)
    assert not list(folder.rglob("bucket=*")) and spark.read.parquet(str(folder)).count() == 20
    commit = state.store(batch, 1)
    for file in (tmp_path / "pivot" / commit.datasets["changes"][0]).glob("*.parquet"):
        buckets = [r.bucket for r in spark.read.parquet(str(file)).collect()]
        assert buckets == sorted(buckets)
    assert state.current(spark).count() == 20


def test_a_pivot_in_an_earlier_layout_is_refused(spark, tmp_path):
    state = PivotState(str(tmp_path / "pivot"), ["k"], ["a"], buckets=2)
    Manifest(spark, state.base).commit(0, {"changes": [], "maxima": []})
    with pytest.raises(ValueError):
        state.current(spark)


def _odd_documents(spark):
    """Attributes and links with URIs of too few parts, and links that no attribute has."""
    schema = (
        "uri string, attributes struct<Name: array<struct<uri: string, value: string>>,"
        " ReferenceId: array<struct<uri: string, value: string>>>,"
        " crosswalks array<struct<attributes: array<string>, type: string, uri: string, value: string>>"
    )
    name, other = "entities/{}/attributes/Name/n", "entities/{}/attributes/Other/o"
    rows = [
        (f"entities/{e}", ([(name.format(e), f"N{e}"), ("entities/7", "short"), (None, "lost")],
                           [(f"entities/{e}/attributes/ReferenceId/r", f"R{e}")]),
         [([name.format(e), other.format(e), "entities/7", None], "t/s/S", f"entities/{e}/crosswalks/c", f"V{e}")])
        for e in range(5, 9)
    ]
    return spark.createDataFrame(rows, schema)


def test_links_that_meet_no_attribute_are_left_out_before_the_shuffle(spark, tmp_path):
    docs = _odd_documents(spark)
    state = EntityState(str(tmp_path), ["attributes.Name"], ["Name"], REFERENCE, buckets=2)
    facts = staged(state.facts(docs), "facts")
    links = state._promising(facts, None)
    assert {r.uri for r in links.collect()} == {"entities/7", *[f"entities/{e}/attributes/Name/n" for e in range(5, 9)]}
    touched = facts.where("entity = '8'").select("entity", "bucket").distinct()
    assert [r.uri for r in state._promising(facts, touched).collect()] == ["entities/8/attributes/Name/n"]
    assert state._promising(facts.where("kind = 'listed'"), None).count() == 0
    # crosswalks alone, then a part of the attributes, then all
    for number, part in enumerate((docs.drop("attributes"), docs.where("uri = 'entities/8'"), docs)):
        state.store(part, "run", number)
        want = entity_wide(docs.where("uri = 'entities/8'") if number == 1 else docs, ["attributes.Name"], ["Name"],
                           REFERENCE)
        found = state.current(spark).where("EntityID = '8'" if number == 1 else "true")
        if number:
            want = want.where("EntityID = '8'" if number == 1 else "true")
            assert actual(found.dropDuplicates()) == actual(want.dropDuplicates()) and found.count() > 0
        else:
            assert found.count() == 0


def test_a_batch_of_documents_leaves_no_working_tables(spark, tmp_path, parts, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path / "shared"))
    state = _state(tmp_path)
    state.store(parts[1], "run", 0)
    state.store(parts[2], "run", 1)
    state.store(parts[2].limit(0), "run", 2)
    assert state.current(spark).count() > 0
    assert (tmp_path / "shared").exists() and list((tmp_path / "shared").rglob("*.parquet")) == []


def test_documents_of_the_stream_land_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: str(tmp_path))
    assert streamed_entities(spark, DATA).count() > 0
    landed = [f.name for f in tmp_path.rglob("landing-*/part-*")]
    assert len(landed) == 6 and all(n.endswith(".json.lz4") for n in landed)
