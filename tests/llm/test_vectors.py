"""Whitening and hard negatives against plain numpy and brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from entitylake.llm import hard_negatives, whitening

from llm_fixtures import DATA, shipped  # noqa: F401

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        # names that operators use for results or in between
        T.StructField("row", T.StringType()),
        T.StructField("numbers", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)


@pytest.fixture
def vectors(spark):
    def make(rows):
        full = [(k, None if v is None else list(v), l, "r", "n", "s", "k") for k, v, l in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


def _floats(values):
    return [float(np.float32(v)) for v in values]


def _clean(rows):
    return [
        (k, v, l) for k, v, l in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]


# --- whitening ---------------------------------------------------------------------------------


def _whitened(frame, components=8, **options):
    data = whitening.vectors(frame, "vec_id", "embedding")
    model = whitening.fit(data, components, **options)
    rows = whitening.whiten(data, model, "vec_id")
    return model, {r["vec_id"]: r for r in rows.collect()}, rows


def _expected(rows, components=8):
    x = np.array([[math.floor(1024 * e) + 100_000 for e in v] for _, v, _ in rows])
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    deviations = [sum(int(d) ** 2 for d in n * r.astype(object) - sums) for r in x]
    return values, centred @ turned / np.sqrt(values), deviations, np.trace(centred.T @ centred) / n


def _same_up_to_sign(got, want, tolerance=1e-9):
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < tolerance


def test_whitening_equals_a_dense_decomposition(vectors):
    rng = np.random.default_rng(1)
    spread = rng.standard_normal((300, 12)) * np.linspace(3, 0.5, 12)
    rows = [(i, _floats(v), 0) for i, v in enumerate(spread + 0.7)]
    model, found, frame = _whitened(vectors(rows))
    values, want, deviations, total = _expected(rows)
    assert model.rows == 300 and model.steps == 12
    assert np.allclose(model.variances, values, rtol=1e-12)
    assert np.allclose(model.explained, values / total, rtol=1e-12)
    _same_up_to_sign(np.array([found[i]["whitened"] for i in range(300)]), want)
    assert [found[i]["deviation"] for i in range(300)] == deviations
    assert whitening.identity_error(frame, 8) < 1e-9


def test_whitening_leaves_unusable_rows_out_and_counts_repeated_ones(vectors):
    rng = np.random.default_rng(2)
    good = [(i, _floats(rng.standard_normal(5)), None) for i in range(40)]
    good += good[:7] + [(None, good[3][1], 1)]
    bad = [(100, None, 0), (101, [1.0, None, 2.0, 3.0, 4.0], 0), (102, [float("nan")] * 5, 0),
           (103, [1.0, float("-inf"), 0.0, 0.0, 0.0], 0), (104, [1.0], 0), (105, [], 0)]
    model, found, frame = _whitened(vectors(good + bad))
    values, _, _, _ = _expected(good)
    assert model.rows == 48 and frame.count() == 48 and set(found) == {*range(40), None}
    assert len(model.variances) == 5 and np.allclose(model.variances, values[:5], rtol=1e-12)


def test_components_that_share_a_variance_are_all_found(vectors):
    # four orthogonal directions of the same variance, two of another, none along the last two
    points = []
    for axis, size in enumerate([4, 4, 4, 4, 2, 2, 0, 0]):
        for sign in (1, -1):
            points.append([size * sign * (a == axis) for a in range(8)])
    rows = [(i, _floats(p), 0) for i, p in enumerate(points)]
    model, found, frame = _whitened(vectors(rows))
    assert len(model.variances) == 6
    assert np.allclose(model.variances, [2 * 4096**2 / 16] * 4 + [2 * 2048**2 / 16] * 2)
    assert whitening.identity_error(frame, 6) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [0.1, 0.2], 0)] * 9, [(1, [], 0)], [(1, None, 0)]])
def test_tables_without_variance_have_no_components(vectors, rows):
    model, _, frame = _whitened(vectors(rows))
    kept = [r for r in rows if r[1] is not None]
    assert len(model.variances) == 0 and frame.count() == len(kept)
    assert whitening.component_rows(frame, model, "vec_id").count() == 0
    assert whitening.identity_error(frame, 0) == 0.0


def test_fewer_steps_with_a_tolerance(vectors):
    rng = np.random.default_rng(3)
    scale = np.concatenate([[9, 7, 5], np.full(37, 0.1)])
    rows = [(i, _floats(v), 0) for i, v in enumerate(rng.standard_normal((200, 40)) * scale)]
    model, _, _ = _whitened(vectors(rows), components=3, tolerance=1e-12)
    assert model.steps < 40
    assert np.allclose(model.variances, _expected(rows, 3)[0], rtol=1e-10)


def test_distances_beyond_64_bits_are_missing_and_large_ones_exact():
    x = np.array([[3_000_000, 5], [0, 0]])
    sums = np.array([3_000_000, 5], object)
    near, far = (whitening._distances(x, n, sums) for n in (2, 10_000))
    assert near == [(3_000_000) ** 2 + 25, (3_000_000) ** 2 + 25]
    assert far == [None, 3_000_000**2 + 25]


def test_whitening_query_on_test_data(spark):
    rows = entry.queries()["op11_lanczos_whitening"](spark, DATA).collect()
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    source = _clean([(r["vec_id"], r["embedding"], 0) for r in table])
    values, want, deviations, total = _expected(source)
    at = {k: i for i, (k, _, _) in enumerate(source)}
    got = np.full(want.shape, np.nan)
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviations[at[r["vec_id"]]] and r["n"] == len(source)
        assert abs(r["explained"] - values[r["component"] - 1] / total) < 1e-12
        assert r["identity_error"] < 1e-9
    _same_up_to_sign(got, want)


# --- hard negatives ----------------------------------------------------------------------------


def _mined_plainly(rows, is_anchor, low=80, high=100, most=5):
    known = [
        (k, [math.floor(256 * x) for x in v], l)
        for k, v, l in _clean(rows) if k is not None and l is not None
    ]
    longest = max((len(v) for _, v, _ in known), default=0)
    known = [(k, v + [0] * (longest - len(v)), l) for k, v, l in known]
    out = []
    for a, (key, vector, label) in enumerate(known):
        if not is_anchor(key):
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v)), k, l) for b, (k, v, l) in enumerate(known) if b != a
        ]
        positives = sorted((s, k) for s, k, l in scored if l == label)[:most]
        for score, positive in positives:
            inside = sorted(
                (s, k) for s, k, l in scored
                if l != label and low * -score <= 100 * -s <= high * -score
            )
            out += [(key, positive, r, k, -score, -s) for r, (s, k) in enumerate(inside[:most], 1)]
    return sorted(out)


def _mined(frame, anchors, **options):
    rows = hard_negatives.mined(frame, "vec_id", "embedding", "label", anchors, **options)
    assert rows.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(tuple(r) for r in rows.collect())


def test_negatives_equal_brute_force(vectors):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((4, 20))
    rows = []
    for i in range(900):
        near = centres[i % 4] + rng.standard_normal(20) * 0.8
        rows.append((i, _floats(near / np.linalg.norm(near)), int(rng.integers(0, 3))))
    want = _mined_plainly(rows, lambda k: k % 50 == 0)
    assert len(want) > 300
    # many small cells, few large ones, and groups of anchors give the same rows
    for options in ({"cell_bytes": 2_000}, {}, {"tasks": 200}):
        assert _mined(vectors(rows), F.col("vec_id") % 50 == 0, **options) == want


def test_copies_of_rows_and_anchors_are_balanced():
    assert hard_negatives._grid(0, 0, 1, 0.0) == (1, 1)
    assert hard_negatives._grid(51_282, 513, 12, 0.1) == (12, 1)
    cells, groups = hard_negatives._grid(75_000_000, 750_000, 4_000, 143.05)
    assert cells * groups >= 4_000 and cells >= 144
    assert 75_000_000 * groups + 750_000 * cells < 14 * 75_000_000
    assert hard_negatives._grid(900, 18, 200, 0.0)[1] == 2


def test_negatives_of_ties_repeats_and_unusable_rows(vectors):
    rng = np.random.default_rng(5)
    rows = [(i, _floats(rng.integers(-2, 3, 4) / 2), int(i % 3)) for i in range(150)]
    rows += [(10, rows[10][1], rows[10][2])] * 3  # an anchor that occurs four times
    rows += [(20, [0.5, 0.5, 1.0, 1.0], 1), (30, [1.0], 0), (None, [1.0] * 4, 1), (40, [1.0] * 4, None),
             (50, None, 1), (60, [float("inf"), 0.0, 0.0, 0.0], 1), (70, [1.0, None, 0.0, 0.0], 1), (80, [], 2)]
    want = _mined_plainly(rows, lambda k: k % 10 == 0)
    assert _mined(vectors(rows), F.col("vec_id") % 10 == 0) == want
    narrow = _mined_plainly(rows, lambda k: k % 10 == 0, low=95, high=99, most=2)
    options = {"low": 95, "high": 99, "positives": 2, "negatives": 2}
    assert _mined(vectors(rows), F.col("vec_id") % 10 == 0, **options) == narrow


def test_a_vector_that_a_third_of_the_rows_share(vectors):
    rng = np.random.default_rng(6)
    same = _floats(rng.standard_normal(8))
    rows = [(i, same if i % 3 == 0 else _floats(rng.standard_normal(8)), i % 4) for i in range(1_200)]
    assert _mined(vectors(rows), F.col("vec_id") % 100 == 0) == _mined_plainly(
        rows, lambda k: k % 100 == 0
    )


def test_no_rows_no_anchors_and_one_label_give_nothing(vectors):
    rows = [(i, [1.0, float(i)], 0) for i in range(5)]
    every = F.lit(True)
    assert _mined(vectors([]), every) == []
    assert _mined(vectors(rows), F.lit(None).cast("boolean")) == []
    assert _mined(vectors(rows), every) == []


def test_large_numbers_are_scored_exactly(vectors):
    rng = np.random.default_rng(7)
    rows = [(i, _floats(rng.standard_normal(6) * 4_000), i % 2) for i in range(80)]
    assert _mined(vectors(rows), F.col("vec_id") % 10 == 0) == _mined_plainly(
        rows, lambda k: k % 10 == 0
    )


def test_the_index_leaves_dimensions_out_and_loses_nothing():
    rng = np.random.default_rng(8)
    heavy_first = rng.standard_normal((500, 64)) * np.geomspace(200, 1, 64)
    numbers = np.floor(heavy_first).astype("<i2")
    batch = pa.RecordBatch.from_pydict(
        {
            "row": np.arange(500), "key": np.arange(500), "label": np.zeros(500, np.int64),
            "numbers": pa.array([r.tobytes() for r in numbers], pa.binary()),
        }
    )
    index = hard_negatives.Index([batch], 64, "<i2")
    anchors = numbers[:16].astype(np.int64)
    rest = hard_negatives._suffix_norms(anchors[:, index.by_weight], index.cuts)
    assert index.cuts[index._indexed(rest, [None] * 16)] <= 32
    whole = anchors @ numbers.astype(np.int64).T
    asked = pa.RecordBatch.from_arrays(
        [batch.column(n).slice(0, 16) for n in ("row", "key", "label", "numbers")]
        + [pa.array([[]] * 16, pa.list_(pa.int64()))] * 2,
        names=["row", "key", "label", "numbers", "lows", "highs"],
    )
    found = index.search(asked, 3).to_pylist()
    for a in range(16):
        order = [k for k in np.lexsort((np.arange(500), -whole[a])) if k != a][:3]
        assert [(r["found_key"], r["score"]) for r in found if r["row"] == a] == [
            (k, whole[a, k]) for k in order
        ]
