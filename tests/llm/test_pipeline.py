"""The pipeline against brute force: rows without an id and ids that several texts share."""

from collections import Counter

import corpus_pipeline
import pytest

from llm_fixtures import docs, shipped  # noqa: F401
from test_dedup import _components, _near_rows, _sets
from test_tokens import _pieces


def _squeezed(text):
    return "".join((text or "").split(" "))


def _exact(rows):
    """Of equal texts the longest, of these the smallest id, a missing one last."""
    best = {}
    for key, text in sorted(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0)):
        best.setdefault(_squeezed(text), (key, text))
    return list(best.values())


def _near(rows):
    """Of each group of near copies the smallest id, a missing one last."""
    labels = _components(_sets(list(enumerate(t for _, t in rows)), 5), 80)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(labels[i], []).append((key is None, key or 0, i))
    return [rows[min(g)[2]] for g in groups.values()]


EXACT = [
    (None, "one"), (None, "two"), (None, "three words here"), (5, "shared"), (5, "by other"),
    (5, "copied"), (None, "copied"), (None, "copied "), (6, "a b"), (6, "a  b"), (7, "a b"),
    (None, "spaced out"), (None, "spaced  out"), (8, "again"), (8, "again"), (None, "again"),
]


def _near_cases():
    texts = [t for _, t in _near_rows() if t and t.strip()]
    # every third without an id, ids shared by seven texts; unlike texts without an id as well
    rows = [(None if i % 3 == 0 else i // 7, t) for i, t in enumerate(texts)]
    return _exact([(key, " ".join(t.split())) for key, t in rows])


def _got(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_exact_stage(spark, docs):
    df = docs([(k, t, "en") for k, t in EXACT])
    got = corpus_pipeline.exact(spark, df, "")
    assert got.columns == df.columns
    assert _got(got) == Counter(_exact(EXACT))


def test_near_stage(spark, docs):
    rows = _near_cases()
    df = docs([(k, t, "en") for k, t in rows])
    got = corpus_pipeline.near(spark, df, "")
    assert got.columns == df.columns
    found, want = _got(got), _near(rows)
    # of a group's texts that share the smallest id either may stay
    assert sorted((k is None, k or 0) for k, _ in found) == sorted((k is None, k or 0) for k, _ in want)
    assert len(_near([*found])) == len(want) and set(found.values()) == {1}


@pytest.mark.parametrize("stage", ["exact", "near"])
def test_stages_of_nothing(spark, docs, stage):
    assert getattr(corpus_pipeline, stage)(spark, docs([]), "").count() == 0


def test_whole_pipeline(spark, docs, tmp_path):
    rows = [*EXACT, (None, "1 2 3"), (9, None), (10, "")]
    docs([(k, t, "en") for k, t in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = _pieces(_near(_exact(EXACT)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
