"""Exact and near deduplication against brute force."""

import hashlib
import os
import random
import re

import numpy as np
import pytest

from entitylake.llm import exact_dedup, near_dedup, queries
from entitylake.llm.components import components

from llm_fixtures import DATA, docs, shipped  # noqa: F401


def _keepers(rows):
    groups = {}
    for key, text in rows:
        text = text or ""
        norm = re.sub(r"[\x20\x09-\x0D]", "", text)
        groups.setdefault(norm, []).append((-len(text), key is None, key if key is not None else 0))
    return {n: (min(g)[2] if not min(g)[1] else None, len(g)) for n, g in groups.items()}


def _expect_exact(rows):
    """One row of a group is kept: the longest, of these the one with the smallest id, of these any."""
    best, out, chosen = _keepers(rows), [], set()
    for key, text in sorted(rows, key=lambda r: -len(r[1] or "")):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep, size = best[norm]
        digest = hashlib.sha256(norm.encode()).hexdigest()
        kept = key == keep and norm not in chosen
        chosen |= {norm} if kept else set()
        out.append((key, keep, size, kept, digest))
    return sorted(out, key=repr)


CASES = [
    (1, "a b c"), (2, "abc"), (3, "a  bc\n"), (4, None), (5, ""), (6, " \t\x0b"), (7, "a\xa0bc"),
    (None, "abc    "), (8, "ü" * 50_000), (9, "ü" * 50_000), (9, "ü" * 50_000), (10, "A b c"),
    (2**60 + 1, "big"), (2**60, "big"), (11, "\x1cabc"),
    (20, "s p"), (20, "s  p "), (20, "sp"), (None, "no id"), (None, "no  id"), (None, "noid"),
    (21, "same"), (21, "same"), (21, "same"),
]


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 900])
def test_exact_duplicates(docs, table_bytes):
    df = docs([(k, t, "en") for k, t in CASES])
    got = exact_dedup.exact_duplicates(df, table_bytes=table_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == _expect_exact(CASES)


def test_exact_duplicates_of_nothing(docs):
    assert exact_dedup.exact_duplicates(docs([])).count() == 0


def test_grace_spills_and_cleans_up(tmp_path):
    random.seed(1)
    contents = [bytes([random.randrange(256)]) * random.randint(1, 400) for _ in range(3_000)]
    records = [
        (hashlib.sha256(c).digest(), c, (-i % 7, False, i), 1) for i, c in enumerate(contents)
    ]
    got = {e[1]: (e[2], e[3]) for e in exact_dedup.grace(iter(records), 5_000, str(tmp_path))}
    want = {}
    for _, content, best, n in records:
        old = want.get(content, (best, 0))
        want[content] = (min(old[0], best), old[1] + n)
    assert got == want
    assert os.listdir(tmp_path) == []


def test_table_compares_contents():
    table = exact_dedup.OpenTable()
    for content in (b"one", b"two", b"one"):
        table.add(b"\0" * 32, content, (0, False, 1), 1)
    assert [(e[1], e[3]) for e in table.entries] == [(b"one", 2), (b"two", 1)]


def _sets(rows, words):
    out = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        n = max(1, len(w) - words + 1)
        out[key] = {tuple(w[i : i + words]) for i in range(n)} if w else set()
    return out


def _components(sets, percent):
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def _near_rows():
    """Chains, a crowd of near copies about the threshold, exact copies, short and empty texts."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):  # edits of one original, few or many
        text = base.copy()
        for _ in range(rnd.randint(0, 9)):
            text[rnd.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    chain = [word() for _ in range(150)]
    for i in range(200, 215):  # each links to the next, the ends do not
        chain = chain.copy()
        chain[(i * 17) % 150] = word()
        rows.append((i, " ".join(chain).upper() if i % 2 else " ".join(chain)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE  two"), (305, "one")]
    rows += [(306, "Ä b c d e f"), (307, "ä b c d e f"), (308, "x y z"), (309, "x y z")]
    rows += [(i, " ".join(word() for _ in range(rnd.randint(3, 200)))) for i in range(400, 440)]
    return rows


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, words, percent):
    rows = _near_rows()
    got = near_dedup.near_duplicates(docs([(k, t, "en") for k, t in rows]), words=words, percent=percent)
    sets = _sets(rows, words)
    want = _components(sets, percent)
    for r in got.collect():
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id
        )


def test_blocks_lose_no_link(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = _near_rows()
    got = near_dedup.near_duplicates(docs([(k, t, "en") for k, t in rows]), words=3, percent=85)
    want = _components(_sets(rows, 3), 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_near_duplicates_of_few(docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0
    rows = near_dedup.near_duplicates(docs([None, ""])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == [
        (0, 0, 0, True), (1, 0, 1, True)
    ]


def test_rows_repeated_or_without_id(docs):
    text = "a b c d e f g h"
    rows = near_dedup.near_duplicates(docs([(7, text, "en"), (7, text, "en"), (None, text, "en")]))
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows.collect()) == [
        (-1, 7, False), (7, 7, True), (7, 7, True)
    ]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for shared in (950, 900, 800):
        hashes = rng.integers(0, 2**63, 2_000 - shared, np.uint64)
        left, right = np.sort(hashes[:1_000]), np.sort(hashes[-1_000:])
        a, b = (near_dedup.odd_sketch(near_dedup.minhashes(s)) for s in (left, right))
        bits = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
        j = shared / (2_000 - shared)
        n = near_dedup.SKETCH_BITS
        apart = -n / 2 * np.log(1 - 2 * bits / n)
        assert abs(1 - apart / 2 / near_dedup.SAMPLES - j) < 0.07
        assert bits <= near_dedup.most_apart(j)


@pytest.mark.parametrize("size", [3, 200, 1_000, 1_200])
def test_parity_refuses_no_link(size):
    rng = np.random.default_rng(size)
    for differing in range(0, size, 1 + size // 40):
        hashes = rng.integers(0, 2**63, size + differing, np.uint64)
        left, right = np.unique(hashes[:size]), np.unique(hashes[differing:])
        a, b = near_dedup.set_parity(left), near_dedup.set_parity(right)
        assert int(np.bitwise_count((a ^ b).view(np.uint64)).sum()) <= len(np.setxor1d(left, right))


def test_large_sets_meet_small_ones(docs):
    """Sets below, at and above the sizes where one kind of sketch gives way to the other."""
    rnd = random.Random(12)
    long = [f"w{rnd.randrange(10**6)}" for _ in range(1_700)]
    rows = [(i, " ".join(long[:n])) for i, n in enumerate([900, 1_020, 1_026, 1_030, 1_100, 1_282, 1_290, 1_500])]
    rows += [(i, " ".join(long[j:][:n])) for i, (j, n) in enumerate([(300, 1_100), (30, 1_300), (9, 1_690)], 20)]
    got = near_dedup.near_duplicates(docs([(k, t, "en") for k, t in rows]), words=3, percent=85)
    assert {r.doc_id: r.component_id for r in got.collect()} == _components(_sets(rows, 3), 85)


def _crowd(n):
    """Copies of one text with as many words of their own that no two are linked, though nearly."""
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for key in range(n):
        text = base.copy()
        for at in range(key % 43, 300, 43):
            text[at] = f"x{rnd.randrange(10**6)}"
        rows.append((key, " ".join(text)))
    return rows


def test_pairs_that_are_surely_apart_are_no_candidates(docs, monkeypatch):
    rows, counts, confirmed = _crowd(120), [], near_dedup._confirmed

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_confirmed", counted)
    got = near_dedup.near_duplicates(docs([(k, t, "en") for k, t in rows]), words=3, percent=85)
    want = _components(_sets(rows, 3), 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert sum(counts) < 2 * len(rows)


def test_texts_without_candidates_stay_where_they_are(docs, spark, monkeypatch):
    texts = docs([f"text {i}" for i in range(5_000)]).selectExpr("doc_id as id", "text")
    ids = spark.range(0, 5_000, 100)
    found = near_dedup._with_ids(texts, ids)
    assert sorted(r.id for r in found.collect()) == list(range(0, 5_000, 100))
    passed, joined = [], near_dedup.even_join
    monkeypatch.setattr(
        near_dedup, "even_join", lambda left, *rest: passed.append(left.count()) or joined(left, *rest)
    )
    near_dedup._with_ids(texts, ids)
    assert 50 <= passed[0] < 1_000


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_sketch_margin_in_deviations(threshold):
    """Ideal samples of pairs at the threshold: the filter is more than five deviations away."""
    rng = np.random.default_rng(4)
    differing = rng.binomial(near_dedup.SAMPLES, 1 - threshold, 20_000)
    bits = [
        int((np.bincount(rng.integers(0, near_dedup.SKETCH_BITS, 2 * d)) & 1).sum()) for d in differing
    ]
    assert near_dedup.most_apart(threshold) > np.mean(bits) + 5 * np.std(bits)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100
    }


def test_queries_on_the_smallest_tables(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    got = queries.op10_exact_dedup(spark, DATA).collect()
    assert sorted(map(tuple, got), key=repr) == _expect_exact(rows)
    want = _components(_sets(rows, 3), 85)
    near = queries.op5_minhash_near_dedup(spark, DATA).collect()
    assert {r.doc_id: r.component_id for r in near} == want
