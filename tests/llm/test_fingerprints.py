"""Order MinHash against a plain Python version."""

import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from entitylake.llm import order_minhash

from llm_fixtures import DATA, docs, shipped  # noqa: F401


def _signed(number):
    return number - (1 << 64) if number >= 1 << 63 else number


def _hashed(*values):
    """Spark's 64-bit hash: each value is hashed with the hash before it as the seed."""
    seed = 42
    for kind, value in values:
        data = value.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", value)
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return _signed(seed)


def _signature(text, words=3, components=64, picked=2):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not found:
        return [0] * components
    hashes = [_hashed(("s", w)) for w in found]
    seen, buckets = {}, {}
    for place in range(max(len(found) - words + 1, 1)):
        kmer = _hashed(*[("l", h) for h in hashes[place : place + words]])
        kmer = _signed(((kmer << 30) & (1 << 64) - 1)) >> 30  # 34 bits of it
        number = seen[kmer] = seen.get(kmer, -1) + 1
        order = _signed((_hashed(("l", kmer), ("i", number)) << 30) & (1 << 64) - 1) >> 30
        bucket = (order & (1 << 34) - 1) >> (34 - components.bit_length() + 1)
        buckets.setdefault(bucket, []).append((order, place))
    out = [0] * components
    for bucket, members in buckets.items():
        chosen = sorted(sorted(members)[:picked], key=lambda m: m[1])
        out[bucket] = max(_hashed(*[("l", order) for order, _ in chosen]) & 0x7FFFFFFF, 1)
    return out


def _like(a, b):
    used = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


PROSE = " ".join(f"w{i * i % 97}" for i in range(400))
TEXTS = [
    None, "", " \n\t", "one", "two words", "three words here", "a b c a b c a b c a b c", "the " * 300,
    PROSE, PROSE.replace("w9 ", "x "), "漢字 だけ 長い", "x" * 200_000, " lead and trail ", "z z y",
]


def test_signatures_equal_the_plain_version(spark, docs):
    rows = order_minhash.fingerprints(docs(TEXTS)).collect()
    assert [r["fingerprint"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [
        _signature(t) for t in TEXTS
    ]
    other = order_minhash.fingerprints(docs(TEXTS), words=1, components=8, picked=3).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in other} == {
        i: _signature(t, 1, 8, 3) for i, t in enumerate(TEXTS)
    }


def test_order_counts_and_not_only_the_words(spark, docs):
    words = [f"w{i}" for i in range(600)]
    swapped = words[300:] + words[:300]
    edits = [words[:i] + ["new"] + words[i + 1 :] for i in (10, 300, 590)]
    few = words[:100] + [f"n{i}" for i in range(30)] + words[130:]
    texts = [" ".join(t) for t in (words, swapped, edits[0], few, [f"m{i}" for i in range(600)])]
    prints = [
        r["fingerprint"]
        for r in sorted(order_minhash.fingerprints(docs(texts)).collect(), key=lambda r: r["doc_id"])
    ]
    likes = [_like(prints[0], p) for p in prints]
    assert likes[2] > 0.9 > likes[3] > likes[1] > likes[4] == 0
    # as sets of 3-word runs the swapped text is nearly the same; half of all pairs change their order
    assert 0.3 < likes[1] < 0.7


def test_likeness_of_empty_and_equal_texts(spark, docs):
    pairs = docs(["", " ", "a b c d", "a  b\nc d", "x y z"])
    prints = order_minhash.fingerprints(pairs).select("doc_id", "fingerprint")
    other = prints.select(F.col("doc_id").alias("o"), F.col("fingerprint").alias("f"))
    rows = prints.join(other, F.col("doc_id") <= F.col("o")).select(
        "doc_id", "o", order_minhash.likeness(F.col("fingerprint"), F.col("f")).alias("l")
    )
    found = {(r["doc_id"], r["o"]): r["l"] for r in rows.collect()}
    alike = {(i, i) for i in range(5)} | {(0, 1), (2, 3)}
    assert found == {p: float(p in alike) for p in found}


def test_following_rows_with_missing_and_repeated_ids(spark, docs):
    rows = [(5, "five", "en"), (None, "none", "en"), (2, None, "en"), (5, "five", "en"), (9, "", "en"),
            (-1, "minus", "en"), (5, "cinq", "en")]
    found = order_minhash.with_following(docs(rows), "doc_id", "text").collect()
    assert len(found) == len(rows)
    ring = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    keys = [k for k, _ in ring]
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found) == sorted(
        (k is not None, k or 0) for k in keys
    )
    follows = {r["text"]: r["next_text"] for r in found if r["doc_id"] != 5}
    assert follows["none"] == "minus" and follows["minus"] == "" and follows[""] in ("none", "five", "cinq")
    assert [r["next_text"] for r in found if r["doc_id"] == 9] == ["none"]
    assert sorted(r["next_text"] for r in found if r["doc_id"] == 5 or r["doc_id"] == 2) == [
        "", "cinq", "five", "five"
    ]


def test_one_row_follows_itself_and_no_row_gives_none(spark, docs):
    assert order_minhash.with_following(docs(["x"]).limit(0), "doc_id", "text").count() == 0
    (only,) = order_minhash.with_following(docs(["x"]), "doc_id", "text").collect()
    assert only["next_text"] == "x" and only["next_fingerprint"] == only["fingerprint"]


def test_query_equals_brute_force(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    ring = sorted((r["doc_id"], r["text"] or "") for r in documents)
    texts = [t for _, t in ring]
    found = {r["doc_id"]: r for r in entry.queries()["op12_order_minhash"](spark, DATA).collect()}
    assert len(found) == len(ring)
    prints = [_signature(t) for t in texts]
    as_hex = lambda p: "".join(f"{x:08x}" for x in p)
    for i, (key, text) in enumerate(ring):
        after = (i + 1) % len(ring)
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        row, changed = found[key], _signature(edited)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == as_hex(prints[i]) and row["edited_fingerprint"] == as_hex(changed)
        assert row["near_edited"] == _like(prints[i], changed)
        assert row["near_next"] == _like(prints[i], prints[after])
