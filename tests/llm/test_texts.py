"""WARC, secrets, language, quality: small tables with every odd case."""

import hashlib
import re
import time

import numpy as np
from pyspark.sql import functions as F

from entitylake.llm import common, language_id, quality_mil, quality_rules, queries, secret_scan, warc
from entitylake.llm.common import sampled

from llm_fixtures import DATA, docs, shipped  # noqa: F401

KEY = "password = 'abc123def' AKIA" + "Z9" * 10 + " " + "0a1b2c" * 6


def test_secret_spans_and_redaction(docs):
    texts = [None, "", KEY, "é" * 40 + KEY, "password=token: abcdefgh", "x " * 2_000 + KEY, KEY, KEY]
    df = docs(texts)
    found = secret_scan.scan(df, secret_scan.train(df))
    assert sorted(found.columns) == sorted(df.columns)
    rows = {r.doc_id: r.secrets for r in found.collect()}
    for i, text in enumerate(texts):
        text = text or ""
        assign = [
            (m.start(), 0, m.end())
            for m in re.finditer(secret_scan.ASSIGN, text, re.A) if len(m[2]) >= 6
        ]
        want = assign + [(m.start(), 1, m.end()) for m in re.finditer(secret_scan.ACCESS, text)]
        want += [(m.start(), 2, m.end()) for m in re.finditer(secret_scan.HEX, text)]
        assert [tuple(s) for s in rows[i] if s["kind"] < 3] == sorted(want)
    clean = {r.doc_id: r.text for r in secret_scan.redact(found).collect()}
    assert clean[0] is None and clean[1] == "" and "AKIA" not in clean[3] and clean[4] == texts[4]


def test_secrets_are_learned_from_every_document(spark):
    """A few secrets among many documents weigh as much as they do alone."""
    key = F.concat(F.lit(KEY + " ordinary_identifier token = "), F.sha2(F.col("doc_id").cast("string"), 256))
    rows = spark.range(30_000).withColumnRenamed("id", "doc_id").withColumn(
        "text", F.when(F.col("doc_id") % 1_500 == 7, key).otherwise("a b c")
    )
    model = secret_scan.train(rows)
    assert model == secret_scan.train(rows.where("doc_id % 1500 = 7"))
    assert len(set(model.weights)) > 10


def test_language_of_odd_texts(docs):
    en, fr = "the cat and the dog are here " * 5, "le chat et le chien sont ici " * 5
    df = docs([(i, en if i % 2 else fr, "en" if i % 2 else "fr") for i in range(20)])
    model = language_id.train(df, "text", "lang", "doc_id")
    odd = docs([None, "", "123 !?", en * 3_000, fr.upper(), en])
    got = {r.doc_id: r.language for r in language_id.with_language(odd, model).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "fr", "en"]
    assert all(0 <= g.score <= 1 for g in got.values())
    assert language_id.with_language(docs([]), language_id.train(docs([]), "text", "lang", "doc_id")).count() == 0


def test_quality_rules_of_odd_texts(docs):
    texts = [None, "", "a", "a b c " * 200, "one two\n" * 40, " \n\t", "word" * 20_000]
    rows = {r.doc_id: r for r in quality_rules.assessed(docs(texts)).collect()}
    assert [rows[i].n_words for i in range(7)] == [0, 0, 1, 600, 80, 0, 1]
    assert rows[3].n_repeat_words == 600 and rows[4].n_dup_lines == 39
    assert not any(r.kept for r in rows.values())


def test_quality_scores_of_odd_texts(docs):
    df = docs([None, "", "plain words " * 400])
    model = quality_mil.fit([], quality_mil.np.array([]))
    scores = df.select(quality_mil.quality(model, df.text).alias("s")).collect()
    assert [r.s for r in scores] == [0.5] * 3


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 90
    pages = [(1, "http://a", big), (2, "http://b c", big), (3, None, None), (4, "u", "é"), (5, "u", "é")]
    known = warc.headers(spark.createDataFrame(pages, "k long, url string, h string"), "k", "url", "h")
    run = warc.write_archives(warc.resolved(known), str(tmp_path / "w"))
    back = warc.with_payloads(warc.read_archives(spark, str(tmp_path / "w"), run)).collect()
    assert {(r.page_id, r.record_type, r.refers_to, r.html) for r in back} == {
        ("1", "revisit", "2", big), ("2", "response", None, big), ("3", "response", None, ""),
        ("4", "response", None, "é"), ("5", "response", None, "é"),
    }
    assert {r.digest for r in back if r.page_id == "4"} == {hashlib.sha1("é".encode()).hexdigest()}


def test_revisits_of_repeated_and_missing_ids(spark, tmp_path):
    one, two, three = ("<p>" + c * 1_200 for c in "xyz")
    pages = [(1, one), (1, one), (1, one), (2, one), (2, one), (None, one), (None, two), (None, two),
             (3, three), (None, three), (2, "short"), (9, "short"), (None, None), (7, "é" * 600), (7, two + "!")]
    frame = spark.createDataFrame([(k, "u", h) for k, h in pages], "k long, url string, h string")
    known = warc.headers(frame.repartition(3), "k", "url", "h")
    found = [(r.page_id, r.html, r.record_type, r.refers_to) for r in warc.resolved(known).collect()]
    want = []
    for key, html in pages:
        ids = [k for k, h in pages if h == html and k is not None]
        large = html is not None and len(html.encode()) >= 1_000
        refers = max(ids) if large and ids and key != max(ids) else None
        want.append((key, html or "", "response" if refers is None else "revisit", refers))
    assert sorted(found, key=repr) == sorted(want, key=repr)
    run = warc.write_archives(warc.resolved(known), str(tmp_path / "w"))
    back = warc.with_payloads(warc.read_archives(spark, str(tmp_path / "w"), run)).collect()
    assert sorted((r.page_id or "", r.html) for r in back) == sorted(
        ("" if k is None else str(k), h or "") for k, h in pages
    )


def test_workers_give_back_what_is_not_in_use(monkeypatch):
    monkeypatch.setattr(common, "IDLE_SECONDS", 0.2)
    monkeypatch.setattr(common, "_watcher", None)
    first = common.resident(("a",), list)
    assert common.resident(("a",), list) is first
    deadline = time.monotonic() + 20
    while common._held and time.monotonic() < deadline:
        time.sleep(0.05)
    assert not common._held and common.resident(("a",), list) is not first
    common.resident(("b",), list)
    assert list(common._held) == [("b",)]


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = [r for r in queries.op8_language_id(spark, DATA).collect() if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_bundles_equal_plain_ones_however_texts_are_cut(monkeypatch):
    """Plain: every trigram's vector, one after the other."""
    space = language_id.Hyperspace(64)
    rng = np.random.default_rng(9)
    odd = "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 20_000)))
    texts = ["", "12 !", "a", "Ab  c'd", "İé ß", "ab" * 3_000, odd, "x" * 999 + " " + "y" * 999]

    def plain(text):
        codes, total = [0], np.zeros(64)
        for c in text.lower():
            if c.isalpha() or codes[-1] != 0:
                codes.append(ord(c) if c.isalpha() else 0)
        codes += [0] if codes[-1] != 0 else []
        vectors = {c: space.vectors[space.index[c]].astype(int) for c in set(codes)}
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            total += np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
        return total

    whole = space.bundle(texts)
    assert (whole == np.array([plain(t) for t in texts])).all()
    monkeypatch.setattr(language_id, "_PIECE", 7)
    assert (language_id.Hyperspace(64).bundle(texts) == whole).all()
    monkeypatch.undo()
    long = "".join(map(chr, rng.integers(97, 123, 3_000_000)))
    in_pieces = space.bundle([long])
    monkeypatch.setattr(language_id, "_PIECE", 1 << 22)
    assert (space.bundle([long]) == in_pieces).all()


def test_samples_are_bounded_whatever_the_size_and_the_ids(spark):
    frame = spark.range(20_000).selectExpr("id", "'t' as text", "0 as label")
    some = sampled(frame, ["id", "text", "label"], 20_000, 2_000).count()
    assert 1_700 < some < 2_300
    # a table of 1e11 rows, of which these are a part: one in 5,000,000 is not none of them in general
    assert sampled(frame, ["id"], 10**11, 10**9).count() > 100
    missing = spark.range(20_000).selectExpr("cast(null as long) as id", "cast(id as string) as text", "0 as label")
    assert 1_700 < sampled(missing, ["id", "text", "label"], 20_000, 2_000).count() < 2_300
    same = spark.range(20_000).selectExpr("7 as id", "'t' as text", "0 as label")
    assert sampled(same, ["id", "text", "label"], 20_000, 20_000).count() == 1


def test_rows_outside_the_sample_are_left_out_before_labels_are_joined(docs, spark):
    texts = docs([(i, None if i % 50 == 0 else f"text {i}", "en") for i in range(4_000)])
    texts = texts.select(F.col("doc_id").alias("id"), "text")
    labels = spark.range(4_000).select("id", F.expr("cast(id % 3 = 0 as int)").alias("label"))

    def chosen(rows):
        found = sampled(rows.join(labels, "id"), ["id", "text", "label"], 4_000, 100)
        return sorted((r.id, r.label) for r in found.collect())

    few = quality_mil._eligible(texts, 4_000, 100)
    assert chosen(few) == chosen(texts) and 60 < len(chosen(few)) < 150
    assert few.count() < 300
    assert quality_mil._eligible(texts, 4_000, 4_000).count() == 4_000
