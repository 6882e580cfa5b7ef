"""Byte-level BPE, packing and sharding."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from entitylake.llm import byte_bpe, chunk_cache, packing, queries, sharding

from llm_fixtures import DATA, docs, shipped  # noqa: F401

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "  ", "\n", "a \n b", "a\n \nb", "a  b", "a   b", "b  ", "b\n ", " lead", "I'll they've",
    "naïve café Straße İstanbul ΣΑΣ", "١٢٣ ½ ²", "emoji 😀👍🏽", "á é", "x" * 700, " " * 300 + "y",
    "<|endoftext|> and <|startoftext|>", "don't'S", "#$%&* --- ___", "tab\tand\x0bvt\x1cfs\x85nel\xa0nbsp",
    "漢字かな交じり文", None,
]


def _reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _random_texts(n):
    rnd = random.Random(8)
    alphabet = " \n\t\r\x0b\xa0　\x1c\x85aabbctheing'sé ß12½!?_-.😀漢́İK"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_encoder_equals_reference():
    texts = [t or "" for t in TEXTS] + _random_texts(3_000)
    want = _reference()
    for text, ids in zip(texts, byte_bpe.text_encoder(RANKS, public_tokenizers.PATTERN).encode(texts)):
        assert ids.tolist() == want.encode_ordinary(text), repr(text)
        assert byte_bpe.decode(ids, RANKS) == text.encode()


def test_transducer_with_little_memory():
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(RANKS), limit=50)
    for word in (b"internationalisation", b"thethethe", b"aaaaaaaaab", b"\xff\xfe\xe2\x82"):
        assert [machine.tokens[i] for i in machine.encode(word)] == machine.merged(word)


def test_states_and_pieces_are_kept_compactly():
    """States share what waits in them, its last ids and its places; a piece's ids are kept as bytes."""
    encoder = byte_bpe.TextEncoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    texts, want = [*_random_texts(60), "aned.\nTherly, ciónezciónga. of the other"], _reference()
    assert [i.tolist() for i in encoder.encode(texts)] == [want.encode_ordinary(t) for t in texts]
    states = encoder.transducer.states
    for place in range(1, 5):
        assert len({id(s[place]) for s in states[1:]}) == len({s[place] for s in states[1:]}) < len(states) - 1
    assert {type(p) for p in encoder.pieces.values()} == {bytes}


ENDINGS = ["", ".", ",", "&&&", "'", "?!", "'s.", "\"'", ")1", "$*\t", ".\x0b", "́.", "—,", "×.", "İ,", "ſ'", "漢!", "Σ."]


def _ended(words):
    return [w + e for w in words for e in ENDINGS]


def test_a_word_is_known_whatever_punctuation_follows():
    encoder = byte_bpe.TextEncoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    words, signs = ["foo", "Barñ", "été", "it's", "a1b"], [".", ",", "&&&", "?!", "'", "---"]
    text, want = " ".join(["x", *[w + s for w in words for s in signs]]), _reference()
    assert encoder.encode([text])[0].tolist() == want.encode_ordinary(text)
    assert encoder.cache.known <= 1 + len(words) + len(signs)
    odd = _ended(["", "we", "we'", "don't", "İ", "é", "1", "漢", "a.b"])
    texts = [*odd, " ".join(odd), "\n".join(odd), "  ".join(odd), " ".join(odd)]
    assert [i.tolist() for i in encoder.encode(texts)] == [want.encode_ordinary(t) for t in texts]


def test_pairs_of_tokens_that_may_stand_together():
    """A merge over the border ends the test early; the answers are those of the definition."""
    machine, rnd = byte_bpe.Transducer(byte_bpe.read_ranks(RANKS)), random.Random(3)
    short = [n for n, t in machine.tokens.items() if len(t) < 5]
    for last, number in (rnd.choices(short, k=2) for _ in range(3_000)):
        pair = [machine.tokens[last], machine.tokens[number]]
        assert machine._stands(last, number) == (
            machine.merged(pair[1]) == pair[1:] and machine.merged(b"".join(pair)) == pair
        )


def test_utf8_machine_equals_reference():
    rnd = random.Random(2)
    pool = [0x61, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0, 0xC0]
    for _ in range(3_000):
        data = bytes(rnd.choice(pool) for _ in range(rnd.randint(0, 12)))
        machine, at = byte_bpe.Utf8Machine(), rnd.randint(0, 12)
        got = machine.feed(data[:at]) + machine.feed(data[at:]) + machine.close()
        assert got == data.decode("utf-8", "replace").encode()


def test_stream_decoder_any_portions():
    ids = np.array(_reference().encode_ordinary("naïve 😀👍🏽 漢字 café " * 20), np.uint32)
    whole = byte_bpe.decode(ids, RANKS)
    for step in (1, 2, 7):
        decoder = byte_bpe.StreamDecoder(*byte_bpe.decoder_tables(RANKS))
        parts = [decoder.feed(ids[i : i + step]) for i in range(0, len(ids), step)]
        assert b"".join([*parts, decoder.close()]) == whole


def test_encoded_and_decoded_tables(docs):
    df = docs(TEXTS)
    one = byte_bpe.digests(byte_bpe.round_trip(df)).collect()
    two = byte_bpe.digests(byte_bpe.decoded(byte_bpe.encoded(df))).collect()
    assert sorted(one) == sorted(two)
    for r in one:
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    assert byte_bpe.digests(byte_bpe.round_trip(docs([]))).count() == 0


def test_a_chunk_is_looked_up_once_however_often_it_occurs(monkeypatch):
    encoder = byte_bpe.TextEncoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    asked = []

    class Counting(type(encoder.cache.ordinals)):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    encoder.cache.ordinals = Counting()
    texts = ["a bc a bc  a\n", "bc a", "", " a", "x \n y"] * 50
    want = _reference()
    assert [i.tolist() for i in encoder.encode(texts)] == [want.encode_ordinary(t) for t in texts]
    assert len(asked) <= 15


def test_chunk_cache_forgets_and_stays_right():
    cache = chunk_cache.ChunkCache(lambda chunks: [[len(c), 7][: len(c) % 3] for c in chunks], limit=20)
    rnd = random.Random(4)
    for _ in range(60):
        texts = [["x" * rnd.randint(0, 60) for _ in range(rnd.randint(0, 9))] for _ in range(4)]
        want = [[i for c in t for i in [len(c), 7][: len(c) % 3]] for t in texts]
        assert [a.tolist() for a in cache.ids(texts)] == want
        assert cache.known <= 20 + 36


def _pieces(rows, limit=4096):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    out = []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, at in enumerate(range(0, len(ids), limit)):
            part = ids[at : at + limit]
            out.append((key, n, at, len(part), zlib.crc32(part.tobytes())))
    return out


def test_words_with_accents_are_encoded_together(monkeypatch):
    """Each chunk's ids are the tokenizer's, and chunks of accented words and punctuation are encoded as one text."""
    rnd = random.Random(8)
    signs = "aéñößçŝıžªºİſŉ'sdtl.,\n&#09×÷一\u0301\u00ad-"
    odd = ["".join(rnd.choices(signs.replace("\n", ""), k=rnd.randint(1, 9))).lower() for _ in range(3_000)]
    chunks = [c.encode() for c in dict.fromkeys([*odd, "ciónezciónga.", "it's", "", "İ.", "l'été"])]
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    want = [tokenizer.encode([c.decode()], is_pretokenized=True, add_special_tokens=False).ids for c in chunks]
    found = packing._new_word_tokens(WORDS).ids_of(pa.array([[c] for c in chunks], pa.list_(pa.binary())))
    assert [f.tolist() for f in found] == want
    known = ["ciónezciónga.", "l'été", "it's", "éa1.", "İ", "ſa", "一"]
    assert packing._words_in([c.encode() for c in known]).tolist() == [2, 3, 2, 3, 0, 0, 0]


def test_words_are_known_whatever_punctuation_follows():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    cache = packing._new_word_tokens(WORDS)
    words, signs = ["foo", "Barñ", "été", "it's", "a1b"], [".", ",", "&&&", "?!", "'", "---"]
    text = " ".join(w + s for w in words for s in signs)
    odd = _ended(["", "we", "we'", "don't", "İ", "é", "1", "漢", "a.b"])
    texts = [text, *odd, " ".join(odd), "\n".join(odd), " ".join(odd)]
    found = cache.ids_of(packing._chunks(pa.array(texts[:1])))
    assert cache.known <= len(words) + len(signs)
    found += cache.ids_of(packing._chunks(pa.array(texts[1:])))
    assert [f.tolist() for f in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _check_packing(rows, limit):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= limit for n in at.values())
    return len(at)


@pytest.mark.parametrize("limit", [4096, 50])
def test_packing(docs, limit):
    texts = [*TEXTS, *_random_texts(100), *_random_texts(30), "word " * 10_000]
    df = docs([*[(i, t, "en") for i, t in enumerate(texts)], (None, "no id", "en"), (3, "\n", "en")])
    rows = [*enumerate(texts), (None, "no id"), (3, "\n")]
    got = packing.pack(packing.token_pieces(df, limit=limit), limit=limit, cell=40)
    found = got.collect()
    known = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    assert known == Counter(_pieces(rows, limit))
    _check_packing(found, limit)
    ids = {(r.doc_id, r.piece): r.ids for r in found}
    for s in packing.sequences(got).limit(5).collect():
        own = sorted((r for r in found if r.sequence_id == s.sequence_id), key=lambda r: r.offset)
        assert s.ids == [i for r in own for i in (ids[r.doc_id, r.piece] if r.doc_id != 3 else r.ids)]


def test_pieces_with_little_memory(docs):
    df = docs([(i, t, "en") for i, t in enumerate([*TEXTS, *_random_texts(40)])])
    plain, tight = packing.token_pieces(df), packing.token_pieces(df, kept=20, portion_bytes=100)
    assert sorted(tight.collect(), key=str) == sorted(plain.collect(), key=str)
    assert packing._new_word_tokens(WORDS, 20).limit == 20


def test_packing_of_nothing(docs):
    assert packing.pack(packing.token_pieces(docs([]))).count() == 0


def test_genetic_search_improves_and_stays_valid():
    rnd = np.random.default_rng(6)
    # triples that fill bins exactly: hard for best fit, the optimum is known
    cut = np.sort(rnd.integers(20, 80, (60, 2)), 1)
    sizes = np.concatenate([cut[:, 0], cut[:, 1] - cut[:, 0] + 1, 101 - cut[:, 1] - 1])
    sizes = sizes[sizes > 0]
    first = packing.seeded(sizes, 100, np.random.default_rng(0), 0.0)
    final = packing.evolve(sizes, [], 100, 60, [1])[0]
    loads = np.bincount(final, sizes)
    assert loads.max() <= 100 and loads.sum() == sizes.sum()
    assert packing.fitness(final, sizes, 100) <= packing.fitness(first, sizes, 100)
    assert final.max() + 1 <= packing.lower_bound(sizes, 100) + 1


def test_crossover_keeps_every_piece():
    rnd = np.random.default_rng(5)
    sizes = rnd.integers(1, 100, 300)
    a, b = (packing.seeded(sizes, 100, rnd, s) for s in (0.0, 0.5))
    for _ in range(20):
        child = packing.crossover(a, b, sizes, 100, rnd)
        assert child.min() >= 0 and np.bincount(child, sizes).max() <= 100


def test_packing_query(spark):
    found = queries.op1_best_fit_packing(spark, DATA).collect()
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    want = Counter(_pieces([tuple(r) for r in table.collect()]))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = _check_packing(found, 4096)
    assert bins <= -(-sum(r.length for r in found) // 4096) + 1


def test_byte_bpe_query(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    want = _reference()
    for r in queries.op3_byte_bpe(spark, DATA).collect():
        ids = np.array(want.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- sharding ---------------------------------------------------------------------------------------


def _check_shards(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("rows", [[], [None, None, ""], [str(i % 5) for i in range(200)]])
def test_shards(docs, rows):
    df = docs([(i if i % 9 else None, t, "en") for i, t in enumerate(rows)])
    placed = sharding.shuffled_shards(df, 7, partitions=5, cells_per_shard=3)
    assert set(df.columns) == set(placed.columns) - {"slot"}
    found = placed.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in df.collect())
    if rows:
        _check_shards(found, 7)


def test_equal_rows_are_spread(spark):
    placed = sharding.shuffled_shards(spark.range(600).selectExpr("1 as x"), 6, partitions=8).collect()
    _check_shards(placed, 6)


def test_matrix_has_exact_margins_and_is_uniform():
    rnd = np.random.default_rng(1)
    total = np.zeros((3, 2))
    for _ in range(3_000):
        matrix = sharding.communication_matrix([5, 0, 7], [6, 6], rnd)
        assert matrix.sum(1).tolist() == [5, 0, 7] and matrix.sum(0).tolist() == [6, 6]
        total += matrix
    assert np.allclose(total / 3_000, [[2.5, 2.5], [0, 0], [3.5, 3.5]], atol=0.1)


def test_large_hypergeometric_draws():
    rnd = np.random.default_rng(2)
    draws = [sharding._hypergeometric(10**9, 3 * 10**9, 10_000, rnd) for _ in range(2_000)]
    assert abs(np.mean(draws) - 2_500) < 5 and abs(np.std(draws) - 43.3) < 4
    small = [sharding._hypergeometric_inverse(5, 7, 6, rnd) for _ in range(5_000)]
    assert abs(np.mean(small) - 2.5) < 0.06


def test_every_order_is_as_likely(spark):
    """Over seeds, rows land in each shard about equally often."""
    rows = spark.range(12).withColumnRenamed("id", "x")
    counts = Counter()
    for seed in range(12):
        for r in sharding.shuffled_shards(rows, 2, partitions=3, seed=seed).collect():
            counts[r.x] += r.shard
    assert 3 <= min(counts[i] for i in range(12)) + 3 and max(counts.values()) <= 12


def test_shard_query(spark):
    found = queries.op6_hypergeometric_shards(spark, DATA).collect()
    _check_shards(found, 24)
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: (r.text or "").encode() for r in table.collect()}
    for r in found:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))


def test_shard_query_places_whole_documents(spark, monkeypatch):
    """The operator gets every column, and digests are of the texts that it placed."""
    given, place = [], sharding.shuffled_shards

    def placed(rows, *args):
        given.extend(rows.columns)
        return place(rows, *args).selectExpr("* except (text)", "concat(text, '!') as text")

    monkeypatch.setattr(sharding, "shuffled_shards", placed)
    found = queries.op6_hypergeometric_shards(spark, DATA).collect()
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    assert given == table.columns
    texts = {r.doc_id: f"{r.text}!".encode() for r in table.where("text is not null").collect()}
    for r in found:
        if r.doc_id in texts:
            assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))


def test_ranks_are_taken_without_the_rows(docs, monkeypatch):
    written, stage = [], sharding.staged

    def staged(df, label):
        written.append((label, "_row" in df.columns))
        return stage(df, label)

    monkeypatch.setattr(sharding, "staged", staged)
    sharding.shuffled_shards(docs(["a", "a", "b"]), 2).collect()
    assert [label for label, whole in written if whole] == ["shard-rows"]
