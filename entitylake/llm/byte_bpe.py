"""Byte-level BPE by a finite-state transducer, and streaming decoding.

Merges applied in order of rank give the same tokens as a left-to-right rule: the last token of a
prefix is the one suffix token that may follow the last token of what stands before it, and two tokens
may follow each other if encoding their joined bytes gives just these two.  So a state is the last
token emitted with the bytes not yet emitted; for a byte the last token of the longer prefix is
found, and tokens that all continuations share are emitted.  A continuation can only begin where the
rest is the start of some token, so lookahead is bounded by the longest token.  States and transitions
are made when first met (lazy determinisation) and remembered, up to a bound.

Decoding joins the bytes of tokens and passes them through a state machine for UTF-8 that holds back
an incomplete character.

Defined results: a NULL text is empty: no ids, no bytes.  Bytes that are not UTF-8 decode to U+FFFD,
one for each longest start of a character, as usual.  Repeated rows get equal results.
"""

from __future__ import annotations

import array
import base64
import bisect
import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entitylake.llm.chunk_cache import ChunkCache, spans
from entitylake.llm.common import field, portions, resident

TRANSITIONS_KEPT = 1_000_000
CHUNKS_KEPT = 200_000
PIECES_KEPT = 600_000
PORTION = 4 << 20  # bytes of text whose chunks are looked up together
STEP = 4096  # ids that are decoded at a time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(n) for t, n in (line.split() for line in file if line.strip())}


class Transducer:
    """Ids of byte strings under merge ranks."""

    def __init__(self, ranks: dict[bytes, int], limit: int = TRANSITIONS_KEPT):
        self.ranks, self.limit = ranks, limit
        self.tokens = {number: token for token, number in ranks.items()}
        self.lengths = {number: len(token) for token, number in ranks.items()}
        # the tree of all tokens: a node and a byte give a node; per node its token or -1
        self.below: dict[int, int] = {}
        self.named, self.inner = [-1], [True]
        for token, number in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                node = self.below.setdefault(key, len(self.named))
                if node == len(self.named):
                    self.named.append(-1)
                    self.inner.append(False)
            self.named[node] = number
        self.whole: dict[int, bool] = {}
        self.adjacent: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.names = {(-1, b""): 0}
        # per state: last id emitted, bytes not emitted, the last id of each of their prefixes, where
        # a token may still begin, and the tree's node for the bytes from there on
        self.states: list[tuple] = [(-1, b"", (), (0,), (0,))]
        self.next: dict[int, int] = {}  # twice the state, and one more where something is emitted
        self.out: dict[int, tuple[int, ...]] = {}
        self.alike: dict = {}  # one of each of the tuples and bytes that many transitions and states share

    def merged(self, data: bytes) -> list[bytes]:
        """The definition: always join the adjacent pair of lowest rank, leftmost first."""
        return self._merged(data, 0)[0]

    def _merged(self, data: bytes, border: int) -> tuple[list[bytes], bool]:
        """The parts of ``data``, and whether ``border`` lies inside one: then they are not merged further."""
        rank, never = self.ranks.get, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        ranked = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranked:
            least = min(ranked)
            if least == never:
                break
            at = ranked.index(least)
            if at + 1 == border:
                return parts, True
            border -= at + 1 < border  # counts the parts before it
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranked[at]
            if at:
                ranked[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranked):
                ranked[at] = rank(parts[at] + parts[at + 1], never)
        return parts, False

    def _stands(self, last: int, number: int) -> bool:
        """Whether a token may stand after ``last``, or at the start if that is negative."""
        token = self.tokens[number]
        good = self.whole.get(number)
        if good is None:
            good = self.whole[number] = self.merged(token) == [token]
        if last < 0 or not good:
            return good
        key = last << 32 | number
        good = self.adjacent.get(key)
        if good is None:
            if len(self.adjacent) > self.limit // 2:
                self.adjacent.clear()
            before = self.tokens[last]
            parts, crossed = self._merged(before + token, len(before))
            good = self.adjacent[key] = not crossed and parts == [before, token]
        return good

    def _ids(self, ends: tuple[int, ...], end: int) -> tuple[int, ...]:
        """The ids that make the first ``end`` bytes."""
        ids = []
        while end > 0:
            number = ends[end - 1]
            ids.append(number)
            end -= self.lengths[number]
        return tuple(reversed(ids))

    def _step(self, state: int, byte: int) -> int:
        """Make one transition."""
        last, waiting, ends, live, nodes = self.states[state]
        waiting += bytes((byte,))
        below, named, inner, lengths = self.below.get, self.named, self.inner, self.lengths
        number, places, kept = -1, [], []
        for start, node in zip(live, nodes):
            node = below(node << 8 | byte)
            if node is None:
                continue
            if number < 0 <= named[node] and self._stands(ends[start - 1] if start else last, named[node]):
                number = named[node]
            if inner[node]:
                places.append(start)
                kept.append(node)
        if number < 0:
            raise ValueError("the ranks lack a single byte")
        ends = (*ends, number)
        places.append(len(waiting))
        kept.append(0)
        live = tuple(places)
        # the longest part that all ways to a live place share: step back from the farthest place
        while places[0] and len(places) > 1:
            place = places.pop()
            place -= lengths[ends[place - 1]]
            if place not in places:
                bisect.insort(places, place)
        cut = places[0]
        key = state << 8 | byte
        if cut:
            ids = self._ids(ends, cut)
            self.out[key] = self.alike.setdefault(ids, ids)
            last, waiting, ends = ends[cut - 1], waiting[cut:], ends[cut:]
            live = tuple([p - cut for p in live])
        found = self.names.get((last, waiting))
        if found is None:
            # after whatever token, the bytes that wait mostly have the same ends and places
            waiting, ends, live, kept = [self.alike.setdefault(x, x) for x in (waiting, ends, live, tuple(kept))]
            found = self.names[last, waiting] = len(self.states)
            self.states.append((last, waiting, ends, live, kept))
        found = self.next[key] = found << 1 | (cut > 0)
        return found

    def encode(self, data: bytes) -> list[int]:
        if len(self.next) > self.limit:
            self._reset()
        state, out, known, emitted = 0, [], self.next.get, self.out
        for byte in data:
            key = state << 8 | byte
            step = known(key) or self._step(state, byte)
            if step & 1:
                out += emitted[key]
            state = step >> 1
        waiting, ends = self.states[state][1:3]
        out += self._ids(ends, len(waiting))
        return out


_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: A run of white space with a blank in it that is neither before a visible character nor alone: the
#: pattern then looks beyond the blank, and such texts are split by the pattern as a whole.
_IRREGULAR = rf"{_BLANK} (?:{_BLANK}|\z)"
# no text in UTF-8 has these bytes
_FIRST, _MATCH = b"\xff", b"\xfe"
#: ASCII punctuation between a letter and a blank or the end is a match by itself.  In bytes of UTF-8; letters
#: are those of ASCII and Latin-1.
_TAIL = rb"([a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])([!-/:-@\[-`{-~]+)( |$)"


class TextEncoder:
    """Ids of texts; the pattern parts a text first, each match is encoded by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        # white space as the property of that name, to which \s of other libraries may add
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")
                                     .replace(r"\s", r"\p{White_Space}")
                                     .replace(r"\S", r"\P{White_Space}"))
        self.pieces: dict[bytes, bytes] = {}  # a match and its ids, as they are gathered
        self.cache = ChunkCache(self._encode, CHUNKS_KEPT)

    def _piece(self, data: bytes) -> bytes:
        found = self.pieces.get(data)
        if found is None:
            if len(self.pieces) > PIECES_KEPT:
                self.pieces.clear()
            found = self.pieces[data] = array.array("I", self.transducer.encode(data)).tobytes()
        return found

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out, sizes = [], []
        for chunk in chunks:
            mark = chunk[:1]
            if mark == _MATCH:
                ids = self._piece(chunk[1:])
            elif mark != _FIRST and (chunk if chunk.isascii() else chunk.decode()).isalpha():
                ids = self._piece(b" " + chunk)
            else:
                text = chunk[1:].decode() if mark == _FIRST else " " + chunk.decode()
                ids = b"".join([self._piece(m.encode()) for m in self.pattern.findall(text)])
            out.append(ids)
            sizes.append(len(ids) // 4)
        return np.frombuffer(b"".join(out), np.uint32), np.cumsum(sizes) - sizes, np.array(sizes, np.int64)

    def _matches(self, text: str) -> list[bytes]:
        return [_MATCH + m.encode() for m in self.pattern.findall(text)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts without NULL.

        Texts are cut into chunks that begin with a blank, except the first, which is marked instead: no match
        reaches over such a place.  Punctuation after a word is a chunk of its own, marked as a match, so that a
        word is known whatever follows it.
        """
        texts = pa.array(texts, pa.string())
        irregular = pc.match_substring_regex(texts, _IRREGULAR)
        regular = texts.filter(pc.invert(irregular)) if irregular.true_count else texts
        marked = pc.binary_join_element_wise(_FIRST, regular.cast(pa.binary()), b"")
        marked = pc.replace_substring_regex(marked, _TAIL, rb"\1 " + _MATCH + rb"\2\3")
        found = self.cache.ids_of(pc.split_pattern(marked, b" "))
        if not irregular.true_count:
            return found
        rest = [self._matches(t) for t in texts.filter(irregular).to_pylist()]
        theirs, ours = iter(self.cache.ids_of(pa.array(rest, pa.list_(pa.binary())))), iter(found)
        return [next(theirs if odd else ours) for odd in irregular.to_pylist()]


def text_encoder(path: str, pattern: str) -> TextEncoder:
    return resident(("bytes", path, pattern), lambda: TextEncoder(read_ranks(path), pattern))


# --- decoding --------------------------------------------------------------------------------------


class Utf8Machine:
    """Incremental UTF-8: ``feed`` gives the complete characters' bytes, ``close`` what is left over.

    The state is the incomplete start of a character with the range allowed for its next byte.
    """

    BAD = "�".encode()

    def __init__(self) -> None:
        self.held, self.need, self.low, self.high = b"", 0, 0x80, 0xBF

    def feed(self, data: bytes) -> bytes:
        out = bytearray()
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.held += bytes([byte])
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out += self.held
                        self.held = b""
                    continue
                out += self.close()
            if byte < 0x80:
                out.append(byte)
            elif 0xC2 <= byte <= 0xF4:
                self.held, self.need = bytes([byte]), 1 + (byte >= 0xE0) + (byte >= 0xF0)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out += self.BAD
        return bytes(out)

    def close(self) -> bytes:
        left, self.held, self.need, self.low, self.high = self.BAD * bool(self.held), b"", 0, 0x80, 0xBF
        return left

    @property
    def between(self) -> bool:
        return not self.need


class TokenBytes:
    """The bytes of all tokens, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The tokens' bytes, and where each begins and the last ends."""
        sizes = self.sizes[ids]
        data = self.flat[spans(self.starts[ids], sizes)].tobytes()
        return data, np.concatenate([[0], np.cumsum(sizes)])


class StreamDecoder:
    """Bytes of valid UTF-8 from ids that come in any portions."""

    def __init__(self, tokens: TokenBytes, whole: np.ndarray):
        self.tokens, self.whole, self.machine = tokens, whole, Utf8Machine()

    def feed(self, ids: np.ndarray) -> bytes:
        data, ends = self.tokens.joined(ids)
        broken = np.flatnonzero(~self.whole[ids])
        if self.machine.between and not len(broken):
            return data
        out, at = [], 0
        for first in [*([] if self.machine.between else [0]), *broken.tolist()]:
            if first < at:
                continue
            out.append(data[ends[at] : ends[first]])
            at = first
            while at < len(ids) and (at == first or not self.machine.between):
                out.append(self.machine.feed(data[ends[at] : ends[at + 1]]))
                at += 1
        return b"".join([*out, data[ends[at] :]])

    def close(self) -> bytes:
        return self.machine.close()


@functools.cache
def decoder_tables(path: str) -> tuple[TokenBytes, np.ndarray]:
    """Each id's bytes, and whether they are complete characters by themselves."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    whole = np.zeros(len(tokens), bool)
    for token, number in ranks.items():
        tokens[number] = token
        machine = Utf8Machine()
        whole[number] = machine.feed(token) == token and machine.between
    return TokenBytes(tokens), whole


def decode(ids: np.ndarray, path: str) -> bytes:
    decoder = StreamDecoder(*decoder_tables(path))
    parts = [decoder.feed(ids[at : at + STEP]) for at in range(0, len(ids), STEP)]
    return b"".join([*parts, decoder.close()])


# --- on tables --------------------------------------------------------------------------------------


def encoded(
    documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``doc_id, ids``: a row per row; ids as little-endian unsigned 32-bit integers in one binary."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    named = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([field(named, "doc_id"), T.StructField("ids", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder = text_encoder(path, pattern)
        for part in portions(batches, 1, PORTION):
            texts = pc.fill_null(part.columns[1], "")
            ids = [i.astype("<u4").tobytes() for i in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.columns[0], pa.array(ids, pa.binary())], schema=arrow
            )

    return named.mapInArrow(run, schema)


def decoded(encoded_: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` with the decoded bytes as ``data``."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = T.StructType([*encoded_.schema.fields, T.StructField("data", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    at = encoded_.columns.index("ids")

    def run(batches):
        for part in portions(batches, at, 4 << 20):
            data = [
                decode(np.frombuffer(i, "<u4"), path) if i is not None else None
                for i in part.columns[at].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], schema=arrow)

    return encoded_.mapInArrow(run, schema)


def round_trip(
    documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``doc_id, ids, data``: :func:`encoded` and :func:`decoded` in one pass over the texts."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    named = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            field(named, "doc_id"), T.StructField("ids", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder = text_encoder(path, pattern)
        for part in portions(batches, 1, PORTION):
            ids = encoder.encode(pc.fill_null(part.columns[1], ""))
            data = [decode(i, path) for i in ids]
            columns = [pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                       pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([part.columns[0], *columns], schema=arrow)

    return named.mapInArrow(run, schema)


def digests(decoded_: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return decoded_.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"),
    )
