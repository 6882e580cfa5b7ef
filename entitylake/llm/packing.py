"""Best-fit packing of tokenised documents by a distributed grouping genetic algorithm.

Documents become pieces of at most one sequence.  Pieces are dealt by hash to cells of about
``CELL`` pieces, each a bin-packing problem of its own, which costs a part of one sequence per cell.
A cell is solved by several islands, each with its own population, which starts from best-fit
decreasing in perturbed orders.  A child takes over whole well-filled bins of one parent; the other
parent's bins that hold any of their pieces are dissolved, and pieces displaced by that are put back by
best fit.  After each epoch every island sends its elite to the next one.  A cell is finished when
an individual needs no more bins than the lower bound.

Only lengths take part in the search; token ids stay with the pieces.  States travel as tables in the
shared folder, and everything random is seeded by cell and island, so a lost task repeats itself.

Defined results: a NULL text is an empty one, whose only id is the end id.  Repeated rows are pieces
of their own.  A NULL id stays NULL.  An empty table gives an empty one.  Other columns play no part.
"""

from __future__ import annotations

import bisect
import functools
import math
import os
import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from entitylake.llm.chunk_cache import ChunkCache
from entitylake.llm.common import field, portions, resident
from entitylake.operators.linkage import even_join
from entitylake.sources.scratch import staged

LIMIT = 4096
END_ID = 1
CELL = 4096
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 12
POPULATION = 6
WELL_FILLED = 0.98
SEED = 411


# --- pieces --------------------------------------------------------------------------------------


# Letters that the tokenizer lowers one by one, how it parts texts of these and printable ASCII,
# and its mark of a word's end.  A dotted I would become two characters, a long s may be taken for an s.
LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-įı-ž"
PLAIN = rf"^[!-~{LETTERS}]+$"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+"
# the tokenizer parts a letter from punctuation after it
TAIL = rf"([{LETTERS}])([!-/:-@\[-`{{-~]+)([ \t\n\x0b\f\r]|$)"
WORD_END = "</w>"
JOINED = 200  # chunks that are encoded as one text
ALONE = 5_000  # other chunks that are encoded at a time
WORDS_KEPT = 500_000
MOST_TASKS = 20_000  # of an epoch
PORTION = 4 << 20  # bytes of text that are looked up together


def _words_in(chunks: list[bytes]) -> np.ndarray:
    """The words the tokenizer makes of each chunk, whose A-Z are lowered; 0 where that is not plain."""
    texts = pa.array(chunks, pa.binary()).view(pa.string())
    plain = pc.match_substring_regex(texts, PLAIN)
    return pc.if_else(plain, pc.count_substring_regex(texts, WORDS), 0).to_numpy(zero_copy_only=False)


def _chunks(texts: pa.Array) -> pa.Array:
    """The chunks of each text: what stands between ASCII white space, and punctuation at the end of a word by
    itself, so that a word is known whatever follows it.

    The tokenizer lowers letters anyway; doing so for A-Z first leaves fewer chunks to know.
    """
    lowered = pc.replace_substring_regex(pc.ascii_lower(texts), TAIL, r"\1 \2\3")
    return pc.ascii_split_whitespace(lowered)


def _word_tokens(path: str, kept: int = WORDS_KEPT) -> ChunkCache:
    return resident(("words", path, kept), lambda: _new_word_tokens(path, kept))


def _new_word_tokens(path: str, kept: int = WORDS_KEPT) -> ChunkCache:
    """Ids by the tokenizer file ``path``, whose tokens never reach over ASCII white space.

    Plain chunks are encoded many at a time, as one text, and told apart by their numbers of words;
    the others one by one.  A task has one core, so the tokenizer gets no threads.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    size = tokenizer.get_vocab_size()
    is_end = np.array([(tokenizer.id_to_token(i) or "").endswith(WORD_END) for i in range(size)])

    def singly(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = [c.decode("utf-8", "surrogatepass") for c in chunks]
        found = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
        return np.array(found.ids, np.uint32), sizes

    def joined(chunks: list[bytes], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = b" ".join(chunks).decode("utf-8")
        [found] = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        ends = np.flatnonzero(is_end[ids])
        last = np.cumsum(words) - 1
        if last[-1] + 1 != len(ends):
            return singly(chunks)
        return ids, np.diff(ends[last], prepend=-1)

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = _words_in(chunks)
        order, parts = [], []
        for some, step in ((np.flatnonzero(words), JOINED), (np.flatnonzero(words == 0), ALONE)):
            order.append(some)
            for low in range(0, len(some), step):
                here = some[low : low + step]
                mine = [chunks[i] for i in here.tolist()]
                parts.append(joined(mine, words[here]) if step == JOINED else singly(mine))
        order = np.concatenate(order)
        in_order = np.concatenate([s for _, s in parts])
        starts, sizes = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        starts[order], sizes[order] = np.cumsum(in_order) - in_order, in_order
        return np.concatenate([i for i, _ in parts]), starts, sizes

    return ChunkCache(encode, kept)


def token_pieces(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    tokenizer: str | None = None,
    with_ids: bool = True,
    kept: int = WORDS_KEPT,
    portion_bytes: int = PORTION,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``, a row per piece.

    A worker remembers about ``kept`` words and looks up those of ``portion_bytes`` of text together: smaller
    numbers take less memory and more time, the rows are the same.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    named = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            field(named, "doc_id"),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ][: None if with_ids else -1]
    )
    arrow = to_arrow_schema(schema)

    def cut(batches):
        cache = _word_tokens(path, kept)
        for portion in portions(batches, 1, portion_bytes):
            texts = pc.fill_null(portion.columns[1], "")
            rows = []
            for name, ids in zip(portion.columns[0].to_pylist(), cache.ids_of(_chunks(texts))):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), limit)):
                    part = ids[start : start + limit]
                    row = (name, number, start, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.view(np.int32)) if with_ids else row)
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return named.mapInArrow(cut, schema)


# --- the genetic algorithm -------------------------------------------------------------------------


def lower_bound(sizes: np.ndarray, limit: int) -> int:
    return max(math.ceil(int(sizes.sum()) / limit), int((2 * sizes > limit).sum()))


def _loads(bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes, minlength=int(bins.max()) + 1).astype(np.int64)


def best_fit(order, sizes: np.ndarray, bins: np.ndarray, loads: list[int], limit: int) -> None:
    """Put the pieces of ``order`` where they leave least room; changes ``bins`` and ``loads``."""
    rooms = sorted((limit - load, i) for i, load in enumerate(loads) if load < limit)
    for piece in order:
        size = int(sizes[piece])
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, target = rooms.pop(at)
        else:
            room, target = limit, len(loads)
            loads.append(0)
        bins[piece] = target
        loads[target] += size
        if room > size:
            bisect.insort(rooms, (room - size, target))


def _compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int64)


def fitness(bins: np.ndarray, sizes: np.ndarray, limit: int) -> tuple[int, float]:
    """Smaller is better: the number of bins, then how evenly they are filled."""
    loads = _loads(bins, sizes)
    return len(loads), -float(np.mean((loads / limit) ** 2))


def seeded(sizes: np.ndarray, limit: int, random: np.random.Generator, spread: float) -> np.ndarray:
    """Best fit in decreasing order of sizes that are perturbed by up to ``spread``."""
    noisy = sizes * (1 + spread * random.random(len(sizes)))
    bins = np.zeros(len(sizes), np.int64)
    best_fit(np.argsort(-noisy, kind="stable"), sizes, bins, [], limit)
    return bins


def crossover(
    keep: np.ndarray, give: np.ndarray, sizes: np.ndarray, limit: int, random: np.random.Generator
) -> np.ndarray:
    """``keep`` with some well-filled bins of ``give`` put in whole."""
    loads = _loads(give, sizes)
    full = np.flatnonzero(loads >= WELL_FILLED * limit)
    if not len(full):
        full = np.flatnonzero(loads == loads.max())
    chosen = random.choice(full, max(1, len(full) // 3), replace=False)
    injected = np.isin(give, chosen)
    touched = np.isin(keep, np.unique(keep[injected]))
    loose = np.flatnonzero(touched & ~injected)
    # the worst bins of what is left are opened as well: their pieces may close gaps elsewhere
    rest = ~touched
    child = np.full(len(sizes), -1, np.int64)
    if rest.any():
        child[rest] = _compact(keep[rest])
        filled = _loads(child[rest], sizes[rest])
        poor = np.argsort(filled, kind="stable")[: max(1, len(filled) // 50)]
        opened = rest & np.isin(child, poor)
        loose = np.concatenate([loose, np.flatnonzero(opened)])
        child[opened] = -1
    placed = child >= 0
    count = 0
    if placed.any():
        child[placed] = _compact(child[placed])
        count = int(child[placed].max()) + 1
    child[injected] = count + _compact(give[injected])
    done = child >= 0
    known = _loads(child[done], sizes[done]).tolist() if done.any() else []
    best_fit(loose[np.argsort(-sizes[loose], kind="stable")], sizes, child, known, limit)
    return _compact(child)


def evolve(
    sizes: np.ndarray, population: list[np.ndarray], limit: int, generations: int, seed: list[int]
) -> list[np.ndarray]:
    """The population after some generations, best first; an empty one is filled first."""
    random = np.random.default_rng(seed)
    bound = lower_bound(sizes, limit)

    def sort(members):
        return sorted(members, key=lambda b: fitness(b, sizes, limit))

    if not population:
        population = [seeded(sizes, limit, random, 0.0)]
    population = sort(population)
    while len(population) < POPULATION and population[0].max() + 1 > bound:
        population = sort([*population, seeded(sizes, limit, random, 0.3 * random.random())])
    for _ in range(generations):
        if population[0].max() + 1 <= bound:
            break
        children = []
        for _ in range(POPULATION // 2):
            one, two = random.choice(len(population), 2, replace=len(population) < 2)
            first, second = (population[min(one, two)], population[max(one, two)])
            children.append(crossover(second, first, sizes, limit, random))
            children.append(crossover(first, second, sizes, limit, random))
        population = sort([*population, *children])[:POPULATION]
    return population


# --- cells and islands -----------------------------------------------------------------------------

_STATE = "cell long, part int, island int, sizes array<int>, members array<array<int>>, open boolean"


def _epoch(limit: int, generations: int, epoch: int) -> Callable:
    schema = pa.schema(
        [
            ("cell", pa.int64()), ("part", pa.int32()), ("island", pa.int32()),
            ("sizes", pa.list_(pa.int32())), ("members", pa.list_(pa.list_(pa.int32()))),
            ("open", pa.bool_()),
        ]
    )

    def run(batches):
        for batch in batches:
            for cell, part, island, sizes, members in zip(*(c.to_pylist() for c in batch.columns)):
                lengths = np.array(sizes, np.int64)
                known = [np.array(m, np.int64) for m in members]
                seed = [SEED, cell, part, island, epoch]
                known = evolve(lengths, known, limit, generations, seed)
                unsolved = bool(known[0].max() + 1 > lower_bound(lengths, limit))
                row = [cell, part, island, sizes, [m.tolist() for m in known], unsolved]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema
                )

    return run


def _offsets(batches):
    """Best individuals as ``place, bin, offset`` of every piece."""
    schema = pa.schema(
        [
            ("cell", pa.int64()), ("part", pa.int32()), ("place", pa.int32()), ("bin", pa.int64()),
            ("offset", pa.int64()),
        ]
    )
    for batch in batches:
        for cell, part, sizes, bins in zip(*(c.to_pylist() for c in batch.columns)):
            sizes, bins = np.array(sizes, np.int64), np.array(bins, np.int64)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(sizes[order])
            first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
            before = (ends - sizes[order])[first]
            offset = np.empty(len(bins), np.int64)
            offset[order] = ends - sizes[order] - before[np.cumsum(first) - 1]
            columns = [
                np.full(len(bins), cell), np.full(len(bins), part, np.int32),
                np.arange(len(bins), dtype=np.int32), bins, offset,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)


def pack(
    pieces: DataFrame, limit: int = LIMIT, cell: int = CELL, islands: int = ISLANDS,
    epochs: int = EPOCHS, generations: int = GENERATIONS,
) -> DataFrame:
    """All columns of ``pieces`` (as of :func:`token_pieces`) with ``sequence_id`` and ``offset``.

    Starts jobs.  ``pieces`` is staged with a number for every row, by which rows are dealt to cells: these
    stay even however often a row is repeated.  One that gets more than twice its share is divided.
    """
    columns = pieces.columns
    pieces = staged(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    cells = max(1, math.ceil(pieces.count() / cell))
    dealt = pieces.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells)))
    rank = F.expr(
        "row_number() over (partition by _cell order by xxhash64(_row), _row)"
    )
    dealt = dealt.withColumn("_rank", rank - 1)
    dealt = staged(
        dealt.withColumn("_part", F.floor(F.col("_rank") / (2 * cell)).cast("int"))
        .withColumn("_place", (F.col("_rank") % (2 * cell)).cast("int")).drop("_rank", "_row"),
        "dealt-pieces",
    )
    problems = dealt.groupBy("_cell", "_part").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_place", F.col("length").cast("int").alias("n")))),
            lambda x: x["n"],
        ).alias("sizes")
    )
    state = problems.select(
        F.col("_cell").alias("cell"), F.col("_part").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "sizes",
        F.array().cast("array<array<int>>").alias("members"),
    )
    finished = []
    for epoch in range(epochs):
        # a task an island, as far as that goes: by their bytes they would all be one task's
        state = state.repartition(min(cells * islands, MOST_TASKS), "cell", "part", "island")
        state = staged(
            state.mapInArrow(_epoch(limit, generations, epoch), _STATE), "islands"
        )
        finished.append(state)
        unsolved = state.groupBy("cell", "part").agg(F.min("open").alias("still")).where("still")
        if epoch == epochs - 1 or not unsolved.limit(1).count():
            break
        keys = ["cell", "part", "island"]
        elites = state.select(
            "cell", "part", ((F.col("island") + 1) % islands).alias("island"),
            F.get("members", F.lit(0)).alias("elite"),
        )
        state = even_join(state, unsolved.select("cell", "part"), ["cell", "part"], "left_semi")
        state = even_join(state, elites, keys).select(
            *keys, "sizes", F.concat("members", F.array("elite")).alias("members")
        )
    every = functools.reduce(DataFrame.unionByName, finished)
    best = F.get("members", F.lit(0))
    winners = every.groupBy("cell", "part").agg(
        F.min_by(F.struct("sizes", best.alias("bins")), F.struct(F.array_max(best), "island")).alias("w")
    ).select("cell", "part", "w.sizes", "w.bins")
    placed = winners.mapInArrow(
        _offsets, "cell long, part int, place int, bin long, offset long"
    ).select(
        F.col("cell").alias("_cell"), F.col("part").alias("_part"), F.col("place").alias("_place"),
        (F.shiftleft("cell", 33) + F.col("part").cast("long") * (2 * cell) + F.col("bin"))
        .alias("sequence_id"), "offset",
    )
    return even_join(dealt, placed, ["_cell", "_part", "_place"]).select(
        *columns, "sequence_id", "offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of each sequence, from packed pieces with their ids."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))
