"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

N-grams are 64-bit hashes. Documents are taken in blocks of up to BLOCK_TOKENS words; a block is a row that holds its
documents' words packed. Order by order, blocks are exploded into rows (hash, ref, block): each distinct n-gram of the
block, its place in the block and how often it stands there. Rows are partitioned by hash once: a window over the hash is
the count table and its join to the exploded n-grams. What comes out goes back to the blocks, row by row and dealt by
block, and only there is it packed, so the packed rows grow with the corpus and not with blocks times tasks; a block
scores its n-grams and sums per document.

An n-gram that `min_count` keeps has a prefix and a suffix that are kept too, so the longer n-grams of a block without
these need no row: their count can't be in the table. Which words end a kept n-gram is marked in the blocks once per
order. A frequent n-gram is one row per block, so no key is hot; the rows grow with the corpus, and what a task holds is a
block or a sorted run.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._common import drop_scratch, materialise, release_memory, table
from millrace.llm.shingles import mix, text_chunks, word_hashes

#: An n-gram that the corpus has once, in the document that is scored, is no evidence: two and more count.
ORDER, MIN_COUNT, BACKOFF = 3, 2, 0.4
BLOCK_TOKENS = 1_000_000
#: An order's n-grams are exploded and joined in so many slices of the hashes, one after the other, so that the disk holds
#: one slice's rows at a time; a power of two.
SLICES = 2
#: Rows of exploded n-grams in a batch.
BATCH_ROWS = 1 << 18
_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)


def _pack(values: np.ndarray) -> bytes:
    """Compressed, the bytes of equal weight together."""
    width = values.dtype.itemsize
    return zstandard.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), 3)


def _unpack(packed: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def ngrams(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For each word the hash of the n-gram that ends there, 0 where the document begins later; first as in
    word_hashes. Hashes of different n differ."""
    out = np.zeros(len(words), _U)
    if len(words) < n:
        return out
    rolled = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        rolled = mix(rolled * _STEP + words[k : len(words) - n + 1 + k] + _U(n))
    out[n - 1 :] = rolled
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    out[place < n - 1] = 0
    return out


#: kept: a bit per word, set where an n-gram ends that the table of the last order keeps; null before there is one.
_BLOCKS = "block bigint, doc_ids array<bigint>, sizes array<int>, vocabulary binary, tokens binary, n_tokens bigint, kept binary"


def _blocks(batches: Iterable[pa.RecordBatch], block_tokens: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[list, np.ndarray, np.ndarray]] = []
    count, number = 0, TaskContext.get().partitionId() << 32

    def flush() -> pa.RecordBatch:
        words = np.concatenate([np.empty(0, _U), *[w for _, w, _ in held]])
        kinds, inverse, times = np.unique(words, return_inverse=True, return_counts=True)
        # frequent words get small numbers, which compress well
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(kinds), np.uint32)
        rank[order] = np.arange(len(kinds), dtype=np.uint32)
        ids, sizes = [i for d, _, _ in held for i in d], np.concatenate([s for _, _, s in held])
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([_pack(kinds[order])], pa.binary()), pa.array([_pack(rank[inverse])], pa.binary()), pa.array([len(words)], pa.int64()), pa.array([None], pa.binary())],
            names=[x.split()[0] for x in _BLOCKS.split(", ")],
        )

    for batch in batches:
        for start, texts in text_chunks(batch, 1):
            words, first = word_hashes(texts)
            held.append((batch.column(0).slice(start, len(texts)).to_pylist(), words, np.diff(first).astype(np.int32)))
            count += len(words)
            if count >= block_tokens:
                yield flush()
                held, count, number = [], 0, number + 1
    if held:
        yield flush()


def _words_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    words = _unpack(row["vocabulary"], np.uint64)[_unpack(row["tokens"], np.uint32)]
    return words, np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64))))


def _kinds(words: np.ndarray, first: np.ndarray, n: int, part_of: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct n-grams, of a slice or all, sorted; which words end one; and for these words its place among
    the distinct."""
    hashes = ngrams(words, first, n)
    possible = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first)) >= n - 1
    if part_of is not None:
        possible &= _slice(hashes) == _U(part_of)
    keys, inverse = np.unique(hashes[possible], return_inverse=True)
    return keys, possible, inverse


def _slice(hashes: np.ndarray) -> np.ndarray:
    """The slice of each hash: sorted hashes have their slices in order."""
    return hashes >> _U(32) >> _U(32 - (SLICES - 1).bit_length())


def _placed(answers: list[dict], n: int, keys: np.ndarray) -> np.ndarray:
    """Counts of the block's distinct n-grams, which are sorted; 0 for what the table does not keep."""
    out = np.zeros(len(keys), np.int64)
    begin = np.searchsorted(_slice(keys), np.arange(SLICES, dtype=_U))
    for row in answers:
        if row["n"] == n:
            out[begin[row["slice"]] + np.cumsum(_unpack(row["places"], np.uint32), dtype=np.uint32)] = _unpack(row["counts"], np.int64)
    return out


#: ref: how often the n-gram stands in the block, times 2**32, and its place; both are below a block's number of words.
#: What differs from row to row stands together, which compresses better.
_ROWS = "hash bigint, ref bigint, block bigint"


_SCHEMA = pa.schema([("hash", pa.int64()), ("ref", pa.int64()), ("block", pa.int64())])


def _exploded(row: dict, n: int, part_of: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block in a slice, places counted there; of a marked block only those whose prefix and suffix are
    kept."""
    words, first = _words_of(row)
    keys, possible, inverse = _kinds(words, first, n, part_of)
    times = np.bincount(inverse, minlength=len(keys))
    some = np.arange(len(keys))
    if row["kept"] is not None:
        kept = np.unpackbits(_unpack(row["kept"], np.uint8), count=len(words)).astype(bool)
        both = np.zeros(len(keys), bool)
        at = np.flatnonzero(possible)
        both[inverse] = kept[at] & kept[at - 1]
        some = np.flatnonzero(both)
    for low in range(0, len(some), BATCH_ROWS):
        part = some[low : low + BATCH_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(times[part] << 32 | part), pa.array(np.full(len(part), row["block"]))], schema=_SCHEMA)


def _rows(blocks: DataFrame, n: int, part_of: int) -> DataFrame:
    return blocks.mapInArrow(lambda batches: (out for batch in batches for row in batch.to_pylist() for out in _exploded(row, n, part_of)), _ROWS)


def _marked(blocks: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """The blocks with their words marked that end a kept n-gram."""

    def run(mine: pa.Table, found: pa.Table) -> pa.Table:
        held, marks = found.to_pylist(), []
        for row in mine.to_pylist():
            words, first = _words_of(row)
            keys, possible, inverse = _kinds(words, first, n)
            kept = np.zeros(len(words), bool)
            kept[possible] = (_placed(held, n, keys) > 0)[inverse]
            marks.append(_pack(np.packbits(kept)))
        return mine.set_column(mine.schema.get_field_index("kept"), "kept", pa.array(marks, pa.binary()))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, _BLOCKS)


_ANSWERS = "block bigint, n int, slice int, places binary, counts binary"


def _packed(batches: Iterable[pa.RecordBatch], n: int, part_of: int) -> Iterator[pa.RecordBatch]:
    """A row per block of what has gathered: its places in order and their counts."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, place, count = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1, 2))
        place &= 0xFFFFFFFF
        kinds, which = np.unique(block, return_inverse=True)
        order = np.argsort(which << 32 | place)
        block, place, count = kinds[which[order]], place[order], count[order]
        begins = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
        ends = np.append(begins[1:], len(block))
        places = [_pack(np.diff(place[a:b].astype(np.uint32), prepend=np.uint32(0))) for a, b in zip(begins, ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array(block[begins]), pa.array([n] * len(begins), pa.int32()), pa.array([part_of] * len(begins), pa.int32()), pa.array(places, pa.binary()), pa.array([_pack(count[a:b]) for a, b in zip(begins, ends)], pa.binary())],
            names=[x.split()[0] for x in _ANSWERS.split(", ")],
        )

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 8 * BATCH_ROWS:
            yield flush(held)
            held, rows = [], 0
    if rows:
        yield flush(held)


def _answers(rows: DataFrame, n: int, part_of: int, min_count: int) -> DataFrame:
    """The exploded n-grams with their counts in the corpus, where these are kept. Count table and join are one window
    over the hash: an aggregate beside it would explode and shuffle the same rows once more. They are dealt by block
    before they are packed; a block with very many may be split, as its packed rows need not be one."""
    counted = rows.withColumn("count", F.sum(F.shiftright("ref", 32)).over(Window.partitionBy("hash"))).where(F.col("count") >= (min_count if n > 1 else 1))
    dealt = counted.select("block", "ref", "count").hint("rebalance", F.col("block"))
    return dealt.mapInArrow(lambda b: _packed(b, n, part_of), _ANSWERS)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """materialise(), after which the shuffle files of df are gone too: the listeners' queue holds the query that ended
    last, with its shuffles, until another one has ended."""
    out = materialise(df, label)
    df.sparkSession.sql("SELECT 1").collect()
    release_memory(df.sparkSession)
    return out


_SCORES = "doc_id bigint, n_words bigint, log_prob double"


def _scores(blocks: pa.Table, answers: pa.Table, order: int, backoff: float, total: int) -> pa.Table:
    ids, sizes, sums = [], [], []
    held = answers.to_pylist()
    for row in blocks.to_pylist():
        words, first = _words_of(row)
        context, score = np.full(len(words), total, np.float64), np.zeros(len(words))
        for n in range(1, order + 1):
            keys, possible, inverse = _kinds(words, first, n)
            found = np.zeros(len(words), np.int64)
            found[possible] = _placed(held, n, keys)[inverse]
            better = np.log(np.maximum(found, 1)) - np.log(np.maximum(context, 1))
            score = np.where(found > 0, better, score + np.where(possible & (n > 1), np.log(backoff), 0.0))
            # the count of the context of the next order's n-grams: this order's n-gram one word before
            context = np.concatenate(([0.0], found[:-1].astype(np.float64))) if len(found) else context
        ids += row["doc_ids"]
        sizes += row["sizes"]
        sums += [float(score[a:b].sum()) for a, b in zip(first[:-1], first[1:])]
    return pa.table([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], names=["doc_id", "n_words", "log_prob"])


def score_documents(docs: DataFrame, *, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Returns doc_id, n_words, log_prob (natural, summed over the words) and mean_log_prob, a row per row of docs.

    Words are split at white space, A-Z in lower case. A word's score is log(count of the longest n-gram ending there
    that the table keeps / count of its context), plus log(backoff) for each longer n-gram that the document has there;
    a single word's context is all words. n-grams of two words and more are kept from min_count occurrences on, over
    all documents. Null and empty texts have 0 words, log_prob 0 and a null mean. Repeated rows count as often as they
    stand; a null doc_id stays null; an empty table stays empty. Other columns are ignored.
    """
    blocks = _stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lambda b: _blocks(b, block_tokens), _BLOCKS), "lm-blocks")
    total = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    answers: list[DataFrame] = []
    for n in range(1, order + 1):
        answers += [_stored(_answers(_rows(blocks, n, k), n, k, min_count), f"lm-answers{n}") for k in range(SLICES)]
        if 1 < n < order and min_count > 1:
            unmarked, blocks = blocks, _stored(_marked(blocks, reduce(DataFrame.unionAll, answers[-SLICES:]), n), "lm-blocks")
            for where in {os.path.dirname(x) for x in unmarked.inputFiles()}:
                drop_scratch(docs.sparkSession, where)
    every = reduce(DataFrame.unionAll, answers)
    scored = blocks.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(lambda b, a: _scores(b, a, order, backoff, total), _SCORES)
    return scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
