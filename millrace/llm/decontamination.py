"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are cut into passages of up to 64 words. Their TF-IDF matrix, with document frequencies over all
documents, is factored by a distributed randomised SVD: each round multiplies the passages' Gram matrix with a thin
matrix, partition by partition, and only that thin matrix (terms of a block of passages by rank) comes to the driver.
Documents' windows of 32 and 64 words are folded into the latent space and compared by cosine with the passages. What
the leading directions do not hold is found by its rare words: of a passage's rarest words, so many must be in any text
that could be confirmed that PREFIX_HITS of them are left after all that may be missing. A candidate is confirmed by the longest common subsequence of words, and a paraphrase, which keeps fewer of them, by the
passage's answer as well: that is its last sentence, or the column `answer` where the benchmark has one.

Items of fewer than MIN_WORDS words are searched as phrases, word by word. In scripts that are written without spaces
every character is a word.

Searching is a map over whole documents, without a shuffle: documents are read once for the frequencies of all terms
and once for the search. The benchmark is the query set: its blocks of BLOCK_PASSAGES passages bound the matrices that
are factored, and a task holds the indexes of all blocks, some 5 MB a thousand passages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialise, release_memory, table
from millrace.llm.shingles import mix, text_chunks, word_hashes

PASSAGE_WORDS, CELL_WORDS = 64, 16
#: Windows are so many cells long and begin at every cell.
SCALES = (2, 4)
BLOCK_PASSAGES = 2048
RANK, OVERSAMPLING, ROUNDS = 128, 16, 2
#: Cosine from which a window is a candidate for a passage.
MIN_COSINE = 0.14
#: Share of the passage's words in order in the document: enough alone, and enough with the answer found.
MIN_LCS, MIN_LCS_WITH_ANSWER = 0.8, 0.7
#: Rare words of a passage that a window must hold to be a candidate whatever its cosine, where the passage has enough.
PREFIX_HITS = 3
#: Share of the answer's words that must be there in order.
MIN_ANSWER = 0.8
#: Items of fewer words are too short for shares of words: they are held where all their words follow each other.
MIN_WORDS = 8
#: Phrases of a block.
BLOCK_PHRASES = 1 << 16
#: Bytes that separate words: all of ASCII but digits and letters.
_BREAKS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
#: Bytes that begin characters from U+0800 on.
_FAR = re.compile(rb"[\xe0-\xff]")
#: Characters of scripts without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Tai, Javanese, Yi, kana, bopomofo, Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u302f\u3031-\u303c\u3040-\u30fa\u30fc-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00016fe0-\U00018dff\U0001b000-\U0001b16f\U00020000-\U0003ffff]")
#: Their spaces and punctuation.
_WIDE_BREAKS = re.compile("[\u3000-\u3004\u3008-\u3020\u3030\u303d-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])|\n")


def _plain(text: bytes) -> bytes:
    if text.isascii():
        return text.translate(_BREAKS)
    lower = text.decode("utf-8", "replace").lower()
    if _FAR.search(text):
        lower = _UNSPACED.sub(r" \g<0> ", _WIDE_BREAKS.sub(" ", lower))
    return lower.encode().translate(_BREAKS)


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([_plain(t) for t in texts])


def _word_list(text: str | None) -> list[int]:
    return _words([(text or "").encode()])[0].tolist()


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of a."""
    places: dict[int, int] = {}
    for k, word in enumerate(a):
        places[word] = places.get(word, 0) | (1 << k)
    full = (1 << len(a)) - 1
    rows = full
    for word in b:
        met = rows & places.get(word, 0)
        rows = ((rows + met) | (rows - met)) & full
    return len(a) - rows.bit_count()


@dataclass
class Passage:
    item_id: int
    words: list[int]
    answer: list[int]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items, parts, words, answers = [], [], [], []
        for item, text, answer in zip(*(c.to_pylist() for c in batch.columns)):
            found = _word_list(text)
            if not found:
                continue
            if answer is None:
                answer = next((x for x in reversed(_SENTENCE.split(text)) if _word_list(x)), "")
            step = PASSAGE_WORDS // 2
            for part, low in enumerate(range(0, max(1, len(found) - step), step) if len(found) > PASSAGE_WORDS else [0]):
                items.append(item)
                parts.append(part)
                words.append(np.array(found[low : low + PASSAGE_WORDS], np.uint64).tobytes())
                answers.append(np.array(_word_list(answer), np.uint64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(parts, pa.int32()), pa.array(words, pa.binary()), pa.array(answers, pa.binary())], names=["item_id", "part", "words", "answer"])


def passages_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, part, words, answer), words as packed hashes; items with a null id or without words have none.
    Reads item_id, text and, if there is one, answer."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint"), "text", answer.alias("answer"))
    return rows.mapInArrow(_cut, "item_id bigint, part int, words binary, answer binary").distinct()


def _lookup(vocabulary: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Each word's place in the sorted vocabulary, or -1."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, at, -1)


def _document_counts(batches: Iterable[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many documents of the partition a term is; term -1 counts the documents."""
    counts, documents = np.zeros(len(vocabulary), np.int64), 0
    for batch in batches:
        for _, texts in text_chunks(batch, 0):
            words, first = _words(texts)
            term = _lookup(vocabulary, words)
            document = np.repeat(np.arange(len(texts)), np.diff(first))
            both = np.unique((document * len(vocabulary) + term)[term >= 0])
            counts += np.bincount(both % len(vocabulary), minlength=len(vocabulary))
            documents += len(texts)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int32()), pa.array([documents, *counts[some]], pa.int64())], names=["term", "n"])


def _gram_times(passages: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """A'A times thin, A being the TF-IDF matrix of the passages: partial products by partition, added term by term."""
    width = thin.shape[1]

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(thin.shape)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                term, times = np.unique(_lookup(vocabulary, np.frombuffer(packed, np.uint64)), return_counts=True)
                row = times[term >= 0] * idf[term[term >= 0]]
                row = row / (np.linalg.norm(row) or 1.0)
                out[term[term >= 0]] += np.outer(row, row @ thin[term[term >= 0]])
        some = np.flatnonzero(out.any(axis=1))
        for low in range(0, len(some), 4096):
            part = some[low : low + 4096]
            flat = pa.array(out[part].reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), flat)], names=["term", "v"])

    rows = passages.select("words").mapInArrow(partial, "term int, v array<double>")
    summed = rows.groupBy("term").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(width)]).toPandas()
    out = np.zeros(thin.shape)
    out[summed["term"].to_numpy()] = summed.drop(columns="term").to_numpy()
    return out


def randomised_svd(passages: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors of the passages' TF-IDF matrix: (terms, up to rank)."""
    width = min(rank + OVERSAMPLING, len(vocabulary))
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((len(vocabulary), width)))[0]
    for _ in range(ROUNDS):
        basis = np.linalg.qr(_gram_times(passages, vocabulary, idf, basis))[0]
    values, inner = np.linalg.eigh(basis.T @ _gram_times(passages, vocabulary, idf, basis))
    order = np.argsort(values)[::-1][:rank]
    order = order[values[order] > 1e-9]
    return basis @ inner[:, order]


def rare_prefix(term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, int]:
    """The passage's rarest terms, and how many of them are in every text whose LCS with it is enough: PREFIX_HITS, or
    what all its terms give. term has the passage's words in order."""
    kinds, times = np.unique(term, return_counts=True)
    order = np.lexsort((kinds, -idf[kinds]))
    kinds, times = kinds[order], times[order]
    spare = max(k for k in range(len(term) + 1) if (len(term) - k) / len(term) >= MIN_LCS_WITH_ANSWER)
    sure = 0
    for k in range(1, len(kinds) + 1):
        # a term is gone when all its words are: the cheapest go first
        sure = k - int(np.searchsorted(np.cumsum(np.sort(times[:k])), spare, "right"))
        if sure >= PREFIX_HITS:
            return kinds[:k], sure
    return kinds, sure


class Index:
    """A block of passages in the latent space, and the search of texts against it."""

    def __init__(self, passages: list[Passage], vocabulary: np.ndarray, idf: np.ndarray, unseen: float, vectors: np.ndarray):
        self.passages, self.vocabulary = passages, vocabulary
        self.squares, self.unseen = (idf**2).astype(np.float32), np.float32(unseen**2)
        self.fold = (idf[:, None] * vectors).astype(np.float32)
        latent = np.zeros((len(passages), vectors.shape[1]), np.float32)
        self.sure = np.zeros(len(passages), np.int64)
        rare = []
        for k, p in enumerate(passages):
            term = _lookup(vocabulary, np.array(p.words, np.uint64))
            latent[k] = self.fold[term].sum(axis=0)
            prefix, self.sure[k] = rare_prefix(term, idf)
            rare.append(np.stack((prefix, np.full(len(prefix), k))))
        terms, holders = np.concatenate(rare, axis=1)
        self.holders = holders[np.argsort(terms, kind="stable")]
        self.holders_at = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=len(vocabulary)))))
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def _by_rare_words(self, cell: np.ndarray, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, passage) of the largest scale, by the cell it begins at, where the window and the cells next to it
        hold enough rare words. cell and term are the terms that cells hold; low and high are the cells of a cell's
        document."""
        many = self.holders_at[term + 1] - self.holders_at[term]
        cell = np.repeat(cell, many)
        passage = self.holders[np.arange(len(cell)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.holders_at[term], many)]
        window = cell[:, None] + np.arange(-SCALES[-1], 2)
        inside = (window >= low[cell][:, None]) & (window < high[cell][:, None])
        both, times = np.unique((window * len(self.passages) + passage[:, None])[inside], return_counts=True)
        window, passage = np.divmod(both, len(self.passages))
        enough = times >= self.sure[passage]
        return window[enough], passage[enough]

    def candidates(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, np.ndarray, float]]:
        """(text, passage, first and last word of the window, the text's words, cosine)."""
        words, first = _words(texts)
        if not len(words):
            return
        term, size = _lookup(self.vocabulary, words), np.diff(first)
        cells = -(-size // CELL_WORDS)
        base = np.concatenate(([0], np.cumsum(cells)))
        cell = np.repeat(base[:-1], size) + (np.arange(len(words)) - np.repeat(first[:-1], size)) // CELL_WORDS
        square = np.full(len(term), self.unseen)
        # a term counts once in a cell
        both = np.unique((cell * len(self.vocabulary) + term)[term >= 0])
        held_cell, held = np.divmod(both, len(self.vocabulary))
        square[term >= 0] = 0
        vector, norm = np.zeros((base[-1], self.fold.shape[1]), np.float32), np.bincount(cell, square, base[-1])
        if not len(held):
            return
        norm += np.bincount(held_cell, self.squares[held], base[-1])
        # a cell has few terms: add their vectors place by place
        starts = np.flatnonzero(np.diff(held_cell, prepend=-1))
        place = np.arange(len(held)) - np.repeat(starts, np.diff(starts, append=len(held)))
        for k in range(CELL_WORDS):
            some = place == k
            vector[held_cell[some]] += self.fold[held[some]]
        document, end = np.repeat(np.arange(len(texts)), cells), np.repeat(base[1:], cells)
        rare = self._by_rare_words(held_cell, held, np.repeat(base[:-1], cells), end)
        here, reach = np.arange(base[-1]), 1
        for scale in SCALES:
            while reach < scale:
                near = np.minimum(here + reach, base[-1] - 1)
                inside = here + reach < end
                vector, norm = vector + vector[near] * inside[:, None], norm + norm[near] * inside
                reach *= 2
            length = np.sqrt(np.maximum(norm, 1e-9)).astype(np.float32)
            product = vector @ self.latent.T
            near = product >= MIN_COSINE * length[:, None]
            if scale == SCALES[-1]:
                near[rare] = True
            for c, p in np.argwhere(near):
                d = document[c]
                low = first[d] + (c - base[d]) * CELL_WORDS
                yield d, p, max(first[d], low - CELL_WORDS), min(first[d + 1], low + (scale + 1) * CELL_WORDS), words, float(product[c, p] / length[c])

    def search(self, texts: list[bytes]) -> list[dict[int, tuple[float, float, float]]]:
        """Per text {item_id: (cosine, share of words, share of the answer)} of its confirmed passages, the best each."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        for d, p, low, high, words, cosine in self.candidates(texts):
            passage = self.passages[p]
            if found[d].get(passage.item_id, (0, 0, 0))[1] == 1.0:
                continue
            region = words[low:high].tolist()
            there = set(region)
            if sum(w in there for w in passage.words) < MIN_LCS_WITH_ANSWER * len(passage.words):
                continue
            share = lcs_length(passage.words, region) / len(passage.words)
            if share < MIN_LCS_WITH_ANSWER:
                continue
            answer = lcs_length(passage.answer, region) / len(passage.answer) if passage.answer else 0.0
            if share >= MIN_LCS or answer >= MIN_ANSWER:
                found[d][passage.item_id] = max(found[d].get(passage.item_id, (0.0, 0.0, 0.0)), (cosine, share, answer), key=lambda x: x[1])
        return found


class Phrases:
    """A block of items of fewer than MIN_WORDS words, and the search of texts for them."""

    def __init__(self, passages: list[Passage]):
        self.factors = np.random.default_rng(104).integers(0, 1 << 64, MIN_WORDS, np.uint64) | np.uint64(1)
        held: dict[int, dict[int, list[Passage]]] = {}
        for p in passages:
            key = int(self._rolled(np.array(p.words, np.uint64), len(p.words))[0])
            held.setdefault(len(p.words), {}).setdefault(key, []).append(p)
        self.held = {n: (np.array(sorted(keys), np.uint64), [keys[k] for k in sorted(keys)]) for n, keys in held.items()}

    def _rolled(self, words: np.ndarray, n: int) -> np.ndarray:
        """A hash for each n words in a row."""
        out = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            out += words[k : k + len(out)] * self.factors[k]
        return mix(out)

    def search(self, texts: list[bytes]) -> list[dict[int, tuple[float, float, float]]]:
        """As Index.search: cosine and share of words of what is there word by word are 1."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        words, first = _words(texts)
        for n, (keys, members) in self.held.items():
            if len(words) < n:
                continue
            rolled = self._rolled(words, n)
            at = np.minimum(np.searchsorted(keys, rolled), len(keys) - 1)
            place = np.flatnonzero(keys[at] == rolled)
            text = np.searchsorted(first, place, "right") - 1
            for w, d in zip(place.tolist(), text.tolist()):
                if w + n > first[d + 1]:
                    continue
                for p in members[at[w]]:
                    best = found[d].get(p.item_id)
                    if best and (best[2] == 1.0 or not p.answer) or words[w : w + n].tolist() != p.words:
                        continue
                    region = words[max(first[d], w - CELL_WORDS) : min(first[d + 1], w + n + CELL_WORDS)].tolist()
                    answer = lcs_length(p.answer, region) / len(p.answer) if p.answer else 0.0
                    found[d][p.item_id] = max(best or (1.0, 1.0, 0.0), (1.0, 1.0, answer))
        return found


def _held(rows: DataFrame) -> list[Passage]:
    return [Passage(r.item_id, np.frombuffer(r.words, np.uint64).tolist(), np.frombuffer(r.answer, np.uint64).tolist()) for r in rows.orderBy("item_id", "part").collect()]


def build_indexes(docs: DataFrame, benchmark: DataFrame, *, rank: int = RANK) -> list[Index | Phrases]:
    """An index for each block of passages and of phrases; none for a benchmark without words. Documents are read once,
    for the document frequencies of all blocks."""
    every = materialise(passages_of(benchmark), "bench-passages")
    short = F.octet_length("words") < 8 * MIN_WORDS
    passages, phrases = every.where(~short), every.where(short)
    blocks, phrase_blocks = -(-passages.count() // BLOCK_PASSAGES), -(-phrases.count() // BLOCK_PHRASES)
    out: list[Index | Phrases] = []
    for block in range(phrase_blocks):
        held = _held(phrases.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(phrase_blocks)) == block))
        if held:
            out.append(Phrases(held))
    parts = [passages.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(blocks)) == block) for block in range(blocks)]
    members = [(mine, held) for mine in parts if (held := _held(mine))]
    if not members:
        return out
    own = [np.unique(np.concatenate([np.array(p.words, np.uint64) for p in held])) for _, held in members]
    total = np.unique(np.concatenate(own))
    counted = docs.select("text").mapInArrow(lambda b: _document_counts(b, total), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    n, seen = dict(zip(counted["term"], counted["n"])), np.zeros(len(total))
    documents = n.pop(-1, 0)
    seen[list(n)] = list(n.values())
    every_idf = np.log((documents + 1) / (seen + 1)) + 0.05
    for (mine, held), vocabulary in zip(members, own):
        idf = every_idf[_lookup(total, vocabulary)]
        out.append(Index(held, vocabulary, idf, float(np.median(idf)), randomised_svd(mine, vocabulary, idf, rank)))
    release_memory(docs.sparkSession)
    return out


_FOUND = "doc_id bigint, item_id bigint, cosine double, lcs double, answer double"


def _hits(indexes: list[Index | Phrases]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch, 1):
                ids = batch.column(0).slice(start, len(texts)).to_pylist()
                rows = [(ids[d], item, *scores) for index in indexes for d, hits in enumerate(index.search(texts)) for item, scores in hits.items()]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in _FOUND.split(", ")])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item that it holds: doc_id, item_id, cosine, lcs, answer (best of all places).

    Clean documents have no row. Null and empty texts hold nothing; rows of one doc_id count as one document; an empty
    table on either side gives an empty result. Other columns are ignored.
    """
    indexes = build_indexes(docs, benchmark)
    if not indexes:
        return docs.sparkSession.createDataFrame([], _FOUND)
    out = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_hits(indexes), _FOUND)
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])


def _clean(indexes: list[Index | Phrases], column: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not any(found) for _, texts in text_chunks(batch, column) for found in zip(*(index.search(texts) for index in indexes))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns pass through. Rows are judged one by one, those
    with a null doc_id too."""
    indexes = build_indexes(docs, benchmark)
    return docs.mapInArrow(_clean(indexes, docs.columns.index("text")), docs.schema) if indexes else docs


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
