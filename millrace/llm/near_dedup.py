"""MinHash near-dedup with min-max hashing.

Each permutation is evaluated once and gives two signature values, its minimum and its maximum over the document's
shingle set: 100 evaluations are a signature of 200 values, banded into 40 bands of 5. At similarity 0.8 a pair misses
all bands with probability 1e-7.

Equal sets are collapsed to one before anything else. In a bucket (the sets that agree in a band) every set is compared
with one hub, the set that shares most buckets with others, and confirmed links are joined into components. Buckets
whose sets are then still in several components have each set outside the bucket's largest component compared with the
sets of the other components, which completes the comparison exactly: pairs within a component need none.

Before full sets are compared, and before such pairs leave a join, a bitmap per set (4 bits or more per shingle) gives
an upper bound of the intersection. It never drops a link, and it drops nearly all pairs of a group whose members are
alike but not similar enough. A pair leaves the join in the first band that it shares and in no other. What is left is
confirmed on full sets. Inside the join a bucket still costs its sets outside the largest component times all its sets:
a group whose members are mostly linked to no hub is compared pair by pair, which exact links need there.

Copies of a set are counted per salt of their doc_ids first, so that no task gets all rows of a set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialise, table
from millrace.llm.components import connected_components
from millrace.llm.shingles import mix, shingle_sets, text_chunks

PERMUTATIONS, BAND_ROWS = 100, 5
#: Sets up to so many are sent to all executors as (number, hash, id) when their texts are fetched, 40 bytes each; of
#: more, the texts are shuffled.
BROADCAST_SETS = 500_000
#: Parts into which the rows of one set are dealt.
SALTS = 256
_U = np.uint64


def _bands(sets: list[np.ndarray], permutations: int = PERMUTATIONS, rows: int = BAND_ROWS) -> np.ndarray:
    """(sets, bands) hashes; sets must not be empty."""
    flat, begin = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    random = np.random.default_rng(104)
    factors, shifts = random.integers(0, 1 << 64, permutations, _U) | _U(1), random.integers(0, 1 << 64, permutations, _U)
    low, high = np.empty((permutations, len(sets)), _U), np.empty((permutations, len(sets)), _U)
    held = np.empty_like(flat)
    for k in range(permutations):
        np.multiply(flat, factors[k], out=held)
        held += shifts[k]
        np.minimum.reduceat(held, begin, out=low[k])
        np.maximum.reduceat(held, begin, out=high[k])
    values = np.concatenate([low, high]).reshape(-1, rows, len(sets))
    out = np.zeros((len(values), len(sets)), _U)
    for k in range(rows):
        out = mix(out ^ values[:, k, :]) + _U(k + 1)
    return mix(out + np.arange(len(values), dtype=_U)[:, None] * _U(0x9E3779B97F4A7C15)).T


def _bits(values: np.ndarray) -> np.ndarray:
    """A bit for each value modulo the bitmap's size, a power of two of at least 4 bits per value."""
    size = 1 << max(6, (4 * len(values) - 1).bit_length())
    out = np.zeros(size, np.uint8)
    out[values & _U(size - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts]), pa.int64()))


def _set_hash(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


_SIGNED = "doc_id bigint, n_shingles bigint, set_hash binary, bands array<bigint>, bits array<bigint>"


def _signed(batch: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, np.int64)
    for rows in batch:
        for start, texts in text_chunks(rows, 1):
            sets = shingle_sets(texts, width)
            bands: list[np.ndarray] = [none] * len(sets)
            full = [k for k, s in enumerate(sets) if len(s)]
            for k, own in zip(full, _bands([sets[k] for k in full]) if full else ()):
                bands[k] = own.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).slice(start, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_hash(s) if len(s) else None for s in sets], pa.binary()),
                    _lists(bands),
                    _lists([_bits(s) if len(s) else none for s in sets]),
                ],
                names=[x.split()[0] for x in _SIGNED.split(", ")],
            )


def _with_sets(batch: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for rows in batch:
        for start, texts in text_chunks(rows, 2):
            sets = shingle_sets(texts, width)
            number, wanted = (rows.column(k).slice(start, len(texts)).to_pylist() for k in (0, 1))
            right = [(n, s) for n, h, s in zip(number, wanted, sets) if len(s) and _set_hash(s) == h]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in right], pa.int64()), _lists([s.view(np.int64) for _, s in right])], names=["set_no", "shingles"])


# What both bitmaps have, the larger one folded to the size of the other; and the values that share a bit with another.
_FOLDED = "IF(size({0}) > size({1}), zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (p, q) -> p | q), {0})"
_COUNT = "aggregate({0}, 0L, (s, w) -> s + bit_count(w))"


def _may_link(a: str, b: str, na: str, nb: str, percent: int) -> str:
    """SQL: neither the sizes nor the bitmaps rule out a link. Sizes of which one is above twice the other never get
    to the bitmaps, so that one fold is enough."""
    x, y = _FOLDED.format(a, b), _FOLDED.format(b, a)
    both = _COUNT.format(f"zip_with({x}, {y}, (p, q) -> p & q)")
    most = f"({both} + least({na} - {_COUNT.format(x)}, {nb} - {_COUNT.format(y)}))"
    return f"(least({na}, {nb}) * 100 >= greatest({na}, {nb}) * {percent} AND (least({na}, {nb}) * 2 < greatest({na}, {nb}) OR {most} * 100 >= ({na} + {nb} - {most}) * {percent}))"


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """Returns doc_id, n_shingles, component_id and kept, a row per row of docs (doc_id, text; other columns ignored).

    Documents are linked whose sets of shingles of `width` words have 100 * intersection >= percent * union;
    component_id is the smallest doc_id that links reach, and kept tells whether the document is that one. A null or
    empty text has no shingles and is linked with nothing. Rows with a null doc_id are linked with nothing, have a null
    component_id and are kept. Rows that repeat a doc_id are one document, with the links of all its texts. An empty
    table gives an empty result.
    """
    signed = materialise(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lambda b: _signed(b, width), _SIGNED), "near-signed")
    known = signed.where("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    salted = known.select("doc_id", "set_hash", "n_shingles", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = materialise(salted.groupBy("set_hash", "salt").agg(F.min("doc_id").alias("least")), "near-parts")
    first = parts.groupBy("set_hash").agg(F.min("least").alias("rep"))
    reps = parts.select("set_hash", "salt").join(first, "set_hash")
    placed = materialise(salted.join(reps, ["set_hash", "salt"]).select("doc_id", "set_hash", "n_shingles", "rep"), "near-placed")
    chosen = known.join(placed.where("doc_id = rep").select("doc_id", "set_hash").distinct(), ["doc_id", "set_hash"], "left_semi").dropDuplicates(["doc_id", "set_hash"])
    sets = materialise(chosen.select(F.monotonically_increasing_id().alias("set_no"), "set_hash", F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands", "bits"), "near-sets")
    banded = sets.select(F.explode("bands").alias("band"), "set_no")
    crowded = banded.groupBy("band").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    members = materialise(banded.join(crowded, "band"), "near-members")
    score = members.groupBy("set_no").agg(F.sum("crowd").alias("score"))
    hubs = members.join(score, "set_no").groupBy("band").agg(F.max(F.struct("score", "set_no"))["set_no"].alias("hub"))
    stars = members.join(hubs, "band").where("set_no <> hub").select(F.least("set_no", "hub").alias("a"), F.greatest("set_no", "hub").alias("b")).distinct()
    stars = materialise(_plausible(stars, sets, percent), "near-stars")
    # a document with several texts links their sets
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    same = placed.join(several, "doc_id").select(F.col("rep").alias("u"), F.col("lo").alias("v"))
    links = materialise(_confirmed(stars, sets, docs, width, percent).unionAll(same), "near-links")
    open_ = materialise(_open_pairs(members, sets, connected_components(links), percent).join(stars.select("a", "b"), ["a", "b"], "left_anti"), "near-open")
    links = links.unionAll(_confirmed(open_, sets, docs, width, percent))
    components = connected_components(links)
    found = placed.select("doc_id", "n_shingles", "rep").join(components, F.col("rep") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = signed.where("set_hash IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionAll(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose bitmaps don't rule out a link."""
    x = sets.select(F.col("set_no").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    y = sets.select(F.col("set_no").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    return pairs.join(x, "a").join(y, "b").where(_may_link("ba", "bb", "na", "nb", percent)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The (u, v) document ids of distinct pairs (a, b) whose full sets are similar enough, from their texts."""
    numbers = pairs.select(F.col("a").alias("set_no")).unionAll(pairs.select("b")).distinct()
    wanted = materialise(sets.select("set_no", "set_hash", "rep").join(numbers, "set_no", "left_semi"), "near-wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_SETS else wanted
    rows = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(side, "rep").select("set_no", "set_hash", "text")
    full = materialise(rows.mapInArrow(lambda b: _with_sets(b, width), "set_no bigint, shingles array<bigint>").join(wanted.select("set_no", "rep"), "set_no"), "near-full")
    # repeated rows of a document give a set more than once
    x = full.select(F.col("set_no").alias("a"), F.col("rep").alias("u"), F.col("shingles").alias("sa"))
    y = full.select(F.col("set_no").alias("b"), F.col("rep").alias("v"), F.col("shingles").alias("sb"))
    counted = pairs.join(x, "a").join(y, "b").select("u", "v", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("c"))
    return counted.where(F.col("c") * 100 >= (F.col("na") + F.col("nb") - F.col("c")) * percent).select("u", "v")


def _open_pairs(members: DataFrame, sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """The plausible pairs (a, b) of sets that share a bucket and are in different components."""
    known = sets.select("set_no", "rep", "n", "bits").join(components, F.col("rep") == F.col("node"), "left").select("set_no", "n", "bits", F.coalesce("component", "rep").alias("c"))
    placed = materialise(members.select("band", "set_no").join(known.select("set_no", "c"), "set_no"), "near-placed-members")
    per = placed.groupBy("band", "c").agg(F.count(F.lit(1)).alias("m"))
    main = per.groupBy("band").agg(F.max(F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("m").alias("all"))
    # a bucket of two has had its one comparison
    several = main.where("parts > 1 AND all > 2").select("band", F.col("top.c").alias("top"))
    left = placed.join(several, "band")
    # the buckets of a set that are left, in one order for all sets
    own = left.groupBy("set_no").agg(F.sort_array(F.collect_list("band")).alias("buckets"))
    left = materialise(left.join(known.select("set_no", "n", "bits").join(own, "set_no"), "set_no"), "near-left")
    x = left.where("c <> top").select("band", *[F.col(k).alias(f"x_{k}") for k in ("set_no", "n", "bits", "c", "buckets")])
    y = left.select("band", F.col("top").alias("y_top"), *[F.col(k).alias(f"y_{k}") for k in ("set_no", "n", "bits", "c", "buckets")])
    # both ways round if both are outside the largest component; once is enough
    once = "(y_c = y_top OR x_set_no < y_set_no)"
    first = "array_min(array_intersect(x_buckets, y_buckets)) = band"
    near = f"least(x_n, y_n) * 100 >= greatest(x_n, y_n) * {percent}"
    pairs = x.join(y, "band").where(f"x_c <> y_c AND {once} AND {near} AND {first} AND {_may_link('x_bits', 'y_bits', 'x_n', 'y_n', percent)}")
    return pairs.select(F.least("x_set_no", "y_set_no").alias("a"), F.greatest("x_set_no", "y_set_no").alias("b"))


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
