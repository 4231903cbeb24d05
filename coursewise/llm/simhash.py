"""Operator 7: SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into four segments of 16 bits.  If two fingerprints
differ in at most three bits, some segment i is equal and the segment after
it differs in at most one bit, for a suitable i: were it not so, the three
bits would have to spoil four successors.  The perfect Golay code (23 bits,
4096 codewords, every word within 3 bits of exactly one) makes the second
condition a join: a segment's own key is the index of its nearest codeword,
its near keys are the indices of the codewords nearest to it and to all words
one bit away (one to six of them).  One side joins its four own keys, the
other all its near keys, each together with the equal segment; XOR and a bit
count verify what meets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_CHARS, text_batches, written
from .components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
_SEGMENTS, _SEGMENT_BITS = 4, 16
# Fixed value: generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code
_GOLAY = 0b110001110101


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles; bit set if it is set in over half of the shingle hashes, 0 without words.

    Words are split at ASCII white space and A-Z are lower-cased.  Shingles are
    handled in blocks, so a very long text needs no more memory than its words.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    span = min(shingle_words, len(words)) - 1
    n = len(words) - span
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK_CHARS // 8):
        j = min(n, i + BLOCK_CHARS // 8)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(start[i:j].tolist(), end[i + span:j + span].tolist(), strict=True)),
                             np.uint64, j - i)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) // 255 * 255  # sums of 255 bits fit in a byte
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp bigint) of every row; null texts count as empty, other columns are not read."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


@functools.lru_cache(maxsize=1)
def golay_keys() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16-bit word (padded to 23): own codeword index; flat near indices and their offsets."""
    def syndrome(words: np.ndarray) -> np.ndarray:
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest ^= np.where(rest >> bit & 1, _GOLAY << (bit - 11), 0)
        return rest

    bits = 1 << np.arange(23)
    two = (bits[:, None] ^ bits)[np.triu_indices(23, 1)]
    three = np.unique([a ^ b for a in two for b in bits if a & b == 0])
    errors = np.concatenate([[0], bits, two, three])
    leader = np.zeros(1 << 11, np.int64)
    leader[syndrome(errors)] = errors  # perfect code: each syndrome belongs to one error of at most 3 bits
    # the 16 bits lie at the top: 12 message bits and 4 check bits
    words = np.arange(1 << _SEGMENT_BITS) << 7
    near = np.concatenate([words[:, None], words[:, None] ^ bits[7:]], axis=1)
    index = np.sort((near ^ leader[syndrome(near.ravel())].reshape(near.shape)) >> 11, axis=1)
    fresh = np.concatenate([np.ones((len(index), 1), bool), index[:, 1:] != index[:, :-1]], axis=1)
    own = (words ^ leader[syndrome(words)]) >> 11
    return own, index[fresh], np.concatenate([[0], np.cumsum(fresh.sum(axis=1))])


def _keys(fps: np.ndarray, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the own or near keys of fingerprints: which segment, its 16 bits, codeword index of the next one."""
    own, flat, offset = golay_keys()
    rows, keys = [], []
    for i in range(_SEGMENTS):
        equal = fps >> (16 * i) & 0xFFFF
        other = fps >> (16 * ((i + 1) % _SEGMENTS)) & 0xFFFF
        prefix = (i << 28) + (equal << 12)
        if near:
            count = offset[other + 1] - offset[other]
            row = np.repeat(np.arange(len(fps)), count)
            at = np.repeat(offset[other] - (np.cumsum(count) - count), count) + np.arange(len(row))
            rows.append(row)
            keys.append(prefix[row] + flat[at])
        else:
            rows.append(np.arange(len(fps)))
            keys.append(prefix + own[other])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(classes: DataFrame, near: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            row, key = _keys(fps, near)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], ["key", "fp"])

    return classes.select("fp").mapInArrow(run, "key bigint, fp bigint")


def links(classes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b), a < b: the pairs of distinct fingerprints (column fp) that differ in at most ``max_distance`` bits.

    No link is lost for distances up to three; more would need other segments
    and is refused.  A pair may come more than once, by several keys.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("four segments find distances up to 3")
    own = _keyed(classes, False).withColumnRenamed("fp", "a")
    near = _keyed(classes, True).withColumnRenamed("fp", "b")
    return own.join(near, (own.key == near.key) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                    max_distance: int = MAX_DISTANCE, seed: int = SEED) -> DataFrame:
    """(id, fp bigint, component) of every row of ``docs``; component is the smallest id reachable over links.

    Copies share a fingerprint and are linked once, as a class.  Null and empty
    texts have fingerprint zero and link like any other.  Rows that repeat id
    and text get the same component, other texts under the id their own; a null id is never a component unless nothing
    else is reachable, and then the component is null.  An empty table gives
    no rows; columns other than id and text are not read.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle_words, seed), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes, max_distance))
    joined = classes.join(roots, classes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    joined = written(joined, "class_roots")
    named = joined.groupBy("root").agg(F.min("least").alias("component"))
    of_class = written(joined.join(named, "root").select("fp", "component"), "class_components")
    return rows.join(of_class, "fp").select(F.col("id").alias(id_col), "fp", "component")
