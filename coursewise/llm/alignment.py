"""Operator 13: alignment of two tokenizers' tokens by interval coalescing.

Both tokenizers cut the same bytes.  All tokens of both sides are sorted by
their start, ends are accumulated as a running maximum, and a group breaks
where a start reaches that maximum: there tokens of both sides end.  Overlaps
are expanded within the groups.

How often an id pair is linked in the whole corpus comes from one aggregation.
Documents are handled in chunks; a chunk asks for the counts of its distinct
pairs, each once, and gets them by a join, so what is shuffled is far less
than one row a link.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, text_batches, written

#: Links of one chunk after which a new one begins, and documents of a chunk; a longer document is a chunk by itself.
CHUNK_LINKS, CHUNK_ROWS = 1 << 19, 1000
#: Characters that are aligned at once.
_ALIGN_CHARS = 1 << 18
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")

Encoder = Callable[[list[str]], list[list[int]]]


# Fixed value: how byte-level vocabularies of this kind cut a text before merging
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# beyond these letters the Unicode version of the library decides what a letter is
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def _byte_level(path: str) -> tuple[Encoder, list[bytes]]:
    """Ids of space + text and the bytes of every entry of a byte-level vocabulary.

    Where the file's merges are its entries in order, tiktoken merges the same
    entries in a fraction of the time; it takes the Latin texts.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = True  # their strings inside a text are ordinary text
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    entries = [b""] * library.get_vocab_size(with_added_tokens=True)
    for token, i in vocab.items():
        entries[i] = token.encode() if i in added else bytes(map(byte_of.__getitem__, token))
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    in_order = all(vocab.get(left + right) == 256 + i for i, (left, right) in enumerate(merges))
    plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    fast = Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries) if i not in added}, special_tokens={}) if in_order and plain else None

    def encode(texts: list[str]) -> list[list[int]]:
        other = [i for i, t in enumerate(texts) if fast is None or _BEYOND_LATIN.search(t)]
        slow = dict(zip(other, library.encode_batch_fast([" " + texts[i] for i in other], add_special_tokens=False), strict=True))
        return [slow[i].ids if i in slow else fast.encode_ordinary(" " + t) for i, t in enumerate(texts)]

    return encode, entries


def _pieces(path: str) -> tuple[Encoder, list[bytes]]:
    """Ids of a text (the model adds the space) and the bytes of every piece."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: library.encode(texts, num_threads=1), entries


class Vocabulary:
    """An encoder with the bytes and the decimal digits of its ids."""

    def __init__(self, path: str) -> None:
        self.encode, self.entries = (_pieces if path.endswith(".model") else _byte_level)(path)
        self.length = np.fromiter(map(len, self.entries), np.int64, len(self.entries))
        self.width = len(str(len(self.entries)))
        self.digits = np.zeros((len(self.entries), self.width + 1), np.uint8)
        for i in range(len(self.entries)):
            said = str(i).encode()
            self.digits[i, :len(said)] = np.frombuffer(said, np.uint8)
        self.n_digits = (self.digits > 0).sum(axis=1)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, loaded once per Python worker."""
    return Vocabulary(path)


def _spans(sizes: np.ndarray) -> np.ndarray:
    """Starts of consecutive spans."""
    return np.cumsum(sizes) - sizes


def coalesce(start: np.ndarray, end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The group of every interval: groups break where a start reaches the running maximum of the ends before it.

    ``other`` marks the second side; it only decides among equal starts, so
    that the order is one and the same.  No interval is empty.
    """
    order = np.lexsort((other, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.append(False, start[order][1:] >= reach[:-1])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a index, b index) of all overlapping pairs, by b; each side is sorted and without overlaps among its own."""
    first = np.searchsorted(a_end, b_start, "right")
    count = np.searchsorted(a_start, b_end, "left") - first
    b = np.repeat(np.arange(len(b_start)), count)
    return np.repeat(first - _spans(count), count) + np.arange(len(b)), b


def _groups_text(a: Vocabulary, b: Vocabulary, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray,
                 doc_groups: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document; a document's groups are consecutive, ``doc_groups`` has their number."""
    group = np.concatenate([a_group, b_group])
    side = np.repeat(np.array([0, 1]), (len(a_ids), len(b_ids)))
    order = np.argsort(2 * group + side, kind="stable")
    width = max(a.width, b.width) + 1
    text = np.zeros((len(order), width), np.uint8)
    size = np.concatenate([a.n_digits[a_ids], b.n_digits[b_ids]])[order]
    text[:len(a_ids), :a.width] = a.digits[a_ids, :a.width]
    text[len(a_ids):, :b.width] = b.digits[b_ids, :b.width]
    text = text[order]
    group, side = group[order], side[order]
    last = np.append(group[1:] != group[:-1], True)
    turn = np.append(side[1:] != side[:-1], False) & ~last
    text[np.arange(len(order)), size] = np.where(last, ord(";"), np.where(turn, ord("|"), ord(",")))
    flat = text[np.arange(width) <= size[:, None]].tobytes()
    ends = np.cumsum(size + 1)
    # the last sign of a document is the semicolon after its last group
    stops = np.append(0, ends[np.searchsorted(group, np.cumsum(doc_groups), "left") - 1])
    return [flat[i:j - 1] for i, j in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def align(a: Vocabulary, b: Vocabulary, texts: list[str | None]) -> Iterator[tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive blocks of ``texts``: (numbers by name, digests, pairs, their links, their documents' ends).

    ``pairs`` are the distinct (A id, B id) pairs of each document as
    ``A << 32 | B``, sorted within it.  A text that is null, empty, or whose
    joined tokens are not the bytes of space + text on either side, has zeros
    and an empty digest.
    """
    for i, j in blocks(texts, _ALIGN_CHARS):
        block = [t or "" for t in texts[i:j]]
        ids = [v.encode(block) for v in (a, b)]
        kept: list[int] = []
        for k, text in enumerate(block):
            whole = b" " + text.encode()
            if text and all(b"".join(map(v.entries.__getitem__, own[k])) == whole for v, own in zip((a, b), ids, strict=True)):
                kept.append(k)
        n = len(block)
        counts = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
        flats = []
        for count, own in zip(counts, ids, strict=True):
            count[kept] = [len(own[k]) for k in kept]
            flats.append(np.fromiter(itertools.chain.from_iterable(map(own.__getitem__, kept)), np.int64, int(count.sum())))
        numbers = {"n_a": counts[0], "n_b": counts[1], "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64)}
        digests = [""] * n
        if not kept:
            yield numbers, digests, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n, np.int64)
            continue
        a_size, b_size = a.length[flats[0]], b.length[flats[1]]
        a_start, b_start = _spans(a_size), _spans(b_size)  # the documents stand one after the other, so no group spans two
        a_end, b_end = a_start + a_size, b_start + b_size
        side = np.repeat(np.array([False, True]), (len(a_size), len(b_size)))
        group = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]), side)
        a_group, b_group = group[~side], group[side]
        first = _spans(counts[0][kept])
        doc_groups = np.diff(np.append(a_group[first], group.max() + 1))
        numbers["n_groups"][kept] = doc_groups
        for k, said in zip(kept, _groups_text(a, b, flats[0], flats[1], a_group, b_group, doc_groups), strict=True):
            digests[k] = hashlib.sha256(said).hexdigest()
        at_a, at_b = overlaps(a_start, a_end, b_start, b_end)
        doc = np.searchsorted(np.cumsum(counts[0]), at_a, "right")  # documents without tokens are passed over
        numbers["n_links"] += np.bincount(doc, minlength=n)
        pair = flats[0][at_a] << 32 | flats[1][at_b]
        order = np.lexsort((pair, doc))
        pair, doc = pair[order], doc[order]
        fresh = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])))
        links = np.diff(np.append(fresh, len(pair)))
        yield numbers, digests, pair[fresh], links, np.cumsum(np.bincount(doc[fresh], minlength=n))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) of every row, chunk by chunk.

    ``pairs`` holds a document's distinct linked id pairs (A << 32 | B) and
    ``links`` how often each is linked in it.  A chunk is named by its task and
    number; a task that runs again may name others, so write the table before use.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"chunk bigint, id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{n} bigint' for n in _NUMBERS)}, groups_sha256 string, pairs array<bigint>, links array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocabulary(a_path), vocabulary(b_path)
        base, number, held, size = TaskContext.get().partitionId() << 32, 0, 0, 0
        for batch in batches:
            done = 0
            for numbers, digests, pairs, links, ends in align(a, b, batch.column("text").to_pylist()):
                n, chunk = len(digests), []
                for count in np.diff(np.append(0, ends)).tolist():
                    if size and (size + count > CHUNK_LINKS or held >= CHUNK_ROWS):
                        number, held, size = number + 1, 0, 0
                    held, size = held + 1, size + count + 1
                    chunk.append(base + number)
                offsets = pa.array(np.append(0, ends), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk, pa.int64()), batch.column("id").slice(done, n), *(pa.array(numbers[k]) for k in _NUMBERS), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(links))],
                    ["chunk", "id", *_NUMBERS, "groups_sha256", "pairs", "links"])
                done += n

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) over the corpus: links that hold the pair, and whether no pair of its B id has more."""
    linked = aligned.select(F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    counts = written(linked.groupBy("pair").agg(F.sum("links").alias("count")), "pair_counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("most"))
    return counts.withColumn("b_id", b_id).join(most, "b_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    A's tokens of space + text and B's tokens of the text (B adds the space)
    cover the same bytes; groups lie between the places where tokens of both
    sides end, links are the overlapping pairs.  ``count_sum`` adds up, over a
    row's links, how many links of the corpus hold the same id pair; ``n_best``
    counts the links whose pair has the highest count of its B id, ties included.

    Null and empty texts, and texts that a tokenizer does not give back byte by
    byte, have zeros and an empty digest.  Very long texts are one chunk each.
    Null and repeated ids give a result per row and every row counts; an empty
    table gives none; other columns are not read.
    """
    aligned = written(alignments(docs, a_path, b_path, id_col, text_col), "alignments")
    counts = written(pair_counts(aligned), "pair_best")
    # each chunk asks once for each of its pairs; asks are dealt out by pair, and a pair that all chunks ask for is one row a chunk
    asks = aligned.select("chunk", F.explode("pairs").alias("pair")).distinct()
    answers = asks.join(counts, "pair").select(F.col("chunk").alias("asker"), "pair", "count", "best")
    id_type = aligned.schema["id"].dataType.simpleString()

    def total(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        pair = told.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, count, best = pair[order], told.column("count").to_numpy()[order], told.column("best").to_numpy(zero_copy_only=False)[order]
        sums: list[np.ndarray] = []
        own = rows.combine_chunks()
        pairs, links = (pa.concat_arrays(own.column(c).chunks) if own.num_rows else pa.array([], pa.list_(pa.int64())) for c in ("pairs", "links"))
        size = np.asarray(pairs.value_lengths())
        at = np.searchsorted(pair, np.asarray(pairs.flatten()))
        n = np.asarray(links.flatten())
        for value in (np.where(best[at], n, 0) if len(at) else n, n * count[at] if len(at) else n):
            run = np.append(0, np.cumsum(value))
            ends = np.cumsum(size)
            sums.append(run[ends] - run[ends - size])
        columns = [own.column("id"), *(own.column(c) for c in _NUMBERS), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), own.column("groups_sha256")]
        return pa.table(columns, ["id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    schema = f"id {id_type}, {', '.join(f'{n} bigint' for n in _NUMBERS)}, n_best bigint, count_sum bigint, groups_sha256 string"
    out = aligned.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(total, schema)
    return out.withColumnRenamed("id", id_col)
