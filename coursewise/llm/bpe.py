"""Operator 9: byte-pair encoding and decoding by contiguous rank arrays.

A word is a row of token ids plus the row of merge ranks of its adjacent
pairs.  Each round scans the ranks for the minimum (leftmost on ties), writes
the merged id, deletes the boundary and looks up the two neighbouring ranks.
Words of one length advance together as a matrix: every row loses exactly one
boundary a round, so the matrix stays rectangular.  A word of more than
``SHORT_WORD`` bytes goes through the same rule with a heap, because repeated
scans would cost the square of its length.

A block of texts is cut into words with array operations over its code points.
Words that were merged before come from a bounded per-process cache: a hash
table of word hashes whose entries name slices of an id buffer and of a
spelling buffer; a hit counts only if the spelling is the same.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_CHARS, blocks, text_batches

SHORT_WORD = 64
#: Words kept per Python worker; the cache starts anew when it is full.
CACHE_WORDS = 1 << 19

# Fixed value: the pattern by which the vocabulary's file cuts words
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_NO_RANK = np.iinfo(np.int32).max
_WHITE_SPACE = regex.compile(r"\p{White_Space}+")
# from here on classes and case mapping are left to the tokenizer library, whose Unicode version decides
_LATIN = 0x250
_BEYOND_LATIN = re.compile(f"[{chr(_LATIN)}-\U0010ffff]")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.array([_SPACE if _WHITE_SPACE.fullmatch(c) else _LETTER if regex.fullmatch(r"\p{L}", c)
                   else _DIGIT if regex.fullmatch(r"\p{N}", c) else _OTHER for c in map(chr, range(_LATIN))], np.uint8)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^k and base^-k modulo 2^64 for k below n; base is odd."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... of each range, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _WordTable:
    """Word hashes -> slices of an id buffer; linear probing over arrays.

    A word is found by two 64-bit hashes; ``spelled`` compares code points, so
    words that share both hashes are told apart, by chance or by design.
    """

    def __init__(self, limit: int) -> None:
        bits = (2 * limit - 1).bit_length()
        self.limit, self._mask, self._shift = limit, (1 << bits) - 1, np.uint64(64 - bits)
        self._slot = np.empty(1 << bits, np.int32)
        self.clear()

    def clear(self) -> None:
        self._slot[:] = -1
        self.count = self._used = 0
        self._first, self._second = np.empty((2, 1 << 14), np.uint64)
        self._start, self._length = np.empty((2, 1 << 14), np.int64)
        self._ids = np.empty(1 << 16, np.int32)
        self._chars_used = 0
        self._chars_start, self._chars_length = np.empty((2, 1 << 14), np.int64)
        self._chars = np.empty(1 << 16, np.uint32)

    def _home(self, first: np.ndarray) -> np.ndarray:
        return ((first * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The entry of each word, -1 where there is none."""
        out = np.full(len(first), -1, np.int64)
        left, at = np.arange(len(first)), self._home(first)
        while len(left):
            entry = self._slot[at]
            there = entry >= 0
            left, at, entry = left[there], at[there], entry[there]
            same = (self._first[entry] == first[left]) & (self._second[entry] == second[left])
            out[left[same]] = entry[same]
            left, at = left[~same], (at[~same] + 1) & self._mask
        return out

    def spelled(self, entry: np.ndarray, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each entry is the word ``code[start:end]``; no word is empty."""
        size = end - start
        same = self._chars_length[entry] == size
        at = np.flatnonzero(same)
        if len(at):
            equal = self._chars[_ranges(self._chars_start[entry[at]], size[at])] == code[_ranges(start[at], size[at])]
            same[at] = np.logical_and.reduceat(equal, np.cumsum(size[at]) - size[at])
        return same

    def add(self, first: np.ndarray, second: np.ndarray, size: np.ndarray, chars: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        """Append words (``size`` code points each in ``chars``, ``length`` ids each) whose hashes are not there yet, each once."""
        k, n = self.count, len(first)
        while k + n > len(self._first):
            self._first, self._second, self._start, self._length, self._chars_start, self._chars_length = (
                np.concatenate([x, np.empty_like(x)]) for x in (self._first, self._second, self._start, self._length, self._chars_start, self._chars_length))
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while self._chars_used + len(chars) > len(self._chars):
            self._chars = np.concatenate([self._chars, np.empty_like(self._chars)])
        self._first[k:k + n], self._second[k:k + n], self._length[k:k + n], self._chars_length[k:k + n] = first, second, length, size
        self._start[k:k + n] = self._used + np.cumsum(length) - length
        self._ids[self._used:self._used + len(ids)] = ids
        self._used += len(ids)
        self._chars_start[k:k + n] = self._chars_used + np.cumsum(size) - size
        self._chars[self._chars_used:self._chars_used + len(chars)] = chars
        self._chars_used += len(chars)
        self.count += n
        entry, at = np.arange(k, k + n, dtype=np.int32), self._home(first)
        while len(entry):
            free = self._slot[at] < 0
            self._slot[at[free]] = entry[free]
            lost = self._slot[at] != entry  # taken before, or by another word just now
            entry, at = entry[lost], (at[lost] + 1) & self._mask

    def ids(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, flat ids) of entries, in order."""
        length = self._length[entry]
        return length, self._ids[_ranges(self._start[entry], length)]


class WordBpe:
    """A BPE vocabulary with word ends, lower case and dropped white space, read from a tokenizer file.

    ``encode(texts)`` gives the ids that the library gives without added
    begin and end tokens; the strings of added tokens inside a text become
    their ids, as is the library's default.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        if spec["decoder"] is not None or model["byte_fallback"] or not suffix:
            raise ValueError(f"{path} is not a word-end BPE vocabulary")
        self.special = {t["content"]: t["id"] for t in added}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        splitter = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if splitter["pattern"]["Regex"] != WORD_PATTERN:
            raise ValueError(f"{path} cuts words by another pattern")
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens = np.full(size, "", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token

        chars = _byte_chars()
        self._byte_of = {c: b for b, c in chars.items()}
        self._inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self._last = np.array([vocab[chars[b] + suffix] for b in range(256)], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self._merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._size = size
        order = np.argsort(left * size + right, kind="stable")
        self._pairs = (left * size + right)[order]
        self._ranks = order.astype(np.int32)
        self._rank_of = dict(zip(self._pairs.tolist(), self._ranks.tolist(), strict=True))
        self._table = _WordTable(CACHE_WORDS)
        self._powers = [powers(base, 2 * BLOCK_CHARS) for base in _BASES]

    # -- merging -----------------------------------------------------------

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left * self._size + right
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pair, self._ranks[at], _NO_RANK)

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, final ids) of words of one length, a matrix per final length."""
        rows = np.arange(len(ids))
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == _NO_RANK
            if done.any():
                yield rows[done], ids[done]
                go = ~done
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    return
            n, width = ids.shape
            row = np.arange(n)
            ids[row, at] = self._merged[best]
            ids = ids[np.arange(width) != at[:, None] + 1].reshape(n, width - 1)
            ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(n, width - 2)
            left, right = at > 0, at < width - 2
            ranks[row[left], at[left] - 1] = self._rank(ids[row[left], at[left] - 1], ids[row[left], at[left]])
            ranks[row[right], at[right]] = self._rank(ids[row[right], at[right]], ids[row[right], at[right] + 1])
        yield rows, ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same rule for one long word: the minimum comes from a heap, neighbours from links."""
        n, size, rank_of = len(ids), self._size, self._rank_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self._merged[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (q := rank_of.get(ids[x] * size + ids[after[x]])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[after[x]]))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, flat ids) of words given as their bytes, none empty."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        count, done = np.zeros(len(words), np.int64), []
        for block in np.split(order, 1 + np.flatnonzero(np.diff(size[order]))) if len(words) else ():
            width = int(size[block[0]])
            raw = np.frombuffer(b"".join([words[k] for k in block.tolist()]), np.uint8).reshape(-1, width)
            ids = self._inner[raw]
            ids[:, -1] = self._last[raw[:, -1]]
            if width > SHORT_WORD:
                final = ((np.array([k]), np.array([self._merge_long(row)])) for k, row in enumerate(ids.tolist()))
            else:
                final = self._merge_rows(ids)
            for rows, out in final:
                count[block[rows]] = out.shape[1]
                done.append((block[rows], out))
        start = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.int32)
        for rows, out in done:
            flat[start[rows][:, None] + np.arange(out.shape[1])] = out
        return count, flat

    # -- words of a block ----------------------------------------------------

    def _latin(self, text: str) -> str | None:
        """The normalised text if it is Latin and holds no added token, else None."""
        if "<|" in text and self._special.search(text):
            return None
        if text.isascii():
            return text.lower()
        if _BEYOND_LATIN.search(text):
            return None
        text = unicodedata.normalize("NFC", text).lower()
        return None if _BEYOND_LATIN.search(text) else text  # some capitals have a small letter further on

    def _cut(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the words among Latin code points: ``WORD_PATTERN`` over arrays."""
        kind = _CLASS[code]
        before = np.empty_like(kind)
        before[:1], before[1:] = _SPACE, kind[:-1]
        first = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
        # a quoted ending starts at a quote before which no other sign stands, and ends after one or two letters
        quote = np.flatnonzero((code == 0x27) & (before != _OTHER))
        if len(quote):
            ahead = np.concatenate([code, np.zeros(2, np.uint32)]).astype(np.uint64)
            one = np.isin(ahead[quote + 1], [*map(ord, "stmd")])
            two = np.isin(ahead[quote + 1] << np.uint64(32) | ahead[quote + 2], [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])
            cut = quote[one | two]
            stop = cut + np.where(one, 2, 3)[one | two]
            first[cut + 1] = False
            stop = stop[stop < len(code)]
            first[stop] = kind[stop] != _SPACE
        start = np.flatnonzero(first)
        edge = np.append(np.flatnonzero(first | (kind == _SPACE)), len(code))
        return start, edge[np.searchsorted(edge, start, "right")]

    def _latin_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, flat ids) of normalised Latin texts."""
        block = "\n".join(texts)
        code = np.frombuffer(block.encode("utf-32-le"), np.uint32)
        start, end = self._cut(code)
        hashes = []
        for base, (up, down) in zip(_BASES, self._powers, strict=True):
            if len(code) > len(up):  # a text of more than a block without white space
                up, down = powers(base, len(code))
            total = np.zeros(len(code) + 1, np.uint64)
            np.cumsum((code + np.uint32(1)) * up[:len(code)], out=total[1:])  # one more, so that U+0000 counts
            hashes.append((total[end] - total[start]) * down[start])
        count, flat = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        step = CACHE_WORDS // 2
        for i in range(0, len(start), step):
            got = self._word_ids(block, code, start[i:i + step], end[i:i + step], *(h[i:i + step] for h in hashes))
            count.append(got[0])
            flat.append(got[1])
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        owner = np.searchsorted(np.cumsum(size), start, "right")
        return np.bincount(owner, np.concatenate(count), len(texts)).astype(np.int64), np.concatenate(flat)

    def _word_ids(self, block: str, code: np.ndarray, start: np.ndarray, end: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, flat ids); words come from the cache, new ones are merged and kept."""
        entry = np.full(len(start), -1, np.int64)
        at = np.flatnonzero(end - start <= SHORT_WORD)
        entry[at] = self._entries(block, code, start[at], end[at], one[at], two[at])
        known, other = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        if not len(other):
            return self._table.ids(entry)
        # long words are merged each time, since nothing that large is kept, and so are words whose hashes another word has
        lengths, parts = np.empty(len(start), np.int64), []
        words = [block[a:b].encode() for a, b in zip(start[other].tolist(), end[other].tolist(), strict=True)]
        for rows, (count, ids) in ((known, self._table.ids(entry[known])), (other, self.merge(words))):
            lengths[rows] = count
            parts.append((rows, count, ids))
        begin, out = np.cumsum(lengths) - lengths, np.empty(int(lengths.sum()), np.int32)
        for rows, count, ids in parts:
            out[_ranges(begin[rows], count)] = ids
        return lengths, out

    def _entries(self, block: str, code: np.ndarray, start: np.ndarray, end: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The cache entry of each word, new words being merged and added; -1 for a word whose hashes another word has."""
        table = self._table
        if table.count + len(start) > table.limit:
            table.clear()
        entry = table.find(one, two)
        new = np.flatnonzero(entry < 0)
        if len(new):
            new = new[np.lexsort((two[new], one[new]))]
            fresh = np.append(True, (one[new[1:]] != one[new[:-1]]) | (two[new[1:]] != two[new[:-1]]))
            pick = new[fresh]
            size = end[pick] - start[pick]
            merged = self.merge([block[a:b].encode() for a, b in zip(start[pick].tolist(), end[pick].tolist(), strict=True)])
            table.add(one[pick], two[pick], size, code[_ranges(start[pick], size)], *merged)
            entry[new] = table.find(one[new], two[new])
        return np.where(table.spelled(entry, code, start, end), entry, -1)

    def _other_ids(self, text: str) -> np.ndarray:
        """Ids of a text that holds added tokens or other letters: the library cuts it into words, the merges are ours."""
        out = []
        for k, part in enumerate(self._special.split(text)):
            if k % 2:
                out.append(np.array([self.special[part]], np.int32))
                continue
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
            number = {w: i for i, w in enumerate(dict.fromkeys(words))}
            count, flat = self.merge([bytes(map(self._byte_of.__getitem__, w)) for w in number])
            which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            out.append(flat[_ranges((np.cumsum(count) - count)[which], count[which])])
        return np.concatenate(out)

    def _segments(self, text: str) -> Iterator[str]:
        """A very long text cut at white space, which no word spans."""
        at = 0
        while len(text) - at > BLOCK_CHARS and (cut := _WHITE_SPACE.search(text, at + BLOCK_CHARS)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of n + 1 entries, flat int32 ids) of the texts; a null text has no ids."""
        counts, flat = np.zeros(len(texts), np.int64), [np.empty(0, np.int32)]
        for start, stop in blocks(texts):
            latin: list[str] = []
            owners: list[int] = []

            def flush() -> None:
                if latin:
                    count, ids = self._latin_ids(latin)
                    np.add.at(counts, owners, count)
                    flat.append(ids)
                    latin.clear()
                    owners.clear()

            for i in range(start, stop):
                for segment in self._segments(texts[i] or ""):
                    plain = self._latin(segment) if segment else ""
                    if plain is None:
                        flush()
                        ids = self._other_ids(segment)
                        counts[i] += len(ids)
                        flat.append(ids)
                        continue
                    latin.append(plain)
                    owners.append(i)
                    if len(plain) >= BLOCK_CHARS:
                        flush()
            flush()
        return np.concatenate([[0], np.cumsum(counts)]), np.concatenate(flat)

    def decode(self, ids: np.ndarray) -> str:
        """The token strings joined by a space: the file names no decoder, so word ends and byte characters stay."""
        return " ".join(self.tokens[ids])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """The vocabulary, loaded once per Python worker."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row of ``docs``.

    A null or empty text has an empty array and an empty string.  Ids are
    passed through as they are (null, repeated rows: one result per row), other
    columns of ``docs`` are not read.
    """
    text_batches(docs.sparkSession)
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    rows = docs.select(F.col(id_col).alias("id"), text.cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            column = batch.column("text")
            for start, stop in blocks(column.to_pylist(), 4 * BLOCK_CHARS):
                offsets, ids = bpe.encode(column.slice(start, stop - start).to_pylist())
                decoded = [bpe.decode(ids[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, stop - start),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
                     pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    out = rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)
