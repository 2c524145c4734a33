"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters that occurs in a text with at most e edits keeps at
least m - q + 1 - q*e of its q-grams, all on e + 1 neighbouring diagonals (text position
minus item position).  Shared q-grams are counted in bands of 2(e + 1) diagonals that
overlap by half, so every such run of diagonals lies whole in one band; bands that reach
the bound are kept and verified by a banded alignment of the item against that region.

The budget e is the item's length times the edit rate, rounded down, for every item.  Where
the bound would fall below one (short items), the item is looked up by 4-grams instead, and
where even these promise nothing it is aligned with the whole text.

Texts and items are compared in lower case with runs of white space as one blank; spans
are positions in that form of the text.  Texts of any length are searched whole.  Null and
empty texts and items match nothing, nor do items of fewer than q characters.  Items with the
same text are reported each.
Repeated rows give repeated results.  Extra columns are ignored by ``matches`` and kept by
``drop_contaminated``.  Empty tables give an empty result (or all documents).

The items travel to the tasks in slices of at most ``slice_chars`` characters; a larger
benchmark takes more slices, each against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SLICE_CHARS = 4_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram (q a multiple of four), read as 64-bit words of 16-bit codes."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    small = np.minimum(codes, 0xFFFF).astype("<u2")
    out = np.zeros(n, np.uint64)
    for k in range(0, q, 4):
        word = np.ndarray((n,), "<u8", small, offset=2 * k, strides=(2,))
        out = (out ^ word) * MIX[k // 4 % 2]
        out ^= out >> np.uint64(29)
    return out


def align(item: np.ndarray, region: np.ndarray, first: int, width: int) -> tuple[int, int]:
    """(edits, end) of the best occurrence of ``item`` in ``region`` on diagonals first..first+width-1.

    Free ends in the region; cells outside the band don't count.  Row j holds the cells
    of text positions j + first + 0..width-1 (number of region characters used).
    """
    big = len(item) + len(region) + 1
    at = np.arange(width)
    pos = at + first
    row = np.where((pos >= 0) & (pos <= len(region)), 0, big)
    for j, c in enumerate(item.tolist(), 1):
        pos = at + first + j
        inside = (pos >= 0) & (pos <= len(region))
        same = np.full(width, False)
        ok = inside & (pos >= 1)
        same[ok] = region[pos[ok] - 1] == c
        new = np.where(ok, row + ~same, big)               # from (j-1, pos-1): the same diagonal
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)       # item character left out of the text
        new = np.where(inside, new, big)
        row = np.minimum(np.minimum.accumulate(new - at) + at, big)  # extra text characters
        row[~inside] = big
    best = int(np.argmin(row))
    return int(row[best]), best + first + len(item)


class Grams:
    """The q-grams of some items; ``numbers`` are the items' places in the lists given."""

    def __init__(self, numbers: list[int], codes: list[np.ndarray], edits: np.ndarray, q: int) -> None:
        self.q = q
        self.edits, self.least = edits, np.full(len(codes), 1 << 40)
        size = np.array([len(codes[k]) for k in numbers], np.int64)
        self.least[numbers] = size - q + 1 - q * edits[numbers]
        grams = [_grams(codes[k], q) for k in numbers]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.array(numbers, np.int64), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.hashes, self.first, self.many = np.unique(hashes[order], return_index=True, return_counts=True)
        self.bits = max(16, int(np.ceil(np.log2(max(len(self.hashes), 1) * 64))))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.hashes >> np.uint64(64 - self.bits)] = True

    def regions(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) pairs that reach the q-gram bound."""
        h = _grams(codes, self.q)
        at = np.nonzero(self.seen[h >> np.uint64(64 - self.bits)])[0]
        if not len(at):
            return []
        where = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[where] == h[at]
        at, where = at[hit], where[hit]
        many = self.many[where]
        if not len(at):
            return []
        ends = np.cumsum(many)
        slot = np.repeat(self.first[where] - (ends - many), many) + np.arange(ends[-1])
        item, place = self.owner[slot], self.place[slot]
        diagonal = np.repeat(at, many) - place
        enough = np.bincount(item, minlength=len(self.least)) >= self.least  # over the whole text first
        keep = enough[item]
        if not keep.any():
            return []
        item, place, diagonal = item[keep], place[keep], diagonal[keep]
        band = diagonal // (self.edits[item] + 1)
        span = int(band.max() - band.min()) + 3
        low = int(band.min()) - 1
        key = np.concatenate([item * span + band - low, item * span + band - 1 - low])
        # every kept q-gram has an item position of its own, so repeats in the text count once
        most = int(self.place.max()) + 1
        key = np.unique(key * most + np.concatenate([place, place])) // most
        keys, count = np.unique(key, return_counts=True)
        full = keys[count >= self.least[keys // span]]
        return [(int(k // span), int(k % span) + low) for k in full]


class Index:
    """Q-grams of some items, and the search of one text for them."""

    def __init__(self, items: list[tuple[int, str]], q: int = 8, edit_rate: float = 0.1) -> None:
        self.q = q
        self.items = [(i, plain(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if len(t) >= q]
        self.codes = [_codes(t) for _, t in self.items]
        size = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.floor(size * edit_rate + 1e-9).astype(np.int64)
        by: dict[int, list[int]] = {}
        for k, (n, e) in enumerate(zip(size.tolist(), self.edits.tolist(), strict=True)):
            by.setdefault(next((x for x in (q, 4) if x <= q and n - x + 1 - x * e >= 1), 0), []).append(k)
        self.whole = by.pop(0, [])  # items without a q-gram bound
        self.grams = [Grams(numbers, self.codes, self.edits, x) for x, numbers in sorted(by.items(), reverse=True)]

    def regions(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) pairs that reach the q-gram bound."""
        return [r for g in self.grams for r in g.regions(codes)]

    def _everywhere(self, k: int, codes: np.ndarray, at: int) -> Iterator[tuple[int, int, int]]:
        """(edits, start, end) of item ``k`` in a part of the text that starts at ``at``: the best, then beside it."""
        item, size = self.codes[k], len(self.codes[k])
        if len(codes) + self.edits[k] < size:
            return
        cost, end = align(item, codes, -size, size + len(codes) + 1)
        if cost <= self.edits[k]:
            _, length = align(item[::-1], codes[:end][::-1], -int(self.edits[k]) - 1, 2 * int(self.edits[k]) + 3)
            yield cost, at + end - length, at + end
            yield from self._everywhere(k, codes[:end - length], at)
            yield from self._everywhere(k, codes[end:], at + end)

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, edits) of the occurrences, one for overlapping finds of an item."""
        t = plain(text)
        if len(t) < self.q or not self.items:
            return []
        codes = _codes(t)
        found: dict[int, list[tuple[int, int, int]]] = {k: f for k in self.whole if (f := list(self._everywhere(k, codes, 0)))}
        for k, band in self.regions(codes):
            wide, item, size = int(self.edits[k]) + 1, self.items[k][1], len(self.codes[k])
            lo = max(band * wide, 0)
            hi = min((band + 2) * wide + size, len(t))
            start = t.find(item, lo, hi)
            if start >= 0:
                found.setdefault(k, []).append((0, start, start + size))
                continue
            region = codes[lo:hi]
            cost, end = align(self.codes[k], region, band * wide - lo, 2 * wide)
            if cost <= self.edits[k]:
                back = region[:end][::-1]  # the start: the same alignment from the end
                _, length = align(self.codes[k][::-1], back, -wide, 2 * wide + 1)
                found.setdefault(k, []).append((cost, lo + end - length, lo + end))
        out = []
        for k, spans in found.items():
            taken: list[tuple[int, int]] = []
            for cost, a, b in sorted(spans):
                if all(b <= x or a >= y for x, y in taken):
                    taken.append((a, b))
                    out.append((self.items[k][0], a, b, cost))
        return sorted(out)


def _slices(benchmark: DataFrame, slice_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, a bounded number of characters at a time."""
    part, size = [], 0
    rows = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        part.append((r.item_id, r.text))
        size += len(r.text)
        if size >= slice_chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def matches(docs: DataFrame, benchmark: DataFrame, q: int = 8, edit_rate: float = 0.1,
            slice_chars: int = SLICE_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): one row for every occurrence of an item in a document."""
    schema = "doc_id long, item_id long, start long, `end` long, edits long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _slices(benchmark, slice_chars):
        def run(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            index = Index(items, q, edit_rate)
            for b in batches:
                hits = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True)
                        for m in index.find(t.as_py())]
                cols = [pa.array([h[i] for h in hits], pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "start", "end", "edits"])

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def contaminated(text: Column, items: list[tuple[int, str]], q: int = 8, edit_rate: float = 0.1) -> Column:
    """True where a text holds an occurrence of one of the items."""

    @F.pandas_udf("boolean")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(items, q, edit_rate)
        for s in texts:
            yield pd.Series([bool(index.find(t)) for t in s], dtype=bool)

    return found(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = 8, edit_rate: float = 0.1,
                      slice_chars: int = SLICE_CHARS) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark item."""
    for items in _slices(benchmark, slice_chars):
        docs = docs.where(~contaminated(F.col("text"), items, q, edit_rate))
    return docs
