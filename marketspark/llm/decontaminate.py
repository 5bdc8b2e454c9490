"""Benchmark leaks: q-gram lemma filtering in diagonal bands, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, stage, text_or_empty

Q = 8
#: Items are searched in overlapping windows of this many normalised characters, a window starting every half.
WINDOW = 100
#: Edits allowed in a window, as a share of its length.
EDIT_RATE = 0.08
#: Windows searched in one pass over the documents; larger benchmarks take several passes.
BLOCK_WINDOWS = 100_000
#: Characters normalised and hashed at once in a task. The arrays made of them take some 50 bytes a character.
CHUNK = 250_000
_TABLE_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LIMIT = 0x30000
_END, _OUT = 1, 2  # values that no normalised character has

_folded: np.ndarray | None = None


def folded() -> np.ndarray:
    """Code point -> lower-cased code point of letters and digits, 0 for all else."""
    global _folded
    if _folded is None:
        table = np.zeros(_LIMIT + 1, dtype=np.uint32)
        for c in range(_LIMIT):
            if (ch := chr(c)).isalnum():
                table[c] = ord(ch.lower()[0])
        _folded = table
    return _folded


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(characters, their places in ``text``): letters and digits lower-cased, anything between them one 0."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    chars = folded()[np.minimum(points, _LIMIT)]
    keep = chars > 0
    keep[1:] |= chars[:-1] > 0
    at = np.flatnonzero(keep)
    return chars[at], at


def grams(chars: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place."""
    n = len(chars) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(Q):
        out *= _ODD
        out += chars[j:n + j]
    out ^= out >> np.uint64(29)
    out *= _ODD
    return out


@dataclass
class Window:
    item: object
    chars: np.ndarray
    budget: int
    needed: int


def windows(item: object, text: str) -> list[Window]:
    """The windows of an item. The lemma: k edits spoil at most k*q of the m+1-q q-grams of a window.

    Where a short window would need no common q-gram at all, its budget shrinks until it needs one; items under q
    characters have no window.
    """
    chars = normalise(text or "")[0]
    chars = chars[:-1] if len(chars) and chars[-1] == 0 else chars
    size = len(chars)
    starts = [0] if size <= WINDOW else [*range(0, size - WINDOW, WINDOW // 2), size - WINDOW]
    out = []
    for s in starts:
        part = chars[s:s + WINDOW]
        m = len(part)
        if m < Q:
            continue
        k = min(math.floor(EDIT_RATE * m), (m - Q) // Q)
        out.append(Window(item, part, k, m + 1 - Q * (k + 1)))
    return out


class Index:
    """q-grams of a block of windows."""

    def __init__(self, block: list[Window]):
        self.block = block
        sizes = [len(w.chars) - Q + 1 for w in block]
        hashes = np.concatenate([grams(w.chars) for w in block])
        window = np.repeat(np.arange(len(block)), sizes)
        place = np.concatenate([np.arange(n) for n in sizes])
        order = np.argsort(hashes, kind="stable")
        self.window, self.place = window[order], place[order]
        self.grams, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.grams >> np.uint64(64 - _TABLE_BITS)] = True
        self.needed = np.array([w.needed for w in block])
        self.budget = np.array([w.budget for w in block])
        self.length = np.array([len(w.chars) for w in block])
        self.least, self.reach = int(self.needed.min()), int((self.length + self.budget).max())
        self.band = 1 << max(3, int(self.budget.max()).bit_length())

    def candidates(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows (document, window, band) whose band of diagonals shares the needed number of q-grams."""
        hashes = grams(chars)
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _TABLE_BITS)])
        gram = np.searchsorted(self.grams, hashes[at])
        gram = np.minimum(gram, len(self.grams) - 1)
        real = self.grams[gram] == hashes[at]
        at, gram = at[real], gram[real]
        # A match has `least` hits within `reach`; others cannot belong to one.
        if len(at) < self.least:
            return np.zeros((0, 3), dtype=np.int64)
        dense = np.flatnonzero(at[self.least - 1:] - at[:len(at) - self.least + 1] <= self.reach)
        mark = np.zeros(len(at) + 1, dtype=np.int64)
        mark[dense] += 1
        np.add.at(mark, dense + self.least, -1)
        inside = np.cumsum(mark[:-1]) > 0
        at, gram = at[inside], gram[inside]
        n = self.count[gram]
        which = np.repeat(self.first[gram] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        window, diagonal = self.window[which], np.repeat(at, n) - self.place[which]
        doc = np.searchsorted(starts, np.repeat(at, n), side="right") - 1
        # Bands overlap by the budget, so all diagonals of a match lie in one band.
        low = diagonal // self.band
        again = diagonal - low * self.band < self.budget[window]
        rows = np.stack([np.r_[doc, doc[again]], np.r_[window, window[again]], np.r_[low, low[again] - 1]], axis=1)
        if not len(rows):
            return rows
        rows = rows[np.lexsort(rows.T[::-1])]
        new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
        shared = np.diff(np.r_[new, len(rows)])
        rows = rows[new]
        return rows[shared >= self.needed[rows[:, 1]]]

    def verified(self, chars: np.ndarray, starts: np.ndarray, stops: np.ndarray, rows: np.ndarray):
        """(row, edits, end): candidates whose window aligns within its band in at most its budget of edits."""
        out = []
        for m in np.unique(self.length[rows[:, 1]]):
            own = np.flatnonzero(self.length[rows[:, 1]] == m)
            for part in np.array_split(own, -(-len(own) // 2000)):
                doc, window, band = rows[part].T
                pattern = np.stack([self.block[w].chars for w in window]).astype(np.int64)
                pad = int(self.budget.max())
                width = self.band + 3 * pad
                left = band * self.band - pad
                place = left[:, None] + np.arange(width + m)
                inside = (place >= starts[doc][:, None]) & (place < stops[doc][:, None])
                text = np.where(inside, chars[np.clip(place, 0, len(chars) - 1)], _OUT).astype(np.int64)
                lane = np.arange(width)
                cost = np.zeros((len(part), width), dtype=np.int64)
                for i in range(m):
                    step = cost + (text[:, i:i + width] != pattern[:, i:i + 1])
                    step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                    cost = np.minimum.accumulate(step - lane, axis=1) + lane
                best = cost.argmin(axis=1)
                edits = cost[np.arange(len(part)), best]
                good = edits <= self.budget[window]
                out += zip(part[good].tolist(), edits[good].tolist(),
                           (left + best + m)[good].tolist(), strict=True)
        return out

    def search(self, texts: list[str]) -> list[tuple[int, object, int, int, int]]:
        """(text number, item, edits, start, stop): best window of each item found in each text, with its place."""
        parts, places = zip(*(normalise(t) for t in texts), strict=True)
        end = np.array([_END], dtype=np.uint32)
        chars = np.concatenate([x for p in parts for x in (p, end)])
        sizes = np.array([len(p) for p in parts])
        starts = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        rows = self.candidates(chars, starts)
        found: dict[tuple[int, int], tuple[int, object, int, int, int]] = {}
        for row, edits, stop in self.verified(chars, starts, starts + sizes, rows):
            doc, window, _ = rows[row]
            w = self.block[window]
            where, lo = places[doc], max(0, int(stop - starts[doc]) - len(w.chars))
            hi = min(int(stop - starts[doc]), len(where)) - 1
            hit = (int(doc), w.item, edits, int(where[min(lo, len(where) - 1)]), int(where[hi]) + 1)
            key = (int(doc), window if w.item is None else w.item)
            if key not in found or (edits, hit[3]) < (found[key][2], found[key][3]):
                found[key] = hit
        return list(found.values())

    def search_all(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int]]:
        """What ``search`` finds, on runs of texts of about ``CHUNK`` characters: their arrays are all that a task holds of them."""
        lo = held = 0
        for hi, text in enumerate(texts, 1):
            held += len(text)
            if held >= CHUNK or hi == len(texts):
                yield from ((lo + d, *rest) for d, *rest in self.search(texts[lo:hi]))
                lo, held = hi, 0


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, edits, start, stop): one row per row of ``docs`` and benchmark item found in it.

    A text holds an item if one of its windows aligns to a part of it within the edit budget; case, punctuation and
    white space do not count. ``start`` and ``stop`` are code points of the text, near the ends of the best window.
    NULL or empty texts and items match nothing, nor do items under eight letters and digits. Repeated rows and
    items are found each time; equal items under one id are one. Either table may be empty; other columns are ignored.
    The benchmark is read in blocks of at most ``BLOCK_WINDOWS`` windows (10 MB), each sent to all tasks; documents never
    move.
    """
    spark = prepare(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    ids = [slim.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()]
    schema = f"id {ids[0]}, item {ids[1]}, edits int, start long, stop long"
    found = None

    def pass_over(block: list[Window]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = Index(shared.value)
            for part in parts:
                out = [(part["id"].iloc[d], *rest) for d, *rest in index.search_all(part["text"].tolist())]
                yield pd.DataFrame(out, columns=["id", "item", "edits", "start", "stop"], dtype=object)

        return slim.mapInPandas(run, schema)

    block: list[Window] = []
    items = benchmark.select(item_col, item_text).distinct().toLocalIterator()  # a block at a time on the driver
    for item, text in items:
        block += windows(item, text)
        if len(block) >= BLOCK_WINDOWS:
            one = pass_over(block)
            found, block = one if found is None else found.union(one), []
    if block or found is None:
        one = pass_over(block) if block else spark.createDataFrame([], schema)
        found = one if found is None else found.union(one)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found."""
    hits = stage(leaks(docs, benchmark, id_col).select(F.col(id_col).alias("_leaked")).distinct(), "leaks")
    return docs.join(hits, docs[id_col].eqNullSafe(hits["_leaked"]), "left_anti")
