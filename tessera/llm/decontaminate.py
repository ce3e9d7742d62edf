"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are folded (lower case, runs of white space one space).  Every ``WINDOW`` characters
of a benchmark item, from any start, are a window (a shorter item is one window).  A
document contains an item if one window aligns somewhere in it with at most ``ERROR`` of
the window's length in edits.

A region within k edits of a window of length m shares at least m - q + 1 - k q of the
window's character q-grams, on diagonals that differ by at most k.  So hits are counted in
diagonal bands of width 4 k + 2 that overlap by half, bands below the bound are dropped,
and the rest is aligned within the band, which decides.

The benchmark is the stated query set: it is read in blocks of at most ``BLOCK_CHARS``
characters, each sent to the tasks as one table, and every block meets every document.

Null and empty texts, and items shorter than ``Q`` folded characters (too little to be
evidence), match nothing.  Items with a null id have no row in ``contaminated``, but
``clean`` looks for them too.  Repeated items and documents
each give their own row, once per distinct (document id, item id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import PrefixHash

Q = 10
WINDOW = 100
ERROR = 0.08
#: Characters of benchmark text in one block; a longer item is a block of its own.
BLOCK_CHARS = 2_000_000
_FILTER_BITS = 22
#: Characters of documents handled in one vectorised step.
STEP_CHARS = 1 << 20
#: Windows aligned in one vectorised step, and the symbol outside of a document.
ALIGNED = 4096
NOWHERE = np.uint32(0xFFFFFFFF)


def fold(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int, q: int = Q, error: float = ERROR) -> int:
    """Most edits for a window, no more than leave the q-gram bound at one."""
    return max(0, min(int(length * error), (length - q) // q))


def bound(length: int, q: int = Q, error: float = ERROR) -> int:
    return length - q + 1 - q * budget(length, q, error)


def symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Windows:
    """The q-gram index of one block of benchmark items, whose every start is a window."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.text = [], []
        for item, text in items:
            folded = fold(text)
            if len(folded) >= Q:
                self.item.append(item)
                self.text.append(folded)
        grams, owner, place = [], [], []
        for i, text in enumerate(self.text):
            g = PrefixHash(symbols(text)).windows(Q)
            grams.append(g)
            owner.append(np.full(len(g), i, np.int64))
            place.append(np.arange(len(g)))
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        gram, owner, place = cat(grams, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner, self.place = gram[order], owner[order], place[order]
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._slot(self.gram)] = True
        size = np.fromiter(map(len, self.text), np.int64, len(self.text))
        self.sym, self.first = symbols("".join(self.text)), np.cumsum(size) - size
        self.longest = int(size.max(initial=0))
        #: of each item's windows: their length and the last one's start
        self.length = np.minimum(size, WINDOW)
        self.last = size - self.length
        self.budget = np.array([budget(n) for n in self.length], np.int64)
        self.bound = np.array([bound(n) for n in self.length], np.int64)

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def bands(self, sym: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(document, item, band, low, high) rows: windows low to high meet the q-gram bound.

        ``sym`` holds documents one after the other, ``starts`` their starts and the end.
        """
        grams = PrefixHash(sym).windows(Q)
        at = np.flatnonzero(self.seen[self._slot(grams)])
        lo = np.searchsorted(self.gram, grams[at], "left")
        n = np.searchsorted(self.gram, grams[at], "right") - lo
        keep = n > 0
        at, lo, n = at[keep], lo[keep], n[keep]
        doc = np.searchsorted(starts, at, "right") - 1
        inside = at + Q <= starts[doc + 1]
        at, lo, n, doc = at[inside], lo[inside], n[inside], doc[inside]
        if not len(at):
            return np.zeros((0, 5), np.int64)
        # one row per hit position and posting
        each = np.repeat(np.arange(len(at)), n)
        post = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        item = self.owner[post]
        half = 2 * self.budget[item] + 1
        band = (at[each] - starts[doc[each]] - self.place[post] + self.longest) // half
        pair, at_pair = np.unique(doc[each] * len(self.text) + item, return_inverse=True)
        # a q-gram of the item counts once in a band, however often the band repeats it
        band = np.concatenate([band, band - 1]) + 1
        pairs, places = np.tile(at_pair, 2), np.tile(self.place[post], 2)
        # pairs and bands are numbered by what occurs, so that no product leaves 64 bits
        spread = int(band.max()) + 1
        key, at_key = np.unique(pairs * spread + band, return_inverse=True)
        hits = np.unique(at_key * self.longest + places)
        at_key, places = hits // self.longest, hits % self.longest
        item = pair[key // spread] % len(self.text)
        # enough places of a band within one window, counted from each place on
        owner = item[at_key]
        until = np.arange(len(hits)) + self.bound[owner] - 1
        reach = np.minimum(until, len(hits) - 1)
        width = self.length[owner] - Q
        enough = np.flatnonzero((until < len(hits)) & (at_key[reach] == at_key)
                                & (places[reach] - places <= width))
        of = at_key[enough]
        low = np.maximum(places[reach[enough]] - width[enough], 0)
        high = np.minimum(places[enough], self.last[owner[enough]])
        # both grow within a key: what the row before lists is not listed again
        follows = np.flatnonzero(of[1:] == of[:-1]) + 1
        low[follows] = np.maximum(low[follows], high[follows - 1] + 1)
        fresh = low <= high
        of, low, high = of[fresh], low[fresh], high[fresh]
        return np.stack([pair[key[of] // spread] // len(self.text), item[of],
                         key[of] % spread - 1, low, high], 1)

    def align(self, sym: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(document, item, window, edits, end): each window's best place in its band, for
        those within the budget."""
        out = [np.zeros((0, 5), np.int64)]
        for m in np.unique(self.length[rows[:, 1]]).tolist():
            same = rows[self.length[rows[:, 1]] == m]
            n = same[:, 4] - same[:, 3] + 1
            ends = np.cumsum(n)
            for a in range(0, int(ends[-1]), ALIGNED):
                number = np.arange(a, min(a + ALIGNED, int(ends[-1])))
                row = np.searchsorted(ends, number, "right")
                doc, item, band, low, _ = same[row].T
                window = low + number - (ends - n)[row]
                out.append(self._align(sym, starts, m, doc, item, band, window))
        return np.concatenate(out)

    def _align(self, sym, starts, m, doc, item, band, window) -> np.ndarray:
        k = budget(m)
        half = 2 * k + 1
        # diagonals band*half .. (band+2)*half - 1, and k around them for the path
        width = 2 * half + 2 * k
        low = band * half - self.longest - k + window
        at = starts[doc] + low + np.arange(m + width)[:, None]
        inside = (at >= starts[doc]) & (at < starts[doc + 1])
        region = np.where(inside, sym[np.clip(at, 0, len(sym) - 1)], NOWHERE)
        pattern = self.sym[self.first[item] + window + np.arange(m)[:, None]]
        edits, end = _banded(pattern, region, width, starts[doc + 1] - starts[doc] - low, k)
        good = edits <= k
        return np.stack([doc, item, window, edits, low + end], 1)[good]


def _banded(pattern: np.ndarray, region: np.ndarray, width: int, inside: np.ndarray,
            most: int) -> tuple[np.ndarray, np.ndarray]:
    """``banded_edits`` of many pairs, one per column; ``inside`` is where regions end.
    Columns with more than ``most`` edits may give any number above it."""
    far = 1 << 20
    edits, end = np.full(pattern.shape[1], far), np.zeros(pattern.shape[1], np.int64)
    open_ = np.arange(pattern.shape[1])
    step = np.arange(width + 1, dtype=np.int32)[:, None]
    row = np.zeros((width + 1, len(open_)), np.int32)  # row[d]: pattern[:i] against region up to i + d
    for i in range(len(pattern)):
        best = row + (region[i:i + width + 1] != pattern[i])
        np.minimum(best[:-1], row[1:] + 1, out=best[:-1])
        row = np.minimum.accumulate(best - step, axis=0) + step  # symbols of the region left over
        if i % 16 == 15:
            alive = row.min(axis=0) <= most
            if 2 * alive.sum() < len(alive):
                row, region, pattern = row[:, alive], region[:, alive], pattern[:, alive]
                open_ = open_[alive]
    ends = len(pattern) + step
    row = np.where(ends <= inside[open_], row, far)
    d = row.argmin(axis=0)
    edits[open_], end[open_] = row[d, np.arange(len(open_))], ends[d, 0]
    return edits, end


def banded_edits(pattern: str, region: str, width: int) -> tuple[int, int]:
    """Fewest edits between the pattern and any substring of the region that starts among
    its first ``width`` places, along diagonals 0 to ``width``; and where that one ends."""
    width = max(1, width)
    p, r = symbols(pattern), symbols(region)
    r = np.concatenate((r, np.full(len(p) + width + 2, NOWHERE, np.uint32)))
    edits, end = _banded(p[:, None], r[:, None], width, np.array([len(region)]), len(p))
    return int(edits[0]), int(end[0])


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, windows, end): which documents contain which items.

    ``edits`` is the least over the item's windows found, ``windows`` their number, ``end``
    where the first of these ends in the folded text.  Rows with a null id are left out.
    """
    found = None
    source = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"),
                                                       F.col(text).alias("text"))
    for block in _blocks(benchmark, item, item_text, block_chars):
        part = _search(source, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = _search(source.limit(0), [])
    return found.groupBy("doc_id", "item_id").agg(
        F.min("edits").alias("edits"), F.max("windows").alias("windows"), F.min("end").alias("end"))


def _blocks(benchmark: DataFrame, item: str, text: str, most: int,
            unnamed: bool = False) -> Iterator[list]:
    """Items as (id, text) in blocks; ``unnamed`` ones, with a null id, come as id -1."""
    block: list[tuple[int, str]] = []
    size = 0
    wanted = F.col(text).isNotNull() & (F.lit(unnamed) | F.col(item).isNotNull())
    rows = benchmark.where(wanted).select(
        F.coalesce(F.col(item).cast("long"), F.lit(-1)).alias("i"),
        F.col(text).alias("t")).orderBy("i", "t")
    for row in rows.toLocalIterator():
        if block and size + len(row["t"]) > most:
            yield block
            block, size = [], 0
        block.append((row["i"], row["t"]))
        size += len(row["t"])
    if block:
        yield block


def _search(source: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    shared = source.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Windows(shared.value)
        for frame in batches:
            ids = frame["doc_id"].tolist()
            for first, folded in _steps(frame["text"].tolist()):
                yield _matches(index, ids[first:first + len(folded)], folded)

    return source.mapInPandas(run, "doc_id long, item_id long, edits long, windows long, end long")


def _matches(index: Windows, ids: list[int], folded: list[str]) -> pd.DataFrame:
    starts = np.concatenate(([0], np.cumsum([len(t) for t in folded]))).astype(np.int64)
    sym = symbols("".join(folded))
    found = pd.DataFrame(index.align(sym, starts, index.bands(sym, starts)),
                         columns=["doc", "item", "window", "edits", "end"])
    if not len(found):
        return pd.DataFrame([], columns=["doc_id", "item_id", "edits", "windows", "end"], dtype="int64")
    found = (found.sort_values(["edits", "end"]).drop_duplicates(["doc", "item", "window"])
             .groupby(["doc", "item"]).agg(edits=("edits", "min"), windows=("window", "size"),
                                           end=("end", "min")).reset_index())
    found["doc_id"] = np.array(ids, np.int64)[found["doc"]]
    found["item_id"] = np.array(index.item, np.int64)[found["item"]]
    return found.groupby(["doc_id", "item_id"]).agg(
        edits=("edits", "min"), windows=("windows", "max"), end=("end", "min")).reset_index()


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
          item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that contain an item, whatever the ids of both.

    Each block of the benchmark is one more filter on the text; nothing is shuffled.
    """
    for block in _blocks(benchmark, item, item_text, block_chars, unnamed=True):
        docs = docs.where(~_contains(docs.sparkSession, block)(F.col(text)))
    return docs


def _contains(spark, items: list[tuple[int, str]]):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def contains(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Windows(shared.value)
        for texts in batches:
            hit = np.zeros(len(texts), bool)
            for first, folded in _steps(texts.tolist()):
                places = list(range(first, first + len(folded)))
                hit[_matches(index, places, folded)["doc_id"].to_numpy(np.int64)] = True
            yield pd.Series(hit)

    return contains


def _steps(texts: list) -> Iterator[tuple[int, list[str]]]:
    """(first row, folded texts) of runs of about STEP_CHARS characters."""
    i = 0
    while i < len(texts):
        folded, size, first = [], 0, i
        while i < len(texts) and (not folded or size < STEP_CHARS):
            folded.append(fold(texts[i]))
            size += len(folded[-1])
            i += 1
        yield first, folded
