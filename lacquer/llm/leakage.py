"""Held-out test passages inside a corpus: a prefix-filtered containment join.

Texts become word sequences (a Han character is a word) without case, width, punctuation,
spacing or layout, and sequences become shingles, held as 64-bit hashes.  The items are a table
like any other: their number is not limited, and whatever it is, the corpus is read once.

1. The items' shingles are written down, and marked in a bitmap of bounded size that goes to all
   tasks.  A shingle that is not marked is no item's.
2. One pass over the corpus keeps the marked shingles of each text with their positions, and
   counts in how many texts each stands.  By position, a shingle that stands alone can be part
   of no run and goes (positional bound); texts without any other give no row.
3. Item shingles are ordered by rarity.  A text that shares enough shingles with an item shares
   some of the item's prefix, so texts and items meet on prefix shingles only, and only those that
   meet on enough of them go on.  Texts too short for the required words go (length bound).
4. The pairs are verified in windows of the text of the item's size: runs of shared shingles on
   one diagonal, bridged over single changed words, must cover the required share of the item.

Runs made of mere phrases of the corpus do not count.  What is a phrase is judged for each item by
the texts that do not reproduce it, so that no number of copies makes a phrase of the item's own
wording: copies of the item and long stretches quoted from it are taken out of the counts, and
wording that is no more frequent than the rarest wording around it is the item's own too, since
phrases about others come without the names and things the item has between them.

All steps are joins and aggregates of tables, so that a passage copied into a third of the texts
is split by the planner's skew handling; nothing of texts, items or pairs comes to the driver but
the bitmap and one count.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_IGNORED = re.compile("[​-‏‪-‮⁠-⁤﻿­️]")
_WORD = re.compile("[㐀-䶿一-鿿豈-﫿]|[^\\W_㐀-䶿一-鿿豈-﫿]+")
_HAN = re.compile("[㐀-䶿一-鿿豈-﫿]")

#: Words to a shingle: single changed words leave shorter ones whole.
SHINGLE_WORDS, SHINGLE_HAN = 3, 5
#: The share of an item's shingles a text has at least if it reproduces half the wording with single words changed.
SHINGLE_SHARE = 0.15
#: Runs are bridged over so many changed words, and count from so many words; the whole of a shorter item is a run.
BRIDGE_WORDS, BRIDGE_HAN = 3, 5
RUN_WORDS, RUN_HAN = 6, 9
#: A stretch of so many runs' length, unbroken or broken by single changed words only, is quoted from the item, not a phrase.
QUOTED_RUNS, QUOTED_CHANGED_RUNS = 2, 4
#: Chance that a shingle with just the share of a phrase counts as more.
PHRASE_CHANCE = 0.001
#: Around a shingle, its own wording is as frequent as this share of the rarest shingles.
OWN_SHARE = 0.1
#: The bitmap has about so many cells for each shingle, and at most two to the power of this many.
CELLS_EACH, MOST_BITS = 64, 27
#: Words hashed at once, and hashes of words kept.
BLOCK_WORDS, KEPT_WORDS = 200_000, 1_000_000
#: Items a verifying task keeps at hand.
KEPT_ITEMS = 2000

_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: str) -> list[str]:
    text = unicodedata.normalize("NFKC", _IGNORED.sub("", text)).casefold()
    return _WORD.findall(unicodedata.normalize("NFKC", text))


class WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got

    def of(self, sequence: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, sequence), dtype=np.uint64, count=len(sequence))


def shingle_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """The hashes of all stretches of ``k`` words; each size has hashes of its own."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, k, dtype=np.uint64)
    for o in range(k):
        out = (out ^ ids[o : o + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


class Bitmap:
    """Which hashes are marked, by two cells each; what is not marked is surely none of them."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.shift, self.cells = np.uint64(64 - bits), cells

    @staticmethod
    def places(hashes: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return hashes >> shift, (hashes * _TURN) >> shift

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for p in self.places(hashes, self.shift):
            out &= ((self.cells[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out


class Item:
    """A test item: its words, and where each of its shingles stands."""

    __slots__ = ("key", "n", "run", "bridge", "k", "sequence", "at")

    def __init__(self, key: int, text: str):
        self.key, self.sequence = key, words(text)
        self.n = len(self.sequence)
        han = sum(1 for w in self.sequence if _HAN.match(w)) * 2 > self.n
        self.k = min(SHINGLE_HAN if han else SHINGLE_WORDS, self.n)
        self.run, self.bridge = min(RUN_HAN if han else RUN_WORDS, self.n), BRIDGE_HAN if han else BRIDGE_WORDS
        self.at: dict[tuple, list[int]] = defaultdict(list)
        for i in range(self.n - self.k + 1 if self.n else 0):
            self.at[tuple(self.sequence[i : i + self.k])].append(i)

    @classmethod
    def of_sizes(cls, n: int, k: int, run: int, bridge: int) -> Item:
        """An item known by its sizes only."""
        item = cls.__new__(cls)
        item.n, item.k, item.run, item.bridge = n, k, run, bridge
        return item


def reach(k: int) -> int:
    """Shared shingles further apart in the text are never in one run."""
    return k + 2 * (BRIDGE_HAN if k > SHINGLE_WORDS else BRIDGE_WORDS)


def covered(item: Item, hits: list[tuple[int, int]], rare: set[int]) -> int:
    """Words of the item inside runs of shared shingles, over all windows of the text.

    ``hits`` are positions (item, text) of shared shingles.  A run goes on along its diagonal, or
    one a few words aside, over at most ``bridge`` words; it counts if it is long enough and has
    shingles that are not mere phrases of the corpus.
    """
    mark = bytearray(item.n)
    for window in item_windows(item, hits):
        _mark(item, window, rare, mark)
    return sum(mark)


def item_windows(item: Item, hits: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """The hits in stretches of text that are apart by more than any run of the item can bridge."""
    window: list[tuple[int, int]] = []
    apart = max(item.n, item.k + 2 * item.bridge)
    for h in sorted(hits, key=lambda h: h[1]):
        if window and h[1] - window[-1][1] > apart:
            yield window
            window = []
        window.append(h)
    if window:
        yield window


def _mark(item: Item, hits: list[tuple[int, int]], rare: set[int], mark: bytearray) -> None:
    """Mark the words of the item that runs of these hits cover."""
    hits.sort(key=lambda h: (h[1] - h[0], h[0]))
    runs: list[list[int]] = []  # from, to (exclusive) in the item, diagonal, rare shingles, shingles
    for i, j in hits:
        d = j - i
        last = runs[-1] if runs else None
        if last and last[2] == d and i <= last[1] + item.bridge:
            last[1] = i + item.k
            last[3] += i in rare
            last[4] += 1
        else:
            runs.append([i, i + item.k, d, int(i in rare), 1])
    runs.sort()
    merged: list[list[int]] = []
    open_on: dict[int, list[int]] = {}  # merged runs that may go on, by diagonal
    for r in runs:
        latest = -1
        for d in range(r[2] - item.bridge, r[2] + item.bridge + 1):
            if d in open_on:
                # runs come by their beginnings: what has ended before this one is closed for good
                open_on[d] = [x for x in open_on[d] if r[0] <= merged[x][1] + item.bridge]
                latest = max(latest, *open_on[d], -1)
        if latest < 0:
            latest = len(merged)
            merged.append(list(r))
        else:
            m = merged[latest]
            open_on[m[2]].remove(latest)
            m[1], m[2], m[3], m[4] = max(m[1], r[1]), r[2], m[3] + r[3], m[4] + r[4]
        open_on.setdefault(r[2], []).append(latest)
    for low, high, _, rares, count in merged:
        if high - low >= item.run and rares >= max(1, 0.25 * count):
            mark[low:high] = b"\1" * (high - low)


def quoted(item: Item, hits: list[tuple[int, int]]) -> set[int]:
    """Positions of the item's shingles inside stretches too long for a phrase, or as long as the item."""
    hits = sorted(hits, key=lambda h: (h[1] - h[0], h[0]))
    out: set[int] = set()
    for step, runs in ((1, QUOTED_RUNS), (item.k + 1, QUOTED_CHANGED_RUNS)):
        stretch: list[tuple[int, int]] = []
        for h in [*hits, None]:
            if stretch and (h is None or h[1] - h[0] != stretch[-1][1] - stretch[-1][0] or h[0] - stretch[-1][0] > step):
                if stretch[-1][0] + item.k - stretch[0][0] >= min(runs * item.run, item.n):
                    out.update(i for i, _ in stretch)
                stretch = []
            stretch.append(h)
    return out


def phrase_from(mean: float) -> int:
    """The least count that a Poisson variable of this mean reaches with a chance below ``PHRASE_CHANCE``."""
    if mean > 400:
        return int(mean + 3.09 * mean**0.5) + 1
    term = math.exp(-mean)
    tail, n = 1.0, 0
    while tail >= PHRASE_CHANCE:
        tail -= term
        n += 1
        term *= mean / n
    return n


def own_wording(item: Item, texts: np.ndarray, own: np.ndarray, common: int, total: int, rare_share: float) -> np.ndarray:
    """Places of the item's shingles that are no phrases.

    ``texts`` and ``own`` count, by place, the texts that hold the shingle and those known to
    reproduce it; ``common`` is the count from which the others make a phrase.  Where all wording
    around a place is frequent, so many texts are taken to reproduce it.
    """
    if not len(texts):
        return np.zeros(0, dtype=np.int64)
    side = 2 * item.run + item.k
    padded = np.pad(texts.astype(np.float64), side, constant_values=np.nan)
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * side + 1)
    level = np.nanquantile(around, OWN_SHARE, axis=1, method="lower")
    from_level = {v: phrase_from(v + rare_share * max(0.0, total - v)) for v in np.unique(level).tolist()}
    bound = np.array([from_level[v] for v in level.tolist()])
    return np.flatnonzero((texts - own < common) | (texts < bound))


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def item_table(items: DataFrame) -> DataFrame:
    """``(item_id, n, k, run, bridge, shingles)``: one row per item with words, its shingles each with its places."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                item = Item(key, text)
                if not item.n:
                    continue
                at: dict[int, list[int]] = defaultdict(list)
                for i, h in enumerate(shingle_hashes(hashes.of(item.sequence), item.k).view(np.int64).tolist()):
                    at[h].append(i)
                rows.append((key, item.n, item.k, item.run, item.bridge, [{"h": h, "places": p} for h, p in at.items()]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([("h", pa.int64()), ("places", pa.list_(pa.int32()))])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item_id", "n", "k", "run", "bridge", "shingles"])

    once = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"))
    return once.mapInArrow(make, "item_id bigint, n int, k int, run int, bridge int, shingles array<struct<h:bigint,places:array<int>>>")


def bitmap_of(hashes: DataFrame, count: int) -> Bitmap:
    """The bitmap of a column of hashes; what comes to the driver is at most its cells."""
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(CELLS_EACH * max(1, count)))))
    shift = np.uint64(64 - bits)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            p = np.unique(np.concatenate(Bitmap.places(h, shift)))
            block, starts = np.unique(p >> np.uint64(6), return_index=True)
            marks = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), starts) if len(p) else p
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int64)), _signed(marks)], ["block", "marks"])

    got = hashes.mapInArrow(cells, "block bigint, marks bigint").groupBy("block").agg(F.bit_or("marks").alias("marks")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    return Bitmap(bits, out)


def shared_shingles(rows: DataFrame, marked: Bitmap, alone: Bitmap | None, sizes: list[int]) -> DataFrame:
    """One pass over ``(doc_id, text)``.

    Rows ``(row, doc_id, n, h, at)`` of the texts with marked shingles, and rows ``(shingle, texts)``,
    summed per task, of how many texts hold each; the sum without a shingle counts all texts.
    ``alone`` marks the shingles that are a whole item by themselves.
    """
    shared = rows.sparkSession.sparkContext.broadcast((marked, alone))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, whole = shared.value
        known = WordHashes()
        seen: Counter = Counter()
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40

        def block(keys: list[int], sequences: list[list[str]]) -> pa.RecordBatch:
            nonlocal number
            lengths = np.array([len(s) for s in sequences], dtype=np.int64)
            ends = np.cumsum(lengths)
            text_of = np.repeat(np.arange(len(keys)), lengths)
            ids = known.of(list(chain.from_iterable(sequences)))
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for k in sizes:
                h = shingle_hashes(ids, k)
                at = np.flatnonzero(bits.has(h))
                at = at[at + k <= ends[text_of[at]]]
                if not len(at):
                    continue
                h, text = h[at], text_of[at]
                order = np.lexsort((text, h))
                a, b = h[order], text[order]
                first = np.ones(len(a), dtype=bool)
                first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                for shingle, texts in zip(*(x.tolist() for x in np.unique(a[first].view(np.int64), return_counts=True)), strict=True):
                    seen[shingle] += texts
                near = np.zeros(len(at) + 1, dtype=bool)
                near[1:-1] = (text[1:] == text[:-1]) & (np.diff(at) <= reach(k))
                keep = near[1:] | near[:-1]
                if whole is not None:
                    keep |= whole.has(h)
                found.append((text[keep], h[keep], at[keep]))
            seen[None] += len(keys)
            text, h, at = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order = np.argsort(text, kind="stable")
            text, h, at = text[order], h[order], at[order]
            which, starts = np.unique(text, return_index=True)
            offsets = pa.array(np.append(starts, len(text)).astype(np.int32))
            begins = ends - lengths
            names = np.arange(number, number + len(which), dtype=np.int64)
            number += len(which)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names), pa.array([keys[i] for i in which.tolist()], pa.int64()), pa.array(lengths[which].astype(np.int32)), pa.ListArray.from_arrays(offsets, _signed(h)),
                    pa.ListArray.from_arrays(offsets, pa.array((at - begins[text]).astype(np.int32))), pa.nulls(len(which), pa.int64()), pa.nulls(len(which), pa.int64()),
                ],
                _SHARED,
            )

        def sums() -> pa.RecordBatch:
            n = len(seen)
            out = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32())), pa.array(list(seen.keys()), pa.int64()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(out, _SHARED)

        for batch in batches:
            keys: list[int] = []
            sequences: list[list[str]] = []
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sequence = words(text.as_py())
                keys.append(key)
                sequences.append(sequence)
                size += len(sequence)
                if size >= BLOCK_WORDS:
                    yield block(keys, sequences)
                    keys, sequences, size = [], [], 0
            if keys:
                yield block(keys, sequences)
            if len(seen) > KEPT_WORDS:
                yield sums()
        yield sums()

    return rows.mapInArrow(find, "row bigint, doc_id bigint, n int, h array<bigint>, at array<int>, shingle bigint, texts bigint")


_SHARED = ["row", "doc_id", "n", "h", "at", "shingle", "texts"]
_VERIFIED = "doc_id bigint, item_id bigint, at_item array<int>, at_text array<int>, whole boolean, reproduced boolean, own array<bigint>"


def _verify(share: float):
    """Pairs of texts and items that share enough, with the places of what they share and the shingles that are the item's own there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict[int, list[int]]] = {}
        for batch in batches:
            rows = []
            docs, lengths, keys, sizes, ks, runs, bridges = (batch.column(i).to_pylist() for i in (0, 1, 4, 5, 6, 7, 8))
            for r, (doc, n, key, item_n, k, run_, bridge) in enumerate(zip(docs, lengths, keys, sizes, ks, runs, bridges, strict=True)):
                if key not in kept:
                    if len(kept) >= KEPT_ITEMS:
                        kept.clear()
                    kept[key] = {s["h"]: s["places"] for s in batch.column(9)[r].as_py()}
                places = kept[key]
                h, at = batch.column(2)[r].as_py(), batch.column(3)[r].as_py()
                item = Item.of_sizes(item_n, k, run_, bridge)
                hits = [(i, j) for g, j in zip(h, at, strict=True) if g in places for i in places[g]]
                # length bound, with room for words left out
                whole = n >= share * item_n * 0.7 and covered(item, hits, range(item_n)) / item_n >= share
                own = quoted(item, hits)
                reproduced = whole and bool(own)
                if reproduced:
                    own = {i for i, _ in hits}
                if whole or own:
                    of = {i: g for g in places for i in places[g]} if own else {}
                    rows.append((doc, key, [i for i, _ in hits] if whole else None, [j for _, j in hits] if whole else None, whole, reproduced, sorted({of[i] for i in own})))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_(), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in _VERIFIED.split(", ")])

    return run


def find_leaks(docs: DataFrame, items: DataFrame, share: float = 0.46, id_col: str = "doc_id", text_col: str = "text", rare_share: float = 0.002) -> DataFrame:
    """``(doc_id, item_id, share)``: texts that reproduce at least half of an item's wording.

    ``share`` is a little below a half: words cut in two at the ends of a stretch do not count.

    Null, empty and wordless texts and items give nothing; an item shorter than a run has to stand
    in the text as a whole, single changed words aside; a repeated text is found as often as it
    occurs; a repeated item id is one item (of its longest text); other columns are ignored.  Every
    text is read whole and every item is used, however many there are.
    A shingle is a phrase of the corpus if, of the texts that do not reproduce the item, more than
    ``rare_share`` have it: the same share at every size, tested one-sided, so that a few texts of a
    small table prove nothing (see ``own_wording``).
    """
    from lacquer.session import materialise, spread

    known = materialise(item_table(items), "leak-items")
    shingles = known.select("item_id", "k", "run", F.size("shingles").alias("of"), F.explode("shingles").alias("s")).select("item_id", "k", "run", "of", "s.h", "s.places")
    sizes = [tuple(r) for r in known.groupBy("k").agg(F.sum(F.size("shingles")).alias("n"), F.sum(F.when(F.col("run") <= F.col("k"), 1).otherwise(0)).alias("alone")).collect()]  # at most five sizes
    count = sum(n for _, n, _ in sizes)
    marked = bitmap_of(shingles.select("h"), count)
    alone = bitmap_of(shingles.where("run <= k").select("h"), count) if any(a for _, _, a in sizes) else None
    rows = spread(docs.where(F.col(text_col) != "").select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")))
    read = materialise(shared_shingles(rows, marked, alone, sorted(k for k, _, _ in sizes)), "leak-shingles")
    texts = read.where("texts is null")
    counts = read.where("shingle is not null").groupBy(F.col("shingle").alias("h")).agg(F.sum("texts").alias("texts"))
    total = read.where("shingle is null and texts is not null").agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("t")).first().t
    counted = materialise(shingles.join(counts, "h", "left").select("item_id", "of", "h", "places", F.coalesce("texts", F.lit(0)).alias("texts")), "leak-counts")

    # of the shingles a text needs, it may have half among the commonest; the others stand in the prefix

    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("texts", "h"))
    need = F.greatest(F.lit(1), F.floor(F.col("of") * SHINGLE_SHARE)).cast("int")
    of_these = F.ceil(need / 2).cast("int")
    prefix = counted.select("item_id", "h", rank.alias("rank"), (F.col("of") - need + of_these).alias("last"), of_these.alias("least")).where("rank <= last")
    met = texts.select("row", F.explode(F.array_distinct("h")).alias("h")).join(prefix, "h")
    pairs = met.groupBy("row", "item_id").agg(F.count("*").alias("shared"), F.first("least").alias("least")).where("shared >= least").select("row", "item_id")
    candidates = pairs.join(texts.select("row", "doc_id", F.col("n").alias("words"), "h", "at"), "row").join(known, "item_id")
    candidates = candidates.where(F.size(F.array_intersect("h", F.transform("shingles", lambda s: s["h"]))) >= F.greatest(F.lit(1), F.floor(F.size("shingles") * SHINGLE_SHARE)))
    verified = candidates.select("doc_id", "words", "h", "at", "item_id", "n", "k", "run", "bridge", "shingles").mapInArrow(_verify(share), _VERIFIED)
    verified = materialise(verified, "leak-candidates")

    # phrases: what the texts that do not reproduce the item have too often
    own = verified.select("item_id", F.explode("own").alias("h")).groupBy("item_id", "h").agg(F.count("*").alias("own"))
    copies = verified.groupBy("item_id").agg(F.sum(F.col("reproduced").cast("bigint")).alias("copies"), F.max("whole").alias("whole")).where("whole")
    of_item = counted.join(copies.select("item_id"), "item_id").join(own, ["item_id", "h"], "left").groupBy("item_id").agg(F.collect_list(F.struct("places", "texts", F.coalesce("own", F.lit(0)).alias("own"))).alias("seen"))  # the shingles of one item

    def rarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, n, k, run, bridge, copied, seen in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                texts, own_texts = np.zeros(n - k + 1), np.zeros(n - k + 1)
                for s in seen:
                    texts[s["places"]], own_texts[s["places"]] = s["texts"], s["own"]
                places = own_wording(Item.of_sizes(n, k, run, bridge), texts, own_texts, phrase_from(rare_share * max(0, total - copied)), total, rare_share)
                rows.append((key, n, k, run, bridge, places.tolist()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item_id", "n", "k", "run", "bridge", "rare"])

    rare = known.drop("shingles").join(copies, "item_id").join(of_item, "item_id").select("item_id", "n", "k", "run", "bridge", "copies", "seen").mapInArrow(rarity, "item_id bigint, n int, k int, run int, bridge int, rare array<int>")
    judged = verified.where("whole").select("doc_id", "item_id", "at_item", "at_text").join(rare, "item_id")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            for doc, key, at_item, at_text, places, n, k, run, bridge in zip(*(batch.column(c).to_pylist() for c in range(9)), strict=True):
                part = covered(Item.of_sizes(n, k, run, bridge), list(zip(at_item, at_text, strict=True)), set(places)) / n
                if part >= share:
                    for column, value in zip(found, (doc, key, part), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["doc_id", "item_id", "share"])

    return judged.select("doc_id", "item_id", "at_item", "at_text", "rare", "n", "k", "run", "bridge").mapInArrow(judge, "doc_id bigint, item_id bigint, share double")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the leaks found, those whose text holds the item as it is written."""
    from lacquer.session import table

    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "eval_items").select("item_id", F.col("text").alias("wording"))
    return find_leaks(docs, items.withColumnRenamed("wording", "text")).join(docs, "doc_id").join(items, "item_id").where(F.col("text").contains(F.col("wording"))).select("doc_id", "item_id")


#: DuckDB statement of every text that holds an item as it is written.
P7_VERBATIM_SQL = "select d.doc_id, i.item_id from documents d join eval_items i on contains(d.text, i.text)"

__all__ = ["P7_VERBATIM_SQL", "Item", "covered", "find_leaks", "p7_found", "p7_verbatim", "words"]
