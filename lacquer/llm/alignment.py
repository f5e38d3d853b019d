"""Sentence alignment of rough translations.

The lines of a bilingual chunk are cut into units (sentences, parts after a semicolon).  How well
a unit explains another is measured with associations between Han characters and words of the
other side: first those that anchor by themselves - equal numbers, the readings of characters in
names, transcribed names - then, after a first alignment of all chunks, the associations counted over
its confidently aligned units.  Chunks are cut into units and words once; what the first alignment read
is kept as words for the second.  Within a chunk the anchors (units that are each other's best, with a margin) are chained by a heaviest increasing subsequence; the gaps of the
chain are aligned by local dynamic programming with joins and splits; strong pairs off the chain,
wherever in the chunk, are moved sentences, and what is left over joins the neighbour that explains it.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HAN = re.compile("[㐀-鿿豈-﫿]")
_ZH_UNIT = re.compile("[^。！？!?…；;\n]+[。！？!?…；;]*[”’」』）]*|[。！？!?…；;]+[”’」』）]*")
_VI_UNIT = re.compile(r"(?:[^.!?…;\n]|\.(?=\w))+(?:[.!?…;]+[\"”’]*|$)")
_ZH_NUMBER = re.compile("[0-9]+|[〇零一二两三四五六七八九十百千万]+")
_WORD = re.compile(r"\d+|[^\W\d_]+")
_MARKED = re.compile("[àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ]")
_DIGIT = re.compile(r"\d")
_MARKS = re.compile("[̀-ͯ]")
_DIGITS = {c: i for i, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
_UNITS = {"十": 10, "百": 100, "千": 1000, "万": 10000}

#: Scores of unit pairs: anchors, pairs the dynamic program may make, moved sentences, left-over parts.
ANCHOR, PAIR, MOVED, PART = 0.62, 0.56, 0.57, 0.6
MARGIN = 0.12
#: A unit so far explained by one on the other side is a part of it, whose share of that one may be as small as LEAST squared.
WHOLE, LEAST = 0.78, 0.3
#: Weight of an equal number, against at most about 2 of a rare word.
NUMBER_WEIGHT = 2.5
#: A part has to explain at least so much more of the other side.
GAIN = 0.12
SKIP = 0.17
#: Cells of a task's counts after which they are handed on.
MOST_COUNTED = 30_000_000
#: Cells that are counted at once.
COUNTED_AT_ONCE = 1_000_000
#: Words whose tokens a task remembers.
MOST_WORDS = 500_000
#: Cells of unit pairs that are scored at once; only those that can be paired are kept.
BLOCK_CELLS = 2_000_000


def numeral(text: str) -> int:
    """The value of a number in digits or Han numerals."""
    if text.isascii():
        return int(text)
    total = part = digit = 0
    for c in text:
        if c in _DIGITS:
            digit = _DIGITS[c]
        else:
            unit = _UNITS[c]
            if unit == 10000:
                total += (part + digit) * unit
                part = 0
            else:
                part += (digit or 1) * unit
            digit = 0
    return total + part + digit


def zh_tokens(text: str) -> list[str]:
    """Han characters, and numbers above ten as one token each."""
    if not _ZH_NUMBER.search(text):
        return _HAN.findall(text)
    out, end = [], 0
    for m in _ZH_NUMBER.finditer(text):
        if m.group().isascii() or len(m.group()) > 1 or m.group() == "十":
            out += _HAN.findall(text[end : m.start()])
            out.append(f"#{numeral(m.group())}")
            end = m.end()
    return out + _HAN.findall(text[end:])


def _stripped(text: str) -> str:
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", text)).replace("đ", "d")


class _Tokens(dict):
    """Tokens of words of the other side: numbers as on this one, words as they are or plain with a sign before them."""

    def __init__(self, plain: bool):
        self.plain = plain

    def __missing__(self, word: str) -> str:
        if len(self) >= MOST_WORDS:
            self.clear()
        token = self[word] = f"#{int(word)}" if word.isdecimal() else "~" + _stripped(word) if self.plain else word
        return token


_AS_WRITTEN, _PLAIN = _Tokens(False), _Tokens(True)


def _vi_both(text: str) -> tuple[list[str], list[str]]:
    """Tokens as they are written and plain."""
    text = unicodedata.normalize("NFC", text.lower())
    words = _WORD.findall(text)
    plain = [_PLAIN[w] for w in words]
    return [_AS_WRITTEN[w] for w in words] if _MARKED.search(text) or _stripped(text) != text else plain, plain


def vi_tokens(text: str, marked: bool = True) -> list[str]:
    """Words of the other side, numbers as on this one.

    Diacritics tell words apart, but some translations lack them: words of a text without any,
    or of every text if not ``marked``, are written plain with a sign before them.
    """
    return _vi_both(text)[0 if marked else 1]


def units(lines: list[tuple[int, str]], pattern: re.Pattern) -> list[tuple[int, str]]:
    """(line, text) of the units, in order; what has no word or character is no unit."""
    out: list[tuple[int, str]] = []
    for no, text in lines:
        for m in pattern.finditer(text):
            unit = m.group().strip()
            if not _WORD.search(unit):  # Han characters are words too
                continue
            # what follows a quotation in small letters belongs to it
            if pattern is _VI_UNIT and out and out[-1][0] == no and unit[:1].islower() and out[-1][1][-1:] in "\"”’":
                out[-1] = (no, out[-1][1] + " " + unit)
            else:
                out.append((no, unit))
    return out


class Coverage:
    """Shares of source units that target units explain, alone or together."""

    def __init__(self, share: np.ndarray, best: np.ndarray):
        self.share, self.best = share, best
        self.total = np.maximum(share.sum(axis=1), 1.2)

    def rows(self, low: int, high: int) -> np.ndarray:
        """What each target explains alone of the sources low..high."""
        return (self.share[low:high] @ self.best) / self.total[low:high, None]

    def columns(self, low: int, high: int) -> np.ndarray:
        """What the targets low..high explain alone of each source."""
        return (self.share @ self.best[:, low:high]) / self.total[:, None]

    def alone(self, source: int, target: int) -> float:
        return float(self.share[source] @ self.best[:, target] / self.total[source])

    def together(self, source: int, targets: list[int]) -> float:
        return float(self.share[source] @ self.best[:, targets].max(axis=1) / self.total[source])


class Side:
    """The units of one side as ids of known words: which unit holds which id, and its numbers."""

    def __init__(self, units_of: list[list[str]], ids: dict[str, int]):
        self.count = len(units_of)
        flat = list(chain.from_iterable(units_of))
        place = np.repeat(np.arange(self.count), list(map(len, units_of)))
        got = np.fromiter(map(ids.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        self.numbers: dict[str, list[int]] = {}
        for k in [k for k, w in enumerate(flat) if w[0] == "#"]:  # numbers have no id
            self.numbers.setdefault(flat[k], []).append(int(place[k]))
        order = got.argsort(kind="stable")
        order = order[got[order].searchsorted(0) :]
        sorted_ids = got[order]
        new = np.ones(len(order), dtype=bool)
        np.not_equal(sorted_ids[1:], sorted_ids[:-1], out=new[1:])
        at = new.nonzero()[0]
        self.ids = sorted_ids[at]
        #: By distinct id, the units that hold it, and the place of the id.
        self.holders, self.inverse = place[order], new.cumsum() - 1
        self.first = np.append(at, len(order))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of stretches one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Associations:
    """How surely a word of one side brings a token of the other: sparse rows of weights."""

    def __init__(self, vi_to_zh: dict[str, dict[str, float]], zh_to_vi: dict[str, dict[str, float]], vi_weight: dict[str, float], zh_weight: dict[str, float]):
        self.vi_to_zh, self.zh_to_vi, self.vi_weight, self.zh_weight = vi_to_zh, zh_to_vi, vi_weight, zh_weight
        #: Ids of all words of a side, as sources or targets.
        self.zh_ids = {t: i for i, t in enumerate(dict.fromkeys([*zh_to_vi, *(x for row in vi_to_zh.values() for x in row)]))}
        self.vi_ids = {t: i for i, t in enumerate(dict.fromkeys([*vi_to_zh, *(x for row in zh_to_vi.values() for x in row)]))}
        self.rows = {"zh": self._sparse(zh_to_vi, zh_weight, self.zh_ids, self.vi_ids), "vi": self._sparse(vi_to_zh, vi_weight, self.vi_ids, self.zh_ids)}

    def tables(self) -> tuple:
        return self.vi_to_zh, self.zh_to_vi, self.vi_weight, self.zh_weight

    @staticmethod
    def _sparse(table: dict[str, dict[str, float]], weight: dict[str, float], source: dict[str, int], target: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where the row of each source word begins, the targets and weights of all rows, the sources' own weights, and room to look targets up."""
        lengths = np.array([len(table.get(t, ())) for t in source], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        targets = np.array([target[x] for t in source for x in table.get(t, ())], dtype=np.int64)
        values = np.array([np.float32(v) for t in source for v in table.get(t, {}).values()], dtype=np.float64)
        own = np.array([weight.get(t, 0.0) if t in table else 0.0 for t in source] + [0.0])
        return first, targets, values, own, np.full(len(target) + 1, -1, dtype=np.int64)

    def explained(self, source: Side, target: Side, side: str) -> Coverage:
        """How much of each source unit the target units explain."""
        first, targets, values, weight, where = self.rows[side]
        known = len(source.ids)
        share = np.zeros((source.count, known + len(source.numbers)))
        best = np.zeros((known + len(source.numbers), target.count))
        if known:
            strength = weight[source.ids]
            share[source.holders, source.inverse] = strength[source.inverse]
            # pairs of a source word and a target word that both stand here
            where[target.ids] = np.arange(len(target.ids))
            starts, lengths = first[source.ids], first[source.ids + 1] - first[source.ids]
            at = spans(starts, lengths)
            word, there = np.repeat(np.arange(known), lengths), where[targets[at]]
            where[target.ids] = -1
            both = there >= 0
            word, there, sure = word[both], there[both], values[at[both]]
            # each in all units that hold the target word
            counts = target.first[there + 1] - target.first[there]
            units_at = target.holders[spans(target.first[there], counts)]
            np.maximum.at(best.reshape(-1), np.repeat(word * target.count, counts) + units_at, np.repeat(sure, counts))
        for k, (number, places) in enumerate(source.numbers.items(), start=known):  # a number is explained by the same number
            share[places, k] = NUMBER_WEIGHT
            best[k, target.numbers.get(number, [])] = 1.0
        return Coverage(share, best)

    def scores(self, zh: list[list[str]], vi: list[list[str]]) -> tuple[Coverage, Coverage]:
        """How much of each zh unit the vi units explain, and the other way round."""
        a, b = Side(zh, self.zh_ids), Side(vi, self.vi_ids)
        return self.explained(a, b, "zh"), self.explained(b, a, "vi")


def heaviest_chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The heaviest subsequence of pairs that increases on both sides."""
    pairs = sorted(pairs)
    rank = {j: r for r, j in enumerate(sorted({j for _, j, _ in pairs}), start=1)}
    # by rank, a binary indexed tree of the heaviest chains that end at most there: weight, and the first pair with it
    tree: list[tuple[float, int]] = [(0.0, 1)] * (len(rank) + 1)
    best: list[float] = []
    back: list[int] = []
    entered = 0
    for k, (i, j, w) in enumerate(pairs):
        while pairs[entered][0] < i:
            new, r = (best[entered], -entered), rank[pairs[entered][1]]
            while r < len(tree):
                tree[r] = max(tree[r], new)
                r += r & -r
            entered += 1
        top, r = (0.0, 1), rank[j] - 1
        while r:
            top = max(top, tree[r])
            r -= r & -r
        best.append(top[0] + w)
        back.append(-top[1])
    chain = []
    k = int(np.argmax(best)) if best else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def adds(cover: Coverage, source: int, targets: list[int], new: int) -> bool:
    """Whether one more target explains what the others leave open of the source."""
    before = cover.together(source, targets)
    return cover.together(source, [*targets, new]) - before >= max(GAIN, 0.35 * (1 - before))


class UnitPairs:
    """Scores of the pairs of units that can be paired or be parts, by zh unit and vi unit, over the whole chunk."""

    def __init__(self, zh_cover: Coverage, vi_cover: Coverage):
        self.zh_cover, self.vi_cover = zh_cover, vi_cover
        self.n, self.m = len(zh_cover.share), len(vi_cover.share)
        self.score: list[dict[int, float]] = []
        #: as score, but less for places further off: equal sentences go to the nearer place
        self.placed: list[dict[int, float]] = []
        #: shares of at least PART that the vi unit explains of the zh unit, and the reverse
        self.zh_part: list[dict[int, float]] = []
        self.vi_part: list[dict[int, float]] = []
        size = max(1, BLOCK_CELLS // self.m)
        for low in range(0, self.n, size):
            high = min(low + size, self.n)
            zh_part, vi_part = zh_cover.rows(low, high), vi_cover.columns(low, high).T
            score = np.sqrt(np.minimum(zh_part, 1) * np.minimum(vi_part, 1))
            # half explained on both sides is the wording of another sentence; a part is wholly explained
            score[(score < PAIR) & (np.maximum(zh_part, vi_part) < WHOLE)] = 0
            a, b = np.nonzero(score > 0)
            placed = score[a, b] - 0.004 * np.minimum(np.abs((a + low) * (self.m / self.n) - b), 12)
            self._keep(self.score, high - low, a, b, score[a, b])
            self._keep(self.placed, high - low, a, b, placed)
            for kept, values in ((self.zh_part, zh_part), (self.vi_part, vi_part)):
                a, b = np.nonzero(values >= PART)
                self._keep(kept, high - low, a, b, values[a, b])

    @staticmethod
    def _keep(kept: list[dict[int, float]], count: int, a: np.ndarray, b: np.ndarray, values: np.ndarray) -> None:
        """Add ``count`` rows of the values at (a, b)."""
        rows: list[dict[int, float]] = [{} for _ in range(count)]
        for i, j, v in zip(a.tolist(), b.tolist(), values.tolist(), strict=True):
            rows[i][j] = v
        kept += rows


def align_gap(pairs: UnitPairs, closed_i: set[int], closed_j: set[int], i0: int, i1: int, j0: int, j1: int) -> list[tuple[int, int]]:
    """Local dynamic programming over units i0..i1 and j0..j1 (ends exclusive); closed units make no simple pairs."""
    n, m = i1 - i0, j1 - j0
    if not n or not m:
        return []
    zh_cover, vi_cover = pairs.zh_cover, pairs.vi_cover
    before: list[float] = []
    last = [0.0] * (m + 1)
    step = [bytes(m + 1)]
    for a in range(1, n + 1):
        i = i0 + a - 1
        made: dict[int, list[tuple[float, int]]] = {}
        if i not in closed_i:
            for j, s in pairs.score[i].items():
                if s >= LEAST and j0 <= j < j1 and j not in closed_j:
                    made.setdefault(j, []).append((last[j - j0] + s, 3))
        for j in pairs.vi_part[i]:  # one zh unit, two vi units
            if j0 < j < j1 and j - 1 in pairs.vi_part[i]:
                first, second = (j - 1, j) if zh_cover.alone(i, j - 1) >= zh_cover.alone(i, j) else (j, j - 1)
                if adds(zh_cover, i, [first], second):
                    made.setdefault(j, []).append((last[j - j0 - 1] + zh_cover.together(i, [first, second]) + SKIP, 4))
        if a > 1:
            for j in pairs.zh_part[i]:  # two zh units, one vi unit
                if j0 <= j < j1 and j in pairs.zh_part[i - 1]:
                    first, second = (i - 1, i) if vi_cover.alone(j, i - 1) >= vi_cover.alone(j, i) else (i, i - 1)
                    if adds(vi_cover, j, [first], second):
                        made.setdefault(j, []).append((before[j - j0] + vi_cover.together(j, [first, second]) + SKIP, 5))
        row, how_row, left = [0.0], bytearray(m + 1), 0.0
        for b in range(1, m + 1):
            top, how = last[b], 1
            if left > top:
                top, how = left, 2
            if j0 + b - 1 in made:
                for v, h in made[j0 + b - 1]:
                    if v > top:
                        top, how = v, h
            row.append(top)
            how_row[b], left = how, top
        before, last = last, row
        step.append(bytes(how_row))
    out, a, b = [], n, m
    while a and b:
        how = step[a][b]
        if how == 1:
            a -= 1
        elif how == 2:
            b -= 1
        else:
            i, j = i0 + a - 1, j0 + b - 1
            out.append((i, j))
            if how == 4:
                out.append((i, j - 1))
                b -= 1
            elif how == 5:
                out.append((i - 1, j))
                a -= 1
            a, b = a - 1, b - 1
    return out


def align_units(zh_cover: Coverage, vi_cover: Coverage) -> list[tuple[int, int, float]]:
    """Matched units of a chunk with their scores."""
    pairs_of = UnitPairs(zh_cover, vi_cover)
    n, m, score, placed = pairs_of.n, pairs_of.m, pairs_of.score, pairs_of.placed
    # the best and the second best of each unit
    col_best, col_top, col_rest = [-1] * m, [-1.0] * m, [0.0] * m
    row_best, row_rest = [-1] * n, [0.0] * n
    for i in range(n):
        top = -1.0
        for j, v in placed[i].items():
            if v > top:
                row_rest[i], top, row_best[i] = max(row_rest[i], top), v, j
            else:
                row_rest[i] = max(row_rest[i], v)
            if v > col_top[j]:
                col_rest[j], col_top[j], col_best[j] = max(col_rest[j], col_top[j]), v, i
            else:
                col_rest[j] = max(col_rest[j], v)
    anchors = []
    for i in range(n):
        j = row_best[i]
        if j >= 0 and col_best[j] == i and score[i][j] >= ANCHOR and placed[i][j] - max(row_rest[i], col_rest[j]) >= MARGIN:
            anchors.append((i, j, score[i][j]))
    chain = heaviest_chain(anchors)
    on_chain = set(chain)
    moved = [a for a in anchors if a not in on_chain]
    # what is moved takes no part in the gaps
    closed_i, closed_j = {i for i, _, _ in moved}, {j for _, j, _ in moved}
    pairs = [(i, j) for i, j, _ in anchors]
    edges = [(-1, -1, 0.0), *chain, (n, m, 0.0)]
    for (a, b, _), (c, d, _) in zip(edges, edges[1:], strict=False):
        pairs += align_gap(pairs_of, closed_i, closed_j, a + 1, c, b + 1, d)
    matched = set(pairs)
    # sentences moved out of their gap
    used_i, used_j = {i for i, _ in matched}, {j for _, j in matched}
    order = sorted(((placed[i][j], i, j) for i in range(n) if i not in used_i for j, v in score[i].items() if j not in used_j and v >= MOVED), reverse=True)
    for _, i, j in order:
        if i not in used_i and j not in used_j:
            matched.add((i, j))
            used_i.add(i)
            used_j.add(j)
    # parts: a unit nobody took, wholly explained by a unit whose own match leaves that part open
    by_i: dict[int, list[int]] = {}
    by_j: dict[int, list[int]] = {}
    for i, j in matched:
        by_i.setdefault(i, []).append(j)
        by_j.setdefault(j, []).append(i)
    extra = []
    explaining: dict[int, list[tuple[int, float]]] = {}
    for i in by_i:
        for j, v in pairs_of.vi_part[i].items():
            if j not in used_j:
                explaining.setdefault(j, []).append((i, v))
    for j, sources in explaining.items():
        options = [
            (v - 0.02 * min(min(abs(j - k) for k in by_i[i]), 12), i)
            for i, v in sources
            if min(abs(j - k) for k in by_i[i]) <= 3 and adds(zh_cover, i, by_i[i], j)
        ]
        if options:
            extra.append((max(options)[1], j))
    for i in range(n):
        if i in used_i:
            continue
        options = [
            (v - 0.02 * min(min(abs(i - k) for k in by_j[j]), 12), j)
            for j, v in pairs_of.zh_part[i].items()
            if j in by_j and min(abs(i - k) for k in by_j[j]) <= 3 and adds(vi_cover, j, by_j[j], i)
        ]
        if options:
            extra.append((i, max(options)[1]))
    matched.update(extra)
    return [(i, j, score[i].get(j, 0.0)) for i, j in sorted(matched)]


class Chunk(NamedTuple):
    """Both sides of a chunk as units: their lines and distinct tokens, the other side's as written and plain."""

    zh_lines: list[int]
    zh: list[list[str]]
    vi_lines: list[int]
    vi: list[list[str]]
    plain: list[list[str]]


def chunk_of(rows: list[tuple[int, str | None, str | None]]) -> Chunk:
    """Units of both sides; a side left in Chinese has none."""
    zh = units([(no, z) for no, z, _ in rows if z and z.strip()], _ZH_UNIT)
    vi = units([(no, v) for no, _, v in rows if v and v.strip() and (not _HAN.search(v) or 2 * len(_HAN.findall(v)) < len(v))], _VI_UNIT)
    if not zh or not vi:
        return Chunk([], [], [], [], [])
    written, plain = [], []
    for _, text in vi:
        a, b = _vi_both(text)
        plain.append(list(dict.fromkeys(b)))
        written.append(plain[-1] if a is b else list(dict.fromkeys(a)))
    return Chunk([no for no, _ in zh], [list(dict.fromkeys(zh_tokens(t))) for _, t in zh], [no for no, _ in vi], written, plain)


def align_chunk(rows: list[tuple[int, str | None, str | None]], known: Associations, marked: bool = True) -> tuple[Chunk, list[tuple[int, int, float]]]:
    """A chunk and the matches of its units."""
    chunk = chunk_of(rows)
    return chunk, align_units(*known.scores(chunk.zh, chunk.vi if marked else chunk.plain)) if chunk.zh else []


class _Ids(dict):
    """Ids of words in the order they come; the empty word is the first."""

    def __init__(self):
        self[""] = 0

    def __missing__(self, word: str) -> int:
        new = self[word] = len(self)
        return new


class PairCounts:
    """Counts of tokens and of pairs across sides, in one matrix that grows with the vocabularies."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.zh, self.vi = _Ids(), _Ids()
        self.matrix = np.zeros((512, 4096), dtype=np.int32)
        self._forget()

    def _forget(self) -> None:
        self.a: list[int] = []
        self.b: list[int] = []
        self.of_a: list[int] = []
        self.of_b: list[int] = []
        self.cells = 0

    def add(self, zh: Iterable[str], vi: Iterable[str]) -> None:
        """Count a pair of units of distinct tokens; the empty token stands for any, numbers are counted alone."""
        a = [0, *[self.zh[t] for t in zh if t[0] != "#"]]
        b = [0, *[self.vi[t] for t in vi if t[0] != "#"]]
        self.a += a
        self.b += b
        self.of_a.append(len(a))
        self.of_b.append(len(b))
        self.cells += len(a) * len(b)
        if self.cells > COUNTED_AT_ONCE:
            self.settle()

    def settle(self) -> None:
        """Enter what was added into the matrix."""
        rows, columns = self.matrix.shape
        if len(self.zh) > rows or len(self.vi) > columns:
            grown = np.zeros((rows if len(self.zh) <= rows else len(self.zh) * 5 // 4, columns if len(self.vi) <= columns else len(self.vi) * 3 // 2), dtype=np.int32)
            grown[:rows, :columns] = self.matrix
            self.matrix, columns = grown, grown.shape[1]
        of_a, of_b = np.array(self.of_a, dtype=np.int64), np.array(self.of_b, dtype=np.int64)
        # each token of a unit with all of the other unit
        lengths = np.repeat(of_b, of_a)
        others = np.array(self.b, dtype=np.int64)[spans(np.repeat(np.cumsum(of_b) - of_b, of_a), lengths)]
        np.add.at(self.matrix.reshape(-1), np.repeat(np.array(self.a, dtype=np.int64) * columns, lengths) + others, np.int32(1))
        self._forget()

    def full(self) -> bool:
        return self.matrix.size > MOST_COUNTED

    def drain(self, parts: int) -> Iterator[tuple[int, str, str, bytes]]:
        """(part, token, words, counts): the words that stand with a token and how often; what stands with any goes to every part."""
        self.settle()
        words = np.array(list(self.vi), dtype=object)
        for token, row in zip(list(self.zh), self.matrix, strict=False):
            at = np.nonzero(row)[0]
            if len(at):
                held = " ".join(words[at].tolist()), row[at].astype("<i4").tobytes()
                for part in range(parts) if not token else (zlib.crc32(token.encode()) % parts,):
                    yield part, token, *held
        self.clear()


def between(matches: list[tuple[int, int, float]], n: int, m: int) -> list[tuple[int, int]]:
    """Single units left over on both sides between two pairs in step: they speak of the same, whatever they say."""
    of = {i: j for i, j, _ in matches}
    used = {j for _, j, _ in matches}
    return [(i, of[i - 1] + 1) for i in range(1, n - 1) if i not in of and i - 1 in of and of.get(i + 1) == of[i - 1] + 2 and of[i - 1] + 1 not in used]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Chunks from rows sorted by pair and line; a line stored twice counts once."""
    held, rows = None, []
    for batch in batches:
        for pair, no, zh, vi in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if pair != held:
                if rows:
                    yield held, rows
                held, rows = pair, []
            if not rows or rows[-1][0] != no:
                rows.append((no, zh, vi))
            elif (zh, vi) != rows[-1][1:]:
                rows[-1] = (no, rows[-1][1] or zh, rows[-1][2] or vi)
    if rows:
        yield held, rows


def reading_associations(glossary: DataFrame | None) -> Associations:
    """Anchors known beforehand: the readings of characters that names have."""
    vi_to_zh: dict[str, dict[str, float]] = {}
    zh_to_vi: dict[str, dict[str, float]] = {}
    if glossary is not None:
        from lacquer.llm.names import learn_readings

        readings = learn_readings(glossary)
        for c, w in readings.vietnamese.items():
            vi_to_zh.setdefault("~" + w, {})[c] = 1.0
            zh_to_vi.setdefault(c, {})["~" + w] = 1.0
    vi_weight = {w: 1.0 for w in vi_to_zh} 
    zh_weight = {c: 1.0 for c in zh_to_vi} 
    return Associations(vi_to_zh, zh_to_vi, vi_weight, zh_weight)


def sampled_pairs(lines: DataFrame, most: int) -> DataFrame:
    """All lines of at most ``most`` bilingual chunks, those whose ids have the smallest hashes; ``align_lines`` takes no sample."""
    cell = F.xxhash64(F.col("pair_id"), F.lit("associations"))
    pairs = lines.select("pair_id", cell.alias("cell")).distinct()
    count = lines.agg(F.approx_count_distinct("pair_id").alias("n")).first().n
    if count > 2 * most:  # fewer come to the sort
        pairs = pairs.where(F.pmod("cell", F.lit(1 << 24)) < int((1 << 24) * min(1.0, (1.5 * most + 100) / count)))
        cut = pairs.select(F.pmod("cell", F.lit(1 << 24)).alias("at")).orderBy("at").limit(most).agg(F.max("at").alias("cut")).first().cut
        return lines.where(F.pmod(cell, F.lit(1 << 24)) < F.lit(cut))
    cut = pairs.select("cell").orderBy("cell").limit(most).agg(F.max("cell").alias("cut")).first().cut
    return lines.where(cell <= F.lit(cut)) if cut is not None else lines


#: Columns of what the first alignment leaves: chunks as words, and counts.
_CHUNK = "pair_id bigint, zh_lines array<int>, vi_lines array<int>, zh string, vi string"
_COUNT = "part int, token string, words string, n binary"
#: Characters of words, and bytes of counts, in one batch.
BATCH = 4_000_000


def _first_alignment(rows: DataFrame, first: Associations, parts: int) -> DataFrame:
    """One row per chunk with its units as words, and the counts of all tasks over the units they pair with confidence."""
    shared = rows.sparkSession.sparkContext.broadcast(first.tables())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Associations(*shared.value)
        seen = PairCounts()
        schema = pa.schema([("pair_id", pa.int64()), ("zh_lines", pa.list_(pa.int32())), ("vi_lines", pa.list_(pa.int32())), ("zh", pa.string()), ("vi", pa.string()), ("part", pa.int32()), ("token", pa.string()), ("words", pa.string()), ("n", pa.binary())])
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) if held else [()] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            held.clear()
            return batch

        def counts() -> Iterator[pa.RecordBatch]:
            size = 0
            for row in seen.drain(parts):
                held.append((None,) * 5 + row)
                size += len(row[2]) + len(row[3])
                if size > BATCH:
                    yield out()
                    size = 0

        size = 0
        for pair, lines in _chunks(batches):
            chunk, matches = align_chunk(lines, known, marked=False)
            if not chunk.zh:
                continue
            sure = [(i, j) for i, j, s in matches if s >= 0.5]
            for i, j in sure + between(matches, len(chunk.zh), len(chunk.vi)):
                seen.add(chunk.zh[i], chunk.plain[j] if chunk.vi[j] is chunk.plain[j] else dict.fromkeys(chunk.vi[j] + chunk.plain[j]))
            zh, vi = ("\n".join(map(" ".join, side)) for side in (chunk.zh, chunk.vi))
            held.append((pair, chunk.zh_lines, chunk.vi_lines, zh, vi, None, None, None, None))
            size += len(zh) + len(vi)
            if size > BATCH:
                yield out()
                size = 0
            if seen.full():
                yield from counts()
        yield from counts()
        yield out()

    return _written(rows.mapInArrow(count, f"{_CHUNK}, {_COUNT}"), "first-alignment")


def _significant(counts: DataFrame, parts: int, least: int, weakest: float) -> DataFrame:
    """Counts of all tasks summed, and of each pair of words how much more often than by chance they stand together, where that is at least ``weakest``."""

    def associate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        names: list[str] = []
        held = None
        sums = of_vi = np.zeros(0, dtype=np.int64)

        def settled() -> Iterator[pa.RecordBatch]:
            nonlocal of_vi
            if not held[1]:  # how often each word stands with any
                of_vi = sums.copy()
                return
            at = np.nonzero(sums >= least)[0]
            at = at[at > 0]
            n, nz, nv, total = sums[at], int(sums[0]), of_vi[at], int(of_vi[0])
            by_vi = (n / nv - nz / total) / max(1 - nz / total, 0.05)
            by_zh = (n / nz - nv / total) / np.maximum(1 - nv / total, 0.05)
            kept = (by_vi >= weakest) | (by_zh >= weakest)
            names.extend(list(ids)[len(names) :])
            size = int(kept.sum())
            if size:
                fixed = [pa.array([v] * size, t) for v, t in ((held[1], pa.string()), (nz, pa.int64()), (total, pa.int64()))]
                yield pa.RecordBatch.from_arrays([fixed[0], pa.array([names[k] for k in at[kept].tolist()], pa.string()), pa.array(by_vi[kept]), pa.array(by_zh[kept]), fixed[1], pa.array(nv[kept]), fixed[2]], ["zh", "vi", "by_vi", "by_zh", "nz", "nv", "total"])

        for batch in batches:
            for part, token, words, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (part, token) != held:
                    if held is not None:
                        yield from settled()
                    held = (part, token)
                    sums = np.zeros(len(ids), dtype=np.int64)
                at = [ids[w] for w in words.split(" ")]
                if len(ids) > len(sums):
                    sums = np.concatenate((sums, np.zeros(len(ids) - len(sums), dtype=np.int64)))
                sums[at] += np.frombuffer(n, dtype="<i4")  # the words of a row are distinct
        if held is not None:
            yield from settled()

    counts = counts.repartition(parts, "part").sortWithinPartitions("part", "token")
    return counts.mapInArrow(associate, "zh string, vi string, by_vi double, by_zh double, nz bigint, nv bigint, total bigint")


def learn_associations(counts: DataFrame, first: Associations, parts: int, least: int = 4, weakest: float = 0.12, most_associations: int = 4_000_000) -> Associations:
    """Associations from the counts of the first alignment over all chunks.

    What comes to the driver is bounded by the words that go together significantly, which follow the
    vocabulary and not the number of chunks (more than ``most_associations`` fail, none is left out).
    """
    from lacquer.session import small_rows

    rows = sorted(small_rows(_significant(counts, parts, least, weakest), most_associations, "associations"))
    vi_to_zh, zh_to_vi, vi_weight, zh_weight = ({k: dict(v) if isinstance(v, dict) else v for k, v in t.items()} for t in first.tables())
    # what was counted replaces what was known beforehand
    counted_vi, counted_zh = {r.vi for r in rows}, {r.zh for r in rows}
    vi_to_zh = {k: v for k, v in vi_to_zh.items() if k not in counted_vi}
    zh_to_vi = {k: v for k, v in zh_to_vi.items() if k not in counted_zh}
    for r in rows:
        if r.by_vi >= weakest:
            vi_to_zh.setdefault(r.vi, {})[r.zh] = r.by_vi
        if r.by_zh >= weakest:
            zh_to_vi.setdefault(r.zh, {})[r.vi] = r.by_zh
    frequency = {("vi", r.vi): r.nv for r in rows} | {("zh", r.zh): r.nz for r in rows}
    for side, to, weight in (("vi", vi_to_zh, vi_weight), ("zh", zh_to_vi, zh_weight)):
        for token, partners in to.items():
            top = max(partners.values())
            # half as sure as the surest partner is sure enough: a word has several translations
            to[token] = {x: min(1.0, a / (0.5 * top)) for x, a in partners.items() if a >= 0.25 * top}
            seen = frequency.get((side, token))
            weight[token] = min(1.0, top) * (float(np.log(1 + rows[0].total / seen)) / 4 if seen else 1.0)
    return Associations(vi_to_zh, zh_to_vi, vi_weight, zh_weight)


def _written(df: DataFrame, label: str) -> DataFrame:
    from lacquer.session import materialise

    return materialise(df, label)


def align_lines(lines: DataFrame, glossary: DataFrame | None = None) -> DataFrame:
    """``(pair_id, zh_line, vi_line)``: lines that translate one another, each pair of lines once.

    Rows without pair or line number give nothing; null and blank sides are gaps; a line stored
    twice counts once; a chunk with one side only gives nothing; further columns are ignored.
    The glossary helps with the readings of names; without it only numbers anchor at first.
    """
    spark = lines.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = lines.where("pair_id is not null and line is not null").select(F.col("pair_id").cast("bigint").alias("pair_id"), F.col("line").cast("int").alias("line"), "zh", "vi")
    rows = rows.repartition(parts, "pair_id").sortWithinPartitions("pair_id", "line", "zh", "vi")
    first = reading_associations(glossary)
    kept = _first_alignment(rows, first, parts)
    known = learn_associations(kept.where("part is not null").select("part", "token", "words", "n"), first, parts)
    shared = spark.sparkContext.broadcast(known.tables())

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Associations(*shared.value)
        found: list[tuple[int, int, int]] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            batch = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], ["pair_id", "zh_line", "vi_line"])
            found.clear()
            return batch

        for batch in batches:
            for pair, zh_lines, vi_lines, zh, vi in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                matches = align_units(*model.scores(*([unit.split() for unit in side.split("\n")] for side in (zh, vi))))
                found += [(pair, a, b) for a, b in sorted({(zh_lines[i], vi_lines[j]) for i, j, _ in matches})]
                if len(found) > 20_000:
                    yield out()
        yield out()

    chunks = kept.where("pair_id is not null").select("pair_id", "zh_lines", "vi_lines", "zh", "vi")
    return chunks.mapInArrow(align, "pair_id bigint, zh_line int, vi_line int")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return align_lines(table(spark, sf_dir, "chunk_lines"), table(spark, sf_dir, "glossary"))


__all__ = ["Associations", "align_chunk", "align_lines", "align_units", "heaviest_chain", "learn_associations", "numeral", "p4_found", "vi_tokens", "zh_tokens"]
