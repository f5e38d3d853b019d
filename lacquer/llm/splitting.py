"""Splitting oversized texts at natural boundaries, with a wanted overlap.

The candidate cut positions of a text carry a penalty by kind: paragraph, line, sentence,
clause, blank, any visible character.  The finer kinds are only offered inside stretches the
coarser ones leave too long.  A piece that ends at cut ``e`` is followed by one that begins
at ``o(e)``, the best boundary near ``e - overlap``.  Dynamic programming over the cuts
chooses the chain that covers the whole text, never exceeds the limit, and minimises the sum
of cut penalties, of squared departures from equal sizes and of a charge per piece: one objective
for every text, over all its boundaries, whatever its size and the number of pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES_SCHEMA = "chunk_id bigint, stage string, piece_no int, piece_from int, piece_to int, overlap int"

#: Penalties of the kinds of boundary, coarse to fine.
PARAGRAPH, LINE, SENTENCE, CLAUSE, BLANK, INSIDE = 0.0, 0.05, 0.15, 0.8, 1.6, 6.0
PIECE_CHARGE = 1.0
IMBALANCE = 0.6
#: Where there is no boundary, one place is as good as another: so many to the longest allowed distance between cuts.
CELLS = 150
#: Costs between cuts that are looked at at once.
BLOCK_COSTS = 1_000_000
#: Weight of a missing or excess share of the wanted overlap when its start is chosen.
OVERLAP_MISS = 2.0
#: Charge for each eighth by which an overlap is shorter at a cut, where there is no chain of pieces otherwise.
SHORTER = 1000.0

_CLOSERS = "”’」』】》）)\"'\\]"
_NATURAL = re.compile(
    rf"(?P<para>\n[ \t\r　]*\n\s*)|(?P<line>\n\s*)"
    rf"|(?P<sent>[。！？!?…]+[{_CLOSERS}]*[ \t　]*|[.;；](?=[\s{_CLOSERS}])[{_CLOSERS}]*[ \t]*)"
    rf"|(?P<clause>[，、：:,][{_CLOSERS}]*[ \t]*)|(?P<blank>[ \t　]+)"
)
_KINDS = (PARAGRAPH, LINE, SENTENCE, CLAUSE, BLANK)
_PENALTY = {"para": PARAGRAPH, "line": LINE, "sent": SENTENCE, "clause": CLAUSE, "blank": BLANK}
#: What can join code points into one visible character.
_JOINED = "[̀-ͯ҃-҉֑-ׇؐ-ًؚ-ٟऀ-෿ะ-๎ᄀ-ᇿ᪰-᫿᷀-᷿‌‍⃐-⃿〪-゙゚〯︀-️︠-︯\U0001f1e6-\U0001f1ff\U0001f3fb-\U0001f3ff\U000e0020-\U000e007f\U000e0100-\U000e01ef\r]"
_MAY_JOIN = re.compile(_JOINED)


def visible_breaks(text: str) -> np.ndarray | None:
    """Mask of positions 0..n between visible characters, or None where every position is one."""
    if not _MAY_JOIN.search(text):
        return None
    import regex

    mask = np.zeros(len(text) + 1, dtype=bool)
    mask[0] = True
    mask[[m.end() for m in regex.finditer(r"\X", text)]] = True
    return mask


def natural_boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions just behind a natural boundary and their penalties, ascending, without 0 and the end."""
    at, cost, n = [], [], len(text)
    for m in _NATURAL.finditer(text):
        end = m.end()
        if 0 < end < n:
            at.append(end)
            cost.append(_PENALTY[m.lastgroup])
    return np.array(at, dtype=np.int64), np.array(cost)


class Splitter:
    """One text; its boundaries are found once and serve every limit."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        self.visible = visible_breaks(text)
        at, cost = natural_boundaries(text)
        if self.visible is not None and len(at):
            keep = self.visible[at]
            at, cost = at[keep], cost[keep]
        self.at, self.cost = at, cost

    def candidates(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Cut positions such that no stretch between neighbours exceeds ``reach`` where avoidable."""
        pos, cost = self.at[self.cost <= SENTENCE], self.cost[self.cost <= SENTENCE]
        for finer in (CLAUSE, BLANK, INSIDE):
            edges = np.concatenate(([0], pos, [self.n]))
            wide = np.flatnonzero(np.diff(edges) > reach)
            if not len(wide):
                break
            extra_p, extra_c = [], []
            for k in wide:
                low, high = int(edges[k]), int(edges[k + 1])
                if finer == INSIDE:
                    step = max(1, reach // CELLS) if self.visible is None else 1
                    p = np.arange(low + step, high, step)
                    if self.visible is not None:
                        seen = p[self.visible[p]]
                        # a single visible character longer than the limit has to be cut itself
                        p = seen if np.diff(np.concatenate(([low], seen, [high]))).max() <= reach else p
                    c = np.full(len(p), INSIDE)
                    if self.visible is not None:
                        c = np.where(self.visible[p], INSIDE, 50 * INSIDE)
                else:
                    inside = (self.at > low) & (self.at < high) & (self.cost == finer)
                    p, c = self.at[inside], self.cost[inside]
                extra_p.append(p)
                extra_c.append(c)
            pos = np.concatenate([pos, *extra_p])
            cost = np.concatenate([cost, *extra_c])
            order = np.argsort(pos, kind="stable")
            pos, cost = pos[order], cost[order]
        return pos, cost

    def begin_after(self, cuts: np.ndarray, overlap: int, aside: int | None = None) -> np.ndarray:
        """For each cut, where the next piece begins: the boundary that comes nearest to the overlap, at most ``aside`` from it (else the overlap)."""
        if overlap <= 0:
            return cuts.copy()
        aside = overlap if aside is None else aside
        want = np.maximum(cuts - overlap, 0)
        best = np.full(len(cuts), -1, dtype=np.int64)
        score = np.full(len(cuts), np.inf)
        for kind in _KINDS:  # within a kind the nearest boundary is the best
            p = self.at[self.cost == kind]
            if not len(p):
                continue
            right = np.searchsorted(p, want, "left")
            for near in (np.maximum(right - 1, 0), np.minimum(right, len(p) - 1)):
                found = p[near]
                s = OVERLAP_MISS * np.abs(found - want) / overlap + kind
                better = (s < score) & (found < cuts) & (np.abs(found - want) <= aside)
                best = np.where(better, found, best)
                score = np.where(better, s, score)
        for i in np.flatnonzero(best < 0):  # no boundary near: the exact overlap, at the edge of a visible character
            p = int(want[i])
            while self.visible is not None and 0 < p and not self.visible[p]:
                p -= 1
            best[i] = p if cuts[i] - p <= overlap + aside else cuts[i]
        return np.minimum(best, cuts)

    def split(self, limit: int, overlap: int) -> list[tuple[int, int]]:
        """Pieces as (from, to) in code points; one piece if the text is within the limit."""
        n = self.n
        if n <= limit or limit < 1:
            return [(0, n)]
        overlap = max(0, min(overlap, limit - 1))
        aside = min(overlap, (limit - overlap) // 2)  # an overlap larger still would leave little to advance
        # visible characters are not cut for the sake of an overlap
        reach = max(1, (limit - overlap - aside) * (CELLS - 4) // CELLS, limit // 2 * (CELLS - 4) // CELLS)
        pos, penalty = self.candidates(reach)
        begin = self.begin_after(pos, overlap, aside)
        pieces = max(2, -(-(n - overlap) // max(1, limit - overlap)))
        ideal = (n + (pieces - 1) * overlap) / pieces
        chain = self._chain(pos, penalty, begin, limit, ideal)
        if chain is None and overlap:
            # only overlaps can stand in the way: at the cuts where they do, they may be shorter
            shorter = [(overlap * (8 - k) // 8, SHORTER * k) for k in range(1, 9)]
            begins = np.concatenate([begin, *(self.begin_after(pos, o, min(o, aside)) for o, _ in shorter)])
            charged = np.concatenate([penalty, *(penalty + charge for _, charge in shorter)])
            cuts = np.tile(pos, len(shorter) + 1)
            order = np.argsort(cuts, kind="stable")
            chain = self._chain(cuts[order], charged[order], begins[order], limit, ideal)
        if chain is None:
            raise AssertionError("no chain of pieces")
        return chain[1]

    def _chain(self, pos: np.ndarray, penalty: np.ndarray, begin: np.ndarray, limit: int, ideal: float) -> tuple[float, list[tuple[int, int]]] | None:
        """The cost and the pieces of the best chain of any number of pieces; a cut may stand there with several begins.

        Cuts are taken in blocks: all costs between a block and what can precede it are one matrix,
        and pieces within the block are settled by repeating its own part until nothing gets cheaper.
        """
        n = self.n
        # node 0 is the start of the text, node k the cut pos[k-1], the last node its end
        ends = np.concatenate(([0], pos, [n]))
        starts = np.concatenate(([0], begin, [n]))
        charge = np.concatenate(([0.0], penalty, [0.0])) + PIECE_CHARGE
        count = len(ends)
        best = np.full(count, np.inf)
        best[0] = 0.0
        previous = np.full(count, -1, dtype=np.int64)
        longest = np.maximum.accumulate(starts)  # starts never run far backwards
        first = np.searchsorted(longest, ends - limit, "left")
        j = 1
        while j < count:
            low = int(first[j])
            high = max(j + 1, min(int(np.searchsorted(ends, ends[j] + limit // 2, "right")), j + max(1, BLOCK_COSTS // max(1, j - low + 1))))
            size = ends[j:high, None] - starts[None, low:high]
            cost = IMBALANCE * ((size - ideal) / ideal) ** 2
            cost[(size > limit) | (starts[j:high, None] <= starts[None, low:high]) | (ends[j:high, None] <= ends[None, low:high])] = np.inf
            rows, own = np.arange(high - j), charge[j:high]
            if low < j:
                before = best[None, low:j] + cost[:, : j - low]
                pick = np.argmin(before, axis=1)
                best[j:high] = before[rows, pick] + own
                previous[j:high] = np.where(np.isfinite(best[j:high]), low + pick, -1)
            inside = cost[:, j - low :]
            while np.isfinite(inside).any():
                within = best[None, j:high] + inside
                pick = np.argmin(within, axis=1)
                cheaper = within[rows, pick] + own
                better = cheaper < best[j:high]
                if not better.any():
                    break
                best[j:high] = np.where(better, cheaper, best[j:high])
                previous[j:high] = np.where(better, j + pick, previous[j:high])
            j = high
        if not np.isfinite(best[-1]):
            return None
        chain, j = [], count - 1
        while j > 0:
            i = int(previous[j])
            chain.append((int(starts[i]), int(ends[j])))
            j = i
        return float(best[-1]), chain[::-1]


def split_texts(texts: DataFrame, caps: DataFrame, id_col: str = "chunk_id", text_col: str = "source_chunk", max_caps: int = 1000) -> DataFrame:
    """Pieces of every text and stage whose length exceeds the stage's ``max_chars``.

    ``piece_from`` and ``piece_to`` are code-point positions (from 0, end exclusive), ``overlap``
    the code points shared with the piece before.  Null and empty texts and stages with a null
    limit or one below 1 give no rows; a null overlap counts as 0; a text within the limit gives
    none for that stage.  Repeated rows of ``texts`` give repeated pieces.  ``caps`` is a
    configuration table of at most ``max_caps`` rows; more fail.
    """
    from lacquer.session import small_rows, spread

    limits = [
        (r.stage, int(r.max_chars), int(r.overlap_chars or 0))
        for r in small_rows(caps.select("stage", "max_chars", "overlap_chars").where("max_chars >= 1"), max_caps, "caps")
    ]
    rows = texts.select(F.col(id_col).alias("chunk_id"), F.col(text_col).alias("body"))
    if not limits:
        return rows.where("false").selectExpr("chunk_id", "'' stage", "0 piece_no", "0 piece_from", "0 piece_to", "0 overlap")
    rows = rows.where(F.length("body") > min(m for _, m, _ in limits))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, stages, nos, froms, tos, shared = [], [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                splitter = None
                for stage, limit, overlap in limits:
                    if len(text) <= limit:
                        continue
                    splitter = splitter or Splitter(text)
                    before = None
                    for no, (low, high) in enumerate(splitter.split(limit, overlap)):
                        ids.append(key)
                        stages.append(stage)
                        nos.append(no)
                        froms.append(low)
                        tos.append(high)
                        shared.append(0 if before is None else before - low)
                        before = high
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(stages, pa.string()), *(pa.array(x, pa.int32()) for x in (nos, froms, tos, shared))],
                ["chunk_id", "stage", "piece_no", "piece_from", "piece_to", "overlap"],
            )

    return spread(rows).mapInArrow(cut, PIECES_SCHEMA)


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return split_texts(table(spark, sf_dir, "chapters"), table(spark, sf_dir, "chunk_caps"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows and stages that had to be split: the first piece of each."""
    return p2_pieces(spark, sf_dir).where("piece_no = 0").select("chunk_id", "stage")


def p2_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pieces of each row and stage amount to: where they begin and end, gaps, pieces beyond the limit, and pieces that add nothing."""
    from lacquer.session import table

    pieces = p2_pieces(spark, sf_dir).join(F.broadcast(table(spark, sf_dir, "chunk_caps").select("stage", "max_chars")), "stage")  # a configuration table
    before = Window.partitionBy("chunk_id", "stage").orderBy("piece_no")
    checked = pieces.withColumn("end_before", F.lag("piece_to").over(before))
    return checked.groupBy("chunk_id", "stage").agg(
        F.min("piece_from").alias("begins"), F.max("piece_to").alias("ends"), F.sum((F.col("piece_from") > F.col("end_before")).cast("int")).alias("gaps"),
        F.sum((F.col("piece_to") - F.col("piece_from") > F.col("max_chars")).cast("int")).alias("too_long"), F.sum((F.col("piece_to") <= F.col("end_before")).cast("int")).alias("idle"),
    )


#: DuckDB statement of what pieces have to amount to: the whole text, without gaps, within the limit, each adding something.
P2_COVERAGE_SQL = "select chunk_id, stage, 0 as begins, length(source_chunk)::int as ends, 0::bigint as gaps, 0::bigint as too_long, 0::bigint as idle from chapters join chunk_caps on length(source_chunk) > max_chars"

#: DuckDB statement of which rows have to be split.
P2_FOUND_SQL = "select chunk_id, stage from chapters join chunk_caps on length(source_chunk) > max_chars"

__all__ = ["P2_COVERAGE_SQL", "P2_FOUND_SQL", "Splitter", "p2_coverage", "p2_found", "p2_pieces", "split_texts"]
