"""The story of a page without the site's own material: a maximum-scoring subsequence.

Words score positive, tags negative.  Tags are the pieces of wording that mark a line as the
site's (navigation, counters, notices, remarks ...); their weights are log-odds learned from
lines of a bounded sample of pages (``train_pages``).  No list of words labels those lines, but what
pages themselves show: wording that a site repeats from page to page, and the shapes of links,
counters and labels.  One linear scan over the lines finds the contiguous region with the
largest sum; everything outside is not story, and neither are lines inside whose own sum is
negative (advertisements between paragraphs).  Tags between quotation marks do not count:
what somebody says or reads in the story is story.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HAN = re.compile("[㐀-鿿豈-﫿]")
_LATIN = re.compile(r"[^\W\d_㐀-鿿豈-﫿]+")
_RUNS = re.compile(r"[㐀-鿿豈-﫿]+|[^\W\d_㐀-鿿豈-﫿]+")
_TITLED = re.compile("《[^》\n]*》")
_NUMBERS = re.compile(r"\d+")
_QUOTED = re.compile("“[^“”\n]*”|「[^「」\n]*」|『[^『』\n]*』|\"[^\"\n]*\"")
_ENDS = re.compile("[。！？!?…]|\\.(?=\\s|$|[\"”])")
_PAUSE = re.compile("[，,；;：:]")
_HEADER = re.compile(r"^\s*Chapter\s+\d+\s*-.*\|\s*SourceFile:", re.I)
_SHAPES = (
    ("^links", re.compile(r"^(?:[^。！？!?…|/>»«·]+(?:\s+[·]\s+|\s*[|/>»«]\s*)){2,}[^。！？!?…]+$|^\s*(?:←|<<|«)|(?:→|>>|»)\s*$|^\s*(?:\[[^\]]{1,12}\]\s*){2,}$|^(?:[^。！？!?….,，-]{1,40}-){2,}[^。！？!?….,，]{1,40}$")),
    ("^entry", re.compile(r"^\s*(?:[·•*▪#]|\d{1,3}[.、)])\s*\S|\S\s{2,}\d+\s*$|^\s*《[^》]*》\s*$")),
    ("^count", re.compile(r"(?:\d[\d,:.-]*+\D{1,8}){2,}\d|\d{4}-\d{2}-\d{2}|[（(]\d+[)）]\s*$|©|\d+\s*/\s*\D{0,3}\d+")),
    ("^label", re.compile(r"^[^，,。！？!?…]{1,14}[：:]\s*$")),
    ("^mark", re.compile(r"[▶►◀◄★☆※]")),
    ("^fields", re.compile(r"(?:[^\s：:]{1,8}[：:][ \t]?[^\s：:]{1,20}[\s　]+){2,}[^\s：:]{1,8}[：:][ \t]?[^\s：:]{1,20}\s*$")),
    ("^user", re.compile(r"^\s*(?:#\d+\s+)?[A-Za-z][\w*]{1,14}\s*[：:]|^\s*#\d+\s+\w")),
)

#: A title and the beginning of its text, as other books are announced.
_BLURB = re.compile(r"^[^，,。！？!?…：:“\"]{2,60}[：:]\s*[^“\"\s].*(?:\.\.\.|……|…)\s*$|^[^，,。！？!?…：:“\"]{2,60}[：:]\s*[“\"][^”\"]*[”\"].+\.\.\.\s*$")
BLURB_LINE = -12.0
#: What a line starts from: a short line that ends like no sentence is rather a heading or a link.
BARE_LINE = -3.0
WORD_SCORE, MOST_WORDS = 1.0, 40.0
#: Shapes that also occur inside a story.
_SHOWN = frozenset(("^entry", "^label", "^user", "^fields"))
#: A sentence of the site between paragraphs (an advertisement) parts the story at most this much.
AD_FLOOR = -6.0
#: What wording has to outweigh inside the region, besides the words.
INSIDE = 2.0
#: Lines of more words are judged by their words and tags alone.
LONG_WORDS = 25
#: Lines longer than this have no shape.
LONGEST_SHAPED = 160
#: Tags below this weight are noise; weights above the other are cut.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 7.0
#: Wording that so many pages of a site have is the site's if chance does not explain it from the other sites.
FEW_PAGES, REPEATED_CHANCE = 3, 1e-6
#: Wording that so many pages have is the site's if such a share of it stands outside of the story.
EDGE_PAGES, EDGE_SHARE = 5, 0.6
#: Of so many words, so many pages have the same ones only if they are the site's.
SAME_WORDS, SAME_PAGES = 8, 6
#: Rounds of learning from the regions found.
ROUNDS = 1


def pieces(line: str) -> set[str]:
    """What can become a tag: pairs and triples of Han characters, words and pairs of words, shapes."""
    out = set()
    low = line.lower()
    for run in re.findall("[㐀-鿿豈-﫿]+", low):
        out.update(run[i : i + n] for n in (2, 3, 4) for i in range(len(run) - n + 1))
    latin = _LATIN.findall(low)
    out.update(f" {w} " for w in latin if len(w) > 2)
    out.update(f" {a} {b} " for a, b in zip(latin, latin[1:], strict=False))
    return out


def shapes(line: str) -> list[str]:
    """Shapes of short lines; a long line is prose or a row of links, which tags tell apart."""
    if len(line) > LONGEST_SHAPED:
        return []
    return [name for name, pattern in _SHAPES if pattern.search(line)]


def word_count(line: str) -> float:
    """Words; two Han characters make one, and so do twelve letters run together."""
    if line.isascii():
        return max(len(line.split()), len(line) / 12) if _LATIN.search(line) else 0
    han = len(line) - len(_HAN.sub("", line))
    if han * 2 > len(line):
        return han / 2
    return han / 2 + max(len(_LATIN.findall(line)), (len(line) - han) / 12)


class Weights:
    """Weights of tags; matching is one pass of an automaton over the line."""

    def __init__(self, tags: dict[str, float]):
        self.tags = tags
        self.automaton = None

    def _build(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for tag, weight in self.tags.items():
            if not tag.startswith("^"):
                self.automaton.add_word(tag, (len(tag), weight, tag))
        self.automaton.add_word("\0", (1, 0.0, ""))
        self.automaton.make_automaton()

    def __getstate__(self):
        return {"tags": self.tags, "automaton": None}

    def _matches(self, line: str):
        if self.automaton is None:
            self._build()
        text = line.lower()
        if _LATIN.search(text):
            text = f" {' '.join(_RUNS.findall(text))} "
        return self.automaton.iter(text)

    def found(self, line: str) -> set[str]:
        """The tags in the line."""
        return {tag for _, (_, _, tag) in self._matches(line)}

    def tag_score(self, line: str) -> float:
        """The weights of the tags in the line; of overlapping ones the heaviest counts."""
        found = [(weight, end - length + 1, end) for end, (length, weight, _) in self._matches(line)]
        if len(found) < 2:
            return found[0][0] if found else 0.0
        found.sort(reverse=True)
        total, taken = 0.0, []
        for weight, low, high in found:
            if all(high < a or low > b for a, b in taken):
                taken.append((low, high))
                total += weight
        return total

    def line_scores(self, line: str) -> tuple[float, float]:
        """Words minus tags, positive for story: for the scan, and for a line inside the region.

        Between lines of the story a short line without the end of a sentence, or an entry of a
        list, is told or shown there; only wording speaks against it.
        """
        told = word_count(line)
        quoted = "“" in line or '"' in line or "「" in line or "『" in line
        outside = _QUOTED.sub(" ", line) if quoted else line
        tags = self.tag_score(outside)
        words = WORD_SCORE * min(told, MOST_WORDS)
        if tags and quoted:  # a title between marks does not speak for an advertisement
            words = WORD_SCORE * min(word_count(outside), MOST_WORDS)
        if _BLURB.match(line):
            return BLURB_LINE - tags, words + INSIDE - tags
        if told > LONG_WORDS:
            return max(words - tags, AD_FLOOR), words + INSIDE - tags
        seen = shapes(line)
        least = AD_FLOOR if told >= 4 and all(s == "^mark" for s in seen) else -1e9
        if not told and not tags and not seen:
            return 0.5, 0.5  # a row of dots or a rule
        inside = words + INSIDE - tags - sum(self.tags.get(s, 0.0) for s in seen if s not in _SHOWN)
        tags += sum(self.tags.get(s, 0.0) for s in seen)
        if told < 8 and not _ENDS.search(line) and not (told >= 5 and _PAUSE.search(line)):
            return max(BARE_LINE + 0.3 * told - tags, least), inside
        return max(words - tags, least), inside


def story_lines(lines: list[str], weights: Weights) -> list[bool]:
    """Which lines are story, by one scan for the region with the largest sum."""
    scores, inside = [0.0] * len(lines), [0.0] * len(lines)
    forced = set()
    for i, line in enumerate(lines):
        if not line or line.isspace():
            continue
        if "SourceFile" in line and _HEADER.match(line):
            forced.add(i)
            scores[i] = MOST_WORDS
        else:
            scores[i], inside[i] = weights.line_scores(line)
    best, best_from, best_to = 0.0, 0, -1
    total, begin = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, best_from, best_to = total, begin, i
    return [i in forced or (best_from <= i <= best_to and inside[i] >= 0) for i in range(len(lines))]


def wording(line: str) -> str:
    """A line without what changes from page to page: titles and what is quoted, numbers, marks, blanks and case."""
    return " ".join(_RUNS.findall(_NUMBERS.sub("0", _TITLED.sub(" ", _QUOTED.sub(" ", line)).lower())))


def by_chance(count: int, mean: float) -> float:
    """The chance of so many or more where ``mean`` are expected (Poisson)."""
    term, below = math.exp(-mean), 0.0
    for k in range(count):
        below += term
        term *= mean / (k + 1)
    return max(0.0, 1.0 - below)


def repeated_lines(pages: list[tuple[str | None, str]]) -> set[str]:
    """Wording of the site's own among (site, page).

    Only pages that are not the same page count: their longest lines differ.  Wording is the site's if
    more of its pages have it than the other sites let expect (what stories say, they say on all sites
    alike), or if it stands outside of the story (see ``edge_lines``).  Only long wording in which
    nothing changes is the site's on all sites too: no two stories say so much in the same words.
    """
    seen: dict[str, dict[str | None, set[str]]] = {}
    of_site: dict[str | None, set[str]] = {}
    same: set[str] = set()
    for site, page in pages:
        lines = page.split("\n")
        story = "\n".join(sorted((x for x in lines if not _HEADER.match(x)), key=len)[-3:])
        of_site.setdefault(site, set()).add(story)
        for line in lines:
            if line.strip() and not _HEADER.match(line) and (said := wording(line)):
                seen.setdefault(said, {}).setdefault(site, set()).add(story)
                if word_count(line) >= SAME_WORDS and said == " ".join(_RUNS.findall(line.lower())):
                    same.add(said)
    total = sum(map(len, of_site.values()))
    out = set()
    for said, sites in seen.items():
        everywhere = sum(map(len, sites.values()))
        if said in same and everywhere >= SAME_PAGES:
            out.add(said)
            continue
        for site, places in sites.items():
            here, all_here = len(places), len(of_site[site])
            elsewhere = (everywhere - here + 0.5) / (total - all_here + 1)
            if here >= FEW_PAGES and by_chance(here, elsewhere * all_here) < REPEATED_CHANCE:
                out.add(said)
                break
    return out | edge_lines(pages, out, {said for said, sites in seen.items() if sum(map(len, sites.values())) >= EDGE_PAGES})


def edge_lines(pages: list[tuple[str | None, str]], known: set[str], repeated: set[str]) -> set[str]:
    """Of repeated wording, what mostly stands outside of the story's region, or at its very edge."""
    first = weigh((label_line(line, known), line) for _, page in pages for line in page.split("\n"))
    outside: Counter = Counter()
    inside: Counter = Counter()
    for _, page in pages:
        lines = page.split("\n")
        said = [wording(line) if line.strip() and not _HEADER.match(line) else "" for line in lines]
        told = [i for i, story in enumerate(story_lines(lines, first)) if story and said[i] and said[i] not in repeated]
        for i, what in enumerate(said):
            if what in repeated:
                (inside if told and told[0] < i < told[-1] else outside)[what] += 1
    return {said for said, n in outside.items() if n >= EDGE_SHARE * (n + inside[said])}


def label_line(line: str, repeated: set[str] = frozenset()) -> int:
    """1 the site's, 0 story, -1 unclear: the labels of the training pages, by what the site repeats and by shape."""
    told = word_count(line)
    if not told or _HEADER.match(line):
        return -1
    if wording(line) in repeated:
        return 1
    if len(_ENDS.findall(line)) >= 2 and told >= 10:
        return 0
    shaped = bool(shapes(line))
    if shaped and not _ENDS.search(line) and told <= 14:
        return 1
    if _ENDS.search(line) and _PAUSE.search(line) and told >= 9 and not shaped:
        return 0
    return -1


def learn(pages: list[tuple[str | None, str]]) -> Weights:
    """Weights of the tags from (site, page): labelled by what a site repeats and by shapes first, then by the regions those find."""
    repeated = repeated_lines(pages)
    weights = weigh((label_line(line, repeated), line) for _, page in pages for line in page.split("\n"))
    for _ in range(ROUNDS):
        weights = weigh(pair for _, page in pages for pair in region_labels(page.split("\n"), weights, repeated))
    return weights


def region_labels(lines: list[str], weights: Weights, repeated: set[str]) -> Iterator[tuple[int, str]]:
    """Labels of the lines of a page: what the region leaves out is the site's, titles and announcements of books aside."""
    for line, story in zip(lines, story_lines(lines, weights), strict=True):
        if not line.strip() or _HEADER.match(line):
            continue
        label = label_line(line, repeated)
        if story:
            yield (0 if label != 1 else -1), line
        elif label == 1 or not _BLURB.match(line) and word_count(line) >= 4 and not shapes(line):
            yield 1, line


def weigh(labelled: Iterable[tuple[int, str]]) -> Weights:
    """Log-odds of pieces of wording between the lines labelled 1 and 0."""
    lines: tuple[list[str], list[str]] = ([], [])
    for label, line in labelled:
        if label >= 0:
            lines[label].append(line)
    theirs: Counter = Counter()
    for line in lines[1]:
        theirs.update(pieces(_QUOTED.sub(" ", line)))
    theirs = Counter({piece: n for piece, n in theirs.items() if n >= 3})
    told: Counter = Counter()
    if theirs:
        find = Weights(dict.fromkeys(theirs, 1.0)).found
        for line in lines[0]:
            told.update(find(line))
    for label, count in ((1, theirs), (0, told)):
        for line in lines[label]:
            count.update(shapes(line))
    tags = {}
    for piece, seen in theirs.items():
        if seen < 3:
            continue
        weight = math.log((seen + 0.5) / (len(lines[1]) + 1)) - math.log((told[piece] + 0.5) / (len(lines[0]) + 1))
        # rare on both sides says little: odds against the chance of an unseen story piece
        weight = min(weight, MOST_WEIGHT, math.log1p(seen) * 2.0)
        if weight >= LEAST_WEIGHT and told[piece] * 8 <= seen:
            tags[piece] = round(weight, 3)
    for name, _ in _SHAPES:
        tags.setdefault(name, 4.0)
    return Weights(tags)


def train(chapters: DataFrame, id_col: str = "chunk_id", text_col: str = "source_chunk", site_col: str = "site", train_pages: int = 1200) -> Weights:
    """Learn from at most ``train_pages`` pages, chosen by the hash of their id; a table without sites is one site."""
    from lacquer.llm.sampling import bounded_rows

    site = F.col(site_col) if site_col in chapters.columns else F.lit(None).cast("string")
    pages = bounded_rows(chapters, id_col, [site, F.col(text_col)], train_pages, "page", F.col(text_col) != "")
    return learn([(r[0], r[1]) for r in pages])


def find_boilerplate(chapters: DataFrame, weights: Weights | None = None, id_col: str = "chunk_id", text_col: str = "source_chunk") -> DataFrame:
    """``(chunk_id, line_no)`` of the non-blank lines that are not story.

    Lines are divided at the line feed and counted from 0, blank ones too.  Null, empty and
    blank texts give nothing; a page without any story gives all its lines; repeated rows give
    repeated results; other columns are ignored.
    """
    from lacquer.session import spread

    shared = chapters.sparkSession.sparkContext.broadcast((weights or train(chapters, id_col, text_col)).tags)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weights(shared.value)
        for batch in batches:
            ids, numbers = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = text.split("\n")
                for no, story in enumerate(story_lines(lines, known)):
                    if not story and lines[no].strip():
                        ids.append(key)
                        numbers.append(no)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], ["chunk_id", "line_no"])

    rows = chapters.where(F.col(text_col) != "").select(F.col(id_col).cast("bigint").alias("chunk_id"), F.col(text_col).alias("text"))
    return spread(rows).mapInArrow(mark, "chunk_id bigint, line_no int")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return find_boilerplate(table(spark, sf_dir, "chapters"))


__all__ = ["Weights", "find_boilerplate", "label_line", "learn", "p5_found", "story_lines", "train"]
