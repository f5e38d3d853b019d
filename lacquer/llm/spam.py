"""Keyword-stuffed and link-list pages.

Each text is cut into units: sentences, list entries, lines.  Content features say how much of the
text stands in entries of lists, in lines with links, in sentences stuffed with one keyword and in
sentences that end as such, how its words repeat and how its entries take up each other's words;
link features say how many links there are, to how many hosts, and how much of the text is their
anchors.  Bagged decision trees, each split choosing among a few features only, are trained here
on a bounded sample (``train_rows``) of weakly labelled texts.  Labels come from several rules
about different features (``RULES``); where rules disagree or say nothing, there is no label.
The votes of the trees are then smoothed with the spam rate of their host, which is counted over
all texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = (
    "listed", "linked", "stuffed", "sentences", "distinct", "top", "recurring", "taken_up", "entries", "entry_words", "units", "everywhere", "digits", "marks", "unended",
    "han", "links", "hosts", "anchored", "repeated_hosts",
)

_INVISIBLE = re.compile("[​-‏‪-‮⁠-⁤﻿­]")
_URL = re.compile(r"(?:(?:https?://|www\.)[^\s)\]】》]+|\b[a-z0-9][a-z0-9-]{0,62}(?:\.[a-z0-9-]{1,63}){0,8}\.[a-z]{2,63}(?:/[^\s)\]】》]*)?)", re.I)
_HOST = re.compile(r"^(?:https?://)?(?:www\.)?")
_GAPS = re.compile(r"[^\S\n]{3,}")
_QUOTE_PREFIX = re.compile(r"^\s*[|>]\s(?=\S)")
#: One sentence with its closing quotes, or the unterminated rest of a line.
_SENTENCE = re.compile(r"(?:[^。！？!?….\n]|\.(?![\s\"”’」』)]|$))*(?:[。！？!?….]+[\"”’」』)）]*|$)", re.M)
_SEPARATOR = re.compile(r"\s*[|¦>»#,，、;；/=•◦▪★☆◆※→~～《》【】\[\]{}]+\s*|\s[-–—:·]\s|(?<=\S)[:：](?=\S{2})|(?<=[㐀-鿿])\s+(?=[㐀-鿿])")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_DIGIT = re.compile(r"\d")
_HAN = re.compile("[㐀-鿿豈-﫿]")
_ENDS = re.compile(r"[。！？!?…]|\.(?=[\s\"”’」』)）]|$)")
_TERMINAL = re.compile(r"[。！？!?….][\"”’」』)）]*$")

#: Frequent words that do not make a sentence stuffed.
STOPWORDS = frozenset(
    "the a an of to and in on at for with from by was were is are be been had has have not no but that this it as you your i "
    "và của là có không cho đã được một các những với trong ra từ đến người khi này đó thì mà ở trên cái chiếc con như"
    .split()
)

#: Entries of lists are at most this long, in tokens; whole lists have at least so many entries.
ENTRY_TOKENS, LIST_ENTRIES = 5, 4
#: Repeated words are at least this share of a stuffed sentence.
STUFFED_SHARE = 0.36
#: So many lines in a row without the end of a sentence are entries, whatever their length.
BARE_RUN = 5


def tokens(text: str) -> list[str]:
    """Words of alphabetic scripts, pairs of neighbouring characters of Han script."""
    out = []
    for word in _WORD.findall(text.lower()):
        if _HAN.search(word):
            out += [word[i : i + 2] for i in range(max(1, len(word) - 1))]
        else:
            out.append(word)
    return out


def extent(text: str) -> int:
    """Letters and digits; a Han character counts as much as three of another script."""
    return sum(map(len, _WORD.findall(text))) + 2 * len(_HAN.findall(text))


def words_in(entry: str) -> float:
    """Length of a list entry in words; two Han characters make one."""
    han = len(_HAN.findall(entry))
    return len(_WORD.findall(_HAN.sub(" ", entry))) + han / 2


def is_stuffed(sentence: str, found: list[str] | None = None) -> bool:
    """Words, or pairs of Han characters, that occur three times and more make up much of the sentence (whose tokens may be given)."""
    found = tokens(sentence) if found is None else found
    if len(found) < 3 or len(set(found)) > len(found) - 2:  # nothing can stand there three times
        return False
    counts = Counter(t for t in found if len(t) > 1 and not t.isdigit() and t not in STOPWORDS)
    if not counts or max(counts.values()) < 3:
        return False
    runs = _WORD.findall(sentence.lower())
    whole = covered = 0.0
    for run in runs:
        if not _HAN.search(run):
            if len(run) > 1 and not run.isdigit() and run not in STOPWORDS:
                whole += 1
                covered += counts[run] >= 3
            continue
        mark = [False] * len(run)
        for i in range(len(run) - 1):
            if counts[run[i : i + 2]] >= 3:
                mark[i] = mark[i + 1] = True
        whole += len(run) / 2
        covered += sum(mark) / 2
    return covered >= STUFFED_SHARE * whole


def listed_share(found: list[str], entries: list[str], terminated: bool) -> float:
    """The share of a unit, given by its tokens and entries, that is short entries of a list.

    Clauses of a sentence can be as short as entries; what ends like a sentence is only a list
    if its words come back.
    """
    if len(entries) < LIST_ENTRIES:
        return 0.0
    sizes = [words_in(e) for e in entries]
    short = [s for s in sizes if s <= ENTRY_TOKENS]
    if len(short) < LIST_ENTRIES:
        return 0.0
    if terminated:
        repeats = len(set(found)) < 0.7 * len(found) and sum(short) >= 0.7 * sum(sizes)
        return float(repeats)
    return sum(short) / sum(sizes)


def bare_lines(lines: list[str]) -> set[int]:
    """Lines that belong to a run of lines in which no sentence ends."""
    out: set[int] = set()
    run: list[int] = []
    for i, line in enumerate([*lines, "."]):
        if i < len(lines) and not _WORD.search(line):
            continue
        if i < len(lines) and not _ENDS.search(line):
            run.append(i)
            continue
        if len(run) >= BARE_RUN:
            out.update(run)
        run = []
    return out


def page_features(text: str) -> tuple[float, ...]:
    """The features of one text, in the order of ``FEATURES``."""
    text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    text = _GAPS.sub("  ", text)
    told = listed = linked = stuffed = ended = anchored = 0
    entries: list[str] = []
    units = 0
    holding: Counter = Counter()  # units that hold a word
    toks: list[str] = []
    hosts: Counter = Counter()
    lines = [_QUOTE_PREFIX.sub("", line) for line in text.split("\n")]
    bare = bare_lines(lines)
    for i, line in enumerate(lines):
        targets = [m.group() for m in _URL.finditer(line)]
        if targets:
            linked += extent(line) or 1
            rest = _URL.sub(" ", line)
            anchored += extent(rest)
            toks += tokens(rest)
            hosts.update(_HOST.sub("", t.lower()).split("/")[0] for t in targets)
            units += 1
            continue
        for m in _SENTENCE.finditer(line):
            unit = m.group().strip()
            long = extent(unit)
            if not long:
                continue
            units += 1
            found = tokens(unit)
            toks += found
            holding.update({t for t in found if len(t) > 1})
            terminated = bool(_TERMINAL.search(unit))
            parts = [e for e in _SEPARATOR.split(unit) if e and _WORD.search(e)]
            share = 1.0 if i in bare else listed_share(found, parts, terminated)
            if share:
                listed += share * long
                told += (1 - share) * long
                entries += parts
            elif is_stuffed(unit, found):
                stuffed += long
            elif not terminated and m.start() == 0 and words_in(unit) <= ENTRY_TOKENS:
                listed += long
                entries.append(unit)
            else:
                told += long
                ended += long * terminated
    whole = told + listed + linked + stuffed or 1
    seen = Counter(toks)
    for word in STOPWORDS & seen.keys():
        del seen[word]
    count = sum(seen.values()) or 1
    links = sum(hosts.values())
    return (
        listed / whole,
        linked / whole,
        stuffed / whole,
        ended / whole,
        len(seen) / count,
        sum(c for _, c in seen.most_common(3)) / count,
        sum(c for c in seen.values() if c >= 3) / count,
        taken_up(entries),
        math.log1p(len(entries)),
        sum(map(words_in, entries)) / max(1, len(entries)),
        math.log1p(units),
        max((n for t, n in holding.items() if t not in STOPWORDS), default=0) / units if units > 2 else 0.0,
        len(_DIGIT.findall(text)) / (len(text) or 1),
        sum(len(_SEPARATOR.findall(line)) for line in lines) / (len(text) or 1),
        sum(1 for line in lines if _WORD.search(line) and not _ENDS.search(line)) / len(lines),
        len(_HAN.findall(text)) / (len(text) or 1),
        math.log1p(links),
        len(hosts) / max(1, links),
        anchored / whole,
        max(hosts.values(), default=0) / max(1, links),
    )


def taken_up(entries: list[str]) -> float:
    """The share of entries whose first or last word other entries begin or end with too."""
    if len(entries) < 2:
        return 0.0
    sides = []
    for e in entries:
        found = tokens(e)
        sides.append((found[0], found[-1]) if found else ("", ""))
    first, last = Counter(a for a, _ in sides), Counter(b for _, b in sides)
    return sum(first[a] > 1 or last[b] > 1 for a, b in sides) / len(entries)


class BaggedTrees:
    """Decision trees (Gini), each grown on a bootstrap sample and splitting on the best of a few features drawn for each node; the vote is the mean of their leaves."""

    def __init__(self, trees: int = 25, depth: int = 7, least: int = 4, seed: int = 7):
        self.count, self.depth, self.least, self.seed = trees, depth, least, seed
        self.trees: list = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BaggedTrees:
        rng = np.random.default_rng(self.seed)
        self.trees = [self._grow(x[pick], y[pick], self.depth, rng) for pick in (rng.integers(0, len(y), len(y)) for _ in range(self.count))]
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator):
        rate = float(y.mean())
        if depth == 0 or len(y) < 2 * self.least or rate in (0.0, 1.0):
            return rate
        best = (1e-9, None, None)
        whole = rate * (1 - rate)
        few = math.ceil(math.sqrt(x.shape[1]))
        drawn = rng.permutation(x.shape[1])
        for k, f in enumerate(drawn.tolist()):
            if k >= few and best[1] is not None:
                break
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            left = np.arange(1, len(y))
            right = len(y) - left
            a, b = ones[:-1] / left, (ones[-1] - ones[:-1]) / right
            gain = whole - (left * a * (1 - a) + right * b * (1 - b)) / len(y)
            gain[(v[1:] <= v[:-1]) | (left < self.least) | (right < self.least)] = -1
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), f, float((v[at] + v[at + 1]) / 2))
        if best[1] is None:
            return rate
        low = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[low], y[low], depth - 1, rng), self._grow(x[~low], y[~low], depth - 1, rng)

    def vote(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees:
            self._walk(tree, x, np.arange(len(x)), out)
        return out / max(1, len(self.trees))

    def _walk(self, node, x: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
        if not isinstance(node, tuple):
            out[rows] += node
            return
        feature, at, left, right = node
        low = x[rows, feature] <= at
        self._walk(left, x, rows[low], out)
        self._walk(right, x, rows[~low], out)


def _rules() -> tuple[tuple[int, object], ...]:
    at = {name: i for i, name in enumerate(FEATURES)}
    f = lambda name: lambda x: x[:, at[name]]
    listed, linked, stuffed, sentences, distinct, recurring, taken, entries, units, everywhere, links = (
        f(n) for n in ("listed", "linked", "stuffed", "sentences", "distinct", "recurring", "taken_up", "entries", "units", "everywhere", "links")
    )
    many, few = math.log1p(5), math.log1p(3)
    return (
        # many links, and hardly a sentence beside them
        (1, lambda x: (links(x) >= few) & (linked(x) > 0.6) & (sentences(x) < 0.35)),
        # a list without sentences: many entries that take up each other's words
        (1, lambda x: (entries(x) >= many) & (listed(x) > 0.6) & (sentences(x) < 0.35)),
        # entries of one keyword, however long
        (1, lambda x: (taken(x) >= 0.6) & (entries(x) >= many) & (sentences(x) < 0.35)),
        # sentences about one keyword over and over
        (1, lambda x: (recurring(x) > 0.5) & (distinct(x) < 0.5) & (stuffed(x) > 0.4)),
        # one keyword in nearly every unit, several times in some
        (1, lambda x: (everywhere(x) >= 0.8) & (distinct(x) < 0.5) & (stuffed(x) > 0.25)),
        # sentences that end, without links, whatever they say
        (0, lambda x: (sentences(x) >= 0.6) & (linked(x) < 0.3)),
        # told for the most part, if not in lines that end, and nothing over and over
        (0, lambda x: (listed(x) + linked(x) + stuffed(x) < 0.4) & (taken(x) < 0.7) & (distinct(x) > 0.6) & (links(x) == 0)),
        # one or two units that say something once: a remark, or a fragment
        (0, lambda x: (units(x) <= math.log1p(2)) & (entries(x) <= math.log1p(2)) & (links(x) == 0) & (distinct(x) > 0.6)),
        # different words throughout and no list
        (0, lambda x: (distinct(x) > 0.85) & (listed(x) < 0.5) & (entries(x) <= math.log1p(12)) & (links(x) == 0)),
    )


#: Weak labelling: (label, which rows the rule speaks of).
RULES = _rules()


def weak_labels(x: np.ndarray) -> np.ndarray:
    """1 and 0 where rules for one label speak and none for the other, -1 elsewhere."""
    said = {label: np.zeros(len(x), dtype=bool) for label in (0, 1)}
    for label, rule in RULES:
        said[label] |= rule(x)
    return np.where(said[1] & ~said[0], 1, np.where(said[0] & ~said[1], 0, -1))


#: Stand in for a kind of text of which a table has no example.
CLEAR = ("Nobody came that evening. The lamps were lit one after another, and the keeper closed the gate!", "lamp sale | lamp cheap | lamp new | lamp best | kite sale | kite cheap | kite new | kite best")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = 8000) -> BaggedTrees:
    """Fit on at most ``train_rows`` texts, chosen by the hash of their id."""
    from lacquer.llm.sampling import bounded_texts

    texts = bounded_texts(docs, id_col, text_col, train_rows, "spam", F.col(text_col).rlike(r"(?U)[\w\p{P}\p{S}]"))
    x = np.array([page_features(t) for t in texts]).reshape(-1, len(FEATURES))
    y = weak_labels(x)
    x, y = x[y >= 0], y[y >= 0]
    if not len(y) or y.min() == y.max():  # no example of one kind: two clear ones stand for it
        clear = np.array([page_features(t) for t in CLEAR * 10])
        x, y = np.vstack([x, clear]), np.concatenate([y, np.tile([0, 1], 10)])
    return BaggedTrees().fit(x, y)


def score_pages(docs: DataFrame, model: BaggedTrees, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``(doc_id, host, vote)`` for every text that is not blank."""
    from lacquer.session import spread

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([page_features(t) for t in batch.column(2).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.vote(x))], ["doc_id", "host", "vote"])

    rows = docs.where(F.col(text_col).rlike(r"(?U)[\w\p{P}\p{S}]")).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    return spread(rows).mapInArrow(score, "doc_id bigint, host string, vote double")


def find_spam(docs: DataFrame, threshold: float = 0.5, host_weight: float = 0.15, prior_pages: float = 20.0, train_rows: int = 8000) -> DataFrame:
    """Rows ``(doc_id, vote, host_rate, score)`` of the texts made for engines.

    ``score`` moves the vote's log-odds by ``host_weight`` times how far the host's rate (with
    ``prior_pages`` pages at the corpus rate added) lies from the corpus rate.  Null, empty and
    blank texts are never found; texts without a host form one host; repeated rows are found
    as often as they occur; other columns are ignored.
    """
    from lacquer.session import materialise

    votes = materialise(score_pages(docs, train(docs, train_rows=train_rows)), "spam-votes")
    overall = votes.agg(F.coalesce(F.avg((F.col("vote") > 0.5).cast("double")), F.lit(0.0)).alias("overall"))
    hosts = votes.groupBy("host").agg(F.sum((F.col("vote") > 0.5).cast("double")).alias("bad"), F.count("*").alias("pages"))
    clip = lambda c: F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99))
    odds = lambda c: F.log(clip(c) / (1 - clip(c)))
    rates = hosts.join(F.broadcast(overall)).select(  # one row
        F.col("host").alias("of"), "overall", ((F.col("bad") + prior_pages * F.col("overall")) / (F.col("pages") + prior_pages)).alias("host_rate")
    )
    return (
        votes.join(rates, votes.host.eqNullSafe(rates["of"]))
        .withColumn("z", odds(F.col("vote")) + host_weight * (odds(F.col("host_rate")) - odds(F.col("overall"))))
        .withColumn("score", 1 / (1 + F.exp(-F.col("z"))))
        .where(F.col("score") > threshold)
        .select("doc_id", "vote", "host_rate", "score")
    )


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return find_spam(table(spark, sf_dir, "documents")).select("doc_id")


__all__ = ["FEATURES", "BaggedTrees", "find_spam", "p8_found", "page_features", "score_pages", "train", "weak_labels"]
