"""Encoding a corpus with a public byte-level BPE vocabulary through a shared prefix trie.

Greedy pair merging has one property that makes sharing possible: the encoding of a prefix
is determined by its *last token* and the encoding of what precedes that token.  A trie over
the distinct words of a batch therefore needs one state per node - the last token of the
encoding of the node's path - and every word is read off by following these states backwards.
Prefixes that many words share are encoded once.

The state of a new node is found among the vocabulary entries that are suffixes of its path:
exactly one of them is *compatible* with the state of the node where it begins, i.e. merging
would not join or reopen anything across the border (checked by undoing merges on both sides
in order of rank).

Each task keeps its own trie, so the corpus is read once and never shuffled; the trie is
started anew when it has grown past ``max_nodes`` (a memory bound, no row is left out).
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the splitting pattern of the byte_bpe vocabularies.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

IDS_SCHEMA = "doc_id bigint, ids array<int>"


def default_vocabulary() -> str:
    """Path of byte_bpe_50k: ``LACQUER_VOCABULARY`` or the installed public tokenizers."""
    if path := os.environ.get("LACQUER_VOCABULARY"):
        return path
    spec = importlib.util.find_spec("public_tokenizers")
    base = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(base, "byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def split_table(ranks: dict[bytes, int]) -> list[tuple[int, int]]:
    """For each token the two tokens its last merge joined; single bytes stand for themselves."""
    table: list[tuple[int, int]] = [(0, 0)] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        if len(token) == 1:
            table[rank] = (rank, rank)
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            table[rank] = (ranks[parts[0]], ranks[parts[1]])
        else:  # not reachable by merges: never chosen
            table[rank] = (-1, -1)
    return table


class TrieEncoder:
    """Words to ids; encodings of shared prefixes are computed once."""

    def __init__(self, ranks: dict[bytes, int], splits: list[tuple[int, int]], max_nodes: int = 400_000):
        self.ranks, self.splits, self.max_nodes = ranks, splits, max_nodes
        self.length = [0] * len(splits)
        self.joined: dict[tuple[int, int], int] = {}
        self.compatible: dict[int, bool] = {}
        self.suffixes: dict[int, int] = {}  # trie of reversed tokens: (node << 8 | byte) -> node
        self.suffix_token: list[int] = [-1]
        for token, rank in ranks.items():
            self.length[rank] = len(token)
            left, right = splits[rank]
            if left < 0:
                continue
            if len(token) > 1:
                self.joined[left, right] = rank
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                nxt = self.suffixes.get(key)
                if nxt is None:
                    nxt = self.suffixes[key] = len(self.suffix_token)
                    self.suffix_token.append(-1)
                node = nxt
            self.suffix_token[node] = rank
        self.reset()

    def reset(self) -> None:
        self.compatible.clear()  # what is remembered of pairs is bounded like the trie
        self.edges: dict[int, int] = {}
        self.last: list[int] = [-1]
        self.start: list[int] = [0]
        self.words: dict[str, list[int]] = {}

    def fits(self, first: int, second: int) -> bool:
        """Whether merging leaves ``first`` and ``second`` side by side."""
        key = first << 20 | second
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self._fits(first, second)
        return known

    def _fits(self, a: int, b: int) -> bool:
        splits, joined = self.splits, self.joined
        newest = 1 << 40  # merges from this rank on had not happened yet
        while True:
            if joined.get((a, b), newest) < newest:
                return False
            left_of_b, right_of_a = splits[b][0], splits[a][1]
            undo_a = a > b
            if undo_a and right_of_a == a:
                undo_a = False
            elif not undo_a and left_of_b == b:
                undo_a = True
            if undo_a:
                if right_of_a == a:
                    return True
                newest, a = a, right_of_a
            else:
                if left_of_b == b:
                    return True
                newest, b = b + 1, left_of_b

    def insert(self, word: bytes) -> int:
        """The node of ``word``; new nodes get their state on the way down."""
        edges, last, start = self.edges, self.last, self.start
        suffixes, suffix_token, length = self.suffixes, self.suffix_token, self.length
        node, path = 0, [0]
        for depth, byte in enumerate(word):
            key = node << 8 | byte
            nxt = edges.get(key)
            if nxt is None:
                state = begin = -1
                back, at = 0, depth
                while at >= 0:
                    back = suffixes.get(back << 8 | word[at], 0)
                    if not back:
                        break
                    token = suffix_token[back]
                    if token >= 0:
                        before = path[at]
                        if before == 0 or self.fits(last[before], token):
                            state, begin = token, before
                            if before:
                                break
                    at -= 1
                nxt = edges[key] = len(last)
                last.append(state)
                start.append(begin)
            node = nxt
            path.append(node)
        return node

    def read(self, node: int) -> list[int]:
        out, last, start = [], self.last, self.start
        while node:
            out.append(last[node])
            node = start[node]
        out.reverse()
        return out

    def add(self, words: set[str]) -> None:
        """Encode the words not seen before, in order, so that neighbours share their path."""
        words_of = self.words
        new = sorted(w.encode("utf-8", "surrogatepass") for w in words if w not in words_of)
        if len(self.last) > self.max_nodes:
            self.reset()
            words_of = self.words
            new = sorted(w.encode("utf-8", "surrogatepass") for w in words)
        for word in new:
            words_of[word.decode("utf-8", "surrogatepass")] = self.read(self.insert(word))


def encode_corpus(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", max_nodes: int = 400_000) -> DataFrame:
    """One row ``(doc_id, ids)`` per row of ``docs``; an empty and a null text give an empty list.

    Repeated rows give repeated results, an empty table gives none, further columns (also one
    called ``ids``) are ignored.  Strings that look like special tokens are ordinary text.
    """
    spark = docs.sparkSession
    ranks = read_ranks(vocabulary or default_vocabulary())
    shared = spark.sparkContext.broadcast((ranks, split_table(ranks)))  # bounded by the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        encoder = TrieEncoder(*shared.value, max_nodes=max_nodes)
        find = regex.compile(WORD_PATTERN).findall
        step = 512
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                split = [find(t) if t else [] for t in part.column(1).to_pylist()]
                encoder.add({w for ws in split for w in ws})
                words = encoder.words
                offsets, flat = [0], []
                for ws in split:
                    for w in ws:
                        flat.extend(words[w])
                    offsets.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), ids], ["doc_id", "ids"])

    from lacquer.session import spread

    return spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(encode, IDS_SCHEMA)


def decode(ids: list[int], by_rank: dict[int, bytes]) -> str:
    """The text of a list of ids."""
    return b"".join(by_rank[i] for i in ids).decode("utf-8", "surrogatepass")


def decode_corpus(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``: the exact way back."""
    by_rank = {rank: token for token, rank in read_ranks(vocabulary or default_vocabulary()).items()}
    shared = encoded.sparkSession.sparkContext.broadcast(by_rank)  # bounded by the vocabulary

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decode(ids, known) for ids in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id bigint, text string")


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ids of each document say when they are read back."""
    back = decode_corpus(p6_ids(spark, sf_dir))
    return back.select("doc_id", F.length("text").alias("chars"), F.sha1(F.col("text").cast("binary")).alias("digest"))


#: DuckDB statement of the texts themselves.
P6_ROUND_TRIP_SQL = "select doc_id, length(coalesce(text, ''))::int as chars, sha1(coalesce(text, '')) as digest from documents"


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return encode_corpus(table(spark, sf_dir, "documents"))


__all__ = ["TrieEncoder", "decode", "default_vocabulary", "encode_corpus", "p6_ids", "read_ranks", "split_table"]
