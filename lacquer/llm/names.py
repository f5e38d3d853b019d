"""Linking variant spellings of names typed by people.

Every surface form of an entry becomes keys in three spaces: its characters (simplified, without
separators, in any order), the words of its reading (Vietnamese readings are learned from the
table itself, Mandarin ones come from the platform's transliterator), and its joined letters.
All keys go through one trie join.  A key of several words goes into a shard for each of its
words, made of the book and the other words as a set, so that every order of them meets there;
other keys are shards by themselves.  The words of a shard form a trie whose leaves know the ids
that have them: ids at one leaf are linked, and Levenshtein automata with transpositions walk the
trie for leaves within a bounded distance.  Short forms (given names, nicknames, initials, names
without their type) link only where one entity of the book answers to them.  Connected components
of the links are the entities.

Nothing is grouped by book.  Ids with one key are linked to the smallest of them before anything is
shuffled, and only that one goes on, so a spelling that a third of all rows have costs a row per
task; within a shard only the distinct words are held; components are found by rounds of joins.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Forms of address, which name nobody by themselves.
ADDRESS_ZH = "大人 公子 姑娘 小姐 夫人 师父 师傅 师兄 师姐 师弟 师妹 前辈 掌门 长老 宗主 门主 帮主 道长 大侠 少侠 少爷 老爷 先生 陛下 殿下 将军 城主 盟主 大师 仙子 老祖 真人 兄 姐姐 哥哥".split()
ADDRESS_VI = (
    "su huynh|su ty|su ti|su de|su muoi|su phu|su ton|tien boi|tien sinh|dai nhan|cong tu|co nuong|tieu thu|phu nhan|chuong mon|truong lao|tong chu|mon chu|"
    "bang chu|dao truong|dai hiep|thieu hiep|thieu gia|lao gia|be ha|dien ha|tuong quan|thanh chu|minh chu|dai su|tien tu|chan nhan|lord|lady|master|miss|mister|sir"
).split("|")
#: Kinds of places, factions and things: the sign, its longer forms, its reading and its English word.
TYPES = {
    "门": ("门派 山门", "mon", "gate"), "派": ("剑派 学派", "phai", "sect"), "帮": ("帮会", "bang", "gang"), "宗": ("宗门", "tong", "school clan"),
    "阁": ("楼阁", "cac", "pavilion"), "书院": ("", "thu vien", "academy"), "商会": ("商行", "thuong hoi", "guild"), "山": ("山脉 大山", "son", "mountain mount"),
    "谷": ("山谷 幽谷", "coc", "valley"), "湖": ("湖泊 大湖", "ho", "lake"), "城": ("城池 古城 大城", "thanh", "city"), "镇": ("古镇 小镇", "tran", "town"),
    "岛": ("海岛 岛屿 孤岛", "dao", "island"), "关": ("关隘 雄关 关口", "quan", "pass"), "剑": ("宝剑 长剑 古剑", "kiem", "sword"), "丹": ("丹药 灵丹 仙丹", "dan", "pill"),
    "鼎": ("宝鼎 古鼎 大鼎", "dinh", "cauldron"), "琴": ("古琴 宝琴 瑶琴", "cam", "zither"), "印": ("宝印 大印 古印", "an", "seal"), "刀": ("宝刀 长刀", "dao", "blade"),
    "塔": ("宝塔 古塔", "thap", "tower"), "峰": ("山峰", "phong", "peak"), "河": ("大河", "ha", "river"), "宫": ("宫殿", "cung", "palace"), "寺": ("寺庙 古寺", "tu", "temple"),
    "村": ("村庄 山村", "thon", "village"), "洞": ("洞府 山洞", "dong", "cave"), "堂": ("", "duong", "hall"),
}
NICK_VI, NICK_ZH, NICK_END = frozenset(("tieu", "a", "lao", "nho")), frozenset("小阿老"), "儿"
KINDS = frozenset(("character", "place", "faction", "item"))

_HAN = re.compile("[㐀-鿿豈-﫿]")
_NOT_HAN = re.compile("[^㐀-鿿豈-﫿A-Za-z]")
_DOTS = re.compile("[·・•‧∙.\\-‐-―\\s　_,，]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_MARKS = re.compile("[\u0300-\u036f]")
_ADDRESSES = frozenset(ADDRESS_VI)
_BY_READING = {vi: zh for zh, (_, vi, _e) in TYPES.items()}
_BY_WORD = {w: zh for zh, (_, _v, e) in TYPES.items() for w in e.split()}
_LONG_TYPES = sorted(((long, zh) for zh, (longs, _, _e) in TYPES.items() for long in longs.split()), key=lambda x: -len(x[0]))


def plain(text: str) -> str:
    """Lower case without diacritics."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text))
    bare = _MARKS.sub("", text)
    if not bare.isascii():
        bare = "".join(c for c in bare if unicodedata.category(c) != "Mn").replace("đ", "d").replace("Đ", "D")
    return bare.lower()


def latin_words(surface: str) -> list[str]:
    """Words of a Latin surface; joined capitals and separators part words, a hyphen joins syllables where blanks part words."""
    text = unicodedata.normalize("NFKC", surface).strip()
    if "-" in text and " " in text:
        text = text.replace("-", "")
    if not (text.istitle() or text.islower() or text.isupper()):  # else no capital follows a small letter
        spaced = [text[:1]]
        for a, b in zip(text, text[1:], strict=False):
            if a.islower() and b.isupper():
                spaced.append(" ")
            spaced.append(b)
        text = "".join(spaced)
    return _LETTERS.findall(plain(text.replace("_", " ")))


_VOWEL = "aeiouy"
_TELEX = (("aa", "a"), ("ee", "e"), ("oo", "o"), ("dd", "d"), ("aw", "a"), ("ow", "o"), ("uw", "u"))


_TONED = re.compile(rf"^([^{_VOWEL}]*[{_VOWEL}w]+)([sfrxj]?)([^{_VOWEL}]*?)([sfrxj]?)$")


@lru_cache(maxsize=100_000)
def telex(word: str) -> str:
    """The word without the marks of keyboard input for Vietnamese."""
    out = word
    for a, b in _TELEX:
        out = out.replace(a, b)
    m = _TONED.match(out)
    if m:
        out = m.group(1) + m.group(3)
    return out.replace("w", "")


def strip_address(words: list[str]) -> tuple[list[str], bool]:
    """Without forms of address at either end, and whether there was one."""
    found = False
    for n in (2, 1):
        while len(words) > n and " ".join(words[-n:]) in _ADDRESSES:
            words, found = words[:-n], True
        while len(words) > n and " ".join(words[:n]) in _ADDRESSES and n == 2:
            words, found = words[n:], True
    if " ".join(words) in _ADDRESSES:
        return [], True
    return words, found


def latin_types(words: list[str]) -> list[tuple[list[str], str]]:
    """(core, type sign) of a name of a place, faction or thing, for a type at either end."""
    out = []
    for n in (2, 1):
        if len(words) > n:
            for part, rest in ((words[-n:], words[:-n]), (words[:n], words[n:])):
                key = " ".join(part)
                sign = _BY_READING.get(key) or (_BY_WORD.get(key) if n == 1 else None)
                if sign:
                    out.append((rest, sign))
    return out


def han_type(name: str) -> tuple[str, str]:
    """Core and type sign; longer forms of a type count as the short one."""
    for long, sign in _LONG_TYPES:
        if name.endswith(long) and len(name) - len(long) >= 2:
            return name[: -len(long)], sign
    for n in (2, 1):
        if name[-n:] in TYPES and len(name) - n >= 2:
            return name[:-n], name[-n:]
    return name, ""


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, or ``most + 1`` beyond ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


class Trie:
    """Words of a shard; ``near`` walks it together with the Levenshtein automaton of a word."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str, most: int) -> list[str]:
        found: list[str] = []
        start = tuple(range(len(word) + 1))
        stack = [(self.root, start, None, "")]
        while stack:
            node, row, before, last = stack.pop()
            for c, child in node.items():
                if c == "":
                    if row[-1] <= most:
                        found.append(child)
                    continue
                new = [row[0] + 1]
                for j, y in enumerate(word, 1):
                    d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != y))
                    if before is not None and j > 1 and c == word[j - 2] and last == y:
                        d = min(d, before[j - 2] + 1)
                    new.append(d)
                if min(new) <= most:
                    stack.append((child, tuple(new), row, c))
        return found


class Readings:
    """What characters sound like: Vietnamese words, pieces of transcribed names, Mandarin syllables."""

    def __init__(self, vietnamese: dict[str, str], pieces: dict[str, str], mandarin: dict[str, str], simple: dict[str, str], legit: set[str], foreign: set[str]):
        self.tables = (vietnamese, pieces, mandarin, simple, legit, foreign)
        self.vietnamese, self.pieces, self.mandarin, self.simple = vietnamese, pieces, mandarin, str.maketrans(simple)
        self.legit, self.foreign = legit, foreign

    def keys(self, book: int, entry: str, kind: str | None, han_names: list[str], latin_names: list[str]) -> set[tuple[str, str]]:
        """(role, key) of an entry: F full names, O short forms it answers to, A short forms it goes by, V words for the trie join."""
        out: set[tuple[str, str]] = set()
        for s in (*han_names, *latin_names):
            if not s or not s.strip():
                continue
            if _HAN.search(s):
                self._han(s, kind, out)
            else:
                self._latin(s, kind, out)
        slug = re.sub(r"^b\d+_", "", entry or "")
        slug = re.sub(r"-\d+$", "", slug)
        if slug and not slug.startswith("zh_") and slug != "unknown":
            self._latin(re.sub(r"[-_]+", " ", slug), kind, out)
        return out

    def _native(self, words: list[str]) -> bool:
        return all(w in self.legit for w in words)

    def _full_words(self, words: list[str], typed: list[tuple[list[str], str]], kind: str | None, out: set) -> None:
        """Keys of a full name given by its words in order."""
        joined = "".join(words)
        out.add(("F", "v:" + " ".join(sorted(words))))
        out.add(("V", "v:" + " ".join(sorted(words))))
        if len(joined) >= 7:
            out.add(("F", "w:" + joined))
        thing = bool(typed) and kind != "character"
        if thing:
            out.update(("O", "core:" + " ".join(core)) for core, _ in typed)
        if len(words) >= 3:
            out.add(("O", "short:" + "".join(w[0] for w in words)))
        for i, w in enumerate(words):
            if len(w) > 1:
                out.add(("O", "init:" + " ".join([*words[:i], w[0], *words[i + 1 :]])))
        if not thing and kind in ("character", None, "other"):
            if len(words) >= 3:
                out.add(("O", "given:" + " ".join(words[-2:])))
                out.add(("O", "nick:" + words[-1]))
            elif len(words) == 2:
                out.add(("O", "part:" + words[0]))
                out.add(("O", "part:" + words[1]))

    def _latin(self, surface: str, kind: str | None, out: set) -> None:
        words, addressed = strip_address(latin_words(surface))
        if not words:
            return
        letters = _LETTERS.findall(unicodedata.normalize("NFKC", surface))
        if all(len(w) == 1 for w in letters) and len(letters) > 1 or (len(letters) == 1 and letters[0].isupper() and 2 < len(letters[0]) <= 6 and letters[0].isascii() and not addressed):
            out.add(("A", "short:" + "".join(letters).lower()))
            return
        forms = {tuple(words)}
        if surface.isascii():  # who types marks by keys types no diacritics
            forms.add(tuple(d if (d := telex(w)) in self.legit else w for w in words))
        for form in forms:
            self._latin_words(list(form), kind, addressed, out)

    def _latin_words(self, words: list[str], kind: str | None, addressed: bool, out: set) -> None:
        if any(len(w) == 1 for w in words) and len(words) > 1 and not (words[0] in NICK_VI and len(words) == 2) and not self._native(words):
            for turn in {tuple(words), (*words[1:], words[0]), (words[-1], *words[:-1])}:
                out.add(("A", "init:" + " ".join(turn)))
            if len(words) > 2:
                out.add(("V", "v:" + " ".join(sorted(words))))
            return
        typed = latin_types(words)
        if len(words) == 1:
            if len(words[0]) >= 7:
                out.add(("F", "w:" + words[0]))
            if kind in ("character", None, "other"):
                out.add(("A", "part:" + words[0]))
            return
        if len(words) == 2 and words[0] in NICK_VI and kind in ("character", None, "other"):
            out.add(("A", "nick:" + words[1]))
            if words[0] not in self.legit:
                return
        # a Mandarin spelling: letters of the core, and the type
        if kind != "character" and typed:
            out.update(("F", f"p:{''.join(core)}|{sign}") for core, sign in typed)
        else:
            for turn in {tuple(words), (*words[1:], words[0]), (words[-1], *words[:-1])}:
                out.add(("F", f"p:{''.join(turn)}|"))
        native = self._native(words)
        if addressed and len(words) == 2:
            out.add(("A", "given:" + " ".join(words)))
        elif len(words) >= 3:
            self._full_words(words, typed, kind, out)
        elif native or (kind not in ("character", None, "other")):
            if kind in ("character", None, "other"):
                out.add(("A", "given:" + " ".join(words)))
            if kind != "character":
                out.add(("A", "core:" + " ".join(words)))
        else:
            self._full_words(words, typed, kind, out)
            if kind in ("character", None, "other"):
                out.add(("A", "given:" + " ".join(words)))

    def _han(self, surface: str, kind: str | None, out: set) -> None:
        text = unicodedata.normalize("NFKC", surface).strip("《》〈〉「」『』“”\"' 　").translate(self.simple)
        parts = [p for p in _DOTS.split(text) if p]
        name = "".join(_NOT_HAN.sub("", p) for p in parts)
        for title in ADDRESS_ZH:
            if name == title:
                return
            if name.endswith(title) and len(name) > len(title):
                name, parts = name[: -len(title)], [name[: -len(title)]]
                break
        han = "".join(_HAN.findall(name))
        if not han:
            return
        person = kind in ("character", None, "other")
        if len(han) < len(name):  # a letter stands for a part
            out.add(("A", "hpart:" + han))
            return
        if len(name) == 1:
            return
        foreign = all(c in self.foreign for c in name)
        if len(name) == 2 and person and not foreign:
            if name[0] in NICK_ZH:
                out.add(("A", "hnick:" + name[1]))
                if name[1] in self.vietnamese:
                    out.add(("A", "nick:" + self.vietnamese[name[1]]))
                return
            if name[1] == NICK_END:
                out.add(("A", "hnick:" + name[0]))
                if name[0] in self.vietnamese:
                    out.add(("A", "nick:" + self.vietnamese[name[0]]))
                return
        core, sign = han_type(name) if kind != "character" else (name, "")
        if foreign and person:
            dotted = [p for p in parts if len(p) > 1]
            if len(dotted) < 2 and len(name) <= 3:
                out.add(("A", "hpart:" + name))
                if all(c in self.pieces for c in name):
                    out.add(("A", "part:" + "".join(self.pieces[c] for c in name)))
                return
            out.add(("F", "h:" + "".join(sorted(name))))
            if len(dotted) == 2:
                out.add(("V", "h:" + " ".join(sorted(dotted))))
                out.add(("O", "hpart:" + dotted[0]))
                out.add(("O", "hpart:" + dotted[1]))
                sounds = ["".join(self.mandarin.get(c, "?") for c in p) for p in dotted]
                out.add(("F", "s:" + " ".join(sorted(sounds))))
                out.add(("V", "s:" + " ".join(sorted(sounds))))
                if all(c in self.pieces for c in name):
                    self._full_words(["".join(self.pieces[c] for c in p) for p in dotted], [], kind, out)
            return
        base = core + sign
        words = [self.vietnamese.get(c, "") for c in base]
        if len(base) >= 3:
            out.add(("F", "h:" + "".join(sorted(base))))
            sounds = "".join(self.mandarin.get(c, "?") for c in core)
            if kind != "character" and sign:
                out.add(("F", f"p:{sounds}|{sign}"))
                out.add(("O", "hcore:" + core))
            else:
                out.add(("F", f"p:{''.join(self.mandarin.get(c, '?') for c in base)}|"))
            if person and not sign:
                out.add(("O", "hgiven:" + base[-2:]))
                out.add(("O", "hnick:" + base[-1]))
            if all(words):
                type_words = TYPES[sign][1].split() if sign else []
                core_words = words[: len(core)]
                self._full_words(core_words + type_words, [(core_words, sign)] if sign else [], kind, out)
        else:
            if person:
                out.add(("A", "hgiven:" + base))
                if all(words):
                    out.add(("A", "given:" + " ".join(words)))
            if kind != "character":
                out.add(("A", "hcore:" + base))
                if all(words):
                    out.add(("A", "core:" + " ".join(words)))


def _lists(row_zh, row_vi, alias) -> tuple[list[str], list[str]]:
    alias = alias or {}
    return [x for x in (row_zh or []) + (alias.get("zh") or []) if x], [x for x in (row_vi or []) + (alias.get("vi") or []) if x]


def learn_readings(glossary: DataFrame) -> Readings:
    """Readings from all entries; what comes to the driver is bounded by the characters of the script."""
    spark = glossary.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for zh, vi, alias in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                hans, latins = _lists(zh, vi, alias)
                for h in set(hans):
                    if not _HAN.search(h):
                        continue
                    dotted = [p for p in re.split("[·・•]", h) if p]
                    if len(dotted) == 2 and all(_HAN.fullmatch(c) for p in dotted for c in p):
                        for c in "".join(dotted):
                            seen["foreign", c, ""] += 1
                    elif len(h) in (3, 4) and all(_HAN.fullmatch(c) for c in h):
                        for c in h:
                            seen["native", c, ""] += 1
                    for v in set(latins):
                        words = latin_words(v)
                        if len(dotted) == 1 and len(words) == len(h) and len(h) >= 3:
                            for c, w in zip(h, words, strict=True):
                                if _HAN.fullmatch(c):
                                    seen["word", c, w] += 1
                        elif len(dotted) == 2 and len(words) == 2:
                            for p, w in zip(dotted, words, strict=True):
                                if len(w) % len(p) == 0 and len(w) >= 2 * len(p):
                                    n = len(w) // len(p)
                                    for k, c in enumerate(p):
                                        seen["piece", c, w[k * n : (k + 1) * n]] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())],
            ["what", "char", "word", "n"],
        )

    from lacquer.session import materialise

    counted = glossary.select("names_zh", "names_vi", "aliases").mapInArrow(count, "what string, char string, word string, n bigint").groupBy("what", "char", "word").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "readings")
    # for each character its commonest reading and those at least a third as common: a bounded number for each character
    best = counted.groupBy("what", "char").agg(F.max_by("word", F.struct("n", "word")).alias("word"), F.max("n").alias("n"), F.sum("n").alias("all"))
    frequent = counted.alias("c").join(best.select("what", "char", F.col("n").alias("top")).alias("b"), ["what", "char"]).where("what = 'word' and n >= 5 and n * 3 >= top").select("word").distinct()
    vietnamese, pieces, use = {}, {}, defaultdict(dict)
    for r in best.collect():
        if r.what == "word":
            vietnamese[r.char] = r.word
        elif r.what == "piece":
            pieces[r.char] = r.word
        else:
            use[r.char][r.what] = r.all
    legit = set(vietnamese.values()) | {r.word for r in frequent.collect()} | {w for _, vi, _e in TYPES.values() for w in vi.split()}
    foreign = {c for c, n in use.items() if n.get("foreign", 0) > n.get("native", 0)}
    mandarin, simple = transliterations(spark)
    return Readings(vietnamese, pieces, mandarin, simple, legit, foreign)


def transliterations(spark: SparkSession) -> tuple[dict[str, str], dict[str, str]]:
    """Mandarin syllables and simplified forms of characters, by the text library the platform ships; without it this fails."""
    chars = [chr(c) for c in range(0x4E00, 0xA000)]
    try:
        icu = spark._jvm.com.ibm.icu.text.Transliterator
        sounds = icu.getInstance("Han-Latin; Latin-ASCII").transliterate(" ".join(chars)).split(" ")
        simplified = icu.getInstance("Traditional-Simplified").transliterate("".join(chars))
    except Exception as error:
        raise RuntimeError("no transliterator (com.ibm.icu) on the driver's class path: Mandarin spellings and traditional characters could not be linked") from error
    if len(sounds) != len(chars) or len(simplified) != len(chars):
        raise RuntimeError("the transliterator does not keep one form for each character")
    return dict(zip(chars, sounds, strict=True)), {a: b for a, b in zip(chars, simplified, strict=True) if a != b}


#: Entries of a task's memory of keys and links, after which it is handed on.
KEPT_KEYS = 500_000
_KEYS = "book_id bigint, id string, kind string, key string, word string, role string"


def name_keys(glossary: DataFrame, readings: Readings) -> DataFrame:
    """What the rows say, by ``role``.

    ``E`` an id and its kind; ``O`` a short form (``key``) the id answers to and ``A`` one it goes by;
    ``S`` a ``word`` in the shard ``key`` and the smallest id of the task that has it; ``L`` two ids
    (``id`` and, as ``key``, a smaller one) with one word in one shard.
    """
    shared = glossary.sparkSession.sparkContext.broadcast(readings.tables)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Readings(*shared.value)
        said: set[tuple] = set()
        smallest: dict[tuple, str] = {}

        def out() -> pa.RecordBatch:
            rows = [*said, *((book, entry, None, shard, word, "S") for (book, shard, word), entry in smallest.items())]
            said.clear()
            smallest.clear()
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.string()) for i, c in enumerate(columns)], [f.split()[0] for f in _KEYS.split(", ")])

        for batch in batches:
            for book, entry, kind, zh, vi, alias in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                kind = kind if kind in KINDS else None
                said.add((book, entry, kind, None, None, "E"))
                if book is None:
                    continue
                keys = known.keys(book, entry, kind, *_lists(zh, vi, alias))
                words = {key for role, key in keys if role == "V"}
                for role, key in keys:
                    if role in "OA":
                        said.add((book, entry, None, key, None, role))
                    elif role == "V" or key not in words:
                        for place in shards(key) if role == "V" else ((key, ""),):
                            other = smallest.setdefault((book, *place), entry)
                            if other != entry:
                                low, high = min(other, entry), max(other, entry)
                                smallest[book, *place] = low
                                said.add((book, high, None, low, None, "L"))
            if len(said) + len(smallest) > KEPT_KEYS:
                yield out()
        yield out()

    rows = glossary.where("canonical_id is not null").select(F.col("book_id").cast("bigint").alias("book_id"), "canonical_id", "kind", "names_zh", "names_vi", "aliases")
    return rows.mapInArrow(make, _KEYS)


def shards(key: str) -> list[tuple[str, str]]:
    """(shard, word) for each word of a key of words: the shard is the space and the other words, which come sorted."""
    space, words = key[0], key[2:].split(" ")
    return [(f"{space}~" + " ".join(words[:i] + words[i + 1 :]), w) for i, w in enumerate(words)]


def accept(space: str, count: int, a: str, b: str, known: set[str]) -> bool:
    """Whether two words of a shard may be one, of names with so many words."""
    if space == "h":
        return len(a) == len(b) and len(a) > 1 or abs(len(a) - len(b)) == 1
    if space == "s":
        return min(len(a), len(b)) >= 4
    if min(len(a), len(b)) < 2:
        return False
    if count >= 3:
        return not (a in known and b in known)
    return min(len(a), len(b)) >= 3


def trie_links(shard: str, ids: dict[str, str], known: set[str]) -> list[tuple[str, str]]:
    """Links between the ids of a shard's words that are near each other; ``ids`` has the smallest id of each word."""
    if len(ids) < 2:
        return []
    space, rest = shard[0], shard[2:]
    count = len(rest.split(" ")) + 1
    trie, out = Trie(ids), []
    for w in ids:
        if count >= 3 and space == "v" and w in known:
            continue  # two right words are two names; from a wrong one the way leads here
        most = 1 if space == "h" or len(w) < 6 else 2
        near = [x for x in trie.near(w, most) if x != w and accept(space, count, w, x, known)]
        if count >= 3 and space == "v":
            # a misspelling belongs to the nearest right word, if there is one nearest
            right = [(osa(w, x, most), x) for x in near if x in known]
            if right:
                least = min(right)[0]
                nearest = [x for d, x in right if d == least]
                near = nearest if len(nearest) == 1 else []
        out += [(max(ids[w], ids[x]), min(ids[w], ids[x])) for x in near if ids[w] != ids[x]]
    return out


def trie_join(keys: DataFrame, legit: set[str]) -> DataFrame:
    """``(book_id, a, b)``: links of ids whose keys are equal, or differ by a typing error in one word.

    ``keys`` has the rows ``S`` of ``name_keys``.  Rows come sorted, so that a task holds the distinct
    words of one shard, each with its smallest id.
    """
    shared = keys.sparkSession.sparkContext.broadcast(legit)  # bounded by the syllables of the language

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held: tuple | None = None
        ids: dict[str, str] = {}
        found: set[tuple] = set()

        def flush() -> None:
            if held is not None and held[1][1] == "~":
                found.update((held[0], a, b) for a, b in trie_links(held[1], ids, known))

        def out() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            batch = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], ["book_id", "a", "b"])
            found.clear()
            return batch

        for batch in batches:
            for book, shard, word, entry in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held != (book, shard):
                    flush()
                    held, ids = (book, shard), {}
                first = ids.setdefault(word, entry)
                if first != entry:
                    found.add((book, entry, first))
            if len(found) > KEPT_KEYS:
                yield out()
        flush()
        yield out()

    rows = keys.select("book_id", "key", "word", "id").repartition("book_id", "key").sortWithinPartitions("book_id", "key", "word", "id")
    return rows.mapInArrow(walk, "book_id bigint, a string, b string")


def contracted(edges: DataFrame) -> DataFrame:
    """The links as stars around the smallest id, as far as one task sees them.

    The links of a book come together where they fit a task; those of a book too large for one are
    spread over several (rebalanced), whose stars are then joined by the rounds of ``components``.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[tuple, str] = {}

        def root(book: int, x: str) -> str:
            top = x
            while (up := parent.get((book, top), top)) != top:
                top = up
            while x != top:  # shorten the way
                parent[book, x], x = top, parent[book, x]
            return top

        def out() -> pa.RecordBatch:
            rows = [(book, x, root(book, x)) for book, x in list(parent)]
            parent.clear()
            rows = [r for r in rows if r[1] != r[2]]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], ["book_id", "a", "b"])

        for batch in batches:
            for book, x, y in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x, y = root(book, x), root(book, y)
                low, high = min(x, y), max(x, y)
                parent[book, high] = low
                parent.setdefault((book, low), low)
            if len(parent) > KEPT_KEYS:
                yield out()
        yield out()

    return edges.where("a <> b").select("book_id", "a", "b").hint("rebalance", "book_id").mapInArrow(settle, "book_id bigint, a string, b string")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``(book_id, id, component)`` of the linked ids: the smallest id each is linked to, directly or not.

    Tasks settle what they see; then every round takes the smallest label among the neighbours and
    the label of that label, until nothing changes.  Each is written to the shared folder, so no plan
    grows and lost executors cost one round.
    """
    from lacquer.session import materialise

    stars = materialise(contracted(edges), "stars")
    both = stars.union(stars.select("book_id", F.col("b"), F.col("a")))
    labels = materialise(both.groupBy("book_id", F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    for _ in range(rounds):
        offered = both.join(labels.select("book_id", F.col("id").alias("b"), "component"), ["book_id", "b"]).select("book_id", F.col("a").alias("id"), "component", F.lit(None).cast("string").alias("old"))
        lowest = labels.select("book_id", "id", "component", F.col("component").alias("old")).unionByName(offered).groupBy("book_id", "id").agg(F.min("component").alias("lowest"), F.max("old").alias("old"))
        jump = labels.select("book_id", F.col("id").alias("lowest"), F.col("component").alias("further"))
        new = lowest.join(jump, ["book_id", "lowest"], "left").withColumn("component", F.least("lowest", F.coalesce("further", "lowest")))
        seen = Observation()
        labels = materialise(new.observe(seen, F.sum((F.col("component") < F.col("old")).cast("bigint")).alias("changed")).select("book_id", "id", "component"), "labels")
        if not seen.get["changed"]:
            return labels
    raise RuntimeError("components did not settle")


def link_names(glossary: DataFrame) -> DataFrame:
    """``(book_id, id, component)`` of every id: ids of one entity share a component.

    Null ids are ignored, a null book is no book (its ids stay apart), repeated rows and ids add
    their names to the same id; null and empty name lists, blanks and forms of address add
    nothing; an entry without any name is its own component; further columns are ignored.
    """
    from lacquer.session import materialise

    readings = learn_readings(glossary)
    keys = materialise(name_keys(glossary, readings), "name-keys", ["role"])
    of = lambda role: keys.where(F.col("role") == role)
    nodes = of("E").groupBy("book_id", "id").agg(F.max("kind").alias("kind"))
    strong = of("L").select("book_id", F.col("id").alias("a"), F.col("key").alias("b")).unionByName(trie_join(of("S"), readings.legit))
    labels = nodes.join(components(strong), ["book_id", "id"], "left").withColumn("component", F.coalesce("component", "id"))
    labels = materialise(labels, "strong-labels")

    # short forms: whoever answers to one, if it is one entity - of the asker's kind, where kinds are known
    # Owners and askers meet in one row per short form, so a form that many have costs no pairs.
    kinds = labels.where("book_id is not null").groupBy("book_id", "component").agg(F.collect_set("kind").alias("kinds"))
    labelled = labels.select("book_id", "id", "component").join(kinds, ["book_id", "component"])
    forms = keys.where("role in ('O', 'A')").select("book_id", "id", "key", "role").join(labelled, ["book_id", "id"])
    forms = materialise(forms.select("book_id", "key", "role", F.col("component").alias("own"), "kinds"), "forms")
    # of the owners of a form, the smallest and the largest entity: of all, of those of a kind, of those of no known kind
    ways = {"all": F.lit(True), "none": F.size("kinds") == 0} | {k: F.array_contains("kinds", k) for k in sorted(KINDS)}
    owned = forms.where("role = 'O'").groupBy("book_id", "key").agg(*[f(F.when(c, F.col("own"))).alias(f"{n}_{w}") for w, c in ways.items() for n, f in (("low", F.min), ("high", F.max))])
    met = forms.where("role = 'A'").select("book_id", "key", "own", "kinds").distinct().join(owned, ["book_id", "key"], "left")
    asked = lambda n: [F.when(ways[k], F.col(f"{n}_{k}")) for k in sorted(KINDS)] + [F.when(~ways["none"], F.col(f"{n}_none")), F.when(ways["none"], F.col(f"{n}_all"))]
    answered = materialise(met.select("book_id", "key", "own", F.least(*asked("low")).alias("low"), F.greatest(*asked("high")).alias("high")), "short-forms")
    # of several short forms of one entity those that point to one entity count, if they agree
    single = answered.where("low = high and low <> own").groupBy("book_id", "own").agg(F.min("low").alias("low"), F.max("low").alias("high"))
    weak = single.where("low = high").select("book_id", F.col("own").alias("a"), F.col("low").alias("b"))
    # entries with nothing but the same short form
    lonely = answered.where("low is null and (key like 'h%' or key like 'given%' or key like 'core%')")
    lonely_first = lonely.groupBy("book_id", "key").agg(F.min("own").alias("b"))
    alike = lonely.join(lonely_first, ["book_id", "key"]).where("own <> b").select("book_id", F.col("own").alias("a"), "b")
    joined = components(weak.unionByName(alike)).select("book_id", F.col("id").alias("component"), F.col("component").alias("entity"))
    out = labels.where("book_id is not null").join(joined, ["book_id", "component"], "left").select("book_id", "id", F.coalesce("entity", "component").alias("component"))
    return out.unionByName(labels.where("book_id is null").select("book_id", "id", F.col("id").alias("component")))


def linked_pairs(linked: DataFrame) -> DataFrame:
    """``(id_a, id_b)``, ``id_a < id_b``, of all ids of one entity."""
    a = linked.where("book_id is not null").select("book_id", "component", F.col("id").alias("id_a"))
    b = linked.where("book_id is not null").select("book_id", "component", F.col("id").alias("id_b"))
    return a.join(b, ["book_id", "component"]).where("id_a < id_b").select("id_a", "id_b")


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(book_id, id, entity)``: the entity of every id, one row per id, which grows with the ids and not with their pairs."""
    from lacquer.session import table

    return link_names(table(spark, sf_dir, "glossary")).withColumnRenamed("component", "entity")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lacquer.session import table

    return linked_pairs(link_names(table(spark, sf_dir, "glossary")))


__all__ = ["Readings", "Trie", "components", "latin_words", "learn_readings", "link_names", "linked_pairs", "name_keys", "osa", "p3_entities", "p3_found", "telex", "trie_join", "trie_links"]
