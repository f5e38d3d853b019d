"""Tokenizing, splitting, boilerplate, leakage, spam and truncation: brute force, round trips and edge cases."""

import itertools
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lacquer.llm import boilerplate, leakage, spam, splitting, tokenize, truncation

VOCABULARY = tokenize.default_vocabulary()
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no public vocabulary here")


# encoding


@pytest.fixture(scope="module")
def encoder():
    ranks = tokenize.read_ranks(VOCABULARY)
    return ranks, tokenize.TrieEncoder(ranks, tokenize.split_table(ranks), max_nodes=2000)


@pytest.fixture(scope="module")
def reference(encoder):
    import tiktoken

    return tiktoken.Encoding("reference", pat_str=tokenize.WORD_PATTERN, mergeable_ranks=encoder[0], special_tokens={})


@needs_vocabulary
def test_words_as_the_reference_library(encoder, reference):
    import regex

    find = regex.compile(tokenize.WORD_PATTERN).findall

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(max_size=60), st.text(alphabet="abehtinors '\n\t,.12上官龙冰Ưưộ🇻🇳", max_size=80)))
    def run(text):
        words = find(text)
        encoder[1].add(set(words))
        ids = [i for w in words for i in encoder[1].words[w]]
        assert ids == reference.encode_ordinary(text)
        assert tokenize.decode(ids, {v: k for k, v in encoder[0].items()}) == text

    run()


@needs_vocabulary
def test_encode_corpus(spark, reference):
    texts = ["a b", None, "", "<|endoftext|>", "a b", "x " * 5000, "上官龙冰" * 800]
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tokenize.encode_corpus(rows, max_nodes=100).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert tokenize.encode_corpus(rows.limit(0)).count() == 0


# splitting


def valid(text, pieces, limit):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(b - a <= limit for a, b in pieces)
    assert all(a < c <= b < e for (a, b), (c, e) in itertools.pairwise(pieces))


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="ab。，\n 🇻🇳é́👩‍🚀", min_size=1, max_size=300), st.integers(8, 60), st.integers(0, 12))
def test_pieces_cover_within_the_limit(text, limit, overlap):
    s = splitting.Splitter(text)
    pieces = s.split(limit, overlap)
    valid(text, pieces, limit)
    if s.visible is not None and all(len(g) <= limit // 4 for g in __import__("regex").findall(r"\X", text)):
        assert all(s.visible[b] for _, b in pieces)


@pytest.mark.parametrize(("parts", "share", "overlap"), [(12, 0.4, 0), (14, 0.1, 0), (14, 0.12, 3), (13, 0.3, 6)])
def test_chain_is_the_cheapest(parts, share, overlap):
    """Against all sets of cuts: two pieces as well as more than eight, with overlaps and without."""
    rng = random.Random(parts + overlap)
    most = 0
    for _ in range(12):
        text = "".join(rng.choice(["aaaa", "bbb", "cc"]) + rng.choice(["。", "，", "\n", "。"]) for _ in range(parts))
        s, limit = splitting.Splitter(text), max(9 + overlap, int(len(text) * share))
        pos, penalty = s.candidates(limit)
        begin = s.begin_after(pos, overlap)
        ideal = 0.8 * limit
        found = s._chain(pos, penalty, begin, limit, ideal)
        best = np.inf
        for bits in range(1 << len(pos)):
            cuts = [c for c in range(len(pos)) if bits >> c & 1]
            ends, starts = [*(int(pos[c]) for c in cuts), len(text)], [0, *(int(begin[c]) for c in cuts)]
            sizes = [e - a for a, e in zip(starts, ends, strict=True)]
            if max(sizes) > limit or any(x >= y for x, y in itertools.pairwise(starts)):
                continue
            best = min(best, sum(penalty[c] for c in cuts) + sum(splitting.IMBALANCE * ((x - ideal) / ideal) ** 2 for x in sizes) + len(sizes) * splitting.PIECE_CHARGE)
        assert (found is None and best == np.inf) or abs(found[0] - best) < 1e-9
        most = max(most, len(found[1]) if found else 0)
    assert most > 8 or share > 0.2


def test_all_boundaries_are_candidates():
    text = "".join(f"{'x' * (i % 7 + 1)}. " for i in range(4000))
    assert len(splitting.Splitter(text).candidates(6000)[0]) == 3999


def test_overlap_comes_near():
    text = "".join(f"Sentence number {i} is here. " for i in range(200))
    pieces = splitting.Splitter(text).split(600, 80)
    valid(text, pieces, 600)
    assert all(40 <= b - c <= 120 for (_, b), (c, _) in itertools.pairwise(pieces))
    assert all(text[:b].rstrip().endswith(".") for _, b in pieces)


def test_no_boundary_and_crowds_of_them():
    for text in ("x" * 30_000, "\n" * 30_000, "é́" * 5000, "👩‍🚀" * 4000):
        for limit in (2600, 9500):
            valid(text, splitting.Splitter(text).split(limit, 100), limit)


def test_split_texts(spark):
    caps = spark.createDataFrame([("a", 20, 4, "x"), ("b", 10, None, "x"), ("c", None, 1, "x"), ("d", 0, 1, "x")], "stage string, max_chars int, overlap_chars int, piece_no string")
    rows = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, ""), (4, "short"), (1, "one two three four five six")], "chunk_id bigint, source_chunk string")
    got = splitting.split_texts(rows, caps).collect()
    assert {(r.chunk_id, r.stage) for r in got} == {(1, "a"), (1, "b")} and len([r for r in got if r.piece_no == 0]) == 4
    assert splitting.split_texts(rows.limit(0), caps).count() == 0 and splitting.split_texts(rows, caps.limit(0)).count() == 0


def test_large_overlaps_are_kept():
    rng = random.Random(6)
    text = "".join(rng.choice(["Anh đi. ", "Em ở lại, ", "trời mưa to ", "Xong!\n"]) for _ in range(1500))
    for limit, overlap in ((1000, 400), (1000, 600), (300, 200), (100, 60)):
        pieces = splitting.Splitter(text).split(limit, overlap)
        valid(text, pieces, limit)
        shared = [a[1] - b[0] for a, b in itertools.pairwise(pieces)]
        assert sum(abs(x - overlap) <= 0.2 * overlap for x in shared) > 0.8 * len(shared)


# boilerplate


PAGE = """首页 | 书架 | 排行榜 | 登录
点击：70598　收藏：8745　字数：225988
Chapter 3 - 第三章 雨 | SourceFile: C003-第三章 雨.txt
雨停以后，陆尘云离开了客栈，手里还握着那封旧信。他没有回头，也没有说一句话。
“下一页。”他低声说，把书递给了她。
手机扫码下载xx客户端，离线也能看。
……
她接过书，慢慢翻开，窗外的狗叫了一整夜。天亮之前，她才放下灯，转身看着门口。
上一页 | 返回目录 | 下一页
热门推荐
《雪原里的信件》
更新太慢了，等了8天

版权所有 © 2024 xx 保留一切权利"""


def site_pages(count=24):
    """Pages of the site of ``PAGE``, each with a story of its own, and of a second site without its material."""
    rng = random.Random(7)
    say = lambda: "，".join("".join(rng.choices([chr(c) for c in range(0x5200, 0x5400)], k=rng.randint(5, 9))) for _ in range(3)) + "。" + "".join(rng.choices([chr(c) for c in range(0x5200, 0x5400)], k=9)) + "。"
    head, tail = PAGE.split("\n")[:2], PAGE.split("\n")[8:]
    pages = []
    for i in range(count):
        own = [head[0], f"点击：{rng.randint(1, 99999)}　收藏：{i}　字数：{rng.randint(1, 99999)}", PAGE.split("\n")[2], say(), say(), "手机扫码下载xx客户端，离线也能看。", say(), *tail]
        pages += [("a", "\n".join(own)), ("b", "\n".join(say() for _ in range(6)))]
    return pages


def test_story_of_a_page():
    weights = boilerplate.learn(site_pages())
    lines = PAGE.split("\n")
    story = boilerplate.story_lines(lines, weights)
    assert [i for i, s in enumerate(story) if s] == [2, 3, 4, 6, 7]
    assert not any(boilerplate.story_lines(["登录", "注册"], weights))


def test_what_sites_repeat_is_theirs():
    stories = [f"他走过第{i}座桥，没有回头。她在{chr(0x5200 + i)}边等了一夜。" * (1 + i % 3) for i in range(60)]
    pages = [(f"s{i % 3}", "\n".join([f"欢迎来到第{i}页" if i % 3 == 0 else "灯", story, "【叮！经验 +9】" if i % 5 == 0 else "雨", f"门外又响了{chr(0x5300 + i)}声，他没有动。她也没有说话。", "本页面由书友上传请勿转载内容版权归作者所有谢谢支持" if i % 9 == 0 else "风"])) for i, story in enumerate(stories)]
    repeated = boilerplate.repeated_lines(pages)
    assert boilerplate.wording("欢迎来到第77页") in repeated and boilerplate.wording("本页面由书友上传请勿转载内容版权归作者所有谢谢支持") in repeated
    assert boilerplate.wording("【叮！经验 +9】") not in repeated and not any(boilerplate.wording(s) in repeated for s in stories)
    assert boilerplate.repeated_lines([("s", pages[0][1])] * 50) == set()  # one page, fetched again and again
    assert abs(boilerplate.by_chance(2, 1.0) - (1 - 2 * np.exp(-1))) < 1e-12


def test_region_is_the_heaviest(monkeypatch):
    class Given:
        def __init__(self, scores):
            self.scores = iter(scores)

        def line_scores(self, line):
            s = next(self.scores)
            return s, 1.0

    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(1, 9))]
        story = boilerplate.story_lines(["x"] * len(scores), Given(scores))
        best = max([sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)] + [0])
        assert sum(s for s, keep in zip(scores, story, strict=True) if keep) == best


def test_find_boilerplate(spark):
    rows = spark.createDataFrame([(1, PAGE, 0), (2, None, 0), (3, "", 0), (4, " \n ", 0), (5, "登录\n\n注册", 0), (1, PAGE, 0)], "chunk_id bigint, source_chunk string, line_no int")
    got = boilerplate.find_boilerplate(rows, boilerplate.learn(site_pages())).collect()
    by = {k: sorted(r.line_no for r in got if r.chunk_id == k) for k in (1, 2, 3, 4, 5)}
    assert by[5] == [0, 2] and by[2] == by[3] == by[4] == [] and len(by[1]) == 2 * len(set(by[1])) and 12 not in by[1]
    assert boilerplate.find_boilerplate(rows.limit(0)).count() == 0


# leakage


ITEM = "Viro asked Giang where the white hawk had come from. We must reach the prison within twenty days, said Risoro. Risoro handed the broken bow to Nepe. Giang promised to fetch the cold flask from the post house."


def leak_rows():
    words = ITEM.split()
    changed = [w if i % 9 else "thing" for i, w in enumerate(words)]
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in ITEM)
    return [
        (1, "Before. " + ITEM + " After."), (2, ITEM.upper().replace(".", " \n")), (3, " ".join(words[: len(words) * 2 // 3])), (4, " ".join(words[:8])), (5, " ".join(changed)),
        (6, None), (7, ""), (8, "... !!!"), (9, "Sofa asked Meng where the black cat had come from. We must reach the bridge within nine days, said Tavi."),
        (10, wide), (11, " ".join(words[:14]) + " something else entirely happens here now " + " ".join(words[22:])), (1, "Before. " + ITEM + " After."), (12, "filler words " * 3000 + ITEM),
    ]


def test_find_leaks(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in leak_rows()], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, ""), (10, "two words"), (7, "short"), (None, ITEM)], "item_id bigint, text string")
    got = leakage.find_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (1, 7), (2, 7), (3, 7), (5, 7), (10, 7), (11, 7), (12, 7)]
    assert leakage.find_leaks(docs.limit(0), items).count() == 0 and leakage.find_leaks(docs, items.limit(0)).count() == 0


DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def leaks(spark, docs, items):
    return {(r.doc_id, r.item_id) for r in leakage.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}


@pytest.mark.parametrize("copies", [30, 60, 600, 1000])
def test_frequent_leaks_are_found(spark, copies):
    """However many of a thousand texts hold an item, whole or changed at random, all are found."""
    rng = random.Random(copies)
    vocabulary = [f"w{i}" for i in range(5000)]
    item, short = rng.sample(vocabulary, 40), rng.sample(vocabulary, 5)
    docs, want = [], set()
    for d in range(1000):
        text = rng.choices(vocabulary, k=20)
        if d < copies:
            copy = [w if rng.random() > 0.08 or d % 2 else rng.choice(vocabulary) for w in item]
            text = text[:10] + copy + text[10:] + short
            want |= {(d, 1), (d, 2)}
        docs.append((d, " ".join(text)))
    assert leaks(spark, docs, [(1, " ".join(item)), (2, " ".join(short))]) == want


@pytest.mark.parametrize("size", range(1, 9))
def test_short_items_are_found_whole(spark, size):
    """Against a search for the words: items of one to eight words or characters, the longer ones with one word changed too."""
    rng = random.Random(size)
    word = [f"q{i}" for i in range(400)]
    han = [chr(0x4E00 + i) for i in range(400)]
    for vocabulary, joint in ((word, " "), (han, "")):
        items = [rng.sample(vocabulary, size) for _ in range(3)]
        docs, want = [], set()
        for d in range(60):
            text, i = rng.choices(vocabulary, k=30), d % 4
            if i < 3:
                text = text[: d % 20] + items[i] + text[d % 20 :]
            docs.append((d, joint.join(text)))
            want |= {(d, k) for k, x in enumerate(items) if any(text[j : j + size] == x for j in range(len(text)))}
        assert want <= (got := leaks(spark, docs, [(k, joint.join(x)) for k, x in enumerate(items)]))
        assert size > 3 or got == want


def test_many_items(spark):
    """Fifty thousand items against a comparison of every text with every item that shares a shingle."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=12 + i % 5))) for i in range(50_000)]
    docs = [(d, " ".join([*rng.choices(vocabulary, k=15), *(items[rng.randrange(50_000)][1].split()[: rng.choice((4, 8, 16))]), *rng.choices(vocabulary, k=15)])) for d in range(40)]
    grams = {d: list(zip(s := t.split(), s[1:], s[2:], strict=False)) for d, t in docs}
    sets = {d: set(g) for d, g in grams.items()}
    want = set()
    for key, text in items:
        item = leakage.Item(key, text)
        for d in grams:
            if not sets[d].isdisjoint(item.at):
                hits = [(i, j) for j, g in enumerate(grams[d]) if g in item.at for i in item.at[g]]
                if leakage.covered(item, hits, set(range(item.n))) / item.n >= 0.46:
                    want.add((d, key))
    assert leaks(spark, docs, items) == want and len(want) > 15


def test_hashes_tell_places_and_sizes():
    hashes = leakage.WordHashes()
    ids = hashes.of("a b c a b d".split())
    three, two = leakage.shingle_hashes(ids, 3).tolist(), leakage.shingle_hashes(ids, 2).tolist()
    assert len(three) == 4 and len(set(three)) == 4 and two[0] == two[3] and not set(two) & set(three) and not len(leakage.shingle_hashes(ids[:1], 2))


def test_windows_hold_what_one_run_can_reach():
    item = leakage.Item(1, " ".join(f"w{i}" for i in range(20)))
    hits = [(i, i + 5) for i in range(6)] + [(i, i + 200) for i in range(6, 18)]
    assert [len(w) for w in leakage.item_windows(item, hits)] == [6, 12] and leakage.covered(item, hits, set(range(20))) == 20


def test_prefix_filter_loses_nothing(spark):
    """Against a comparison of every text with every item."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(6)]
    docs = []
    for d in range(120):
        words = rng.choices(vocabulary, k=60)
        i = rng.randrange(6)
        n = rng.choice([0, 8, 15, 24, 30, 40])
        docs.append((d, " ".join(words[:20] + items[i][1].split()[:n] + words[20:])))
    want = set()
    for d, text in docs:
        seq = leakage.words(text)
        for key, t in items:
            item = leakage.Item(key, t)
            grams = list(zip(seq, seq[1:], seq[2:], strict=False))
            hits = [(i, j) for j, g in enumerate(grams) if g in item.at for i in item.at[g]]
            if leakage.covered(item, hits, set(range(item.n))) / item.n >= 0.46:
                want.add((d, key))
    got = {(r.doc_id, r.item_id) for r in leakage.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == want and len(want) > 20


def test_copies_make_no_phrase_of_an_item(spark):
    """An item copied, whole or in half, into a third of the texts, and one quoted in a third, are still found; phrases about others are not."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    fill = lambda n: " ".join(rng.choices(vocabulary, k=n))
    phrase = "then {} went down to the old stone gate and said nothing to {}"
    hot, asked, told = fill(40), fill(40), phrase.format("Nepe", "Giang")
    for size in (90, 900):
        docs, want = [], set()
        for d in range(size):
            kind = d % 30
            if kind < 8:
                text = f"{fill(12)} {hot} {fill(12)}"
                want.add((d, 1))
            elif kind < 10:
                text = f"{fill(12)} {' '.join(hot.split()[:25])}"
                want.add((d, 1))
            elif kind < 20:
                text = f"{' '.join(asked.split()[:17])} {fill(12)}"
            elif kind < 29:
                text = phrase.format(*rng.choices(vocabulary, k=2)) + (f" {fill(9)}" if d % 2 else "")
            else:
                text = f"{fill(3)} {' '.join(asked.split()[:20])} {fill(8)}"
                want.add((d, 2))
            docs.append((d, text))
        items = [(1, hot), (2, asked), (3, f"{told} {fill(6)} {phrase.format('Viro', 'Sofa')}")]
        got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_runs_go_on_past_recurring_phrases():
    """Words are put in every five words, and what stands at each break recurs twenty times elsewhere."""
    sequence = [f"w{i}" for i in range(40)]
    item = leakage.Item(1, " ".join(sequence))
    text = [w for i in range(0, 40, 5) for w in (*sequence[i : i + 5], f"put{i}")]
    for b in range(5, 40, 5):
        for n in range(20):
            text += [*sequence[b - 2 : b + 1], *(f"else{b}-{n}-{k}" for k in range(4 + n % 3))]
    hits = [(i, j) for j, g in enumerate(zip(text, text[1:], text[2:], strict=False)) for i in item.at.get(g, ())]
    assert leakage.covered(item, hits, set(range(item.n))) == 40


# spam


STORY = "After the rain stopped, Lu Chen left the inn with seven attendants. He did not look back, and nobody said a word! The dogs outside barked all night. \"Do not tell her about this,\" he murmured."
SPAM = [
    "kite sale | kite cheap | kite top 10 | kite near me | kite original | kite discount | kite wholesale | kite full set",
    "\n".join(f"lamp {w} http://a{i}.example/p/{i}" for i, w in enumerate("sale cheap best new used original".split())),
    "关于斗篷：斗篷是什么，斗篷怎么选，斗篷推荐。想买斗篷吗？斗篷推荐，斗篷推荐，我们的斗篷最好。" * 3,
    "\n".join(["种子价格", "种子最新", "种子优惠", "种子大全", "种子图片", "种子批发", "种子清仓"]),
    "#key;#lamp;#kite;#tent;#sword;#boat;#mask;#bow",
]
PLAIN = [STORY, STORY + "\n#kite #lamp", STORY + "\nhttps://a.example/n1", "风也吹，雨也吹，他走过石桥，没有回头。\n" * 4, "Present were Situ Jingyun, Song Yunfeng, Wei Xiaorong, Ouyang Yuanxia. " + STORY, "短句。"]


def test_features_part_spam_from_stories():
    made = lambda t: sum(spam.page_features(t)[:3])  # noqa: E731 - listed, linked, stuffed
    assert all(made(t) > 0.5 for t in SPAM) and all(made(t) < 0.45 for t in PLAIN if "短句" not in t)
    link = dict(zip(spam.FEATURES, spam.page_features(SPAM[1]), strict=True))
    assert round(np.expm1(link["links"])) == 6 and link["hosts"] == 1.0 and 0 < link["anchored"] < 0.5 and link["linked"] == 1.0


def test_found_pages_are_no_cut_on_one_feature(spark):
    """What the trees find on the test table differs from every cut on a single feature, above or below."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(path)
    found = {r.doc_id for r in spam.find_spam(docs).collect()}
    rows = [(r.doc_id, spam.page_features(r.text)) for r in docs.select("doc_id", "text").collect() if r.text and r.text.strip()]
    x, y = np.array([f for _, f in rows]), np.array([i in found for i, _ in rows])
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        inside = np.concatenate(([0], np.cumsum(y[order])))
        edges = np.concatenate(([True], np.diff(x[order, f]) > 0, [True]))  # a cut lies between different values
        below = inside + (~y[order]).sum() - (np.arange(len(y) + 1) - inside)  # right rows if all below are found
        assert max(below[edges].max(), (len(y) - below)[edges].max()) < len(y), spam.FEATURES[f]


def test_labels_come_from_rules_that_agree():
    x = np.array([spam.page_features(t) for t in [*SPAM[:4], *PLAIN[:4]]])
    assert spam.weak_labels(x).tolist() == [1, 1, 1, 1, 0, 0, 0, 0]
    assert len({rule for _, rule in spam.RULES}) >= 8 and spam.weak_labels(x[:0]).tolist() == []


def test_trees_learn_held_out():
    rng = np.random.default_rng(0)
    x = rng.random((800, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(int)
    model = spam.BaggedTrees(trees=9).fit(x[:600], y[:600])
    assert ((model.vote(x[600:]) > 0.5) == y[600:]).mean() > 0.95


def test_find_spam(spark):
    texts = [*SPAM, *PLAIN, None, "", " \u3000", "x " * 40_000]
    rows = spark.createDataFrame([(i, t, None if i % 3 else "h", 1.0) for i, t in enumerate(texts)] + [(0, SPAM[0], "h", 1.0)], "doc_id bigint, text string, source string, vote double")
    got = [r.doc_id for r in spam.find_spam(rows).collect()]
    assert set(range(len(SPAM))) <= set(got) and not set(got) & set(range(len(SPAM), len(SPAM) + len(PLAIN) + 3)) and got.count(0) == 2
    assert spam.find_spam(rows.limit(0)).count() == 0


def test_hosts_move_doubtful_votes(spark):
    """The same half-and-half text on a host full of spam and on a clean one."""
    half = "Our kite is here. " + STORY.split("!")[0] + ".\nkite sale | kite cheap | kite best | kite new | kite top | lamp sale | lamp new"
    rows = [(i, SPAM[0], "bad") for i in range(200)] + [(i, STORY, "good") for i in range(1000, 1200)] + [(5000, half, "bad"), (6000, half, "good")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    scores = {r.doc_id: r.score for r in spam.find_spam(table, threshold=0.0).where("doc_id >= 5000").collect()}
    assert scores[5000] > scores[6000]


# truncation


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Anh đi. Em ở lại.", 0), ("Anh đi. Em ở l", 1), ("Anh đi. Em nói: \"Chạy mau", 1), ("Anh đi. \"Chạy mau!\"", 0), ("Xong.\n\n* * *", 0), ("Xong.\n— Hết chương —", 0), ("Xong.\n\nSố câu: 27", 0), ("Xong. ✔", 0),
        ("Anh đi về ph [...]", 1), ("Anh đi bản đ�", 1), ("PASS", 0), ("**PASS**\n", 0), ("FIXED_VI\nAnh đi", 1), ("他说：“别走。", 1), ("他走了。", 0), ("Anh đi…", 0), ("Anh đi\n", 1),
    ],
)
def test_ends_of_texts(text, want):
    assert truncation.read_text(text) == want


def test_ends_of_titles_terms_and_objects():
    file = "C001-甲.txt"
    assert truncation.read_title(f"Chapter 1 - A | SourceFile: {file}", file) == 0
    assert truncation.read_title(f"Chapter 1 - A | SourceFile: {file[:-2]}", file) == 1 == truncation.read_title("Chapter 1 - Vườ", None)
    assert truncation.read_terms("陆尘云 = Lục Trần Vân\n秦 =")[0] == 1 == truncation.read_terms("陆尘云 = Lục Trần Vân\n陆尘")[0] == truncation.read_terms("陆尘云 = Lục")[0]
    assert truncation.read_terms("陆尘云 = Lục Trần V")[0] == truncation.OPEN
    whole = '{"canonical_id": "a", "kind": "k", "names_zh": [], "names_vi": [], "evidences": [{"source_file": "f", "evidence": "他走了。"}]}'
    assert truncation.read_json(whole, "glossary")[0] == 0 == truncation.read_json(f"```json\n{whole}\n```", "glossary")[0]
    assert truncation.read_json(whole + '\n{"canonical_id": "b", "kind": "c"}', "glossary")[0] == 1 == truncation.read_json(whole[:-9] + '"}]}', "glossary")[0] == truncation.read_json(whole + '\n{"cano', "glossary")[0]


def answers(spark):
    rng = random.Random(8)
    rows = [(i, "a" if i % 3 else None, "translate", None, ("Câu này dài. " * rng.randint(20, 60))[: rng.randint(100, 399)].rsplit(".", 1)[0] + ".", 0) for i in range(300)]
    for k in range(40):  # one source cuts at 240
        rows.append((1000 + k, "a", "translate", None, (f"Câu {k} này dài lắm và còn tiếp nữa " * 30)[:240], 0))
    rows += [(2000, "a", "terms", None, "陆尘云 = Lục Trần Vân\n秦坤清 = Tần Khôn Thanh", 0), (2001, "a", "terms", None, "秦坤清 = Tần Khôn Thanh\n陆尘云 = Lục Trần V", 0), (2002, "b", None, None, "x", 0), (2003, "b", "title", None, None, 0), (2004, "b", "title", None, "  　", 0)]
    return spark.createDataFrame(rows + [rows[-5]], "result_id bigint, source string, stage string, source_file string, content string, length int")


def test_find_truncated(spark):
    table = answers(spark)
    got = {r.result_id: r for r in truncation.find_truncated(table).collect()}
    assert all(got[1000 + k].cut and got[1000 + k].at_limit for k in range(40))
    assert got[2001].cut and not got[2000].cut and got[2002].cut and 2003 not in got and 2004 not in got
    assert truncation.find_truncated(table).count() == 300 + 40 + 3 + 1
    limits = truncation.length_limits(truncation.read_answers(table)).collect()
    assert any(r.source == "a" and r.length == 240 for r in limits) and len(limits) <= 3
    shares = {r.source: r for r in truncation.truncation_by_source(table).collect()}
    assert shares["b"].results == 1 and shares["b"].cut_share == 1.0 and None in shares
    assert truncation.find_truncated(table.limit(0)).count() == 0


@pytest.mark.parametrize("behind", ["\n" + "-" * 130, "\n\n" + "* " * 400 + "\n", "\n" + "=" * 150 + " Hết chương " + "=" * 150, "\n" + "-" * 90 + "\n" + "-" * 90, "\n" + "-" * 90 + "\nHết chương\n" + "-" * 90])
def test_rules_and_notes_may_be_long(behind):
    assert truncation.read_text("Anh đi. Em ở lại." + behind) == 0
    assert truncation.read_text("Anh đi. Em ở l" + behind) == 1
    assert truncation.strip_marks("Anh đi." + behind) == "Anh đi."


def test_limits_stand_out_by_hazard_as_far_as_answers_reach(spark):
    """Even lengths that end at 300 have no limit there; with many more at 300, or a little more in a thin end, they have."""

    def found(endings):
        rows = [("a", length, 1000 * length + k, 0) for length, n in endings.items() for k in range(n)]
        return [r.length for r in truncation.length_limits(spark.createDataFrame(rows, "source string, length int, body bigint, state int")).collect()]

    even = dict.fromkeys(range(275, 301), 40)
    assert found(even) == []
    assert found(even | {300: 200}) == [300] == found(dict.fromkeys(range(100, 400), 2) | {300: 40})
    assert found({1: 50}) == [] == found({7: 1})


def test_hostile_texts_take_linear_time():
    import time

    weights = boilerplate.learn(site_pages(5))
    for text in ("a-" * 100_000, " " * 200_000, "x" * 200_000, "\n \n" * 50_000, "。" * 100_000, "“" * 100_000, "a.b" * 60_000, "1 " * 100_000):
        began = time.time()
        spam.page_features(text)
        truncation.read_text("x" + text + "y")
        boilerplate.story_lines(text.split("\n"), weights)
        leakage.words(text)
        assert time.time() - began < 20
