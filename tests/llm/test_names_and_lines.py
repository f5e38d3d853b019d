"""Name linking and sentence alignment: brute force and edge cases."""

import itertools
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lacquer.llm import alignment, names

GLOSSARY = "canonical_id string, book_id bigint, kind string, names_zh array<string>, names_vi array<string>, aliases struct<zh:array<string>,vi:array<string>>, component string"


# names


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=6), min_size=1, max_size=12, unique=True), st.text(alphabet="abc", max_size=6), st.integers(0, 2))
def test_trie_finds_all_neighbours(words, word, most):
    assert sorted(names.Trie(words).near(word, most)) == sorted(w for w in words if names.osa(word, w, most) <= most)


def test_distance_counts_transpositions():
    assert names.osa("phung", "phugn", 2) == 1 and names.osa("abc", "abc", 0) == 0 and names.osa("abc", "xyz", 1) == 2


def test_surfaces():
    assert names.latin_words("TạLãngMinh") == ["ta", "lang", "minh"] == names.latin_words("Tạ_Lãng.Minh")
    assert names.latin_words("Gi-sa-vi Lu-lo") == ["gisavi", "lulo"]
    assert [names.telex(w) for w in ("Suwowng".lower(), "taanf", "khoon", "vux", "thinhs")] == ["suong", "tan", "khon", "vu", "thinh"]
    assert (["kho", "ha"], "阁") in names.latin_types(["cac", "kho", "ha"]) and names.latin_types(["thu", "vien", "thien", "dang"]) == [(["thien", "dang"], "书院")] and names.han_type("伏虎山脉") == ("伏虎", "山") and names.han_type("千灯书院") == ("千灯", "书院")


def test_components_are_union_find(spark):
    rng = random.Random(6)
    ids = [f"n{i:02d}" for i in range(40)]
    edges = [(1, rng.choice(ids), rng.choice(ids)) for _ in range(32)] + [(1, f"n{i:02d}", f"n{i + 1:02d}") for i in range(20, 30)]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.id: r.component for r in names.components(spark.createDataFrame(edges, "book_id bigint, a string, b string")).collect()}
    linked = {x for _, a, b in edges if a != b for x in (a, b)}
    assert got == {i: root(i) for i in linked}


def test_trie_join_is_brute_force(spark):
    """Every pair of keys by definition: equal, or one word apart by a typing error, in any order of the words."""
    rng = random.Random(9)
    legit = {"luc", "tran", "van", "khoi", "minh"}
    words = [*legit, "lucc", "trna", "vna", "kohi", "mihn", "tram", "vanh", "longer", "lomger"]
    keys = sorted({"v:" + " ".join(sorted(rng.sample(words, rng.choice((2, 3))))) for _ in range(90)})
    ids = {k: f"n{i:03d}" for i, k in enumerate(keys)}
    rows = [(1, shard, w, ids[k]) for k in keys for shard, w in names.shards(k)]
    rows += [(1, "p:same|", "", i) for i in ("n005", "n001", "n003")] + [(2, "p:same|", "", "n009")]
    got = {(r.book_id, min(r.a, r.b), max(r.a, r.b)) for r in names.trie_join(spark.createDataFrame(rows, "book_id bigint, key string, word string, id string"), legit).collect()}
    want = {(1, "n001", "n005"), (1, "n001", "n003")}
    for k in keys:
        for shard, w in names.shards(k):
            count = len(shard[2:].split(" ")) + 1
            if count >= 3 and w in legit:
                continue
            near = {}
            for other in keys:
                for there, x in names.shards(other):
                    if there == shard and x != w and names.osa(w, x, 2) <= (1 if len(w) < 6 else 2) and names.accept("v", count, w, x, legit):
                        near[x] = ids[other]
            right = {x: names.osa(w, x, 2) for x in near if x in legit}
            if count >= 3 and right:
                best = [x for x in right if right[x] == min(right.values())]
                near = {best[0]: near[best[0]]} if len(best) == 1 else {}
            want |= {(1, min(ids[k], i), max(ids[k], i)) for i in near.values() if i != ids[k]}
    assert got == want and len(want) > 20


def test_a_name_everybody_has_costs_links_and_no_pairs(spark):
    """A third of all entries have one name: they are one entity, and what goes on is a row per task."""
    rows = [(f"e{i:04d}", 1, "character", ["陆尘云"] if i % 3 == 0 else [f"{chr(0x4E00 + i)}{chr(0x5000 + i)}{chr(0x6000 + i)}"], [], None, "x") for i in range(900)]
    glossary = spark.createDataFrame(rows, GLOSSARY).repartition(4)
    keys = names.name_keys(glossary, names.learn_readings(glossary))
    assert keys.where("role = 'S' and key like 'h:%'").groupBy("key").count().agg({"count": "max"}).first()[0] <= 4
    of = {r.id: r.component for r in names.link_names(glossary).collect()}
    assert {of[f"e{i:04d}"] for i in range(0, 900, 3)} == {"e0000"} and len(set(of.values())) == 601


def test_links_come_through_the_trie_join(spark, monkeypatch):
    """Without the rows of the trie join, and the same links found within a task, hardly a pair is left."""
    path = "/root/testdata/sf0.01/glossary.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    glossary = spark.read.parquet(path)
    whole = names.linked_pairs(names.link_names(glossary)).count()
    monkeypatch.setattr(names, "trie_join", lambda keys, legit: keys.where("false").selectExpr("book_id", "id as a", "key as b"))
    make = names.name_keys
    monkeypatch.setattr(names, "name_keys", lambda g, r: make(g, r).where("role <> 'L'"))
    assert names.linked_pairs(names.link_names(glossary)).count() < 0.3 * whole


def test_no_transliterator_is_an_error():
    class Nothing:
        def __getattr__(self, name):
            if name == "getInstance":
                raise TypeError("'JavaPackage' object is not callable")
            return self

    class Session:
        _jvm = Nothing()

    with pytest.raises(RuntimeError, match="transliterator"):
        names.transliterations(Session())


def entries():
    e = lambda i, zh, vi, kind="character", book=1, alias=None: (i, book, kind, zh, vi, alias, "x")
    full = [("陆尘云", "Lục Trần Vân"), ("秦坤清", "Tần Khôn Thanh"), ("秦坤霜", "Tần Khôn Sương"), ("苏寒竹", "Tô Hàn Trúc"), ("萧轩忠", "Tiêu Hiên Trung"), ("温霞珩", "Ôn Hà Hành")]
    # other books teach the readings
    taught = [e(f"t{b}_{k}", [zh], [vi], book=b) for b in range(50, 56) for k, (zh, vi) in enumerate(full)]
    taught += [e(f"p{b}_{k}", [zh], [vi], "place", b) for b in range(50, 56) for k, (zh, vi) in enumerate([("伏虎山", "Phục Hổ Sơn"), ("枯荷阁", "Khô Hà Các"), ("枯荷城", "Khô Hà Thành")])]
    taught += [e(f"f{b}", ["奇吉·瓦奈"], ["Kygi Wane"], book=b) for b in range(50, 56)]
    return taught + [
        e("a1", ["陆尘云"], ["Lục Trần Vân"]), e("a2", ["陆 尘云"], ["Luc Tran Van"]), e("a3", None, ["Vân Lục Trần"]), e("a4", ["陆尘云大人"], None), e("a5", None, ["LụcTrầnVânn"]), e("a6", ["尘云"], None), e("a7", None, ["L. Trần Vân"]), e("a8", ["陆塵雲"], []),
        e("b1", ["秦坤清"], ["Tần Khôn Thanh"]), e("b2", None, ["Taanf Khoon Thanh"]), e("c1", ["秦坤霜"], ["Tần Khôn Sương"]), e("c2", ["秦坤霜", "大人", " "], [None, ""]),
        e("d1", ["伏虎山"], ["Phục Hổ Sơn"], "place"), e("d2", ["伏虎山脉"], None, "place"), e("d3", None, ["Sơn Phục Hổ"], "place"), e("d4", ["伏虎"], None, "place"), e("d5", None, ["Fuhu mountain"], "place"),
        e("g1", ["枯荷阁"], ["Khô Hà Các"], "faction"), e("g2", ["荷枯阁"], None, "faction"), e("h1", ["枯荷城"], ["Khô Hà Thành"], "place"), e("g3", None, ["KHC"], "faction"),
        e("k1", ["奇吉·瓦奈"], ["Kygi Wane"]), e("k2", ["奇吉瓦奈"], None), e("k3", None, ["Kygi W."]), e("k4", None, ["Kygy Wane"]), e("k5", None, ["Wane Kygi"]),
        e("z1", None, None), e("z2", [], [""], None), e("a1", ["陆尘云"], ["Lục Trần Vân"]), e(None, ["陆尘云"], None), e("o1", ["陆尘云"], ["Lục Trần Vân"], book=2), e("n1", ["陆尘云"], None, book=None),
        e("m1", None, ["x" * 5000]),
    ]


def test_links(spark):
    linked = names.link_names(spark.createDataFrame(entries(), GLOSSARY))
    groups = {}
    for r in linked.where("book_id = 1").collect():
        groups.setdefault(r.component, set()).add(r.id[0])
    assert sorted("".join(sorted(g)) for g in groups.values()) == ["a", "b", "c", "d", "g", "h", "k", "m", "z", "z"]
    pairs = {(r.id_a, r.id_b) for r in names.linked_pairs(linked).collect()}
    assert all(a < b for a, b in pairs) and not any("o1" in p or "n1" in p for p in pairs) and ("a1", "a8") in pairs
    assert {r.id for r in linked.where("book_id is null").collect()} == {"n1"}


def test_no_entries(spark):
    assert names.linked_pairs(names.link_names(spark.createDataFrame([], GLOSSARY))).count() == 0


# alignment


def test_numerals():
    assert [alignment.numeral(x) for x in ("21", "二十一", "十", "一百零三", "两千", "三万二千")] == [21, 21, 10, 103, 2000, 32000]
    assert alignment.zh_tokens("等了二十一天") == ["等", "了", "#21", "天"] and "#21" in alignment.vi_tokens("đợi 21 ngày")
    assert alignment.vi_tokens("Đợi") == ["đợi"] and alignment.vi_tokens("doi") == ["~doi"] == alignment.vi_tokens("Đợi", marked=False)


def test_units():
    cut = lambda s: [t for _, t in alignment.units([(0, s)], alignment._VI_UNIT)]
    assert cut('"Chạy mau!" Anh nói. Em đi; tôi ở.') == ['"Chạy mau!"', "Anh nói.", "Em đi;", "tôi ở."]
    assert cut('"Chạy!" anh nói.') == ['"Chạy!" anh nói.'] and cut("***") == [] == cut("")


def test_chain_is_the_heaviest():
    rng = random.Random(9)
    for _ in range(200):
        pairs = [(rng.randrange(6), rng.randrange(6), rng.random()) for _ in range(rng.randrange(8))]
        got = alignment.heaviest_chain(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(got))
        best = 0.0
        for n in range(len(pairs) + 1):
            for c in itertools.combinations(sorted(pairs), n):
                if all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(c)):
                    best = max(best, sum(w for _, _, w in c))
        assert abs(sum(w for _, _, w in got) - best) < 1e-9


WORLD = [("山", "núi"), ("河", "sông"), ("马", "ngựa"), ("船", "thuyền"), ("灯", "đèn"), ("书", "sách"), ("剑", "kiếm"), ("雪", "tuyết"), ("狗", "chó"), ("门", "cửa"), ("桥", "cầu"), ("火", "lửa"), ("酒", "rượu"), ("茶", "trà"), ("王", "vua"), ("信", "thư")]


def chunks(n, seed=3):
    """Chunks of made-up sentences with one moved, one left out, one added, one pair joined."""
    rng = random.Random(seed)
    rows, truth = [], set()
    for p in range(n):
        sentences = []
        for _ in range(9):
            words = rng.sample(WORLD, 4)
            k = rng.randint(11, 99)
            sentences.append(("".join(z for z, _ in words) + f"{k}。", " ".join(v for _, v in words).capitalize() + f" {k}."))
        zh = [s[0] for s in sentences]
        vi = [(i, s[1]) for i, s in enumerate(sentences)]
        vi.insert(2, vi.pop(7))
        vi.pop(5)
        vi.insert(1, (None, "Người lạ kể chuyện cổ xưa."))
        joined = [vi[0], (vi[2][0], vi[2][1]), *vi[3:]]
        lines = [*joined[:3], ((joined[3][0], joined[4][0]), joined[3][1] + " " + joined[4][1]), *joined[5:], vi[1]]
        for no in range(max(len(zh), len(lines))):
            rows.append((p, no, zh[no] if no < len(zh) else None, lines[no][1] if no < len(lines) else None, "x"))
            if no < len(lines):
                for i in lines[no][0] if isinstance(lines[no][0], tuple) else (lines[no][0],):
                    if i is not None:
                        truth.add((p, i, no))
    return rows, truth


def test_alignment_recovers_known_pairs(spark):
    rows, truth = chunks(60)
    table = spark.createDataFrame([*rows, *rows[:5]], "pair_id bigint, line int, zh string, vi string, zh_line string")
    got = {(r.pair_id, r.zh_line, r.vi_line) for r in alignment.align_lines(table).collect()}
    hit = len(got & truth)
    assert hit / len(got) > 0.93 and hit / len(truth) > 0.9


def test_alignment_edges(spark):
    schema = "pair_id bigint, line int, zh string, vi string"
    rows, _ = chunks(20)
    odd = [(900, 0, "山河马船11。", "山河马船11。"), (901, 0, None, "Núi sông."), (902, 0, "", " "), (903, 0, "山。", None), (None, 0, "山11。", "Núi 11."), (904, None, "山11。", "Núi 11."), (905, 0, "山河" * 3000 + "。", "Núi sông " * 3000 + ".")]
    got = alignment.align_lines(spark.createDataFrame([r[:4] for r in rows] + odd, schema)).collect()
    assert not {r.pair_id for r in got} & {900, 901, 902, 903, 904, None}
    assert alignment.align_lines(spark.createDataFrame([], schema)).count() == 0
    assert len({(r.pair_id, r.zh_line, r.vi_line) for r in got}) == len(got)


def test_training_chunks_are_bounded_and_whole(spark):
    rows = spark.createDataFrame([(p, i) for p in range(500) for i in range(3)], "pair_id bigint, line int")
    for most in (40, 300, 5000):
        got = alignment.sampled_pairs(rows, most).groupBy("pair_id").count().collect()
        assert 0.5 * min(most, 500) < len(got) <= most and {r["count"] for r in got} == {3}
    assert alignment.sampled_pairs(rows.limit(0), 10).count() == 0


def test_associations_are_counted_over_all_chunks(spark):
    """Words that stand in four of 4,600 chunks are known, wherever those lie: any sample of the chunks would miss most of them."""
    rare = [(chr(0x6000 + 2 * k) + chr(0x6001 + 2 * k), f"xa{chr(97 + k % 26)}{'ie'[k // 26]} yo{chr(97 + k % 26)}{'ie'[k // 26]}") for k in range(40)]
    rows = [(p, 0, f"{z}{p + 1000}。", f"{v.capitalize()} {p + 1000}.") for p, (z, v) in enumerate(rare * 4)]
    rows += [(p, 0, f"山河{p + 1000}。", f"Núi sông {p + 1000}.") for p in range(160, 4600)]
    swapped = [(rare[k], rare[(k + 1) % 40]) for k in range(40)]
    for p, (one, other) in enumerate(swapped, start=10_000):
        rows += [(p, 0, one[0] + "。", other[1].capitalize() + "."), (p, 1, other[0] + "。", one[1].capitalize() + ".")]
    got = alignment.align_lines(spark.createDataFrame(rows, "pair_id bigint, line int, zh string, vi string")).where("pair_id >= 10000").collect()
    assert {tuple(r) for r in got} == {(p, a, 1 - a) for p in range(10_000, 10_040) for a in (0, 1)}


def test_pair_counts_are_brute_force(spark, monkeypatch):
    """Counts of pairs, handed on in between, grown and summed over tasks, by definition."""
    monkeypatch.setattr(alignment, "COUNTED_AT_ONCE", 300)
    rng = random.Random(12)
    zh_words, vi_words = [chr(0x6000 + k) for k in range(700)], [f"w{k}" for k in range(6000)]
    rows, truth, seen = [], {}, alignment.PairCounts()
    for k in range(900):
        zh, vi = rng.sample(zh_words, 6), rng.sample(vi_words, 5) + rng.sample(vi_words[:3], 2)
        vi = list(dict.fromkeys(vi))
        seen.add([*zh, "#12"], [*vi, "#12"])
        for a in ("", *zh):
            for b in ("", *vi):
                truth[a, b] = truth.get((a, b), 0) + 1
        if k % 250 == 0:
            rows += seen.drain(3)
    rows += seen.drain(3)
    got = alignment._significant(spark.createDataFrame(rows, "part int, token string, words string, n binary").repartition(5), 3, 1, -9.0).collect()
    assert {(r.zh, r.vi) for r in got} == {(a, b) for a, b in truth if a and b} and len(got) == len({(r.zh, r.vi) for r in got})
    total = truth["", ""]
    for r in got:
        n, nz, nv = truth[r.zh, r.vi], truth[r.zh, ""], truth["", r.vi]
        assert (r.nz, r.nv, r.total) == (nz, nv, total)
        assert abs(r.by_vi - (n / nv - nz / total) / max(1 - nz / total, 0.05)) < 1e-12 and abs(r.by_zh - (n / nz - nv / total) / max(1 - nv / total, 0.05)) < 1e-12


def test_sparse_explanations_are_brute_force():
    """Shares of units by definition: each word's weight, by the surest word of the other unit."""
    rng = random.Random(2)
    zh_to_vi = {c: {v: rng.random() for v in rng.sample("abcdefgh", 3)} for c in "甲乙丙丁戊"}
    vi_to_zh = {v: {c: rng.random() for c in rng.sample("甲乙丙丁戊", 2)} for v in "abcdef"}
    known = alignment.Associations(vi_to_zh, zh_to_vi, {v: rng.random() + 0.5 for v in "abcdef"}, {c: rng.random() + 0.5 for c in "甲乙丙丁戊"})
    zh = [rng.choices([*"甲乙丙丁戊己", "#7"], k=rng.randint(0, 6)) for _ in range(7)]
    vi = [rng.choices([*"abcdefghxy", "#7", "#8"], k=rng.randint(0, 6)) for _ in range(5)]
    for cover, sources, targets, table, weight in zip(known.scores(zh, vi), (zh, vi), (vi, zh), (zh_to_vi, vi_to_zh), (known.zh_weight, known.vi_weight), strict=True):
        got = cover.rows(0, len(sources))
        for i, s in enumerate(sources):
            own = {w: alignment.NUMBER_WEIGHT if w[0] == "#" else weight.get(w, 0.0) for w in set(s)}
            for j, t in enumerate(targets):
                said = sum(v * (float(w in t) if w[0] == "#" else max([table.get(w, {}).get(x, 0.0) for x in t], default=0.0)) for w, v in own.items())
                assert abs(got[i, j] - said / max(sum(own.values()), 1.2)) < 1e-6


def test_long_chunks_are_aligned_whole(spark):
    """800 lines against 400 that join two each, and 900 of which two changed places over 800 lines."""
    rng = random.Random(8)
    sentences = []
    for k in range(900):
        words = rng.sample(WORLD, 4)
        sentences.append(("".join(z for z, _ in words) + f"{k + 1000}。", " ".join(v for _, v in words).capitalize() + f" {k + 1000}."))
    rows = [r[:4] for r in chunks(40)[0]]
    rows += [(500, i, sentences[i][0], f"{sentences[2 * i][1]} {sentences[2 * i + 1][1]}" if i < 400 else None) for i in range(800)]
    place = [*range(900)]
    place[50], place[850] = 850, 50
    rows += [(501, i, sentences[i][0], sentences[place[i]][1]) for i in range(900)]
    truth = {(500, i, i // 2) for i in range(800)} | {(501, place[i], i) for i in range(900)}
    got = {(r.pair_id, r.zh_line, r.vi_line) for r in alignment.align_lines(spark.createDataFrame(rows, "pair_id bigint, line int, zh string, vi string")).where("pair_id >= 500").collect()}
    assert {(501, 850, 50), (501, 50, 850)} <= got
    assert len(got & truth) / len(got) > 0.97 and len(got & truth) / len(truth) > 0.97
