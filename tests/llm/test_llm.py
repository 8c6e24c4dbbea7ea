"""The language-data operators on small tables with every awkward case, and against brute force."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestloom.llm import contamination, cooccurrence, names, packing, queries, sentences
from nestloom.llm.words import words

# ---- items that appear together


def cooccurring(spark, data, **options):
    df = spark.createDataFrame(data, "basket long, xs array<string>, item string")
    return cooccurrence.cooccurring(df, F.col("basket"), {"xs": F.col("xs")}, **options)


def test_pairs_against_brute_force(spark, rows):
    rng = random.Random(1)
    data = [(b % 150, [rng.choice("abcdefghij") for _ in range(rng.randrange(6))] + [None], "clash") for b in range(200)] + [(None, ["a", "b"], None), (7, None, None)]
    baskets = defaultdict(set)
    for b, xs, _ in data:
        if b is not None:
            baskets[b] |= {x for x in xs or [] if x}
    n, both = Counter(x for xs in baskets.values() for x in xs), Counter(p for xs in baskets.values() for p in itertools.combinations(sorted(xs), 2))
    for least, lift in ((1, 0), (5, 0), (5, 1.02)):
        expected = sorted(("xs", a, b, n[a], n[b], c) for (a, b), c in both.items() if c >= least and c * len(baskets) >= lift * n[a] * n[b])
        found = cooccurring(spark, data, min_count=least, min_lift=lift)
        assert rows(found, "field_name", "item_a", "item_b", "n_a", "n_b", "n_ab") == sorted(expected, key=str)


def test_surprise_has_pairs_of_few_works(spark, rows, tmp_path):
    works = [(f"W{i}", [("T1",), ("T2",)] if i == 0 else [("T3",), ("T4",)] if i < 7 else [(f"T{i}",)]) for i in range(20)]
    held = "array<struct<id string>>"
    spark.createDataFrame(works, f"id string, topics {held}").selectExpr("*", f"cast(null as {held}) concepts", f"cast(null as {held}) keywords").write.parquet(f"{tmp_path}/works.parquet")
    assert rows(queries.p2_surprise(spark, str(tmp_path)), "item_a", "item_b", "n_ab") == [("t1", "t2", 1), ("t3", "t4", 6)]


def test_large_baskets_take_the_block_join(spark, rows):
    data = [(b, [f"i{k:02d}" for k in range(12)], None) for b in range(3)] + [(9, ["i01", "i02"], None)]
    df = spark.createDataFrame(data, "basket long, xs array<string>, item string")
    inc = cooccurrence.incidences(df, F.col("basket"), {"xs": F.col("xs")})
    whole, cut = (cooccurrence.pair_counts(inc, 4, 1, basket_items=m) for m in (100, 5))
    assert rows(whole) == rows(cut) and whole.count() == 66


def test_empty_baskets(spark):
    assert cooccurring(spark, []).count() == 0
    assert cooccurring(spark, [(1, [], None), (2, None, None)]).count() == 0


def test_tails_are_those_of_the_coin_flips():
    rng = np.random.default_rng(1)
    for k in (1, 3, 10):
        q, n = rng.random((30, k)) * rng.choice([0.001, 0.05, 0.3], (30, 1)), rng.integers(1, 50, k)
        at = rng.integers(1, 25, 30)
        got = cooccurrence.tail_log10(q, n.astype(float), at)
        for r in range(30):
            pmf = np.array([1.0])
            for c in range(k):
                for _ in range(n[c]):
                    pmf = np.convolve(pmf, [1 - q[r, c], q[r, c]])
            tail = pmf[at[r] :].sum() if at[r] < len(pmf) else 0
            if tail > 1e-13:
                assert got[r] == pytest.approx(-math.log10(tail), abs=0.1, rel=0.03)


def test_the_fit_in_blocks_and_without_convergence():
    freq, size = np.array([1, 2, 5, 9]), np.array([1, 3, 4])
    n_items, n_baskets = np.array([4, 3, 2, 1]), np.array([5, 6, 2])
    size_sum, freq_sum = (size * n_baskets).sum(), (freq * n_items).sum()
    n_items[0] += size_sum - freq_sum
    whole, blocked = (cooccurrence.fit_null(freq, n_items, size, n_baskets, cells=c) for c in (1 << 20, 2))
    assert np.allclose(whole[0], blocked[0]) and np.allclose(whole[1], blocked[1])
    with pytest.raises(RuntimeError, match="converged"):
        cooccurrence.fit_null(freq, n_items, size, n_baskets, rounds=1)


def test_null_keeps_frequencies_and_sizes():
    freq, items, size, baskets = np.array([2, 5, 9]), np.array([10, 5, 2]), np.array([1, 3, 4]), np.array([20, 9, 4])
    x, y = cooccurrence.fit_null(freq, items, size, baskets)
    p = np.outer(x, y) / (1 + np.outer(x, y))
    assert (p * baskets).sum(1) == pytest.approx(freq, rel=1e-5) and (p * items[:, None]).sum(0) == pytest.approx(size, rel=1e-5)


def test_planted_pair_is_surprising(spark):
    rng = random.Random(2)
    data = [(b, [rng.choice("abcdefgh") for _ in range(3)] + (["p", "q"] if b % 10 == 0 else []), None) for b in range(300)]
    found = {(r["item_a"], r["item_b"]): r for r in cooccurring(spark, data, min_count=2).collect()}
    assert found["p", "q"]["q_tail"] > 10 and found["p", "q"]["expected"] < 6
    assert all(r["q_tail"] <= 2 for k, r in found.items() if not {"p", "q"} & set(k))


# ---- names


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Farid Kondwick", "F. Kondwick", True), ("Farid Kondwick", "Kondwick,  Farid", True), ("Farid Kondwick", "Farid Kodnwick", True), ("Susanna Vera Changsasez", "Sue Vera Changsasez", True),
        ("Samuel Tülfaikska", "Dr. Sam Tuelfaikska", True), ("Søren Klemm", "SOEREN KLEMM, Jr.", True), ("Francisco Ursula Klexer", "Francisco Klexer II", True), ("Noor al-Hundsen", "al Hundsen Noor", True),
        ("Linus von Hendzouxman", "l. vonhendzouxman", True), ("Jean-Luc Bekkável", "J.-L. Bekkável", True), ("Rebecca Amara Priand", "Becky Priand", True), ("Alexander Dortić", "S. Dortić", True),
        ("Stephen King", "Steve King", True), ("Antonio Silva", "Toni Silva", True), ("王 小明", "王小明", True), ("王小明", "王小红", False), ("Arjun Rao", "Arj Rao", True),
        ("Rebecca Leinov", "Joseph Leinov", False), ("Yuki Keakov", "Yuki Prindgotu", False), ("Arjun Zoltán Seirova", "Noor Seirova", False), ("Samuel Richard Félm", "Samuel Chokard", False), ("", "X Y", False), (None, None, False),
    ],
)
def test_spellings(a, b, same):
    x, y = names.tokens(a), names.tokens(b)
    assert bool(names.same_name(x, y)) == same == bool(names.same_name(y, x))
    if same:
        assert set(names.endings(x)) & set(names.endings(y))


def test_short_forms_by_rule_and_without_a_list():
    known = names.Known("", {"vera": (50, 40), "wen": (50, 40), "novak": (50, 3), "robert": (50, 45), "bob": (50, 40)})
    for a, b in (("Vera Ivanova", "Verochka Ivanova"), ("Wen Li", "Wenwen Li"), ("Robert Novak", "Rob Novak"), ("Robert Novak", "Robbie Novak")):
        assert names.same_name(names.tokens(a), names.tokens(b), known) > 0
    assert names.same_name(["robert", "novak"], ["bob", "novak"], known) == 0
    assert known.is_given("robert") and not known.is_given("novak") and not known.conflict("novak", "nowak")


def test_lcs_ratio():
    def brute(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return 2 * best[-1][-1] / (len(a) + len(b))

    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 12))) for _ in range(2))
        assert names.lcs_ratio(a, b) == pytest.approx(brute(a, b))


PEOPLE = [
    (1, "Farid Kondwick", 10), (1, "Farid Kondwick", 10), (2, "F. Kondwick", 10), (3, "Kondwick, Farid", 11), (3, "Kondwick, Farid", 10), (4, "Farid Kondwick", 12), (5, "Mei Zovel", 10), (6, None, 10), (7, "Mei Zovel", None), (None, "Mei Zovel", 10), (8, "!!", 10),
]
MENTIONS = [(100, 0, "FARID KONDWICK", 10), (100, 1, "M. Zovel", 10), (100, 2, "Olga Nowhere", 10), (101, 0, "Farid Kondwick", 12), (102, 0, None, 10), (103, 0, "Farid Kondwick", 99)]


@pytest.mark.parametrize("common", [200, 1])
def test_linking(spark, rows, common):
    people, mentions = spark.createDataFrame(PEOPLE, "id long, name string, g long"), spark.createDataFrame(MENTIONS, "k1 long, k2 int, name string, g long")
    persons, attached = names.link_names(people, mentions, common)
    assert rows(persons) == [(1, 2), (1, 3), (2, 3)]
    assert rows(attached, "k1", "k2", "id") == [(100, 0, 1), (100, 1, 5), (101, 0, 4)]


ALIKE = [("Maria", "Marta"), ("Daniel", "Daniela"), ("Andreas", "Andrea"), ("Mario", "Maria"), ("Wei", "Wen"), ("Xiaoming", "Xiaoning")]


def test_different_names_that_are_alike(spark, rows):
    # each given name begins many names, so that it is established
    crowd = [(1000 * n + i, f"{name} {''.join(chr(97 + (i * 7 + n * 3 + k * k * (i + 1)) % 26) for k in range(9))}", 100 + i) for n, name in enumerate(sorted({x for p in ALIKE for x in p})) for i in range(30)]
    pairs = [(50_000 + 2 * k + j, f"{name} Keller{'abcdef'[k]}w", 5 + k) for k, p in enumerate(ALIKE) for j, name in enumerate(p)]
    typed = [(60_000, "Maira Kellerxw", 60), (60_001, "Maria Kellerxw", 60)]
    people = spark.createDataFrame(crowd + pairs + typed, "id long, name string, g long")
    persons, _ = names.link_names(people, spark.createDataFrame([], "k1 long, k2 int, name string, g long"))
    assert [x for x in rows(persons) if x[0] >= 50_000] == [(60_000, 60_001)]


def test_one_institution_with_many_names(spark, rows):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("aeiou" if i % 2 else "bdklmnrst") for i in range(n))
    people = [(i, f"{word(5)} {word(4)}ova", 1) for i in range(3_000)]
    people += [(10_000 + i, name[:2] + name[3:] if i % 2 else f"{name.split()[1]}, {name[0]}.", 1) for i, (_, name, _) in enumerate(people[:400])]
    people += [(20_000, people[0][1], 1)] * 500
    df = spark.createDataFrame(people, "id long, name string, g long")
    members, _ = names.linked(df, spark.createDataFrame([], "k1 long, k2 int, name string, g long"), common=40)
    root = {r["node"]: r["root"] for r in members.collect()}
    alike = lambda a, b: names.same_name(names.tokens(a), names.tokens(b)) > 0
    planted = [(i, 10_000 + i) for i in range(400) if alike(people[i][1], people[3_000 + i][1])]
    assert len(planted) > 380 and all(root[a] == root[b] for a, b in planted) and root[20_000] == root[0]


def test_blocks_that_cannot_be_refined_are_cut(spark, rows):
    people = [(i, f"Jo Novak{chr(97 + i % 26)}", 1) for i in range(60)]
    df = spark.createDataFrame(people, "id long, name string, g long")
    members, _ = names.linked(df, spark.createDataFrame([], "k1 long, k2 int, name string, g long"), common=3)
    assert members.select("root").distinct().count() == 1 and members.count() == 60


def test_linking_nothing(spark):
    persons, attached = names.link_names(spark.createDataFrame([], "id long, name string, g long"), spark.createDataFrame([], "k1 long, k2 int, name string, g long"))
    assert persons.count() == attached.count() == 0


def test_components(spark, rows):
    edges = spark.createDataFrame([(n, n + 1) for n in range(1, 30)] + [(50, 40), (40, 60)], "a long, b long")
    assert dict(rows(names.components(edges))) == {n: 1 for n in range(1, 31)} | {40: 40, 50: 40, 60: 40}


# ---- packing

DOCS = [(1, "alpha beta " * 30), (2, "alpha gamma " * 20), (3, None), (4, ""), (5, "delta " * 500), (6, "日本語のテキスト。" * 10), (6, "日本語のテキスト。" * 10), (7, "x")]


def test_every_document_is_packed_once(spark):
    docs = spark.createDataFrame([(*d, "clash") for d in DOCS], "doc_id long, text string, container string")
    rows = packing.packed(docs, capacity=100, shard_items=3).collect()
    encode = packing.tokenizer(packing.TOKENIZER).encode_ordinary
    expected = Counter()
    for d, text in DOCS:
        n = len(encode(text or ""))
        expected.update((d, k, k * 100, min(100, n - k * 100)) for k in range(max(1, -(-n // 100))))
    assert Counter((r["doc_id"], r["piece"], r["token_start"], r["n_tokens"]) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r["container"]].append(r)
    assert all(sum(r["n_tokens"] for r in c) <= 100 and sorted(r["position"] for r in c) == list(range(len(c))) for c in held.values())


def test_packing_nothing(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_room_is_used(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["red", "green", "blue", "sky", "sea"]) for _ in range(rng.randrange(5, 120)))) for i in range(600)], "doc_id long, text string")
    placed = packing.packed(docs, capacity=256, shard_items=100)
    assert packing.packing_report(placed, 256).first()["used"] > 0.97


@pytest.mark.parametrize("least, most", [(60, 70), (40, 60)])
def test_groups_stay_bounded_when_items_stay_loose(spark, least, most):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, "red " * rng.randrange(least, most)) for i in range(200)], "doc_id long, text string")
    rows = packing.packed(docs, capacity=100, shard_items=20).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(200))
    room, groups = Counter(), Counter()
    for r in rows:
        room[r["container"]] += r["n_tokens"]
        groups[r["container"].rpartition("-")[0]] += 1
    assert max(room.values()) <= 100 and max(groups.values()) <= 60


def test_a_third_of_equal_documents_is_cut_like_all_others(spark):
    rng = random.Random(8)
    docs = [(None, "same words here " * 20)] * 300 + [(i, "".join(rng.choice("ab ") for _ in range(90))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.packed(df, capacity=100, shard_items=50).collect()
    assert sum(r["doc_id"] is None for r in rows) == 300 and sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == list(range(600))
    groups = Counter(r["container"].rpartition("-")[0] for r in rows)
    assert max(groups.values()) <= 50
    assert packing.packing_faults(df, packing.packed(df, 100, shard_items=50), 100).first()[1:] == (0, 0, 0)
    # the containers do not depend on how the documents are spread
    again = packing.packed(df.repartition(7), capacity=100, shard_items=50).collect()
    assert Counter((r["container"], r["doc_id"], r["n_tokens"]) for r in again) == Counter((r["container"], r["doc_id"], r["n_tokens"]) for r in rows)


def test_the_rest_of_a_document_has_its_own_terms(spark):
    text = "early " * 120 + "late " * 30
    df = packing.items(spark.createDataFrame([(1, text)], "doc_id long, text string"), 100, packing.TOKENIZER)
    rows = sorted(df.collect(), key=lambda r: r["piece"])
    assert [r["n_tokens"] for r in rows][:-1] == [100] and [len(r["terms"]) for r in rows] == [0, 2]
    assert sum(rows[-1]["counts"]) < 60


def test_neighbours_share_a_window():
    terms = [np.array([1, 2]), np.array([5, 6]), np.array([1, 2]), np.array([5, 6])]
    found = packing.pack(np.array([60, 50, 40, 40]), terms, [np.ones(2, int)] * 4, np.ones(10), 2.0, 100)
    assert found == [[0, 2], [1, 3]]


# ---- leaks


def leaked(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, lang string, text string")
    return {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in contamination.leaks(d, i, **options).collect()}


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_leaks(spark):
    docs = [
        (1, f"before {PASSAGE} after", None), (2, "BEFORE. Óne *two* thrée-four five\xad, six; seven\neight NINE ten eleven twelve", None), (3, None, None), (4, "", None),
        (5, "one two three four FIVE six seven WRONG nine ten eleven twelve", None), (6, "one two three four five six seven", None), (1, "nothing", None),
    ]
    found = leaked(spark, docs, [(10, "en", PASSAGE), (11, "en", "short text"), (12, "en", None), (10, "en", PASSAGE)])
    assert found[1, 10] == (12, 12, 12) and found[2, 10] == (12, 12, 12)
    assert found[5, 10][1] == 0 and found[5, 10][2] > 0
    assert set(found) == {(1, 10), (2, 10), (5, 10)}


def test_signs_count_in_chinese(spark):
    text = "我们用测量了个潮湿催化剂光谱误差为毫克"
    assert leaked(spark, [(1, f"前{text}后", None)], [(1, "zh", text)])[1, 1][1] == len(text)
    assert leaked(spark, [(1, text[:11] + "乙" * 3, None)], [(1, "zh", text)]).get((1, 1), (0, 0))[1] == 0


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, "en", " ".join(rng.choice("abcd") * 2 for _ in range(20))) for i in range(30)]
    docs = []
    for d in range(60):
        text = [rng.choice("abcd") * 2 for _ in range(30)]
        piece = rng.choice(items)[2].split()
        cut = rng.randrange(12)
        docs.append((d, " ".join(text[:10] + piece[cut : cut + 8 + rng.randrange(5)] + text[10:]), None))
    expected = {}
    for d, text, _ in docs:
        grams = {tuple(words(text)[p : p + 8]) for p in range(len(words(text)) - 7)}
        for i, _, item in items:
            w = words(item)
            covered = {p + k for p in range(len(w) - 7) if tuple(w[p : p + 8]) in grams for k in range(8)}
            if covered:
                expected[d, i] = len(covered)
    for chars in (20_000_000, 300):
        assert {k: v[1] for k, v in leaked(spark, docs, items, block_chars=chars).items() if v[1]} == expected


def test_no_leaks(spark):
    assert leaked(spark, [], []) == {} and leaked(spark, [(1, PASSAGE, None)], []) == {} and leaked(spark, [], [(1, "en", PASSAGE)]) == {}


def test_words():
    assert words("The Bioﬁlm-Straße, *ø*l 1.5!") == ["the", "biofilm", "strasse", "ol", "1", "5"]
    assert words("図3にABを") == ["図", "3", "に", "ab", "を"] and words(None) == words("") == []


# ---- sentences


@pytest.mark.parametrize(
    ("parts"),
    [
        ["As Dr. Kolb and W. R. Klein et al. showed in Fig. 27, it fell by 65.3 percent.", " ", "mRNA counts fell, p = 3.0.", " ", "57 records were dropped."],
        ['"Is it urban?" asked Prof. al-Kim, and nobody replied.', "\n", "“The sensor is arid, and tekon is not.”", " ", "No. 385 in the series won!"],
        ["“Our beetle won,” wrote Mrs. Kisel, “but the ledger did not.”", " ", "It failed... or so the log claims."],
        ["(Each scaffold was read again by the team.)", "\n\n", "Methods", "\n\n", "1. Scope", "\n \n", "All were run by Ltd.", " ", "In the U.S. and elsewhere it rained at 6 a.m. and later."],
        ["It absorbed them often.", "", "Why did it end?!", "", "Funding: X, grant y.254/1971; none other.", "", "150 records fell."],
        ["Die Datei wurde am 9. März 2014 geprüft, z. B. mit x.", " ", "„Ist es stabil?“, fragte Prof. X in der Karte.", " ", "Vgl. dazu Abb. 3 und Bd. 33!"],
        ["« La carte est-elle humide ? » demanda le Pr. X devant la forêt.", " ", "Pourquoi ?", " ", "Cf. fig. 2 et p. 3."],
        ["«La capa es húmeda», escribió B. X en 2018, «pero gukon no».", " ", "¿Por qué?", " ", "En EE. UU. la curva cubre 7 casos."],
        ["По данным проф. X и др., в 1951 г. снизилась, т. е. упала.", " ", "«Разве плотность городской?» — спросил M. X из zaiosis."],
        ["「化石は季節的ですか？」とXは尋ねた。", "", "なぜxの語彙は線形なのか？", "", "Xは「終わった。」とy誌に書いた。"],
        ["我们测量了54个算法，误差为11.38毫克。", "", "“这种陶瓷真的稳定吗？”X在会议上问道。", "", "见图96.38，没有关系。"],
        ["डॉ. X के अनुसार कमी आई।", " ", "“नमूना नम है।” ऐसा प्रो. X ने कहा।", " ", "कितना धीमा है यह!"],
        ["«هل القياس رطب؟» سأل أ. X عن y.", " ", "ذكر د. Y أن المصدر انخفض."],
        ["ผลของเยื่อยังหายากอยู่", " ", "ในวารสารปี 1971 ไม่มีป่า", " ", "ทำไมเยื่อจึงช้า"],
    ],
)
def test_sentence_boundaries(parts):
    text, expected, at = "  " + "".join(parts) + "\n", [], 2
    for k, part in enumerate(parts):
        if k % 2 == 0:
            expected.append((at, at + len(part)))
        at += len(part)
    assert sentences.split(text) == expected


def test_blank_texts_have_no_sentence():
    assert sentences.split("") == sentences.split(" \n\n ") == []
    assert sentences.split("word") == [(0, 4)]


TEXTS = st.text(alphabet=st.sampled_from('ab AB.?! \n"“”„(1。」か…é*'), max_size=300)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_sentences_cover_the_text(text):
    found = sentences.split(text)
    covered = set().union(*[range(a, b) for a, b in found]) if found else set()
    assert {i for i, c in enumerate(text) if not c.isspace()} <= covered
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in found) and found == sorted(found)
    assert all(a[1] <= b[0] for a, b in itertools.pairwise(found))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_chunk_functions_compose(text, size):
    whole, bounds = sentences.read(text, 0, len(text))
    state, found = 0, []
    for lo in range(0, max(1, len(text)), size):
        ends, cuts = sentences.read(text, lo, min(len(text), lo + size))
        found += [(e, n) for e, n, bits in cuts if bits >> state & 1]
        state = ends[state]
    assert state == whole[0] and found == [(e, n) for e, n, bits in bounds if bits & 1]


def test_long_texts_are_cut_without_a_trace(spark, rows):
    rng = random.Random(9)
    pieces = ["One two. ", '"Is it?" asked X. ', "A\n\nB ", "“No.” Yes! ", "3.5 kg. ", "U.S. law", "。」と", "  "]
    texts = [(i, "".join(rng.choice(pieces) for _ in range(120)), "clash") for i in range(8)] + [(90, None, None), (91, "", None), (92, " " * 500, None), (93, "x" * 700, None), (94, ". " * 300, None)]
    texts += texts[:2]
    df = spark.createDataFrame(texts, "doc_id long, text string, start_char string")
    expected = sorted(((d, a, b) for d, t, _ in texts if t for a, b in sentences.split(t)), key=str)
    assert rows(sentences.sentences(df)) == expected
    assert rows(sentences.sentences(df, chunk_chars=90, context=120)) == expected


def test_blanks_behind_a_chunk_are_seen(spark, rows):
    text = "One two." + " " * 3_000 + "said nobody. Three." + " word" * 900 + ". End."
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    for size in (8, 100, 700):
        assert rows(sentences.sentences(df, size, 200), "start_char", "end_char") == sorted([x for x in sentences.split(text)] * 2, key=str)


def test_no_documents(spark):
    assert sentences.sentences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- ids that are null or beyond what a double holds

BIG = 2**60 + 1


def test_null_and_large_ids(spark):
    docs = spark.createDataFrame([(None, f"A b. C d. {PASSAGE}"), (BIG, f"{PASSAGE}. X y."), (7, "z. " * 900), (None, "q. " * 900)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "en", PASSAGE), (BIG, "en", PASSAGE), (None, "en", PASSAGE)], "item_id long, lang string, text string")
    counts = lambda df: {r["doc_id"]: r["count"] for r in df.groupBy("doc_id").count().collect()}
    assert counts(sentences.sentences(docs, 500, 100)) == {None: 902, BIG: 2, 7: 1}
    assert {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, items, 0.5).collect()} == {(d, i) for d in (None, BIG) for i in (1, BIG, None)}
    assert set(counts(packing.packed(docs, 100))) == {None, BIG, 7}
