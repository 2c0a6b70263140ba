"""Spelling variants: parsing, the trie against brute force, and classes on hand-written and test names."""

import random

import pytest

from reconspark.llm.names import CITIES, PLATFORMS, Words, character_pairs, city_of, customer_name, edits, learned_words, platform_of, same_brand, shop_name
from reconspark.llm.queries import _words, p5_classes
from reconspark.llm import variants
from reconspark.llm.variants import spelling_classes, spelling_pairs, trie_pairs

WORDS = Words({**PLATFORMS, "欧集": ("欧集", "欧集站", "eumart"), "澳铺": ("auspu", "澳铺", "澳铺站"), "美澜": ("meilan", "美澜")}, dict(CITIES))


@pytest.mark.parametrize(
    "text,brand,platform,kind,ordinal",
    [
        ("毫翰恭彩烘焙抖音企业店", "毫翰恭彩", "抖音", "企业", ""), ("专卖店（惠爹剑系零食）拼多多", "惠爹剑系", "拼多多", "专卖", ""), ("　毫翰恭彩烘焙ＤＹ企業店-旧", "毫翰恭彩", "抖音", "企业", ""),
        ("【新】李沼住玉乳业欧集专营店二店(停用)", "李沼住玉", "欧集", "专营", "二"), ("李沼住玉 乳业JD 旗舰店", "李沼住玉", "京东", "旗舰", ""), ("昧尔屉坪生活美澜官旗", "昧尔屉坪", "美澜", "旗舰", ""),
        ("乘缎姿瑟乳业拼多多企业二店", "乘缎姿瑟", "拼多多", "企业", "二"), ("AUSPU茉尔梦畅乳业专卖店二店*", "茉尔梦畅", "澳铺", "专卖", "二"), ("", "", "", "", ""), (None, "", "", "", ""),
    ],
)
def test_shop_names(text, brand, platform, kind, ordinal):
    n = shop_name(text, WORDS)
    assert (n.brand, n.platform, n.kind, n.ordinal) == (brand, platform, kind, ordinal)


def test_other_names():
    assert shop_name("Beluka烘焙TMALL旗舰店").nick == "beluka"
    assert customer_name("广州惠爹剑系电子商务有限公司(惠爹剑系拼多多)").brand == "惠爹剑系"
    assert customer_name("Masozu Foods (MEILAN)", WORDS).nick == "masozu" and customer_name("Masozu Foods (MEILAN)", WORDS).platform == "美澜"
    assert customer_name("宁波鲈宵苇猩电子商务有限公司-抖店").platform == "抖音" and customer_name(None).brand == ""
    assert [platform_of(t, WORDS) for t in ("拼多", "JD", "欧集站", None, "?")] == ["拼多多", "京东", "欧集", "", ""]
    assert [city_of(t) for t in ("浙江杭州", "SH", "沪", None)] == ["杭州", "上海", "上海", ""]


def test_same_brand():
    for a, b, want in (("毫翰恭彩", "毫彩", True), ("毫翰恭彩", "毫翰彩恭", True), ("毫翰恭彩", "毫末恭彩", True), ("毫翰恭彩", "彩翰恭毫", True), ("毫翰恭彩", "彩毫", False), ("毫翰恭彩", "毫", False), ("毫翰恭彩", "茉翰螺正", False), ("ab", "ac", False)):
        assert same_brand(a, b) is want, (a, b)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_trie_finds_all_neighbours():
    rng = random.Random(1)
    names = list({"".join(rng.choice("甲乙丙丁") for _ in range(rng.randrange(0, 6))) for _ in range(200)})
    for k in (0, 1, 2):
        assert set(trie_pairs(names, names, k)) == {(a, b) for a in names for b in names if a != b and levenshtein(a, b) <= k}
    assert edits("甲乙", "乙甲") == 1 and edits("", "甲") == 1


def test_classes(spark):
    texts = [("毫翰恭彩烘焙抖音企业店", 50), ("企业店（毫彩烘焙）抖音", 2), ("毫翰彩恭烘焙DY企业店", 1), ("毫翰恭彩烘焙抖音企业店二店", 9), ("毫翰恭彩烘焙天猫企业店", 9), ("zizudi烘焙抖音企业店", 1), ("茉翰螺正食饮抖音企业店", 30), ("N/A", 9), ("", 9), (None, 9), ("x" * 5000, 1)]
    df = spark.createDataFrame(texts, "shop string, n long").selectExpr("*", "'clash' as brand")
    nick = spark.createDataFrame([("zizudi", "毫翰恭彩"), ("zizudi", "毫翰恭彩"), ("zizudi", "别的")], "nick string, brand string")
    classes = spelling_classes(df, nick)
    links = {r.shop: r.links for r in classes.collect()}
    assert links == {t: (3 if i in (0, 1, 2, 5) else 0) for i, (t, _) in enumerate(texts) if i not in (7, 8, 9)}
    pairs = {tuple(r) for r in spelling_pairs(classes).collect()}
    assert len(pairs) == 6 and all(a < b for a, b in pairs)
    assert spelling_classes(df.limit(0)).count() == 0


def test_test_names_fall_into_their_stores(spark, tiny):
    rows, words = p5_classes(spark, tiny).collect(), _words(spark, tiny)
    for r in rows:
        n, (brand, platform, ordinal) = shop_name(r.shop, words), r.class_id.split("|")
        assert (n.platform, n.ordinal) == (platform, ordinal)
        assert n.nick or n.brand == brand or set(n.brand) & set(brand)


def test_platforms_and_cities_on_no_list(spark):
    rows = [(f"毫翰{chr(0x4E10 + i)}彩烘焙云帆旗舰店", "云帆") for i in range(600)] + [("毫翰恭彩烘焙云帆旗舰店", "YunFan"), ("毫翰恭彩烘焙云帆企业店", " yunfan "), ("毫翰恭彩烘焙云帆站企业店", "云帆站"), ("毫翰恭彩烘焙JD企业店", "京東"), ("x", "孤例"), (None, "云帆"), ("y", None)]
    cities = [("兰州市",), ("兰州",), ("甘肃兰州",), ("甘肃兰州",), ("兰州",), ("杭州",), ("浙江杭州",), ("LZ",), (None,)]
    said, towns = spark.createDataFrame(rows, "shop string, platform string"), spark.createDataFrame(cities, "city_text string")
    words = learned_words(said, towns)
    assert set(words.platforms) == {*PLATFORMS, "云帆"} and set(words.platforms["云帆"]) == {"云帆", "云帆站", "yunfan"}
    assert set(words.cities) == {*CITIES, "兰州"} and city_of("甘肃兰州", words) == "兰州" and city_of("兰州市", words) == "兰州"
    assert shop_name("毫翰恭彩烘焙YUNFAN旗舰店", words) == shop_name("旗舰店（毫翰恭彩烘焙）云帆站", words) and shop_name("毫翰恭彩烘焙云帆旗舰店", words).brand == "毫翰恭彩"
    assert learned_words(said.limit(0), towns.limit(0)) == Words(dict(PLATFORMS), dict(CITIES))
    texts = spark.createDataFrame([("毫翰恭彩烘焙云帆旗舰店", 5), ("毫翰恭烘焙YunFan旗舰店", 1), ("毫翰恭彩烘焙京东旗舰店", 5)], "shop string, n long")
    assert {r.shop: r.links for r in spelling_classes(texts, words=words).collect()} == {"毫翰恭彩烘焙云帆旗舰店": 1, "毫翰恭烘焙YunFan旗舰店": 1, "毫翰恭彩烘焙京东旗舰店": 0}


def test_spellings_share_a_pair_of_characters():
    rng = random.Random(2)
    names = list({"".join(rng.choice("甲乙丙") for _ in range(rng.randrange(2, 6))) for _ in range(150)})
    for a in names:
        for b in names:
            if a != b and same_brand(a, b):
                assert character_pairs(a) & character_pairs(b), (a, b)


@pytest.mark.parametrize("shard", [3, 4000])
def test_neighbours_against_all_pairs(spark, monkeypatch, shard):
    monkeypatch.setattr(variants, "SHARD_NAMES", shard)
    rng = random.Random(6)
    rows = list({(rng.choice("pq"), "".join(rng.choice("甲乙丙丁戊己") for _ in range(rng.randrange(1, 6)))) for _ in range(160)})
    got = {tuple(r) for r in variants._neighbours(spark.createDataFrame(rows, "block string, brand string")).collect()}
    near = lambda a, b: same_brand(a, b) and (levenshtein(a, b) <= 2 or sorted(a) == sorted(b))
    assert got == {(p, a, b) for p, a in rows for q, b in rows if p == q and a != b and near(a, b)} and len(got) > 100
