"""Reading levels: accuracy on held-out grades, a brute-force graph, and tables without prose, grades or rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reconspark.llm import reading
from reconspark.llm.reading import reading_levels, words_of

DATA = "/root/testdata/sf0.1"


def test_held_out_grades(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/reading_label.parquet")
    held = F.pmod(F.hash("doc_id"), F.lit(5)) == 0
    known = labels.where(held & F.col("reading_level").isNotNull()).select("doc_id", F.col("reading_level").alias("grade"))
    got = reading_levels(docs, labels.where(~held)).join(known, "doc_id")
    got = got.select((F.col("reading_level") == F.col("grade")).cast("int").alias("same"), (F.abs(F.col("reading_level") - F.col("grade")) <= 1).cast("int").alias("near"), "difficulty", "grade")
    r = got.agg(F.avg("same").alias("same"), F.avg("near").alias("near"), F.corr("difficulty", "grade").alias("corr"), F.count("*").alias("n")).first()
    print(r)
    assert r.n > 150 and r.same > 0.72 and r.near > 0.97 and r.corr > 0.9


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "她买了新的袋子。我们退了旧的货物。", "x"), (2, None, "x"), (3, "", "x"), (4, "JY1 | 2 | 3\nJY2 | 3 | 4", "x"), (5, "The man saw a box. The man lost a key.", "x"), (6, "a" * 200_000, "x"), (7, "她买了新的袋子。", "x")],
        "doc_id long, text string, grade string",
    )
    labels = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "b", None), (2, "a", 3), (5, "a", 4), (99, "a", 2), (None, None, None)], "doc_id long, rater string, reading_level int")
    got = {r.doc_id: r.reading_level for r in reading_levels(docs, labels).collect()}
    assert set(got) == {1, 5} and all(1 <= v <= 5 for v in got.values())
    assert reading_levels(docs, labels.limit(0)).count() == 0
    assert reading_levels(docs.limit(0), labels).count() == 0


CODE = re.compile(r"https?:[!-~]*[\"-+\-/-9<->@-~]|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]*[A-Za-z0-9]|(?<![A-Za-z])[A-Za-z]++[0-9][A-Za-z0-9_]*")


def brute_words(text):
    """Script, words and length classes by plain patterns; None for fewer than two sentences of prose."""
    kept, z, e = [], 0, 0
    for s in re.split(r"[。！？!?\n\r]+|\.(?=[ \t-\r]|$)", CODE.sub(" ", text or "")):
        han, latin = re.findall("[一-鿿㐀-䶿]", s), re.findall("[A-Za-z]+", s)
        if (len(han) >= 4 or len(latin) >= 3) and not re.match(r"[ \t-\r]*(主题|主旨|[Ss]ubject|[Rr]e\b|Ref\b|>|\[)", s, re.ASCII):
            kept.append((s, len(han), len(latin)))
            z, e = z + len(han), e + len(latin)
    if len(kept) < 2:
        return None
    words = Counter()
    for s, h, w in kept:
        words.update(x.lower() for x in re.findall("[A-Za-z]+", s))
        words.update(re.findall("(?=([一-鿿㐀-䶿]{2}))", s))
        words[("#z", round(np.log2(h) * 3)) if h >= 4 else ("#e", round(np.log2(w) * 3))] += 1
    return int(z < 3 * e), words


def taken_apart(texts):
    index, script, doc, word = words_of(texts)
    found = defaultdict(Counter)
    for d, w in zip(doc.tolist(), word.tolist(), strict=True):
        found[d][w] += 1
    return {int(i): (int(script[d]), found[d]) for d, i in enumerate(index)}


def test_words_against_patterns(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ["a.B12 c. d e f. Re: x y z. re-do it all. g h i", "ＡＢ 她买了新的袋子！她买了新的袋子", "x1y2_z 她买了新的袋。" * 3, "\ud800她买了新的袋子。我们退了旧的货物", "The the THE. the The the"]
    got = taken_apart(texts)
    want = {i: b for i, t in enumerate(texts) if (b := brute_words(t))}
    assert set(got) == set(want) and len(want) > 900
    meaning = {}
    for i, (script, words) in want.items():
        assert got[i][0] == script and sorted(got[i][1].values()) == sorted(words.values()), texts[i]
    # A number always stands for the same word: what one document has alone tells which.
    for i, (_, words) in want.items():
        for w, n in words.items():
            same = {x for x, m in got[i][1].items() if m == n}
            meaning[w] = meaning.get(w, same) & same
    assert all(meaning.values())


def brute_levels(texts, grades, tolerance=reading.TOLERANCE):
    """The same iterations over one dense table."""
    docs = [(i, *b) for i, t in enumerate(texts) if (b := brute_words(t))]
    names = sorted({w for _, _, words in docs for w in words}, key=str)
    at = {w: k for k, w in enumerate(names)}
    count = np.zeros((len(docs), len(names)))
    for d, (_, _, words) in enumerate(docs):
        for w, n in words.items():
            count[d, at[w]] = n
    df, length = (count > 0).sum(axis=0), np.array([isinstance(w, tuple) for w in names])
    idf = np.where(df >= 2, np.log((len(docs) + 1) / df), 0.0)
    words, lengths = np.sqrt(count) * idf * ~length, count * length
    weight = words / np.maximum(words.sum(axis=1, keepdims=True), 1e-12) + reading.LENGTH_WEIGHT * lengths / lengths.sum(axis=1, keepdims=True)
    script, grade = np.array([s for _, s, _ in docs]), np.array([grades.get(i, np.nan) for i, _, _ in docs])
    held, use = ~np.isnan(grade), df >= 2
    mean, x, line, error = grade[held].mean(), np.where(held, np.nan_to_num(grade), 0.0), None, None
    active = held.astype(float)
    while True:
        word = np.where(use, (weight.T @ (x * active) + reading.PRIOR * mean) / (weight.T @ active + reading.PRIOR), mean)
        value = weight @ word / weight.sum(axis=1)
        line = {s: np.polyfit(value[held & (script == s)], grade[held & (script == s)], 1) for s in (0, 1)}
        fit = np.array([np.polyval(line[s], v) for s, v in zip(script, value, strict=True)])
        before, error = error, ((fit - grade)[held] ** 2).mean()
        if before is not None and abs(error - before) <= tolerance * before:
            return {i: f for (i, _, _), f in zip(docs, fit, strict=True)}
        x, active = np.where(held, np.nan_to_num(grade), fit), np.ones(len(docs))


@pytest.mark.parametrize("edges", [300, 10**6])
def test_blocks_against_one_table(spark, monkeypatch, edges):
    monkeypatch.setattr(reading, "BLOCK_EDGES", edges)
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "reading_label"))
    ids, texts = zip(*[(r.doc_id, r.text) for r in rows.collect()], strict=True)
    given = defaultdict(set)
    for r in labels.collect():
        if r.reading_level is not None:
            given[r.doc_id].add((r.rater, r.reading_level))
    grades = {i: np.mean([level for _, level in given[d]]) for i, d in enumerate(ids) if given[d]}
    got = {r.doc_id: r.difficulty for r in reading.fitted(rows, labels).collect()}
    want = {ids[i]: f for i, f in brute_levels(texts, grades).items()}
    assert set(got) == set(want) and max(abs(got[k] - want[k]) for k in want) < 1e-6


def test_prose_beside_addresses_stays():
    first, second = "她买了新的袋子。", "我们退了旧的货物。"
    texts = {
        1: first + second, 2: first + second + "ops@mail.example.invalid", 3: "ops@mail.example.invalid" + first + second, 4: first + "ops@mail.example.invalid" + second,
        5: first + "https://a.example/b?c=1" + second, 6: first + "a" * 100 + ".b@mail.example.invalid，" + second,
        7: "The man wrote to a@b.example. The man saw https://a.example/b. The man left now.", 8: "The man wrote to  . The man saw  . The man left now.",
        9: first + second + "a@" * 50_000, 10: first + second + "." * 100_000 + "@", 11: first + second + "http:" + "!" * 100_000,
    }
    found = taken_apart(list(texts.values()))
    got = {i: found[k][1] for k, i in enumerate(texts)}
    assert all(got[i] == got[1] for i in (2, 3, 4, 5, 6)) and got[7] == got[8]
