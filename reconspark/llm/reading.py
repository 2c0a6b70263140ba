"""Reading difficulty of documents, spread from graded examples over a document-word graph.

The graph joins each document to its words (Latin words, pairs of neighbouring Chinese characters) and to the
length classes of its sentences. Graded documents are clamped to their grade; words take the weighted mean of
their documents and documents that of their words, again and again (harmonic iterations), each time brought back
to the scale of the grades by a line per script, until the graded documents' values no longer move.

Documents lie in blocks of about a million edges, a table bucketed by block that every iteration reads where it lies.
What moves is one row for each block and each of its different words: the block's part of the word's sums goes to the
word, the sum over all blocks comes back. No table of all words exists in any one place; the driver sees a few sums of
the graded documents in each iteration.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reconspark.session import bucketed, discard, staged

#: Edges of a block, characters that are taken apart at once: both bound memory only.
BLOCK_EDGES, SLICE_CHARS = 1_000_000, 1_000_000
#: Iterations end when the mean square error of the graded documents changes by less than this part of itself.
TOLERANCE = 0.01
#: Weight of all sentence lengths of a document against all its words, and of the mean in each word's value.
LENGTH_WEIGHT, PRIOR = 0.6, 0.02
KNOTS = 50

#: Addresses, of address characters only: Chinese prose and a closing stop beside them stay.
_ADDRESS = re.compile(r"https?:[!-~]*[\"-+\-/-9<->@-~]|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]*[A-Za-z0-9]")
#: Openings of header and quotation lines, which are no prose, and the characters these begin with.
_HEADER = re.compile(r"主题|主旨|[Ss]ubject|[Rr]e\b|Ref\b|>|\[", re.ASCII)
_HEADER_STARTS = np.array(sorted(map(ord, "主SsRr>[")), np.uint32)
_ENDS = np.array(sorted(map(ord, "。！？!?\n\r")), np.uint32)
#: A word is a number of 42 bits: two for its kind (Chinese pair, Latin word, sentence length), 40 for its value.
_LATIN, _LENGTH, _BITS = 1 << 40, 2 << 40, 42


def _starts(mask: np.ndarray) -> np.ndarray:
    return np.flatnonzero(mask & ~np.append(False, mask[:-1]))


def _ends(mask: np.ndarray) -> np.ndarray:
    return np.flatnonzero(mask & ~np.append(mask[1:], False)) + 1


def _hashed(letters: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """40 bits of each run of letters, by its polynomial."""
    if not len(first):
        return np.zeros(0, np.int64)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    run = np.repeat(first, size) + at
    h = np.add.reduceat((letters[run].astype(np.uint64) | np.uint64(32)) * powers[at], np.cumsum(size) - size)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(24)).astype(np.int64)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Index of the texts with at least two sentences of prose, their script (0 Chinese, 1 Latin), and the words and
    sentence lengths of these: position in the index and word, with repeats.

    A sentence of prose has at least four Chinese characters or three Latin words and is no header line. Addresses and
    codes (letters with digits after them) are no words.
    """
    parts = [_ADDRESS.sub(" ", t) if t and ("@" in t or "http" in t) else t or "" for t in texts]
    joined = "\n".join(parts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    text_end = np.cumsum([len(p) + 1 for p in parts])
    letter = ((cp | 32) >= 97) & ((cp | 32) <= 122)
    digit = (cp >= 48) & (cp <= 57)
    word = letter | digit | (cp == 95)
    first, last = _starts(letter), _ends(letter)
    code = digit[np.minimum(last, len(cp) - 1)]
    if code.any():
        ends = _ends(word)
        until = ends[np.searchsorted(ends, first[code], "right")]
        step = np.bincount(first[code], minlength=len(cp) + 1) - np.bincount(until, minlength=len(cp) + 1)
        cp[np.cumsum(step)[:-1] > 0] = 32
        letter = ((cp | 32) >= 97) & ((cp | 32) <= 122)
        first, last = _starts(letter), _ends(letter)
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    han = ((cp >= 0x4E00) & (cp <= 0x9FFF)) | ((cp >= 0x3400) & (cp <= 0x4DBF))
    stop = np.isin(cp, _ENDS) | ((cp == 46) & np.append(space[1:], True))
    sentence = np.cumsum(stop) - stop
    n = int(sentence[-1]) + 1
    end = np.flatnonzero(stop)
    begin = np.append(0, end[:-1] + 1)
    z, e = np.bincount(sentence[han], minlength=n), np.bincount(sentence[first], minlength=n)
    good = (z >= 4) | (e >= 3)
    solid = np.flatnonzero(~space)
    lead = solid[np.searchsorted(solid, begin[good])] if good.any() else np.zeros(0, np.int64)
    which = np.flatnonzero(good)
    odd = np.isin(cp[lead], _HEADER_STARTS)
    for s, at in zip(which[odd], lead[odd], strict=True):
        if _HEADER.match("".join(map(chr, cp[at : at + 8]))):
            good[s] = False
    which = np.flatnonzero(good)
    of = np.searchsorted(text_end, begin, "right")
    many = np.bincount(of[which], minlength=len(texts))
    index = np.flatnonzero(many >= 2)
    place = np.full(len(texts), -1)
    place[index] = np.arange(len(index))
    good &= many[of] >= 2
    which = np.flatnonzero(good)
    doc = place[of]
    zd, ed = np.bincount(doc[which], z[which], len(index)), np.bincount(doc[which], e[which], len(index))
    pair = np.flatnonzero(han[:-1] & han[1:] & good[sentence[:-1]])
    packed = np.where(cp < 0x4E00, cp.astype(np.int64) - 0x3400, cp.astype(np.int64) - 0x4E00 + 0x19C0)
    kept = good[sentence[first]]
    size = (last - first)[kept]
    length = np.where(z[which] >= 4, z[which], e[which])
    grade = np.rint(np.log2(np.maximum(length, 1)) * 3).astype(np.int64) + np.where(z[which] >= 4, 0, 1 << 20)
    where = np.concatenate([doc[sentence[pair]], doc[sentence[first[kept]]], doc[which]])
    what = np.concatenate([packed[pair] << 15 | packed[pair + 1], _hashed(cp, first[kept], size) | _LATIN, grade | _LENGTH])
    return index, (zd < 3 * ed).astype(np.int64), where, what


def _number(values: np.ndarray) -> np.ndarray:
    """The same whole numbers, none of them negative, in as few bytes as hold the greatest."""
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def _packed(values: np.ndarray) -> bytes:
    small = _number(values)
    return bytes([small.itemsize]) + small.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Keys and texts of about SLICE_CHARS characters at once."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        ends = np.cumsum([len(t or "") for t in texts])
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
            yield batch.column(0).slice(at, upto - at), texts[at:upto]
            at = upto


def document_blocks(docs: DataFrame) -> DataFrame:
    """block, keys, script, sizes (edges of each document), edges (places in words), counts, words, seen (documents of the
    block with the word): the documents of `docs` (doc_id, text) with at least two sentences of prose, in blocks.

    Documents stay in their partition; a block is closed at BLOCK_EDGES, so its size does not depend on that of the table.
    """
    kind = dict(docs.dtypes)["doc_id"]
    names = ["block", "keys", "script", "sizes", "edges", "counts", "words", "seen"]

    def one(number: int, parts: list[tuple]) -> pa.RecordBatch:
        keys = pa.concat_arrays([p[0] for p in parts])
        word, count = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        words, edge = np.unique(word, return_inverse=True)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (keys, pa.array(words), pa.array(np.bincount(edge, minlength=len(words)).astype(np.int64)))]
        blobs = [pa.array([_packed(v)], pa.binary()) for v in (np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), edge, count)]
        return pa.RecordBatch.from_arrays([pa.array([number]), lists[0], *blobs, *lists[1:]], names=names)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for keys, texts in _slices(batches):
            index, script, doc, word = words_of(texts)
            if not len(index):
                continue
            edge, count = np.unique(doc << _BITS | word, return_counts=True)
            parts.append((keys.take(pa.array(index)), script, np.bincount(edge >> _BITS, minlength=len(index)), edge & ((1 << _BITS) - 1), count))
            held += len(edge)
            if held >= BLOCK_EDGES:
                yield one(number, parts)
                number, parts, held = number + 1, [], 0
        if parts:
            yield one(number, parts)

    return docs.select("doc_id", "text").mapInArrow(make, f"block bigint, keys array<{kind}>, script binary, sizes binary, edges binary, counts binary, words array<bigint>, seen array<bigint>")


class _Block:
    """The graph of one block: for each edge its document, word and weight; for each document its grade and script."""

    def __init__(self, row: dict, documents: int):
        self.script, sizes, self.edge, count = (_unpacked(row[c]) for c in ("script", "sizes", "edges", "counts"))
        self.n, self.words, count = len(sizes), np.asarray(row["words"]), count.astype(float)
        self.doc = np.repeat(np.arange(self.n), sizes)
        self.grade = np.full(self.n, np.nan)
        if row["graded"] is not None:
            self.grade[row["graded"]] = row["grades"]
        self.place = np.asarray(row["place"] if row["place"] is not None else [], np.int64)
        idf = np.zeros(len(self.words))
        idf[self.place] = np.log((documents + 1) / np.asarray(row["total"] if row["total"] is not None else []))
        length = (self.words >> 40 == 2)[self.edge]
        self.weight = np.where(length, count, np.sqrt(count) * idf[self.edge])
        for kind, share in ((length, LENGTH_WEIGHT), (~length, 1.0)):
            whole = np.bincount(self.doc[kind], self.weight[kind], self.n)
            self.weight[kind] *= share / np.maximum(whole[self.doc[kind]], 1e-12)
        self.free = np.isnan(self.grade)

    def values(self, words: np.ndarray) -> np.ndarray:
        """The weighted mean of each document's words."""
        total = np.bincount(self.doc, self.weight, self.n)
        return np.bincount(self.doc, self.weight * words[self.edge], self.n) / np.maximum(total, 1e-12)

    def sums(self, docs: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Weighted sums of the chosen documents' values for each word that other documents have too."""
        return np.bincount(self.edge, self.weight * np.where(docs, value, 0.0)[self.doc], len(self.words))[self.place]


#: Sums over graded documents of a script: number, value, grade, value squared, value times grade, grade squared.
_STATS = 6


def _words(block: _Block, row: dict, state: dict) -> np.ndarray:
    """Values of the block's words from the sums over all blocks; words of a single document keep the mean."""
    words = np.full(len(block.words), state["mean"])
    if row["held_top"] is None:
        return words
    top, bottom = np.asarray(row["held_top"]) + PRIOR * state["mean"], np.asarray(row["held_bottom"]) + PRIOR
    if state["lines"] and row["u0"] is not None:
        for s, (slope, base) in enumerate(state["lines"]):
            free = np.asarray(row[f"free{s}"])
            top, bottom = top + slope * np.asarray(row[f"u{s}"]) + base * free, bottom + free
    words[block.place] = top / bottom
    return words


def _lines(stats: np.ndarray) -> list[tuple[float, float]]:
    """Slope and intercept from value to grade for each script; the pooled line where a script has too few grades."""

    def line(s: np.ndarray) -> tuple[float, float] | None:
        n, g, y, gg, gy = s[:5]
        spread = gg - g * g / n if n else 0
        return None if n < 3 or spread <= 1e-12 else ((gy - g * y / n) / spread, y / n - (gy - g * y / n) / spread * g / n)

    pooled = line(stats.sum(axis=0)) or (0.0, stats[:, 2].sum() / max(stats[:, 0].sum(), 1))
    return [line(s) or pooled for s in stats]


def _error(stats: np.ndarray, lines: list[tuple[float, float]]) -> float:
    """Mean square of what the lines leave of the grades."""
    left = [yy - 2 * a * gy - 2 * b * y + a * a * gg + 2 * a * b * g + n * b * b for (n, g, y, gg, gy, yy), (a, b) in zip(stats, lines, strict=True)]
    return sum(left) / max(stats[:, 0].sum(), 1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                cell = batch.column(name)[i]
                listed = pa.types.is_list(cell.type) and cell.is_valid
                row[name] = cell.values if listed and name == "keys" else cell.values.to_numpy(zero_copy_only=False) if listed else cell.as_py()
            yield row


def _shared(parts: DataFrame, columns: tuple[str, ...], least: str | None = None) -> DataFrame:
    """block, place and `columns` as arrays: each word's columns summed over all blocks, back in every block that has it.

    `parts` has block, place, word and columns. With `least`, words below two in this column do not come back.
    """
    over = W.partitionBy("word")
    total = parts.select("block", "place", *[F.sum(c).over(over).alias(c) for c in columns])
    total = total if least is None else total.where(F.col(least) >= 2)
    lists = total.groupBy("block").agg(F.collect_list(F.struct("place", *columns)).alias("__x"))
    return lists.select("block", F.col("__x.place").alias("place"), *[F.col(f"__x.{c}").alias(c) for c in columns])


def _ordered(parts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """_shared with its arrays in order of place, so that they lie beside one another."""
    back = _shared(parts, columns).withColumn("__x", F.array_sort(F.arrays_zip("place", *columns)))
    return back.select("block", *[F.col(f"__x.{c}").alias(c) for c in columns])


def fitted(docs: DataFrame, labels: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, grade (null without any) and difficulty (double, on the scale of the labels by a line per script).

    `docs` has doc_id and text, `labels` doc_id, rater and reading_level with repeats and nulls; a document's grade is the
    mean over its distinct (rater, level) rows. Documents with fewer than two sentences of prose (null, blank, tables,
    codes) have no row. Without any graded document of prose there is no scale and no row comes out. Words of a single
    document join nothing and are left out of the graph; all other words and all documents take part, none is sampled or
    merged. Graded documents get the value that their words give them. The iterations end when the mean square error of
    the graded documents changes by less than `tolerance` of itself.
    """
    kind = dict(docs.dtypes)["doc_id"]
    blocks = bucketed(document_blocks(docs), "block", "reading_blocks")
    documents = blocks.agg(F.sum(F.size("keys"))).first()[0] or 0
    grades = labels.select("doc_id", "rater", F.col("reading_level").cast("double").alias("__l")).where("__l is not null").distinct().groupBy("doc_id").agg(F.avg("__l").alias("grade"))
    graded = blocks.select("block", F.posexplode("keys").alias("__at", "doc_id")).join(grades, "doc_id").groupBy("block").agg(F.collect_list(F.struct("__at", "grade")).alias("__x"))
    graded = graded.select("block", F.col("__x.__at").alias("graded"), F.col("__x.grade").alias("grades"))
    seen = blocks.select("block", F.posexplode(F.arrays_zip("words", "seen")).alias("place", "__w")).select("block", "place", F.col("__w.words").alias("word"), F.col("__w.seen").alias("total"))
    common = _shared(seen, ("total",), least="total").withColumn("__x", F.array_sort(F.arrays_zip("place", "total"))).select("block", F.col("__x.place").alias("place"), F.col("__x.total").alias("total"))
    facts = staged(common.join(graded, "block", "full_outer"), "reading-facts")
    columns = ("held_top", "held_bottom", "free0", "free1")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            b = _Block(row, documents)
            held, ones = ~b.free, np.ones(b.n)
            sums = [b.sums(held, np.nan_to_num(b.grade)), b.sums(held, ones), b.sums(b.free & (b.script == 0), ones), b.sums(b.free & (b.script == 1), ones)]
            yield out(row, b, [float(held.sum()), float(b.grade[held].sum())], sums, columns)

    def out(row: dict, b: _Block, stats: list[float], sums: list[np.ndarray], names: tuple[str, ...]) -> pa.RecordBatch:
        lists = [pa.array([v]) for v in (stats, b.place, b.words[b.place], *sums)]
        return pa.RecordBatch.from_arrays([pa.array([row["block"]]), *lists], names=["block", "stats", "place", "word", *names])

    def schema(names: tuple[str, ...]) -> str:
        return "block bigint, stats array<double>, place array<bigint>, word array<bigint>, " + ", ".join(f"{c} array<double>" for c in names)

    def run(known: DataFrame, step, names: tuple[str, ...], size: int) -> tuple[DataFrame, np.ndarray]:
        made = staged(blocks.join(known, "block", "left").mapInArrow(step, schema(names)), "reading-sums")
        total = made.agg(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0.0)) for i in range(size)]).first()
        return made, np.array(total, float)

    def tall(made: DataFrame, names: tuple[str, ...]) -> DataFrame:
        return made.select("block", F.inline(F.arrays_zip("place", "word", *names)))

    made, (held, grade_sum) = run(facts, first, columns, 2)
    if not held:
        return docs.where("false").select("doc_id", F.lit(None).cast("double").alias("grade"), F.lit(0.0).alias("difficulty"))
    fixed = staged(facts.join(_ordered(tall(made, columns), columns), "block", "left"), "reading-fixed")
    for old in (facts, made):
        discard(old)
    none = F.lit(None).cast("array<double>")
    state, known, error, back = {"mean": grade_sum / held, "lines": None}, fixed.withColumns({"u0": none, "u1": none}), None, None
    while True:

        def step(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                b = _Block(row, documents)
                value = b.values(_words(b, row, state))
                stats = []
                for s in (0, 1):
                    here = ~b.free & (b.script == s)
                    v, y = value[here], b.grade[here]
                    stats += [float(x) for x in (len(v), v.sum(), y.sum(), (v * v).sum(), (v * y).sum(), (y * y).sum())]
                yield out(row, b, stats, [b.sums(b.free & (b.script == s), value) for s in (0, 1)], ("u0", "u1"))

        made, total = run(known, step, ("u0", "u1"), 2 * _STATS)
        stats = total.reshape(2, _STATS)
        lines, before = _lines(stats), error
        error = _error(stats, lines)
        if before is not None and abs(error - before) <= tolerance * before:
            break
        used, back = back, staged(_ordered(tall(made, ("u0", "u1")), ("u0", "u1")), "reading-back")
        known, state = fixed.join(back, "block", "left"), {"mean": state["mean"], "lines": lines}
        for old in (made, used):
            if old is not None:
                discard(old)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, base = np.array([a for a, _ in lines]), np.array([b for _, b in lines])
        for row in _rows(batches):
            b = _Block(row, documents)
            value = slope[b.script] * b.values(_words(b, row, state)) + base[b.script]
            yield pa.RecordBatch.from_arrays([row["keys"], pa.array(b.grade, from_pandas=True), pa.array(value)], names=["doc_id", "grade", "difficulty"])

    rated = staged(blocks.join(known, "block", "left").mapInArrow(finish, f"doc_id {kind}, grade double, difficulty double"), "reading-values")
    for old in (made, back, fixed, blocks):
        if old is not None:
            discard(old)
    return rated


def reading_levels(docs: DataFrame, labels: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, difficulty (double, 1 to 5) and reading_level (bigint, 1 to 5) of every document that fitted() rates.

    The values' distribution over the graded documents is brought to that of the grades, through approximate percentiles
    (a mergeable sketch, off by at most a ten-thousandth of the ranks). Without any grade no row comes out.
    """
    rated = fitted(docs, labels, tolerance)
    at = F.array(*[F.lit(i / KNOTS) for i in range(KNOTS + 1)])
    knots = rated.where("grade is not null").agg(F.percentile_approx("difficulty", at, F.lit(10_000)).alias("x"), F.percentile_approx("grade", at, F.lit(10_000)).alias("y")).first()
    if knots.x is None:
        return rated.select("doc_id", "difficulty", F.lit(0).cast("long").alias("reading_level"))
    level = _interpolated(F.col("difficulty"), list(knots.x), list(knots.y))
    found = rated.select("doc_id", F.least(F.greatest(level, F.lit(1.0)), F.lit(5.0)).alias("difficulty"))
    return found.withColumn("reading_level", F.round("difficulty").cast("long"))


def _interpolated(value: Column, x: list[float], y: list[float]) -> Column:
    """Piecewise linear through the knots, which bring the values' distribution to that of the grades."""
    out = F.lit(float(y[-1]))
    for k in range(len(x) - 1, 0, -1):
        part = F.lit(float(y[k - 1])) if x[k] <= x[k - 1] else F.lit(float(y[k - 1])) + (value - x[k - 1]) * ((y[k] - y[k - 1]) / (x[k] - x[k - 1]))
        out = F.when(value < x[k], part).otherwise(out)
    return F.when(value <= x[0], F.lit(float(y[0]))).otherwise(out)
