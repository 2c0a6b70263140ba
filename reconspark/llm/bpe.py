"""Byte-pair encoding of whole texts in linear time, with a vocabulary file of a public tokenizer.

A text is cut by the vocabulary's pattern; the bytes of each piece are read as Latin-1, an Aho-Corasick automaton
finds the longest token at every byte, and a backtracking pass keeps a token only if it may stand after the one
before it. Whether two tokens may stand side by side depends on them alone and is memoised. The accepted sequence
is the one that applying the merges in order gives.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

try:
    import public_tokenizers
except ImportError:  # another folder is then given by parameter
    public_tokenizers = None

#: Pieces and parts that each worker remembers with their ids, and pairs with their verdict; all start anew when full.
PIECES_KEPT, PAIRS_KEPT = 200_000, 2_000_000


def vocabulary(name: str = "byte_bpe_50k.tiktoken", path: str | None = None) -> tuple[bytes, str]:
    """The bytes of a rank file and its cutting pattern; `path` overrides the installed place."""
    place = path or public_tokenizers.path(name)
    with open(place, "rb") as f:
        return f.read(), getattr(public_tokenizers, "PATTERN", r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Encoder:
    """Encodes pieces by backtracking over longest matches."""

    def __init__(self, ranks: bytes, pattern: str):
        import ahocorasick
        import regex

        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.token_of = {base64.b64decode(t).decode("latin-1"): int(r) for t, r in pairs}
        by_rank = sorted(self.token_of.items(), key=lambda kv: kv[1])
        self.size = {r: len(t) for t, r in by_rank}
        self.cut = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for t, r in by_rank:
            self.automaton.add_word(t, (len(t), r))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}  # the longest token that is a proper prefix
        self.halves: dict[int, tuple[int, int]] = {}  # the two tokens whose merge makes a token
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.parts: dict[str, list[int]] = {}
        self.apart: dict[str, bool] = {}  # two characters: whether no token holds the bytes where they meet
        self.joint = {t[i : i + 2] for t in self.token_of for i in range(len(t) - 1)}
        for t, r in by_rank:
            cut = next((t[:n] for n in range(len(t) - 1, 0, -1) if t[:n] in self.token_of), None)
            if cut is not None:
                self.shorter[r] = self.token_of[cut]
            self.halves[r] = self._halves(t, r)

    def _halves(self, text: str, rank: int) -> tuple[int, int]:
        for n in range(len(text) - 1, 0, -1):
            a, b = self.token_of.get(text[:n]), self.token_of.get(text[n:])
            if a is not None and b is not None and a < rank and b < rank and self._compatible(a, b):
                self.merged[a, b] = rank
                return a, b
        return rank, rank

    def _compatible(self, a: int, b: int) -> bool:
        """Whether a and b stay apart: no merge across their border comes before the merges inside them."""
        merged, halves, bound = self.merged, self.halves, 1 << 60
        while True:
            if merged.get((a, b), bound) < bound:
                return False
            if a > b:
                bound, inner = a, halves[a][1]
                if inner == a:
                    bound, inner = b + 1, halves[b][0]
                    if inner == b:
                        return True
                    b = inner
                else:
                    a = inner
            else:
                bound, inner = b + 1, halves[b][0]
                if inner == b:
                    bound, inner = a, halves[a][1]
                    if inner == a:
                        return True
                    a = inner
                else:
                    b = inner

    def _meet(self, pair: str) -> bool:
        """Whether two characters stay apart whatever stands around them."""
        u, v = (c.encode("utf-8", "surrogatepass").decode("latin-1") for c in pair)
        found = self.apart[pair] = u[-1] + v[0] not in self.joint
        return found

    def _piece(self, piece: str) -> list[int]:
        if piece.isascii():
            return self._part(piece)
        if len(self.apart) > PAIRS_KEPT:
            self.apart.clear()
        ids: list[int] = []
        apart, parts, start, n = self.apart, self.parts, 0, len(piece)
        for i in range(1, n + 1):
            if i < n:
                pair = piece[i - 1 : i + 1]
                cut = apart.get(pair)
                if cut is None:
                    cut = self._meet(pair)
                if not cut:
                    continue
            part = piece[start:i]
            found = parts.get(part)
            if found is None:
                found = self._part(part)
                if len(part) <= 64:
                    if len(parts) >= PIECES_KEPT:
                        parts.clear()
                    parts[part] = found
            ids += found
            start = i
        return ids

    def _part(self, part: str) -> list[int]:
        text = part.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.token_of.get(text)
        if whole is not None:
            return [whole]
        n = len(text)
        longest = [0] * n
        for end, (size, rank) in self.automaton.iter(text):
            longest[end - size + 1] = rank  # ends come in order, so the last one is the longest
        open_at, pairs, size, shorter = bytearray(b"\x01") * (n + 1), self.pairs, self.size, self.shorter
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = ids[-1] if ids else -1
            while True:
                end = at + size[token]
                if open_at[end]:
                    if last < 0:
                        fits = True
                    else:
                        fits = pairs.get((last, token))
                        if fits is None:
                            fits = pairs[last, token] = self._compatible(last, token)
                    if fits:
                        ids.append(token)
                        at = end
                        token = longest[at] if at < n else 0
                        break
                if token in shorter:
                    token = shorter[token]
                else:
                    open_at[at] = 0
                    ids.pop()
                    at -= size[last]
                    token = last
                    break
        if len(pairs) > PAIRS_KEPT:
            pairs.clear()
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens; an empty list for null and empty text."""
        ids: list[int] = []
        pieces = self.pieces
        for piece in self.cut(text) if text else ():
            found = pieces.get(piece)
            if found is None:
                found = self._piece(piece)
                if len(piece) <= 64:
                    if len(pieces) >= PIECES_KEPT:
                        pieces.clear()
                    pieces[piece] = found
            ids += found
        return ids


_ENCODERS: dict[int, Encoder] = {}


def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    key = hash((ranks, pattern))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


def token_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """The key and `ids` (array<int>) of every row, in place: nothing is shuffled and no text is cut short.

    Empty and null texts have the empty list; strings that look like special tokens are ordinary text. Repeated
    keys come out as often as they go in. The vocabulary, under 2 MB, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab or vocabulary())
    kind = dict(docs.dtypes)[key]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for batch in batches:
            ids = [encoder.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def token_counts(docs: DataFrame, keep: tuple[str, ...], text: str = "text", vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """The columns `keep` and `tokens` (int), the length of each text in tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab or vocabulary())
    kinds = dict(docs.dtypes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for batch in batches:
            n = pa.array([len(encoder.encode(t.as_py())) for t in batch.column(len(keep))], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], names=[*keep, "tokens"])

    return docs.select(*keep, text).mapInArrow(count, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", tokens int")
