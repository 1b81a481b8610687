"""Test items that leaked into a corpus, found with an FM-index over each shard of the corpus.

A task turns its documents, shard by shard, into a sequence of word numbers, sorts its suffixes, and keeps the
Burrows-Wheeler transform as a wavelet matrix of packed bits with sampled suffix positions. All runs of ``words``
consecutive words of the test items are searched backwards at once; their occurrences are located by walking to
sampled positions, and overlapping ones of an item in a document are merged into spans to remove. The items are written
to the shared folder and read by the tasks in blocks bounded by their bytes; a shard is indexed once and searched for
every block.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzflow.llm.texts import spread
from quartzflow.session import scratch_path

WORDS = 10
SHARD_WORDS = 400_000
SAMPLE = 16
ITEM_BYTES = 8_000_000  # of test items in a block; a longer item makes a block of its own
_WORD = re.compile(r"[^\W_]+")
_ASCII_AND_MORE = re.compile(r"[\x00-\x7f][^\x00-\x7f]*|[^\x00-\x7f]+")


def words_of(text: str) -> list[str]:
    """Maximal runs of letters and digits after NFKC and case folding."""
    return _WORD.findall(text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold())


def word_places(text: str) -> list[tuple[int, int]]:
    """Begin and end in ``text`` of each of its words (see words_of)."""
    if text.isascii():
        return [m.span() for m in _WORD.finditer(text)]
    import regex

    parts, origin = [], []
    for m in regex.finditer(r"\X", text):
        plain = unicodedata.normalize("NFKC", m[0]).casefold()
        parts.append(plain)
        origin += [m.span()] * len(plain)
    joined = "".join(parts)
    if joined != unicodedata.normalize("NFKC", text).casefold():
        # It composes across clusters. Nothing composes with a sign of ASCII before it, so the text is cut before those.
        parts, origin = [], []
        for m in _ASCII_AND_MORE.finditer(text):
            plain = unicodedata.normalize("NFKC", m[0]).casefold()
            parts.append(plain)
            origin += [m.span()] * len(plain)
        joined = "".join(parts)
    return [(origin[m.start()][0], origin[m.end() - 1][1]) for m in _WORD.finditer(joined)]


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    s = seq[order]
    first = np.r_[True, s[1:] != s[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    alone = first & np.r_[first[1:], True]
    open_ = order[~alone]
    k = 1
    while len(open_):
        r1 = rank[open_]
        nxt = open_ + k
        r2 = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1) + 1
        key = r1 * (n + 1) + r2
        o = np.argsort(key, kind="stable")
        open_, key, r1 = open_[o], key[o], r1[o]
        at = np.arange(len(open_))
        new_key = np.r_[True, key[1:] != key[:-1]]
        new_rank = np.r_[True, r1[1:] != r1[:-1]]
        rank[open_] = r1 + np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_rank, at, 0))
        alone = new_key & np.r_[new_key[1:], True]
        open_ = open_[~alone]
        k *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of ones before i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (seq >> level) & 1
            self.bits.append(Bits(bit))
            one = bit.astype(bool)
            self.zeros.append(int(len(seq) - one.sum()))
            seq = np.concatenate([seq[~one], seq[one]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo, hi = np.zeros_like(i), i
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            a, b = bits.ones(lo), bits.ones(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in zip(self.bits, self.zeros):
            one, a = bits.get(i), bits.ones(i)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + a, i - a)
        return symbol


class FMIndex:
    """Index of documents given as lists of words. Symbol 0 ends each document."""

    def __init__(self, docs: list[list[str]], sample: int = SAMPLE):
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary
        seq: list[int] = []
        starts = []
        for words in docs:
            starts.append(len(seq))
            seq += [number.setdefault(w, len(number) + 1) for w in words]
            seq.append(0)
        x = np.array(seq, np.int64)
        self.starts = np.array(starts, np.int64)
        # For the order each end is another symbol, so no tie reaches beyond a document.
        ends = x == 0
        sa = suffix_order(np.where(ends, np.cumsum(ends) - 1, x + len(docs)))
        bwt = x[sa - 1]
        counts = np.bincount(x, minlength=len(number) + 1)
        self.first = np.r_[0, np.cumsum(counts)]
        self.bwt = WaveletMatrix(bwt, max(1, int(len(number)).bit_length()))
        # Positions are kept at regular distances and at each document's begin, so no walk passes an end.
        kept = sa % sample == 0
        kept |= np.isin(sa, self.starts)
        self.sampled = Bits(kept)
        self.positions = sa[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (rows of symbols, 0 for an unknown word) that occur: their rows and intervals of suffixes."""
        alive = np.flatnonzero((phrases > 0).all(axis=1))
        last = phrases[alive, -1]
        lo, hi = self.first[last], self.first[last + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            c = phrases[alive, j]
            both = self.bwt.rank(np.r_[c, c], np.r_[lo, hi])
            lo, hi = self.first[c] + both[: len(c)], self.first[c] + both[len(c) :]
            on = lo < hi
            alive, lo, hi = alive[on], lo[on], hi[on]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by row."""
        out = np.empty(len(rows), np.int64)
        todo, steps, row = np.arange(len(rows)), 0, rows
        while len(todo):
            there = self.sampled.get(row)
            out[todo[there]] = self.positions[self.sampled.ones(row[there])] + steps
            todo, row = todo[~there], row[~there]
            c = self.bwt.access(row)
            row = self.first[c] + self.bwt.rank(c, row)
            steps += 1
        return out


class Phrases:
    """All distinct runs of ``words`` words of some items, as numbers of their own vocabulary, and who has each."""

    def __init__(self, items: list[tuple[object, str]], words: int):
        number: dict[str, int] = {}
        runs, owners = [np.zeros((0, words), np.int64)], [np.zeros(0, np.int64)]
        for k, (_, text) in enumerate(items):
            w = np.array([number.setdefault(x, len(number)) for x in words_of(text)], np.int64)
            if len(w) >= words:
                runs.append(np.lib.stride_tricks.sliding_window_view(w, words))
                owners.append(np.full(len(w) - words + 1, k))
        self.vocabulary, self.items = list(number), [i for i, _ in items]
        self.runs, which = np.unique(np.concatenate(runs), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(owners)], axis=1), axis=0)
        self.starts = np.searchsorted(pairs[:, 0], np.arange(len(self.runs) + 1))
        self.owners = pairs[:, 1]

    def symbols(self, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Runs whose words are all in a shard, by position, and their symbols there."""
        there = np.array([vocabulary.get(w, 0) for w in self.vocabulary], np.int64)
        at = np.flatnonzero((there[self.runs] > 0).all(axis=1)) if len(self.runs) else np.zeros(0, np.int64)
        return at, there[self.runs[at]] if len(at) else np.zeros((0, self.runs.shape[1]), np.int64)


_LAST: dict[str, Phrases] = {}  # the block of the last table of items that is a single one


def item_blocks(path: str, words: int, most: int) -> Iterator[Phrases]:
    """The written items, read in blocks of at most ``most`` bytes of text."""
    if (key := f"{path} {words} {most}") in _LAST:
        yield _LAST[key]
        return
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    fs, root = pafs.FileSystem.from_uri(path)
    part, size, blocks = [], 0, 0
    for b in ds.dataset(root, filesystem=fs, format="parquet").to_batches(batch_size=256):
        for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
            if part and size + len(t) > most:
                yield Phrases(part, words)
                part, size, blocks = [], 0, blocks + 1
            part.append((i, t))
            size += len(t)
    if part:
        made = Phrases(part, words)
        if not blocks:
            _LAST.clear()
            _LAST[key] = made
        yield made


def merged(begins: np.ndarray, words: int) -> list[tuple[int, int]]:
    """Spans of words covered by runs that begin at the given sorted, distinct places."""
    cuts = np.flatnonzero(np.diff(begins) > words) + 1
    return [(int(part[0]), int(part[-1]) + words) for part in np.split(begins, cuts)]


def leaked_spans(corpus: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, words: int = WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Spans of each document that repeat ``words`` or more consecutive words of a test item.

    Result: doc, item, word_from, word_to, char_from, char_to (ends exclusive; characters of the text as it stands).
    Adjoining and overlapping matches of an item are one span. Null and empty texts, and items of fewer words, match
    nothing. Repeated documents and items each count. Places are exact but in texts that compose across grapheme
    clusters, where a span may reach to the next sign of ASCII.
    """
    doc_kind, item_kind = corpus.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"doc {doc_kind}, item {item_kind}, word_from bigint, word_to bigint, char_from bigint, char_to bigint"
    src = spread(corpus.select(F.col(doc).alias("doc"), F.col(text).alias("text")).filter("length(text) > 0"))

    path, most = scratch_path(corpus.sparkSession, "items"), ITEM_BYTES
    items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter("item is not null and text is not null").write.parquet(path)
    schema_arrow = pa.schema([("doc", _arrow(doc_kind)), ("item", _arrow(item_kind)), *[(c, pa.int64()) for c in ("word_from", "word_to", "char_from", "char_to")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, docs in _shards(batches, shard_words):
            index = FMIndex(docs)
            for phrases in item_blocks(path, words, most):
                yield _search_shard(index, ids, texts, phrases, words, schema_arrow)

    return src.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[str], list[list[str]]]]:
    ids, texts, docs, n = [], [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc").to_pylist(), b.column("text").to_pylist()):
            w = words_of(t)
            ids.append(i)
            texts.append(t)
            docs.append(w)
            n += len(w) + 1
            if n >= most:
                yield ids, texts, docs
                ids, texts, docs, n = [], [], [], 0
    if ids:
        yield ids, texts, docs


def _search_shard(index: FMIndex, ids: list, texts: list[str], phrases: Phrases, words: int, schema: pa.Schema) -> pa.RecordBatch:
    run, symbols = phrases.symbols(index.vocabulary)
    which, lo, hi = index.search(symbols)
    sizes = hi - lo
    total = int(sizes.sum())
    rows = np.repeat(lo - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(total) if total else np.zeros(0, np.int64)
    at = index.locate(rows)
    phrase = np.repeat(run[which], sizes)
    d = np.searchsorted(index.starts, at, side="right") - 1
    begin = at - index.starts[d]
    found: dict[tuple[int, int], list[int]] = {}
    for k, j, b in zip(phrase.tolist(), d.tolist(), begin.tolist()):
        for o in phrases.owners[phrases.starts[k] : phrases.starts[k + 1]].tolist():
            found.setdefault((j, o), []).append(b)
    cols: list[list] = [[], [], [], [], [], []]
    places: dict[int, list[tuple[int, int]]] = {}
    for (j, o), begins in sorted(found.items(), key=lambda x: x[0][0]):
        if j not in places:
            places = {j: word_places(texts[j])}
        for a, b in merged(np.unique(begins), words):
            for c, v in zip(cols, (ids[j], phrases.items[o], a, b, places[j][a][0], places[j][b - 1][1])):
                c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
