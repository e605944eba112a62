"""Evaluation passages in training text: seeds, Karp-Rabin runs and greedy string tiling.

Windows of as many words as the shortest match that counts are hashed with a rolling polynomial. Windows that a test item
shares with a document are seeds; each pair of document and item with a seed is then tiled: the longest unmarked match is
marked, again and again, until none is long enough. Tiles are compared word by word, so a hash collision adds nothing.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from aerolake.functions.frames import typed_frame
from aerolake.session import materialize

WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash
SENT_WORDS = 2_000_000  # words of test items that are sent to the workers; beyond it the seeds are joined by a shuffle
BLOCK_CHARS = 4_000_000
KNOWN_WORDS = 1_000_000
PAIR_BLOCK = 2_000_000  # pairs of equal windows looked at together
BLOOM_BITS = 26  # the filter sent to workers has 2^26 bits (8 MB), whatever the items

PAIRS = "doc_id long, item_id long, longest int, n_tiles int, coverage double"


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORD.findall(text.lower()) if text else []


def window_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """The rolling hash of every window of ``k`` word codes (modulo 2^64)."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * BASE + codes[j : j + n]
    return out ^ (out >> np.uint64(29))


class _Codes(dict):
    """Word -> 64-bit code, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = code = xxh3_64_intdigest(word)
        return code


class Coded:
    """A text as word codes, with the hashes of its windows and their order, made once and when first needed."""

    def __init__(self, codes: np.ndarray, least: int):
        self.codes, self.least = codes, least

    @cached_property
    def hashes(self) -> np.ndarray:
        return window_hashes(self.codes, self.least)

    @cached_property
    def ranked(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.hashes, kind="stable")
        return order, self.hashes[order]


def match_runs(doc: Coded, item: Coded) -> list[tuple[int, int, int]]:
    """All maximal runs of equal words: (place in doc, place in item, length), of at least ``least`` words.

    Windows of ``least`` words are compared by their rolling hashes; a run begins at a pair of equal windows whose neighbours
    before differ, and ends at one whose neighbours behind do. Pairs are made block by block, and only beginnings and ends
    are kept, so a text of one repeated word takes time but no memory.
    """
    hd, hi, least = doc.hashes, item.hashes, doc.least
    if not len(hd) or not len(hi):
        return []
    order, ranked = item.ranked
    low = np.searchsorted(ranked, hd, "left")
    many = np.searchsorted(ranked, hd, "right") - low
    at = np.flatnonzero(many)
    if not len(at):
        return []
    block = np.cumsum(many[at]) // PAIR_BLOCK
    heads, tails = [], []
    for part in np.split(at, np.flatnonzero(np.diff(block)) + 1):
        n = many[part]
        d = np.repeat(part, n)
        i = order[np.repeat(low[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        goes_back = (d > 0) & (i > 0) & (hd[np.maximum(d - 1, 0)] == hi[np.maximum(i - 1, 0)])
        goes_on = (d + 1 < len(hd)) & (i + 1 < len(hi)) & (hd[np.minimum(d + 1, len(hd) - 1)] == hi[np.minimum(i + 1, len(hi) - 1)])
        heads.append(np.column_stack([d - i, d])[~goes_back])
        tails.append(np.column_stack([d - i, d])[~goes_on])
    # on each diagonal beginnings and ends alternate
    head, tail = (x[np.lexsort((x[:, 1], x[:, 0]))] for x in (np.concatenate(heads), np.concatenate(tails)))
    runs = [(int(d), int(d - diagonal), int(e - d) + least) for (diagonal, d), (_, e) in zip(head, tail, strict=True)]
    return [(d, i, n) for d, i, n in runs if np.array_equal(doc.codes[d : d + n], item.codes[i : i + n])]


def tiles(doc: list[str], item: list[str], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length) of the longest matches, none overlapping another.

    The longest run whose words are all unmarked is marked, again and again; what marks leave of a run of at least ``least``
    words is a run again. Ties go to the match that comes first in the document, then in the item.
    """
    codes = _Codes()
    return tile_runs(*[Coded(np.array([codes[w] for w in ws], np.uint64), least) for ws in (doc, item)])


def tile_runs(doc: Coded, item: Coded) -> list[tuple[int, int, int]]:
    """As :func:`tiles`, of coded texts."""
    least = doc.least
    heap = [(-n, d, i) for d, i, n in match_runs(doc, item)]
    if len(heap) == 1:
        return [(heap[0][1], heap[0][2], -heap[0][0])]
    heapq.heapify(heap)
    used_d, used_i, out = np.zeros(len(doc.codes), bool), np.zeros(len(item.codes), bool), []
    while heap:
        n, d, i = heapq.heappop(heap)
        n = -n
        taken = used_d[d : d + n] | used_i[i : i + n]
        if not taken.any():
            out.append((d, i, n))
            used_d[d : d + n] = used_i[i : i + n] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (a - b, d + a, i + a))
    return out


def _tile_pair(doc_id: int, doc: Coded, item_id: int, item: Coded) -> tuple:
    got = tile_runs(doc, item)
    return doc_id, item_id, max((n for *_, n in got), default=0), len(got), sum(n for *_, n in got) / max(len(item.codes), 1)


class _Seeds:
    """Sorted window hashes of the test items."""

    def __init__(self, items: list[tuple[int, list[str]]], k: int):
        codes = _Codes()
        self.k, self.items = k, {i: Coded(np.array([codes[x] for x in w], np.uint64), k) for i, w in items}
        hashes, owners = [], []
        for item_id, item in self.items.items():
            h = np.unique(item.hashes)
            hashes.append(h)
            owners.append(np.full(len(h), item_id, np.int64))
        h, o = (np.concatenate(hashes), np.concatenate(owners)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners = h[order], o[order]
        self.filter = np.zeros(1 << 20, bool)  # by the top 20 bits, to pass over most windows at once
        self.filter[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into h, item) of all seeds."""
        at = np.flatnonzero(self.filter[(h >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.hashes, h[at], "left")
        many = np.searchsorted(self.hashes, h[at], "right") - low
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.owners[np.repeat(low, many) + within]


def _windows(texts: list[str | None], k: int, codes: _Codes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Word codes of each text, window hashes and the text each window belongs to; no window spans two texts."""
    split = [words(t) for t in texts]
    size = np.array([len(w) for w in split])
    flat = np.fromiter((codes[w] for ws in split for w in ws), np.uint64, int(size.sum()))
    h = window_hashes(flat, k)
    owner = np.repeat(np.arange(len(split)), size)
    same = owner[: len(h)] == owner[k - 1 :] if len(h) else np.zeros(0, bool)
    return np.split(flat, np.cumsum(size)[:-1]) if len(split) else [], h[same], owner[: len(h)][same]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= BLOCK_CHARS):
            size += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def find_leaks(documents: DataFrame, items: DataFrame, least: int = 13, sent_words: int = SENT_WORDS) -> DataFrame:
    """Pairs of document and item with at least one tile: ``doc_id, item_id, longest, n_tiles, coverage``.

    documents: ``doc_id, text``; items: ``item_id, passage``; others are ignored. ``least``: words of the shortest tile;
    ``longest``: words of the longest; ``coverage``: the share of the passage's words under tiles, whatever their order.
    Null, empty and wordless texts and passages, and passages of fewer than ``least`` words, have no pair; repeated
    documents each have their own; repeated items too; empty tables give an empty one. Whole texts are read.

    Scale: one pass over the documents without a shuffle while the items have at most ``sent_words`` words (counted
    first). Beyond it the items' windows are a table and the documents' windows are joined to it by hash; windows that
    no item has are dropped by 8 MB of bits before the shuffle, and exactly in the join; pairs are made distinct, and only
    their texts meet again for the tiling.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tests = items.select(F.col("item_id").cast("long"), F.col("passage").cast("string")).filter("passage is not null")
    total = tests.agg(F.sum(F.size(F.split("passage", r"[^\p{L}\p{N}]+"))).alias("n")).first()["n"] or 0

    def tiled(rows: list[tuple]) -> pd.DataFrame:
        return typed_frame([r for r in rows if r[2] >= least], PAIRS)

    if total <= sent_words:
        held = [(r["item_id"], w) for r in tests.toLocalIterator() if len(w := words(r["passage"])) >= least]
        shared = spark.sparkContext.broadcast(_Seeds(held, least))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds, codes = shared.value, _Codes()
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                rows = []
                for a, b in _blocks(texts):
                    split, h, owner = _windows(texts[a:b], least, codes)
                    at, item = seeds.hits(h)
                    coded: dict[int, Coded] = {}
                    for d, i in sorted(set(zip(owner[at].tolist(), item.tolist(), strict=True))):
                        doc = coded.setdefault(d, Coded(split[d], least))
                        rows.append(_tile_pair(ids[a + d], doc, i, seeds.items[i]))
                yield pa.RecordBatch.from_pandas(tiled(rows), preserve_index=False)

        return docs.mapInArrow(scan, PAIRS)

    def hashed(bits: Broadcast | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            codes = _Codes()
            for pdf in batches:
                key, texts = pdf.iloc[:, 0].to_numpy(), pdf.iloc[:, 1].tolist()
                for a, b in _blocks(texts):
                    _, h, owner = _windows(texts[a:b], least, codes)
                    if bits is not None:
                        place = (h >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)
                        asked = ((bits.value[place >> 5] >> (place & 31).astype(np.uint32)) & 1).astype(bool)
                        h, owner = h[asked], owner[asked]
                    yield pd.DataFrame({"key": key[a:b][owner], "h": h.view(np.int64)}).drop_duplicates()

        return run

    item_windows = materialize(tests.mapInPandas(hashed(None), "key long, h long").select(F.col("key").alias("item_id"), "h"), "windows")
    place = F.shiftrightunsigned("h", 64 - BLOOM_BITS)
    words_of = item_windows.select(F.shiftright(place, 5).cast("int").alias("word"), place.bitwiseAND(31).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    bits = np.zeros(1 << (BLOOM_BITS - 5), np.uint32)
    for r in words_of.toLocalIterator():
        bits[r["word"]] = r["bits"]
    doc_windows = docs.mapInPandas(hashed(spark.sparkContext.broadcast(bits)), "key long, h long").select(F.col("key").alias("doc_id"), "h")
    pairs = doc_windows.join(item_windows, "h").select("doc_id", "item_id").distinct()

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        coded = lambda t: Coded(np.array([codes[w] for w in words(t)], np.uint64), least)
        for pdf in batches:
            yield tiled([_tile_pair(d, coded(t), i, coded(p)) for d, t, i, p in zip(pdf["doc_id"], pdf["text"], pdf["item_id"], pdf["passage"], strict=True)])

    return pairs.join(docs, "doc_id").join(tests, "item_id").select("doc_id", "text", "item_id", "passage").mapInPandas(tile, PAIRS)


def leaked(documents: DataFrame, items: DataFrame, run: int = 13) -> DataFrame:
    """Documents that hold at least ``run`` successive words of an item's passage: ``doc_id, item_id``."""
    return find_leaks(documents, items, least=run).filter(F.col("longest") >= run).select("doc_id", "item_id").distinct()


def covered(documents: DataFrame, items: DataFrame, least: int = 5, run: int = 13, coverage: float = 0.8) -> DataFrame:
    """Leaks in any order: pairs with a run of 13 words, or with tiles of five words and more over 0.8 of the passage."""
    return find_leaks(documents, items, least=least).filter((F.col("longest") >= run) | (F.col("coverage") >= coverage))
