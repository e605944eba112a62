"""Byte-pair encoding of a corpus by recursive SQL in DuckDB, inside each partition.

Texts are split into pieces by the tokenizer's pattern. The pieces that a worker hasn't met become token-position rows of
a DuckDB table; a recursive query joins adjacent tokens with the merge table, contracts the leftmost pair of the smallest
rank in each piece, and repeats until no pair merges; an ordered aggregation gives each piece's ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_CHARS = 2_000_000  # text encoded at a time
CACHE_PIECES = 500_000  # a worker's memory of encoded pieces; it is emptied beyond that, which changes no result
LONG_PIECE = 4096  # bytes; the recursion takes a round per merged rank, so longer pieces are merged with a heap

_RECURSION = """
WITH RECURSIVE state AS (
    SELECT word, pos, tok, 0 AS round FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN merged ELSE tok END AS tok, round + 1
    FROM (
        SELECT *, coalesce(lag(taken) OVER (PARTITION BY word ORDER BY pos), false) AS eaten
        FROM (
            -- in a stretch of overlapping hits (as in aaa) every other one is taken, from the left
            SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, stretch ORDER BY pos) % 2 = 1 AS taken
            FROM (
                SELECT *, place - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS stretch
                FROM (
                    SELECT *, coalesce(rank = best, false) AS hit
                    FROM (
                        SELECT p.*, m.rank, m.merged, min(m.rank) OVER (PARTITION BY p.word) AS best
                        FROM (
                            SELECT word, pos, tok, round, lead(tok) OVER w AS next, row_number() OVER w AS place
                            FROM state WINDOW w AS (PARTITION BY word ORDER BY pos)
                        ) p LEFT JOIN merges m ON p.tok = m.first AND p.next = m.second
                    ) WHERE best IS NOT NULL
                )
            )
        )
    ) WHERE NOT eaten
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM (SELECT * FROM state QUALIFY round = max(round) OVER (PARTITION BY word))
GROUP BY word ORDER BY word
"""


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file: itself if printable, else 256 and on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


def load_vocabulary(path: str) -> dict[str, np.ndarray]:
    """Id of every byte and the merge table (first, second, merged, rank), from a tokenizer's json file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    table = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int32)
    return {"bytes": np.array([ids[c] for c in _byte_letters()], np.int32), "first": table[:, 0], "second": table[:, 1], "merged": table[:, 2], "rank": np.arange(len(table), dtype=np.int32)}


class Encoder:
    """Encodes pieces; one per worker and vocabulary."""

    def __init__(self, vocabulary: dict[str, np.ndarray]):
        import duckdb
        import regex

        self.split = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.bytes = vocabulary["bytes"]
        self.merges = pa.table({k: vocabulary[k] for k in ("first", "second", "merged", "rank")})
        self.known: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[tuple[int, int], tuple[int, int]] | None = None
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        self.con.register("merges_arrow", self.merges)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_arrow")

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that aren't known yet."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG_PIECE]
        for i, b in enumerate(raw):
            if len(b) > LONG_PIECE:
                self.known[pieces[i]] = self.by_heap(b)
        if not short:
            return
        size = np.array([len(raw[i]) for i in short])
        offs = np.concatenate([[0], np.cumsum(size)])
        tok = self.bytes[np.frombuffer(b"".join(raw[i] for i in short), np.uint8)]
        start = pa.table({"word": np.repeat(np.arange(len(short), dtype=np.int32), size), "pos": (np.arange(offs[-1]) - np.repeat(offs[:-1], size)).astype(np.int32), "tok": tok.astype(np.int32)})
        self.con.register("start", start)
        for word, ids in self.con.execute(_RECURSION).fetchall():
            self.known[pieces[short[word]]] = tuple(ids)
        self.con.unregister("start")

    def by_heap(self, raw: bytes) -> tuple[int, ...]:
        """The same merges for one very long piece, by a heap of pairs over a linked list."""
        if self._pairs is None:
            c = [self.merges[k].to_pylist() for k in ("first", "second", "rank", "merged")]
            self._pairs = {(a, b): (r, m) for a, b, r, m in zip(*c, strict=True)}
        tok = self.bytes[np.frombuffer(raw, np.uint8)].tolist()
        n = len(tok)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(self._pairs[p][0], i) for i in range(n - 1) if (p := (tok[i], tok[i + 1])) in self._pairs]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or self._pairs.get((tok[i], tok[j]), (-1, 0))[0] != rank:
                continue
            tok[i] = self._pairs[tok[i], tok[j]][1]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] < n and (p := (tok[k], tok[nxt[k]])) in self._pairs:
                    heapq.heappush(heap, (self._pairs[p][0], k))
        return tuple(t for t, a in zip(tok, alive, strict=True) if a)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        out: list[list[int]] = []
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= BLOCK_CHARS):
                size += len(texts[end] or "")
                end += 1
            pieces = [self.split.findall(t) if t else [] for t in texts[at:end]]
            if len(self.known) > CACHE_PIECES:
                self.known.clear()
            fresh = set(chain.from_iterable(pieces)) - self.known.keys()
            if fresh:
                self.learn(sorted(fresh))
            known = self.known
            out += [list(chain.from_iterable([known[p] for p in ps])) for ps in pieces]
            at = end
        return out


_ENCODERS: dict[str, Encoder] = {}


def encode_documents(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, ids`` of every document, without special tokens.

    documents: ``doc_id, text``; others are ignored. An empty and a null text have an empty list; strings that look like
    special tokens are ordinary text; repeated documents come out as often as they go in; an empty table gives an empty
    one. ``vocabulary`` is a json file of a byte-level BPE tokenizer, read on the driver and sent to the workers (its size
    is fixed by the tokenizer, about 50 000 merges).

    Scale: one pass without a shuffle; each worker encodes every distinct piece once and keeps it, up to 500 000 pieces.
    """
    spark = documents.sparkSession
    loaded = load_vocabulary(vocabulary)
    digest = hashlib.sha1(b"".join(v.tobytes() for v in loaded.values())).hexdigest()
    shared = spark.sparkContext.broadcast(loaded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if digest not in _ENCODERS:
            _ENCODERS[digest] = Encoder(shared.value)
        encoder = _ENCODERS[digest]
        for batch in batches:
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")
