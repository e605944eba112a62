"""Text cut off by field limits or in transfer.

For every source the discrete hazard of each length (texts that end at it, of those at least as long) is computed with
window functions and tested exactly against the hazard of the neighbouring lengths; lengths with too many endings, under
control of the false discovery rate, are limits of the source, and incomplete endings there are cuts by the limit. A cut
in transfer can have any length, so no hazard shows it: there the corpus decides, by how often the same last words end a
text and how often they go on.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from aerolake.session import materialize

NEIGHBOURS = 25  # lengths on either side that make the usual hazard
APART = 3  # nearest lengths left out of it, as cuts are often trimmed
FDR = 0.01
LEAST_ENDINGS = 4  # endings at a length before it is tested
TRIM = 8  # characters a cut text may have lost to trimming
CLOSER_TEXTS = 4  # distinct texts that a closer must end
GOES_ON = 0.1  # ... and it goes on in at most this many texts, per text it ends
BLOOM_BITS = 24  # the filter sent to workers has 2^24 bits (2 MB), whatever the corpus
BLOCK_CHARS = 200_000  # characters hashed at once, so that the arrays stay in a core's cache

# --- fixed values: marks put after a cut, closing formulas and terminal signs -------------------------------------------
MARKS = ("[…]", "[...]", "(…)", "(...)", "…", "...", "[truncated]", "(truncated)", "[cut]", "<cut>", "[snip]")
FORMULAS = (
    "kind regards", "best regards", "regards", "best wishes", "yours sincerely", "sincerely", "thanks", "cheers",
    "mit freundlichen grüßen", "viele grüße", "freundliche grüße", "cordialement", "bien à vous", "salutations", "wako", "kwa heshima",
)
TERMINAL = ".!?。！？؟"
CLOSERS = "\"'”’»)]}"
# ---------------------------------------------------------------------------------------------------------------------

_MARK = re.compile(r"\s*(?:" + "|".join(re.escape(m) for m in MARKS) + r")\s*$")
_LOG = re.compile(r"^\s*\[?\d{4}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d)?[^\]]*\]\s*[A-Z]{3,}\b")
_ASSIGN = re.compile(r"^\s*[\w.\[\]]+ ?(?:=|:=) ?\S")
_SIGNED = re.compile(r"[.!?…]\s+--? ?\S[^\n]{0,40}$")
_NUMBER = re.compile(r"\d[\d.,:]*")


def _is_row(line: str) -> bool:
    """A row of a table or of separated values."""
    s = line.strip()
    if s.startswith("|"):
        return s.endswith("|") and len(s) > 1
    for sep in ",;\t|":
        cells = s.split(sep)
        if len(cells) >= 3 and sum(any(ch.isdigit() for ch in c) for c in cells) >= len(cells) - 1 and all(len(c.split()) <= 2 for c in cells):
            return True
    return False


def ending(text: str | None) -> str:
    """How a text ends: empty, terminal, stopped (a number and a full stop), row, listing, signed, symbol, marked or open."""
    s = (text or "").rstrip()
    if not s:
        return "empty"
    if s[-1] in TERMINAL and s[-2:-1].isalpha():  # whole whatever the line is; most texts
        return "terminal"
    start = s.rfind("\n") + 1
    last = s[start:].strip("\r")
    if _is_row(last):
        return "row"
    if last.startswith(("    ", "\t")) or _LOG.match(last) or _ASSIGN.match(last):
        return "listing"
    above = s[:start].rstrip() if start else ""
    before = above[above.rfind("\n") + 1 :].strip().rstrip(",").lower()
    if before in FORMULAS and len(last.split()) <= 6 or last.strip().rstrip(",").lower() in FORMULAS:
        return "signed"
    if last.lstrip().startswith("--") or _SIGNED.search(last):
        return "signed"
    m = _MARK.search(s)
    if m:
        body = s[: m.start()].rstrip()
        if not body or body[-1] in TERMINAL:
            return "terminal"
        return "trailing" if m[0].strip() == "…" and m.start() == len(body) else "marked"
    tail = s.rstrip(CLOSERS) if s[-1] in CLOSERS else s
    if tail and tail[-1] in TERMINAL:
        return "stopped" if tail[-1] == "." and len(tail) > 1 and tail[-2].isdigit() else "terminal"
    if not s[-1].isalnum() and s[-1] not in ",;:-–—/'\"([{&%°+=*#@_\\�" + CLOSERS and not s[-1].isspace():
        return "symbol"
    return "open"


# --- hashes of beginnings of segments ------------------------------------------------------------------------------------
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1), modulo 2^64; kept, as blocks are of one size."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(max(n, BLOCK_CHARS), base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


_OTHER, _BLANK, _LINE_END, _DIGIT, _SENTENCE = range(5)
_CLASS = np.zeros(1 << 16, np.uint8)  # of characters up to U+FFFE
_CLASS[[32, 9, 0xA0]], _CLASS[[10, 13]], _CLASS[48:58], _CLASS[[ord(c) for c in TERMINAL]] = _BLANK, _LINE_END, _DIGIT, _SENTENCE


def segment_prefixes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts, character by character: the hash of the segment up to it, the text it belongs to, where its segment starts, and
    itself (numbers as 9, blanks as 0); and the place of each text's last such character (-1 for none).

    A segment begins with a line or behind the end of a sentence, at its first character that isn't blank. Numbers are alike
    whatever their digits, and so are runs of blanks. The hash is a polynomial over the characters, modulo 2^64, then mixed.
    """
    size = np.array([len(t) + 1 for t in texts], np.int64)
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    cls = _CLASS[np.minimum(code, 0xFFFF)]
    before = np.empty_like(cls)
    before[:1], before[1:] = _LINE_END, cls[:-1]
    # a digit behind a digit and a blank behind a blank or a line's end say nothing more
    keep = np.flatnonzero(~(((cls == _DIGIT) & (before == _DIGIT)) | ((cls == _BLANK) & ((before == _BLANK) | (before == _LINE_END)))))
    code, owner, cls = code[keep], owner[keep], cls[keep]
    n = len(code)
    before = before[:n]
    before[:1], before[1:] = _LINE_END, cls[:-1]
    solid = (cls != _BLANK) & (cls != _LINE_END)
    # a segment starts at the first solid character behind a line's end, or behind a sentence's end and a blank
    at = np.arange(n, dtype=np.int32)
    begun = np.maximum.accumulate(np.where((before == _LINE_END) | ((cls == _BLANK) & (before == _SENTENCE)), at, 0))
    next_solid = np.minimum.accumulate(np.where(solid, at, n)[::-1])[::-1]
    start = np.minimum(next_solid[begun], max(n - 1, 0))
    code = np.where(cls == _DIGIT, np.uint32(57), np.where(cls == _BLANK, np.uint32(32), code))
    mixed = (code + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= _powers(_ODD, n)
    total = np.cumsum(mixed, dtype=np.uint64)
    h = (total - (total[start] - mixed[start])) * _powers(_INVERSE, n)[start] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    where = np.flatnonzero(solid)
    reach = np.searchsorted(owner[where], np.arange(len(texts)), side="right") - 1
    own = (reach >= 0) & (owner[where[reach]] == np.arange(len(texts))) if len(where) else np.zeros(len(texts), bool)
    last = np.where(own, where[reach] if len(where) else -1, -1)
    return h, owner, start, np.where(solid, code, 0), last


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_CHARS):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def number_contexts(text: str) -> tuple[Counter[str], Counter[str]]:
    """How often a number behind two words has a full stop behind it, and how often it is a decimal. The text's end counts for neither."""
    stop, on = Counter(), Counter()
    tokens = text.split()
    for k, token in enumerate(tokens):
        if "0" <= token[0] <= "9" and k > 1:
            whole = _NUMBER.match(token)[0].rstrip(".,:")
            two = f"{tokens[k - 2]} {tokens[k - 1]}".lower()
            if token[len(whole) :] == ".":
                if k + 1 < len(tokens):
                    stop[two] += 1
            elif "." in whole:
                on[two] += 1
    return stop, on


def _stopped_context(text: str) -> str | None:
    """The two words before the number that ends a text with a full stop."""
    tokens = text.rstrip().rstrip(CLOSERS).split()
    return f"{tokens[-3]} {tokens[-2]}".lower() if len(tokens) > 2 and _NUMBER.fullmatch(tokens[-1]) else None


def _signed64(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


# --- hazards --------------------------------------------------------------------------------------------------------------
_LGAMMA = np.frompyfunc(math.lgamma, 1, 1)


def binomial_tail(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Probability of k or more of n at the rate p, exactly: the regularized incomplete beta function I_p(k, n - k + 1).

    Its continued fraction is taken from the side where it converges fast, and until it has.
    """
    a, b, x = np.asarray(k, float), np.asarray(n, float) - np.asarray(k, float) + 1, np.clip(np.asarray(p, float), 0.0, 1.0)
    edge = (x <= 0) | (x >= 1) | (a <= 0)
    swap = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    a, b, x = np.where(edge, 1.0, a), np.where(edge, 1.0, b), np.where(edge, 0.5, x)
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    f, m, moving = d.copy(), 0, np.ones(len(x), bool)
    while moving.any():
        m += 1
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            f = np.where(moving, f * d * c, f)
        moving &= np.abs(d * c - 1) > 1e-12
    log_front = (_LGAMMA(a + b) - _LGAMMA(a) - _LGAMMA(b)).astype(float) + a * np.log(x) + b * np.log1p(-x)
    value = np.clip(np.exp(log_front) * f / a, 0.0, 1.0)
    value = np.where(swap, 1 - value, value)
    return np.where(edge, np.where((np.asarray(k) <= 0) | (np.asarray(p, float) >= 1), 1.0, 0.0), value)


def hazards_of_lengths(texts: DataFrame) -> DataFrame:
    """Hazard tests from ``source, hash, chars, bytes``, one row per document; see :func:`length_hazards`."""
    one = texts.filter("chars > 0").select("source", "hash", "chars", "bytes").distinct()
    lengths = one.select("source", F.explode(F.create_map(F.lit("chars"), F.col("chars"), F.lit("bytes"), F.col("bytes"))).alias("unit", "length"))
    d = lengths.groupBy("source", "unit", F.col("length").cast("long").alias("length")).agg(F.count("*").alias("endings"))
    by = Window.partitionBy("source", "unit").orderBy("length")

    def window(a: int, b: int) -> dict[str, F.Column]:
        """Endings at the lengths from a to b around each, and the texts that were at risk there, summed over these lengths."""
        within, up_to = by.rangeBetween(a, b), by.rangeBetween(Window.unboundedPreceding, b)
        first, last = F.greatest(F.lit(1), F.col("length") + a), F.col("length") + b
        ended = F.coalesce(F.sum("endings").over(within), F.lit(0))
        reached = F.coalesce(F.sum(F.col("endings") * F.col("length")).over(within), F.lit(0)) - (first - 1) * ended
        passed = (F.col("total") - F.coalesce(F.sum("endings").over(up_to), F.lit(0))) * F.greatest(F.lit(0), last - first + 1)
        return {"ended": ended, "exposed": reached + passed}

    left, right = window(-NEIGHBOURS, -APART - 1), window(APART + 1, NEIGHBOURS)
    # sums from a length on are the total less those before it: frames that only grow are summed once
    d = d.withColumn("total", F.sum("endings").over(Window.partitionBy("source", "unit")))
    at_risk = F.col("total") - F.sum("endings").over(by.rowsBetween(Window.unboundedPreceding, 0)) + F.col("endings")
    # half an ending keeps an empty neighbourhood from certainty; the greater hazard of both sides, as lengths set in and run out
    rate = [F.when(x["exposed"] > 0, F.least(F.lit(1.0), (x["ended"] + 0.5) / x["exposed"])) for x in (left, right)]
    d = d.select("*", at_risk.alias("at_risk"), rate[0].alias("before"), rate[1].alias("behind"))
    usual = F.coalesce(F.greatest("before", "behind"), F.lit(1.0))
    d = d.withColumns({"usual": usual, "hazard": F.col("endings") / F.col("at_risk")}).filter(F.col("endings") >= LEAST_ENDINGS)

    @F.pandas_udf("double")
    def upper_tail(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series(binomial_tail(k.to_numpy(), n.to_numpy(), p.to_numpy()))

    d = d.withColumn("p_value", upper_tail("endings", "at_risk", "usual"))
    ranked = Window.partitionBy("source", "unit").orderBy("p_value", "length")
    d = d.withColumns({"rank": F.row_number().over(ranked), "tests": F.count("*").over(Window.partitionBy("source", "unit"))})
    passed = F.when(F.col("p_value") <= FDR * F.col("rank") / F.col("tests"), F.col("rank"))
    d = d.withColumn("last", F.max(passed).over(Window.partitionBy("source", "unit")))
    return d.select("source", "unit", "length", "endings", "at_risk", "hazard", "usual", "p_value", F.coalesce(F.col("rank") <= F.col("last"), F.lit(False)).alias("limit"))


def length_hazards(documents: DataFrame) -> DataFrame:
    """Hazard tests of every source, unit (chars, bytes) and length with enough endings.

    ``source, unit, length, endings, at_risk, hazard, usual, p_value, limit``. ``hazard`` is the share of the texts at least
    as long that end at the length, ``usual`` the hazard of the neighbouring lengths (the greater of
    those before and behind), ``p_value`` the exact binomial
    probability of as many endings at the usual hazard; ``limit`` marks the lengths that pass at a false discovery rate of
    1 % within the source and unit.

    Copies of one text are one ending, as they share their length without being cut. Null and empty texts aren't counted; null
    sources form one source. Only counts per length leave the scan; windows run over a source's distinct lengths.
    """
    return hazards_of_lengths(documents.select(F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("hash"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), F.octet_length("text").alias("bytes")))


# --- the corpus's evidence ------------------------------------------------------------------------------------------------
def _bloom(wanted: DataFrame) -> np.ndarray:
    """A bit for each wanted hash, by its low bits, as bytes of a fixed number."""
    place = F.col("key").bitwiseAND((1 << BLOOM_BITS) - 1)
    words = wanted.select(F.shiftright(place, 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(key & 31 as int))").alias("bit"))
    out = np.zeros(1 << (BLOOM_BITS - 5), np.uint32)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[r["word"]] = r["bits"]
    return out


EVIDENCE = "kind string, key long, hash long, n_stop long, n_on long"


def corpus_evidence(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How the wanted last words and number contexts go on: ``key, n_stop, n_on``.

    docs: ``text, hash``; wanted: ``key``, distinct. A last segment (``key`` its hash) goes on where a text's segment begins
    with it and has more characters; ``n_on`` counts distinct texts. A number's context (``key`` the hash of two words) has
    ``n_stop`` numbers with a full stop and ``n_on`` decimals behind it, copies of a text counted once. One scan; what
    isn't wanted is dropped by a filter of fixed size in the workers, and exactly in the join.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_bloom(wanted))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = sent.value
        mask = np.uint64((1 << BLOOM_BITS) - 1)
        for pdf in batches:
            texts, hashes = pdf["text"].tolist(), pdf["hash"].to_numpy(np.int64)
            for a, b in _blocks(texts):
                h, owner, start, char, _ = segment_prefixes(texts[a:b])
                low = h & mask
                hit = np.flatnonzero((char > 0) & ((bits[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32)) & 1).astype(bool))
                solid = np.flatnonzero(char > 0)
                then = np.searchsorted(solid, hit, side="right")
                more = then < len(solid)
                then = solid[np.minimum(then, len(solid) - 1)] if len(solid) else then
                more &= (start[then] == start[hit]) & (char[then] != ord("…"))
                yield pd.DataFrame({"kind": "t", "key": _signed64(h[hit][more]), "hash": hashes[a:b][owner[hit][more]], "n_stop": 0, "n_on": 1}).drop_duplicates()
                rows = []
                for t, x in zip(texts[a:b], hashes[a:b], strict=True):
                    stop, on = number_contexts(t)
                    for two in stop.keys() | on.keys():
                        key = xxh3_64_intdigest(two)
                        place = key & ((1 << BLOOM_BITS) - 1)
                        if int(bits[place >> 5]) >> (place & 31) & 1:
                            rows.append(("n", key - (1 << 64) if key >> 63 else key, x, stop[two], on[two]))
                yield pd.DataFrame(rows, columns=["kind", "key", "hash", "n_stop", "n_on"]).astype({"kind": "string", "key": "int64", "hash": "int64", "n_stop": "int64", "n_on": "int64"})

    each = docs.filter("text is not null").select("text", "hash").mapInPandas(scan, EVIDENCE).join(wanted, "key", "left_semi")
    each = each.groupBy("key", "hash").agg(F.max("n_stop").alias("n_stop"), F.max("n_on").alias("n_on"))
    return each.groupBy("key").agg(F.sum("n_stop").alias("n_stop"), F.sum("n_on").alias("n_on"))


ENDS = "doc_id long, source string, hash long, ending string, last long, stopped long, chars long, bytes long"


def judge(documents: DataFrame) -> DataFrame:
    """Every document with its ending: ``doc_id, source, ending, at_limit, cut, cut_by``.

    documents: ``doc_id, source, text``; others are ignored. ``cut``: the text ends inside a word or a sentence, whether or
    not a mark follows. ``at_limit``: its length is, up to eight characters of trimming, a limit of the source by
    :func:`length_hazards`. ``cut_by``: ``limit`` for an incomplete ending at such a length, ``transfer`` for one elsewhere,
    null for a whole text. Null, empty and blank texts are whole; repeated documents are judged each, but are one text
    where the corpus is evidence; null sources form one source; an empty table gives an empty one. Whole texts are read.

    A last segment that ends at least four distinct texts, goes on in at most a tenth as many, and ends most of them at no
    limit, is a closer of the corpus and makes them whole, whatever the corpus's size. A number with a full stop at the end
    ("set to 3." or "back to 6." of "6.1") is whole unless, in the whole corpus, a decimal follows its two words more often
    than a full stop. ``…`` without a blank before it is a mark only at a limit, since whole notes end with it too.

    Scale: two scans of the texts. The first leaves a row per document without its text; the second counts how the wanted
    segments and numbers go on, filtered in the workers by 2 MB of bits. What is shuffled are hashes.
    """
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), text.alias("text"), F.xxhash64(text).alias("hash"))

    def ends_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for a, b in _blocks(texts):
                part, part_of = texts[a:b], pdf.iloc[a:b]
                kind = [ending(t) for t in part]
                asked = [k for k, e in enumerate(kind) if e in ("open", "trailing")]
                last: list[int | None] = [None] * len(part)
                if asked:
                    bodies = [part[k].rstrip().rstrip("…") if kind[k] == "trailing" else part[k] for k in asked]
                    h, _, _, _, at = segment_prefixes(bodies)
                    keys = _signed64(h)
                    for k, place in zip(asked, at.tolist(), strict=True):
                        last[k] = int(keys[place]) if place >= 0 else None
                two = [_stopped_context(t) if k == "stopped" else None for k, t in zip(kind, part, strict=True)]
                stopped = [None if c is None else (key - (1 << 64) if (key := xxh3_64_intdigest(c)) >> 63 else key) for c in two]
                yield pd.DataFrame({
                    "doc_id": part_of["doc_id"], "source": part_of["source"], "hash": part_of["hash"], "ending": kind, "last": pd.array(last, "Int64"),
                    "stopped": pd.array(stopped, "Int64"), "chars": [len(t) for t in part], "bytes": [len(t.encode("utf-8", "surrogatepass")) for t in part],
                })

    ends = materialize(docs.mapInPandas(ends_of, ENDS), "endings")
    limits = materialize(hazards_of_lengths(ends).filter("limit").select("source", "unit", "length"), "limits")
    near = F.explode(F.sequence(F.greatest(F.lit(1).cast("long"), F.col("length") - TRIM), F.col("length")))
    at = limits.select(F.col("source").alias("src"), "unit", near.alias("len")).distinct()
    chars, octets = (at.filter(F.col("unit") == u).select(F.col("src").alias(f"s_{u}"), F.col("len").alias(f"l_{u}"), F.lit(True).alias(f"at_{u}")) for u in ("chars", "bytes"))
    ends = ends.join(chars, F.col("source").eqNullSafe(F.col("s_chars")) & (F.col("chars") == F.col("l_chars")), "left")
    ends = ends.join(octets, F.col("source").eqNullSafe(F.col("s_bytes")) & (F.col("bytes") == F.col("l_bytes")), "left")
    ends = ends.select("doc_id", "source", "hash", "ending", "last", "stopped", (F.coalesce("at_chars", F.lit(False)) | F.coalesce("at_bytes", F.lit(False))).alias("at_limit"))

    once = ends.filter("last is not null").groupBy("last", "hash").agg(F.min("at_limit").alias("at_limit"))
    tails = once.groupBy(F.col("last").alias("key")).agg(F.count("*").alias("n"), F.count_if("at_limit").alias("n_limit"))
    tails = materialize(tails.filter((F.col("n") >= CLOSER_TEXTS) & (2 * F.col("n_limit") <= F.col("n"))), "tails")
    wanted = materialize(tails.select("key").union(ends.filter("stopped is not null").select("stopped")).distinct(), "wanted")
    evidence = materialize(corpus_evidence(docs, wanted), "evidence")
    zero = F.lit(0)
    closers = tails.join(evidence, "key", "left").filter(F.coalesce("n_on", zero) <= GOES_ON * F.col("n")).select(F.col("key").alias("last"), F.lit(True).alias("known"))
    decimals = evidence.filter("n_on > n_stop").select(F.col("key").alias("stopped"), F.lit(True).alias("goes_on"))
    out = ends.join(closers, "last", "left").join(decimals, "stopped", "left")
    closes = F.coalesce("known", F.lit(False))
    decimal = (F.col("ending") == "stopped") & F.coalesce("goes_on", F.lit(False))
    cut = (F.col("ending") == "marked") | ((F.col("ending") == "open") & ~closes) | ((F.col("ending") == "trailing") & ~closes & F.col("at_limit")) | decimal
    by = F.when(cut & F.col("at_limit"), "limit").when(cut, "transfer")
    return out.select("doc_id", "source", F.when(closes, "closer").otherwise(F.col("ending")).alias("ending"), "at_limit", cut.alias("cut"), by.alias("cut_by"))


def truncated(documents: DataFrame) -> DataFrame:
    """Documents whose text was cut: ``doc_id, source``."""
    return judge(documents).filter("cut").select("doc_id", "source")


def truncation_rates(documents: DataFrame) -> DataFrame:
    """How often each source cuts: ``source, n_docs, n_cut, n_at_limit, rate``; ``n_at_limit`` counts the cuts at a limit."""
    return judge(documents).groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("cut").alias("n_cut"), F.count_if(F.col("cut") & F.col("at_limit")).alias("n_at_limit"), (F.count_if("cut") / F.count("*")).alias("rate"))
