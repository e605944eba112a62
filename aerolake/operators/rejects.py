"""Rows that fail to parse: structural indexing of raw delimited lines.

A batch of lines is one byte buffer. A numpy mask of its quote characters and the parity of the mask's prefix sum give,
for every byte at once, whether it lies inside quotes; delimiters, field borders and quoting errors follow from the
masks, without a loop over lines. Field counts and type checks then split the lines into typed rows and rejects with one
reason each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.parse import NUMBER_RE, parse_instants, slice_strings

#: The columns of the raw ozone files and their types.
TYPED_COLUMNS = {
    "flags": "string", "o3": "double", "hio3": "double", "cellai": "bigint", "cellbi": "bigint", "bncht": "double",
    "lmpt": "double", "o3lt": "double", "flowa": "double", "flowb": "double", "pres": "double",
}
REASONS = ("quoting", "column_count", "bad_dtm", "bad_o3")
_TIME_NAMES = ("dtm", "pcdate")
_COMMA, _QUOTE, _BLANK, _TAB = 44, 34, 32, 9

OUTPUT = T.StructType(
    [T.StructField("line_id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("line_no", T.IntegerType()), T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("dtm", T.TimestampType())]
    + [T.StructField(c, {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}[t]) for c, t in TYPED_COLUMNS.items()]
)


def _per_line(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


class StructuralIndex:
    """Field borders and quoting errors of a batch of lines.

    ``blank_layout``: per line, whether runs of blanks (else commas) separate its fields.
    """

    def __init__(self, buf: np.ndarray, offs: np.ndarray, blank_layout: np.ndarray):
        n, size = len(offs) - 1, len(buf)
        self.buf, self.offs, self.blank = buf, offs, blank_layout
        length = np.diff(offs)
        owner = np.repeat(np.arange(n), length)
        is_quote = buf == _QUOTE
        before = np.cumsum(is_quote, dtype=np.int64) - is_quote
        at_start = np.concatenate([before, [before[-1] + is_quote[-1] if size else 0]])[offs[:-1]] if size else np.zeros(n, np.int64)
        inside = ((before - at_start[owner]) & 1).astype(bool)
        is_blank = (buf == _BLANK) | (buf == _TAB) | (buf == 13)
        sep = np.where(blank_layout[owner], is_blank, buf == _COMMA) & ~inside

        first = np.zeros(size, bool)
        last = np.zeros(size, bool)
        filled = length > 0
        first[offs[:-1][filled]] = True
        last[offs[1:][filled] - 1] = True
        left_ok = first | np.concatenate([[True], sep[:-1] | is_quote[:-1]]) if size else first
        right_ok = last | np.concatenate([sep[1:] | is_quote[1:], [True]]) if size else last
        # a closing quote just before the next separator sees that separator as outside; an opening one is outside itself
        opening, closing = is_quote & ~inside, is_quote & inside
        wrong = (opening & ~left_ok) | (closing & ~right_ok)
        self.misquoted = (_per_line(wrong, offs) > 0) | ((_per_line(is_quote, offs) & 1) == 1)

        # fields start after a separator (comma layout) or at a non-blank after a blank (blank layout)
        blank_owner = blank_layout[owner]
        solid = ~sep
        starts_blank = solid & (first | np.concatenate([[False], sep[:-1]])) if size else solid
        ends_blank = solid & (last | np.concatenate([sep[1:], [False]])) if size else solid
        self._b_start, self._b_end = np.flatnonzero(starts_blank & blank_owner), np.flatnonzero(ends_blank & blank_owner) + 1
        self._b_first = np.concatenate([[0], np.cumsum(_per_line(starts_blank & blank_owner, offs))])
        comma_sep = sep & ~blank_owner
        self._c_pos = np.flatnonzero(comma_sep)
        self._c_first = np.concatenate([[0], np.cumsum(_per_line(comma_sep, offs))])
        self.n_fields = np.where(blank_layout, np.diff(self._b_first), np.diff(self._c_first) + 1)
        # fields up to the last one that isn't empty
        content = ~(sep | is_blank)
        last_content = np.full(n, -1, np.int64)
        where = np.flatnonzero(content)
        if len(where):
            np.maximum.at(last_content, owner[where], where)
        filled_seps = np.searchsorted(self._c_pos, last_content, side="left") - self._c_first[:-1]
        self.n_filled = np.where(blank_layout, self.n_fields, np.where(last_content >= 0, np.maximum(filled_seps, 0) + 1, 0))
        self.empty = last_content < 0

    def field(self, lines: np.ndarray, k: int) -> pa.StringArray:
        """Field ``k`` of the given lines (all of one layout, each with more than ``k`` fields), unquoted and trimmed."""
        if not len(lines):
            return pa.array([], pa.string())
        if self.blank[lines[0]]:
            begin, end = self._b_start[self._b_first[lines] + k], self._b_end[self._b_first[lines] + k]
        else:
            first = self._c_first[lines]
            begin = self.offs[lines] if k == 0 else self._c_pos[first + k - 1] + 1
            is_last = self.n_fields[lines] == k + 1
            # the last field has no separator behind it; its index is clipped and not used
            nxt = self._c_pos[np.minimum(first + k, max(len(self._c_pos) - 1, 0))] if len(self._c_pos) else self.offs[lines + 1]
            end = np.where(is_last, self.offs[lines + 1], nxt)
        begin, end = np.asarray(begin, np.int64), np.asarray(end, np.int64)
        quoted = (end - begin >= 2) & (self.buf[np.minimum(begin, len(self.buf) - 1)] == _QUOTE)
        out = slice_strings(self.buf, begin + quoted, end - quoted)
        if quoted.any():
            out = pc.replace_substring(out, '""', '"')
        return pc.utf8_trim_whitespace(out)


def _number(text: pa.StringArray) -> pa.DoubleArray:
    ok = pc.match_substring_regex(text, NUMBER_RE)
    return pc.cast(pc.if_else(ok, text, None), pa.float64())


def _classify(batch: pa.RecordBatch) -> pa.RecordBatch:
    line = batch.column("line")
    line = pa.concat_arrays([line]) if line.offset else line  # offsets from 0
    line = pc.fill_null(line.cast(pa.string()), "")
    n = len(line)
    offs = np.frombuffer(line.buffers()[1], np.int32, n + 1, line.offset * 4).astype(np.int64)
    data = line.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    header = batch.column("header").to_pandas()
    codes, uniques = header.factorize()
    names = [[x.strip().strip('"').lower() for x in (h.split(",") if "," in h else h.split())] for h in uniques]
    blank_header = np.array([("," not in h) for h in uniques] + [False])
    index = StructuralIndex(buf, offs, blank_header[codes])
    reason = np.full(n, None, object)
    width = np.array([len(x) for x in names] + [-1])[codes]
    wrong_count = (index.n_fields < width) | (index.n_filled > width) | (width < 0)
    reason[wrong_count] = "column_count"
    reason[index.misquoted] = "quoting"
    micros = np.zeros(n, np.int64)
    got: dict[str, list] = {c: [] for c in TYPED_COLUMNS}
    order: list[np.ndarray] = []
    for h, cols in enumerate(names):
        lines = np.flatnonzero((codes == h) & ~wrong_count & ~index.misquoted)
        if not len(lines):
            continue
        at = {c: cols.index(c) for c in dict.fromkeys(cols)}
        if "dtm" in at:
            stamp = index.field(lines, at["dtm"])
        elif "pcdate" in at and "pctime" in at:
            stamp = pc.binary_join_element_wise(index.field(lines, at["pcdate"]), index.field(lines, at["pctime"]), " ")
        else:
            stamp = pa.array([""] * len(lines), pa.string())
        us, ok = parse_instants(stamp)
        micros[lines] = us
        o3 = _number(index.field(lines, at["o3"])) if "o3" in at else pa.nulls(len(lines), pa.float64())
        reason[lines[~np.asarray(o3.is_valid())]] = "bad_o3"
        reason[lines[~ok]] = "bad_dtm"
        order.append(lines)
        for c, kind in TYPED_COLUMNS.items():
            if c == "o3":
                got[c].append(o3)
            elif c not in at:
                got[c].append(pa.nulls(len(lines), pa.string() if kind == "string" else pa.float64()))
            else:
                text = index.field(lines, at[c])
                got[c].append(text if kind == "string" else _number(text))
    # back to the order of the input; lines without parsed fields take null
    taken = np.concatenate(order) if order else np.zeros(0, np.int64)
    back = np.full(n, -1, np.int64)
    back[taken] = np.arange(len(taken))
    good = np.array([r is None for r in reason])
    pick = pa.array(np.where(good, back, -1), pa.int64(), mask=~good)
    arrays = [batch.column("line_id"), batch.column("file_name"), batch.column("line_no"), batch.column("line"), pa.array(reason, pa.string())]
    arrays.append(pa.array(micros, pa.int64(), mask=~good).cast(pa.timestamp("us", "UTC")))
    for c, kind in TYPED_COLUMNS.items():
        whole = pa.concat_arrays(got[c]) if got[c] else pa.nulls(0, pa.string() if kind == "string" else pa.float64())
        col = whole.take(pick)
        if kind == "bigint":
            val = np.asarray(col.fill_null(np.nan))
            whole_number = np.isfinite(val) & (np.abs(val - np.round(val)) < 1e-6) & (np.abs(val) < 2**53)
            col = pa.array(np.where(whole_number, np.round(np.where(whole_number, val, 0)), 0).astype(np.int64), pa.int64(), mask=~whole_number)
        arrays.append(col)
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in OUTPUT])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _classify(batch)


def load_lines(lines: DataFrame) -> DataFrame:
    """Every data line, typed, or with the ``reason`` for which it doesn't load.

    Input columns: ``line_id``, ``file_name``, ``line_no``, ``line``; others are ignored. A file's header is its first
    line that starts with ``dtm`` or ``pcdate``; repeated headers, blank and null lines and lines starting with ``#`` are
    no data lines and don't come out. A data line of a file without a header (or with a null file name) has the reason
    ``column_count``. Output: the input columns, ``reason`` (null for a loaded line), ``dtm`` and the typed columns, which
    are null for a rejected line; a cell other than dtm and o3 that isn't of its type is null. Every line is judged by
    itself, so repeated lines and any order are fine, and an empty table gives an empty table.

    Scale: one pass; the only shuffle is the join with the headers, one row per file, which AQE broadcasts while it is
    small and otherwise splits by skew where one file holds much of the input.
    """
    src = lines.select(F.col("line_id").cast("long"), F.col("file_name").cast("string"), F.col("line_no").cast("int"), F.col("line").cast("string"))
    head = F.lower(F.regexp_replace(F.regexp_extract("line", r"^\s*\"?([^\s,]*)", 1), '"', ""))
    is_header = head.isin(*_TIME_NAMES) & F.col("line").rlike(r"^\s*\"?[A-Za-z]")
    headers = src.filter(is_header).groupBy("file_name").agg(F.min_by("line", F.struct("line_no", "line_id")).alias("header"))
    data = src.filter(F.col("line").isNotNull() & (F.trim(F.regexp_replace("line", r"\s+", " ")) != "") & ~F.col("line").startswith("#") & ~is_header)
    return data.join(headers, "file_name", "left").select("line_id", "file_name", "line_no", "line", "header").mapInArrow(_run, OUTPUT)


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that don't load: ``line_id``, ``reason``."""
    return load_lines(lines).filter(F.col("reason").isNotNull()).select("line_id", "reason")
