"""Reading sets of raw files: binary scan, archives, encodings, one parser per format, errors beside rows."""

from __future__ import annotations

import io
import json
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.session import filesystem, materialize

Parser = Callable[[str, bytes], pd.DataFrame | Iterator[pd.DataFrame]]
_SPARK = {"strings": T.ArrayType(T.StringType()), "doubles": T.ArrayType(T.DoubleType()), "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "tinyint": T.ByteType(), "timestamp": T.TimestampType()}


@dataclass(frozen=True)
class Format:
    """A file format: the names it accepts, its columns and types, and its parser of one member's bytes.

    The parser returns a frame of the columns as text or values, or an iterator of frames, blocks of successive rows of a
    long file; it raises ValueError for a file it doesn't accept. Where most of many columns are empty in a row, the parser
    may give the columns of ``held`` instead, from which ``named`` makes the format's own as expressions.
    """

    name: str
    accept: str
    columns: dict[str, str]
    parse: Parser
    members: str = r".*"
    single_member: bool = False
    held: dict[str, str] | None = None
    named: Callable[[], list[Column]] | None = None

    @property
    def parsed(self) -> dict[str, str]:
        return self.columns if self.held is None else self.held

    @property
    def schema(self) -> T.StructType:
        """Of what is parsed."""
        own = [T.StructField(c, _SPARK[k]) for c, k in self.parsed.items()]
        return T.StructType([T.StructField("path", T.StringType()), T.StructField("member", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("error", T.StringType()), *own])


def decode(raw: bytes) -> str:
    """Text of a file in UTF-8 (with or without a mark), UTF-16 with a mark, else Windows-1252; NUL characters dropped."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16").replace("\0", "")
    try:
        return raw.decode("utf-8-sig").replace("\0", "")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace").replace("\0", "")


def members(path: str, raw: bytes, depth: int = 2) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of a plain file, or of the members of a zip (nested up to ``depth``) or tar.gz archive."""
    low = path.lower()
    if low.endswith(".zip") or raw[:4] == b"PK\x03\x04":
        if depth <= 0:
            raise ValueError("archive nested too deep")
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for info in z.infolist():
                if not info.is_dir():
                    inner = z.read(info)
                    if info.filename.lower().endswith(".zip"):
                        yield from members(info.filename, inner, depth - 1)
                    else:
                        yield info.filename, inner
    elif low.endswith((".tar.gz", ".tgz")):
        with tarfile.open(fileobj=io.BytesIO(raw), mode="r:gz") as tar:
            for m in tar:
                if m.isfile():
                    yield m.name, tar.extractfile(m).read()
    else:
        yield path, raw


def to_type(text: pd.Series, kind: str) -> pd.Series:
    """Tolerant conversion of a column: what doesn't fit is null; whole numbers may be written as decimals."""
    if kind in ("strings", "doubles"):
        return text
    if kind == "string":
        s = text.astype("string").str.strip()
        return s.where(s != "").astype(object).where(s.notna() & (s != ""), None)
    if kind == "timestamp":
        return pd.to_datetime(text, utc=True, errors="coerce", format="ISO8601") if not pd.api.types.is_datetime64_any_dtype(text) else text
    n = pd.to_numeric(text.astype("string").str.strip() if text.dtype == object else text, errors="coerce")
    if kind == "double":
        return n.astype("Float64")
    whole = n.where((n - n.round()).abs() < 1e-6).round()
    return whole.astype("Float64").astype("Int64")


def _typed(rows: pd.DataFrame, fmt: Format, path: str, member: str, first: int) -> pd.DataFrame:
    out = {"path": path, "member": member, "ordinal": range(first, first + len(rows)), "error": None}
    data = {c: to_type(rows[c].reset_index(drop=True), k) if c in rows else pd.Series([None] * len(rows)) for c, k in fmt.parsed.items()}
    return pd.DataFrame(out, index=range(len(rows))).assign(**data)


def _blocks(fmt: Format, path: str, member: str, content: bytes) -> list[pd.DataFrame]:
    """The typed rows of a member, all of them before the first goes on, since a member that fails later has none."""
    parsed, out, first = fmt.parse(member, content), [], 0
    for rows in [parsed] if isinstance(parsed, pd.DataFrame) else parsed:
        if len(rows):  # a frame without rows has no types
            out.append(_typed(rows, fmt, path, member, first))
            first += len(rows)
    return out


def read_format(spark: SparkSession, paths: str | list[str], fmt: Format, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all accepted files, and (path, member, error) of those that fail. A bad file loses only itself.

    One task parses one file or more, never a part of one, as archives can't be split; files are read where they lie and
    are neither moved nor deleted. ``keep`` writes the parsed rows to the shared folder, so that both results come from
    one parse. An empty file has no row and no error.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return parse_files(accepted(scan, fmt), fmt, keep)


def accepted(files: DataFrame, fmt: Format) -> DataFrame:
    """The files (``path`` and others) whose names a format accepts; folders don't count."""
    return files.filter(F.element_at(F.split("path", "/"), -1).rlike(fmt.accept))


def parse_files(files: DataFrame, fmt: Format, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_format`, of files that lie in a table: ``path``, ``content`` (bytes). Null contents are empty files."""
    files = files.select("path", F.coalesce("content", F.lit(b"")).alias("content"))
    schema, only = fmt.schema, re.compile(fmt.members, re.I)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                member = ""
                try:
                    inner = [(n, b) for n, b in members(path, bytes(raw)) if only.search(n)]
                    if fmt.single_member and len(inner) != 1:
                        raise ValueError(f"{len(inner)} members instead of one")
                    for member, content in inner:
                        if content.strip():
                            yield from _blocks(fmt, path, member, content)
                except Exception as e:  # noqa: BLE001  (any failure of a foreign file is its own error row)
                    yield pd.DataFrame({"path": [path], "member": [member], "ordinal": [0], "error": [f"{type(e).__name__}: {e}"]} | {c: [None] for c in fmt.parsed})

    out = files.mapInPandas(run, schema)
    if keep:
        out = materialize(out, fmt.name)
    good = out.filter("error is null").drop("error")
    if fmt.named is not None:
        good = good.select("path", "member", "ordinal", *fmt.named())
    return good, out.filter("error is not null").select("path", "member", "error")


def avo_files(files: DataFrame) -> DataFrame:
    """Files named ``avo-<station>-<cadence>.parquet``: adds ``station`` and ``cadence``; other names drop out."""
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda k: F.regexp_extract(name, r"(?i)^avo-([a-z0-9]+)-([a-z0-9]+)\.parquet$", k)
    return files.withColumns({"station": F.lower(part(1)), "cadence": F.lower(part(2))}).filter(F.col("station") != "")


def level1_root(spark: SparkSession, root: str, station: str) -> str:
    """The data root of a path that is the root itself, its ``level1`` folder, or a station's folder below that."""
    fs, path = filesystem(spark, root)
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise FileNotFoundError(f"{root} is no folder")
    if fs.exists(filesystem(spark, f"{root.rstrip('/')}/level1")[1]):
        return root.rstrip("/")
    for levels in (["level1"], ["level1", station]):
        if root.rstrip("/").split("/")[-len(levels) :] == levels:
            return root.rstrip("/").rsplit("/", len(levels))[0]
    raise FileNotFoundError(f"{root} is neither a root with level1, nor level1, nor level1/{station}")


def settle_files(spark: SparkSession, read: DataFrame, errors: DataFrame, archive: str, quarantine: str) -> dict[str, str]:
    """Move files that were read to the archive, and failed ones to quarantine with a ``<name>.errors.json`` beside them.

    read, errors: as of :func:`read_format`; a file with a failed member is quarantined whole. A name that is taken gets a
    number. Paths come to the driver one by one. Returns old -> new path.
    """
    moved: dict[str, str] = {}
    failed = errors.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("member", "error"))).alias("errors"))
    good = read.select("path").distinct().join(failed, "path", "left_anti").withColumn("errors", F.lit(None))
    for rows, folder in ((failed, quarantine), (good, archive)):
        fs, place = filesystem(spark, folder)
        fs.mkdirs(place)
        for r in rows.toLocalIterator():
            name = r["path"].rsplit("/", 1)[-1]
            n, target = 0, f"{folder.rstrip('/')}/{name}"
            while fs.exists(filesystem(spark, target)[1]):
                n += 1
                target = f"{folder.rstrip('/')}/{n}_{name}"
            if not fs.rename(filesystem(spark, r["path"])[1], filesystem(spark, target)[1]):
                raise OSError(f"{r['path']} can't be moved to {target}")
            moved[r["path"]] = target
            if r["errors"] is not None:
                out = fs.create(filesystem(spark, f"{target}.errors.json")[1])
                out.write(json.dumps([e.asDict() for e in r["errors"]], ensure_ascii=False).encode())
                out.close()
    return moved
