"""Parsers of the instruments' raw formats. Each gets one file's bytes and gives its rows as text columns."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.sources.files import Format, decode

# --- fixed values: columns of the formats --------------------------------------------------------------------------------
_CHANNELS = range(1, 8)
AE33_COLUMNS = (
    {"Inst_SN": "string", "row_id": "bigint", "DateTime_1": "string", "dtm": "timestamp", "unclear": "int", "DateTime_2": "string"}
    | {f"{n}Ch{i}": "bigint" for i in _CHANNELS for n in ("Ref", "Sen1", "Sen2")}
    | {n: "bigint" for i in _CHANNELS for n in (f"BC{i}1", f"BC{i}2", f"BC{i}")}
    | {f"K{i}": "double" for i in _CHANNELS}
    | {"BB": "double", "Pressure": "double", "Temperature": "double", "Flow1": "bigint", "Flow2": "bigint", "FlowC": "bigint"}
    | {"ContTemp": "double", "SupplyTemp": "double", "LedTemp": "double"}
    | {n: "bigint" for n in ("ContStatus", "LedStatus", "DetectStatus", "ValveStatus", "Status", "TapeAdvCount", "TapeAdvLeft", "unclear_4", "unclear_5", "unclear_6")}
)
AE33_OLD_NAMES = {
    "unclear_2": "BB", "Pres": "Pressure", "Temp": "Temperature", "Temp_1": "ContTemp", "Temp_2": "SupplyTemp", "Temp_3": "LedTemp",
    "Stat_1": "ContStatus", "Stat_2": "LedStatus", "Stat_3": "DetectStatus", "Stat_4": "ValveStatus", "Stat_5": "Status", "unclear_3": "TapeAdvLeft",
}
_WAVELENGTHS = (370, 470, 520, 590, 660, 880, 950)
AE31_COLUMNS = (
    {"id": "string", "date": "string", "time": "string"}
    | {n: "double" for n in ("UV370", "B470", "G520", "Y590", "R660", "IR880", "IR950", "flow")}
    | {n: "double" for w in _WAVELENGTHS for n in (f"_{w}", f"sens_zero_{w}", f"sens_beam_{w}", f"ref_zero_{w}", f"ref_beam_{w}", f"att_{w}")}
)
VRXA00_COLUMNS = {"iii": "int", "zzzztttt": "string"} | {
    n: "double"
    for n in ("tre200s0", "uor200s0", "prestas0", "fa1010z0", "da1010z0", "rre150z0", "ta1200s0", "ua1200s0", "pa1stas0", "fkl010z0", "dkl010z0", "ra1150z0", "fkl010z1", "gor000z0", "ta2200s0", "ua2200s0")
}
THERMO_49C = "pcdate pctime time date o3 flags cellai cellbi bncht lmpt o3lt flowa flowb pres".split()
THERMO_49I = "pcdate pctime time date flags o3 hio3 cellai cellbi bncht lmpt o3lt flowa flowb pres".split()
THERMO_MODERN = "dtm time date o3 flags hio3 cellai cellbi bncht lmpt o3lt flowa flowb pres".split()
THERMO_COLUMNS = {"pcdate": "string", "pctime": "string", "time": "string", "date": "string", "flags": "string"} | {n: "double" for n in ("o3", "hio3", "bncht", "lmpt", "o3lt", "flowa", "flowb", "pres")} | {"cellai": "bigint", "cellbi": "bigint"}
AURORA_COLUMNS = "dtm ssp1 ssp2 ssp3 sbsp1 sbsp2 sbsp3 sample_temp enclosure_temp RH pressure major_state DIO_state".split()
NE300_COLUMNS = (
    "dtm 4035 2002 2635000 2525000 2450000 2635090 2525090 2450090 5001 5002 5003 5004 5005 5006 5010 26635000 26525000 26450000 13525000 "
    "15635000 15525000 15450000 11635000 11525000 11450000 11635090 11525090 11450090 6007 6008 6001 6002 6003 6635000 6525000 6450000 6635090 6525090 6450090"
).split()
G2401_COLUMNS = {"DATE": "string", "TIME": "string"}
EATON_TEXT = ("output_source", "battery_status")
EATON_DECIMAL = ("battery_voltage", "input_frequency", "output_frequency")
EATON_WHOLE = ("output_source_code", "on_battery", "battery_status_code", "battery_capacity_pct", "battery_runtime_min", "seconds_on_battery", "input_voltage", "output_voltage", "output_load", "active_alarms")
TAHMO_UNITS = {
    "Air Temperature": "°C", "Atmospheric Pressure": "kPa", "Battery Percent": "%", "Battery Voltage": "mV", "Gust Speed": "m/s",
    "Lightning Activity": "", "Lightning Distance": "km", "Logger Temperature": "°C", "Max Precip Rate": "mm/h", "Precipitation": "mm",
    "RH Sensor Temp": "°C", "Reference Pressure": "kPa", "Solar Radiation": "W/m²", "VPD": "kPa", "Vapor Pressure": "kPa",
    "Wind Direction": "°", "Wind Speed": "m/s", "X-axis Level": "°", "Y-axis Level": "°",
}
AVO_NAMES = {
    "Datetime_start(UTC)": "ts", "Timestamp": "ts", "DateTime": "ts", "Source": "source", "CO2": "co2", "CO2 (ppm)": "co2",
    "Temperature (Celsius)": "tp", "Humidity (%)": "hm", "Pressure (pascal)": "pr", "PM1 (ug/m3)": "pm1", "PM2.5 (ug/m3)": "pm25_conc",
    "PM10 (ug/m3)": "pm10_conc", "PM2.5 AQI US": "pm25_aqius", "PM2.5 AQI CN": "pm25_aqicn", "PM10 AQI US": "pm10_aqius",
    "PM10 AQI CN": "pm10_aqicn", "Particle Count": "pnc", "Particle count": "pnc",
}
ECC_COLUMNS = ("time_s", "iecc_ma", "tp_k", "um_v", "im_ma", "ref_nbar", "ecc_nbar")
ECC_MISSING = "999999.000"
WDCGG_COLUMNS = (
    "site_gaw_id year month day hour minute second year1 month1 day1 hour1 minute1 second1 value value_unc nvalue latitude longitude altitude "
    "elevation intake_height flask_no ORG_QCflag QCflag instrument measurement_method scale"
).split()
WDCGG_MISSING = (-999, -9, -99.9, -999.999)
OMI_COLUMNS = ("Datetime", "MJD2000", "Year", "DOY", "sec_ut", "Orbit", "CTP", "Lat", "Lon", "Dist", "SZA", "Ozone", "O3blwCld", "SurfP", "CldP", "CldF", "Ref", "AI", "SOI")
OMI_MISSING = -90000
CPD2_TABLES = {
    "S11a": ("F1_S11", "F2_S11", "BsB_S11", "BsG_S11", "BsR_S11", "BbsB_S11", "BbsG_S11", "BbsR_S11", "T1_S11", "T2_S11", "U_S11", "P_S11"),
    "S11s": ("F2_S11",),
    "S11c": ("BswB_S11", "BswG_S11", "BswR_S11", "BbswB_S11", "BbswG_S11", "BbswR_S11"),
    # total and back scattering (Cs, Cbs), each in blue, green and red: reference, dark and sample counts of both shutters, ...
    "S11k": (
        "P1_S11", "P2_S11", "T3_S11", "T4_S11", "U1_S11", "U2_S11", "DEN1_S11", "DEN2_S11",
        *(f"{n}{c}_S11" for k in (1, 2) for w in ("r", "d", "p") for n in (f"Cs{w}{k}", f"Cbs{w}{k}") for c in "BGR"),
        *(f"{n}{c}_S11" for n in ("Csn", "Cbsn", "Bs1", "Bbs1", "Bs2", "Bbs2", "Bs2g", "Bbs2g", "PCTs", "PCTbs") for c in "BGR"),
    ),
    "S11m": ("CrG_S11", "BswB_S11", "BswG_S11", "BswR_S11", "BbswB_S11", "BbswG_S11", "BbswR_S11", *(f"Calparams{k}_{i}_S11" for k in range(60, 66) for i in range(1, 14))),
    "A11a": ("Q_A11", "PCT_A11", *(f"{n}{i}{c}_A11" for n, c in (("X", "c"), ("ZIr", ""), ("Ipz", ""), ("Ip", ""), ("Ifz", ""), ("If", "")) for i in _CHANNELS)),
}
STAMPS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%d.%m.%Y %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d")
BLOCK = 10_000  # records of a long file that are taken apart at once
# ---------------------------------------------------------------------------------------------------------------------


def stamps(text: pd.Series, formats: tuple[str, ...] = STAMPS) -> pd.Series:
    """Times by the first format that fits, UTC."""
    t = text.astype("string").str.strip().str.replace(r"\.\d+(?=Z?$)", "", regex=True)
    out = pd.Series(pd.NaT, index=text.index, dtype="datetime64[ns, UTC]")
    for f in formats:
        out = out.fillna(pd.to_datetime(t.where(out.isna()), format=f, utc=True, errors="coerce"))
    return out


def _lines(raw: bytes, comment: str | None = None) -> list[str]:
    return [x for x in decode(raw).splitlines() if x.strip() and not (comment and x.startswith(comment))]


def _records(lines: list[str], sep: str | None = ",") -> list[list[str]]:
    if sep is None:
        return [x.split() for x in lines]
    return [[c.strip() for c in r] for r in csv.reader(io.StringIO("\n".join(lines)), delimiter=sep, skipinitialspace=True)]


def _frame(records: list[list[str]], names: list[str], exact: bool = False) -> pd.DataFrame:
    """Records as columns; shorter ones are padded and longer ones cut, unless only exact ones are kept."""
    if exact:
        records = [r for r in records if len(r) == len(names)]
    return pd.DataFrame([(r + [""] * len(names))[: len(names)] for r in records], columns=names, dtype=object)


def _ae33(name: str, raw: bytes) -> pd.DataFrame:
    lines = _lines(raw, "#")
    sep = "|" if lines and lines[0].count("|") > lines[0].count(",") else ","
    rec = _records(lines, sep)
    names = list(AE33_COLUMNS)
    if rec and rec[0][0] == "Inst_SN":
        names, rec = rec[0], rec[1:]
    df = _frame(rec, names)
    for old, new in AE33_OLD_NAMES.items():
        if old in df:
            if new in df:
                both = (df[old] != "") & (df[new] != "") & (df[old] != df[new])
                if both.any():
                    raise ValueError(f"{old} and {new} differ")
                df[new] = df[new].where(df[new] != "", df[old])
            else:
                df[new] = df[old]
    df["dtm"] = stamps(df["dtm"])
    if df["dtm"].isna().any():
        raise ValueError("a dtm can't be read")
    return df


_SLOT_DATE = re.compile(r"^\d{1,2}-[A-Za-z]{3}-\d{2}$")


def _ae31(name: str, raw: bytes) -> pd.DataFrame:
    rec = _records(_lines(raw))
    body = list(AE31_COLUMNS)
    if rec and {"dtm", *body} & set(rec[0]):
        rec = rec[1:]
    out, first = [], re.compile(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:")
    for r in rec:
        dtm = r.pop(0) if r and first.match(r[0]) else ""
        if len(r) == len(body) - 1 and r and _SLOT_DATE.match(r[0]):  # without the id all fields stand one to the left
            r = ["", *r]
        out.append([dtm, *(r + [""] * len(body))[: len(body)]])
    df = pd.DataFrame(out, columns=["dtm", *body], dtype=object)
    own = stamps(df["dtm"])
    built = pd.to_datetime(df["date"].astype("string") + " " + df["time"].astype("string"), format="%d-%b-%y %H:%M", utc=True, errors="coerce")
    return df.assign(dtm=own.fillna(built))


def _vrxa00(name: str, raw: bytes) -> pd.DataFrame:
    lines = decode(raw).splitlines()
    at = next((i for i, x in enumerate(lines) if x.startswith("iii ")), None)
    if at is None:
        raise ValueError("no header line")
    df = _frame(_records([x for x in lines[at + 1 :] if x.strip()], None), lines[at].split()).replace("/", "")
    return df.assign(dtm=pd.to_datetime(df["zzzztttt"], format="%Y%m%d%H%M", utc=True, errors="coerce"), source=name.rsplit("/", 1)[-1])


def _thermo(name: str, raw: bytes) -> pd.DataFrame:
    lines = _lines(raw, "#")
    sep = "," if lines and "," in lines[0] else None
    rec = _records(lines, sep)
    if rec and rec[0][0] in ("dtm", "pcdate"):
        names = rec[0]
        rec = [r for r in rec[1:] if r != names]
    else:
        names = THERMO_MODERN if sep else THERMO_49C if "49c" in name.lower() else THERMO_49I
    df = _frame(rec, names, exact=True)
    stamp = df["dtm"] if "dtm" in df else df["pcdate"] + " " + df["pctime"]
    return df.assign(dtm=stamps(stamp), source=name.rsplit("/", 1)[-1])


def _neph(columns: list[str]):
    def parse(name: str, raw: bytes) -> pd.DataFrame:
        rec = _records(_lines(raw))
        head = rec[0] if rec else []
        if head and head[0] in ("dtm", "Date & Time"):
            names, rec = ["dtm", *head[1:]], rec[1:]
            if names == columns[: len(names)] and rec and len(rec[0]) > len(names):  # only the first names were written
                names = columns
        elif head and head[0] == "37":
            names, rec = ["dtm", *head[1:]], rec[1:]
        else:
            names = columns
            if rec and len(rec[0]) > len(columns):
                names = columns[:1] + [f"column_{i + 1}" for i in range(1, len(rec[0]))]
        df = _frame(rec, names)
        return df.assign(dtm=stamps(df["dtm"]))

    return parse


def _g2401(name: str, raw: bytes) -> pd.DataFrame:
    rec = _records(_lines(raw), None)
    if not rec or "DATE" not in rec[0]:
        raise ValueError("no header line")
    df = _frame(rec[1:], rec[0], exact=True)
    return df.assign(dtm=stamps(df["DATE"] + " " + df["TIME"]), source=name.rsplit("/", 1)[-1])


def _with_header(required: str, default: list[str] | None = None, rename: dict[str, str] | None = None):
    def parse(name: str, raw: bytes) -> pd.DataFrame:
        rec = _records(_lines(raw))
        names = [(rename or {}).get(n, n) for n in rec[0]]
        if required in names:
            rec = rec[1:]
        elif default:
            names = default
        else:
            raise ValueError(f"no column {required}")
        df = _frame(rec, names)
        return df.assign(dtm=stamps(df[required]))

    return parse


def _two_headers(name: str, raw: bytes) -> pd.DataFrame:
    """A cleaned table whose first line names the columns and whose second one gives their units."""
    rec = _records(_lines(raw))
    if len(rec) < 2 or any(re.match(r"\d{4}-", c) for c in rec[1]):
        raise ValueError("no second header line")
    df = _frame(rec[2:], ["dtm", *rec[0][1:]])
    return df.assign(dtm=stamps(df["dtm"]))


def _avo(name: str, raw: bytes) -> pd.DataFrame:
    df = _with_header("ts", rename=AVO_NAMES)(name, raw)
    df = df.loc[:, ~df.columns.duplicated()]
    if "pnc" in df:  # raw text counts per litre; parquet of earlier runs is already per cm3 and isn't read here
        df["pnc"] = pd.to_numeric(df["pnc"], errors="coerce") / 1000
    return df


def _tahmo(name: str, raw: bytes) -> Iterator[pd.DataFrame]:
    for df in pd.read_csv(io.StringIO(decode(raw)), dtype=str, keep_default_na=False, chunksize=BLOCK):
        missing = {"measurement", "device_sn", "timestamp_utc", "value", "mrid", "error_flag", "units"} - set(df.columns)
        if missing:
            raise ValueError(f"missing columns {sorted(missing)}")
        want = df["measurement"].str.strip().map(TAHMO_UNITS)
        if want.isna().any() or (want != df["units"].str.strip()).any():
            raise ValueError("unknown measurement or unit")
        error = df["error_flag"].str.strip().str.lower()
        if not error.isin(["true", "false", "0", "1"]).all():
            raise ValueError("unknown error_flag")
        yield df.assign(dtm=pd.to_datetime(pd.to_numeric(df["timestamp_utc"]), unit="s", utc=True), error_flag=error.isin(["true", "1"]).astype(int))


#: Names of the logger export's files, and other spellings of its units.
EXPORT_NAME = r"(?i)^(.+?)-(Raw-)?Configuration\s+(\d+)-(\d+(?:\.\d+)?)\.csv$"
UNIT_SPELLINGS = {"degree_C": "°C", "degrees": "°", "W/m2": "W/m²"}
EXPORT_COLUMNS = {"file": "string", "raw": "tinyint", "line": "bigint", "device_sn": "string", "stamp": "string", "rid": "bigint", "offset": "string", "measurement": "string", "value": "double"}


def _export_label(text: str) -> str:
    words = text.replace("\u00a0", " ").split()
    if len(words) > 1:
        words[0] = UNIT_SPELLINGS.get(words[0], words[0])
    return " ".join(words)


def _tahmo_export(name: str, raw: bytes) -> pd.DataFrame:
    """One file of a logger export, calibrated or raw: the device in the first line, the record count in the second, names in the third.

    A calibrated file gives a row per record and measurement, a raw one a row per record with its id and UTC offset.
    """
    base = re.match(EXPORT_NAME, name.rsplit("/", 1)[-1])
    rec = [[c.strip() for c in r] for r in csv.reader(io.StringIO(decode(raw)))]
    if not base or len(rec) < 3:
        raise ValueError("not an export with three header lines")
    device, names, body = rec[0][0], [_export_label(x) for x in rec[2]], rec[3:]
    claim = re.search(r"# Records:\s*(\d+)", rec[1][0]) if rec[1] else None
    if claim and int(claim[1]) != len(body):
        raise ValueError(f"{claim[1]} records claimed, {len(body)} there")
    wrong = [n for n, r in enumerate(body, 1) if len(r) != len(names)]
    if wrong or len(set(names)) != len(names) or "Timestamps" not in names:
        raise ValueError(f"record {wrong[0]}: other fields than names" if wrong else "names twice, or no Timestamps")
    df = pd.DataFrame(body, columns=names, dtype=object)
    own = {"file": "-".join((base[1], base[3], base[4])), "raw": int(base[2] is not None), "line": range(1, len(df) + 1), "device_sn": device}
    head = pd.DataFrame(own, index=df.index).assign(stamp=df["Timestamps"])
    if base[2]:
        if not {"Device RID", "UTC Offset"} <= set(names):
            raise ValueError("no Device RID or UTC Offset")
        unset = df["UTC Offset"].str.lower().isin(["", "not set"])
        return head.assign(rid=df["Device RID"], offset=df["UTC Offset"].mask(unset, ""))
    labels = {_export_label(f"{u} {m}"): m for m, u in TAHMO_UNITS.items()}
    unknown = [n for n in names if n != "Timestamps" and n not in labels]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    parts = []
    for label, m in labels.items():
        if label in df:
            n = pd.to_numeric(df[label].mask(df[label] == ""))  # text that is no number is an error
            if np.isinf(n.astype(float)).any():
                raise ValueError(f"{m}: not finite")
            parts.append(head.assign(measurement=m, value=n))
    return pd.concat(parts) if parts else head.iloc[:0]


def _eaton(name: str, raw: bytes) -> pd.DataFrame:
    hour = re.search(r"eaton-(\d{10})", name, re.I)
    df = pd.read_csv(io.StringIO(decode(raw)), dtype=str, keep_default_na=False)
    if hour is None or set(df.columns) != {"dtm", *EATON_TEXT, *EATON_DECIMAL, *EATON_WHOLE}:
        raise ValueError("unexpected name or columns")
    dtm = pd.to_datetime(df["dtm"].str.strip(), format="%Y-%m-%d %H:%M:%S", utc=True)
    if (dtm.dt.strftime("%Y%m%d%H") != hour[1]).any() or dtm.duplicated().any():
        raise ValueError("a time outside the file's hour, or twice")
    out = df.assign(dtm=dtm)
    for c in (*EATON_DECIMAL, *EATON_WHOLE):
        text = df[c].str.strip()
        n = pd.to_numeric(text.where(text != ""))
        if np.isinf(n).any() or (c in EATON_WHOLE and (n.dropna() % 1 != 0).any()):
            raise ValueError(f"{c}: not a finite or whole number")
        out[c], out[f"f_{c}"] = n, n.isna().astype(int)
    return out


def _cpd2(name: str, raw: bytes) -> Iterator[pd.DataFrame]:
    """Blocks of records; the fields of a record are kept as its leading texts and the numbers behind them, whatever its type."""
    lines = (f"{x}\n" for x in _lines(raw, "!"))
    records = ([c.strip() for c in r] for r in csv.reader(lines, skipinitialspace=True))
    for rec in batched((r for r in records if r and r[0] in CPD2_TABLES and len(r) >= 4), BLOCK):
        heads = [4 + len(_CPD2_TEXTS[r[0]]) for r in rec]
        numbers = [r[k : 4 + len(CPD2_TABLES[r[0]])] for r, k in zip(rec, heads, strict=True)]
        codes, distinct = pd.factorize(np.array([c for n in numbers for c in n], object))  # a spelling is parsed once
        flat = pd.to_numeric(pd.Series(distinct, dtype="string"), errors="coerce").to_numpy(float, na_value=np.nan)[codes]
        ends = np.cumsum([len(n) for n in numbers]).tolist()
        df = pd.DataFrame([(r[0], r[1], r[2], r[3], len(r), "|".join(r[4:])) for r in rec], columns=list(CPD2_HELD)[:6], dtype=object)
        texts = pd.Series([[c or None for c in r[4:k]] for r, k in zip(rec, heads, strict=True)], dtype=object)
        yield df.assign(dtm=stamps(df["dtm"]), texts=texts, numbers=pd.Series([flat[e - len(n) : e] for e, n in zip(ends, numbers, strict=True)], dtype=object))


CPD2_FORMAT_COLUMNS = {"record": "string", "station": "string", "epoch": "bigint", "dtm": "timestamp", "n_fields": "int", "fields": "string"} | {n: "string" if n.startswith("F") else "double" for t in CPD2_TABLES.values() for n in t}
CPD2_HELD = {c: CPD2_FORMAT_COLUMNS[c] for c in ("record", "station", "epoch", "dtm", "n_fields", "fields")} | {"texts": "strings", "numbers": "doubles"}
_CPD2_TEXTS = {t: [n for n in names if n.startswith("F")] for t, names in CPD2_TABLES.items()}  # they lead


def _cpd2_named() -> list[Column]:
    """The columns of all record types, null in records of other types and behind the end of short ones."""
    cells: dict[str, list[tuple[str, Column]]] = {}
    for t, names in CPD2_TABLES.items():
        for i, n in enumerate(names):
            k = i - len(_CPD2_TEXTS[t])
            number = F.get("numbers", F.lit(k))
            cells.setdefault(n, []).append((t, F.get("texts", F.lit(i)) if k < 0 else F.when(~F.isnan(number), number)))
    own = {n: F.coalesce(*[F.when(F.col("record") == t, c) for t, c in of]) for n, of in cells.items()}
    return [own[c].alias(c) if c in own else F.col(c) for c in CPD2_FORMAT_COLUMNS]


def cpd2_table(rows: DataFrame, record: str) -> DataFrame:
    """One record type's table: station, epoch, dtm and the columns of that type, in order of time."""
    return rows.filter(F.col("record") == record).select("station", "epoch", "dtm", *CPD2_TABLES[record]).sort("dtm")


_NUM = r"[-+]?\d*\.?\d+"
_PAIR = re.compile(rf"(X[ACD]{{2}})\s+(\d\d:\d\d:\d\d)\s+({_NUM})\s+({_NUM})\s+({_NUM})")
_SINGLE = re.compile(rf"X[ACD]\s+\d\d:\d\d:\d\d\s+(?:{_NUM}\s+){{3}}({_NUM})")
_SET = re.compile(rf"^([BCDFMSZ]+)\s+({_NUM})\s+([ACD]{{2,}})\s*$", re.M)
_DAY = re.compile(r"Dobson\s*(\d+)\s+(\d+)\s+(\d+)\s+(\d{4})")


def _dobson(name: str, raw: bytes) -> pd.DataFrame:
    text = decode(raw)
    day = _DAY.search(text)
    if not day:
        raise ValueError("no Dobson header")
    _, d, m, y = day.groups()
    starts = list(_SET.finditer(text))
    rows = []
    for k, s in enumerate(starts):
        part = text[s.end() : starts[k + 1].start() if k + 1 < len(starts) else len(text)]
        singles, pairs = _SINGLE.findall(part), {p[0]: p for p in _PAIR.findall(part)}
        if not pairs:
            continue
        first = next(iter(pairs.values()))
        note = re.search(r"comment\s*(.*)", part)
        row = {"type": s[1], "sequence": s[3], "comments": note[1].strip() if note else "", "dtm": f"{y}-{int(m):02d}-{int(d):02d} {first[1]}", "sza": first[3], "mu": first[2]}
        row |= {"XAD": pairs.get("XAD", [""] * 5)[4], "XCD": pairs.get("XCD", [""] * 5)[4]}
        rows.append(row | {f"X{i + 1}": v for i, v in enumerate(singles[:7])})
    df = pd.DataFrame(rows, columns=[c for c in DOBSON_COLUMNS if c != "source"])
    return df.assign(dtm=stamps(df["dtm"]), source=name.rsplit("/", 1)[-1])


DOBSON_COLUMNS = {"source": "string", "type": "string", "sequence": "string", "comments": "string", "dtm": "timestamp", "sza": "double", "mu": "double", "XAD": "double", "XCD": "double"} | {f"X{i}": "double" for i in range(1, 8)}


def _ecc(name: str, raw: bytes) -> pd.DataFrame:
    lines = raw.decode("latin-1").splitlines()
    day = re.match(r"\d{8}", name.rsplit("/", 1)[-1])
    rows = []
    for x in lines[10:]:
        cells = x.split()
        if cells and all(c == ECC_MISSING for c in cells):
            break  # the footer follows
        if len(cells) == len(ECC_COLUMNS):
            rows.append(["" if c == ECC_MISSING else c for c in cells])
    sonde = next((x.split(":", 1)[1].strip() for x in lines[:10] if x.startswith("Sonde:")), "")
    return pd.DataFrame(rows, columns=list(ECC_COLUMNS), dtype=object).assign(launch=day[0] if day else "", sonde=sonde)


def _shadoz(name: str, raw: bytes) -> pd.DataFrame:
    lines = decode(raw).splitlines()
    n = int(lines[0].strip())
    meta = {k.strip(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:n] if ":" in x)}
    bad = float(meta["Missing or bad values"])
    names = lines[n - 2].split()
    df = _frame(_records([x for x in lines[n:] if x.strip()], None), names)
    when = re.search(r"\d{8}T\d{2}", name)
    wide = df.apply(pd.to_numeric, errors="coerce").replace(bad, np.nan)
    dtm = pd.to_datetime(when[0], format="%Y%m%dT%H", utc=True) if when else pd.NaT
    long = wide.reset_index(names="level").melt("level", var_name="variable", value_name="value")
    return long.assign(dtm=dtm, launch=name.rsplit("/", 1)[-1])


def nasa_ames(name: str, raw: bytes) -> pd.DataFrame:
    """NASA-Ames 1001 in long form: time as the file's date plus fractional days, missing codes null."""
    lines = decode(raw).splitlines()
    n, kind = (int(v) for v in lines[0].split()[:2])
    if kind != 1001:
        raise ValueError(f"file format {kind}, not 1001")
    start = pd.Timestamp("-".join(lines[6].split()[:3]), tz="UTC")
    n_vars = int(lines[9])
    scale = [float(v) for v in lines[10].split()]
    missing = lines[11].split()
    head = lines[n - 1].split()
    rec = [x.split() for x in lines[n:] if x.strip()]
    days = np.array([float(r[0]) for r in rec])
    dtm = (start + pd.to_timedelta(np.round(days * 86_400), unit="s")) if len(rec) else pd.DatetimeIndex([], tz="UTC")
    parts = []
    for k in range(n_vars):
        v = pd.to_numeric(pd.Series([r[k + 1] for r in rec], dtype=object))
        v = v.mask(v == float(missing[k])) * scale[k]
        parts.append(pd.DataFrame({"dtm": dtm, "column": k + 1, "variable": head[k + 1] if k + 1 < len(head) else f"v{k + 1}", "value": v}))
    return pd.concat(parts) if parts else pd.DataFrame({"dtm": [], "column": [], "variable": [], "value": []})


def _wdcgg(name: str, raw: bytes) -> pd.DataFrame:
    lines = decode(raw).splitlines()
    at = next((i for i, x in enumerate(lines) if x.strip() == "# VARIABLE ORDER"), None)
    if at is None:
        raise ValueError("no variable order")
    unit = next((x.split()[3] for x in lines[:at] if len(x.split()) > 3 and x.split()[1] == "value:units"), "")
    df = _frame(_records([x for x in lines[at + 1 :] if x.strip() and not x.startswith("#")], None), WDCGG_COLUMNS)
    n = df.apply(pd.to_numeric, errors="coerce")
    df = df.mask(n.isin(WDCGG_MISSING), "")

    def when(suffix: str) -> pd.Series:
        return pd.to_datetime(pd.DataFrame({c: n[c + suffix] for c in ("year", "month", "day", "hour", "minute", "second")}), utc=True, errors="coerce")

    return df.assign(start=when(""), end=when("1"), unit=unit)


def _omi(name: str, raw: bytes) -> pd.DataFrame:
    lines = decode(raw).splitlines()
    at = next((i for i, x in enumerate(lines) if "Read format" in x), None)
    if at is None:
        raise ValueError("no header")
    df = _frame(_records([x for x in lines[at + 3 :] if x.strip()], None), list(OMI_COLUMNS))
    df = df.mask(df.apply(pd.to_numeric, errors="coerce") == OMI_MISSING, "")
    return df.assign(dtm=pd.to_datetime(df["Datetime"].str.slice(0, 15), format="%Y%m%dT%H%M%S", utc=True, errors="coerce"))


def _climate_index(name: str, raw: bytes) -> pd.DataFrame:
    rows = []
    for r in _records(_lines(raw), None):
        if len(r) == 13 and re.fullmatch(r"\d{4}", r[0]):
            rows += [(f"{r[0]}-{m:02d}-01 00:00:00", v) for m, v in enumerate(r[1:], 1) if float(v) > -998]
    df = pd.DataFrame(rows, columns=["dtm", "value"], dtype=object)
    return df.assign(dtm=stamps(df["dtm"]))


def _noaa_mbl(name: str, raw: bytes) -> pd.DataFrame:
    rec = _records([x.replace(",", " ") for x in _lines(raw, "#")], None)
    rec = [r for r in rec if len(r) >= 4 and re.fullmatch(r"\d{4}", r[0])]
    df = pd.DataFrame([(f"{r[0]}-{int(r[1]):02d}-{int(r[2]):02d} 00:00:00", r[3]) for r in rec], columns=["dtm", "value"], dtype=object)
    return df.assign(dtm=stamps(df["dtm"]))


_G2401 = {"DATE": "string", "TIME": "string", "dtm": "timestamp", "source": "string"} | {
    n: "double"
    for n in ("FRAC_DAYS_SINCE_JAN1", "FRAC_HRS_SINCE_JAN1", "JULIAN_DAYS", "EPOCH_TIME", "ALARM_STATUS", "INST_STATUS", "CavityPressure", "CavityTemp", "DasTemp", "EtalonTemp", "WarmBoxTemp", "MPVPosition", "solenoid_valves", "CO_sync", "CO2_sync", "CO2_dry_sync", "CH4_sync", "CH4_dry_sync", "H2O_sync")
}
_STAMPED = {"dtm": "timestamp"}

FORMATS: dict[str, Format] = {
    f.name: f
    for f in (
        Format("ae33", r"(?i)ae33.*\.(csv|dat|zip)$", AE33_COLUMNS, _ae33, r"\.(csv|dat|txt)$"),
        Format("ae31", r"(?i)ae31.*\.(csv|zip)$", _STAMPED | AE31_COLUMNS, _ae31, r"\.csv$"),
        Format("vrxa00", r"(?i)^VRXA00\.", _STAMPED | VRXA00_COLUMNS | {"source": "string"}, _vrxa00, r"VRXA00", True),
        Format("thermo", r"(?i)(49c|49i).*\.(csv|dat|txt|zip)$", _STAMPED | THERMO_COLUMNS | {"source": "string"}, _thermo, r"\.(csv|dat|txt)$"),
        Format("ne300", r"(?i)ne-?300.*\.(csv|dat|txt|zip)$", _STAMPED | {c: "double" for c in NE300_COLUMNS[1:]} | {f"column_{i}": "double" for i in range(2, 49)}, _neph(NE300_COLUMNS), r"\.(csv|dat|txt)$"),
        Format("aurora3000", r"(?i)aurora3000.*\.(csv|dat|txt|zip)$", _STAMPED | {c: "double" for c in AURORA_COLUMNS[1:]}, _neph(AURORA_COLUMNS), r"\.(csv|dat|txt)$"),
        Format("g2401", r"DataLog_User_Sync", _G2401, _g2401, r"DataLog_User_Sync"),
        Format("fidas", r"(?i)fidas.*\.(csv|zip)$", _STAMPED | {"id": "string", "checksum": "string"} | {str(i): "double" for i in range(0, 100)}, _with_header("dtm"), r"\.(csv|txt)$"),
        Format("hmp110", r"(?i)hmp110.*\.(csv|zip)$", _STAMPED | {"T": "double", "RH": "double", "Td": "double"}, _with_header("dtm", ["dtm", "T", "RH", "Td"]), r"\.(csv|txt)$"),
        Format("cleaned", r"(?i)clean.*\.csv$", _STAMPED | {f"BC{i}": "double" for i in _CHANNELS} | {f"{n}{i}": "double" for n in ("ssp", "sbsp") for i in (1, 2, 3)}, _two_headers, r"\.csv$"),
        Format("avo", r"(?i)avo.*\.(csv|zip)$", _STAMPED | {"source": "string"} | {n: "double" for n in dict.fromkeys(AVO_NAMES.values()) if n not in ("ts", "source")}, _avo, r"\.csv$"),
        Format("tahmo", r"(?i)\.(csv|zip)$", _STAMPED | {"device_sn": "string", "measurement": "string", "value": "double", "mrid": "bigint", "error_flag": "tinyint", "units": "string"}, _tahmo, r"\.csv$", True),
        Format("tahmo_export", r"(?i)\.(csv|zip)$", EXPORT_COLUMNS, _tahmo_export, r"Configuration.*\.csv$"),
        Format("eaton", r"(?i)^eaton-\d{10}\.(zip|csv)$", _STAMPED | {c: "string" for c in EATON_TEXT} | {c: "double" for c in EATON_DECIMAL} | {c: "bigint" for c in EATON_WHOLE} | {f"f_{c}": "tinyint" for c in (*EATON_DECIMAL, *EATON_WHOLE)}, _eaton, r"\.csv$", True),
        Format("cpd2", r"(?i)\.(tar\.gz|tgz)$", CPD2_FORMAT_COLUMNS, _cpd2, r"(S11|A11)", held=CPD2_HELD, named=_cpd2_named),
        Format("d018", r"(?i)\.018$", DOBSON_COLUMNS, _dobson),
        Format("ecc_asap", r"^\d{8}.*", {"launch": "string", "sonde": "string"} | {c: "double" for c in ECC_COLUMNS}, _ecc),
        Format("shadoz", r"(?i)shadoz.*\.(zip|dat)$", _STAMPED | {"launch": "string", "level": "int", "variable": "string", "value": "double"}, _shadoz, r"\.dat$"),
        Format("nasa_ames", r"(?i)\.(nas|na)$", _STAMPED | {"column": "int", "variable": "string", "value": "double"}, nasa_ames),
        Format("wdcgg", r"(?i)\.txt$", {"start": "timestamp", "end": "timestamp", "unit": "string", "site_gaw_id": "string"} | {c: "double" for c in ("value", "value_unc", "nvalue", "latitude", "longitude", "altitude", "QCflag")}, _wdcgg),
        Format("omi", r"(?i)\.txt$", _STAMPED | {c: "double" for c in OMI_COLUMNS[1:]}, _omi),
        Format("climate_index", r".*", _STAMPED | {"value": "double"}, _climate_index),
        Format("noaa_mbl", r"(?i)\.(csv|txt)$", _STAMPED | {"value": "double"}, _noaa_mbl),
    )
}


#: Dataset names that go by another reader's name.
OTHER_NAMES = {"tei49c": "thermo", "tei49i": "thermo", "49c": "thermo", "49i": "thermo", "ne-300": "ne300", "aurora": "aurora3000", "picarro": "g2401", "dobson": "d018"}


def readers() -> dict[str, str]:
    """Dataset name -> format name."""
    return {n: n for n in FORMATS} | OTHER_NAMES


def clean_avo(rows: DataFrame) -> DataFrame:
    """AVO rows without columns that are blank, named ``slot.*`` or null throughout; times and sources stay.

    Which columns are null throughout is one aggregate over all rows.
    """
    named = rows.select(*[c for c in rows.columns if c.strip() and not c.startswith("slot.")])
    some = named.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in named.columns]).first()
    return named.select(*[f"`{c}`" for c in named.columns if some[c] or c in ("dtm", "source")])


def avo_parquet(rows: DataFrame) -> DataFrame:
    """AVO rows of a Parquet file of any age: columns under their present names, types and time zone; particle counts as they are."""
    held = {}
    for c in rows.columns:
        held.setdefault(AVO_NAMES.get(c, c), []).append(F.col(f"`{c}`"))
    out = rows.select(*[F.coalesce(*x).alias(n) for n, x in held.items()])
    out = out.withColumnRenamed("ts", "dtm") if "ts" in out.columns and "dtm" not in out.columns else out
    typed = {c: F.col(c).try_cast(FORMATS["avo"].columns[c]) for c in out.columns if c in FORMATS["avo"].columns}
    return clean_avo(out.withColumns(typed))


def by_source(rows: DataFrame, column: str = "source") -> dict[str, DataFrame]:
    """A frame per source, as filters on one scan; the names (one per sensor) are gathered first. Rows without a source have no frame."""
    names = [r[0] for r in rows.filter(F.col(column).isNotNull()).select(column).distinct().toLocalIterator()]
    return {n: rows.filter(F.col(column) == n) for n in sorted(names)}
