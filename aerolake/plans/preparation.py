"""Queries of the general data-preparation operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import compaction, drift, gridding, outliers, rejects, units
from aerolake.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.redundant_fragments(table(spark, d, "level1_fragments"))


def p1_harvest(spark: SparkSession, d: str) -> DataFrame:
    """The harvested records, as the committed files hold them; the instruments' own columns."""
    records = compaction.compact(table(spark, d, "level1_fragments")).records(spark)
    held = set(records.select("cells.*").columns)
    return records.select("device", "instrument", F.unix_micros("dtm").alias("us"), *[(F.col(f"cells.{c}") if c in held else F.lit(None)).cast("double").alias(c) for c in HARVESTED])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejected(table(spark, d, "thermo_lines"))


def p3_loaded(spark: SparkSession, d: str) -> DataFrame:
    return rejects.load_lines(table(spark, d, "thermo_lines")).filter("reason is null").drop("reason", "line")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return units.in_other_unit(table(spark, d, "avo_fidas_ae3x"))


def p4_common(spark: SparkSession, d: str) -> DataFrame:
    out = units.harmonize(table(spark, d, "avo_fidas_ae3x"))
    return out.select("reading_id", "source", "quantity", "raw_value", "unit_code", "unit_from", F.round("value", 6).alias("value"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return outliers.implausible(table(spark, d, "thermo"), table(spark, d, "ae33"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.found_changes(table(spark, d, "thermo_files"))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.unify_files(table(spark, d, "thermo_files"))[0]


def p6_failed_casts(spark: SparkSession, d: str) -> DataFrame:
    return drift.unify_files(table(spark, d, "thermo_files"))[1]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return gridding.missing_slots(table(spark, d, "ae33"), table(spark, d, "avo_fidas_ae3x"), table(spark, d, "devices"))


def p7_series(spark: SparkSession, d: str) -> DataFrame:
    return gridding.regularize(gridding.station_series(table(spark, d, "ae33"), table(spark, d, "avo_fidas_ae3x")), table(spark, d, "devices"))


HARVESTED = ("bb", "bc6", "flowa", "flowc", "o3", "pres", "pressure", "rh", "sample_temp", "t", "td")

QUERIES = {f.__name__: f for f in (p1_found, p1_harvest, p3_found, p3_loaded, p4_found, p4_common, p5_found, p6_found, p6_table, p6_failed_casts, p7_found, p7_series)}

#: The same rows in SQL, where it expresses the operator: record keys from text, line rules by patterns, slots by an anti-join.
_RECORDS = r"""
        WITH f AS (SELECT fragment_id, device, instrument, string_split_regex(content, '\r?\n') AS l FROM level1_fragments WHERE content IS NOT NULL),
        r AS (SELECT fragment_id, device, instrument, list_transform(string_split(l[1], ','), lambda x: lower(trim(x))) AS names, unnest(l[2:]) AS line FROM f),
        v AS (SELECT fragment_id, device, instrument, names, string_split(line, ',') AS v FROM r WHERE trim(line) <> ''),
        k AS (
            SELECT fragment_id, device, instrument, epoch_us(CAST(v[list_position(names, 'dtm')] || CASE WHEN regexp_matches(v[list_position(names, 'dtm')], '(Z|[+-][0-9]{2}:[0-9]{2})$') THEN '' ELSE 'Z' END AS TIMESTAMPTZ)) AS us, COLUMNS_
            FROM v)
        SELECT device, arg_min(instrument, fragment_id) AS instrument, us, NAMES_ FROM k GROUP BY device, us, NAMES_
    """
_READINGS = """
        WITH r AS (
            SELECT 'thermo.o3' AS field, device, row_id, epoch_us(dtm) AS us, o3 AS v FROM thermo WHERE coalesce(f_o3 NOT IN (3, 4), true)
            UNION ALL SELECT 'thermo.flowa', device, row_id, epoch_us(dtm), flowa FROM thermo
            UNION ALL SELECT 'ae33.bc6', inst_sn, row_id, epoch_us(dtm), bc6 FROM ae33),
        a AS (SELECT *, coalesce(lag(us) OVER w = us AND lag(v) OVER w = v, false) AS again, coalesce(lag(v) OVER w <> v, true) AS moves FROM r WHERE v IS NOT NULL AND NOT isnan(v) AND us IS NOT NULL WINDOW w AS (PARTITION BY field, device ORDER BY us, row_id)),
        o AS (SELECT *, sum((NOT again)::INTEGER) OVER w - 1 AS i, sum(moves::INTEGER) OVER w AS run FROM a WINDOW w AS (PARTITION BY field, device ORDER BY us, row_id)),
        b AS (SELECT field, device, i, v, max(i) OVER (PARTITION BY field, device) AS n FROM o WHERE NOT again),
        -- the series mirrored at its ends
        p AS (SELECT field, device, i, v, true AS own FROM b UNION ALL SELECT field, device, -i, v, false FROM b WHERE i BETWEEN 1 AND 15 UNION ALL SELECT field, device, 2 * n - i, v, false FROM b WHERE n - i BETWEEN 1 AND 15),
        c AS (SELECT *, v - quantile_disc(v, 0.5) OVER (PARTITION BY field, device ORDER BY i ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS resid FROM p),
        s AS (SELECT field, device, CASE WHEN quantile_disc(abs(resid), 0.5) > 0 THEN 1.4826 * quantile_disc(abs(resid), 0.5) ELSE 1.2533 * avg(abs(resid)) END AS scatter FROM c WHERE own GROUP BY 1, 2),
        d AS (SELECT c.field, c.device, i, resid / nullif(scatter, 0) AS away, CASE WHEN abs(resid / nullif(scatter, 0)) > 5 THEN sign(resid) ELSE 0 END AS side FROM c JOIN s ON c.field = s.field AND c.device IS NOT DISTINCT FROM s.device WHERE own),
        e AS (SELECT *, sum(turn) OVER (PARTITION BY field, device ORDER BY i) AS stretch FROM (SELECT *, (lag(side) OVER (PARTITION BY field, device ORDER BY i) IS DISTINCT FROM side)::INTEGER AS turn FROM d)),
        g AS (SELECT field, device, i, side <> 0 AND count(*) OVER w <= 3 AND min(abs(away)) OVER w > 10 AS spike FROM e WINDOW w AS (PARTITION BY field, device, stretch))
        SELECT o.field, o.row_id FROM (SELECT *, count(*) OVER (PARTITION BY field, device, run) AS length FROM o) o JOIN g ON o.field = g.field AND o.device IS NOT DISTINCT FROM g.device AND o.i = g.i
        WHERE spike OR length >= 10 OR v < CASE o.field WHEN 'thermo.o3' THEN -20 WHEN 'thermo.flowa' THEN 0 ELSE -20000 END OR v > CASE o.field WHEN 'thermo.o3' THEN 500 WHEN 'thermo.flowa' THEN 5 ELSE 100000 END
    """
_UNITS = r"""
        WITH spelled AS (
            SELECT reading_id, source, instrument,
                   CASE WHEN NOT isnan(pm25_conc) THEN pm25_conc WHEN NOT isnan(ir880) THEN ir880 WHEN NOT isnan(bc6) THEN bc6 END AS num, value_text,
                   list_transform([coalesce(unit, ''), coalesce(value_text, ''), coalesce(note, '')], lambda t: replace(replace(replace(replace(replace(replace(replace(replace(replace(
                       lower(t), 'µ', 'u'), 'μ', 'u'), 'micrograms', 'ug'), 'milligrams', 'mg'), 'nanograms', 'ng'), 'cubic metre', 'm3'), 'litre', 'l'), '³', '3'), '**', '')) AS t,
                   CASE WHEN NOT isnan(pm25_conc) THEN 'ug/m3' WHEN NOT isnan(ir880) OR NOT isnan(bc6) THEN 'ng/m3' WHEN instrument IN ('avo', 'fidas') THEN 'ug/m3' WHEN instrument IN ('ae31', 'ae33') THEN 'ng/m3' END AS common,
                   CASE WHEN NOT isnan(pm25_conc) THEN 'pm25_conc' WHEN NOT isnan(ir880) THEN 'ir880' WHEN NOT isnan(bc6) THEN 'bc6' WHEN instrument IN ('avo', 'fidas') THEN 'pm25_conc' WHEN instrument = 'ae31' THEN 'ir880' WHEN instrument = 'ae33' THEN 'bc6' END AS quantity
            FROM avo_fidas_ae3x),
        found AS (
            SELECT *, regexp_extract(t[1], '(ug|mg|ng)(/|\s*per\s*|\s+)(m|l)', ['mass', 'sep', 'volume']) AS u,
                   regexp_extract(t[2], '(ug|mg|ng)(/|\s*per\s*|\s+)(m|l)', ['mass', 'sep', 'volume']) AS v,
                   regexp_extract(t[3], '(?:^|[^0-9\s])\s*(ug|mg|ng)(/|\s*per\s*|\s+)(m|l)[\^]?-?[31]?(?:$|[^a-z])', ['mass', 'sep', 'volume']) AS n
            FROM spelled),
        stated AS (
            SELECT reading_id, source, common, quantity, CASE WHEN u.mass <> '' THEN 'unit' WHEN v.mass <> '' THEN 'value_text' WHEN n.mass <> '' THEN 'note' ELSE 'inferred' END AS unit_from, CASE WHEN u.mass <> '' THEN u WHEN v.mass <> '' THEN v WHEN n.mass <> '' THEN n END AS s,
                   coalesce(num, TRY_CAST(regexp_extract(value_text, '(?:^|[^A-Za-z0-9.^*-])([0-9]+[.]?[0-9]*)', 1) AS DOUBLE)) AS x
            FROM found),
        coded AS (SELECT *, CASE WHEN s IS NOT NULL THEN s.mass || CASE s.volume WHEN 'm' THEN '/m3' ELSE '/l' END END AS code FROM stated WHERE x IS NOT NULL AND common IS NOT NULL),
        scaled AS (
            SELECT *, CASE code WHEN 'mg/m3' THEN 1e3 WHEN 'ug/l' THEN 1e3 WHEN 'ng/m3' THEN 1e-3 WHEN 'ug/m3' THEN 1 END * CASE common WHEN 'ng/m3' THEN 1e3 ELSE 1 END AS scale FROM coded),
        levels AS (SELECT source, common, median(log10(abs(x * scale))) AS own FROM scaled WHERE code IS NOT NULL AND x <> 0 GROUP BY 1, 2),
        every AS (SELECT common, median(own) AS whole FROM levels GROUP BY 1),
        guessed AS (
            SELECT reading_id, source, common, quantity, unit_from, x, coalesce(code, CASE WHEN x = 0 OR coalesce(own, whole) IS NULL THEN common ELSE list_sort(list_transform(
                       [('ug/m3', 1.0), ('mg/m3', 1000.0), ('ng/m3', 0.001)],
                       lambda c: (abs(log10(abs(x)) + log10(c[2] * CASE common WHEN 'ng/m3' THEN 1e3 ELSE 1 END) - coalesce(own, whole)), c[1] <> common, c[1])))[1][3] END) AS unit_code
            FROM scaled LEFT JOIN levels USING (source, common) LEFT JOIN every USING (common))
        """
_COMMON = """SELECT reading_id, source, quantity, x AS raw_value, unit_code, unit_from,
        round(x * CASE unit_code WHEN 'mg/m3' THEN 1e3 WHEN 'ug/l' THEN 1e3 WHEN 'ng/m3' THEN 1e-3 ELSE 1 END * CASE common WHEN 'ng/m3' THEN 1e3 ELSE 1 END, 6) AS value FROM guessed"""
_CELLS = ", ".join(f"TRY_CAST(v[list_position(names, '{c}')] AS DOUBLE) AS {c}" for c in HARVESTED)

SQL = {
    "p1_harvest": _RECORDS.replace("COLUMNS_", _CELLS).replace("NAMES_", ", ".join(HARVESTED)),
    "p5_found": _READINGS,
    "p1_found": r"""
        WITH f AS (SELECT fragment_id, device, string_split_regex(content, '\r?\n') AS l FROM level1_fragments WHERE content IS NOT NULL),
        r AS (SELECT fragment_id, device, list_transform(string_split(l[1], ','), lambda x: lower(trim(x))) AS names, unnest(l[2:]) AS line FROM f),
        v AS (SELECT fragment_id, device, names, string_split(line, ',') AS v FROM r WHERE trim(line) <> ''),
        k AS (
            SELECT fragment_id, device, epoch_us(CAST(v[list_position(names, 'dtm')] || CASE WHEN regexp_matches(v[list_position(names, 'dtm')], '(Z|[+-][0-9]{2}:[0-9]{2})$') THEN '' ELSE 'Z' END AS TIMESTAMPTZ)) AS us,
                   list_sort(list_filter(list_transform(range(1, len(names) + 1), lambda i: CASE WHEN names[i] <> 'dtm' AND trim(v[i]) <> '' THEN names[i] || '=' || CAST(CAST(v[i] AS DOUBLE) + 0 AS VARCHAR) END), lambda x: x IS NOT NULL)) AS cells
            FROM v),
        firsts AS (SELECT DISTINCT min(fragment_id) AS fragment_id FROM k GROUP BY device, us, cells)
        SELECT fragment_id FROM level1_fragments ANTI JOIN firsts USING (fragment_id)
    """,
    "p4_found": _UNITS + "SELECT reading_id, unit_code FROM guessed WHERE unit_code <> common",
    "p4_common": _UNITS + _COMMON,
    "p3_found": r"""
        WITH base AS (SELECT *, lower(regexp_extract(line, '^\s*"?([^\s,]*)', 1)) AS first FROM thermo_lines WHERE line IS NOT NULL),
        heads AS (SELECT file_name, arg_min(lower(line), line_no) AS h FROM base WHERE first IN ('dtm', 'pcdate') GROUP BY 1),
        data AS (
            SELECT line_id, line, contains(h, ',') AS comma, CASE WHEN contains(h, ',') THEN string_split(h, ',') ELSE string_split_regex(trim(h), '\s+') END AS names,
                   regexp_replace(line, '"([^"]|"")*"', 'Q', 'g') AS plain
            FROM base LEFT JOIN heads USING (file_name)
            WHERE trim(line) <> '' AND NOT starts_with(line, '#') AND first NOT IN ('dtm', 'pcdate')),
        cells AS (
            SELECT *, CASE WHEN comma THEN string_split(plain, ',') ELSE string_split_regex(trim(plain), '\s+') END AS v,
                   len(string_split(regexp_replace(plain, '[,\s]+$', ''), ',')) AS filled,
                   CASE WHEN comma THEN regexp_full_match(line, '("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*') ELSE NOT contains(line, '"') END AS quoted
            FROM data),
        typed AS (
            SELECT *, trim(CASE WHEN comma THEN v[list_position(names, 'dtm')] ELSE v[1] || ' ' || v[2] END) AS t, trim(v[list_position(names, 'o3')]) AS o3 FROM cells),
        judged AS (
            SELECT line_id, CASE
                WHEN NOT quoted THEN 'quoting'
                WHEN names IS NULL OR len(v) < len(names) OR (CASE WHEN comma THEN filled ELSE len(v) END) > len(names) THEN 'column_count'
                WHEN NOT (coalesce(regexp_full_match(t, '[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}(T| +)[0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?Z?') AND TRY_CAST(replace(replace(t, '/', '-'), 'Z', '') AS TIMESTAMP) IS NOT NULL, false)
                       OR coalesce(try_strptime(t, ['%m/%d/%Y %H:%M:%S', '%m/%d/%Y %I:%M:%S %p', '%m/%d/%Y %H:%M']) IS NOT NULL, false)) THEN 'bad_dtm'
                WHEN NOT coalesce(regexp_full_match(o3, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'), false) THEN 'bad_o3' END AS reason
            FROM typed)
        SELECT line_id, reason FROM judged WHERE reason IS NOT NULL
    """,
    "p7_found": """
        WITH usable AS (
            SELECT inst_sn AS device, epoch_us(dtm) AS us FROM ae33 WHERE bc6 IS NOT NULL AND dtm IS NOT NULL
            UNION ALL
            SELECT source, epoch_us(dtm) FROM avo_fidas_ae3x
            WHERE dtm IS NOT NULL AND (coalesce(NOT isnan(pm25_conc), false) OR coalesce(NOT isnan(ir880), false) OR coalesce(NOT isnan(bc6), false) OR value_text IS NOT NULL)),
        slots AS (
            SELECT DISTINCT u.device, v.cadence_s::BIGINT AS c, u.us // (1000000 * v.cadence_s::BIGINT) AS slot
            FROM usable u JOIN devices v ON u.device = v.device),
        spans AS (SELECT device, c, min(slot) AS a, max(slot) AS b FROM slots GROUP BY device, c),
        grid AS (SELECT device, c, unnest(generate_series(a, b)) AS slot FROM spans)
        SELECT g.device, g.slot * g.c AS slot_epoch FROM grid g ANTI JOIN slots s ON g.device = s.device AND g.slot = s.slot
    """,
}
