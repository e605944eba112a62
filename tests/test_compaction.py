import numpy as np
import pytest

from aerolake.operators.compaction import compact, first_fit_decreasing, redundant_fragments
from aerolake.session import filesystem, scratch_path

SCHEMA = "fragment_id long, path string, device string, instrument string, modified_at timestamp, n_bytes int, content string, bin string, cells string"


def frame(spark, rows):
    return spark.createDataFrame([(i, f"p{i}", d, "x", None, None if c is None else len(c), c, "clash", "clash") for i, d, c in rows], SCHEMA)


ROWS = [
    (1, "a", "dtm,o3,t\n2008-01-01 00:00:00,1.50,2\n2008-01-01 00:01:00,,3\n"),
    (2, "a", "t,dtm,o3\r\n+2.0,2008-01-01T03:00:00+03:00,1.5\r\n"),  # same record in another style
    (3, "a", "dtm,o3,t\n2008-01-01 00:00:00,1.5,2\n2008-01-01 00:02:00,9,9\n"),  # one new
    (4, "b", "dtm,o3,t\n2008-01-01 00:00:00,1.5,2\n"),  # another device
    (5, "a", None),
    (6, "a", ""),
    (7, "a", "dtm,o3,t\n\n \n"),
    (8, "a", "dtm,o3,t\nbroken,1,1\nbroken,1,1\n"),  # no instant: kept under its text, once
    (9, None, "dtm,o3,t\n2008-01-01 00:00:00.000,1.5,2\n"),
    (10, None, "dtm,o3,t,extra\n2008-01-01T00:00:00Z,1.5,2,\n"),
]


def test_every_record_once(spark):
    done = compact(frame(spark, ROWS), target_bytes=40)
    records = done.records(spark).collect()
    assert done.n_records == len(records) == 6
    keys = [(r.device, r.dtm, r.stamp, str(r.cells), str(r.rest)) for r in records]
    assert len(set(keys)) == len(keys)
    manifest = {r.fragment_id: r for r in done.manifest(spark).collect()}
    assert {i: (m.n_records, m.n_new) for i, m in manifest.items()} == {1: (2, 2), 2: (1, 0), 3: (2, 1), 4: (1, 1), 5: (0, 0), 6: (0, 0), 7: (0, 0), 8: (2, 1), 9: (1, 1), 10: (1, 0)}


def test_found_and_empty(spark):
    found = {r.fragment_id for r in redundant_fragments(frame(spark, ROWS)).collect()}
    assert found == {2, 5, 6, 7, 10}
    empty = compact(frame(spark, []))
    assert (empty.n_records, empty.n_bins) == (0, 0)
    assert redundant_fragments(frame(spark, [])).count() == 0


def test_commit_is_all_or_nothing(spark):
    target = scratch_path(spark, "once")
    compact(frame(spark, ROWS), target)
    with pytest.raises(FileExistsError):
        compact(frame(spark, ROWS), target)


def test_nothing_filled_is_dropped(spark):
    rows = [
        (1, "a", "dtm,o3\n2008-01-01 00:00:00,1,7\n"),
        (2, "a", "dtm,o3\n2008-01-01 00:00:00,1,8\n"),  # differs beyond the header's names
        (3, "a", 'dtm,note,o3\n2008-01-01 00:00:00,"a,b",1\n2008-01-01 00:01:00,"say ""x""\nagain",1\n2008-01-01 00:02:00,5" tube,1\n'),
        (4, "a", 'o3,dtm,note\n1.0,2008-01-01 00:00:00,"a,b"\n'),  # the first record of 3 in another order
        (5, "a", "dtm,o3,o3,\n2008-01-01 00:00:00,1,2,3\n"),  # a name twice, an empty name
        (6, "a", "dtm,o3,o3,\n2008-01-01 00:00:00,1,2,4\n"),
        (7, "a", "dtm,code\n2008-01-01 00:00:00,9007199254740992\n2008-01-01 00:00:00,9007199254740993\n2008-01-01 00:00:00,7d\n2008-01-01 00:00:00,7\n"),
        (8, "a", "dtm,code\n2008-01-01 00:00:00,+09007199254740992.0\n2008-01-01 00:00:00,7.00\n"),
        (9, "a", 'dtm,note\n2008-01-01 00:05:00,"open\n2008-01-01 00:06:00,x\n'),  # a quote that isn't closed takes no line with it
    ]
    done = compact(frame(spark, rows))
    assert {r.fragment_id for r in done.manifest(spark).filter("n_new = 0").collect()} == {4, 8}
    records = done.records(spark).collect()
    assert len(records) == done.n_records == 13
    notes = {r.cells["note"] for r in records}
    assert {"a,b", 'say "x"\nagain', '5" tube', '"open', "x"} <= notes
    assert {r.cells["#3"] for r in records} >= {7.0, 8.0} and {r.cells["o3#3"] for r in records} == {None, 2.0}
    assert {r.cells["code"] for r in records} >= {"9007199254740992", "9007199254740993", "7d", "7.0"}


def test_rare_names_stay_in_the_map(spark, monkeypatch):
    monkeypatch.setattr("aerolake.operators.compaction.COLUMNS", 1)
    done = compact(frame(spark, [(1, "a", "dtm,o3\n2008-01-01 00:00:00,1\n"), (2, "a", "dtm,o3,x y\n2008-01-01 00:01:00,1,q\n")]))
    assert sorted((r.cells["o3"], str(r.rest)) for r in done.records(spark).collect()) == [(1.0, "{'x y': 'q'}"), (1.0, "{}")]


def test_a_damaged_bin_is_found_and_nothing_is_committed(spark, monkeypatch):
    from pyspark.sql import functions as F

    from aerolake.operators import compaction

    target = scratch_path(spark, "damaged")
    honest = compaction.differing_bins

    def damaged(expected, data, names):
        one = data.withColumn("cells", F.col("cells").withField("o3", F.when(F.col("cells.o3") == 9, 8.0).otherwise(F.col("cells.o3"))))
        bad, n = honest(expected, one, names)
        assert (bad, n) == (1, 6)
        assert honest(expected, data.filter("device is not null"), names) == (1, 5)
        assert honest(expected, data, names) == (0, 6)
        return bad, n

    monkeypatch.setattr(compaction, "differing_bins", damaged)
    with pytest.raises(ValueError, match="1 bins differ"):
        compact(frame(spark, ROWS), target)
    for path in (target, f"{target}.staging"):
        fs, hpath = filesystem(spark, path)
        assert not fs.exists(hpath)


def test_first_fit_decreasing():
    sizes = np.array([5, 4, 3, 3, 2, 2, 1, 12.0])
    bins = first_fit_decreasing(sizes, 10)
    load = {b: sizes[bins == b].sum() for b in set(bins)}
    assert all(v <= 10 or (bins == b).sum() == 1 for b, v in load.items())
    assert len(load) == 3
    assert len(first_fit_decreasing(np.array([]), 10)) == 0


def test_many_files_are_split_into_blocks(spark):
    rows = [(i, "a", f"dtm,v\n2008-01-01 00:{i // 60:02d}:{i % 60:02d},{i}\n") for i in range(1, 200)]
    done = compact(frame(spark, rows), target_bytes=200, block_files=20)
    assert done.n_records == 199 and 10 <= done.n_bins < 199
