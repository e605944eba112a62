import random
import time

from aerolake.llm import consensus
from aerolake.llm.consensus import align, conflicting_columns, distance, representative, survivors, tokens

SCHEMA = "row_id long, source string, timestamp timestamp, value double, aux double, flag int, note string, origin string, received_at timestamp, conflicting_columns string, g string, entry string"


def frames(spark, at, rows):
    data = [(i, s, None if t is None else at(t), v, a, f, n, o, None if r is None else at(r), None, "clash", "clash") for i, s, t, v, a, f, n, o, r in rows]
    origins = spark.createDataFrame([("manual", 1, "x"), ("logger", 4, "x"), ("live", 5, "x"), (None, 9, "x")], "origin string, trust_rank int, g string")
    return spark.createDataFrame(data, SCHEMA), origins


T = "2008-01-01 00:00:01"


def test_survivors(spark, at):
    nan = float("nan")
    rows = [
        (1, "Buc-Ae33 01", "2008-01-01 00:00:01.9", 1.5, -999.0, 0, "ok", "live", "2008-01-02 00:00:00"),
        (2, "bucae3301", T, 2.5, nan, None, "-", "logger", "2008-01-02 00:00:00"),
        (3, "BUC/AE33/01", T, 99999.0, 3.0, 0, None, "manual", "2008-01-02 00:00:00"),
        (4, "buc_ae33_01", T, 2.5, None, 0, " ", "logger", "2008-01-03 00:00:00"),
        (5, "buc_ae33_01", "2008-01-01 00:00:02", 7.0, None, 0, None, "live", None),  # alone
        (6, "x", None, 1.0, 1.0, 1, "a", "live", None),
        (7, "x", None, 2.0, 1.0, 1, "a", "live", None),
        (8, None, T, 2.0, 1.0, 1, "a", "live", None),
        (9, None, T, 3.0, 1.0, 1, "a", "live", None),
        (10, "y", T, 1.0, 1.0, 1, "n/a", "nowhere", None),  # unknown origin, ties by received_at, then row_id
        (11, "y", T, 1.0, 1.0, 1, "none", None, "2008-01-01 00:00:00"),
        (12, "y", T, 4.0, 1.0, 1, "NULL", "nowhere", None),
        (12, "y", T, 4.0, 1.0, 1, "NULL", "nowhere", None),  # repeated row
    ]
    df, origins = frames(spark, at, rows)
    got = {(r.group_row_id, r.column_name): (r.keep_row_id, r.entry, r.conflict) for r in survivors(df, origins).collect()}
    assert got == {
        (1, "value"): (4, "2.5", True), (1, "aux"): (3, "3.0", False), (1, "flag"): (3, "0", False), (1, "note"): (1, "ok", False),
        (10, "value"): (11, "1.0", True),
    }
    assert {tuple(r) for r in conflicting_columns(df, origins).collect()} == {(1, "value"), (10, "value")}
    assert survivors(*frames(spark, at, [])).count() == 0


def test_hot_group_is_a_tree(spark, at, monkeypatch):
    rows = [(i, "hot", T, float(i % 300), None, None, f"note number {i % 300}", "logger", f"2008-01-{2 + i % 20:02d} 00:00:00") for i in range(1, 1500)]
    df, origins = frames(spark, at, rows)
    best = max(rows, key=lambda r: (r[8], r[0]))
    flat = {(r.column_name, r.keep_row_id) for r in survivors(df, origins).collect()}
    monkeypatch.setattr(consensus, "BLOCK", 8)
    tree = {(r.column_name, r.keep_row_id) for r in survivors(df, origins).collect()}
    assert flat == tree == {("value", best[0]), ("note", best[0])}


def test_votes_and_alignment(spark, at):
    assert tokens("a-12 b") == ["a", "-", "1", "2", "b"] and distance(["a", "b"], ["a", "c", "b"]) == 1
    profile = align([{"a": 1}, {"b": 1}], ["a", "x", "b"], 1, 1)
    assert [max(c, key=c.get) for c in profile][0] == "a" and len(profile) == 3
    values = ["pump swapped today", "pump swaped today", "pump swapped today twice"]
    assert representative(values, [1, 1, 1]) == 0
    assert representative(values, [1, 2, 4]) == 2
    rows = [(i, "s", T, v, None, None, None, "logger" if v == 9.0 else "live", "2008-01-02 00:00:00") for i, v in enumerate([1.5, 1.5, 1.5, 9.0], 1)]
    df, origins = frames(spark, at, rows)
    assert [r.keep_row_id for r in survivors(df, origins, weights="votes").filter("column_name = 'value'").collect()] == [3]
    assert [r.keep_row_id for r in survivors(df, origins).filter("column_name = 'value'").collect()] == [4]


def test_real_readings_of_nines_are_kept(spark, at):
    values = [9.99, 99.9, 99.0, 999.5, 999.0, 9999.9, -999.0, 99999.0]
    rows = [(2 * k + j, f"s{k}", T, v if j else None, None, None, "\t" if j else None, "live", None) for k, v in enumerate(values) for j in (0, 1)]
    got = {(r.group_row_id // 2, r.column_name) for r in survivors(*frames(spark, at, rows)).collect()}
    assert got == {(k, "value") for k in range(4)}


def test_alignment_keeps_every_sequence_whole(monkeypatch):
    rng = random.Random(4)
    for cells in (16_000_000, 12):  # whole tables of steps, and halves
        monkeypatch.setattr(consensus, "CELLS", cells)
        for _ in range(60):
            seqs = [[rng.choice("abcd") for _ in range(rng.randrange(0, 9))] for _ in range(rng.randrange(1, 5))]
            weights = [rng.randrange(1, 4) for _ in seqs]
            profile, total = [], 0
            for seq, w in zip(seqs, weights, strict=True):
                before = len(profile)
                profile = align(profile, seq, w, total)
                total += w
                assert len(profile) >= max(before, len(seq))
            assert all(sum(col.values()) == total for col in profile)
            for t in "abcd":
                assert sum(col.get(t, 0) for col in profile) == sum(w * s.count(t) for s, w in zip(seqs, weights, strict=True))


def test_distance_against_the_textbook():
    def plain(a, b):
        if not a or not b:
            return len(a) + len(b)
        return min(plain(a[1:], b) + 1, plain(a, b[1:]) + 1, plain(a[1:], b[1:]) + (a[0] != b[0]))

    rng = random.Random(5)
    for _ in range(80):
        a, b = ([rng.choice("ab") for _ in range(rng.randrange(0, 6))] for _ in range(2))
        assert distance(a, b) == plain(a, b)


def test_long_values_and_values_without_tokens():
    long = [" ".join(f"w{k * 7 % 1000 + v}" if k % 50 == v else f"w{k % 977}" for k in range(4000)) for v in range(3)]
    began = time.perf_counter()
    assert representative(long, [1, 1, 1]) == 0
    assert time.perf_counter() - began < 60
    assert representative([" ", "pump off"], [2, 1]) == 0 and representative([" ", "pump off", "pump off"], [2, 1, 1]) == 0
    assert representative(["pump off", " ", "pump on", "pump on "], [2, 1, 2, 2]) == 2  # tokens, not values, vote


def test_values_are_aligned_whatever_their_weights(monkeypatch):
    seen, own = [], consensus.align
    monkeypatch.setattr(consensus, "align", lambda profile, seq, *a: seen.append(seq) or own(profile, seq, *a))
    assert representative(["34.47", "27.682", "34.5"], [4, 2, 1]) == 0 and seen == [tokens(v) for v in ("34.47", "27.682", "34.5")]
    rng = random.Random(6)
    for _ in range(200):  # a value that outweighs all others wins by the alignment itself
        values = list({" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(2, 7))})
        assert representative(values, [1 << (len(values) - 1 - k) for k in range(len(values))]) == 0
    assert representative([f"{k} x" for k in range(1000)], [1 << (999 - k) for k in range(1000)]) == 0


def test_short_sequences_are_aligned_as_long_ones(monkeypatch):
    rng = random.Random(7)
    for _ in range(100):
        seqs = [[rng.choice("abc") for _ in range(rng.randrange(0, 9))] for _ in range(4)]
        weights, out = [rng.randrange(1, 5) for _ in seqs], []
        for short in (0, 32):
            monkeypatch.setattr(consensus, "SHORT", short)
            profile, total = [], 0
            for seq, w in zip(seqs, weights, strict=True):
                profile = align(profile, seq, w, total)
                total += w
            out.append((profile, distance(seqs[0], seqs[1])))
        assert out[0] == out[1]
