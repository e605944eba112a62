import math
import random

import numpy as np
import pytest

from aerolake.llm.truncation import binomial_tail, ending, judge, length_hazards, number_contexts, segment_prefixes, truncated, truncation_rates

SCHEMA = "doc_id long, text string, source string, n_chars int, ending string, length int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, "clash", 1) for i, s, t in rows], SCHEMA)


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (None, "empty"), ("", "empty"), (" \n\t", "empty"), ("All good.", "terminal"), ('He said "stop!"', "terminal"), ("Is it (really?)", "terminal"),
        ("The flag was set to 3.", "stopped"), ("The pump was", "open"), ("a b,", "open"), ("within 5 %", "open"), ("Done. 👍", "symbol"),
        ("x.\n| 09:35 | 21.8 | 1 |", "row"), ("x.\n| 09:35 | 21", "open"), ("x.\n16:30,53.80,38.69", "row"), ("x.\no3 = 81.2 ppb", "listing"),
        ("x.\n    pump = 'B'", "listing"), ("[2008-01-01 00:16:18] INFO logger.core: flushed 9573 rows", "listing"), ("Kind regards\nthe lamp team", "signed"),
        ("All fine. -- logged 13:00 UTC", "signed"), ("x.\nFiled by shift 5", "open"), ("the pump was […]", "marked"),
        ("the pump was...", "marked"), ("the pump ran. […]", "terminal"), ("x.\nNotes continue in ticket 7…", "trailing"),
    ],
)
def test_endings(text, kind):
    assert ending(text) == kind


def corpus():
    rng = random.Random(6)
    parts = ["The pump", "The dryer", "The roof inlet", "A modem"], ["ran without interruption", "was cleaned", "read 12.5 units below the reference", "was set to 4"], ["overnight", "after the storm", "on the second visit", "at 10:25 UTC"]

    def text(n):
        return " ".join(" ".join(rng.choice(p) for p in parts) + f" for {rng.randrange(9)}.{rng.randrange(9)} hours." for _ in range(n))

    rows, cut = [], set()
    for i in range(600):
        s = ("limited", "free", None)[i % 3]
        t = text(rng.randrange(2, 12))
        if s == "limited" and len(t) > 300:
            t = t[:300]
            while not t[-1].isalpha():
                t = t[:-1] if len(t) > 296 else text(4)[:297]
            if ending(t) == "open":
                cut.add(i)
        if i % 50 == 1:
            t += "\nSee you tomorrow"  # a closer that no rule knows
            cut.discard(i)
        if i % 40 == 7:
            t = text(3)
            t = t[: t.rfind(" for ")] + " for 3."  # ends in the middle of a decimal
            cut.add(i)
        rows.append((i, s, t))
    return rows, cut


def test_judge(spark):
    rows, cut = corpus()
    got = {r.doc_id: r for r in judge(frame(spark, rows)).collect()}
    assert {i for i, r in got.items() if r.cut} == cut
    assert all(got[i].ending == "closer" for i in range(1, 600, 50) if i not in cut)
    limited = [r for r in got.values() if r.source == "limited" and r.cut and r.ending == "open"]
    assert sum(r.at_limit for r in limited) >= 0.9 * len(limited)
    hazards = [r for r in length_hazards(frame(spark, rows)).filter("limit and unit = 'chars'").collect()]
    assert any(296 <= r.length <= 300 and r.source == "limited" for r in hazards)
    rates = {r.source: r for r in truncation_rates(frame(spark, rows)).collect()}
    assert rates["limited"].n_docs == 200 and rates["limited"].rate > rates["free"].rate and None in rates


def test_copies_are_no_limit(spark):
    rows = [(i, "s", "The same whole text of some length here." if i % 2 else f"Another text number {i} " + "x" * (i % 37) + " ends.") for i in range(400)]
    assert length_hazards(frame(spark, rows)).filter("limit and length = 40 and unit = 'chars'").count() == 0


def test_corner_cases(spark):
    rows = [(1, None, None), (2, None, ""), (3, "s", "cut in the midd"), (3, "s", "cut in the midd"), (4, "s", "long " * 100_000 + "end")]
    assert sorted(r.doc_id for r in truncated(frame(spark, rows)).collect()) == [3, 3, 4]
    assert truncated(frame(spark, [])).count() == 0 and truncation_rates(frame(spark, [])).count() == 0


def test_copies_of_a_cut_text_are_no_closer(spark):
    cut = "The pump ran over night.\nThe calibration uni"
    rows = [(i, "s", cut) for i in range(50)] + [(50, "s", cut + "t was moved."), (51, "t", "Other words here.\nThe calibration uni")]
    rows += [(100 + i, "s", f"Text number {i} is whole.") for i in range(100)]
    assert sorted(r.doc_id for r in truncated(frame(spark, rows)).collect()) == [*range(50), 51]


def test_copies_are_one_text_of_evidence(spark):
    closer = [(i, "s", f"Note {'x' * i} is whole.\nSee you tomorrow") for i in range(12)]
    goes_on = [(100 + i, "s", "We wrote it.\nSee you tomorrow at the mast.") for i in range(50)]  # one text that goes on
    decimals = [(200 + i, "s", "The flag was set to 3.5 again.") for i in range(20)]  # one text with a decimal
    whole = [(300 + i, "s", f"Now set to {i}. It held {'y' * i}.") for i in range(3)] + [(400, "s", "The flag was set to 3.")]
    assert truncated(frame(spark, closer + goes_on + decimals + whole)).count() == 0


def test_binomial_tail_is_exact():
    exact = lambda k, n, p: sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k, n + 1))
    cases = [(k, n, p) for n in (1, 5, 40, 200) for k in (0, 1, n // 2, n) for p in (0.0, 1e-4, 0.03, 0.5, 0.97, 1.0)]
    got = binomial_tail(*(np.array(c) for c in zip(*cases, strict=True)))
    assert np.allclose(got, [exact(*c) for c in cases], rtol=1e-9, atol=1e-300)
    # far more endings than any number of terms, at and under the usual hazard
    big = binomial_tail(np.array([4500, 5000, 995_000, 1_002_000]), np.array([10**6, 10**6, 10**9, 10**9]), np.array([0.005, 0.005, 0.001, 0.001]))
    assert big[0] > 1 - 1e-9 and 0.49 < big[1] < 0.52 and big[2] > 1 - 1e-6 and 0.02 < big[3] < 0.03


def test_long_lengths_with_few_endings_are_no_limit(spark):
    # a hazard of 2 % at every length from 40, but for one length with few endings and one with many
    rows, i, at_risk = [], 0, 6000
    for length in range(40, 220):
        n = round(at_risk * {60: 0.002, 80: 0.08}.get(length, 0.02))
        at_risk -= n
        for _ in range(n):
            rows.append((i, "s", f"{i:06d} " + "x" * (length - 8) + "."))
            i += 1
    got = {r.length: r for r in length_hazards(frame(spark, rows)).filter("unit = 'chars'").collect()}
    assert [n for n, r in sorted(got.items()) if r.limit] == [80] and got[60].p_value > 0.99
    assert got[40].at_risk == i and abs(got[80].hazard - 0.08) < 0.01 and abs(got[80].usual - 0.02) < 0.005


def test_a_tail_that_a_limit_makes_is_no_closer(spark):
    # many distinct texts cut at 59 characters within the same boilerplate, which never goes on elsewhere
    rows = [(i, "form", f"Text {i:05d} was sent from the mast today.\nAll data are provi") for i in range(60)]
    rows += [(100 + i, "form", f"Text {'y' * i} ends by itself.") for i in range(200)]
    assert len(rows[0][2]) == 59
    got = {r.doc_id: r for r in judge(frame(spark, rows)).collect()}
    assert all(got[i].cut and got[i].cut_by == "limit" for i in range(60)) and not any(got[100 + i].cut for i in range(200))


def test_segments_and_numbers():
    h, owner, start, char, last = segment_prefixes(["Set to 12.  It ran", "", " \n", "x.\nIt ran off", "Set  to 7"])
    end = {k: h[p] for k, p in enumerate(last) if p >= 0}
    assert sorted(end) == [0, 3, 4] and end[0] != end[3]
    assert end[0] in h[owner == 3] and end[4] in h[owner == 0]  # begun alike, whatever the blanks and digits
    stop, on = number_contexts("The flag was set to 3. It was set to 3.5 and set to 4. Set to 5.")
    assert stop == {"set to": 2} and on == {"set to": 1}
