import random

from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.llm.leakage import covered, find_leaks, leaked, tiles, words

D, I = "doc_id long, text string, item_id string", "item_id long, task string, passage string, answer string, doc_id string"
WORDS = [f"w{i}" for i in range(400)]


def brute(docs, items, k=13):
    out = set()
    for d, text in docs:
        w = words(text)
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        for i, passage in items:
            p = words(passage)
            if any(tuple(p[j : j + k]) in grams for j in range(len(p) - k + 1)):
                out.add((d, i))
    return out


def corpus():
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(10, 60)))) for i in range(30)] + [(90, None), (91, ""), (92, "...")]
    items.append((93, items[3][1]))  # a repeated item
    docs = []
    for d in range(120):
        w = rng.choices(WORDS, k=rng.randrange(0, 120))
        if d % 3 == 0:
            p = words(items[rng.randrange(30)][1])
            n = rng.randrange(8, len(p) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[:n]
        docs.append((d, ", ".join(w).upper() if d % 2 else " ".join(w)))
    docs += [(500, None), (501, ""), (502, "- -"), (503, docs[0][1]), (504, items[0][1] + " " + "filler " * 200_000 + items[1][1])]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "clash") for d in docs], D), spark.createDataFrame([(i, "t", p, None, "clash") for i, p in items], I)


def test_against_brute_force(spark):
    docs, items = corpus()
    df, it = frames(spark, docs, items)
    want = brute(docs, items)
    assert len(want) > 10
    assert {tuple(r) for r in leaked(df, it).collect()} == want
    by_shuffle = find_leaks(df, it, sent_words=1).filter("longest >= 13").select("doc_id", "item_id")
    assert {tuple(r) for r in by_shuffle.collect()} == want
    assert leaked(*frames(spark, [], items)).count() == leaked(*frames(spark, docs, [])).count() == 0


def test_reordered_passage(spark):
    p = [f"a{i}" for i in range(40)]
    moved = " ".join(p[20:30] + ["x"] + p[0:10] + ["y"] + p[30:40] + ["z"] + p[10:20])
    df, it = frames(spark, [(1, moved), (2, " ".join(p[:9]))], [(7, " ".join(p))])
    got = [(r.doc_id, r.item_id, r.longest, r.n_tiles, r.coverage) for r in covered(df, it).collect()]
    assert got == [(1, 7, 10, 4, 1.0)]
    assert leaked(df, it).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=25), st.lists(st.sampled_from("abc"), max_size=15))
def test_tiles_are_greedy_and_disjoint(doc, item):
    got = tiles(doc, item, 2)
    assert [n for *_, n in got] == sorted((n for *_, n in got), reverse=True)
    in_doc = [d + j for d, _, n in got for j in range(n)]
    in_item = [i + j for _, i, n in got for j in range(n)]
    assert len(set(in_doc)) == len(in_doc) and len(set(in_item)) == len(in_item)
    assert all(doc[d : d + n] == item[i : i + n] for d, i, n in got)
    longest = max((n for n in range(len(item) + 1) for i in range(len(item) - n + 1) if n and any(doc[d : d + n] == item[i : i + n] for d in range(len(doc) - n + 1))), default=0)
    assert (got[0][2] if got else 0) == (longest if longest >= 2 else 0)


def test_repeated_words_and_tiles_against_brute_force():
    from aerolake.llm import leakage

    def brute_tiles(doc, item, least):
        used_d, used_i, out = set(), set(), []
        while True:
            best = (0, 0, 0)
            for d in range(len(doc)):
                for i in range(len(item)):
                    n = 0
                    while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in used_d and i + n not in used_i:
                        n += 1
                    if n > best[2]:
                        best = (d, i, n)
            if best[2] < least:
                return out
            d, i, n = best
            out.append(best)
            used_d |= set(range(d, d + n))
            used_i |= set(range(i, i + n))

    rng = random.Random(2)
    for block in (2_000_000, 5):  # pairs in one block, and in many
        leakage.PAIR_BLOCK = block
        for _ in range(150):
            a, b = ([rng.choice("abc"[: rng.choice((1, 3))]) for _ in range(rng.randrange(0, 25))] for _ in range(2))
            least = rng.randrange(1, 5)
            assert tiles(a, b, least) == brute_tiles(a, b, least)
    leakage.PAIR_BLOCK = 2_000_000
    assert tiles(["a"] * 3000, ["a"] * 3000, 13) == [(0, 0, 3000)]
