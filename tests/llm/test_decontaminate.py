import random

import pytest

from lopside.llm import decontaminate
from lopside.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_against_sql(spark, scale):
    from check_queries import compare, duck
    folder = f"/root/testdata/sf{scale}"
    got = QUERIES["op9_decontaminate"](spark, folder).toPandas()
    assert compare(got, duck(folder).execute(SQL["op9_decontaminate"]).fetchdf()) is None


def runs(text, n):
    w = (text or "").lower().split()
    return {tuple(w[k:k + n]) for k in range(max(len(w) - n + 1, min(len(w), 1)))}


def brute(docs, items):
    sizes = {len((a or "").split()) for _, a in items} & {1, 2, 3, 4} | {5}
    held = [(d, set().union(*(runs(b, n) for n in sizes))) for d, b in docs]
    out = set()
    for i, a in items:
        x = runs(a, 5)
        for d, y in held:
            if x and len(x & y) >= 0.8 * len(x):
                out.add((d, i, len(x & y), len(x)))
    return out


def test_short_items_in_long_documents(spark):
    """Items of one to four words are found wherever their words follow each other, by the SQL as well."""
    import duckdb

    from check_queries import compare
    rng = random.Random(2)
    filler = lambda n: [f"w{rng.randrange(9)}" for _ in range(n)]
    items = [(1, "Rare"), (2, "two Words"), (3, "w1 w2 w3"), (4, "four words of it"), (5, "five words are a shingle"), (6, ""), (7, None), (8, "rare")]
    docs = [(0, " ".join(filler(4000))), (1, " ".join([*filler(3000), "RARE", *filler(2)])), (2, "two words"), (3, "a two  words b"), (4, "words two"),
            (5, "four words of"), (6, "x four words\nof it y z"), (7, "five words are a"), (8, " ".join([*filler(30), "five words are a shingle"])),
            (9, None), (10, ""), (11, "rarely"), (12, "it of words four rare two"), (13, "rare rare rare")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(d, b).drop("_key")
    assert {tuple(r)[:4] for r in got.collect()} == brute(docs, items)
    assert {(1, 1), (1, 8), (3, 2), (6, 4), (0, 3), (13, 1)} <= {(r.doc_id, r.item_id) for r in got.collect()}
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("benchmark", b.toPandas())
    assert compare(got.toPandas(), con.execute(decontaminate.SQL).fetchdf()) is None


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([3, 5, 9, 20, 60, 150])))) for i in range(60)] + [(90, None), (91, " "), (92, "one"), (93, "one")]
    docs = []
    for k in range(300):
        w = words(rng.choice([0, 4, 50, 400, 6000]))
        if k % 3 == 0:
            planted = rng.choice(items[:60])[1].upper().split()
            if k % 2:
                planted[len(planted) // 2] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = planted
        docs.append((k, " ".join(w)))
    docs += [(400, "One"), (401, None), (None, items[3][1]), (0, docs[0][1])]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, shared string")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    got = [tuple(r)[:4] for r in decontaminate.matches(d, b).drop("_key").collect()]
    assert set(got) == brute(docs, items) and len(got) == len(set(got))
    leaks = {r[0] for r in got}
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in leaks)
    assert decontaminate.clean(d.limit(0), b).count() == 0 and decontaminate.clean(d, b.limit(0)).count() == len(docs)
