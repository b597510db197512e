import hashlib
import random
import re

import pytest

import corpus_pipeline
from lopside.llm import lines
from lopside.llm.queries import QUERIES

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen {}"
SPACES = " \t\r\x0b\x0c"


def words_of(text):
    return [w for w in re.split("[ \t\r\x0b\x0c\n]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def units_of(text):
    """(start, end, words) in characters: sentences of 15 words, lines and paragraphs of 40 that hold several smaller ones."""
    found, paragraph = [], []

    def close():
        own = [w for *_, ws in paragraph for w in ws]
        if len(paragraph) > 1 and len(own) >= 40:
            found.append((paragraph[0][0], paragraph[-1][1], own))
        paragraph.clear()

    at = 0
    for line in text.split("\n"):
        if not line.strip(SPACES):
            close()
        else:
            sentences = [(m.start(), m.end()) for m in re.finditer(f"(?:(?![.!?][{SPACES}]).)*(?:[.!?][{SPACES}]+)?", line, re.S) if m[0]]
            parts = [(at + a, at + b, words_of(line[a:b])) for a, b in sentences if words_of(line[a:b])]
            found += [p for p in parts if len(p[2]) >= 15]
            own = words_of(line)
            if len(parts) > 1 and len(own) >= 40:
                found.append((at, at + len(line), own))
            paragraph.append((at, at + len(line), own))
        at += len(line) + 1
    close()
    return found


def brute(rows):
    """{doc_id: (what is left, bytes removed)} for rows (doc_id, text) without repeated ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        text = text or ""
        gone = [False] * len(text)
        for start, end, words in sorted(units_of(text)):
            if tuple(words) in seen:
                gone[start:end] = [True] * (end - start)
            seen.add(tuple(words))
        at = 0
        for line in text.split("\n")[:-1]:  # a line that went takes its newline along
            end = at + len(line)
            if line and all(gone[at:end]):
                gone[end] = True
            at = end + 1
        kept = "".join(c for c, g in zip(text, gone) if not g)
        if gone and gone[-1] and not text.endswith("\n"):
            kept = kept.removesuffix("\n")
        out[doc_id] = kept, sum(len(c.encode()) for c, g in zip(text, gone) if g)
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute(rows)
    got = QUERIES["op7_lines"](spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, removed = want[r.doc_id]
        assert (r.kept_sha256, r.removed_bytes) == (hashlib.sha256(kept.encode()).hexdigest(), removed)


def test_units_of_all_sizes(spark):
    short = "it is so. " * 16  # a line of short sentences: 48 words
    verse = "\n".join(f"line {k} of a verse that many people know" for k in range(6))  # 54 words in short lines
    say = LONG.format("a")
    rows = [(1, f"Before. {say}. After that."), (2, f"Other words. {say.upper()}.  And more."), (3, f"x\n{short}\ny"), (4, f"{short}\nend"),
            (5, f"top\n\n{verse}\n\nrest"), (6, f"{verse}"), (7, f"a\n\n{verse}\nand one line more\n\nz"), (8, "short one. " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup(df).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "Other words. And more." and got[4].text == "end"
    assert got[3].text == rows[2][1] and got[6].text == "" and got[7].text == rows[6][1] and got[8].text == rows[7][1]
    assert [(s.start, s.end) for s in got[2].removed] == [(13, 13 + len(say) + 3)]
    assert {i: r.text for i, r in got.items()} == {i: k for i, (k, _) in brute(rows).items()}


def test_odd_rows(spark):
    a, b = LONG.format("a"), LONG.format("b")
    rows = [(2, f"{a}\n{b}"), (1, f"intro\n{a.upper()}  \nend"), (3, None), (4, ""), (5, f"{b}\nshort\nshort\n{b}"), (None, a),
            (7, "x " * 50000 + "\n" + a), (7, "x " * 50000 + "\n" + a), (8, a), (8, b), (9, "\n\n" + b + "\n")]
    df = spark.createDataFrame([(i, t, "r", 5, 6, "q") for i, t in rows],
                               "doc_id long, text string, unit string, n_units long, _id long, removed string")
    got = lines.dedup(df)
    assert got.columns == ["doc_id", "text", "unit", "_id", "n_units", "removed"] and {r._id for r in got.collect()} == {6}
    out = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(out, key=str) == sorted([
        (2, b), (1, f"intro\n{a.upper()}  \nend"), (3, None), (4, ""), (5, "short\nshort"), (None, ""),
        (7, "x " * 50000), (7, "x " * 50000), (8, ""), (8, ""), (9, "\n\n")], key=str)
    assert lines.dedup(df.limit(0)).count() == 0


def test_one_line_in_every_document(spark):
    a = LONG.format("hot")
    df = spark.range(5000).selectExpr("id as doc_id", f"concat('{a}', '\n', 'own ', id) as text")
    got = lines.dedup(df.repartition(7)).selectExpr("size(removed) as n", "doc_id").filter("n = 0").collect()
    assert [r.doc_id for r in got] == [0]


def test_stretch_of_one_word(spark):
    rows = [(1, "Begin " + "the " * 60 + "end of one"), (2, "Other " + "THE  " * 114 + "end of two"), (3, "the " * 49 + "three"),
            (4, "the\n" * 50), (5, "them " * 70), (6, "x " + "the " * 50 + "y " + "the " * 60), (7, "so " * 50 + "and " + "so " * 60)]
    got = {r.doc_id: r.text for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {1: rows[0][1], 2: "Other end of two", 3: rows[2][1], 4: "", 5: rows[4][1], 6: "x y  ", 7: rows[6][1]}
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert left == {i: t for i, t in got.items() if t}


def shared_words(rows, words):
    """{doc_id: the places of the words that lie in a run of ``words`` words that an earlier document holds}."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        own = words_of(text or "")
        runs = [tuple(own[i:i + words]) for i in range(len(own) - words + 1)]
        out[doc_id] = {k for i, r in enumerate(runs) if r in seen for k in range(i, i + words)}
        seen.update(runs)
    return out


def test_passages_wherever_they_begin(spark):
    pick = random.Random(5)

    def some(n):  # no unit of its own: sentences of at most seven words, all on one line
        return " ".join(f"w{pick.randrange(10**6)}" + (". " if k % 7 == 6 else "") for k in range(n))

    common = some(50)
    rows = [(k, some(pick.randrange(60, 160))) for k in range(40)]
    for k in range(40, 120):
        other = re.split(" +", pick.choice(rows)[1])
        at = pick.randrange(len(other))
        passage = " ".join(other[at:at + pick.randrange(40, 120)])
        rows.append((k, f"{some(pick.randrange(30))} {passage.upper() if k % 3 else passage} {common if k % 2 else ''} {some(pick.randrange(30))}"))
    same = some(60)
    rows += [(120, same[:len(same) // 2] + same), (121, "No " * 300), (122, "no " * 80 + "more"), (123, None), (124, ""), (125, common)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    want = shared_words(rows, 50)
    assert sum(map(bool, want.values())) > 50
    for table in (df, df.unionByName(df)):  # rows that come twice are one document
        got = lines.dedup(table, passage_words=50).collect()
        assert len(got) == table.count()
        for r in got:
            gone = want[r.doc_id]
            assert words_of(r.text or "") == [w for k, w in enumerate(words_of(dict(rows)[r.doc_id] or "")) if k not in gone]
    assert lines.dedup(df.limit(0), passage_words=50).count() == 0


def test_one_passage_in_every_document(spark):
    passage = " ".join(f"word{k}" + "." * (k % 5 == 4) for k in range(60))
    df = spark.range(3000).selectExpr("id as doc_id", f"concat('own', id, ' ', '{passage}', ' end', id) as text")
    got = {r.doc_id: r.text for r in lines.dedup(df.repartition(7), passage_words=50).collect()}
    assert got == {k: f"own{k} end{k}" if k else f"own0 {passage} end0" for k in range(3000)}
