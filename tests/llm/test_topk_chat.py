import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lopside.llm import chat, topk
from lopside.llm.queries import QUERIES, SQL, vocabulary


def brute(rows, k, every):
    sound = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in sound:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(900)]
    rows += [(900 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2001, [None, 1.0]), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16), (None, rows[0][1]),
             (2004, []), (2005, [1e9] * 16), (2006, [0.5])]
    schema = "vec_id long, embedding array<double>, score string"
    df = topk.quantised(spark.createDataFrame([(*r, "x") for r in rows], schema))
    for shard_rows in (100, 5000):
        got = topk.top_k(df, topk.every(df, 20), shard_rows=shard_rows).collect()
        assert {tuple(r) for r in got} == brute(rows, 10, 20) and len(got) == len(set(got))
    few = topk.quantised(spark.createDataFrame([(*r, "x") for r in rows[:4]], schema))
    assert topk.top_k(few, topk.every(few, 2)).count() == 6
    none = topk.quantised(spark.createDataFrame([], schema))
    assert topk.top_k(none, topk.every(none, 2)).count() == 0


def test_op3_against_sql(spark, small):
    from check_queries import compare, duck
    assert compare(QUERIES["op3_maxscore"](spark, small).toPandas(), duck(small).execute(SQL["op3_maxscore"]).fetchdf()) is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("<|\\>turnxé ", max_size=12), st.text("<|\\>endé\n|", max_size=30)), max_size=4))
def test_escape_round_trip(turns):
    text, starts, ends = chat.render(turns)
    assert chat.parse(text) == turns


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_against_the_rows(spark):
    long = "naïve 😀 text <|end|> " * 3000
    rows = [(1, 0, "system", "be <|turn|> kind"), (1, 2, "assistant", "<\\|end|>x<|"), (1, 1, "user", None), (1, 3, "assistant", ""),
            (1, 4, "assistant", "|> 東京 yes"), (2, 0, "user", "hi"), (3, None, None, "?"), (3, 0, "assistant", long),
            (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (None, 0, "assistant", "lost id")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    made = chat.format_chats(df.select("conv_id", "turn", "role", "text"), vocabulary("byte_bpe_50k.json"))
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest(whole), len(loss), digest(loss))
    assert chat.read_back(chat.format_chats(df.limit(0), vocabulary("byte_bpe_50k.json"))).count() == 0
    trap = chat.read_back(chat.format_chats(chat.trap(df), vocabulary("byte_bpe_50k.json"))).head()
    assert trap.loss_sha256 == digest("</s>[INST] ok [/INST]") and trap.conv_id == -1
