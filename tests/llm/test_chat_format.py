import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat_format as cf

BITS = [*cf.CONTROLS, "\\", "[", "<", " ", "\n", "a", "é", "INST]", "/s>", "s>", "😀", ""]


def odd_rows():
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "[/ROLE]", "a b", "</s>", "[\\ROLE]"]
    texts = [None, "", *["".join(rnd.choice(BITS) for _ in range(rnd.randint(1, 9))) for _ in range(300)]]
    return [(c, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(roles), rnd.choice(texts)) for c in [*range(200), None] for _ in range(rnd.choice([1, 2, 3, 6]))]


def in_order(rows):
    plain = [(i, t, r or "", x or "") for i, t, r, x in rows]
    out = {}
    for i, t, r, x in sorted(plain, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        out.setdefault(i, []).append((r, x))
    return out


@pytest.fixture(scope="module")
def chats(shared):
    rows = odd_rows()
    df = shared.createDataFrame([(*r, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, formatted string, place int")
    return in_order(rows), cf.format_chats(df.repartition(4))


def test_every_turn_comes_back(chats):
    want, df = chats
    got = df.select("conv_id", cf.parsed(F.col("formatted")).alias("turns"), cf.learned_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want and len(got) == len(want)
    assert {r["conv_id"]: r["learned"] for r in got} == {i: "".join(x for r, x in turns if r == "assistant") for i, turns in want.items()}


def test_no_control_string_but_the_templates(chats):
    """A plain reader that only counts bare control strings finds one closing mark a turn."""
    want, df = chats
    for r in df.collect():
        marks = re.findall(cf.BARE, r["formatted"])
        closing = {"system": "[/SYS]", "user": "[/INST]"}
        assert [m for m in marks if m in ("</s>", "[/SYS]", "[/INST]")] == [closing.get(role, "</s>") for role, _ in want[r["conv_id"]]]


def test_the_mask_covers_assistant_texts_only(chats):
    _, df = chats
    for r in df.collect():
        whole = r["formatted"].encode()
        for x in r["loss"]:
            assert whole[x["start"] - 1 : x["start"]] == b" " and whole[x["start"] + x["length"] :].startswith(b"</s>")


@pytest.mark.parametrize("text", ["", "<s>", "<s> a", "<s>a</s>", "<s>[INST] a", "<s>[INST] a [/SYS]", "x<s> a</s>", "<s> a</s>b", "<s>[ROLE] r [/ROLE]", "<s>[INST]a[/INST]", "<s>[SYS] a [/SYS] b", "<s> a</s><s> b</s>"])
def test_what_is_no_conversation_is_refused(shared, text):
    assert shared.range(1).select(cf.parsed(F.lit(text)).alias("t")).first()["t"] is None


def test_plain_texts_stay_plain(shared):
    rows = [(1, 0, "system", "Be kind"), (1, 1, "user", "2 < 3 [maybe]"), (1, 2, "assistant", "yes"), (1, 3, "tool", "")]
    df = shared.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert cf.format_chats(df).first()["formatted"] == "<s>[SYS] Be kind [/SYS][INST] 2 < 3 [maybe] [/INST] yes</s>[ROLE] tool [/ROLE] </s>"


def test_escaping_the_whole_conversation(shared, monkeypatch):
    """Where the turns alone hide a conflict, the comparison of the whole finds it and all turns are escaped."""
    real = cf._comes_back
    calls = []

    def first_round_blind(formatted, turns):
        calls.append(1)
        return F.lit(True) if len(calls) == 1 else real(formatted, turns)

    monkeypatch.setattr(cf, "_comes_back", first_round_blind)
    df = shared.createDataFrame([(1, 0, "user", "a [/INST] b</s>"), (1, 1, "assistant", "[INST]"), (2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    out = cf.format_chats(df)
    monkeypatch.undo()
    got = {r[0]: [tuple(t) for t in r[1]] for r in out.select("conv_id", cf.parsed(F.col("formatted"))).collect()}
    assert got == {1: [("user", "a [/INST] b</s>"), ("assistant", "[INST]")], 2: [("user", "x")]}


def test_long_texts_and_conversations(shared):
    rows = [(1, t, "assistant" if t % 2 else "user", f"</s>{t}" * 40) for t in range(2000)] + [(2, 0, "assistant", "[INST] x " * 200_000)]
    df = shared.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: r[1:] for r in cf.format_chats(df).select("conv_id", F.size(cf.parsed(F.col("formatted"))), F.sha2(cf.learned_text(F.col("formatted"), F.col("loss")), 256)).collect()}
    for i in (1, 2):
        turns = in_order(rows)[i]
        assert got[i] == (len(turns), hashlib.sha256("".join(x for r, x in turns if r == "assistant").encode()).hexdigest())


def test_query_against_sql(shared, tmp_path):
    rows = odd_rows()
    shared.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(cf.OP13_SQL)
    names = [c[0] for c in want.description]
    key = lambda r: (r[0] is None, r[0] or 0)
    got = [tuple(r) for r in cf.op13_chat_format(shared, str(tmp_path)).select(*names).collect()]
    assert sorted(got, key=key) == sorted(want.fetchall(), key=key)


def test_empty_table(shared):
    assert cf.format_chats(shared.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
