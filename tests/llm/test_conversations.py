import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from riskloom.llm import conversations as cv
from riskloom.llm.shared import read

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
GIVEN = {"": "user", "s": "user", "u": "assistant", "a": "user"}
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = [" " if x is None else x for x in (role, text)]
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def plain_repair(rows):
    """Every audit is kept as a text; of all ways to a state the cheapest forty go on, so ties are compared whole."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = {r[1] for r in rows if r[1] is not None}
    seen, faults, ways = set(), [], {"": [(0, "", ())]}

    def inserted(ways):
        out = {}
        for (state, held), many in product(ways.items(), range(3)):
            lines, end = (), state
            for _ in range(many):
                lines += ((GIVEN[end], ""),)
                end = GIVEN[end][0]
            out.setdefault(end, []).extend((c + 2 * many, a + "I" * many, w + lines) for c, a, w in held)
        return out

    for _, _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        more = {}
        for state, held in inserted(ways).items():
            for c, a, w in held:
                more.setdefault(state, []).append((c + 3, a + "D", w))
                if fault not in ("blank", "duplicate"):
                    c += fault == "truncated"
                    more.setdefault(GIVEN[state][0], []).append((c + 2, a + "R", (*w, (GIVEN[state], text))))
                    if role[:1] and role[0] in NEXT[state]:
                        more.setdefault(role[0], []).append((c, a + "K", (*w, (role, text))))
        ways = {s: sorted(set(held))[:40] for s, held in more.items()}
    cost, audit, lines = min(w for s, held in inserted(ways).items() if s in ("", "a") for w in held)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    told = "\n".join(f"{r}:{t}" for r, t in lines)
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(told.encode()).hexdigest())


def plain(rows):
    hurt = plain_damage(rows)
    return {i: plain_repair([r for r in hurt if r[0] == i]) for i in {r[0] for r in rows}}


def answer(df):
    rows = df.select(*COLUMNS).collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows():
    rnd = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Aide"]
    texts = ["hi.", "yes!", "cut", "", "  ", None, "ok?\n", "é", "a.b. \t"]
    return [(c, rnd.choice([None, 0, 1, 2, 3, 5, 9, 12, 15]), rnd.choice(roles), rnd.choice(texts)) for c in [*range(150), None] for _ in range(rnd.choice([1, 2, 5, 9, 14]))]


@pytest.fixture(scope="module")
def odd(shared, tmp_path_factory):
    rows = odd_rows()
    folder = str(tmp_path_factory.mktemp("odd"))
    df = shared.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, edit string")
    df.repartition(5).write.parquet(f"{folder}/conversations.parquet")
    return folder, plain(rows)


def test_whole_table_against_plain_repair(shared):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read(shared, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert answer(cv.op12_conversation_repair(shared, folder)) == plain(rows)


@pytest.mark.parametrize("held", [cv.HELD, 1, 3])
def test_odd_rows_and_spilled_pieces(shared, odd, held, monkeypatch):
    folder, want = odd
    whole = cv.repair
    monkeypatch.setattr(cv, "repair", lambda df: whole(df, held=held))
    assert answer(cv.op12_conversation_repair(shared, folder)) == want


def test_pieces_bounded_by_bytes(shared, odd, monkeypatch):
    folder, want = odd
    whole = cv.repair
    monkeypatch.setattr(cv, "repair", lambda df: whole(df, held_bytes=200))
    shared.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert answer(cv.op12_conversation_repair(shared, folder)) == want
    finally:
        shared.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_long_conversation_in_phase_and_out_of_phase(shared):
    """Two ways stay open to the end, so nothing is decided before the last row."""
    rows = [(1, t, "tool", f"row {t}.") for t in range(121)] + [(2, t, "user" if t % 2 else "assistant", "x" * 2000 + f"{t}!") for t in range(90)]
    df = shared.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = cv.repair(df, held=10)
    got = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in cv.digests(edits).collect()}
    cost = {r["conv_id"]: r["cost"] for r in cv.summary(edits).collect()}
    for i in (1, 2):
        want = plain_repair([r for r in rows if r[0] == i])
        assert (cost[i], *got[i]) == want[5:]


def test_the_rows_that_come_out(shared):
    rows = [(1, 0, "system", "Be kind."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Hi."), (1, 4, "user", "cut"), (1, 4, "user", " ")]
    df = shared.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r["place"], r["part"], r["edit"], r["role"], r["text"], r["fault"]) for r in cv.repair(df).orderBy("place", "part").collect()]
    assert got[:5] == [
        (1, 0, "K", "system", "Be kind.", None), (2, 0, "I", "user", "", None), (2, 1, "K", "assistant", "Hi.", None),
        (3, 0, "D", "assistant", "Hi.", "duplicate"), (4, 0, "D", "user", " ", "blank"),
    ]
    assert [g[2:] for g in got[5:]] == [("D", "user", "cut", "truncated")]  # deleting costs 3, keeping it 1 and an answer 2
    assert sum(r["cost"] for r in cv.repair(df).collect()) == plain_repair(rows)[5]


def test_empty_table(shared, tmp_path):
    shared.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert cv.op12_conversation_repair(shared, str(tmp_path)).count() == 0
