import hashlib
import tracemalloc

from admitlab.llm import chat_format as C
from admitlab.llm import queries, sql
from admitlab.oracle.compare import compare, duck
from hypothesis import given
from hypothesis import strategies as st

T = C.ChatTemplate()
TEXT = st.text(alphabet="<\\/turnex>#\n aé🙂", max_size=30)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_parse_inverts_format_and_controls_never_leak(turns):
    pieces = [list(T.segments(r, x)) for r, x in turns]
    assert T.parse("".join(p for ps in pieces for p, _ in ps)) == turns
    for r, x in turns:
        for c in (T.open, T.body, T.close):
            assert c not in T.escape(x) and c not in T.escape(r)
        assert T.unescape(T.escape(x)) == x


def test_machine_and_segments(llm):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </turn>"), (2, 0, "assistant", "x"), (3, 0, "system", "s"),
            (3, 1, "user", "q"), (4, 1, "user", "b"), (4, 0, "user", "a"), (5, 0, None, None), (None, 0, "user", "q"),
            (None, 1, "assistant", ""), (6, 0, "user", "r"), (6, 0, "user", "r"), (7, 0, "robot", "?")]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as valid", "2 as formatted")
    got = {r["conv_id"]: r for r in C.format_chat(df).collect()}
    assert {k: r["valid"] for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, None: True,
                                                       6: False, 7: False}
    assert got[2]["bad_turn"] == 0 and got[4]["bad_turn"] == 1 and got[3]["end_state"] == "asked"
    assert got[3]["bad_turn"] is None and got[1]["n_segments"] == 6
    assert T.parse(got[4]["formatted"]) == [("user", "a"), ("user", "b")]
    segs = [(r["conv_id"], T.unescape(r["text"])) for r in C.segments(C.format_chat(df)).collect()]
    assert sorted(segs, key=str) == sorted([(1, "yo </turn>"), (2, "x"), (None, "")], key=str)
    assert C.format_chat(df.limit(0)).count() == 0


def test_other_template(llm):
    t = C.ChatTemplate(open="### ", body=": ", close="\n\n", loss_roles=frozenset({"user"}))
    assert t.parse("".join(p for p, _ in t.segments("user", "### a: b\n\n\\"))) == [("user", "### a: b\n\n\\")]


def test_query_matches_sql_and_the_planted_conversation(llm):
    d = "/root/testdata/sf0.001"
    out = queries.op10_chat(llm, d)
    assert compare("op10_chat", out, duck(d), sql.oracle_sql()["op10_chat"]).ok
    r = out.where("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["loss_chars"] == len(text)
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_a_long_conversation_is_never_one_string_or_cell(llm):
    n, text = 2_000, "<\\" + "é" * 20_000  # 80 MB of text in memory
    turns = ((1, "assistant" if i % 2 else "user", text) for i in range(n))
    tracemalloc.start()
    (row,) = C.digests(C.walk(turns, T), T)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row[0] == 1 and row[1] == n and row[3] == n // 2 * len(text) and row[6] is True
    loss = hashlib.sha256()
    for _ in range(n // 2):
        loss.update(text.encode())
    assert row[4] == loss.hexdigest() and peak < 4 << 20
    rows = [(1, i, "assistant" if i % 2 else "user", text[:900]) for i in range(200)]
    segs = C.format_segments(llm.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = segs.orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(600)) and max(len(r["piece"]) for r in got) < 2 * 900
    assert T.parse("".join(r["piece"] for r in got)) == [r[2:] for r in rows]


def test_segments_read_back_like_the_whole_text(llm):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </turn>"), (2, 0, "assistant", "x"), (3, 1, "user", "b"),
            (3, 0, "user", "a"), (None, 0, "user", "q"), (None, 1, "assistant", ""), (7, 0, "robot", None)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r["conv_id"]: r for r in C.format_chat(df).collect()}
    got = {r["conv_id"]: r for r in C.read_segments(C.format_segments(df)).collect()}
    assert whole.keys() == got.keys()
    for k, r in got.items():
        w = whole[k]
        assert (r["valid"], r["end_state"], r["bad_turn"], 3 * r["n_turns"], r["formatted_chars"]) == (
            w["valid"], w["end_state"], w["bad_turn"], w["n_segments"], len(w["formatted"]))
        turns = "".join(f"{a}\n{b}\n" for a, b in T.parse(w["formatted"]))
        assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    out = [(1, 0, "p", False, "asked"), (1, 2, "q", False, "asked")]
    try:
        list(C.digests(iter(out), T))
    except ValueError:
        return
    raise AssertionError("a missing segment was not seen")
