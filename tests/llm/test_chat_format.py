"""Operator 9: rotation, masks, parts and edge cases (the oracle test holds the SQL)."""

from bellwether.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, piece string"


def render(rows, me):
    text, spans = "", []
    for who, said in rows:
        head = "<|system|>\n" if who == "system" else "<|assistant|>\n" if who == me else f"<|user name={who}|>\n"
        text += head
        if who == me:
            spans.append((len(text), len(text) + len(said) + len(C.END)))
        text += said + C.END
    return text, spans


def test_every_participant_gets_a_perspective(spark):
    rows = [(1, 0, "system", "be kind", ""), (1, 1, "ann", "hé 😀", ""), (1, 2, "bob", "yo", ""), (1, 3, "cy", "", ""),
            (1, 4, "ann", None, "")]
    got = {r["perspective"]: r for r in C.rotate(spark.createDataFrame(rows, SCHEMA)).collect()}
    plain = [(r[2], r[3] or "") for r in rows]
    assert sorted(got) == ["ann", "bob", "cy"]
    for me, r in got.items():
        text, spans = render(plain, me)
        assert r["text"] == text and [tuple(s) for s in r["mask"]] == spans and r["n_turns"] == r["n_rows"] == 5


def check_pieces(rows, out):
    """Pieces in order make each perspective's whole dialogue, and their spans count from its beginning."""
    for me in sorted({r[2] for r in rows}):
        text, spans = render([(r[2], r[3]) for r in rows], me)
        mine = sorted((r for r in out if r["perspective"] == me), key=lambda r: r["piece"])
        assert "".join(r["text"] for r in mine) == text
        assert [tuple(s) for r in mine for s in r["mask"]] == spans
        assert [r["offset"] for r in mine] == [sum(len(q["text"]) for q in mine[:k]) for k in range(len(mine))]
        assert sum(r["n_turns"] for r in mine) == len(rows)


def test_long_and_sparse_dialogues_are_whole(spark):
    for step, n in ((1, 100), (1, 1000), (100, 300)):
        rows = [(1, step * t, "abc"[t % 3], f"turn {t}", "") for t in range(n)]
        out = C.rotate(spark.createDataFrame(rows, SCHEMA)).collect()
        assert [r["piece"] for r in out] == [0, 0, 0] and {r["n_turns"] for r in out} == {n}
        check_pieces(rows, out)


def test_pieces_of_a_conversation_over_the_bound(spark):
    rows = [(1, 7 * t, "ab"[t % 2], f"t{t}" * (t % 9), "") for t in range(150)]
    out = C.rotate(spark.createDataFrame(rows, SCHEMA), piece_chars=200).collect()
    assert len({r["piece"] for r in out}) > 5
    check_pieces(rows, out)
    long = [(1, t, "ab"[t % 2], "x" * 300_000, "") for t in range(60)]           # 18 million characters, over the bound
    out = C.rotate(spark.createDataFrame(long, SCHEMA)).collect()
    assert {r["piece"] for r in out} == {0, 1}
    check_pieces(long, out)


def test_edges(spark):
    rows = [(None, 0, "user", "x", ""), (None, 1, None, "y", ""), (3, None, "", "z", ""), (3, 0, "user", "w", ""),
            (4, 0, "system", "only", ""), (5, 0, "user", "twice", ""), (5, 0, "user", "twice", "")]
    got = {(r["conv_id"], r["perspective"], r["piece"]): r for r in C.query(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {(None, "user", 0), (None, "unknown", 0), (3, "unknown", 0), (3, "user", 0), (5, "user", 0)}
    five = got[5, "user", 0]
    assert (five["n_turns"], five["n_rows"]) == (1, 2)
    text = five["text"]
    a, b = map(int, five["mask"].split("-"))
    assert text[a:b] == "twice" + C.END and five["n_trained"] == b - a
    assert got[3, "user", 0]["text"].startswith("<|user name=unknown|>\nz")          # the null turn comes first
    assert C.query(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = C.query(spark.createDataFrame([(1, 0, "a", "b", "")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_and_ties_are_one_dialogue_as_in_the_oracle(spark):
    """9 copies of 8 turns, and 100 ties of one turn number: neighbours stay together, row for row the SQL's result."""
    import duckdb
    from bellwether.llm.oracle import OP9
    rows = [(1, t, "ab"[t % 2], f"t{t}", "") for t in range(8) for _ in range(9)]
    rows += [(2, 0, "abc"[k % 3], f"tie {k:03}", "") for k in range(100)] + [(None, None, "a", "x", "")] * 70
    rows += [(3, 50 * t, "ab"[t % 2], f"long {t}", "") for t in range(200)]
    got = sorted(map(tuple, C.query(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, piece VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
    assert got == sorted(con.execute(OP9).fetchall(), key=str)
    assert [r[4:6] for r in got if r[0] == 1] == [(8, 72)] * 2 and [r[4] for r in got if r[0] == 3] == [200] * 2


def test_ties_over_the_bound_are_split_at_consecutive_turns(spark):
    rows = [(1, k // 50, "ab"[k % 2], f"{k:04}", "") for k in range(300)]
    out = C.rotate(spark.createDataFrame(rows + [(1, 0, "a", "0000", "")] * 100, SCHEMA), piece_chars=100).collect()
    check_pieces(sorted(rows, key=lambda r: (r[1], r[2], r[3])), out)
    assert {r["n_turns"] for r in out} == {20} and sum(r["n_rows"] for r in out) == 2 * 400
