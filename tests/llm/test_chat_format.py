from collections import defaultdict

from tests.oracle import compare, duck
from wellspark.llm.chat_format import OP9_SQL, format_chats, numbered_turns, op9_chat_formatting

from .helpers import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos int, block int, p1 int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def brute(rows):
    """{rendered: (conv_id, turns, copies)} by comparing every pair of conversations; turn numbers must differ."""
    convs = defaultdict(list)
    for c, t, r, x in set(rows):
        convs[c].append((t, r, x))
    seqs = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: (y[0] is None, y[0]))] for c, v in convs.items()}
    out = {}
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            continue
        same = [k for k, o in seqs.items() if o == s]
        if c == min(same, key=lambda k: (k is None, k)):
            text = "".join(f"<|im_start|>{r if r is not None else 'unknown'}\n{(x or '').replace('<|', '< |')}<|im_end|>\n"
                           for r, x in s)
            out[text] = (c, len(s), len(same))
    return out


def got(df):
    parts = defaultdict(dict)
    for r in df.collect():
        parts[r.conv_id, r.n_turns, r.copies][r.part] = r.rendered
    return {"".join(p[k] for k in sorted(p)): key for key, p in parts.items()}


def test_whole_table_matches_sql(spark):
    r = compare(spark, duck(SF), "op9", SF, op9_chat_formatting, OP9_SQL)
    assert r["ok"], r


def test_ties_agree_with_sql(spark):
    """Turns of the same number, NULL roles and texts among them."""
    rows = [(1, 5, "user", x) for x in "bca"] + [(1, 5, None, "d"), (1, 5, "user", None), (1, 5, "assistant", "z")]
    rows += [(2, 5, "user", x) for x in "cab"] + [(2, 5, None, "d"), (2, 5, "user", None), (2, 5, "assistant", "z"), (2, 6, "user", "on")]
    rows += [(3, None, "user", x) for x in "qp"] + [(3, 1, "user", "first"), (4, 1, "user", "first")]
    con = duck(SF)
    con.execute("DROP VIEW conversations")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    r = compare(spark, con, "op9", SF, lambda *_: format_chats(frame(spark, rows)), OP9_SQL)
    assert r["ok"] and r["rows"] == 2, r


def test_snapshots_copies_and_edges(spark):
    talk = [("user", "hi"), ("assistant", "hello <|im_end|>"), ("user", None), (None, "x"), ("user", "")]
    rows = [(c, t, *talk[t]) for c, n in ((1, 2), (2, 5), (3, 4), (4, 5), (None, 1)) for t in range(n)]
    rows += [(5, 10 * t, *talk[t]) for t in range(5)]                        # gaps in the numbers
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "yes"), (6, 1, "assistant", "yes"), (7, None, "user", "only")]
    rows += [(8, 0, "user", "hi"), (8, None, "assistant", None), (9, 0, "user", "")]
    rows += [(None, 1, "user", "of nobody")]
    want = brute(rows)
    assert got(format_chats(frame(spark, rows))) == want
    assert got(format_chats(frame(spark, rows), part=2, block=2)) == want
    assert format_chats(frame(spark, [])).count() == 0


def test_turns_without_numbers_are_many_blocks_too(spark):
    """One number for all turns, or none: no window holds more than a block."""
    rows = [(1, 7, "user", f"t{t:05d}") for t in range(1200)] + [(2, None, "user", f"t{t:05d}") for t in range(700)]
    rows += [(None, None, "user", f"n{t}") for t in range(500)] + [(3, 7, "user", f"t{t:05d}") for t in range(300)]
    turns = numbered_turns(frame(spark, rows), block=100)
    places = defaultdict(list)
    for r in turns.collect():
        places[r.conv_id, r.n_turns].append(r.pos)
    assert {k: sorted(v) for k, v in places.items()} == {(c, n): list(range(1, n + 1))
                                                         for c, n in ((1, 1200), (2, 700), (None, 500), (3, 300))}
    con = duck(SF)
    con.execute("DROP VIEW conversations")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    whole = lambda *_: format_chats(frame(spark, rows), part=10 ** 6, block=100)
    r = compare(spark, con, "op9", SF, whole, OP9_SQL)
    assert r["ok"], r


def test_one_huge_conversation_is_many_blocks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(1500)]
    df = format_chats(frame(spark, rows), part=500, block=100)
    assert df.count() == 6 and got(df) == brute(rows)


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a")]
    out = format_chats(frame(spark, rows)).collect()
    assert len(out) == 1 and out[0].copies == 2 and out[0].n_turns == 2
