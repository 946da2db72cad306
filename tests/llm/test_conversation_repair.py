"""Conversation repair against SQL, against all edit sequences, and over conversations split between tasks."""

import hashlib
import itertools
import random
import re

import pytest

from tests.llm.helpers import SF
from tests.oracle import compare, duck
from wellspark.llm import conversation_repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
INSERTS = ["", "u", "a", "ua", "au"]


def exhaustive(rows):
    """Least (cost, audit, repaired initials) over all edits with up to two inserts in a place."""
    best = None
    choices = []
    for initial, fault in rows:
        extra = 5 if fault == "truncated" else 0
        own = [("D", 2, "")]
        if fault not in ("blank", "duplicate"):
            own += [("K", extra, initial or "?"), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
        choices.append([("I" * len(i) + e, 5 * len(i) + c, i + r) for i in INSERTS for e, c, r in own])
    choices.append([("I" * len(i), 5 * len(i), i) for i in INSERTS])
    for picked in itertools.product(*choices):
        roles = "".join(p[2] for p in picked)
        if re.fullmatch("(s?(ua)+)?", roles):
            found = sum(p[1] for p in picked), "".join(p[0] for p in picked), roles
            best = found if best is None or found < best else best
    return best


def test_parser_tells_the_grammar():
    parser = R.Parser(R.GRAMMAR)
    for n in range(7):
        for word in itertools.product("sua", repeat=n):
            at = [0]
            for t in word:
                at = [to for s in at for to in parser.moves[s][t]]
            assert any(parser.accepts[s] for s in at) == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))


def test_ambiguous_and_endless_grammars():
    """Two ways to read the same roles are two stacks until they meet; nesting without bound is refused."""
    both = R.Repairer((("C", "A"), ("C", "B"), ("A", "ua"), ("B", "uX"), ("X", "a")))
    cost, audit, _ = both.finish((s, c, (a,), r) for s, c, a, r in both.run([("u", ""), ("a", "")]))
    assert (cost, audit) == (0, "KK")
    with pytest.raises(ValueError):
        R.Parser((("C", "uCa"), ("C", "")))


def test_edits_are_the_least_of_all():
    rng, repairer = random.Random(4), R.Repairer()
    for _ in range(150):
        rows = [(rng.choice("suuaa") if rng.random() < 0.95 else "", rng.choice(["", "", "truncated", "duplicate", "blank"]))
                for _ in range(rng.randrange(5))]
        found = repairer.finish((s, c, (a,), r) for s, c, a, r in repairer.run(rows))
        assert found[:2] == exhaustive(rows)[:2], rows


def test_blocks_put_together_are_the_whole():
    rng, repairer = random.Random(5), R.Repairer()
    for _ in range(40):
        rows = [(rng.choice("sua"), rng.choice(["", "", "", "truncated", "duplicate", "blank"])) for _ in range(40)]
        whole = repairer.finish((s, c, (a,), r) for s, c, a, r in repairer.run(rows))
        cuts = [0, *sorted(rng.sample(range(1, 40), 3)), 40]
        blocks = [[(start, *found) for start in range(10) for found in repairer.run(rows[a:b], start)]
                  for a, b in zip(cuts, cuts[1:])]
        assert repairer.join(blocks) == whole


def test_query_matches_sql(spark):
    r = compare(spark, duck(SF), "op12_conversation_repair", SF, R.op12_conversation_repair, R.OP12_SQL)
    assert r["ok"], r


def hard_rows():
    rng = random.Random(6)
    texts = ["Yes.", "no", "", " \n\t", None, "What? ", "fine!\x0b", "…", "a.b", "Same."]
    roles = ["user", "user", "assistant", "assistant", "system", None, "", "tool", "User"]
    rows = [(c, rng.choice([None, rng.randrange(12), t]), rng.choice(roles), rng.choice(texts))
            for c in [*range(40), None] for t in range(rng.randrange(9))]
    rows += [(900, t % 700, "user" if t % 2 else "assistant", f"turn {t % 333}" + "." * (t % 3)) for t in range(2500)]
    rows += [(901, None, rng.choice(roles), f"{rng.randrange(400)}." * 3) for _ in range(1500)]   # one turn number
    rows += [(902, 5, "user", "again.")] * 700 + [(903, 1, "user", "long. " * 40_000), (903, 2, "assistant", "yes." * 9)]
    return rows


def test_hard_rows_and_split_conversations_match_sql(spark):
    """Ties, repeated rows, NULLs everywhere, one long text, conversations over many tasks; clashing columns."""
    rows = spark.createDataFrame(hard_rows(), SCHEMA).selectExpr("*", "1 AS n", "'x' AS audit", "2 AS part", "3 AS place")
    con = duck(SF)
    con.execute("DROP VIEW conversations")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in hard_rows()])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = R.edit_blocks(R.find_faults(rows)).filter("conv_id in (900, 901)").groupBy("conv_id").agg(
            {"part": "max", "*": "count"}).collect()
        assert len(blocks) == 2 and all(b["count(1)"] > 2 for b in blocks)  # both lie in several tasks
        r = compare(spark, con, "repair", SF, lambda *_: R.repair_report(R.damage(rows), rows), R.OP12_SQL)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert r["ok"], r


def test_repaired_rows_follow_the_grammar(spark):
    rows = spark.createDataFrame(hard_rows(), SCHEMA)
    repaired = R.repair_conversations(rows).collect()
    report = {r.conv_id: r for r in R.repair_report(rows, rows).collect()}
    by = {}
    for r in sorted(repaired, key=lambda r: (str(r.conv_id), r.place)):
        by.setdefault(r.conv_id, []).append(r)
    assert set(by) <= set(report)
    for conv_id, r in report.items():
        mine = by.get(conv_id, [])
        assert [m.place for m in mine] == list(range(1, len(mine) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(m.role[:1] for m in mine))
        assert "".join(m.edit for m in mine) == r.audit.replace("D", "")
        assert all(m.text == "" and m.turn is None for m in mine if m.edit == "I")
        text = "\n".join(f"{m.role}:{m.text}" for m in mine)
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.repair_report(R.damage(none), none).count() == 0
    assert R.repair_conversations(none).count() == 0
    gone = spark.createDataFrame([(1, 2, "user", "Hi.")], SCHEMA)
    row = R.repair_report(gone.limit(0), gone).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
