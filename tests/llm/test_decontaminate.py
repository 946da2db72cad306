import re
from collections import Counter, defaultdict

from wellspark.llm.decontaminate import contaminated, drop_contaminated, op2_decontamination

from .helpers import SF, documents, prose

WORDS = lambda t: re.findall(r"\w+", (t or "").lower())


def bag(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items, threshold=0.8):
    """Every window of the item's length against every item."""
    shingles = defaultdict(set)
    bags = {i: (len(WORDS(t)), bag(WORDS(t))) for i, t in items if WORDS(t)}
    for i, (_, c) in bags.items():
        for s in c:
            shingles[s].add(i)
    found = {}
    for d, text in docs:
        w = WORDS(text)
        some = {i for k in range(1, 6) for p in range(len(w) - k + 1) for i in shingles.get(tuple(w[p:p + k]), ())}
        for i in some:
            n, c = bags[i]
            best = 0.0
            for s in range(max(1, len(w) - n + 1)):
                b = bag(w[s:s + n])
                common = sum((b & c).values())
                best = max(best, common / (sum(b.values()) + sum(c.values()) - common))
            if best >= threshold:
                found[d, i] = round(best, 9)
    return found


def got(df):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in df.collect()}


def test_whole_tables_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute([d for d in docs if len(d[1]) < 8000], items)
    have = {k: v for k, v in got(op2_decontamination(spark, SF)).items() if len(dict(docs)[k[0]]) < 8000}
    assert want and have == want


def test_altered_short_long_and_missing(spark):
    items = [(1, prose(40, 1)), (2, "two words"), (3, None), (4, ""), (5, prose(30, 5)), (6, prose(30, 5)),
             (None, "Null item of several words here")]
    a = WORDS(items[0][1])
    rows = [(1, prose(50, 2) + " " + items[0][1] + " " + prose(50, 3)), (2, " ".join(a[:38] + ["new", "end"])),
            (3, " ".join(a[:20] + ["other"] * 3 + a[23:])), (4, "some Two, words!"), (5, None), (6, ""),
            (7, items[4][1].upper()), (None, items[4][1]), (8, " ".join(a[:36])), (9, prose(20_000, 9) + items[0][1]),
            (10, "x " + items[0][1] + " " + items[0][1]), (10, "x " + items[0][1] + " " + items[0][1]),
            (11, "null ITEM of several words here")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    have = got(contaminated(documents(spark, rows, key=1, h="x", sh=2, n=3), bench))
    assert have == brute(rows, items)
    assert (3, 1) not in have and have[(2, 1)] < 1 and (None, 5) in have and (11, None) in have


def test_stage_drops_only_contaminated_rows(spark):
    item = prose(30, 4)
    rows = [(1, "a " + item), (2, "clean text"), (3, None), (None, item), (2, "clean text")]
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = drop_contaminated(documents(spark, rows, key="k"), bench)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(2, "clean text"), (2, "clean text"), (3, "")]
    assert contaminated(documents(spark, []), bench).count() == 0
    assert drop_contaminated(documents(spark, rows), bench.limit(0)).count() == 5


def test_moved_parts(spark):
    """Items of which a part has changed places inside a longer document."""
    items = [(n, prose(n, n, 10_000)) for n in (30, 60, 100)] + [(7, "one two three"), (8, "z " * 40)]
    rows = []
    for n, text in items[:3]:
        a = WORDS(text)
        for q in (1, n // 4, n // 2, n - 3):
            moved = " ".join(a[-q:] + a[:-q])
            rows += [(len(rows), prose(200, 900 + q, 10_000) + " " + moved + " " + prose(200, 901 + q, 10_000)),
                     (len(rows) + 1, moved), (len(rows) + 2, prose(9, 3) + " " + moved), (len(rows) + 3, moved + " tail")]
        third = n // 3
        rows.append((len(rows), prose(50, 1) + " " + " ".join(a[third:2 * third] + a[:third] + a[2 * third:]) + " end"))
    rows += [(200, "x one two three y one two"), (201, "z " * 300), (202, "z " * 36 + "y"), (203, "z " * 30)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    have = got(contaminated(documents(spark, rows), bench))
    assert have == brute(rows, items)
    assert {(d, i) for d, i in have if d < 200 and have[d, i] < 1 and d % 4 == 0}
