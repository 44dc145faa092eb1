from collections import Counter

from covenant.llm import decontaminate
from tests.llm.corpora import documents, no_documents, texts, words

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def benchmark(spark):
    own = dict(t for t in texts() if t[0] is not None)
    tokens = own[12].split()
    items = [
        (1, " ".join(tokens[100:130])),
        (2, (own[7] or "").upper()),
        (3, " ".join(tokens[3000:3009])),
        (4, None),
        (5, ""),
        (6, "the, The! THE the-the the the the the the the the"),
        (7, "Ünïcode"),
        (8, " ".join(tokens[500:509] + ["never"])),
        (9, " ".join(tokens[105:125])),
        (9, " ".join(tokens[105:125])),
        (None, " ".join(tokens[700:720])),
        (11, "?!"),
    ]
    return items, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        tokens = words(text, PATTERN, fold=True)
        size = min(10, len(tokens))
        for i in range(len(tokens) - size + 1) if size else ():
            windows.setdefault(tuple(tokens[i : i + size]), set()).add(item)
    out = []
    for key, text in docs:
        tokens = words(text, PATTERN, fold=True)
        hit, listed = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(tokens) - size + 1):
                window = tuple(tokens[i : i + size])
                if window in windows:
                    hit |= set(range(i, i + size))
                    listed |= windows[window]
        listed = sorted(str(i) for i in listed if i is not None)
        out.append((key, len(tokens), len(hit), ",".join(listed), bool(hit)))
    return Counter(out)


def test_matches_brute_force(spark):
    items, table = benchmark(spark)
    found = decontaminate.find_contamination(documents(spark), table)
    assert found.columns.count("items") == 1 and "score" in found.columns
    rows = Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in found.collect())
    assert rows == brute_force(texts(), items)


def test_empty_tables(spark):
    items, table = benchmark(spark)
    assert decontaminate.find_contamination(no_documents(spark), table).collect() == []
    found = decontaminate.find_contamination(documents(spark), table.limit(0))
    assert Counter((r.doc_id, r.n_hit, r.contaminated) for r in found.collect()) == Counter((i, 0, False) for i, _ in texts())


def test_no_python_on_the_way(spark):
    _, table = benchmark(spark)
    plan = decontaminate.find_contamination(documents(spark), table)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
