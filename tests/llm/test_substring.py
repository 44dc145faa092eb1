import hashlib
from collections import Counter

from covenant.llm import substring
from tests.llm.corpora import documents, no_documents, texts, words


def brute_force(docs, width):
    first = {}
    for key, text in docs:
        tokens = words(text)
        for i in range(len(tokens) - width + 1):
            window = tuple(tokens[i : i + width])
            first[window] = min(first.get(window, float("inf")), float("inf") if key is None else key)
    out = []
    for key, text in docs:
        tokens = words(text)
        gone = set()
        for i in range(len(tokens) - width + 1):
            if first[tuple(tokens[i : i + width])] < (float("inf") if key is None else key):
                gone |= set(range(i, i + width))
        kept = " ".join(t for i, t in enumerate(tokens) if i not in gone)
        out.append((key, len(tokens), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_matches_brute_force(spark):
    found = substring.remove_repeats(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute_force(texts(), 13)
    untouched = [r for r in found if r.n_removed == 0]
    assert all(r.kept_text == (r.text or "") for r in untouched)
    assert all(words(r.kept_text) for r in found if 0 < r.n_removed < r.n_words)


def test_a_full_sketch_loses_nothing(spark):
    # One block of cells for everything, and a narrow window: most windows pass the filter, the result is the same.
    found = substring.remove_repeats(documents(spark), width=2, depth=1, max_cells=substring.BLOCK).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == brute_force(texts(), 2)


def test_empty_table_and_other_columns(spark):
    assert substring.remove_repeats(no_documents(spark)).collect() == []
    assert set(documents(spark).columns) <= set(substring.remove_repeats(documents(spark)).columns)


def test_gaps_round_trip():
    import numpy as np

    cells = np.array([0, 1, 254, 255, 256, 511, 5000, 4194303], np.uint32)
    assert substring.read_gaps(substring.write_gaps(cells)).tolist() == cells.tolist()
    assert substring.read_gaps(substring.write_gaps(cells[:0])).tolist() == []


def test_stretches_are_decided_in_pieces_of_any_size(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = []
    for row in range(400):
        n = int(rng.integers(1, 9))
        windows = np.zeros(n, substring._WINDOW)
        windows["hash"], windows["check"] = rng.integers(0, 40, n), rng.integers(0, 3, n)
        rows.append((int(rng.choice([1, 1, 1, 2, 5, 9])), int(rng.integers(0, 12)), row, int(rng.integers(0, 100)), windows))
    rows.sort(key=lambda r: r[0])
    # A window's anchor is given by the window in real stretches; here it is part of what is compared.
    least = {}
    for anchor, doc, _, _, windows in rows:
        for w in windows.tolist():
            least[anchor, w] = min(least.get((anchor, w), 99), doc)
    wanted = {}
    for anchor, doc, row, place, windows in rows:
        at = {place + i for i, w in enumerate(windows.tolist()) if doc > least[anchor, w]}
        if at:
            wanted[row] = at
    for anchor in {r[0] for r in rows}:
        for r in rows:
            if r[0] == anchor:
                r[4]["hash"] += np.uint64(1000 * anchor)
    batches = [
        pa.RecordBatch.from_pydict(
            {
                "anchor": pa.array([r[0] for r in part], pa.int64()),
                "doc_id": pa.array([r[1] for r in part], pa.int64()),
                "row": pa.array([r[2] for r in part], pa.int64()),
                "place": pa.array([r[3] for r in part], pa.int32()),
                "windows": pa.array([r[4].tobytes() for r in part], pa.binary()),
                "flags": pa.nulls(len(part), pa.binary()),
            }
        )
        for part in (rows[i : i + 37] for i in range(0, len(rows), 37))
    ]
    for decided in (10, 100, 10**6):
        monkeypatch.setattr(substring, "DECIDED", decided)
        got = {}
        for batch in substring._decide(iter(batches)):
            for row, flags in zip(batch.column("row").to_pylist(), batch.column("flags").to_pylist(), strict=True):
                got.setdefault(row, set()).update(np.frombuffer(flags, "<u4").tolist())
        assert got == wanted


def test_the_sketch_is_given_back(spark, monkeypatch):
    """Workers hold a broadcast for as long as they live, unless it is taken back."""
    made = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append(broadcast(self, value)) or made[-1])
    given_back = []
    kind = type(spark.sparkContext.broadcast(b""))
    destroy = kind.destroy
    monkeypatch.setattr(kind, "destroy", lambda self, blocking=False: given_back.append(self) or destroy(self, blocking))
    assert substring.remove_repeats(documents(spark)).count() == len(texts())
    assert made[1] in given_back


def test_files_are_read_in_small_batches(spark):
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.unset(setting)
    substring.remove_repeats(documents(spark))
    assert int(spark.conf.get(setting)) <= 1_000
