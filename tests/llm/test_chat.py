import random
import re

import pytest
from pyspark.sql import functions as F

from covenant.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window int, start string, tokens string"


def turns():
    rng = random.Random(2)
    nasty = ["<turn role=\"x\">", "</turn>", "\\", "\\\\", "\\l", "\\\\l", "<", "\\<", "\"", "\\q", "\n", "é\U0001f600", "### "]
    rows = []
    for conv in range(12):
        n = rng.choice([1, 2, 5, 40])
        for turn in range(n):
            role = "system" if turn == 0 and conv % 2 else ("assistant" if turn % 2 else "user")
            text = "".join(rng.choice([*nasty, "word ", "Größe "]) for _ in range(rng.randrange(0, 40)))
            rows.append((conv, turn, role, text))
    rows += [(50, 0, "user", None), (50, 1, "assistant", ""), (50, 2, None, "x"), (50, 3, 'od"d<\\role', "y")]
    rows += [(51, 0, "assistant", "long " * 5000), (51, 1, "user", "?"), (51, 2, "assistant", "end")]
    rows += [(52, 0, "user", "a"), (52, 0, "user", "a"), (52, 0, "assistant", "b"), (52, None, "assistant", "first")]
    rows += [(None, 0, "user", "u"), (None, 1, "assistant", "v"), (53, 0, "system", "only")]
    return [(*r, 1, "s", "t") for r in rows]


def ordered():
    out = {}
    for conv, turn, role, text, *_ in turns():
        out.setdefault(conv, []).append((float("-inf") if turn is None else turn, role or "", text or ""))
    return {k: [(r, t) for _, r, t in sorted(v)] for k, v in out.items()}


def test_round_trip_and_mask(spark):
    budget, history = 120, 30
    windows = chat.read_turns(chat.format_chat(spark.createDataFrame(turns(), SCHEMA).repartition(3), budget, history))
    learned = windows.withColumn("learned", chat.learned_text(windows)).orderBy("conv_id", "window").collect()
    found, texts, spans = {}, {}, {}
    for r in learned:
        found.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        texts.setdefault(r.conv_id, []).append(r.learned)
        spans.setdefault(r.conv_id, []).append(r)
    wanted = ordered()
    assert found == wanted
    for conv, own in wanted.items():
        assert "".join(texts[conv]) == "".join(t for role, t in own if role == "assistant")
        assert [r.window for r in spans[conv]] == list(range(len(spans[conv])))
        for r in spans[conv][1:]:
            # What is repeated: the system turn, and the turns just before the window's own.
            system = own[0][0] == "system"
            assert r.repeated >= system
            if system:
                assert r.text.startswith('<turn role="system">')
    assert any(r.repeated > 1 for r in learned)


def counted(text):
    return len(re.findall(chat.TOKEN, text)) + chat.MARKS


@pytest.mark.parametrize("budget, history", [(200, 40), (90, 60), (64, 0), (1024, 128)])
def test_windows_keep_to_the_budget(spark, budget, history):
    windows = chat.read_turns(chat.format_chat(spark.createDataFrame(turns(), SCHEMA).repartition(5), budget, history)).collect()
    found = {}
    for r in windows:
        found.setdefault(r.conv_id, []).append(r)
    for conv, own in ordered().items():
        system = counted(own[0][1]) if own[0][0] == "system" else 0
        rest = [counted(t) for _, t in own[system > 0 :]]
        place = 0
        for r in sorted(found[conv], key=lambda r: r.window):
            again = r.repeated - (system > 0 and r.window > 0)
            mine = len(r.turns) - (system > 0 and r.window == 0)
            repeated, held = sum(rest[place - again : place]), sum(rest[place : place + mine])
            assert repeated <= history
            assert system + repeated + held <= budget or mine <= 1 and system + held > budget and not again
            place += mine
        assert place == len(rest)


def windows_of(spark, sizes, **options):
    rows = [(1, i, "user", "", n) for i, n in enumerate(sizes)]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, ids int")
    found = chat.read_turns(chat.format_chat(given, tokens="ids", **options)).orderBy("window").collect()
    return [len(r.turns) for r in found]


def test_windows_are_chosen_against_the_budget(spark):
    assert windows_of(spark, [100, 300, 900, 50]) == [2, 1, 1]
    assert windows_of(spark, [440] * 8) == [2, 2, 2, 2]
    assert windows_of(spark, [1020] * 3) == [1, 1, 1]
    assert windows_of(spark, [None, -5, 5000, 1]) == [2, 1, 1]
    # Two neighbouring windows never fit into one.
    rng = random.Random(5)
    sizes = [rng.randrange(1, 500) for _ in range(300)]
    counts = windows_of(spark, sizes)
    assert sum(counts) == 300 and len(counts) <= 2 * sum(n + chat.MARKS for n in sizes) / (chat.BUDGET - chat.HISTORY) + 1


def test_one_conversation_in_many_ranges(spark):
    rows = [(1, i, "system" if i == 0 else ("assistant" if i % 2 else "user"), f"t{i} " * (i % 40)) for i in range(4000)]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        windows = chat.read_turns(chat.format_chat(given))
        found = windows.withColumn("learned", chat.learned_text(windows)).orderBy("window").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.window for r in found] == list(range(len(found))) and len(found) > 50
    assert [(t.role, t.text) for r in found for t in r.turns] == [(r, t) for _, _, r, t in rows]
    assert "".join(r.learned for r in found) == "".join(t for _, _, r, t in rows if r == "assistant")


def test_empty_table(spark):
    assert chat.format_chat(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_on_the_way(spark, monkeypatch):
    # Without the written tables between, the plan is that of the whole way.
    monkeypatch.setattr(chat, "written", lambda df, path: df)
    plan = chat.read_turns(chat.format_chat(spark.createDataFrame(turns(), SCHEMA)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
