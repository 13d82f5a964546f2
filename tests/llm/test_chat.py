"""Chat windows against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from urllib.parse import quote_plus

import pytest

from siltstone.llm import chat, queries


def expected(rows):
    conversations = defaultdict(list)
    for r in rows:
        conversations[r.conv_id].append(r)
    for key, turns in conversations.items():
        turns.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        whole = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in turns)
        loss = "".join(r.text or "" for r in turns if r.role == "assistant")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        yield key, (len(turns), digest[0], len(loss), digest[1])


def found(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_all_conversations(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    result = queries.op7_chat_formatting(spark, small)
    assert found(result) == dict(expected(turns.unionByName(chat.probe(turns)).collect()))
    assert found(result)[-7][0] == 2


HARD = [
    "\\", "<turn>", "</turn>\n", "\n</turn>\n", "x\\", "", "\n", "é漢 <", "\\<turn", "$0 \\1", "%0A+",
    "a b c d e " * 60, "long word " * 900,
]


@pytest.fixture(scope="module")
def hard_turns(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "system", "a\nb <x>%", None, ""]
    rows = []
    for conv, n in ((1, 30), (2, 2100), (3, 60), (None, 7), (4, 1)):
        for k in range(n):
            turn = rng.choice([None, *range(40)]) if conv == 3 else k
            text = "".join(rng.choice(HARD) for _ in range(rng.randint(0, 5))) if rng.random() < 0.9 else None
            rows.append((conv, turn, rng.choice(roles), text, "x", 5))
    rows += rows[:3]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, window string, segment int")


def test_hard_conversations_read_back(hard_turns):
    assert found(chat.digests(chat.formatted(hard_turns))) == dict(expected(hard_turns.collect()))


def cost(role: str, text: str) -> int:
    """Bytes of a formatted turn."""
    body = text.replace("\\", "\\\\").replace("<turn", "\\<turn").replace("</turn", "\\</turn")
    return len(f"<turn>{quote_plus(role, safe='*-._')}\n{body}\n</turn>\n".encode())


def plain_windows(rows, budget: int = chat.BUDGET):
    """(segment, window, system, repeated, own turns) of one conversation, turn by turn."""
    turns = [(r.role or "", r.text or "") for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))]
    sizes = [cost(*t) for t in turns]
    system = next((k for k, t in enumerate(turns) if t[0] == "system"), None)
    found = []
    for n, size in enumerate(sizes):
        segment, room = n // chat.SEGMENT, -1
        if found and found[-1][0] == segment:
            _, _, first, own = found[-1]
            head = sizes[system] if system is not None and system < first else 0
            room = budget - head - sum(sizes[first : own[-1] + 1])
        if room >= size:
            found[-1][3].append(n)
            continue
        for again in (2, 1, 0):
            history = sum(sizes[max(n - again, 0) : n])
            head = sizes[system] if system is not None and system < n - again else 0
            if again <= n and (not again or (history <= chat.FOR_HISTORY and head + history + size <= budget)):
                break
        number = found[-1][1] + 1 if found and found[-1][0] == segment else 0
        found.append((segment, number, n - again, [n]))
    for segment, number, first, own in found:
        head = [turns[system]] if system is not None and system < first else []
        yield segment, number, len(head) + own[0] - first, head + turns[first : own[-1] + 1]


def test_windows_equal_a_plain_version(hard_turns):
    """Over seams of segments, with long, empty, NULL and repeated turns."""
    windows = chat.formatted(hard_turns)
    read = windows.select("*", chat.read_turns(windows.text).alias("turns")).collect()
    conversations = defaultdict(list)
    for r in hard_turns.collect():
        conversations[r.conv_id].append(r)
    got = {(w.conv_id, w.segment, w.window): (w.n_context, [tuple(t) for t in w.turns]) for w in read}
    want = {(key, s, k): (n, t) for key, rows in conversations.items() for s, k, n, t in plain_windows(rows)}
    assert got == want
    for w in read:
        assert w.n_tokens == len(w.text.encode()) and w.over_budget == (w.n_tokens > chat.BUDGET)
        if w.over_budget:  # one turn of its own, and no history
            assert len(w.turns) - w.n_context == 1 and w.n_context <= 1
    assert any(w.conv_id == 2 and w.segment and not w.window and w.n_context > 1 for w in read)


def test_windows_follow_the_order_not_the_numbers(spark):
    """Sparse numbers give the windows of dense ones, history crosses segments, windows are well filled."""
    rows = [(k, "system" if not k else ("user", "assistant")[k % 2], f"turn {k} " * (1 + k % 9)) for k in range(1500)]
    schema = "conv_id long, turn long, role string, text string"
    made = []
    for step in (1, 10_000):
        turns = spark.createDataFrame([(1, k * step, role, text) for k, role, text in rows], schema)
        made.append(chat.formatted(turns.repartition(4)).orderBy("segment", "window").collect())
    assert made[0] == made[1]
    assert all(w.n_context == 3 for w in made[0][1:])
    assert sum(w.n_tokens for w in made[0]) / len(made[0]) > 0.7 * chat.BUDGET


def test_given_counts_and_texts_without_spaces(spark):
    """Bytes bound the tokens of any script; a column of counts takes their place."""
    schema = "conv_id long, turn long, role string, text string, n long"
    turns = spark.createDataFrame([(1, 0, "user", "漢" * 50_000, 30_000), (1, 1, "assistant", "好", 5), (1, 2, "user", "x", None)], schema)
    first, second = chat.formatted(turns).orderBy("window").collect()
    assert first.n_tokens > 150_000 and first.over_budget and not second.over_budget
    first, second = chat.formatted(turns, tokens="n").orderBy("window").collect()
    assert (first.n_tokens, second.n_tokens, second.n_context) == (30_000, 5, 0)


def test_no_conversations_and_empty_ones(spark, hard_turns):
    assert chat.digests(chat.formatted(hard_turns.limit(0))).count() == 0
    empty = spark.createDataFrame([(1, 0, None, None)], "conv_id long, turn long, role string, text string")
    row = chat.digests(chat.formatted(empty)).first()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (1, 0, hashlib.sha256(b"").hexdigest())


def test_main_path_is_native(hard_turns):
    plan = chat.digests(chat.formatted(hard_turns))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
