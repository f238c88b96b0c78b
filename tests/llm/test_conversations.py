"""Repair of conversations against a plain search over all edits."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import FOLDER
from tidewater.llm import conversations
from tidewater.llm import queries as llm

SCHEMA = "conv_id long, turn long, role string, text string, seq long, edit string, found string, fault string, copy int, moves int"


def expected(turns, conv_ids):
    groups = defaultdict(list)
    for row in turns:
        groups[row[0]].append(row)
    return Counter((c, *brute.audited(groups[c])) for c in conv_ids)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "D", "x", "y", 5, 6) for r in rows], SCHEMA).repartition(3)


def wild_rows(seed, n_conversations=60):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u"]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "é漢\U0001f600!", "So it is", "A longer answer. " * 30]
    rows = [(c if c else None, draw.choice([None, -3, 0, 1, 2, 3, 5, 8, 13]), draw.choice(roles), draw.choice(texts)) for c in range(n_conversations) for _ in range(draw.randrange(9))]
    return rows + rows[:20]


def test_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = Counter(map(tuple, llm.QUERIES["op11_conversation_repair"](spark, FOLDER).collect()))
    assert got == expected(brute.damaged(rows), {r[0] for r in rows})


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_wild_rows(spark, seed, batch):
    """NULLs, ties, repeated rows, strange roles, clashing columns; batches that end inside conversations."""
    rows = wild_rows(seed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        turns = conversations.damaged(frame(spark, rows))
        got = Counter(map(tuple, conversations.audits_of_all(turns, frame(spark, rows)).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected(brute.damaged(rows), {r[0] for r in rows})


def test_log_is_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "And"), (1, 2, "user", "And"), (2, 0, "user", "Hi."), (3, None, "tool", None)]
    log = conversations.repair(frame(spark, rows)).orderBy("conv_id", "seq").collect()
    assert [(r.conv_id, r.edit, r.role, r.text, r.fault) for r in log] == [
        (1, "K", "system", "Be brief.", None), (1, "I", "user", "", None), (1, "K", "assistant", "Hello.", None), (1, "D", "user", "And", "truncated"),
        (1, "D", "user", "And", "duplicate"), (2, "K", "user", "Hi.", None), (2, "I", "assistant", "", None), (3, "D", "tool", " ", "blank"),
    ]


def test_one_long_conversation(spark):
    """Many batches of one conversation, in one task."""
    draw = random.Random(5)
    rows = [(7, k, draw.choice(["user", "assistant"]), f"Text {k}{draw.choice('.!?x')}") for k in range(1500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = [tuple(r) for r in conversations.audits(conversations.repair(frame(spark, rows))).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == list(expected(rows, [7]))


def test_decisions_are_the_least(spark):
    """All role sequences up to five turns."""
    rows, conv = [], 0
    for n in range(1, 6):
        for roles in itertools.product(["system", "user", "assistant"], repeat=n):
            rows += [(conv, k, r, f"Line {k}{'.' if (conv + k) % 3 else ''}") for k, r in enumerate(roles)]
            conv += 1
    got = Counter(map(tuple, conversations.audits(conversations.repair(frame(spark, rows))).collect()))
    assert got == expected(rows, range(conv))


def test_no_rows_after_damage(spark):
    every = frame(spark, [(1, 0, "user", "x"), (None, 0, "user", "x")])
    got = conversations.audits_of_all(every.limit(0), every).collect()
    assert len(got) == 2 and {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", brute.audited([])[-1])}
    assert conversations.audits_of_all(every.where(F.lit(False)), every.where(F.lit(False))).count() == 0
    assert conversations.repair(every.where(F.lit(False))).count() == 0
