"""Formatting and reading back, on texts that look like the template."""
import hashlib
import random
from collections import defaultdict

from tidemark.llm import chat_format
from tidemark.llm.queries import CONTROL_TEXT, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def held_against(frame, rows):
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        turns[conv].append((role or "", text or ""))
    got = frame.set_index("conv_id")
    assert sorted(got.index) == sorted(turns)
    for conv, said in turns.items():
        loss = "".join(t for r, t in said if r == "assistant")
        r = got.loc[conv]
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{a}\n{b}\n" for a, b in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_round_trip_across_small_batches(spark):
    random.seed(5)
    parts = [*chat_format.CONTROL, "\\", " ", "\n", "<", "s>", "é", "😀", "[", "/", "<<", ">>"]
    roles = ["user", "assistant", "system", "tool", "<s>", "", None, "[INST]\\"]
    rows = [
        (i // 7, i % 7, random.choice(roles), random.choice([None, "", *["".join(random.choices(parts, k=random.randrange(1, 9))) for _ in range(9)]]))
        for i in range(2100)
    ]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = chat_format.digest_chats(chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    held_against(got, rows)


def test_query_on_the_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    held_against(QUERIES["op8_chat_format"](spark, sf).toPandas(), [*rows, (-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)])


def test_formatted_text_marks_turns(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "yes"), (1, 3, "tool", "x")]
    got = chat_format.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert bytes(got["formatted"]).decode() == "<<SYS>>\nbe kind\n<</SYS>>\n[INST] hi \\</s> [/INST] <s> yes </s><<ROLE>>tool\n<</ROLE>>\nx\n<</TURN>>\n"


def test_edges(spark):
    assert chat_format.digest_chats(chat_format.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "assistant", "z" * 300_000)]
    got = {r["conv_id"]: r for r in chat_format.digest_chats(chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert (got[None]["n_turns"], got[1]["n_turns"], got[2]["loss_chars"]) == (1, 3, 300_000)
