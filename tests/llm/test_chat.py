import random

from pyspark.sql import functions as F

from fennmark.llm import chat, queries
from tests.oracle import SF, duck, duck_rows, spark_rows

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, t int, k int"


def back(df):
    read = df.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss_texts(F.col("formatted"), F.col("turns")).alias("loss"))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], list(r.loss)) for r in read.collect()}


def test_query_equals_sql(spark):
    names, expected = duck_rows(duck(), queries.OP1_SQL)
    df = queries.op1_chat_format(spark, SF)
    assert sorted(df.columns) == names and spark_rows(df) == expected


def test_round_trip_of_control_strings(spark):
    rng = random.Random(3)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<", "\\", "|", "|>", "<\\|", "<|nl|>", "assistant", " ", "é", "\U0001f600", ""]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
    rows = [(c, t, rng.choice(["user", "assistant", text()]), text(), "", 0, 0) for c in range(200) for t in range(rng.randrange(1, 5))]
    got = back(chat.format_chat(spark.createDataFrame(rows, SCHEMA)))
    for c in got:
        mine = [(r[2], r[3]) for r in rows if r[0] == c]
        assert got[c] == (mine, [t for role, t in mine if role == "assistant"])


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 0, None, None, None, None, None), (1, None, "assistant", None, "", 1, 1), (None, 0, "user", "a", "", 1, 1), (2, 0, "user", "b", "", 1, 1), (2, 0, "user", "a", "", 1, 1), (2, 0, "user", "a", "", 1, 1), (3, 0, "assistant", "x" * 300_000, "", 1, 1)]
    got = back(chat.format_chat(spark.createDataFrame(rows, SCHEMA)))
    assert got[1] == ([("assistant", ""), ("", "")], [""])
    assert got[None] == ([("user", "a")], [])
    assert got[2][0] == [("user", "a"), ("user", "a"), ("user", "b")]
    assert got[3][1] == ["x" * 300_000]
    assert chat.format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


def test_content_parts(spark):
    parts = [("text", "see <|image|>: ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), None, ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, 5, None, None), (None, None, None, None, None, None, None)]
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])], f"conv_id long, turn long, role string, text array<{chat.PART}>")
    r = chat.format_chat(rows).first()
    assert r.formatted == "<|im_start|>user\nsee <\\|image|>: <|image|><|audio|><|document|><|image|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert [tuple(a) for a in r.attachments] == [("image", "a.png", 4, 0), ("audio", "b.wav", 38, 0), ("document", "c.pdf", 3072, 0), ("image", None, 0, 0)]
    assert r.expanded_tokens == 4 + 38 + 3072


def test_query_rows_come_through_the_visitor(spark, monkeypatch):
    seen, visit = [], chat.visit_parts
    monkeypatch.setattr(chat, "visit_parts", lambda parts, **sizes: seen.append(1) or visit(parts, **sizes))
    assert queries.op1_chat_format(spark, SF).count() > 0 and seen
