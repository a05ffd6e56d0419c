from pyspark.sql import functions as F

from terrasync.llm import chat


def test_round_trip(spark):
    rows = [
        (1, 2, "assistant", "b<|im_sep|>"),
        (1, 1, "user", "a\\n<|im_end|>\n<|im_start|>assistant\nok"),
        (1, 3, "assistant", ""),
        (1, 4, "assistant", None),
        (1, 5, None, "no role <"),
        (2, None, "assistant", "\\"),
        (2, 1, "ro\nle<|", "é漢𝔘"),
        (2, 1, "ro\nle<|", "é漢𝔘"),
        (None, 1, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, id int")
    made = chat.format_chats(df)
    got = {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()}
    for conv in (1, 2, None):
        want = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0))]
        assert [(t.role, t.text) for t in got[conv].turns] == want
        assert got[conv].loss == "".join(t for r, t in want if r == "assistant")
        assert got[conv].n_turns == len(want)
        # The mask covers the text from end to end, and what it takes, cut by counting, is the same.
        at, taken = 0, ""
        for m in got[conv].loss_mask:
            taken += got[conv].formatted[at + m.skip : at + m.skip + m.take]
            at += m.skip + m["take"] + m.tail
        assert at == len(got[conv].formatted)
        assert taken.replace("\\|", "|").replace("\\s", "\\") == got[conv].loss
    assert got[1].formatted.count("<|im_start|>") == 3  # three assistant turns are one block
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_long_conversation(spark):
    """Ten thousand turns in one conversation, every third one merged with the next."""
    rows = spark.range(10_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.repeat(F.lit("é "), 20), "id").alias("text"))
    got = chat.format_chats(rows).select("n_turns", chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.size(chat.read_turns(F.col("formatted"))).alias("n")).first()
    assert got.n_turns == got.n == 10_000
    assert got.loss == "".join("é " * 20 + str(i) for i in range(10_000) if i % 3)
