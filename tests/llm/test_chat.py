import random

from pyspark.sql import functions as F

from dictspark.llm import chat

PARTS = ["</s>", "<s>", "[INST] ", " [/INST]", "\\", "<<SYS>> ", " <</SYS>>", "<turn>", "<role>", "</name> ", " </role>", "<none/>", "a", " ", "\n", "<", "[", "é", "𝄞", "s>", "/s>", "INST]", "$1"]


def read(spark, rows):
    done = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = done.select("conv_id", "formatted", "loss", chat.parsed(F.col("formatted")).alias("turns"), chat.under_mask(F.col("formatted"), F.col("loss")).alias("learnt"))
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_of_any_text(spark):
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "", "a b ", "</name> x", " </role>", None]
    rows, expected = [], {}
    for conv in range(150):
        own = [(rng.choice(roles), "".join(rng.choices(PARTS, k=rng.randrange(8)))) for _ in range(rng.randrange(1, 9))]
        expected[conv] = own
        rows += [(conv, t, role, text) for t, (role, text) in enumerate(own)]
    rng.shuffle(rows)
    for conv, got in read(spark, rows).items():
        assert [(t.role, t.text) for t in got.turns] == expected[conv], got.formatted
        assert got.learnt == "".join(text for role, text in expected[conv] if role == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (2, 0, "user", "</s>[INST] ok [/INST]")]
    got = read(spark, rows)
    assert got[1].formatted == "<s>[INST] a<turn>b [/INST] c<turn>d </s>"
    assert [(s.start, s.length) for s in got[1].loss] == [(len("<s>[INST] a<turn>b [/INST] "), 1), (len("<s>[INST] a<turn>b [/INST] c<turn>"), 1)]
    assert "</s>" not in got[2].formatted and got[2].turns[0].text == "</s>[INST] ok [/INST]"


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 0, "user", None), (None, None, "assistant", "first"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 2, None, "")]
    got = read(spark, rows)
    assert [(t.role, t.text) for t in got[None].turns] == [("assistant", "first"), ("user", "")]
    assert [(t.role, t.text) for t in got[3].turns] == [("user", "a"), ("user", "a"), ("user", "b"), (None, "")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("Pieces", F.lit(1)).withColumn("t", F.lit(2))
    assert chat.formatted(docs).columns == ["conv_id", "formatted", "loss"]
    assert chat.formatted(docs.limit(0)).count() == 0


def test_a_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"é{t}") for t in range(3000)] + [(2, 0, "assistant", "x\\" * 100_000)]
    got = read(spark, rows)
    assert [t.text for t in got[1].turns] == [f"é{t}" for t in range(3000)]
    assert got[1].learnt == "".join(f"é{t}" for t in range(1, 3000, 2))
    assert got[2].learnt == "x\\" * 100_000


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert "Python" not in chat.formatted(rows)._jdf.queryExecution().toString()
