from plain import SF001
from pyspark.sql import functions as F

from wiretable.llm import registry
from wiretable.llm.conversations import reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "user", "Hello there.\nHow are  you?\n\nSecond para\nline two"),
    (1, 1, "assistant", "> how are you?\nFine"),
    (1, 2, "user", ">> How are you?\n> Fine\nGood to hear"),
    (1, 3, "assistant", "unquoted"),
    (1, 4, "user", "> > > how are you?\n> Second para\n> line two\n>\n> nothing\nok"),
    (1, 5, "assistant", ">> Good to hear\nagain"),
    (1, 6, "user", "> said by nobody\nwell"),
]


def test_replies_follow_what_they_quote(spark):
    rows = reply_ordered(spark.createDataFrame(TALK, SCHEMA)).collect()
    assert [(r.thread, r.turn, r.depth, r.parent, r.text) for r in rows] == [
        (0, 0, 0, None, TALK[0][3]), (0, 1, 1, 0, "Fine"), (0, 2, 2, 1, "Good to hear"), (0, 4, 1, 0, "ok"),
        (0, 5, 3, 2, "again"), (3, 3, 0, None, "unquoted"), (6, 6, 0, None, "well")]
    assert rows[1].formatted == "<|assistant|>\nFine<|end|>\n"


def test_long_chains_and_common_lines(spark):
    chain = [(1, k, "user", f"> message {k - 1}\nmessage {k}\nthe same line") for k in range(70)]
    common = [(2, k, "user", "> the same line\nthe same line") for k in range(50)]
    rows = reply_ordered(spark.createDataFrame(chain + common, SCHEMA)).collect()
    assert [r.depth for r in rows if r.conv_id == 1] == list(range(70))
    assert {(r.thread, r.parent) for r in rows if r.conv_id == 2} == {(0, None), (0, 0)}


def test_odd_rows(spark):
    odd = [(2, 0, "user", None), (None, 1, "user", "> x"), (2, None, "user", "> x"), (2, 1, None, "> zzz\n text "),
           (2, 2, "user", "> text"), (2, 2, "user", "> text"), (2, 3, "user", ""), (3, 0, "a", "x" * 50_000 + "\n> y")]
    rows = reply_ordered(spark.createDataFrame(odd, SCHEMA)).collect()
    assert sorted((str(r.conv_id), str(r.turn), r.depth, r.text[:4]) for r in rows) == sorted([
        ("2", "0", 0, ""), ("None", "1", 0, ""), ("2", "None", 0, ""), ("2", "1", 0, "text"), ("2", "2", 1, ""), ("2", "2", 1, ""),
        ("2", "3", 0, ""), ("3", "0", 0, "xxxx")])
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_marks_and_blanks(spark):
    marks, blanks = ">" * 100_000, " " * (1 << 20)
    rows = [(1, 0, "user", f"said {blanks}once{blanks}"), (1, 1, "user", f"{marks} said once\nreply"), (1, 2, "user", f"{blanks}> said once\n{blanks}x"),
            (1, 3, "user", f"{blanks}\n{marks}\n" + "> " * 50_000 + "said once\nlast")]
    got = {r.turn: r for r in reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k].parent for k in range(4)] == [None, 0, 0, 0]
    assert (got[1].text, got[2].text, got[3].text) == ("reply", "x", "last") and len(got[0].text) == len("said once") + len(blanks)


def test_many_messages_that_quote(spark):
    """100,000 messages of which two of three quote: a third of them in one conversation."""
    n = F.col("id")
    conv = F.when(n % 3 == 0, F.lit(0).cast("bigint")).otherwise(n % 997)
    # In the large conversation every message quotes the one three before, in the others the one 997 before.
    before = n - F.when(n % 3 == 0, 3).otherwise(997 * 3)
    quotes = (n % 9 != 0) & (before >= 0)
    text = F.concat(F.when(quotes, F.concat(F.lit("> message number "), before.cast("string"), F.lit("\n"))).otherwise(""),
                    F.lit("message number "), n.cast("string"))
    rows = spark.range(100_000).select(conv.alias("conv_id"), n.alias("turn"), F.lit("user").alias("role"), text.alias("text"))
    got = reply_ordered(rows, ordered=False).where("parent is not null")
    r = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("turn") - F.col("parent") == F.when(F.col("conv_id") == 0, 3).otherwise(2991)).alias("good")).first()
    assert r.n > 50_000 and r.good >= r.n - 200


def test_plan_is_native(spark):
    plan = reply_ordered(spark.createDataFrame(TALK, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_query_without_quotations(spark):
    rows = registry.op10_quotations(spark, SF001).collect()
    source = spark.read.parquet(f"{SF001}/conversations.parquet").collect()
    assert sorted((r.conv_id, r.turn) for r in rows) == sorted((r.conv_id, r.turn) for r in source)
    assert [(r.conv_id, r.thread, r.turn) for r in rows] == sorted((r.conv_id, r.thread, r.turn) for r in rows)
