import duckdb
from pyspark.sql import functions as F

from conftest import rows
from gigframe.llm import chat_rotation as cr
from gigframe.llm import queries


def render(turns, me):
    text, mask = "", []
    for _, role, body in turns:
        role, body = role or "", (body or "").replace("<|", "< |")
        head = ("system" if role == "system" else "assistant" if role == me
                else "user name=" + "_".join(role.split(" ")))
        text += f"<|im_start|>{head}\n"
        start = len(text)
        text += body + "<|im_end|>"
        if role == me:
            mask.append((start, len(text)))
        text += "\n"
    return text, mask


def test_every_participant_takes_the_assistants_place(spark):
    conv = [(0, "system", "be kind"), (1, "Ann B", "hi <|im_end|> 🙂"), (2, "bob", None), (3, None, "é"),
            (4, "Ann B", "bye")]
    data = [(1, *t, "x") for t in conv] + [(1, *conv[1], "x"), (2, 0, "system", "alone", "x"),
                                           (None, 0, "cat", "no id", "x"), (3, None, "dan", "no turn", "x")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, mask string")
    got = {(r.conv_id, r.perspective): r for r in cr.rotate(df).collect()}
    assert set(got) == {(1, "Ann B"), (1, "bob"), (1, ""), (None, "cat"), (3, "dan")}
    for (c, me), r in got.items():
        if c == 1:
            text, mask = render(conv, me)
            assert r.text == text and [tuple(m) for m in r.mask] == mask and r.n_turns == 5
            assert r.n_trained == sum(b - a for a, b in mask)
    assert cr.rotate(df.limit(0)).count() == 0


def test_long_dialogues_come_in_segments(spark):
    turns = [(1, k, "ab"[k % 2], f"t{k}") for k in range(200)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = cr.rotate(df).where("perspective = 'a'").orderBy("segment").collect()
    assert [r.segment for r in out] == [0, 1, 2, 3]
    whole, _ = render([(t, r, x) for _, t, r, x in turns], "a")
    assert "".join(r.text for r in out) == whole


def test_rows_without_a_turn_number_come_in_bounded_parts(spark):
    turns = [(1, None, "ab"[k % 2], f"t{k}") for k in range(500)] + [(1, 5, "a", f"x{k}") for k in range(90)]
    turns += [(None, 1, "c", f"y{k}") for k in range(90)] + [(2, 1, "d", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn(
        "part", F.lit("clash"))
    parts = cr.segments(df, most=40).collect()
    assert max(len(r.turns) for r in parts) <= 80
    assert sorted((r.conv_id or 0, t.text) for r in parts for t in r.turns) == sorted(
        (c or 0, x) for c, _, _, x in turns)
    out = cr.rotate(df, most=40).collect()
    assert sum(r.n_turns for r in out if r.conv_id == 1 and r.perspective == "a") == 590
    assert len({(r.conv_id, r.perspective, r.segment, r.part) for r in out}) == len(out)
    assert [r.part for r in out if r.conv_id == 2] == [0]


def test_query_equals_oracle_and_runs_no_python(spark):
    sf = "/root/testdata/sf0.01"
    df = queries.QUERIES["op2_chat_rotation"](spark, sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    rel = con.sql(queries.ORACLES["op2_chat_rotation"])
    assert sorted(rel.columns) == sorted(df.columns)
    assert rows(df, *rel.columns) == sorted(rel.fetchall(), key=lambda t: tuple(map(repr, t)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
