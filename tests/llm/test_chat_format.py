"""Preference formatting against its SQL twin, and its edge cases."""

import duckdb
import pytest

from reelhouse.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def same_as_twin(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = chat_format.query(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    cur = con.execute(chat_format.SQL)
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, r)) for r in cur.fetchall()]
    key = lambda r: (r["conv_id"] is not None, r["conv_id"] or 0)
    assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("rows", [
    [],
    [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, None, None, None)],
    [(1, 0, None, None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, None, "user", ""), (2, 0, "assistant", "first"), (2, 1, "assistant", "first")],
    [(3, i, "user" if i % 2 == 0 else "assistant", f"turn {i} é😀 <|im_end|>") for i in range(400)],
    [(-5, 0, "user", "long " * 200_000), (-5, 1, "assistant", "more " * 200_000), (-5, 2, "assistant", "x"), (6, 0, "user", "alone"), (7, 0, "assistant", "")],
])
def test_equals_the_sql_twin(spark, rows, tmp_path):
    same_as_twin(spark, rows, tmp_path)


def test_columns_of_other_names_are_not_read(spark):
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    pairs = spark.createDataFrame([(1, [(0, "user", "hi")], [(0, "user", "ho")], "x", "y", True)],
                                  f"pair_id long, chosen {turns}, rejected {turns}, __a string, prompt string, __OPEN boolean")
    got = chat_format.preference_format(pairs).collect()
    assert len(got) == 1 and got[0].prompt_turns == 0 and got[0].chosen.startswith("<|im_start|>user\nhi")
