"""Turns without a number are compared like others."""

from reelhouse.llm import chat_format


def test_null_turn_numbers_are_common(spark):
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    user, reply, other = (None, "user", "hi"), (None, "assistant", "good"), (None, "assistant", "bad")
    pairs = spark.createDataFrame([(1, [user, reply], [user, reply]), (2, [user, reply], [user, other]), (3, [user], [user, reply])],
                                  f"pair_id long, chosen {turns}, rejected {turns}")
    got = {r.pair_id: (r.prompt_turns, r.same, r.chosen) for r in chat_format.preference_format(pairs).collect()}
    assert got == {1: (2, True, ""), 2: (1, False, "good<|im_end|>\n"), 3: (1, False, "")}
