from outpulse.llm import chat


def pairs(spark, rows):
    return {r.pair_id: r for r in chat.preference_pairs(
        spark.createDataFrame(rows, "pair_id LONG, side STRING, turn LONG, role STRING, text STRING, pos INT, first STRING")).collect()}


def test_prefix_masks_and_odd_turns(spark):
    rows = [
        (1, "chosen", 0, "user", "hi", 9, "z"), (1, "chosen", 1, "assistant", "yes <|x", 9, "z"), (1, "chosen", 2, "user", None, 9, "z"),
        (1, "rejected", 0, "user", "hi", 9, "z"), (1, "rejected", 5, "assistant", "no", 9, "z"),
        (2, "chosen", 0, "user", "a", 9, "z"), (2, "rejected", 0, "user", "a", 9, "z"),
        (3, "chosen", None, None, "lone", 9, "z"), (None, "chosen", 0, "user", "dropped", 9, "z"),
        (4, "chosen", 1, "assistant", "t", 9, "z"), (4, "chosen", 1, "assistant", "t", 9, "z"), (4, "rejected", 1, "assistant", "t", 9, "z"),
    ]
    got = pairs(spark, rows)
    one = got[1]
    assert (one.shared_turns, one.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert one.chosen == "<|assistant|>\nyes < |x<|end|>\n<|user|>\n<|end|>\n" and one.rejected == "<|assistant|>\nno<|end|>\n"
    assert [one.chosen[slice(*map(int, s.split(":")))] for s in one.chosen_mask.split(",")] == ["yes < |x<|end|>"]
    assert [one.rejected[slice(*map(int, s.split(":")))] for s in one.rejected_mask.split(",")] == ["no<|end|>"]
    assert (got[2].shared_turns, got[2].chosen, got[2].rejected_mask) == (1, "", "")
    assert (got[3].shared_turns, got[3].chosen, got[3].rejected) == (0, "<||>\nlone<|end|>\n", "")
    assert (got[4].shared_turns, got[4].chosen, got[4].rejected) == (1, "<|assistant|>\nt<|end|>\n", "")
    assert set(got) == {1, 2, 3, 4}


def test_swapped_replies_and_empty(spark):
    schema = "conv_id LONG, turn LONG, role STRING, text STRING, side STRING, _n LONG, own STRING"
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (4, 0, "user", "p"), (4, 1, "assistant", None), (4, 2, "user", "more"),
            (9, 0, "assistant", "third"), (5, 0, "user", "no reply"), (None, 0, "assistant", "x")]

    def pairs_of(some):
        frame = spark.createDataFrame([(*r, "s", 1, "o") for r in some], schema).repartition(3)
        return {r.pair_id: r for r in chat.preference_pairs(chat.swapped_replies(frame)).collect()}

    got = pairs_of(rows)
    # Even ids have partners, ids need no neighbours, the last one's partner is the first.
    assert set(got) == {2, 4, 9}
    assert got[2].chosen == "<|assistant|>\na<|end|>\n" and got[2].rejected == "<|assistant|>\n<|end|>\n"
    assert got[4].rejected == "<|assistant|>\nthird<|end|>\n" and got[9].rejected == "<|assistant|>\na<|end|>\n"
    assert pairs_of(rows[:2]) == {} and pairs_of([]) == {}


def test_many_turns_and_long_texts(spark):
    """A long conversation keeps its whole prefix once; texts of megabytes pass as they are."""
    long = "y" * 2_000_000
    turns = [("c", n, "user" if n % 2 == 0 else "assistant", long if n == 3 else f"t{n}") for n in range(4001)]
    rows = [(1, side, n, role, text, 0, "") for side in ("chosen", "rejected") for _, n, role, text in turns]
    rows[-1] = (*rows[-1][:4], "other", 0, "")
    one = pairs(spark, rows)[1]
    assert one.shared_turns == 4000 and long in one.prompt and one.prompt.count("<|end|>") == 4000
    assert (one.chosen, one.rejected) == ("<|user|>\nt4000<|end|>\n", "<|user|>\nother<|end|>\n")
