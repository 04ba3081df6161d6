from __future__ import annotations

from pyspark.sql import functions as F

from martline.llm.preference import format_pairs

SCHEMA = "conv_id long, turn long, role string, text string, pair_id string"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    done = format_pairs(df, F.floor(F.col("conv_id") / 2), F.pmod(F.col("conv_id"), F.lit(2)))
    return {r["pair_id"]: r for r in done.collect()}


def plain(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_prefix_completions_and_masks(spark):
    got = formatted(spark, [
        (0, 0, "user", "hi"), (0, 1, "assistant", "good one"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"),
        (2, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "user", "alone"),
        (6, 0, "user", "same"), (6, 1, "assistant", "é日"), (7, 0, "user", "same"), (7, 1, "assistant", "é日"), (7, 2, "assistant", "more"),
        (8, 0, None, None), (9, 0, None, None), (9, 1, "assistant", ""), (9, None, "user", "lost"), (None, 0, "user", "lost"),
        (10, 5, "b", "2"), (10, 5, "a", "1"), (10, 5, "a", "1"), (11, 0, "a", "1"), (11, 1, "a", "1"), (11, 9, "b", "3"),
    ])
    assert set(got) == {0, 1, 3, 4, 5}
    r = got[0]
    assert (r["chosen_id"], r["rejected_id"], r["prefix_turns"]) == (0, 1, 1)
    assert r["prompt"] == plain([("user", "hi")]) and r["chosen"] == plain([("assistant", "good one")])
    assert r["rejected"] == plain([("assistant", "bad"), ("user", "why")])
    assert [r["chosen"][s["start"] : s["start"] + s["length"]] for s in r["chosen_mask"]] == ["good one<|end|>\n"]
    assert [r["rejected"][s["start"] : s["start"] + s["length"]] for s in r["rejected_mask"]] == ["bad<|end|>\n"]
    assert (got[1]["prefix_turns"], got[1]["chosen"], got[1]["rejected"], got[1]["chosen_mask"]) == (1, "", "", [])
    assert (got[3]["prefix_turns"], got[3]["chosen"]) == (2, "") and got[3]["rejected"] == plain([("assistant", "more")])
    assert got[4]["prompt"] == plain([("", "")]) and got[4]["rejected_mask"][0]["length"] == len("<|end|>\n")
    assert got[5]["prefix_turns"] == 2 and got[5]["rejected"] == plain([("b", "3")])


def test_long_and_empty(spark):
    long = "x" * 300_000
    got = formatted(spark, [(0, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", long)])
    assert got[0]["rejected_mask"][0]["length"] == len(long) + len("<|end|>\n")
    assert formatted(spark, []) == {}
