"""Preference formatting against plain Python."""

from itertools import groupby

from starloom.llm import preference

TURN = "conv_id long, turn long, role string, text string"


def text(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, t in turns)


def brute(rows, pairs):
    clean = [(c, n, r or "", t or "") for c, n, r, t in rows if c is not None]
    order = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])
    lists = {c: [r[1:] for r in g] for c, g in groupby(sorted(clean, key=order), key=lambda r: r[0])}
    out = []
    for a, b in pairs:
        if a in lists and b in lists:
            n = 0
            while n < min(len(lists[a]), len(lists[b])) and lists[a][n][1:] == lists[b][n][1:]:
                n += 1
            out.append((a, b, n, text(lists[a][:n]), text(lists[a][n:]), text(lists[b][n:])))
    return sorted(out)


ROWS = [
    (1, 0, "user", "Hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "More"), (1, 3, "assistant", "é🙂"),
    (2, 0, "user", "Hi"), (2, 1, "assistant", "Hello"), (2, 2, "user", "Less"),
    (3, 0, "user", "Hi"), (3, 1, "assistant", "Hello"),
    (4, 5, "user", "Hi"), (4, 7, "assistant", "Hello"), (4, None, None, None),
    (5, 0, "system", "s" * 100_000), (5, 1, "assistant", ""),
    (6, 0, "user", "Hi"), (6, 0, "user", "Hi"), (None, 0, "user", "Hi"),
]
PAIRS = [(1, 2), (2, 1), (1, 3), (3, 1), (1, 1), (4, 1), (5, 6), (6, 3), (1, 99), (None, 1), (1, 2)]


def examples(spark, rows=ROWS, pairs=PAIRS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, TURN).withColumns({c: F.lit("x") for c in ("one", "other", "turns", "n_common")})
    return preference.preference_examples(df, spark.createDataFrame(pairs, "chosen_id long, rejected_id long"))


def test_prefix_and_completions(spark):
    got = examples(spark).drop("chosen_mask", "rejected_mask").collect()
    assert sorted(tuple(r) for r in got) == brute(ROWS, PAIRS)


def test_mask_covers_assistant_text(spark):
    for r in examples(spark).collect():
        for part, runs in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            at, learned = 0, ""
            for run in filter(None, runs.split(",")):
                n, flag = map(int, run.split(":"))
                learned += part[at : at + n] if flag else ""
                at += n
            assert at == len(part)
            blocks = part.split("<|im_start|>")[1:]
            assert learned == "".join(b.split("\n", 1)[1][:-1] + "\n" for b in blocks if b.startswith("assistant\n"))


def test_pairs(spark):
    rows = [(0, 0, "assistant", "ab"), (1, 0, "assistant", "abc"), (2, 0, "user", "x"), (3, 0, "assistant", None), (4, 0, "user", "y")]
    got = preference.neighbour_pairs(spark.createDataFrame(rows + [(None, 0, "assistant", "abcdef")], TURN)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0), (2, 3)]


def test_no_python_in_the_plan_and_empty_tables(spark):
    df = examples(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert examples(spark, [], []).count() == 0 and examples(spark, ROWS, []).count() == 0
